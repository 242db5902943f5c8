"""Cohort selection and semi-join restriction (B1, B3, C1, C2a-c, D5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.functions.bloom import maybe_in
from wardflow.sources import dictionary as dic

COHORT_COLUMNS = ["subject_id", "icustay_id", "hadm_id", "gender", "dbsource", "first_careunit",
                  "last_careunit", "first_wardid", "last_wardid", "intime", "outtime", "los",
                  "pt_age"]


def calendar_age(later: str = "intime", birth: str = "dob"):
    """H1: calendar-year difference (not completed years), as double."""
    return (F.year(later) - F.year(birth)).cast("double")


def build_cohort(patients: DataFrame, stays: DataFrame, min_age: int = dic.MIN_AGE,
                 max_age: int = dic.MAX_AGE, min_los: float = dic.MIN_LOS_DAYS) -> DataFrame:
    """B3 + C1: stays of patients aged [min_age, max_age] with ``los > min_los``.

    Both predicates are pushed below the join by Catalyst (``los`` reaches
    the stays scan as a parquet filter); the join itself is an equi join on
    ``subject_id`` whose strategy AQE picks from run-time sizes.
    """
    age = calendar_age("intime", "dob")
    joined = patients.select("subject_id", "gender", "dob").join(
        stays.where(F.col("los") > F.lit(float(min_los))), "subject_id")
    return (joined.withColumn("pt_age", age)
            .where(F.col("pt_age").between(float(min_age), float(max_age)))
            .select(*COHORT_COLUMNS))


def restrict(events: DataFrame, keys: DataFrame, on: str | list[str],
             key_names: str | list[str] | None = None, salt: int = 1, bloom_bits: int | None = None) -> DataFrame:
    """Keep ``events`` rows whose key appears in ``keys`` (left semi join).

    ``IN (SELECT DISTINCT k ...)`` needs no DISTINCT here: a semi join never
    duplicates the left side.  No broadcast hint: the key side grows with
    the cohort, so Spark's size threshold / AQE decide at run time.
    ``salt > 1`` splits a hot key explicitly (sessions without AQE): event
    rows are hashed into ``salt`` groups and each key row is repeated once
    per group.  ``bloom_bits`` tests rows against a Bloom filter of the keys
    where they are scanned, so that only few rows of other keys are shuffled
    to the join; ``keys`` is then read twice and should be materialised.
    """
    on = [on] if isinstance(on, str) else list(on)
    key_names = on if key_names is None else ([key_names] if isinstance(key_names, str)
                                              else list(key_names))
    k = keys.select(*[F.col(src).alias(dst) for src, dst in zip(key_names, on)])
    if bloom_bits:
        events = maybe_in(events, k, on, bloom_bits)
    if salt <= 1:
        return events.join(k, on, "left_semi")
    cols = events.columns
    ev = events.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(c) for c in cols]),
                                            F.lit(salt)))
    k = k.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"),
                                                    F.lit(salt - 1).cast("long"))))
    return ev.join(k, on + ["__salt"], "left_semi").select(*cols)
