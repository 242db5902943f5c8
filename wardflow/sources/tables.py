"""A1: table scans.  Parquet only; Catalyst prunes columns and pushes
filters into the scan, so loaders never select columns eagerly."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()

CLINICAL_TABLES = ("patients icustays chartevents labevents outputevents inputevents_cv "
                   "inputevents_mv").split()


def load(spark: SparkSession, base: str, name: str, schema=None) -> DataFrame:
    """Read ``{base}/{name}.parquet`` (or a directory of parquet files)."""
    path = os.path.join(base, f"{name}.parquet")
    if not os.path.exists(path) and os.path.isdir(os.path.join(base, name)):
        path = os.path.join(base, name)
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def conform(df: DataFrame, schema, fill_missing: bool = False) -> DataFrame:
    """Project ``df`` onto a declared StructType (names, order, types).
    A missing column is an error unless ``fill_missing`` (then NULL)."""
    from pyspark.sql import functions as F
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif fill_missing:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            raise ValueError(f"column {f.name!r} missing from input")
    return df.select(*cols)


def load_clinical(spark: SparkSession, base: str, fill_missing: bool = False) -> dict:
    """A1: the seven clinical base tables, each conformed to its declared
    schema (``wardflow.schemas``); keys match ``plans.features.long_features``."""
    return conform_clinical({n: load(spark, base, n) for n in CLINICAL_TABLES}, fill_missing)


def conform_clinical(tables: dict, fill_missing: bool = False) -> dict:
    """The seven clinical tables conformed to their declared schemas."""
    from wardflow import schemas
    declared = {"patients": schemas.PATIENTS, "icustays": schemas.ICUSTAYS,
                "chartevents": schemas.CHARTEVENTS, "labevents": schemas.LABEVENTS,
                "outputevents": schemas.OUTPUTEVENTS, "inputevents_cv": schemas.INPUTEVENTS_CV,
                "inputevents_mv": schemas.INPUTEVENTS_MV}
    return {n: conform(tables[n], declared[n], fill_missing) for n in CLINICAL_TABLES}


def register_views(spark: SparkSession, base: str, names=DRIVER_TABLES) -> None:
    """A4 for SQL users: one temp view per table."""
    for n in names:
        load(spark, base, n).createOrReplaceTempView(n)

