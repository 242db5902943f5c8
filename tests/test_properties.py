"""SURVEY §5 properties on the events analogue (sf0.001)."""

from pyspark.sql import functions as F

from wardflow.operators.impute import locf
from wardflow.plans import features as fx
from wardflow.sources import analogues as an
from wardflow.sources import dictionary as dic

SF = "/root/testdata/sf0.001"


def _pivot(spark, w=3):
    return fx.pivot(an.events_windowed(spark, SF), w)


def test_mask_is_raw_not_null(spark):
    pv = _pivot(spark)
    m = fx.masks(an.events_windowed(spark, SF), 3)
    j = pv.alias("p").join(m.alias("m"), ["icustay_id", "tw_hour_idx"])
    bad = j.where(" OR ".join(f"(p.{c} IS NOT NULL) <> (m.{c} = 1)" for c in dic.FEATURE_COLUMNS))
    assert bad.count() == 0 and j.count() == pv.count()


def test_impute_keeps_observed_values(spark):
    win = an.events_windowed(spark, SF)
    pv, imp = fx.pivot(win, 3), fx.imputed(win, 3)
    j = pv.alias("p").join(imp.alias("i"), ["icustay_id", "tw_hour_idx"])
    cols = [s.name for s in dic.DEFAULT_SPEC if s.source == s.name]
    bad = j.where(" OR ".join(f"(p.{c} IS NOT NULL AND p.{c} <> i.{c})" for c in cols))
    assert bad.count() == 0
    # only the raw (not imputed) columns may stay NULL
    nulls = j.where(" OR ".join(f"i.{s.name} IS NULL" for s in dic.DEFAULT_SPEC
                                if s.impute != "raw"))
    assert nulls.count() == 0


def test_locf_is_idempotent(spark):
    pv = _pivot(spark)
    once = pv.select("icustay_id", "tw_hour_idx", locf("hr").alias("hr"))
    twice = once.select("icustay_id", "tw_hour_idx", locf("hr").alias("hr"))
    a = sorted(tuple(r) for r in once.collect())
    b = sorted(tuple(r) for r in twice.collect())
    assert a == b


def test_windows_are_one_based_and_nested(spark):
    w = an.events_windowed(spark, SF)
    r = w.agg(F.min("tw_1hr"), F.min("tw_24hr"),
              F.sum((F.col("tw_24hr") != F.floor((F.col("tw_1hr") - 1) / 24) + 1).cast("int"))
              ).collect()[0]
    assert r[0] == 1.0 and r[1] == 1.0 and r[2] == 0
