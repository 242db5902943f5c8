"""Golden and property tests for the DataFrame operators (FIXTURES §4, SURVEY §5)."""

import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from conftest import ts
from wardflow import schemas
from wardflow.operators import aggregate as agg
from wardflow.operators import harmonize as hz
from wardflow.operators.cohort import build_cohort, restrict
from wardflow.operators.impute import impute, mask
from wardflow.operators.intervals import interval_join
from wardflow.plans import features as fx
from wardflow.sources import dictionary as dic


def _patients(spark):
    return spark.createDataFrame([
        (1, "F", ts("2100-12-31 00:00:00")), (2, "M", ts("2041-01-01 00:00:00")),
        (3, "M", ts("2040-01-01 00:00:00"))], schemas.PATIENTS)


def _stays(spark):
    def stay(subj, hadm, sid, intime, outtime, los):
        return (subj, hadm, sid, "cv", "MICU", "MICU", 1, 1, ts(intime), ts(outtime), los)
    return spark.createDataFrame([
        stay(1, 100, 10, "2116-01-01 10:20:00", "2116-01-01 20:00:00", 0.51),
        stay(1, 101, 11, "2116-03-01 00:00:00", "2116-03-02 00:00:00", 0.6),
        stay(2, 200, 20, "2116-01-01 00:00:00", "2116-01-01 12:00:00", 0.5),
        stay(2, 201, 21, "2116-02-01 00:00:00", "2116-02-03 00:00:00", 2.0),
        stay(3, 300, 30, "2116-01-01 00:00:00", "2116-01-03 00:00:00", 2.0)], schemas.ICUSTAYS)


def test_cohort_golden(spark):
    c = build_cohort(_patients(spark), _stays(spark))
    got = sorted((r.icustay_id, r.pt_age) for r in c.collect())
    # age 16 (calendar years) kept, 75 kept, 76 dropped; los 0.5 dropped, 0.51 kept
    assert got == [(10, 16.0), (11, 16.0), (21, 75.0)]
    assert c.columns[:3] == ["subject_id", "icustay_id", "hadm_id"]


def _chart(spark, rows):
    full = []
    for i, (hadm, stay, item, t, v) in enumerate(rows):
        full.append((i, 1, hadm, stay, item, ts(t), None, None,
                     None if v is None else str(v), v, "u", 0, 0, None, None))
    return spark.createDataFrame(full, schemas.CHARTEVENTS)


def test_chart_codes_and_whitelist(spark):
    cohort = build_cohort(_patients(spark), _stays(spark))
    t = "2116-01-01 12:00:00"
    chart = _chart(spark, [(100, 10, 52, t, 80.0), (100, 10, 828, t, 100.0),
                           (100, 10, 220045, t, 3000.0), (100, 10, 220045, t, 3000.5),
                           (999, 10, 52, t, 80.0),
                           (100, 10, dic.FIO2_CODES[0], t, 0.5), (999, 10, dic.FIO2_CODES[0], t, 0.5),
                           (999, 10, dic.TEMP_CODES[0], t, 37.0)])
    got = sorted((r.itemcat, r.itemid, r.valuenum)
                 for r in hz.chart_branches(chart, cohort).collect())
    # only TEMP needs no admission of the cohort
    assert got == [("ABP_mean", 52, 80.0), ("FiO2", dic.FIO2_CODES[0], 50.0), ("HR", 220045, 3000.0),
                   ("Temperature", dic.TEMP_CODES[0], 37.0)]


def test_lab_branch_interval_and_whitelist(spark):
    cohort = build_cohort(_patients(spark), _stays(spark))
    labs = spark.createDataFrame([
        (1, 100, 50912, ts("2116-01-01 09:20:00"), "1.1", 1.1, "mg/dl", None),
        (1, 100, 50912, ts("2116-01-01 09:19:59"), "1.2", 1.2, "mg/dl", None),
        (1, 100, 51301, ts("2116-01-01 12:00:00"), "9", 9.0, "K", None),
        (1, 100, 50912, ts("2116-01-01 21:00:00"), "1.3", 1.3, "mg/dl", None),
        (1, 100, 50912, ts("2116-01-01 21:00:01"), "1.4", 1.4, "mg/dl", None)], schemas.LABEVENTS)
    ls = hz.labs_with_stays(labs, restrict(_stays(spark), cohort, "hadm_id"))
    got = sorted((r.icustay_id, r.itemcat, r.valuenum) for r in hz.lab_branch(ls).collect())
    assert got == [(10, "CREATININE", 1.1), (10, "CREATININE", 1.3)]


def test_gcs_components(spark):
    t1, t2, t3 = "2116-01-01 12:00:00", "2116-01-01 13:00:00", "2116-01-01 14:00:00"
    rows = [(100, 10, 220739, t1, 4.0), (100, 10, 223900, t1, 5.0), (100, 10, 223901, t1, 6.0),
            (100, 10, 220739, t2, 4.0), (100, 10, 220739, t3, 2.0), (100, 10, 198, t3, 13.0)]
    chart = _chart(spark, rows)
    dup = chart.where(F.col("row_id") == 0)          # the same row twice counts once
    got = sorted((str(r.charttime), r.valuenum, r.itemid)
                 for r in hz.gcs_branch(chart.unionByName(dup)).collect())
    assert got == [("2116-01-01 12:00:00", 15.0, 198), ("2116-01-01 13:00:00", 4.0, 198),
                   ("2116-01-01 14:00:00", 13.0, 198)]


def test_interval_join_boundaries(spark):
    spans = spark.createDataFrame([(1, ts("2116-01-01 10:20:00"), ts("2116-01-01 20:00:00"))],
                                  "k long, intime timestamp_ntz, outtime timestamp_ntz")
    ev = spark.createDataFrame(
        [(1, ts(t)) for t in ["2116-01-01 09:20:00", "2116-01-01 09:19:59",
                              "2116-01-01 21:00:00", "2116-01-01 21:00:01"]] + [(2, None)],
        "k long, charttime timestamp_ntz")
    got = sorted(str(r.charttime) for r in interval_join(ev, spans, "k").collect())
    assert got == ["2116-01-01 09:20:00", "2116-01-01 21:00:00"]


def test_interval_join_matches_brute_force(spark):
    import datetime as dt
    rnd = random.Random(3)
    base = dt.datetime(2116, 1, 1)
    spans = [(rnd.randint(0, 5), base + dt.timedelta(minutes=rnd.randint(0, 3000)))
             for _ in range(20)]
    spans = [(k, s, s + dt.timedelta(minutes=rnd.randint(0, 600))) for k, s in spans]
    events = [(i, rnd.randint(0, 5), base + dt.timedelta(minutes=rnd.randint(-100, 4000)))
              for i in range(300)]
    sdf = spark.createDataFrame(spans, "k long, intime timestamp_ntz, outtime timestamp_ntz")
    edf = spark.createDataFrame(events, "id long, k long, charttime timestamp_ntz")
    got = sorted((r.id, r.intime) for r in interval_join(edf, sdf, "k").collect())
    tol = dt.timedelta(hours=1)
    want = sorted((i, s) for i, k, t in events for kk, s, e in spans
                  if k == kk and t - s >= -tol and e - t >= -tol)
    assert got == want
    salted = sorted((r.id, r.intime) for r in interval_join(edf, sdf, "k", salt=7).collect())
    assert salted == want


def test_restrict_semi(spark):
    ev = spark.createDataFrame([(1,), (2,), (2,), (3,)], "subject_id long")
    keys = spark.createDataFrame([(2,), (2,), (3,)], "sid long")
    assert sorted(r[0] for r in restrict(ev, keys, "subject_id", "sid").collect()) == [2, 2, 3]
    salted = restrict(ev, keys, "subject_id", "sid", salt=4)
    assert sorted(r[0] for r in salted.collect()) == [2, 2, 3] and salted.columns == ev.columns


def _windowed(spark, rows):
    """rows: (stay, tw_1hr, itemcat, valuenum) -> a minimal windowed table."""
    data = [(s, tw, cat, v, float((tw - 1) // 24 + 1)) for s, tw, cat, v in rows]
    return spark.createDataFrame(
        data, "icustay_id long, tw_1hr double, itemcat string, valuenum double, tw_24hr double")


def test_window_mean_excludes_zero(spark):
    w = _windowed(spark, [(1, 1.0, "HR", 0.0), (1, 1.0, "HR", 10.0), (1, 1.0, "HR", 20.0),
                          (1, 2.0, "HR", 0.0)])
    pv = agg.pivot_features(w, 1).collect()
    assert [(r.tw_hour_idx, r.hr) for r in pv] == [(1.0, 15.0)]


def test_daily_lookup_day_index(spark):
    def days(w, mode, vals):
        d = spark.createDataFrame([(float(v),) for v in vals], "tw double")
        col = agg.day_of_window(F.col("tw"), w, mode)
        return None if col is None else [r[0] for r in d.select(col).collect()]
    assert days(1, "as_written", [23, 24]) == [1.0, 2.0]
    assert days(6, "as_written", [3, 4]) == [1.0, 2.0]
    assert days(12, "as_written", [1, 2]) == [1.0, 2.0]
    assert days(24, "as_written", [1]) is None
    assert days(1, "aligned", [24, 25]) == [1.0, 2.0]
    assert days(24, "aligned", [1]) == [1.0]


def test_urine_lookup_in_pivot(spark):
    # 2.4 l over day 1 -> a 6-h window reads 2.4 * 6 / 24 = 0.6 (aligned day)
    w = _windowed(spark, [(1, 1.0, "URINE", 1.0), (1, 7.0, "URINE", 1.4)])
    w = w.withColumn("tw_6hr", F.floor((F.col("tw_1hr") - 1) / 6) + 1.0)
    pv = {r.tw_hour_idx: r.urine for r in agg.pivot_features(w, 6, day_index="aligned").collect()}
    assert pv[1.0] == pytest.approx(0.6) and pv[2.0] == pytest.approx(0.6)
    pv = {r.tw_hour_idx: r.urine for r in agg.pivot_features(w, 6).collect()}
    assert pv[1.0] == pytest.approx(0.6) and pv[2.0] == pytest.approx(0.6)
    w24 = w.withColumn("tw_24hr", F.lit(1.0))
    assert agg.pivot_features(w24, 24).collect()[0].urine is None      # Q10


def test_crosstab_golden(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "zz", 9.0)],
                               "k long, cat string, v double")
    got = sorted(tuple(r) for r in agg.crosstab(df, ["k"], "cat", "v", ["a", "b"]).collect())
    assert got == [(1, 1.0, 2.0), (2, None, None)]
    pos = agg.crosstab(df, ["k"], "cat", "v", ["b", "a"], ["first", "second"], positional=True)
    assert sorted(tuple(r) for r in pos.collect())[0] == (1, 1.0, 2.0)


def _pivot(spark, cols: dict, n: int):
    rows = []
    for i in range(n):
        r = {c: None for c in dic.FEATURE_COLUMNS}
        r.update({c: v[i] for c, v in cols.items()})
        rows.append(Row(icustay_id=1, tw_hour_idx=float(i + 1), **r))
    schema = "icustay_id long, tw_hour_idx double, " + \
        ", ".join(f"{c} double" for c in dic.FEATURE_COLUMNS)
    return spark.createDataFrame([tuple(r) for r in rows], schema)


def test_locf_default_golden(spark):
    pv = _pivot(spark, {"hr": [None, 90.0, None, 95.0], "urine": [None, 0.2, None, None],
                        "norepinephrine": [None, 0.1, None, None]}, 4)
    out = impute(pv).orderBy("tw_hour_idx").collect()
    assert [r.hr for r in out] == [86.0, 90.0, 90.0, 95.0]
    assert [r.urine for r in out] == [0.0, 0.2, 0.2, 0.2]
    assert [r.norepinephrine for r in out] == [None, 0.1, None, None]
    m = mask(pv).orderBy("tw_hour_idx").collect()
    assert [r.hr for r in m] == [0, 1, 0, 1]


def test_as_written_spec_fills_infusions_from_creatinine(spark):
    pv = _pivot(spark, {"creatinine": [None, 2.0], "pao2": [80.0, None]}, 2)
    out = impute(pv, dic.as_written_spec()).orderBy("tw_hour_idx").collect()
    assert [r.dobutamine for r in out] == [4.0, 2.0]
    assert [r.paco2 for r in out] == [80.0, 80.0]


def test_exact_percentile_matches_numpy(spark):
    import numpy as np
    rnd = np.random.default_rng(5)
    hot = rnd.normal(10, 3, 20000).round(2)              # one hot group, many duplicates
    rows = [("hot", float(v)) for v in hot] + [("odd", float(v)) for v in [3.0, 1.0, 2.0]] + \
           [("even", float(v)) for v in [4.0, 1.0, 3.0, 2.0]] + [("one", 7.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.median_value
           for r in agg.exact_percentile(df, ["g"], "v", accuracy=100).collect()}
    assert got["hot"] == pytest.approx(float(np.median(hot)))
    assert got["odd"] == 2.0 and got["even"] == 2.5 and got["one"] == 7.0
    q = {r.g: r.median_value for r in
         agg.exact_percentile(df, ["g"], "v", p=0.9, accuracy=100).collect()}
    assert q["hot"] == pytest.approx(float(np.quantile(hot, 0.9)))


def test_features_one_stay_equals_filtered(spark):
    rows = [(s, float(tw), cat, float(v)) for s in (1, 2) for tw, cat, v in
            [(1, "HR", 80 + s), (2, "PaO2", 90), (3, "FiO2", 50), (3, "HR", 100), (5, "URINE", 0.1)]]
    w = _windowed(spark, rows)
    a = sorted(tuple(r) for r in fx.features(w, 1).where("icustay_id = 2").collect())
    b = sorted(tuple(r) for r in fx.features(w, 1, stay_id=2).collect())
    assert a == b and len(a) == 4
    assert len(fx.features(w, 1).columns) == 51


def test_join_parts_equals_assemble(spark):
    rows = [(s, float(tw), cat, float(v)) for s in (1, 2) for tw, cat, v in
            [(1, "HR", 80 + s), (2, "PaO2", 90), (3, "FiO2", 50), (3, "HR", 100), (5, "URINE", 0.1)]]
    w = _windowed(spark, rows)
    joined = fx.join_parts(fx.imputed(w, 1), fx.masks(w, 1), fx.scores(w, 1))
    assert sorted(tuple(r) for r in joined.collect()) == \
        sorted(tuple(r) for r in fx.features(w, 1).collect())
    assert joined.columns == fx.features(w, 1).columns


def _defaults_row(spark, dictionary):
    from wardflow.operators.impute import attach_defaults
    df, sql = attach_defaults(spark.range(1), dictionary)
    return df.selectExpr(*[f"{e} AS `{n}`" for n, e in sql.items()]).first()


def test_defaults_from_dataframe(spark):
    d = dic.feature_dictionary(spark)
    from wardflow.operators.impute import literal_defaults
    got = _defaults_row(spark, d).asDict()
    assert got["hr"] == 86.0
    fixed = spark.range(1).selectExpr(*[f"{e} AS `{n}`" for n, e in literal_defaults().items()]).first().asDict()
    assert got == {k: fixed[k] for k in got}
    # a dictionary of any size, and one with two medians for a category
    big = d.unionByName(spark.range(10_001).select(
        F.lit(0).alias("item_idx"), F.concat(F.lit("other"), "id").alias("item_cat"), F.lit(1.0).alias("median_value"),
        F.lit(1.0).alias("mean_value"), F.lit("u").alias("item_unit")).select(d.columns))
    assert _defaults_row(spark, big).asDict() == got
    bad = d.unionByName(d.where("item_cat = 'HR'").withColumn("median_value", F.lit(1.0)))
    with pytest.raises(Exception, match="more than one median"):
        _defaults_row(spark, bad)


def test_exact_percentile_null_groups(spark):
    rows = [("a", 1.0), ("a", 4.0), (None, 5.0), (None, 7.0), ("n", None), (None, None)]
    df = spark.createDataFrame(rows, "g string, v double")
    assert dict(agg.exact_percentile(df, ["g"], "v").collect()) == {"a": 2.5, None: 6.0}
    assert {tuple(r) for r in agg.dictionary_stats(df, "g", "v").collect()} == {
        ("a", 2.5, 2.5, 2), (None, 6.0, 6.0, 2)}


def test_interval_join_candidates_stay_near_linear(spark):
    """A hot key with many consecutive spans: an event meets the spans of its
    bucket only, not its key's whole history."""
    n = 400
    ev = spark.range(n * 5).select(F.lit(1).alias("k"), F.expr("timestamp_ntz'2020-01-01' + make_interval(0,0,0,0,0,0,id * 17280)")
                                   .alias("charttime"), F.col("id"))
    spans = spark.range(n).select(F.lit(1).alias("k"), F.expr("timestamp_ntz'2020-01-01' + make_interval(0,0,0,id)").alias("intime"),
                                  F.expr("timestamp_ntz'2020-01-01' + make_interval(0,0,0,id) + interval 1 day").alias("outtime"))
    j = interval_join(ev, spans, "k", bucket_seconds=86400)
    assert j.count() >= n * 5
    # candidates: equal keys and buckets
    day = F.floor(F.unix_micros(F.col("charttime").cast("timestamp")) / 86_400_000_000)
    first, last = (F.floor((F.unix_micros(F.col(c).cast("timestamp")) + s * 3_600_000_000) / 86_400_000_000)
                   for c, s in (("intime", -1), ("outtime", 1)))
    a = ev.select("id", day.alias("b"))
    b = spans.select(F.explode(F.sequence(first, last)).alias("b"))
    assert a.join(b, "b").count() <= 4 * n * 5


def test_exact_percentile_continuous_hot_group(spark):
    import numpy as np
    vals = np.random.default_rng(9).lognormal(0, 1, 50000)
    df = spark.createDataFrame([("a", float(v)) for v in vals] + [("b", 1.0), ("b", 3.0)],
                               "g string, v double")
    for p in (0.1, 0.5, 0.99):
        got = {r.g: r.median_value for r in
               agg.exact_percentile(df, ["g"], "v", p=p, accuracy=200).collect()}
        assert got["a"] == pytest.approx(float(np.quantile(vals, p)), rel=1e-12)
        assert got["b"] == pytest.approx(1.0 + 2.0 * p)


def test_load_clinical_round_trip(spark):
    """The derived clinical tables written as parquet and read back through
    the declared schemas give the same long rows."""
    import os
    from wardflow.session import checkpoint_dir
    from wardflow.sources import analogues as an
    from wardflow.sources.tables import load_clinical
    import uuid
    t = an.clinical_tables(spark, "/root/testdata/sf0.001")
    base = os.path.join(checkpoint_dir(spark), "tests", uuid.uuid4().hex)
    for name, df in t.items():
        df.write.parquet(os.path.join(base, f"{name}.parquet"))
    loaded = load_clinical(spark, base, fill_missing=True)
    _, a = fx.long_features(**t)
    _, b = fx.long_features(**loaded)
    ra = sorted(repr(tuple(r)) for r in a.collect())
    rb = sorted(repr(tuple(r)) for r in b.collect())
    assert ra == rb and len(ra) > 0
    assert loaded["inputevents_mv"].schema == schemas.INPUTEVENTS_MV
