"""Golden cases for column functions (FIXTURES §4)."""

import math

import pytest

from conftest import ts
from wardflow.functions import arrays, steps, timecols, units


def _one(spark, rows, schema, expr):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr).collect()]


def test_windows_golden(spark):
    start = ts("2100-01-01 10:20:00")
    cases = [  # charttime, tw1, tw3, tw6, tw24, hour_diff
        ("2100-01-01 10:20:00", 1, 1, 1, 1, 20 / 60),
        ("2100-01-01 11:19:59", 1, 1, 1, 1, 4799 / 3600),
        ("2100-01-01 11:20:00", 2, 1, 1, 1, 80 / 60),
        ("2100-01-01 13:20:00", 4, 2, 1, 1, 200 / 60),
        ("2100-01-01 09:40:00", 1, 1, 1, 1, -20 / 60),
        ("2100-01-01 09:20:00", 2, 1, 1, 1, -40 / 60),
        ("2100-01-02 10:20:00", 25, 9, 5, 2, 24 + 20 / 60),
    ]
    df = spark.createDataFrame([(ts(c[0]), start) for c in cases],
                               "charttime timestamp_ntz, intime timestamp_ntz")
    out = timecols.add_windows(df).collect()
    for r, c in zip(out, cases):
        assert (r.tw_1hr, r.tw_3hr, r.tw_6hr, r.tw_24hr) == c[1:5]
        assert r.hour_diff == pytest.approx(c[5], abs=1e-12)


def test_window_size_validated():
    with pytest.raises(ValueError):
        timecols.window_column(2)


def test_fio2_golden(spark):
    vals = [45, 20, 100, 0.4, 0.2, 1, 1.5, 15, 101]
    want = [45, 20, 100, 40, 20, 100, None, None, None]
    got = _one(spark, [(float(v),) for v in vals], "v double", units.normalize_fio2("v"))
    assert [None if g is None else pytest.approx(g) for g in got] == \
           [None if w is None else pytest.approx(w) for w in want]


def test_temp_golden(spark):
    vals = [37, 20, 50, 98.6, 68, 122, 60, 130]
    want = [37, 20, 50, 37, 20, 50, None, None]
    got = _one(spark, [(float(v),) for v in vals], "v double", units.normalize_temp("v"))
    for g, w in zip(got, want):
        assert (g is None and w is None) or abs(g - w) < 1e-9


def test_urine_and_plausible(spark):
    df = spark.createDataFrame([(250.0,), (10000.0,), (10001.0,), (-1.0,), (None,)], "v double")
    kept = df.where(units.plausible("v", 0, 10000)).select(units.ml_to_l("v")).collect()
    assert [r[0] for r in kept] == [0.25, 10.0]


def test_value_text(spark):
    got = _one(spark, [(12.0,), (0.5,), (37.7777,), (None,)], "v double", units.value_text("v"))
    assert got == ["12", "0.5", "37.778", None]


def _score(spark, expr, rows, schema):
    return _one(spark, rows, schema, expr)


CV_SCHEMA = "abp_mean double, dopamine double, dobutamine double, epinephrine double, " \
            "norepinephrine double"


def test_cardiovascular_golden(spark):
    n = None
    rows = [(70.0, n, n, n, n), (60.0, n, n, n, n), (80.0, 4.0, n, n, n), (80.0, n, 3.0, n, n),
            (80.0, 10.0, n, n, n), (80.0, n, n, n, 0.05), (80.0, n, n, n, 0.2),
            (80.0, 16.0, n, n, n), (80.0, n, 3.0, n, 0.2), (n, n, n, n, n)]
    assert _score(spark, steps.cardiovascular_points(), rows, CV_SCHEMA) == \
        [0, 1, 2, 2, 3, 3, 4, 4, 2, 0]


def test_step_goldens(spark):
    def run(fn, vals):
        return _score(spark, fn("v"), [(None if v is None else float(v),) for v in vals],
                      "v double")
    assert run(steps.creatinine_points, [1.19, 1.2, 1.9, 3.4, 4.9, 5]) == [0, 1, 1, 2, 3, 4]
    assert run(steps.gcs_points, [5.9, 6, 9, 12, 14, 14.5, 15, 16]) == \
        [4, 3, 3, 2, 1, None, 0, None]
    assert run(steps.bilirubin_points, [1.2, 1.9, 5.9, 11.9, 12]) == [0, 1, 2, 3, 4]
    assert run(steps.platelets_points, [19, 20, 50, 100, 150]) == [4, 3, 2, 1, 0]
    assert run(lambda c: steps.urine_points(c, 24), [0.19, 0.2, 0.49, 0.5]) == [4, 3, 3, 0]
    assert run(lambda c: steps.urine_points(c, 1), [0.005, 0.01, 0.03]) == [4, 3, 0]


def test_respiration_golden(spark):
    rows = [(90.0, 50.0), (100.0, 100.0), (99.0, 100.0), (400.0, 100.0), (None, 50.0)]
    assert _score(spark, steps.respiration_points(), rows, "pao2 double, fio2 double") == \
        [3, 3, 4, 0, None]


def test_total_is_null_if_any_part_null(spark):
    cols = ["abp_mean", "dopamine", "dobutamine", "epinephrine", "norepinephrine", "pao2",
            "fio2", "creatinine", "gcs", "bilirubin", "platelets", "urine"]
    schema = ", ".join(f"{c} double" for c in cols)
    ok = (80.0, None, None, None, None, 400.0, 100.0, 1.0, 15.0, 1.0, 200.0, 1.0)
    bad = ok[:8] + (14.5,) + ok[9:]
    assert _score(spark, steps.total_score(24), [ok, bad], schema) == [0, None]


def test_pad_golden(spark):
    df = spark.createDataFrame([([1, 2, 3, 4, 5],), ([1],), ([],)], "s array<int>")
    got = [r[0] for r in df.select(arrays.pad("s", 3)).collect()]
    assert got == [[3, 4, 5], [0, 0, 1], [0, 0, 0]]


def test_delta_pairs_golden(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0],)], "s array<double>")
    r = df.select(arrays.delta_pairs("s").alias("p")).collect()[0].p
    assert [(x.first, x.second) for x in r] == [(1.0, 2.0), (3.0, 4.0)]
    odd = spark.createDataFrame([([1.0, 2.0, 3.0],)], "s array<double>")
    with pytest.raises(Exception):
        odd.select(arrays.delta_pairs("s")).collect()


def test_softmax_sums_to_one(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 1000.0],)], "s array<double>")
    a = df.select(arrays.softmax("s")).collect()[0][0]
    assert math.isclose(sum(a), 1.0) and a[-1] == pytest.approx(1.0)


def test_cluster_conf_sizes_follow_the_data():
    from wardflow.session import cluster_conf
    tb = 1024 ** 4
    big = cluster_conf(100 * tb, 8000)
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 512 * 1024 ** 2
    assert int(big["spark.sql.shuffle.partitions"]) >= 50_000
    assert int(big["spark.sql.autoBroadcastJoinThreshold"]) <= 64 * 1024 ** 2
    small = cluster_conf(10 * 1024 ** 3, 64)
    assert int(small["spark.sql.shuffle.partitions"]) == 128
    assert int(small["spark.sql.files.maxPartitionBytes"]) < 512 * 1024 ** 2
