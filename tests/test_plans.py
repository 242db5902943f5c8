"""Plan-shape checks: the plans we claim in the README are the plans Spark runs."""

import re

import pytest

from oracle_check import digest
from wardflow.plans import catalogue, features as fx
from wardflow.sources import analogues as an

SF = "/root/testdata/sf0.001"

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_reads_events_once_plus_spans(spark):
    df = catalogue.QUERIES["features_50_w1"](spark, SF)
    plan = _plan(df)
    scans = set(re.findall(r"FileScan parquet \[([^\]]*)\]", plan))
    assert len(scans) == 3                       # the rows, and (ts, user_id) for the spans and their levels
    assert sum("props" in s for s in scans) == 1
    assert "SortMergeJoin" not in plan           # small stays side is broadcast here
    # exchanges: spans partial agg (as often as the spans), the pivot partial agg, the stay partitioning
    assert len(set(re.findall(r"Exchange hashpartitioning\([^)]*\)", plan))) == 4
    df.collect()
    assert "ReusedExchange" in _plan(df)         # the spans and their levels are one scan when run


def _formatted(df) -> str:
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_pruning_and_pushdown_reach_the_scan(spark):
    plan = _formatted(catalogue.QUERIES["restrict_admission"](spark, SF))
    # only the three projected lineitem columns are read, the key filter is pushed
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>" in plan
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in plan
    plan = _formatted(catalogue.QUERIES["code_map"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,props:string>" in plan


def test_bucketed_table_needs_no_exchange(spark):
    from wardflow.sources.materialize import materialize
    win = materialize(an.events_windowed(spark, SF), "test_bucketed_windowed",
                      bucket_by="icustay_id", buckets=4)
    plan = _final_plan(fx.features(win, 6))
    assert "Exchange" not in plan


@pytest.mark.parametrize("name", ["features_50_w1", "cohort_filter", "restrict_subject",
                                  "interval_join_one_key", "interval_join_two_keys", "encode"])
def test_same_results_without_broadcast(spark, name):
    base = catalogue.QUERIES[name](spark, SF)
    want = digest(base.columns, [tuple(r) for r in base.collect()])[0]
    old = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    try:
        for k, v in NO_BROADCAST.items():
            spark.conf.set(k, v)
        df = catalogue.QUERIES[name](spark, SF)
        if name != "encode":                     # encode's vocabulary broadcast is a hint
            assert "BroadcastHashJoin" not in _final_plan(df) or name == "features_50_w1"
        got = digest(df.columns, [tuple(r) for r in df.collect()])[0]
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert got == want


def test_sql_table_function_one_stay(spark):
    from wardflow.plans import sql as sqlsurface
    win = an.events_windowed(spark, SF)
    sqlsurface.register(spark, win)
    stay = win.select("icustay_id").first()[0]
    got = sorted(tuple(r) for r in spark.sql(f"SELECT * FROM get_features({stay}, 6)").collect())
    want = sorted(tuple(r) for r in fx.features(win, 6, stay_id=stay).collect())
    assert got == want and len(got) > 0
    # the stay filter reaches the scan side of the plan (pushed below the pivot)
    plan = _formatted(spark.sql(f"SELECT * FROM get_features({stay}, 6)"))
    assert f"(user_id#" in plan and f"= {stay})" in plan


def test_long_union_scans_each_log_once(spark):
    """The derived logs all come from lineitem: one scan per log, two for the
    chart log (narrow rows and GCS rows, by disjoint code filters)."""
    df = catalogue.QUERIES["long_union"](spark, SF)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_orderkey#") > 0
    scans = [line for line in plan.split("\n") if "Relation [l_orderkey" in line]
    assert len(scans) == 6


def test_one_stay_filter_reaches_the_scan(spark):
    df = catalogue.QUERIES["features_50_w6_one_stay"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(user_id,7)" in plan


def test_materialize_keeps_two_versions(spark):
    import os
    from wardflow.sources.materialize import materialize, table_path
    for i in range(4):
        df = materialize(spark.range(i + 1), "versions_test")
    assert df.count() == 4 and len(os.listdir(table_path(spark, "versions_test"))) == 2
