"""Forms that hold for far-future spans, hot stays, large tables and late files."""

import datetime as dt
import os
import random
import uuid

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardflow.functions import bloom, lookup
from wardflow.operators import impute, intervals, vocab
from wardflow.operators.intervals import interval_join
from wardflow.plans import features as fx
from wardflow.session import checkpoint_dir
from wardflow.sources import analogues as an
from wardflow.streaming import incremental

SF = "/root/testdata/sf0.001"


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


# -- interval join ------------------------------------------------------------

def test_spans_of_any_length_against_brute_force(spark):
    rnd = random.Random(3)
    t0 = dt.datetime(2020, 1, 1)
    lengths = [0, 1, 3600, 86400, 7 * 86400, 7 * 86400 - 7200, 112 * 86400, 30 * 365 * 86400, 100 * 365 * 86400, 7900 * 365 * 86400]
    spans = [(i, i % 3 or None, t0 + dt.timedelta(seconds=rnd.randrange(10 ** 8)), rnd.choice(lengths)) for i in range(80)]
    spans = [(i, k, s, s + dt.timedelta(seconds=n)) for i, k, s, n in spans] + [(900, 1, None, t0), (901, 1, t0, t0 - dt.timedelta(days=1))]
    events = [(i, rnd.choice([0, 1, 2, None]), t0 + dt.timedelta(seconds=rnd.randrange(2 * 10 ** 8))) for i in range(400)]
    events += [(1000 + i, k, s - dt.timedelta(hours=1)) for i, k, s, _ in spans if s] + [(5000, 1, None)]
    hour = dt.timedelta(hours=1)
    want = sorted((e, i) for e, k, t in events for i, sk, s, end in spans
                  if k is not None and k == sk and t and s and s <= end and s - hour <= t <= end + hour)
    ev = spark.createDataFrame(events, "id long, k int, charttime timestamp_ntz")
    sp = spark.createDataFrame(spans, "span long, k int, intime timestamp_ntz, outtime timestamp_ntz")
    for salt in (1, 4):
        got = interval_join(ev, sp, "k", span_columns=["span"], salt=salt).select("id", "span").collect()
        assert sorted(map(tuple, got)) == want


def test_a_long_span_lies_in_two_buckets_at_most(spark):
    year = 365 * 86400 * 10 ** 6
    width = intervals.BUCKET_SECONDS * 10 ** 6
    rows = [(s, s + n) for s in range(-40 * year, 40 * year, 7 * year) for n in (0, width, width + 1, year, 100 * year, 9000 * year)]
    df = spark.createDataFrame(rows, "lo long, hi long")
    level = intervals.span_level(F.col("hi") - F.col("lo"), width)
    n = intervals._bucket(F.col("hi"), width, level) - intervals._bucket(F.col("lo"), width, level) + 1
    assert {r.n for r in df.select(n.alias("n")).collect()} <= {1, 2}


def test_few_spans_a_key_need_no_buckets(spark):
    t0 = dt.datetime(2020, 1, 1)
    day = dt.timedelta(days=1)
    ev = spark.createDataFrame([(i, i % 5 or None, t0 + i * day) for i in range(100)], "id int, k int, charttime timestamp_ntz")
    rows = [(i, i % 6 or None, t0 + i * 9 * day, t0 + i * 9 * day + (i % 4) * 20 * day) for i in range(40)]
    cols = "span int, k int, intime timestamp_ntz, outtime timestamp_ntz"
    hot = rows + [(100 + i, 1, t0 + i * day, t0 + i * day) for i in range(intervals.FEW_SPANS)]
    for spans, few in ((rows, True), (hot, False)):
        out = interval_join(ev, spark.createDataFrame(spans, cols), "k", span_columns=["span"], by_key=True)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert ("__bucket" not in plan and "Generate" not in plan) == few
        want = sorted((i, s) for i in range(100) for s, k, a, b in spans if k and k == (i % 5 or None)
                      and a - dt.timedelta(hours=1) <= t0 + i * day <= b + dt.timedelta(hours=1))
        assert sorted(map(tuple, out.select("id", "span").collect())) == want and want


def _moved(spark, query):
    """Shuffles (first uses) of a query where nothing is broadcast."""
    from wardflow.plans import catalogue
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        plan = catalogue.QUERIES[query](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return [line for line in plan.split("\n") if "Exchange hashpartitioning(" in line and "Reused" not in line]


def test_the_lab_view_moves_a_lab_row_once(spark):
    moved = _moved(spark, "view_adult_labevents")
    assert len(moved) == 3  # lineitem, orders, stays
    assert not any("bucket" in m for m in moved)


def test_no_log_is_moved_to_the_admissions(spark):
    """A log lies by its admission already: its rows go to the subjects' join
    only, the chart log's as rows of its branches."""
    moved = _moved(spark, "long_union")
    assert not any("bucket" in m for m in moved)
    # one shuffle each: lineitem and orders for six scans; the cohort's subjects, admissions and stays;
    # the rows of four logs on their way to the subjects
    assert sum("subject_id" in m for m in moved) <= 8, moved


def test_no_spans_and_no_events(spark):
    ev = spark.createDataFrame([(1, dt.datetime(2020, 1, 1))], "k int, charttime timestamp_ntz")
    sp = spark.createDataFrame([(1, dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2))], "k int, intime timestamp_ntz, outtime timestamp_ntz")
    assert interval_join(ev, sp.limit(0), "k").isEmpty() and interval_join(ev.limit(0), sp, "k").isEmpty()
    assert interval_join(ev, sp, "k").count() == 1


# -- lookup and encode --------------------------------------------------------

def test_lookup_of_every_element(spark):
    table = spark.createDataFrame([(f"w{i}", i) for i in range(3000)] + [(None, 7)], "token string, id int")
    rows = [(1, [f"w{i}" for i in range(0, 4000, 3)]), (2, []), (3, None), (4, ["w5", None, "x", "w5"])]
    df = spark.createDataFrame(rows, "k int, ts array<string>")
    for slots in (64, 1 << 12):  # full and nearly empty slots
        got = {r.k: r["ids"] for r in lookup.with_values(df, "ts", "ids", table, "token", "id", F.lit(-1), slots).collect()}
        assert got == {k: ts and [int(t[1:]) if t and t[0] == "w" and int(t[1:]) < 3000 else -1 for t in ts] for k, ts in rows}
    with pytest.raises(Exception, match="at most 100 entries"):
        lookup.hash_table(table, "token", "id", 64, max_entries=100).collect()


def test_encode_moves_no_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(-1, None), (-2, ""), (-3, " -- ")], docs.schema))
    words = vocab.build_vocab(docs, 500)
    out = vocab.encode(docs, words)
    by_join = vocab.encode_by_join(docs, words)
    assert sorted(map(str, out.collect())) == sorted(map(str, by_join.collect()))
    main = _plan(vocab.encode(docs, spark.createDataFrame(words.collect()))).split("Subquery")[0]
    assert "Exchange" not in main and "Join" not in main and "Generate" not in main
    assert {r.doc_id: r.ids for r in out.where("doc_id < 0").collect()} == {-1: [1], -2: [1], -3: [1]}


# -- LOCF in blocks -----------------------------------------------------------

def test_locf_in_blocks_is_locf(spark):
    rnd = random.Random(9)
    # stay 1 holds most windows; one stay's id is NULL; windows start below zero
    rows = [(1, t, rnd.choice([None, None, None, float(t)]), rnd.choice([None, "x", "y"])) for t in range(-300, 3000)]
    rows += [(s, t * 7, rnd.choice([None, 1.5]), None) for s in (2, 3, None) for t in range(40)]
    df = spark.createDataFrame(rows, "icustay_id long, tw_hour_idx long, a double, b string")
    w = W.partitionBy("icustay_id").orderBy("tw_hour_idx").rowsBetween(W.unboundedPreceding, W.currentRow)
    want = df.select("*", *[F.last(c, ignorenulls=True).over(w).alias(f"__locf_{c}") for c in "ab"])
    for block in (1, 7, 256, 10 ** 6):
        got = impute.with_locf(df, ["a", "b"], block=block)
        assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert impute.with_locf(df.limit(0), ["a"]).isEmpty()


def test_features_in_blocks_with_a_hot_stay(spark):
    """A stay with over a third of the rows: same features, and no window or
    join key of the plan holds more than a block's rows of it."""
    win = an.events_windowed(spark, SF)
    hot = win.withColumn("icustay_id", F.when(F.col("icustay_id") % 2 == 0, 0).otherwise(F.col("icustay_id"))
                         .cast(win.schema["icustay_id"].dataType))
    share = hot.agg(F.avg((F.col("icustay_id") == 0).cast("int")).alias("s")).first().s
    assert share > 1 / 3
    one = lambda df: sorted(map(str, df.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c)
                                                 for c, t in df.dtypes]).collect()))
    assert one(fx.features(hot, 6, block=16)) == one(fx.features(hot, 6))
    plan = _plan(fx.features(hot, 6, block=16))
    assert "windowspecdefinition(icustay_id" in plan and "__block" in plan


# -- maintained relations -----------------------------------------------------

def _rows(df):
    return sorted(str([round(x, 9) if isinstance(x, float) else x for x in r]) for r in df.collect())


def test_maintained_relations_equal_the_batch_build(spark):
    from wardflow.operators.aggregate import daily_total, window_means
    win = an.events_windowed(spark, SF).persist()
    name = uuid.uuid4().hex
    means, daily = incremental.WindowMeans(spark, f"m{name}", 6), incremental.DailyTotals(spark, f"d{name}")
    with pytest.raises(ValueError, match="no batch"):
        means.read()
    part = F.pmod(F.xxhash64("event_id"), F.lit(5))
    for rel in (means, daily):
        for i in range(5):
            assert rel.upsert(win.where(part == i), i)
            assert not rel.upsert(win.where(part == i), i)  # sent again
            if i in (1, 2, 4):
                rel.compact()
                rel.compact()
        assert not rel.upsert(win.where(part == 0), 0)  # a batch that is in the base
        assert rel.upsert(win.limit(0), 5)  # nothing new
    assert _rows(means.means()) == _rows(window_means(win, 6))
    assert _rows(daily.totals()) == _rows(daily_total(win))
    # an abandoned write is not counted
    win.limit(3).write.parquet(os.path.join(means.folder, "staged", "left-behind"))
    assert _rows(means.means()) == _rows(window_means(win, 6))


def test_a_stream_of_late_files(spark):
    from wardflow.operators.aggregate import window_means
    win = an.events_windowed(spark, SF)
    landing = os.path.join(checkpoint_dir(spark), f"landing-{uuid.uuid4().hex}")
    means = incremental.WindowMeans(spark, f"s{uuid.uuid4().hex}", 24)
    for late in (False, True):  # the older half lands last
        win.where((F.col("tw_24hr") < 3) == late).coalesce(2).write.mode("append").parquet(landing)
        q = means.start(spark.readStream.schema(win.schema).parquet(landing))
        q.awaitTermination(300)
        assert q.exception() is None
    assert _rows(means.means()) == _rows(window_means(win, 24))


# -- Bloom filters ------------------------------------------------------------

def test_bloom_filter_loses_nothing_and_lets_few_through(spark):
    from wardflow.operators.cohort import restrict
    keys = spark.range(0, 20_000, 2).select(F.col("id").alias("k"), F.lit("x").alias("part")).union(
        spark.createDataFrame([(None, "x")], "k long, part string"))
    rows = spark.range(40_000).select("id", F.col("id").alias("k"), F.lit("x").alias("part")).union(
        spark.createDataFrame([(-1, None, "x")], "id long, k long, part string"))
    want = {r.id for r in restrict(rows, keys, ["k", "part"]).collect()}
    assert len(want) == 10_000
    for bits in (64, 1 << 14, 1 << 17):  # far too small, too small, ten bits a key and more
        got = restrict(rows, keys, ["k", "part"], bloom_bits=bits)
        assert {r.id for r in got.collect()} == want
    # of the 30,000 other rows those that pass: (1 - exp(-4 n / m)) ** 4 is 0.5 % here
    passed = bloom.maybe_in(rows, keys, ["k", "part"], 1 << 17).count() - len(want)
    assert 0 < passed < 0.01 * 30_000
    assert bloom.maybe_in(rows, keys.limit(0), ["k", "part"], 1 << 10).isEmpty()
    with pytest.raises(ValueError, match="multiple of 64"):
        bloom.bloom_table(keys, ["k"], 100)


def test_bloom_filter_runs_in_the_scan_stage(spark):
    from wardflow.operators.cohort import restrict
    keys = spark.createDataFrame([(i,) for i in range(5)], "user_id long")
    ev = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "user_id")
    out = restrict(ev, keys, "user_id", bloom_bits=1 << 12)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftSemi") < plan.index("forall(") < plan.index("Relation")
    assert sorted(map(str, out.select(ev.columns).collect())) == sorted(map(str, ev.join(keys, "user_id", "left_semi").select(ev.columns).collect()))
