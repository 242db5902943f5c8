"""The query catalogue: one Spark query per operator group of the survey's
inventory, each over the driver's tables, plus its DuckDB oracle SQL.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> str``.
Doubles are rounded to 6 places in the final projection only (summation
order differs between engines); the library functions themselves never
round.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.plans import oracle as O
from wardflow.plans import features as fx
from wardflow.plans import views
from wardflow.session import ensure_conf
from wardflow.sources import analogues as an
from wardflow.sources import dictionary as dic

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_conf(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run
    return deco


def round6(c):
    """Snap to 9 places (absorbs summation-order noise below 5e-10 at decimal
    ties), then round half away from zero to 6 places; the oracle SQL does
    the same IEEE operations (``oracle.R``)."""
    snapped = F.round(c * F.lit(1e9), 0) / F.lit(1e3)
    return F.round(snapped, 0) / F.lit(1e6)


def rounded(df: DataFrame) -> DataFrame:
    """Round every double column (final projection only; one SQL projection,
    same operations as ``round6``)."""
    return df.selectExpr(*[
        f"round(round(`{f.name}` * 1e9, 0) / 1e3, 0) / 1e6 AS `{f.name}`"
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else f"`{f.name}`"
        for f in df.schema.fields])


# ---------------------------------------------------------------------------
# events feature chain
# ---------------------------------------------------------------------------

def _windowed(spark, sf_dir):
    return an.events_windowed(spark, sf_dir)


def _features_sql(w: int, day_index: str = "as_written") -> str:
    body = O.with_(O.events_windowed_ctes(), O.pivot_ctes(w, day_index), O.imputed_cte(),
                   O.score_cte(w))
    return (body + f"\nSELECT icustay_id, tw_hour_idx, {O.total_expr()}, "
            + O.r6(dic.FEATURE_COLUMNS) + ", "
            + ", ".join(f"m_{c}" for c in dic.FEATURE_COLUMNS) + " FROM sc")


def _features_query(w: int, day_index: str = "as_written"):
    def q(spark, sf_dir):
        return rounded(fx.features(_windowed(spark, sf_dir), w, day_index=day_index))
    return q


for _w in (1, 6, 24):
    register(f"features_50_w{_w}", _features_sql(_w))(_features_query(_w))
register("features_50_w1_aligned", _features_sql(1, "aligned"))(_features_query(1, "aligned"))


@register("features_50_w1_as_written",
          O.with_(O.events_windowed_ctes(), O.pivot_ctes(1, binding=dic.positional_binding()),
                  O.imputed_cte(dic.as_written_spec()), O.score_cte(1))
          + f"\nSELECT icustay_id, tw_hour_idx, {O.total_expr()}, " + O.r6(dic.FEATURE_COLUMNS)
          + ", " + ", ".join(f"m_{c}" for c in dic.FEATURE_COLUMNS) + " FROM sc")
def features_50_w1_as_written(spark, sf_dir):
    """U5 on the event log with the reference text's positional column
    binding (Q1, byte order) and literal imputation slots (Q2, Q3); the
    clinical path in en_US order is ``clinical_features_w6_as_written``."""
    return rounded(fx.features(_windowed(spark, sf_dir), 1, spec=dic.as_written_spec(),
                               binding=dic.positional_binding()))


ONE_STAY = 7


@register("features_50_w6_one_stay", _features_sql(6) + f" WHERE icustay_id = {ONE_STAY}")
def features_50_w6_one_stay(spark, sf_dir):
    """B12/U5 for one stay: the SQL table function called with a literal stay
    id; the filter reaches the scan of the event log."""
    from wardflow.plans import sql as sqlsurface
    sqlsurface.register(spark, _windowed(spark, sf_dir))
    return rounded(spark.sql(f"SELECT * FROM get_features({ONE_STAY}, 6)"))


def _pivot_sql(w: int) -> str:
    body = O.with_(O.events_windowed_ctes(), O.pivot_ctes(w))
    return body + "\nSELECT icustay_id, tw_hour_idx, " + O.r6(dic.FEATURE_COLUMNS) + " FROM pv"


def _pivot_query(w: int):
    def q(spark, sf_dir):
        return rounded(fx.pivot(_windowed(spark, sf_dir), w))
    return q


for _w in (1, 3, 6, 12, 24):
    register(f"window_mean_pivot_w{_w}", _pivot_sql(_w))(_pivot_query(_w))


@register("impute_w6", O.with_(O.events_windowed_ctes(), O.pivot_ctes(6), O.imputed_cte())
          + "\nSELECT icustay_id, tw_hour_idx, " + O.r6(dic.FEATURE_COLUMNS) + " FROM imp")
def impute_w6(spark, sf_dir):
    """LOCF then dictionary default."""
    return rounded(fx.imputed(_windowed(spark, sf_dir), 6))


@register("impute_as_written_w6",
          O.with_(O.events_windowed_ctes(), O.pivot_ctes(6), O.imputed_cte(dic.as_written_spec()))
          + "\nSELECT icustay_id, tw_hour_idx, " + O.r6(dic.FEATURE_COLUMNS) + " FROM imp")
def impute_as_written_w6(spark, sf_dir):
    """U2 with the reference's literal slot bindings (Q2, Q3)."""
    return rounded(fx.imputed(_windowed(spark, sf_dir), 6, spec=dic.as_written_spec()))


@register("locf_w1", O.with_(O.events_windowed_ctes(), O.pivot_ctes(1)) + """
SELECT icustay_id, tw_hour_idx,
  """ + O.R("last_value(hr IGNORE NULLS) OVER w") + """ AS hr_locf,
  """ + O.R("last_value(urine IGNORE NULLS) OVER w") + """ AS urine_locf,
  """ + O.R("last_value(gcs IGNORE NULLS) OVER w") + """ AS gcs_locf
FROM pv
WINDOW w AS (PARTITION BY icustay_id ORDER BY tw_hour_idx
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def locf_w1(spark, sf_dir):
    """E1 alone: last observation carried forward, no default."""
    from wardflow.operators.impute import locf
    pv = fx.pivot(_windowed(spark, sf_dir), 1)
    return rounded(pv.select("icustay_id", "tw_hour_idx", locf("hr").alias("hr_locf"),
                             locf("urine").alias("urine_locf"), locf("gcs").alias("gcs_locf")))


@register("locf_w1_blocks", ORACLE["locf_w1"])
def locf_w1_blocks(spark, sf_dir):
    """E1 in blocks of windows, for stays that hold a large share of the rows."""
    from wardflow.operators.impute import with_locf
    cols = ["hr", "urine", "gcs"]
    filled = with_locf(fx.pivot(_windowed(spark, sf_dir), 1, daily_join=True), cols, block=64)
    return rounded(filled.select("icustay_id", "tw_hour_idx", *[F.col(f"__locf_{c}").alias(f"{c}_locf") for c in cols]))


@register("features_50_w1_blocks", _features_sql(1))
def features_50_w1_blocks(spark, sf_dir):
    """U5 without a step that gathers a stay."""
    return rounded(fx.features(_windowed(spark, sf_dir), 1, block=64))


@register("mask_w3", O.with_(O.events_windowed_ctes(), O.pivot_ctes(3)) + "\nSELECT icustay_id, "
          "tw_hour_idx, " + ", ".join(f"CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END AS {c}"
                                      for c in dic.FEATURE_COLUMNS) + " FROM pv")
def mask_w3(spark, sf_dir):
    """U4: missingness mask of the raw pivot."""
    return fx.masks(_windowed(spark, sf_dir), 3)


@register("score_parts_w12", O.with_(O.events_windowed_ctes(), O.pivot_ctes(12), O.imputed_cte(),
                                     O.score_cte(12))
          + "\nSELECT icustay_id, tw_hour_idx, " + O.total_expr() + ", "
          + ", ".join(O.SCORE_PARTS) + " FROM sc")
def score_parts_w12(spark, sf_dir):
    """U3 with every part."""
    return fx.scores(_windowed(spark, sf_dir), 12, with_parts=True)


@register("score_total_w1", O.with_(O.events_windowed_ctes(), O.pivot_ctes(1), O.imputed_cte(),
                                    O.score_cte(1))
          + "\nSELECT icustay_id, tw_hour_idx, " + O.total_expr() + " FROM sc")
def score_total_w1(spark, sf_dir):
    """Total score per window."""
    return fx.scores(_windowed(spark, sf_dir), 1)


@register("daily_total", O.with_(O.events_windowed_ctes(), O.daily_cte())
          + "\nSELECT icustay_id, tw_24hr, " + O.R("urine_output_per_24hrs") + " AS "
            "urine_output_per_24hrs FROM daily")
def daily_total(spark, sf_dir):
    """Daily urine total per stay."""
    return rounded(fx.daily(_windowed(spark, sf_dir)))


def _in_batches(relation, rows):
    """Count rows in three batches, by their ids; the first is sent again, and
    what is there is compacted before the last."""
    part = F.pmod(F.xxhash64("event_id"), F.lit(3))
    for batch, after in ((0, None), (1, None), (0, relation.compact), (2, None)):
        relation.upsert(rows.where(part == batch), batch)
        if after:
            after()
    return relation


@register("maintained_window_means_w6", O.with_(O.events_windowed_ctes()) + """
SELECT icustay_id, tw_6hr AS tw_hour_idx, lower(itemcat) AS category, """ + O.R("avg(valuenum)") + """ AS valuenum
FROM win WHERE valuenum > 0 GROUP BY icustay_id, tw_6hr, lower(itemcat)""")
def maintained_window_means_w6(spark, sf_dir):
    """A3/D3: window means kept up batch by batch from mergeable states."""
    from wardflow.streaming.incremental import WindowMeans
    relation = WindowMeans(spark, f"window_means_{uuid.uuid4().hex}", 6)
    return rounded(_in_batches(relation, _windowed(spark, sf_dir)).means())


@register("maintained_daily_total", ORACLE["daily_total"])
def maintained_daily_total(spark, sf_dir):
    """Daily totals kept up batch by batch from mergeable states."""
    from wardflow.streaming.incremental import DailyTotals
    relation = DailyTotals(spark, f"daily_total_{uuid.uuid4().hex}")
    return rounded(_in_batches(relation, _windowed(spark, sf_dir)).totals())


@register("daily_lookup_w6", O.with_(O.events_windowed_ctes(), O.daily_cte()) + """,
keys AS (SELECT DISTINCT icustay_id, tw_6hr FROM win)
SELECT icustay_id, tw_6hr AS tw_hour_idx,
  """ + O.R("""(SELECT d.urine_output_per_24hrs * 6 / 24 FROM daily d
         WHERE d.icustay_id = keys.icustay_id AND d.tw_24hr = floor(keys.tw_6hr * 6 / 24) + 1)""") + """
    AS daily_urine
FROM keys""")
def daily_lookup_w6(spark, sf_dir):
    """The decorrelated daily lookup for every (stay, window)."""
    from wardflow.operators.aggregate import lookup_daily
    win = _windowed(spark, sf_dir)
    keys = win.select("icustay_id", F.col("tw_6hr").alias("tw_hour_idx")).distinct()
    return rounded(lookup_daily(keys, fx.daily(win), 6, "daily_urine"))


@register("stay_windows", O.with_(O.events_windowed_ctes()) + """
SELECT event_id, icustay_id, """ + O.R("hour_diff") + """ AS hour_diff,
       tw_1hr, tw_3hr, tw_6hr, tw_12hr, tw_24hr
FROM win""")
def stay_windows(spark, sf_dir):
    """E3/E4/E5 + C4: stay-relative windows (with mirrored pre-start rows)."""
    return rounded(_windowed(spark, sf_dir).select(
        "event_id", "icustay_id", "hour_diff", "tw_1hr", "tw_3hr", "tw_6hr", "tw_12hr",
        "tw_24hr"))


@register("code_map", O.with_(O.events_windowed_ctes()) + """
SELECT event_id, itemid, itemcat, lower(itemcat) AS category FROM mapped""")
def code_map(spark, sf_dir):
    """Whitelisted codes mapped to categories by a broadcast join."""
    from wardflow.operators.harmonize import map_codes
    ev = an.event_rows(an.load(spark, sf_dir, "events"))
    m = map_codes(ev, an.analogue_code_map(spark), "itemid", source="events")
    return m.select("event_id", "itemid", "itemcat", F.lower("itemcat").alias("category"))


@register("unit_rules", O.with_(O.events_windowed_ctes()) + """
SELECT event_id, itemcat, """ + O.R("valuenum") + """ AS valuenum FROM lng""")
def unit_rules(spark, sf_dir):
    """Plausibility filters and unit harmonisation per category."""
    ev = an.load(spark, sf_dir, "events")
    return rounded(an.events_long(spark, ev).select("event_id", "itemcat", "valuenum"))


@register("crosstab_positional_w24", O.with_(O.events_windowed_ctes()) + """,
m AS (SELECT icustay_id, tw_24hr AS tw_hour_idx, lower(itemcat) AS cat, avg(valuenum) AS v
      FROM win WHERE valuenum > 0 GROUP BY icustay_id, tw_24hr, itemcat)
SELECT icustay_id, tw_hour_idx, """ + ", ".join(
    O.R(f"max(CASE WHEN cat = '{c}' THEN v END)") + f" AS {n}"
    for c, n in dic.positional_binding()) + " FROM m GROUP BY icustay_id, tw_hour_idx")
def crosstab_positional_w24(spark, sf_dir):
    """D6 with crosstab's positional binding (Q1): categories in ORDER BY
    item_cat fill the declared output columns in order."""
    from wardflow.operators.aggregate import crosstab, window_means
    means = window_means(_windowed(spark, sf_dir), 24)
    names = [r[1] for r in dic.FEATURE_ROWS]
    return rounded(crosstab(means, ["icustay_id", "tw_hour_idx"], "category", "valuenum",
                            names, dic.FEATURE_COLUMNS, positional=True, key=str.lower))


@register("crosstab_by_name_w24", O.with_(O.events_windowed_ctes()) + """,
m AS (SELECT icustay_id, tw_24hr AS tw_hour_idx, lower(itemcat) AS cat, avg(valuenum) AS v
      FROM win WHERE valuenum > 0 GROUP BY icustay_id, tw_24hr, itemcat)
SELECT icustay_id, tw_hour_idx, """ + ", ".join(
    O.R(f"max(CASE WHEN cat = '{c}' THEN v END)") + f" AS {c}" for c in dic.FEATURE_COLUMNS)
          + " FROM m GROUP BY icustay_id, tw_hour_idx")
def crosstab_by_name_w24(spark, sf_dir):
    """D6 bound by name (the corrected default)."""
    from wardflow.operators.aggregate import crosstab, window_means
    means = window_means(_windowed(spark, sf_dir), 24)
    return rounded(crosstab(means, ["icustay_id", "tw_hour_idx"], "category", "valuenum",
                            dic.FEATURE_COLUMNS))


# ---------------------------------------------------------------------------
# cohort, semi joins, interval joins
# ---------------------------------------------------------------------------

def _cohort(spark, sf_dir):
    from wardflow.operators.cohort import build_cohort
    return build_cohort(an.patients(an.load(spark, sf_dir, "customer")),
                        an.stays(an.load(spark, sf_dir, "orders")))


COHORT_SQL_COLS = ("subject_id, icustay_id, hadm_id, gender, dbsource, first_careunit, "
                   "last_careunit, first_wardid, last_wardid, intime, outtime, "
                   + O.R("los") + " AS los, pt_age")


@register("cohort_filter", O.with_(O.patients_stays_ctes())
          + f"\nSELECT {COHORT_SQL_COLS} FROM cohort")
def cohort_filter(spark, sf_dir):
    """B3 + C1: adults 16-75 (calendar-year age) with stays > 0.5 day."""
    return rounded(_cohort(spark, sf_dir))


@register("ordered_output", O.with_(O.patients_stays_ctes())
          + f"\nSELECT {COHORT_SQL_COLS} FROM cohort ORDER BY pt_age, icustay_id")
def ordered_output(spark, sf_dir):
    """the cohort as a stored relation ordered by age (output sort only)."""
    return rounded(_cohort(spark, sf_dir)).orderBy("pt_age", "icustay_id")


@register("restrict_subject", O.with_(O.patients_stays_ctes()) + """
SELECT event_id, user_id, event_type, value FROM events
WHERE user_id IN (SELECT DISTINCT subject_id FROM cohort)""")
def restrict_subject(spark, sf_dir):
    """Event log rows of cohort subjects (left semi join)."""
    from wardflow.operators.cohort import restrict
    ev = an.load(spark, sf_dir, "events")
    return restrict(ev, _cohort(spark, sf_dir), "user_id", "subject_id").select(
        "event_id", "user_id", "event_type", "value")


@register("restrict_subject_bloom", ORACLE["restrict_subject"])
def restrict_subject_bloom(spark, sf_dir):
    """C2a with the log tested against a Bloom filter of the cohort first."""
    from wardflow.operators.cohort import restrict
    from wardflow.sources.materialize import materialize
    cohort = materialize(_cohort(spark, sf_dir).select("subject_id"), "cohort_subjects")
    ev = an.load(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return restrict(ev, cohort, "user_id", "subject_id", bloom_bits=1 << 20)


@register("restrict_admission", O.with_(O.patients_stays_ctes()) + """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_orderkey IN (SELECT DISTINCT hadm_id FROM cohort)""")
def restrict_admission(spark, sf_dir):
    """Rows of cohort admissions."""
    from wardflow.operators.cohort import restrict
    li = an.load(spark, sf_dir, "lineitem")
    return restrict(li, _cohort(spark, sf_dir), "l_orderkey", "hadm_id").select(
        "l_orderkey", "l_linenumber", "l_quantity")


@register("restrict_stay", O.with_(O.patients_stays_ctes()) + """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_orderkey IN (SELECT icustay_id FROM cohort)""")
def restrict_stay(spark, sf_dir):
    """Rows of cohort stays."""
    from wardflow.operators.cohort import restrict
    li = an.load(spark, sf_dir, "lineitem")
    return restrict(li, _cohort(spark, sf_dir), "l_orderkey", "icustay_id").select(
        "l_orderkey", "l_linenumber", "l_partkey")


LAB_TOLERANCE_DAYS = 30


@register("interval_join_one_key", O.with_(O.patients_stays_ctes()) + f"""
SELECT l.l_orderkey AS hadm_id, l.l_linenumber AS linenumber, s.icustay_id,
       l.l_shipdate AS charttime, s.intime, s.outtime, l.l_quantity AS valuenum
FROM lineitem l JOIN s ON l.l_orderkey = s.hadm_id
WHERE epoch_us(l.l_shipdate) - epoch_us(s.intime) >= -{LAB_TOLERANCE_DAYS * O.DAY_US}
  AND epoch_us(s.outtime) - epoch_us(l.l_shipdate) >= -{LAB_TOLERANCE_DAYS * O.DAY_US}""")
def interval_join_one_key(spark, sf_dir):
    """Lab-like rows get the stay whose span (± 30 days here) holds them."""
    from wardflow.operators.harmonize import labs_with_stays
    labs = an.lab_rows(an.load(spark, sf_dir, "lineitem"))
    st = an.stays(an.load(spark, sf_dir, "orders"))
    j = labs_with_stays(labs, st, tolerance_seconds=LAB_TOLERANCE_DAYS * 86400)
    return j.select("hadm_id", "linenumber", "icustay_id", "charttime", "intime", "outtime",
                    "valuenum")


@register("interval_join_two_keys", """
WITH spans AS (
  SELECT user_id AS subject_id, user_id AS hadm_id, min(ts) AS intime, max(ts) AS outtime
  FROM events GROUP BY user_id, date_trunc('week', ts))
SELECT e.event_id, e.user_id AS icustay_id, e.ts AS charttime, s.intime, s.outtime
FROM events e JOIN spans s ON e.user_id = s.subject_id AND e.user_id = s.hadm_id
WHERE epoch_us(e.ts) - epoch_us(s.intime) >= -3600000000
  AND epoch_us(s.outtime) - epoch_us(e.ts) >= -3600000000""")
def interval_join_two_keys(spark, sf_dir):
    """C4: events joined on (subject, admission) to weekly spans within one
    hour; the event keeps its own stay id and an event near a week boundary
    matches both weeks (Q19)."""
    from wardflow.operators.intervals import interval_join
    ev = an.load(spark, sf_dir, "events")
    spans = (ev.groupBy("user_id", F.date_trunc("week", "ts").alias("wk"))
               .agg(F.min("ts").alias("intime"), F.max("ts").alias("outtime"))
               .select(F.col("user_id").alias("subject_id"), F.col("user_id").alias("hadm_id"),
                       "intime", "outtime"))
    rows = an.event_rows(ev)
    j = interval_join(rows, spans, on=["subject_id", "hadm_id"], ts="charttime")
    return j.select("event_id", "icustay_id", "charttime", "intime", "outtime")


# ---------------------------------------------------------------------------
# GCS components, text, dictionary statistics
# ---------------------------------------------------------------------------

@register("component_total", """
WITH c AS (
  SELECT l_orderkey * 8 + l_linenumber AS row_id, l_suppkey AS subject_id,
         l_orderkey AS hadm_id, l_orderkey AS icustay_id, l_shipdate AS charttime,
         CASE l_linenumber WHEN 1 THEN 198 WHEN 2 THEN 220739 WHEN 3 THEN 223900
                           WHEN 4 THEN 223901 ELSE 0 END AS itemid,
         CAST(l_quantity AS VARCHAR) AS value, l_quantity / 4 AS valuenum
  FROM lineitem),
g AS (
  SELECT subject_id, hadm_id, icustay_id, charttime, valuenum FROM (
    SELECT DISTINCT row_id, subject_id, hadm_id, icustay_id, charttime, value, valuenum
    FROM c WHERE itemid = 198)
  UNION ALL
  SELECT subject_id, hadm_id, icustay_id, charttime, sum(val) AS valuenum FROM (
    SELECT DISTINCT row_id, subject_id, hadm_id, icustay_id, charttime, valuenum AS val
    FROM c WHERE itemid IN (220739, 223900, 223901))
  GROUP BY charttime, subject_id, hadm_id, icustay_id)
SELECT subject_id, hadm_id, icustay_id, 'GCS' AS itemcat, 198 AS itemid, charttime,
       """ + O.R("valuenum") + """ AS valuenum, 'points' AS valueuom
FROM g WHERE valuenum IS NOT NULL AND valuenum >= 3""")
def component_total(spark, sf_dir):
    """D2 + D4 + G1 + Q15: GCS-like totals = direct totals UNION ALL summed
    components (de-duplicated), kept when >= 3."""
    from wardflow.operators.harmonize import gcs_branch
    li = an.load(spark, sf_dir, "lineitem")
    code = (F.when(F.col("l_linenumber") == 1, 198).when(F.col("l_linenumber") == 2, 220739)
             .when(F.col("l_linenumber") == 3, 223900).when(F.col("l_linenumber") == 4, 223901)
             .otherwise(0))
    chart = li.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_id"),
        F.col("l_suppkey").alias("subject_id"), F.col("l_orderkey").alias("hadm_id"),
        F.col("l_orderkey").alias("icustay_id"), F.col("l_shipdate").alias("charttime"),
        code.alias("itemid"), F.col("l_quantity").cast("string").alias("value"),
        (F.col("l_quantity") / 4).alias("valuenum"), F.lit("points").alias("valueuom"))
    g = gcs_branch(chart)
    return rounded(g.select("subject_id", "hadm_id", "icustay_id", "itemcat", "itemid",
                            "charttime", "valuenum", "valueuom"))


@register("text_format", "SELECT l_orderkey, l_linenumber, "
          + O.text_sql("l_extendedprice", 3) + " AS price_text, "
          + O.text_sql("l_discount * 100", 3) + " AS percent_text, "
          + O.text_sql("(l_quantity - 32) * 5 / 9", 3) + " AS celsius_text, "
          + O.text_sql("l_tax / 1000", 6) + " AS litre_text FROM lineitem")
def text_format(spark, sf_dir):
    """H7: display text (at most n places, no trailing zeros)."""
    from wardflow.functions.units import value_text
    li = an.load(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        value_text("l_extendedprice", 3).alias("price_text"),
        value_text(F.col("l_discount") * 100, 3).alias("percent_text"),
        value_text((F.col("l_quantity") - 32) * 5 / 9, 3).alias("celsius_text"),
        value_text(F.col("l_tax") / 1000, 6).alias("litre_text"))


@register("dictionary_stats", O.with_(O.events_windowed_ctes()) + """
SELECT itemcat, """ + O.R("median(valuenum)") + " AS median_value, "
          + O.R("avg(valuenum)") + """ AS mean_value, count(*) AS n
FROM lng WHERE valuenum IS NOT NULL GROUP BY itemcat""")
def dictionary_stats(spark, sf_dir):
    """Per-category exact median and mean computed from the data."""
    from wardflow.operators.aggregate import dictionary_stats as stats
    ev = an.load(spark, sf_dir, "events")
    return rounded(stats(an.events_long(spark, ev)))


@register("dictionary_stats_null_group", """
WITH v AS (SELECT CASE WHEN props::JSON->>'$.k' IS NOT NULL AND CAST(props::JSON->>'$.k' AS INTEGER) % 7 <> 0
             THEN CAST(props::JSON->>'$.k' AS INTEGER) % 7 END AS cat, value FROM events)
SELECT cat, """ + O.R("median(value)") + " AS median_value, " + O.R("avg(value)") + """ AS mean_value,
  count(*) AS n FROM v WHERE value IS NOT NULL GROUP BY cat""")
def dictionary_stats_null_group(spark, sf_dir):
    """D8 with a NULL category, which is a group like any other."""
    from wardflow.operators.aggregate import dictionary_stats as stats
    k = F.get_json_object("props", "$.k").cast("int") % 7
    ev = an.load(spark, sf_dir, "events").select(F.nullif(k, F.lit(0)).alias("cat"), "value")
    return rounded(stats(ev, category="cat", value="value"))


# ---------------------------------------------------------------------------
# sequences
# ---------------------------------------------------------------------------

def _docs(spark, sf_dir):
    return an.load(spark, sf_dir, "documents").select("doc_id", "text")


@register("vocab_topk", O.with_(O.vocab_ctes()) + "\nSELECT token, id, count FROM vocab")
def vocab_topk(spark, sf_dir):
    """The 19,996 most frequent words with ids rank + 3."""
    from wardflow.operators.vocab import build_vocab
    return build_vocab(_docs(spark, sf_dir))


@register("encode", O.with_(O.vocab_ctes(), O.encode_ctes())
          + "\nSELECT doc_id, CAST(len(ids) AS INTEGER) AS n_ids, array_to_string(ids, ' ') AS ids_text FROM enc")
def encode(spark, sf_dir):
    """K2: every document's whole token sequence as ids (OOV 2, start 1)."""
    from wardflow.operators.vocab import build_vocab, encode as enc
    docs = _docs(spark, sf_dir)
    e = enc(docs, build_vocab(docs))
    return e.select("doc_id", F.size("ids").alias("n_ids"),
                    F.array_join("ids", " ").alias("ids_text"))


@register("pad", O.with_(O.vocab_ctes(), O.encode_ctes())
          + "\nSELECT doc_id, array_to_string(" + O.pad_sql("ids", 80)
          + ", ' ') AS padded_text FROM enc")
def pad(spark, sf_dir):
    """K3: encoded sequences left-padded / truncated to the last 80 ids."""
    from wardflow.functions.arrays import pad as pad_arr
    from wardflow.operators.vocab import build_vocab, encode as enc
    docs = _docs(spark, sf_dir)
    e = enc(docs, build_vocab(docs), last_n=80)
    return e.select("doc_id", F.array_join(pad_arr("ids", 80), " ").alias("padded_text"))


@register("load_sequences", """
SELECT doc_id, quality AS label,
  CASE WHEN ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 5 < 1 THEN 'test' ELSE 'train' END
    AS split
FROM documents JOIN labels USING (doc_id)""")
def load_sequences(spark, sf_dir):
    """A5: labelled documents with a fixed hash split."""
    from wardflow.sources.sequences import load_sequences as ls
    return ls(spark, sf_dir).select("doc_id", "label", "split")


def _seq_cols():
    return dic.FEATURE_COLUMNS + [f"m_{c}" for c in dic.FEATURE_COLUMNS]


def _to_sequences_sql(w: int, n: int) -> str:
    vec = "[" + ", ".join(f"coalesce(CAST({O.R(c)} AS DOUBLE), 0.0)" for c in dic.FEATURE_COLUMNS) \
        + ", " + ", ".join(f"CAST(m_{c} AS DOUBLE)" for c in dic.FEATURE_COLUMNS) + "]"
    zero = "[" + ", ".join(["0.0"] * len(_seq_cols())) + "]"
    body = O.with_(O.events_windowed_ctes(), O.pivot_ctes(w), O.imputed_cte(), f"""
vr AS (SELECT icustay_id, tw_hour_idx, {vec} AS v,
              row_number() OVER (PARTITION BY icustay_id ORDER BY tw_hour_idx DESC) AS r
       FROM imp),
st AS (SELECT icustay_id, count(*) AS n_steps, list(v ORDER BY tw_hour_idx) AS steps
       FROM vr WHERE r <= {n} GROUP BY icustay_id)""")
    padded = O.pad_sql("steps", n, zero)
    return body + f"""
SELECT icustay_id, n_steps,
  array_to_string(list_transform({padded},
    lambda s: array_to_string(list_transform(s, lambda x: printf('%.6f', x)), ',')), ';')
    AS steps_text
FROM st"""


@register("to_sequences_w6", _to_sequences_sql(6, 80))
def to_sequences_w6(spark, sf_dir):
    """K4: per stay, the last 80 six-hour feature vectors (24 values + 24
    masks), left-padded with zero vectors."""
    from wardflow.operators.vocab import to_sequences
    f = rounded(fx.features(_windowed(spark, sf_dir), 6))
    s = to_sequences(f, _seq_cols(), 80)
    text = F.array_join(F.transform(
        "steps", lambda v: F.array_join(F.transform(v, lambda x: F.format_string("%.6f", x)),
                                        ",")), ";")
    return s.select("icustay_id", "n_steps", text.alias("steps_text"))


# The embeddings carry a 10-class label (0-9); the reference's head is a
# binary classifier, so its analogue target is the upper half of the classes.
BINARY_FROM_CLASS = 5


def _emb(spark, sf_dir):
    e = an.load(spark, sf_dir, "embeddings")
    return e.select("vec_id", "label",
                    F.when(F.col("label") >= BINARY_FROM_CLASS, 1).otherwise(0).alias("y"),
                    F.transform("embedding", lambda x: x.cast("double")).alias("e"))


EMB_SQL = ("SELECT vec_id, label, "
           f"CASE WHEN label >= {BINARY_FROM_CLASS} THEN 1 ELSE 0 END AS y, "
           "list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings")


@register("delta_pairs", f"""
WITH x AS ({EMB_SQL})
SELECT vec_id, CAST(i AS INTEGER) AS pair_idx, {O.R('a')} AS first, {O.R('b')} AS second FROM (
  SELECT vec_id, unnest(range(len(e) // 2)) AS i,
         unnest(list_filter(e, lambda v, j: j % 2 = 1)) AS a,
         unnest(list_filter(e, lambda v, j: j % 2 = 0)) AS b
  FROM x)""")
def delta_pairs(spark, sf_dir):
    """(x0, x1), (x2, x3), ... of each 64-wide vector, one row per pair."""
    from wardflow.functions.arrays import delta_pairs as dp
    e = _emb(spark, sf_dir)
    p = e.select("vec_id", F.posexplode(dp("e")).alias("pair_idx", "p"))
    return rounded(p.select("vec_id", "pair_idx", F.col("p.first").alias("first"),
                            F.col("p.second").alias("second")))


@register("softmax_reweight", f"""
WITH x AS ({EMB_SQL}),
s AS (SELECT vec_id, e, list_transform(e, lambda v: exp(v - list_max(e))) AS ex FROM x),
a AS (SELECT vec_id, e, list_transform(ex, lambda v: v / list_sum(ex)) AS att FROM s)
SELECT vec_id, CAST(i AS INTEGER) AS i, {O.R('w')} AS weight, {O.R('v * w')} AS reweighted FROM (
  SELECT vec_id, unnest(range(len(e))) AS i, unnest(e) AS v, unnest(att) AS w FROM a)""")
def softmax_reweight(spark, sf_dir):
    """K6: softmax attention weights over each vector and the reweighted vector."""
    from wardflow.functions.arrays import hadamard, softmax
    e = _emb(spark, sf_dir)
    a = e.select("vec_id", softmax("e").alias("a"), "e")
    z = a.select("vec_id", F.posexplode(F.arrays_zip(F.col("a").alias("w"),
                                                      hadamard("e", "a").alias("r"))))
    return rounded(z.select("vec_id", F.col("pos").alias("i"), F.col("col.w").alias("weight"),
                            F.col("col.r").alias("reweighted")))


@register("slice_concat", f"""
WITH x AS ({EMB_SQL}),
h AS (SELECT vec_id, e[1:32] AS c, e[33:64] AS h FROM x)
SELECT vec_id, {O.R('c[1]')} AS c_first, {O.R('c[32]')} AS c_last, {O.R('h[1]')} AS h_first,
       {O.R('h[32]')} AS h_last, CAST(len(list_concat(c, c, c)) AS INTEGER) AS c3_len,
       {O.R('list_sum(list_concat(c, c, c))')} AS c3_sum,
       {O.R('list_concat(h, h, h)[96]')} AS h3_last
FROM h""")
def slice_concat(spark, sf_dir):
    """Channel halves (c, h), 3x concatenation and the last element."""
    from wardflow.functions.arrays import array_sum, halves, repeat_concat
    e = _emb(spark, sf_dir)
    c, h = halves(F.col("e"), 32)
    c3, h3 = repeat_concat(c, 3), repeat_concat(h, 3)
    return rounded(e.select(
        "vec_id", F.element_at(c, 1).alias("c_first"), F.element_at(c, -1).alias("c_last"),
        F.element_at(h, 1).alias("h_first"), F.element_at(h, -1).alias("h_last"),
        F.size(c3).alias("c3_len"), array_sum(c3).alias("c3_sum"),
        F.element_at(h3, -1).alias("h3_last")))


def _head_sql() -> str:
    w = "[" + ", ".join(repr(v) for v in O.head_weights()) + "]"
    return (f"1.0 / (1.0 + exp(-(list_sum(list_transform(e, lambda v, j: v * {w}[j])) "
            f"+ {O.HEAD_BIAS!r})))")


def _head(spark, sf_dir):
    from wardflow.functions.arrays import dot, sigmoid
    e = _emb(spark, sf_dir)
    return e.select("vec_id", "y",
                    sigmoid(dot("e", O.head_weights()) + F.lit(O.HEAD_BIAS)).alias("probability"))


@register("score_head", f"WITH x AS ({EMB_SQL}) SELECT vec_id, y, "
          + O.R(_head_sql()) + " AS probability FROM x")
def score_head(spark, sf_dir):
    """sigmoid(w . x + b) with fixed head weights."""
    return rounded(_head(spark, sf_dir))


@register("evaluate", f"""
WITH x AS ({EMB_SQL}), sc AS (SELECT y, {_head_sql()} AS p FROM x),
cl AS (SELECT y, p, least(greatest(p, 1e-7), 1 - 1e-7) AS q FROM sc)
SELECT count(*) AS n,
  {O.R('avg(CASE WHEN (CASE WHEN p > 0.5 THEN 1.0 ELSE 0.0 END) = y THEN 1.0 ELSE 0.0 END)')}
    AS accuracy,
  {O.R('avg(-(y * ln(q) + (1.0 - y) * ln(1.0 - q)))')} AS bce
FROM cl""")
def evaluate(spark, sf_dir):
    """Accuracy and binary cross-entropy of stored scores."""
    from wardflow.operators.scan import evaluate as ev
    return rounded(ev(_head(spark, sf_dir), label="y"))


@register("fit_head")
def fit_head(spark, sf_dir):
    """Logistic-regression head fitted by Spark ML on the vectors
    (rows-only check: an iterative fit has no SQL form)."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from wardflow.operators.scan import fit_head as fh
    e = _emb(spark, sf_dir).select("vec_id", F.col("y").cast("double").alias("label"),
                                   array_to_vector("e").alias("features"))
    model = fh(e, max_iter=200)
    return model.transform(e).select(
        "vec_id", F.col("label").cast("int").alias("y"),
        vector_to_array("probability")[1].alias("probability"))


HEAD_PENALTY = 0.01


@register("fit_head_gradient", f"""
WITH x AS ({EMB_SQL})
SELECT DISTINCT CAST(i AS INTEGER) - 1 AS feature, 0.0::DOUBLE AS gradient
FROM (SELECT unnest(range(len(e) + 1)) AS i FROM x)""")
def fit_head_gradient(spark, sf_dir):
    """K12 checked at its optimum: the penalised log-loss has one minimum, so
    the gradient at the fitted weights, rounded to 4 places, is zero for
    every coefficient."""
    from pyspark.ml.functions import array_to_vector
    from wardflow.operators import scan
    e = _emb(spark, sf_dir).select(F.col("y").cast("double").alias("label"),
                                   array_to_vector("e").alias("features"))
    model = scan.fit_head(e, max_iter=200, reg_param=HEAD_PENALTY, standardization=False)
    g = scan.head_gradient(model, e, HEAD_PENALTY)
    return g.select("feature", (F.round("gradient", 4) + F.lit(0.0)).alias("gradient"))


@register("scan_score")
def scan_score(spark, sf_dir):
    """Documents -> vocabulary ids -> padded 80 -> frozen-weight
    recurrent scan + attention + gated memory + sigmoid head, scored in
    Arrow batches (rows-only check; NumPy unit tests cover the maths)."""
    from wardflow.functions.arrays import pad as pad_arr
    from wardflow.operators.scan import score_sequences
    from wardflow.operators.vocab import build_vocab, encode as enc
    docs = _docs(spark, sf_dir)
    e = enc(docs, build_vocab(docs), last_n=80)
    return score_sequences(e.select("doc_id", pad_arr("ids", 80).alias("ids")))


# ---------------------------------------------------------------------------
# the clinical build over derived clinical tables (G2 + every branch, §3.2)
# ---------------------------------------------------------------------------

def _clinical_tables(spark, sf_dir):
    """The derived clinical tables, conformed to their declared schemas."""
    from wardflow.sources.tables import conform_clinical
    return conform_clinical(an.clinical_tables(spark, sf_dir), fill_missing=True)


def _clinical(spark, sf_dir, **options):
    return fx.long_features(**_clinical_tables(spark, sf_dir), **options)


def _view_query(name):
    def q(spark, sf_dir):
        views.register_clinical_views(spark, _clinical_tables(spark, sf_dir))
        return rounded(spark.table(name))
    q.__doc__ = f"A4/B1: the view {name} with its full column list."
    return q


for _name, (_, _schema) in views.RESTRICTED.items():
    register(f"view_{_name}", O.view_sql(_name, _schema))(_view_query(_name))
register(f"view_{views.LAB_VIEW}", O.lab_view_sql())(_view_query(views.LAB_VIEW))


@register("clinical_features_w6_as_written",
          O.with_(O.clinical_long_ctes("TEMP"), O.clinical_win_cte(),
                  O.pivot_ctes(6, binding=dic.positional_binding("en_US")),
                  O.imputed_cte(dic.as_written_spec()), O.score_cte(6))
          + f"\nSELECT icustay_id, tw_hour_idx, {O.total_expr()}, " + O.r6(dic.FEATURE_COLUMNS)
          + ", " + ", ".join(f"m_{c}" for c in dic.FEATURE_COLUMNS) + " FROM sc")
def clinical_features_w6_as_written(spark, sf_dir):
    """Both entry points as the reference text has them on an en_US server:
    TEMP as the temperature's category (Q5), the crosstab bound by position
    in en_US order (Q1), the literal imputation slots (Q2, Q3)."""
    cohort, lng = _clinical(spark, sf_dir, temp_category="TEMP")
    return rounded(fx.features(fx.windowed_features(lng, cohort, by_key=True), 6, spec=dic.as_written_spec(),
                               binding=dic.positional_binding("en_US")))


@register("long_union", O.with_(O.clinical_long_ctes()) + """
SELECT subject_id, hadm_id, icustay_id, itemcat, itemid, charttime, cvalue, """
          + O.R("valuenum") + " AS valuenum, valueuom FROM lng")
def long_union(spark, sf_dir):
    """G2 with B2, B4-B9, C2, C3, D2, D4, G1: the eight branches (chart,
    FiO2, temperature, labs, GCS, two infusion logs, urine) over clinical-
    shaped tables, with the real code maps and whitelists."""
    _, lng = _clinical(spark, sf_dir)
    return rounded(lng)


@register("long_union_bloom", ORACLE["long_union"])
def long_union_bloom(spark, sf_dir):
    """The eight branches, every log tested against a Bloom filter of the cohort first."""
    return rounded(_clinical(spark, sf_dir, bloom_bits=1 << 20)[1])


@register("clinical_features_w6", O.with_(O.clinical_long_ctes(), O.clinical_win_cte(),
                                          O.pivot_ctes(6), O.imputed_cte(), O.score_cte(6))
          + f"\nSELECT icustay_id, tw_hour_idx, {O.total_expr()}, " + O.r6(dic.FEATURE_COLUMNS)
          + ", " + ", ".join(f"m_{c}" for c in dic.FEATURE_COLUMNS) + " FROM sc")
def clinical_features_w6(spark, sf_dir):
    """Entry points 2 then 1 on the clinical path: cohort, eight branches,
    windowed table (C4), then the 50-column feature rows."""
    cohort, lng = _clinical(spark, sf_dir)
    return rounded(fx.features(fx.windowed_features(lng, cohort, by_key=True), 6))


# ---------------------------------------------------------------------------
# SQL surface and materialised relations (U8, A3, A4)
# ---------------------------------------------------------------------------

@register("sql_get_features_w1", _features_sql(1))
def sql_get_features_w1(spark, sf_dir):
    """U8: the SQL table function called for every stay through LATERAL."""
    from wardflow.plans import sql as sqlsurface
    sqlsurface.register(spark, _windowed(spark, sf_dir))
    df = spark.sql("""SELECT f.* FROM (SELECT DISTINCT icustay_id FROM windowed_events) s,
                      LATERAL get_features(s.icustay_id, 1) f""")
    return rounded(df)


@register("features_50_w6_bucketed", _features_sql(6))
def features_50_w6_bucketed(spark, sf_dir):
    """A3: the windowed table materialised bucketed by stay in the shared
    checkpoint folder (lineage cut), then the feature rows over it."""
    from wardflow.sources.materialize import materialize
    win = materialize(_windowed(spark, sf_dir), "windowed_events_bucketed",
                      bucket_by="icustay_id")
    return rounded(fx.features(win, 6))


@register("impute_dictionary_defaults_w6",
          O.with_(O.events_windowed_ctes(), O.pivot_ctes(6), O.imputed_cte())
          + "\nSELECT icustay_id, tw_hour_idx, " + O.r6(dic.FEATURE_COLUMNS) + " FROM imp")
def impute_dictionary_defaults_w6(spark, sf_dir):
    """C6 with the dictionary given as a DataFrame (A2): its medians are read
    once as scalar defaults (one row per category; more than one distinct
    median for a category is an error, like the scalar subquery)."""
    return rounded(fx.imputed(_windowed(spark, sf_dir), 6,
                              defaults=dic.feature_dictionary(spark)))


def _dictionary_values_sql() -> str:
    return ", ".join(f"({i}, '{c}', {O.dbl(m)}, {O.dbl(a)}, '{u}')"
                     for i, c, m, a, u in dic.FEATURE_ROWS)


@register("dictionary_vs_data", O.with_(O.events_windowed_ctes()) + f""",
d AS (SELECT * FROM (VALUES {_dictionary_values_sql()})
      AS t(item_idx, item_cat, median_value, mean_value, item_unit)),
st AS (SELECT lower(itemcat) AS cat, median(valuenum) AS data_median, avg(valuenum) AS data_mean,
              count(*) AS n
       FROM lng WHERE valuenum IS NOT NULL GROUP BY lower(itemcat))
SELECT d.item_idx, d.item_cat, d.item_unit, {O.R('d.median_value')} AS stored_median,
       {O.R('d.mean_value')} AS stored_mean, {O.R('st.data_median')} AS data_median,
       {O.R('st.data_mean')} AS data_mean, st.n
FROM d LEFT JOIN st ON lower(d.item_cat) = st.cat""")
def dictionary_vs_data(spark, sf_dir):
    """A2 + D8: the stored dictionary next to the statistics of the data."""
    from wardflow.operators.aggregate import dictionary_stats as stats
    ev = an.load(spark, sf_dir, "events")
    lng = an.events_long(spark, ev).withColumn("cat", F.lower("itemcat"))
    st = stats(lng, category="cat").select(
        "cat", F.col("median_value").alias("data_median"),
        F.col("mean_value").alias("data_mean"), "n")
    d = dic.feature_dictionary(spark)
    out = d.join(st, F.lower(d["item_cat"]) == st["cat"], "left").select(
        "item_idx", "item_cat", "item_unit", F.col("median_value").alias("stored_median"),
        F.col("mean_value").alias("stored_mean"), "data_median", "data_mean", "n")
    return rounded(out)
