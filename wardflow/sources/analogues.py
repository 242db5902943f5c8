"""Analogue views: the driver's test tables shaped like the clinical inputs.

The clinical base tables are not available, so each operator is exercised
on a driver table that has the same shape of problem:

  events  -> one long event log: stay = subject = admission = ``user_id``,
             item code = ``props.k`` (0-99), value = ``value - 1`` (so that
             zero and negative readings exist), time = ``ts``; each user's
             stay runs from its first event + 1 day to its last event - 1 day,
             so both one-hour tolerances and the mirrored pre-start rows (Q8)
             occur.
  customer/orders -> patients/stays: birth year from the account balance,
             stay = order, admission = order, stay length from the price.
  lineitem -> lab-like rows on an admission (order) with ship date as time.

Every view is a lazy projection of the driver table; its size grows with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.functions import units
from wardflow.functions.timecols import US_PER_SECOND, add_micros
from wardflow.sources import dictionary as dic
from wardflow.sources.tables import load

DAY_US = 86400 * US_PER_SECOND
N_CODES = 100          # props.k takes values 0..99
N_EFFECTIVE = 96       # codes 96..99 are mapped but not whitelisted (like Q7)


UNIT_RULE_CATEGORIES = ("FiO2", "Temperature", "Urine")
TYPICAL_RAW = 35.0     # about the median of ``value - 1`` in the events table


def analogue_code_rows() -> list[tuple[int, str, bool, float]]:
    """Code k -> (category of dictionary row (k mod 24) + 1, effective, scale).

    Categories with a unit rule read the raw value (percent/fraction,
    Fahrenheit/Celsius, ml); the others are scaled so a typical reading is
    near the dictionary median, which keeps the step scores non-trivial.
    """
    rows = dic.FEATURE_ROWS
    out = []
    for k in range(N_CODES):
        _, cat, median, _, _ = rows[k % len(rows)]
        scale = 1.0 if cat in UNIT_RULE_CATEGORIES else median / TYPICAL_RAW
        out.append((k, cat, k < N_EFFECTIVE, scale))
    return out


def analogue_code_map(spark: SparkSession) -> DataFrame:
    schema = T.StructType([
        T.StructField("source", T.StringType(), False),
        T.StructField("itemid", T.IntegerType(), False),
        T.StructField("itemcat", T.StringType(), False),
        T.StructField("priority", T.IntegerType(), False),
        T.StructField("effective", T.BooleanType(), False),
        T.StructField("scale", T.DoubleType(), False),
    ])
    from wardflow.sources.literal import local_table
    rows = [("events", k, cat, 0, eff, sc) for k, cat, eff, sc in analogue_code_rows()]
    return local_table(spark, rows, schema)


def _item_code(props) -> "F.Column":
    """The item code: top-level member ``k`` of the JSON object in ``props``
    (NULL when absent)."""
    return F.get_json_object(props, "$.k").cast("int")


def event_rows(events: DataFrame) -> DataFrame:
    """events -> (event_id, subject/hadm/stay ids, itemid, charttime, raw)."""
    return events.select(
        "event_id",
        F.col("user_id").alias("subject_id"), F.col("user_id").alias("hadm_id"),
        F.col("user_id").alias("icustay_id"),
        _item_code(F.col("props")).alias("itemid"),
        F.col("ts").alias("charttime"),
        (F.col("value") - F.lit(1.0)).alias("raw"))


def event_spans(events: DataFrame) -> DataFrame:
    """Per-user stay: first event + 1 day .. last event - 1 day (partial
    aggregate; one row per user)."""
    s = events.groupBy("user_id").agg(F.min("ts").alias("t0"), F.max("ts").alias("t1"))
    intime = add_micros(F.col("t0"), F.lit(DAY_US))
    outtime = add_micros(F.col("t1"), F.lit(-DAY_US))
    return s.select(
        F.col("user_id").alias("subject_id"), F.col("user_id").alias("hadm_id"),
        F.col("user_id").alias("icustay_id"), intime.alias("intime"), outtime.alias("outtime"))


def harmonized_event_rows(mapped: DataFrame) -> DataFrame:
    """Unit rules per category over code-mapped event rows (B5, B7-B9):
    FiO2 fraction/percent, temperature F/C, urine ml -> l, the rest kept
    within 0..3000.  Rows failing their branch's filter are dropped; rule
    results outside every arm stay as NULL values."""
    cat, raw = F.col("itemcat"), F.col("raw")
    scaled = raw * F.col("scale")
    keep = (F.when(cat == "FiO2", units.plausible(raw, 0))
             .when(cat == "Temperature", F.lit(True))
             .when(cat == "Urine", units.plausible(raw, *dic.URINE_RANGE_ML))
             .otherwise(units.plausible(scaled, *dic.CHART_LAB_RANGE)))
    value = (F.when(cat == "FiO2", units.normalize_fio2(raw))
              .when(cat == "Temperature", units.normalize_temp(raw))
              .when(cat == "Urine", units.ml_to_l(raw))
              .otherwise(scaled))
    return mapped.where(keep).withColumn("valuenum", value)


def events_long(spark: SparkSession, events: DataFrame) -> DataFrame:
    """The events log as long feature rows (same columns as the clinical
    long table plus ``event_id``)."""
    from wardflow.operators.harmonize import map_codes
    mapped = map_codes(event_rows(events), analogue_code_map(spark), "itemid", source="events")
    return harmonized_event_rows(mapped).select(
        "event_id", "subject_id", "hadm_id", "icustay_id", "itemcat", "itemid", "charttime",
        "valuenum")


def events_windowed(spark: SparkSession, base: str,
                    tolerance_seconds: float = dic.STAY_TOLERANCE_SECONDS) -> DataFrame:
    """The windowed long table over ``events`` (entry point 2 analogue)."""
    from wardflow.plans.features import windowed_features
    ev = load(spark, base, "events")
    return windowed_features(events_long(spark, ev), event_spans(ev), tolerance_seconds)


# --- customer / orders / lineitem ------------------------------------------

def patients(customer: DataFrame) -> DataFrame:
    """customer -> patients; birth year 1900 + floor((balance + 1000) / 100)."""
    year = (F.floor((F.col("c_acctbal") + F.lit(1000.0)) / F.lit(100.0)) + 1900).cast("int")
    dob = F.make_timestamp_ntz(year, F.lit(7), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    return customer.select(F.col("c_custkey").alias("subject_id"),
                           F.col("c_mktsegment").alias("gender"), dob.alias("dob"))


def stays(orders: DataFrame) -> DataFrame:
    """orders -> stays; admission = stay = order, length = price / 100000 days."""
    los = F.col("o_totalprice") / F.lit(100000.0)
    outtime = add_micros(F.col("o_orderdate"), F.floor(los * F.lit(float(DAY_US))))
    return orders.select(
        F.col("o_custkey").alias("subject_id"), F.col("o_orderkey").alias("hadm_id"),
        F.col("o_orderkey").alias("icustay_id"), F.col("o_orderstatus").alias("dbsource"),
        F.col("o_orderpriority").alias("first_careunit"),
        F.col("o_orderpriority").alias("last_careunit"),
        F.lit(None).cast("int").alias("first_wardid"), F.lit(None).cast("int").alias("last_wardid"),
        F.col("o_orderdate").alias("intime"), outtime.alias("outtime"), los.alias("los"))


def lab_rows(lineitem: DataFrame) -> DataFrame:
    """lineitem -> lab-like rows (no stay id; admission = order)."""
    return lineitem.select(
        F.col("l_orderkey").alias("hadm_id"), F.col("l_linenumber").alias("linenumber"),
        F.col("l_partkey").alias("itemid"), F.col("l_shipdate").alias("charttime"),
        F.col("l_quantity").alias("valuenum"))



# --- the seven clinical base tables, derived from customer/orders/lineitem ---

def code_pools() -> dict[str, list[int]]:
    """Rule-built code pools: every code a branch reads (mapped, whitelisted
    or not), so the derived logs exercise every arm of every map."""
    flat = lambda table: [c for _, cs in table for c in cs]
    return {
        "chart": flat(dic.CHART_CODES) + dic.FIO2_CODES + dic.TEMP_CODES
        + [dic.GCS_TOTAL_CODE] + dic.GCS_COMPONENT_CODES,
        "lab": flat(dic.LAB_CODES),
        "cv": flat(dic.CV_CODES),
        "mv": flat(dic.MV_CODES),
        "urine": list(dic.URINE_CODES),
    }


def _pick(pool: list[int], key) -> "F.Column":
    arr = F.array(*[F.lit(int(c)) for c in pool])
    return F.element_at(arr, (F.pmod(key, F.lit(len(pool))) + 1).cast("int"))


def _hours_after(ts, hours) -> "F.Column":
    return add_micros(ts, hours * F.lit(3600 * US_PER_SECOND))


def clinical_tables(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """patients / icustays / chartevents / labevents / outputevents /
    inputevents_cv / inputevents_mv with the clinical schemas' columns.

    Every lineitem row becomes one chart, one lab and one output row and
    one infusion row (the "mv" log for return flag N, the "cv" log for the
    others); its order is the admission and the stay.  Codes are taken from the pools by part /
    supplier key; times are hours after the order date (ship date for labs).
    """
    customer = load(spark, base, "customer")
    orders = load(spark, base, "orders")
    lineitem = load(spark, base, "lineitem")
    # the seven logs are projections of one join, on the key as the clinical schemas have it
    # (int): a log then lies by its admission, and joins on that move none of its rows again
    order = F.col("o_orderkey").cast("int").alias("order")
    used = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate"]
    lo = lineitem.select(*used, F.col("l_orderkey").cast("int").alias("line_order")).join(
        orders.select(order, "o_custkey", "o_orderdate"), F.col("line_order") == F.col("order"))
    pools = code_pools()
    row_id = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    subj, hadm = F.col("o_custkey").alias("subject_id"), F.col("line_order").alias("hadm_id")
    stay = F.col("line_order").alias("icustay_id")
    line = F.col("l_linenumber")
    chart_v = F.when(line != 7, F.col("l_quantity") * 2)
    chart = lo.select(
        row_id.alias("row_id"), subj, hadm, stay, _pick(pools["chart"], F.col("l_partkey"))
        .alias("itemid"), _hours_after(F.col("o_orderdate"), line * 2).alias("charttime"),
        F.lit(None).cast("timestamp_ntz").alias("storetime"), F.lit(None).cast("int").alias("cgid"),
        chart_v.cast("string").alias("value"), chart_v.alias("valuenum"),
        F.lit("u").alias("valueuom"), F.lit(0).alias("warning"), F.lit(0).alias("error"),
        F.lit(None).cast("string").alias("resultstatus"),
        F.lit(None).cast("string").alias("stopped"))
    lab_v = F.col("l_extendedprice") / 100
    labs = lo.select(
        subj, hadm, _pick(pools["lab"], F.col("l_suppkey")).alias("itemid"),
        F.col("l_shipdate").alias("charttime"), lab_v.cast("string").alias("value"),
        lab_v.alias("valuenum"), F.lit("u").alias("valueuom"), F.lit(None).cast("string")
        .alias("flag"))
    out_code = F.when(line <= 2, _pick(pools["urine"], F.col("l_partkey"))).otherwise(40000)
    output = lo.select(
        row_id.alias("row_id"), subj, hadm, stay,
        _hours_after(F.col("o_orderdate"), line).alias("charttime"), out_code.alias("itemid"),
        (F.col("l_extendedprice") / 10).alias("value"), F.lit("ml").alias("valueuom"),
        F.lit(None).cast("timestamp_ntz").alias("storetime"), F.lit(None).cast("int").alias("cgid"),
        F.lit(None).cast("string").alias("stopped"), F.lit(None).cast("string").alias("newbottle"),
        F.lit(0).alias("iserror"))
    inf_time = _hours_after(F.col("o_orderdate"), line * 3)
    cv = lo.where(F.col("l_returnflag") != "N").select(
        row_id.alias("row_id"), subj, hadm, stay, inf_time.alias("charttime"),
        _pick(pools["cv"], F.col("l_partkey")).alias("itemid"),
        F.col("l_quantity").alias("amount"), F.lit("ml").alias("amountuom"),
        (F.col("l_discount") * 100).alias("rate"), F.lit("mcg/kg/min").alias("rateuom"),
        F.col("l_suppkey").alias("orderid"), F.col("l_extendedprice").alias("originalamount"))
    mv = lo.where(F.col("l_returnflag") == "N").select(
        row_id.alias("row_id"), subj, hadm, stay, inf_time.alias("starttime"),
        _hours_after(F.col("o_orderdate"), line * 3 + 1).alias("endtime"),
        _pick(pools["mv"], F.col("l_partkey")).alias("itemid"),
        F.col("l_quantity").alias("amount"), F.lit("ml").alias("amountuom"),
        (F.col("l_tax") * 100).alias("rate"), F.lit("mcg/kg/min").alias("rateuom"),
        F.col("l_suppkey").alias("orderid"), F.col("l_returnflag").alias("ordercategoryname"))
    return {"patients": patients(customer), "icustays": stays(orders), "chartevents": chart,
            "labevents": labs, "outputevents": output, "inputevents_cv": cv,
            "inputevents_mv": mv}
