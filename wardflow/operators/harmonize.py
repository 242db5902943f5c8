"""Code -> feature mapping, unit rules and the union into one long table
(B2, B4-B9, D2, D4, G1, G2).

Each branch is a narrow projection/filter over one source log plus semi
joins to the cohort; the eight branches are cast to one schema and unioned
(no shuffle besides the semi joins and the GCS component sum).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow import schemas
from wardflow.functions import units
from wardflow.operators.cohort import restrict
from wardflow.operators.intervals import interval_join
from wardflow.sources import dictionary as dic


def map_codes(df: DataFrame, mapping: DataFrame, code: str = "itemid",
              source: str | None = None, source_col: str = "source",
              keep_ineffective: bool = False, first_match: bool = False) -> DataFrame:
    """B6 as a join: attach ``itemcat`` (and any other mapping columns) from
    a (source, itemid, itemcat, priority, effective, ...) table.

    No broadcast hint: a mapping that is small (as the fixed code maps are)
    is broadcast by Spark's own size check, and the events are then never
    shuffled.  Unmapped codes drop.  Codes must be unique per source (``code_map()`` guarantees it);
    ``first_match=True`` resolves repeated codes by lowest priority first,
    like the first arm of a CASE.
    """
    m = mapping
    if source is not None:
        m = m.where(F.col(source_col) == source)
    if not keep_ineffective:
        m = m.where("effective")
    carry = [c for c in m.columns if c not in (source_col, "itemid", "priority", "effective")]
    if first_match:
        m = (m.groupBy(F.col("itemid").alias("__code"))
              .agg(*[F.min_by(c, "priority").alias(c) for c in carry]))
    else:
        m = m.select(F.col("itemid").alias("__code"), *carry)
    return df.join(m, df[code] == m["__code"], "inner").drop("__code")


def to_long(df: DataFrame) -> DataFrame:
    """Cast a branch to the shared long schema."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.LONG.fields])


def dedupe(df: DataFrame, cols: list[str]) -> DataFrame:
    """``SELECT DISTINCT cols``."""
    return df.select(*cols).distinct()


def component_total(rows: DataFrame, keys: list[str], value: str = "valuenum") -> DataFrame:
    """Sum of component values per key (no check that all are present,
    Q15).  Partial aggregation runs before the shuffle."""
    return rows.groupBy(*keys).agg(F.sum(value).alias("valuenum"))


def union_all(branches: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name."""
    return reduce(lambda a, b: a.unionByName(b), branches)


# --- the eight branches over the clinical schema ----------------------------

def chart_branches(chart: DataFrame, cohort: DataFrame, temp_category: str = "Temperature",
                   subjects: DataFrame | None = None) -> DataFrame:
    """The chart, FiO2 and temperature branches in one pass over the chart
    log: the codes of all three reach the scan together, each row then
    yields one long row per branch whose rule it meets.

    Chart and FiO2 rows need their admission in the cohort (a left join to
    its distinct admissions flags them); TEMP has no admission test and no
    plausibility filter of its own (rows with a NULL result are dropped later
    by the windowed ``valuenum >= 0``).  TEMP's category is emitted under the
    dictionary's name so it reaches the pivot (Q5); pass "TEMP" for the
    reference text's.  ``subjects`` restricts the rows to its subjects, by
    their own semi join after the admission test: only the rows of a branch
    are moved to it, not the log."""
    item = F.col("itemid")
    whitelist = dic.whitelist("chart")
    rows = chart.where(item.isin(sorted({*whitelist, *dic.FIO2_CODES, *dic.TEMP_CODES})))
    admitted = cohort.select(F.col("hadm_id").alias("__hadm")).distinct()
    rows = rows.join(admitted, F.col("hadm_id") == F.col("__hadm"), "left")
    in_cohort = F.col("__hadm").isNotNull()
    fio2, temp = units.normalize_fio2("valuenum"), units.normalize_temp("valuenum")

    def row(when, category, text, value, unit):
        return F.when(when, F.struct(category.alias("itemcat"), text.alias("cvalue"),
                                     value.cast("double").alias("valuenum"), unit.alias("valueuom")))
    branches = F.array(
        row(item.isin(whitelist) & units.plausible("valuenum", *dic.CHART_LAB_RANGE) & in_cohort,
            dic.case_map(item, dic.CHART_CODES), F.col("value"), F.col("valuenum"), F.col("valueuom")),
        row(item.isin(dic.FIO2_CODES) & units.plausible("valuenum", 0) & in_cohort,
            F.lit("FiO2"), units.value_text(fio2), fio2, F.lit("%")),
        row(item.isin(dic.TEMP_CODES), F.lit(temp_category), units.value_text(temp), temp, F.lit("C")))
    out = rows.select("subject_id", "hadm_id", "icustay_id", "itemid", "charttime",
                      F.explode(F.array_compact(branches)).alias("b"))
    out = out.select("subject_id", "hadm_id", "icustay_id", "b.itemcat", "itemid",
                     "charttime", "b.cvalue", "b.valuenum", "b.valueuom")
    return to_long(out if subjects is None else restrict(out, subjects, "subject_id"))


def labs_with_stays(labs: DataFrame, stays: DataFrame,
                    tolerance_seconds: float = dic.STAY_TOLERANCE_SECONDS,
                    salt: int = 1) -> DataFrame:
    """Labs carry no stay id; take it from the stay whose span (± 1 h)
    holds the lab time on the same admission."""
    return interval_join(labs, stays, on="hadm_id", ts="charttime",
                         tolerance_seconds=tolerance_seconds, span_columns=["icustay_id"],
                         salt=salt, by_key=True)


def lab_branch(labs_stays: DataFrame) -> DataFrame:
    """Lab rows that carry a stay of the cohort's admissions (restrict the
    stays before ``labs_with_stays``: the labs need no semi join of their own)."""
    rows = labs_stays.where(F.col("itemid").isin(dic.whitelist("lab"))
                            & units.plausible("valuenum", *dic.CHART_LAB_RANGE))
    return to_long(rows.select(
        "subject_id", "hadm_id", "icustay_id",
        dic.case_map(F.col("itemid"), dic.LAB_CODES).alias("itemcat"),
        "itemid", "charttime", F.col("value").alias("cvalue"), "valuenum", "valueuom"))


def gcs_rows(chart: DataFrame) -> DataFrame:
    """GCS view: direct totals (code 198) UNION ALL summed components (G1),
    from one pass over the chart log.  Both kinds are deduplicated (D4) and
    grouped together: a total is a group of its own, components group by
    stay and time (D2)."""
    keys = ["subject_id", "hadm_id", "icustay_id", "charttime"]
    direct = F.col("itemid") == dic.GCS_TOTAL_CODE
    rows = (chart.where(F.col("itemid").isin([dic.GCS_TOTAL_CODE, *dic.GCS_COMPONENT_CODES]))
            .select(*keys, "row_id", direct.alias("direct"), "valuenum",
                    F.when(direct, F.col("value")).alias("value"),
                    F.when(direct, F.col("valueuom")).alias("valueuom")).distinct())
    total = F.when(F.col("direct"), F.struct("row_id", "value", "valuenum", "valueuom"))
    grouped = rows.groupBy(*keys, total.alias("total")).agg(F.sum("valuenum").alias("summed"))
    is_total = F.col("total").isNotNull()
    value = F.when(is_total, F.col("total.valuenum")).otherwise(F.col("summed"))
    return grouped.select(
        *keys, F.when(is_total, F.col("total.value")).otherwise(units.value_text("summed", 0)).alias("cvalue"),
        value.alias("valuenum"),
        F.when(is_total, F.col("total.valueuom")).otherwise(F.lit("points")).alias("valueuom"),
        F.lit("GCS").alias("itemcat"))


def gcs_branch(chart: DataFrame) -> DataFrame:
    rows = gcs_rows(chart).where(units.plausible("valuenum", dic.GCS_MIN))
    return to_long(rows.select(
        "subject_id", "hadm_id", "icustay_id", "itemcat",
        F.lit(dic.GCS_TOTAL_CODE).alias("itemid"), "charttime", "cvalue", "valuenum",
        F.lit("points").alias("valueuom")))


def infusion_branch(rows: DataFrame, table, time_col: str) -> DataFrame:
    """cv / mv rate logs: rate not null and >= 0, mapped by code."""
    codes = [c for _, cs in table for c in cs]
    rows = rows.where(F.col("itemid").isin(codes) & units.plausible("rate", 0))
    return to_long(rows.select(
        "subject_id", "hadm_id", "icustay_id",
        dic.case_map(F.col("itemid"), table).alias("itemcat"), "itemid",
        F.col(time_col).alias("charttime"), units.value_text("rate", 6).alias("cvalue"),
        F.col("rate").alias("valuenum"), F.col("rateuom").alias("valueuom")))


def urine_branch(output_events: DataFrame, cohort: DataFrame) -> DataFrame:
    rows = output_events.where(F.col("itemid").isin(dic.URINE_CODES)
                               & units.plausible("value", *dic.URINE_RANGE_ML))
    rows = restrict(rows, cohort, "icustay_id")
    v = units.ml_to_l("value")
    return to_long(rows.select(
        "subject_id", "hadm_id", "icustay_id", F.lit("URINE").alias("itemcat"), "itemid",
        "charttime", units.value_text(v, 6).alias("cvalue"), v.alias("valuenum"),
        F.lit("l").alias("valueuom")))
