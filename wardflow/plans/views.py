"""A4: the restricted views an analyst of the clinical schema queries first.

Each is its log with its full column list, restricted to subjects of the
cohort; the lab view also carries the stay found by the tolerance interval
join.  They are temp views over lazy plans: a query prunes and filters
through them down to the log's scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardflow import schemas
from wardflow.operators.cohort import build_cohort, restrict
from wardflow.operators.intervals import interval_join
from wardflow.sources import dictionary as dic

#: view -> (log, its declared columns)
RESTRICTED = {
    "adult_chartevents": ("chartevents", schemas.CHARTEVENTS),
    "adult_outputevents": ("outputevents", schemas.OUTPUTEVENTS),
    "adult_inputevents_cv": ("inputevents_cv", schemas.INPUTEVENTS_CV),
    "adult_inputevents_mv": ("inputevents_mv", schemas.INPUTEVENTS_MV),
}
LAB_VIEW = "adult_labevents"
LAB_COLUMNS = ["subject_id", "hadm_id", "icustay_id", "itemid", "charttime", "intime", "outtime",
               "value", "valuenum", "valueuom", "flag"]


def clinical_views(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Name -> DataFrame of the cohort view, the four restricted logs and the
    lab view, from the seven base tables (conformed to their schemas)."""
    cohort = build_cohort(tables["patients"], tables["icustays"])
    out = {"adult_stays": cohort}
    for name, (log, schema) in RESTRICTED.items():
        out[name] = restrict(tables[log], cohort, "subject_id").select(*schema.names)
    out[LAB_VIEW] = interval_join(
        tables["labevents"], tables["icustays"], on="hadm_id", ts="charttime",
        tolerance_seconds=dic.STAY_TOLERANCE_SECONDS,
        span_columns=["icustay_id"], by_key=True).select(*LAB_COLUMNS)
    return out


def register_clinical_views(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    """Register them as temp views; returns their names."""
    views = clinical_views(tables)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
