"""Assembled plans: the windowed long table (pre-processing, entry point 2)
and the per-window feature rows (table functions U1-U5, entry point 1).

The reference computes one stay per call and re-derives the pivot three
times per call; here one lazy plan covers every stay, the pivot is built
once, and mask / imputation / score are columns of the same rows (C7 needs
no join).  Shuffles on the main path: the partial-aggregate pivot on
(stay, window), then one exchange on stay that serves both the daily lookup
windows and the LOCF window (over pivot rows only).  Over a table bucketed
by stay there is no exchange at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.functions import steps
from wardflow.functions.bloom import maybe_in
from wardflow.functions.timecols import add_windows
from wardflow.operators import harmonize as hz
from wardflow.operators.aggregate import daily_total, pivot_features
from wardflow.operators.cohort import build_cohort, restrict
from wardflow.operators.impute import attach_defaults, impute, imputed_sql, locf_sources, mask, mask_sql, with_locf
from wardflow.operators.intervals import interval_join
from wardflow.sources import dictionary as dic

KEYS = ["icustay_id", "tw_hour_idx"]


# --- entry point 2: the windowed long table ---------------------------------

def windowed_features(long_rows: DataFrame, cohort: DataFrame,
                      tolerance_seconds: float = dic.STAY_TOLERANCE_SECONDS,
                      hours=(1, 3, 6, 12, 24), salt: int = 1, by_key: bool = False) -> DataFrame:
    """C4 + E3 + E4: attach the cohort's stay times by (subject, admission)
    within the tolerance, keep ``valuenum >= 0`` and add the window columns.
    The event keeps its own stay id (Q19).  ``salt`` splits hot admissions
    explicitly, ``by_key`` is for admissions of few stays (see ``interval_join``)."""
    j = interval_join(long_rows, cohort, on=["subject_id", "hadm_id"], ts="charttime",
                      tolerance_seconds=tolerance_seconds, salt=salt, by_key=by_key)
    j = j.where(F.col("valuenum") >= 0)
    return add_windows(j, "charttime", "intime", hours)


def long_features(patients, icustays, chartevents, labevents, outputevents, inputevents_cv,
                  inputevents_mv, temp_category: str = "Temperature",
                  materialize_cohort: bool = True, bloom_bits: int | None = None) -> tuple[DataFrame, DataFrame]:
    """§3.2 steps 1-5 over the clinical schema: returns (cohort, long rows).

    Every log is scanned once, the chart log twice (its narrow rows and the
    GCS rows that go on to an aggregate, by disjoint code filters).
    The cohort feeds the semi joins and the windowed join; like the
    reference's materialised cohort it is written once as a parquet table in
    ``spark.checkpoint.dir`` (its file size then guides join planning)
    instead of being recomputed per use.  ``bloom_bits`` tests every log
    against a Bloom filter of the cohort's subjects as it is scanned (see
    ``cohort.restrict``)."""
    cohort = build_cohort(patients, icustays)
    if materialize_cohort:
        from wardflow.sources.materialize import materialize
        cohort = materialize(cohort, "cohort")
    chart = maybe_in(chartevents, cohort, ["subject_id"], bloom_bits) if bloom_bits else chartevents
    cv = restrict(inputevents_cv, cohort, "subject_id", bloom_bits=bloom_bits)
    mv = restrict(inputevents_mv, cohort, "subject_id", bloom_bits=bloom_bits)
    labs = hz.labs_with_stays(labevents, restrict(icustays, cohort, "hadm_id"))
    branches = [
        hz.chart_branches(chart, cohort, temp_category, subjects=cohort),
        hz.lab_branch(labs),
        hz.gcs_branch(restrict(chart, cohort, "subject_id")),
        hz.infusion_branch(cv, dic.CV_CODES, "charttime"),
        hz.infusion_branch(mv, dic.MV_CODES, "starttime"),
        hz.urine_branch(outputevents, cohort),
    ]
    return cohort, hz.union_all(branches)


# --- entry point 1: feature rows ---------------------------------------------

def pivot(windowed: DataFrame, window_hours: int, stay_id=None, day_index: str = "as_written",
          categories=dic.FEATURE_COLUMNS, binding=None, daily_join: bool = False) -> DataFrame:
    """U1 for all stays (or one, filtered before any shuffle); ``binding``
    (e.g. ``dictionary.positional_binding()``) reproduces crosstab's
    positional column binding (Q1).  ``daily_join`` looks the daily totals up
    by a join on (stay, day) instead of windows over a stay."""
    if stay_id is not None:
        windowed = windowed.where(F.col("icustay_id") == stay_id)
    return pivot_features(windowed, window_hours, categories, "urine", day_index,
                          daily=daily_total(windowed, "urine") if daily_join else None, binding=binding)


def assemble(pv: DataFrame, window_hours: int, spec=dic.DEFAULT_SPEC, defaults=None,
             with_parts: bool = False, block: int | None = None) -> DataFrame:
    """U2 + U3 + U4 + U5 as columns over one pivot: masks from the raw
    values, LOCF/default values, and the score from the imputed values.
    Built as two SQL projections (one Window node for every LOCF column);
    with ``block`` the LOCF runs in blocks of so many windows."""
    if block:
        pv = with_locf(pv, locf_sources(spec), block=block)
    pv, values = attach_defaults(pv, defaults, spec)
    imp = imputed_sql(spec, values, filled="__locf_" if block else None)
    masks = mask_sql(dic.FEATURE_COLUMNS, "m_")
    step1 = pv.selectExpr(*[f"`{k}`" for k in KEYS], *[f"{e} AS `{n}`" for n, e in imp.items()],
                          *[f"{e} AS `{n}`" for n, e in masks.items()])
    parts = steps.score_parts_sql(window_hours)
    extra = [f"{e} AS `{n}`" for n, e in parts.items()] if with_parts else []
    return step1.selectExpr(*[f"`{k}`" for k in KEYS],
                            f"{steps.total_score_sql(window_hours)} AS total_sofa_score",
                            *[f"`{c}`" for c in dic.FEATURE_COLUMNS],
                            *[f"`{m}`" for m in masks], *extra)


def features(windowed: DataFrame, window_hours: int, stay_id=None, spec=dic.DEFAULT_SPEC,
             defaults=None, day_index: str = "as_written", binding=None, block: int | None = None) -> DataFrame:
    """(stay, window, score, 24 values, 24 masks) for every stay.  With
    ``block`` no step gathers a stay: the daily totals are joined by (stay,
    day) and the LOCF runs in blocks of so many windows.  The
    reference text exactly: ``spec=dictionary.as_written_spec(),
    binding=dictionary.positional_binding("en_US")`` and a long table built
    with ``long_features(..., temp_category="TEMP")``."""
    return assemble(pivot(windowed, window_hours, stay_id, day_index, binding=binding, daily_join=bool(block)),
                    window_hours, spec, defaults, block=block)


def imputed(windowed: DataFrame, window_hours: int, spec=dic.DEFAULT_SPEC, defaults=None,
            day_index: str = "as_written") -> DataFrame:
    """U2."""
    return impute(pivot(windowed, window_hours, day_index=day_index), spec, defaults)


def masks(windowed: DataFrame, window_hours: int, day_index: str = "as_written") -> DataFrame:
    """U4 (pivot names, like the reference's mask function)."""
    return mask(pivot(windowed, window_hours, day_index=day_index))


def scores(windowed: DataFrame, window_hours: int, spec=dic.DEFAULT_SPEC, defaults=None,
           day_index: str = "as_written", with_parts: bool = False) -> DataFrame:
    """(stay, window, total score) [+ the seven parts]."""
    f = assemble(pivot(windowed, window_hours, day_index=day_index), window_hours, spec,
                 defaults, with_parts)
    parts = list(steps.SCORE_PARTS) if with_parts else []
    return f.select(*KEYS, "total_sofa_score", *parts)


def daily(windowed: DataFrame) -> DataFrame:
    """The daily urine relation (built after the windowed table, Q17)."""
    return daily_total(windowed, "urine")


def join_parts(values: DataFrame, masks_df: DataFrame, score: DataFrame,
               keys=("icustay_id", "tw_hour_idx"), mask_prefix: str = "m_") -> DataFrame:
    """C7 join form for parts computed elsewhere: score ⋈ mask ⋈ values on
    (stay, window) -> the 50-column row.  When all three come from one
    pivot, ``assemble`` gives the same rows without any join."""
    keys = list(keys)
    m = masks_df.select(*keys, *[F.col(c).alias(f"{mask_prefix}{c}")
                                 for c in masks_df.columns if c not in keys])
    out = score.select(*keys, "total_sofa_score").join(m, keys).join(values, keys)
    return out.select(*keys, "total_sofa_score", *dic.FEATURE_COLUMNS,
                      *[f"{mask_prefix}{c}" for c in dic.FEATURE_COLUMNS])
