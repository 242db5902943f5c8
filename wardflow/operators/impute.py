"""LOCF, imputation with defaults and missingness masks.

All LOCF columns share one WindowSpec, so Spark plans a single Window node
(one sort per stay partition) however many columns are imputed.  A stay's
partition holds one row per window of that stay (the pivot output), never
its raw events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardflow.sources import dictionary as dic


_SPECS: dict = {}


def locf_window(partition: str | list[str] = "icustay_id", order: str = "tw_hour_idx"):
    """The one WindowSpec every LOCF column shares (built once per key)."""
    part = (partition,) if isinstance(partition, str) else tuple(partition)
    key = (part, order)
    if key not in _SPECS:
        _SPECS[key] = (W.partitionBy(*part).orderBy(order)
                       .rowsBetween(W.unboundedPreceding, W.currentRow))
    return _SPECS[key]


def locf(col: str | Column, partition="icustay_id", order: str = "tw_hour_idx") -> Column:
    """Last non-null value at or before the current row."""
    c = F.col(col) if isinstance(col, str) else col
    return F.last(c, ignorenulls=True).over(locf_window(partition, order))


def locf_sql(col: str, partition="icustay_id", order: str = "tw_hour_idx") -> str:
    """E1 as SQL text (same frame as ``locf``)."""
    part = [partition] if isinstance(partition, str) else list(partition)
    by = ", ".join(f"`{p}`" for p in part)
    return (f"last(`{col}`, true) OVER (PARTITION BY {by} ORDER BY `{order}` "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")


#: Windows of one block of a stay in ``with_locf``.
BLOCK_WINDOWS = 256


def with_locf(df: DataFrame, cols: list[str], partition="icustay_id", order: str = "tw_hour_idx",
              block: int = BLOCK_WINDOWS, prefix: str = "__locf_") -> DataFrame:
    """E1 in blocks: ``df`` with ``prefix + c``, the last non-null value of ``c``
    at or before the row, for every c of ``cols``.

    A stay's rows are cut into blocks of ``block`` values of the (numeric)
    order column.  Each block's last values come from a partial aggregate,
    what reaches a block from those before it is carried over one row per
    block, and enters the block as a row before its first; the scan then runs
    inside blocks.  So a stay with a large share of all rows is spread over
    its blocks.  Rows whose order is NULL come first in their stay, as in a
    window; equal orders within a stay are not expected.
    """
    keys = [partition] if isinstance(partition, str) else list(partition)
    by = [*keys, "__block"]
    rows = df.withColumn("__block", F.coalesce(F.floor(F.col(order) / block), F.lit(-(1 << 62))))
    ends = rows.groupBy(*by).agg(*[F.max(F.when(F.col(c).isNotNull(), F.struct(order, c))).alias(f"{prefix}{c}") for c in cols])
    before = W.partitionBy(*keys).orderBy("__block").rowsBetween(W.unboundedPreceding, -1)
    carried = ends.select(*by, *[F.last(F.col(f"{prefix}{c}")[c], ignorenulls=True).over(before).alias(f"{prefix}{c}")
                                 for c in cols], F.lit(0).alias("__row"))
    both = rows.select("*", *[F.col(c).alias(f"{prefix}{c}") for c in cols], F.lit(1).alias("__row")).unionByName(
        carried, allowMissingColumns=True)
    here = W.partitionBy(*by).orderBy("__row", order).rowsBetween(W.unboundedPreceding, W.currentRow)
    filled = both.select(*df.columns, "__row", *[F.last(f"{prefix}{c}", ignorenulls=True).over(here).alias(f"{prefix}{c}")
                                                 for c in cols])
    return filled.where("__row = 1").drop("__row")


def locf_sources(spec=dic.DEFAULT_SPEC) -> list[str]:
    """The columns that a spec carries forward."""
    return list(dict.fromkeys(s.source for s in spec if s.impute != "raw"))


def imputed_sql(spec=dic.DEFAULT_SPEC, defaults: dict[str, str] | None = None,
                partition="icustay_id", order: str = "tw_hour_idx", filled: str | None = None) -> dict[str, str]:
    """E2 as SQL text: per spec row ``coalesce(locf(source), default)``, 0 or
    raw.  Every LOCF shares one window definition, so Spark plans one Window
    node for all of them.  ``defaults`` maps a category to the SQL text of
    its default (see ``attach_defaults``).  ``filled`` is the prefix of columns
    that hold the carried values already (see ``with_locf``)."""
    defaults = defaults if defaults is not None else literal_defaults(None)

    def carried(source):
        return f"`{filled}{source}`" if filled else locf_sql(source, partition, order)
    out = {}
    for s in spec:
        if s.impute == "raw":
            out[s.name] = f"`{s.source}`"
        elif s.impute == "locf_zero":
            out[s.name] = f"coalesce({carried(s.source)}, 0.0D)"
        elif s.impute == "locf_default":
            d = defaults.get(s.default)
            out[s.name] = carried(s.source) if d is None else f"coalesce({carried(s.source)}, {d})"
        else:
            raise ValueError(f"unknown impute mode {s.impute!r}")
    return out


def mask_sql(cols=dic.FEATURE_COLUMNS, prefix: str = "m_") -> dict[str, str]:
    """B13 as SQL text."""
    return {f"{prefix}{c}": f"CAST(`{c}` IS NOT NULL AS INT)" for c in cols}


def literal_defaults(dictionary: dict | None = None) -> dict[str, str]:
    """C6 for a fixed dictionary: lower(category) -> SQL literal of its median."""
    if dictionary is None:
        dictionary = {cat: med for _, cat, med, _, _ in dic.FEATURE_ROWS}
    return {k.lower(): f"CAST('{float(v)!r}' AS DOUBLE)" for k, v in dictionary.items() if v is not None}


def attach_defaults(pivot: DataFrame, dictionary: DataFrame | dict | None = None,
                    spec=dic.DEFAULT_SPEC) -> tuple[DataFrame, dict[str, str]]:
    """The pivot and the SQL text of each category's default.

    A dictionary table of any size becomes one scalar subquery: one partial
    aggregate over it yields a single row with the median of every category
    the spec names (an error where a category has two different medians),
    attached to the pivot as the struct column ``__defaults``.
    """
    if not isinstance(dictionary, DataFrame):
        return pivot, literal_defaults(dictionary)
    names = sorted({s.default for s in spec if s.impute == "locf_default" and s.default})

    def only(name):
        v = F.when(F.lower("item_cat") == name, F.col("median_value"))
        two = F.raise_error(F.lit(f"more than one median for category {name!r}")).cast("double")
        return F.when(F.min(v) < F.max(v), two).otherwise(F.max(v)).alias(name)

    row = dictionary.agg(F.struct(*[only(n) for n in names]).alias("d"))
    return (pivot.withColumn("__defaults", row.scalar()),
            {n: f"`__defaults`.`{n}`" for n in names})


def impute(pivot: DataFrame, spec=dic.DEFAULT_SPEC, defaults=None, partition="icustay_id",
           order: str = "tw_hour_idx", block: int | None = None) -> DataFrame:
    """The imputed wide table (LOCF then default); with ``block`` the LOCF
    runs in blocks of so many windows (``with_locf``), for stays that hold a
    large share of the rows."""
    if block:
        pivot = with_locf(pivot, locf_sources(spec), partition, order, block)
    pivot, values = attach_defaults(pivot, defaults, spec)
    keys = [partition] if isinstance(partition, str) else list(partition)
    cols = imputed_sql(spec, values, partition, order, "__locf_" if block else None)
    return pivot.selectExpr(*[f"`{k}`" for k in [*keys, order]], *[f"{e} AS `{n}`" for n, e in cols.items()])


def mask(pivot: DataFrame, cols=dic.FEATURE_COLUMNS, keys=("icustay_id", "tw_hour_idx"),
         prefix: str = "") -> DataFrame:
    """U4: the mask table (same column names as the pivot by default): 1
    where the raw (pre-imputation) value exists, else 0."""
    return pivot.selectExpr(*[f"`{k}`" for k in keys],
                            *[f"{e} AS `{n}`" for n, e in mask_sql(cols, prefix).items()])
