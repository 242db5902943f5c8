"""Windowed means, daily totals, the daily lookup, crosstab pivots and
dictionary statistics (D1, D3, D6, D8, C5, B10, B11, U1).

Every aggregation here is an ordinary ``groupBy`` so Spark runs a partial
(map-side) aggregate before the shuffle.  Grouping keys always include the
window index next to the stay id, so one very long or very busy stay is
spread over as many tasks as it has windows instead of landing in one.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardflow.functions.timecols import window_column
from wardflow.sources.dictionary import FEATURE_COLUMNS

DAILY_VALUE = "urine_output_per_24hrs"


def window_means(windowed: DataFrame, window_hours: int, stay: str = "icustay_id") -> DataFrame:
    """D3 in long form: ``avg(valuenum)`` per (stay, window, category) over
    strictly positive values (B10); the category is lower-cased (B11)."""
    tw = window_column(window_hours)
    return (windowed.where(F.col("valuenum") > 0)
            .groupBy(stay, F.col(tw).alias("tw_hour_idx"), "itemcat")
            .agg(F.avg("valuenum").alias("valuenum"))
            .select(stay, "tw_hour_idx", F.lower("itemcat").alias("category"), "valuenum"))


def daily_total(windowed: DataFrame, category: str = "urine", stay: str = "icustay_id",
                value_name: str = DAILY_VALUE) -> DataFrame:
    """Per (stay, 24-h window) total of one category."""
    return (windowed.where(F.lower("itemcat") == category)
            .groupBy(stay, "tw_24hr").agg(F.sum("valuenum").alias(value_name)))


def day_of_window(tw: Column, window_hours: int, day_index: str = "as_written") -> Column | None:
    """The 24-h window a ``window_hours`` window reads its daily value from.

    ``as_written`` is the reference text: ``floor(tw * w / 24) + 1`` (Q9), and
    no day at all for w = 24, where the text compares the daily table's own
    column with itself (Q10).  ``aligned`` is ``floor((tw - 1) * w / 24) + 1``.
    """
    if day_index == "as_written":
        if window_hours == 24:
            return None
        return (F.floor(tw * F.lit(window_hours) / F.lit(24)) + 1).cast("double")
    if day_index == "aligned":
        return (F.floor((tw - 1) * F.lit(window_hours) / F.lit(24)) + 1).cast("double")
    raise ValueError("day_index must be 'as_written' or 'aligned'")


def lookup_daily(rows: DataFrame, daily: DataFrame, window_hours: int, value_name: str = "daily",
                 day_index: str = "as_written", stay: str = "icustay_id",
                 tw: str = "tw_hour_idx") -> DataFrame:
    """The correlated scalar lookup ``(SELECT total * w / 24 FROM daily
    WHERE stay = .. AND tw_24hr = day(tw))`` decorrelated into a left join on
    (stay, day) after aggregation; no match gives NULL.  (stay, tw_24hr) is
    unique in ``daily``, so the join never duplicates rows."""
    day = day_of_window(F.col(tw), window_hours, day_index)
    if day is None:
        return rows.withColumn(value_name, F.lit(None).cast("double"))
    d = daily.select(F.col(stay).alias("__d_stay"), F.col("tw_24hr").alias("__d_day"),
                     (F.col(DAILY_VALUE) * F.lit(window_hours) / F.lit(24)).alias(value_name))
    r = rows.withColumn("__day", day)
    return (r.join(d, (r[stay] == d["__d_stay"]) & (r["__day"] == d["__d_day"]), "left")
             .drop("__d_stay", "__d_day", "__day"))


def pivot_features(windowed: DataFrame, window_hours: int, categories=FEATURE_COLUMNS,
                   daily_category: str = "urine", day_index: str = "as_written",
                   stay: str = "icustay_id", daily: DataFrame | None = None,
                   binding: list[tuple[str, str]] | None = None) -> DataFrame:
    """U1 (D3 + C5 + D6) for every stay at once, reading the rows once.

    1. One ``groupBy(stay, window)`` (partial aggregate before its shuffle)
       computes a conditional mean per category over strictly positive
       values (B10), whether the window has any positive value (a window
       without one has no row, as in the reference), and the window's share
       of the daily total (all values >= 0 of the daily category).
    2. Every window size divides 24 h, so a window lies inside exactly one
       24-h window, ``day = floor((tw - 1) * w / 24) + 1``.  The daily total
       of that day and of the next one are range-framed window sums over the
       stay's window rows ordered by ``day`` (frames [0, 0] and [1, 1]); the
       lookup (C5) picks the day the reference text asks for.  These windows
       are partitioned by stay, like the LOCF that follows, so the second
       and last shuffle moves aggregated window rows only.

    A window whose positive rows all fall outside ``categories`` still
    yields a row of NULLs, as crosstab does.  The daily category's value is
    present only where the window holds a positive reading of it.  Passing
    ``daily`` (a (stay, tw_24hr, total) table) uses the join form instead.
    ``binding`` ((category, column) pairs, e.g.
    ``dictionary.positional_binding()``) places each category's value in
    another column, as crosstab's positional binding does (Q1).
    """
    if binding is not None:
        categories = [c for c, _ in binding]
    tw = window_column(window_hours)
    cat = F.lower("itemcat")
    v = F.col("valuenum")
    pos = v > 0
    aggs = [F.avg(F.when(pos & (cat == c), v)).alias(f"__c_{c}")
            for c in categories if c != daily_category]
    aggs.append(F.max(F.when(pos, F.lit(1))).alias("__any_pos"))
    has_daily = daily_category in categories
    want_day = (day_of_window(F.col("tw_hour_idx"), window_hours, day_index)
                if has_daily else None)
    if has_daily:
        aggs.append(F.max(F.when(pos & (cat == daily_category), F.lit(1))).alias("__has_daily"))
    inline = want_day is not None and daily is None
    if inline:
        aggs.append(F.sum(F.when(cat == daily_category, v)).alias("__daily_part"))
    agg = windowed.groupBy(stay, F.col(tw).alias("tw_hour_idx")).agg(*aggs)
    if inline:
        day = (F.floor((F.col("tw_hour_idx") - 1) * F.lit(window_hours) / F.lit(24)) + 1)
        agg = agg.withColumn("__day", day.cast("double"))
        by_day = W.partitionBy(stay).orderBy("__day")
        this_day = F.sum("__daily_part").over(by_day.rangeBetween(0, 0))
        next_day = F.sum("__daily_part").over(by_day.rangeBetween(1, 1))
        agg = agg.withColumn(
            "__daily",
            F.when(want_day == F.col("__day"), this_day * F.lit(window_hours) / F.lit(24))
             .when(want_day == F.col("__day") + 1, next_day * F.lit(window_hours) / F.lit(24)))
    wide = agg.where(F.col("__any_pos") == 1)
    if has_daily:
        if want_day is None:
            wide = wide.withColumn("__daily", F.lit(None).cast("double"))
        elif not inline:
            wide = lookup_daily(wide, daily, window_hours, "__daily", day_index, stay)
        wide = wide.withColumn(f"__c_{daily_category}",
                               F.when(F.col("__has_daily") == 1, F.col("__daily")))
    pairs = binding if binding is not None else [(c, c) for c in categories]
    return wide.select(stay, "tw_hour_idx", *[F.col(f"__c_{c}").alias(n) for c, n in pairs])


def crosstab(df: DataFrame, row_keys: list[str], category: str, value: str,
             categories: list[str], out_names: list[str] | None = None,
             positional: bool = False, collation: str = "C", key=None) -> DataFrame:
    """One row per row key, one column per category.

    By default category ``categories[i]`` fills column ``out_names[i]``.
    ``positional=True`` reproduces crosstab's binding (Q1): the categories
    are sorted (the category query's ORDER BY, under ``collation``) and the
    i-th sorted category fills the i-th output column, whatever its name.
    Unlisted categories are ignored; a row whose categories all miss is
    still emitted with NULLs.  ``key`` maps a listed category to the value
    stored in the data (e.g. ``str.lower`` for an ORDER BY on the original
    spelling of lower-cased categories).
    """
    out_names = list(out_names or categories)
    if len(out_names) != len(categories):
        raise ValueError("need one output name per category")
    cats = sort_categories(categories, collation) if positional else list(categories)
    key = key or (lambda c: c)
    aggs = [F.max(F.when(F.col(category) == F.lit(key(c)), F.col(value))).alias(n)
            for c, n in zip(cats, out_names)]
    return df.groupBy(*row_keys).agg(*aggs)


def sort_categories(categories, collation: str = "C") -> list[str]:
    """ORDER BY of the category query: byte order (``C``) or a
    case- and punctuation-insensitive first level (``en_US``)."""
    if collation == "C":
        return sorted(categories, key=lambda s: s.encode("utf-8"))
    if collation == "en_US":
        return sorted(categories, key=lambda s: (re.sub(r"[^0-9a-z]", "", s.lower()), s))
    raise ValueError("collation must be 'C' or 'en_US'")


def _join_groups(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join of rows to one row per group on the group keys; NULL is a
    group like any other."""
    g = groups.withColumnsRenamed({k: f"__g_{k}" for k in keys})
    cond = [F.col(k).eqNullSafe(F.col(f"__g_{k}")) for k in keys]
    return rows.join(g, cond).drop(*[f"__g_{k}" for k in keys])


def exact_percentile(df: DataFrame, keys: list[str], value: str, p: float = 0.5,
                     accuracy: int = 100_000, alias: str = "median_value",
                     reuse_input: bool = True) -> DataFrame:
    """Exact ``percentile_cont(p)`` per group without gathering a group.

    1. One mergeable quantile sketch per group is read at fractions around
       ``p``: ``p -/+ 2/accuracy`` and ever wider ones, out to 0 and 1.  The
       narrowest pair that leaves two ranks of slack at the group's size
       gives a value band that holds the two order statistics
       ``percentile_cont`` interpolates between: about 4 n / accuracy rows.
    2. One pass counts the rows below the band and the band's rows by value
       (partial aggregation first), and a running sum ranks the band.

    If a wanted rank lay outside its band (a sketch beyond its error bound)
    the query fails instead of answering.  A NULL group is a group; NULL
    values are ignored, and a group of nothing else has no row.  A group
    holding a large share of all rows is never sent to one task: only its
    band's distinct values meet in a window.
    """
    x = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("__v"))
    if reuse_input:
        # two passes read the (group, value) pairs: compute them once
        from wardflow.sources.materialize import cut_lineage
        x = cut_lineage(x)
    widths = [2.0 / accuracy * 4 ** j for j in range(32) if 2.0 / accuracy * 4 ** j < 1.0] + [1.0]
    fractions = [max(p - e, 0.0) for e in widths] + [min(p + e, 1.0) for e in widths]
    n = F.col("__n")
    # narrowest width whose slack, beyond the sketch's own error, is two ranks
    level = F.lit(len(widths))
    for j, e in reversed(list(enumerate(widths))):
        level = F.when((e - 1.0 / accuracy) * n >= 2.0, F.lit(j + 1)).otherwise(level)
    rank = (n - 1) * F.lit(float(p))
    sketch = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"),
                                  F.percentile_approx("__v", fractions, accuracy).alias("__q"))
    band = sketch.select(*keys, F.element_at("__q", level).alias("__lo"),
                         F.element_at("__q", level + len(widths)).alias("__hi"),
                         F.floor(rank).alias("__r_lo"), F.ceil(rank).alias("__r_hi"),
                         (rank - F.floor(rank)).alias("__frac"))
    v = F.col("__v")
    j = (_join_groups(x, band, keys).where(v <= F.col("__hi"))
         .select(*keys, F.when(v >= F.col("__lo"), v).alias("__v"), "__r_lo", "__r_hi", "__frac"))
    # the rows below the band are the NULL value of their group
    by_value = j.groupBy(*keys, "__v", "__r_lo", "__r_hi", "__frac").agg(F.count(F.lit(1)).alias("__c"))
    w = (W.partitionBy(*keys).orderBy(F.col("__v").asc_nulls_first())
         .rowsBetween(W.unboundedPreceding, W.currentRow))
    cum, inside = F.col("__cum"), F.col("__v").isNotNull()
    sel = by_value.withColumn("__cum", F.sum("__c").over(w)).groupBy(*keys).agg(
        F.min(F.when(inside & (cum > F.col("__r_lo")), F.col("__v"))).alias("__x_lo"),
        F.min(F.when(inside & (cum > F.col("__r_hi")), F.col("__v"))).alias("__x_hi"),
        F.coalesce(F.max(F.when(~inside, cum)), F.lit(0)).alias("__below"),
        F.max("__r_lo").alias("__r_lo"), F.max("__frac").alias("__frac"))
    missed = (F.col("__below") > F.col("__r_lo")) | F.col("__x_hi").isNull()
    outside = F.raise_error(F.lit("percentile rank outside its sketch band")).cast("double")
    return sel.select(*keys, F.when(missed, outside).otherwise(
        F.col("__x_lo") + (F.col("__x_hi") - F.col("__x_lo")) * F.col("__frac")).alias(alias))


def dictionary_stats(long_rows: DataFrame, category: str = "itemcat", value: str = "valuenum",
                     accuracy: int = 100_000) -> DataFrame:
    """The dictionary's median and mean per category, computed from data
    (the (category, value) pairs are computed once and reused by every pass)."""
    from wardflow.sources.materialize import cut_lineage
    x = cut_lineage(long_rows.where(F.col(value).isNotNull())
                    .select(category, F.col(value).cast("double").alias(value)))
    med = exact_percentile(x, [category], value, 0.5, accuracy, reuse_input=False)
    mean = x.groupBy(category).agg(F.avg(value).alias("mean_value"),
                                   F.count(F.lit(1)).alias("n"))
    return _join_groups(mean, med, [category]).select(category, "median_value", "mean_value", "n")
