"""Mixing sources to target weights.

Sizes are summed per source, a target is set for each source, and a document
of a source with repetition rate ``target / size`` is emitted ``floor(rate)``
times plus once more if a hash-seeded draw in [0, 1) falls below the
fraction.  The draw depends on the document's id and text, and on a number
for each further row that repeats both, so reruns and retried tasks agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardflow.llm import common
from wardflow.llm.common import cut, join_small, packed, unpacked, words

DRAW_BITS = 52
#: If the per-source table is too large to broadcast, a source's rows are spread over so many join keys.
SALTS = 64
#: Rows that repeat a document are numbered in so many parts.
REPEAT_PARTS = 1024


def n_words(text: Column) -> Column:
    """Number of words of a text, a long (null: 0)."""
    return F.size(words(text)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, max_rate: float) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size), one
    row per source.

    Sources in code-point order, null last, get ``weights`` in turn and share
    ``share`` times the total in proportion.  A target stops at ``max_rate``
    times its source's size; the excess is shared anew among the others by
    weight until none is above.  Ranks and rounds are distributed: each round
    is one aggregate row.
    """
    spark = sizes.sparkSession
    ordered = cut(sizes.orderBy(F.col("source").asc_nulls_last()))
    ranked = cut(spark.createDataFrame(
        ordered.rdd.zipWithIndex().map(lambda x: (x[0][0], x[0][1], weights[x[1] % len(weights)])),
        "source string, source_size long, weight long"))
    stop = F.lit(max_rate) * F.col("source_size")
    level, capped = float("inf"), -1
    total, weight_sum = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    if weight_sum:
        level = share * total / weight_sum
    while weight_sum:
        above = F.lit(level) * F.col("weight") > stop
        n, size_above, weight_open = ranked.agg(
            F.count(F.when(above, 1)), F.coalesce(F.sum(F.when(above, F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0))).first()
        if n == capped:
            break
        capped = n
        level = (share * total - max_rate * size_above) / weight_open if weight_open else float("inf")
    return ranked.withColumn("target", F.least(stop, F.lit(level) * F.col("weight")))


def name(id_col: Column, text: Column) -> Column:
    """What tells a document from others: its id and its text's digest."""
    return F.concat_ws(":", F.coalesce(id_col.cast("string"), F.lit("~")), F.coalesce(F.md5(text), F.lit("~")))


def draw(name: Column, nth: Column, seed: str) -> Column:
    """A number in [0, 1) for the nth row (from 0) of a document's name."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), name, F.when(nth > 0, F.concat(F.lit(":"), nth.cast("string")))
                                        .otherwise(F.lit("")))), 1, DRAW_BITS // 4)
    return F.conv(digits, 16, 10).cast("long").cast("double") / F.lit(float(1 << DRAW_BITS))


def _numbered(df: DataFrame) -> DataFrame:
    """``df`` with ``__nth``: rows of one source that agree in ``__name`` are
    numbered from 0.  Rows are looked at again only where names repeat.  Each
    part of a name's rows is numbered by itself, after the rows of the parts
    before it, so that a row repeated very often is not sorted in one task."""
    keyed = df.withColumn("__key", F.md5(F.concat_ws("/", F.col("__name"), F.hex("__of_name"))))
    repeated = cut(keyed.groupBy("__key").count().where("count > 1").select("__key"))
    if repeated.isEmpty():
        return df.withColumn("__nth", F.lit(0).cast("long"))
    mark = repeated.withColumn("__again", F.lit(True))
    if common.measured_bytes(repeated) <= common.BROADCAST_BYTES:
        mark = F.broadcast(mark)
    marked = keyed.join(mark, "__key", "left")
    again = cut(marked.where("__again").withColumn("__at", F.monotonically_increasing_id()))
    part = F.pmod(F.col("__at"), F.lit(REPEAT_PARTS))
    again = again.withColumn("__part", part)
    before = Window.partitionBy("__key").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = again.groupBy("__key", "__part").count().select(
        "__key", "__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__start"))
    inside = F.row_number().over(Window.partitionBy("__key", "__part").orderBy("__at")) - 1
    numbered = again.withColumn("__inside", inside).join(starts, ["__key", "__part"])
    return (marked.where("__again is null").select(*df.columns, F.lit(0).cast("long").alias("__nth"))
            .unionByName(numbered.select(*df.columns, (F.col("__start") + F.col("__inside")).alias("__nth"))))


def _with_targets(df: DataFrame, targets: DataFrame, source: Column) -> DataFrame:
    """Join rows to their source's target without gathering a hot source."""
    same = source.eqNullSafe(F.col("__source"))
    if common.measured_bytes(targets) <= common.BROADCAST_BYTES:
        return df.join(F.broadcast(targets), same)
    salted = targets.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    dealt = df.withColumn("__deal", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    return dealt.join(salted, same & (F.col("__deal") == F.col("__salt"))).drop("__deal", "__salt")


def with_copies(df: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, max_rate: float = 2.0,
                seed: str = "mix", id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source") -> DataFrame:
    """``df`` with ``__size``, ``__source_size``, ``__target`` and ``__copies``.

    Size is the number of words (null text: 0).  Null sources are one source,
    the last.  Documents of a source without words get no copies.  Rows that
    repeat a document draw each for itself, and so do texts that share an id;
    ties cannot occur.  Whole texts of any length are read; other columns are
    carried along whatever their names, except that a column of one of the
    four names is refused.  An empty table gives an empty result.
    """
    made = ["__size", "__source_size", "__target", "__copies"]
    if clash := set(made) & set(df.columns):
        raise ValueError(f"columns {sorted(clash)} would be overwritten")
    own = {"__id": id_col, "__text": text_col, "__of": source_col}
    rows = packed(df, **own).withColumn("__of_name", F.col("__of").cast("string"))
    sizes = rows.groupBy(F.col("__of_name").alias("source")).agg(F.sum(n_words(F.col("__text"))).alias("source_size"))
    t = source_targets(sizes, weights, share, max_rate).select(
        F.col("source").alias("__source"), F.col("source_size").alias("__source_size"), F.col("target").alias("__target"))
    named = _numbered(rows.withColumn("__name", name(F.col("__id"), F.col("__text"))))
    rate = F.when(F.col("__source_size") > 0, F.col("__target") / F.col("__source_size")).otherwise(F.lit(0.0))
    more = draw(F.col("__name"), F.col("__nth"), seed) < rate - F.floor(rate)
    out = _with_targets(named, t, F.col("__of_name")).withColumns(
        {"__size": n_words(F.col("__text")), "__copies": F.floor(rate) + more.cast("long")})
    return out.select(*unpacked(out, df.columns, **own), *made)


def mixed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: every row of ``df`` as often as it has copies, columns
    unchanged, whatever their names.  Other cases as in ``with_copies``."""
    own = {"id": id_col, "text": text_col, "source": source_col}
    repeated = with_copies(packed(df, **own), id_col="id", text_col="text", source_col="source", **options).where("__copies > 0")
    out = repeated.withColumn("__copy", F.explode(F.expr("sequence(1L, __copies)")))
    return out.select(*unpacked(out, df.columns, **own))
