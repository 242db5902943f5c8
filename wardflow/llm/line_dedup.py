"""Line dedup by overlapping three-line windows.

Every three consecutive lines that hold a word are hashed together; windows
that occur twice or more anywhere keep their first occurrence (smallest
document id, then position), and the lines covered by later occurrences are
removed, overlapping windows merged.  DataFrame functions only: one exploded
row of two hashes and a position per window, counted with partial
aggregation, and an equality join back whose hot windows Spark splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import cut, packed, unpacked

WINDOW = 3
#: A character of a word, and a line from its first such character on.
WORD = r"[^ \t\n\x0B\f\r]"
LINE_WITH_WORD = WORD + r"[^\n]*"
RESULTS = ("__n_lines", "__n_removed")


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _windows(docs: DataFrame) -> DataFrame:
    """(id, hash, w, h1, h2): one row per window of (id, text); w counts lines
    with words.  A line is hashed once by each of two functions, a window's
    hashes come from those of its lines."""
    lines = F.filter(_lines(F.col("text")), lambda x: x.rlike(WORD))
    base = docs.where(F.col("text").contains("\n")).select(
        "id", F.xxhash64("text").alias("hash"),
        F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("a"), F.hash(x).alias("b"))).alias("hs"))
    base = base.where(F.size("hs") >= WINDOW)
    at = F.transform(F.sequence(F.lit(0), F.size("hs") - WINDOW), lambda w: F.struct(
        w.alias("w"), F.xxhash64(F.slice("hs", w + 1, WINDOW)).alias("h1"), F.hash(F.slice("hs", w + 1, WINDOW)).alias("h2")))
    return base.select("id", "hash", F.explode(at).alias("x")).select("id", "hash", "x.*")


def _removed_lines(docs: DataFrame) -> DataFrame:
    """(id, hash, covered): per document of (id, text) that loses lines, the
    positions, among its lines with words, that later occurrences cover."""
    windows = cut(_windows(docs))
    place = F.struct(F.col("id").isNull().alias("z"), "id", "hash", "w")
    met = (windows.groupBy("h1", "h2")
           .agg(F.count("*").alias("n"), F.min(place).alias("first"), F.max(place).alias("last"))
           # copies of one row meet at one place: that is no second occurrence
           .where("n > 1 and first <> last").select("h1", "h2", "first"))
    later = windows.join(cut(met), ["h1", "h2"]).where(place != F.col("first"))
    # one row per document and position before the positions meet: copies of a row do not add to the list
    spots = later.groupBy("id", "hash", "w").agg(F.count("*").alias("n"))
    covered = F.flatten(F.transform(F.collect_list("w"), lambda w: F.sequence(w, w + (WINDOW - 1))))
    return spots.groupBy("id", "hash").agg(F.array_distinct(covered).alias("covered"))


def without_repeated_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with the text's repeated lines removed, plus ``__n_lines``
    (lines with a word before) and ``__n_removed``.

    Lines without a word never count as part of a window and stay.  A line
    goes if any later occurrence of a repeated window covers it, also where
    a window overlaps itself or the first occurrence of another.  Rows that
    agree in id and text count as one document: each keeps what it keeps;
    equal ids with different texts are different documents, the smaller text
    hash first; null ids come after all others.  Null texts and texts of
    fewer than three lines stay as they are.  Whole texts of any length are
    read.  An empty table gives an empty result; other columns are carried
    along whatever their names, but the two that are added are an error.
    """
    if set(RESULTS) & set(df.columns):
        raise ValueError(f"columns {RESULTS} are added by this operator")
    docs = packed(df, id=id_col, text=text_col)
    gone = _removed_lines(docs.select("id", "text")).withColumnsRenamed({"id": "gone_id", "hash": "gone_hash"})
    joined = docs.join(gone, F.col("id").eqNullSafe(F.col("gone_id")) & (F.xxhash64("text") == F.col("gone_hash")), "left")
    joined = joined.withColumn("lines", F.when(F.col("covered").isNotNull(), _lines(F.col("text"))))
    pairs = F.transform("lines", lambda x, i: F.struct(i.alias("i"), x.rlike(WORD).alias("word")))
    joined = joined.withColumn("at", F.transform(F.filter(pairs, lambda p: p["word"]), lambda p: p["i"]))
    drop = F.transform("covered", lambda w: F.get("at", w))
    joined = joined.withColumn("stay", F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), drop))
    rest = F.array_join(F.transform("stay", lambda i: F.get("lines", i)), "\n")
    out = joined.select(
        "__row", "id", F.when(F.col("covered").isNull(), F.col("text")).otherwise(rest).alias("text"),
        F.coalesce(F.regexp_count("text", F.lit(LINE_WITH_WORD)), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("covered"), F.lit(0)).cast("long").alias("n_removed"))
    return out.select(*unpacked(out, df.columns, id=id_col, text=text_col),
                      F.col("n_lines").alias("__n_lines"), F.col("n_removed").alias("__n_removed"))
