r"""Benchmark decontamination by normalised word windows.

Words are runs of ``[0-9a-z]`` and everything beyond ASCII, after A-Z are
lower-cased.  Every ten consecutive words of a benchmark item are a window;
an item of fewer words is one window.  The hashes of all item windows form a
set, a bit table of bounded size that goes to every task; a document's
windows are tested against it in place, in one pass over its words.  Only the
windows that pass leave the row, as text, and meet the item windows in an
equality join on the words themselves: that join verifies every hit.
DataFrame functions only; whole texts are never shuffled to be scanned.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import cut, join_small, lower_az, text_identity

WINDOW = 10
#: Characters that end a word, in lower-cased text and in any text.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bits of the table for each window, and the table's size in bits.  A table
#: that is too small for its windows lets more of them through to the join.
BITS_PER_WINDOW, LEAST_BITS, MOST_BITS = 64, 1 << 16, 1 << 26


def normal_words(text: Column) -> Column:
    """The normalised words of a text (null: none)."""
    return F.array_remove(F.split(lower_az(F.coalesce(text, F.lit(""))), GAP), "")


def item_windows(items: DataFrame, n: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(words, len, item): the distinct windows of every item, words joined by
    a space, the item's id as a string (null: empty).  Items without a word
    have none; rows that share an id are one item."""
    ws = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                      normal_words(F.col(text_col)).alias("ws")).where(F.size("ws") > 0)
    ws = ws.withColumn("len", F.least(F.size("ws"), F.lit(n)))
    at = ws.select("item", "len", "ws", F.explode(F.sequence(F.lit(1), F.size("ws") - F.col("len") + 1)).alias("at"))
    return at.select(F.array_join(F.slice("ws", F.col("at"), F.col("len")), " ").alias("words"), "len", "item").distinct()


def _window_hashes(hashes: Column, n: int) -> Column:
    """Hash of every n consecutive words, from the words' hashes."""
    last = F.size(hashes) - n + 1
    at = F.when(last > 0, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(F.slice(hashes, i, n)))


def _bit_table(windows: DataFrame, n_bits: int) -> DataFrame:
    """One row, one array of longs: the set of the windows' hashes."""
    hashes = F.transform(F.split("words", " "), lambda w: F.xxhash64(w))
    h = windows.select(F.xxhash64(hashes).alias("h"))
    cell = F.col("h").bitwiseAND(F.lit(n_bits - 1))
    parts = h.groupBy(F.floor(cell / 64).alias("cell")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (cell % 64).cast("int"))).alias("bits"))
    every = h.sparkSession.range(n_bits // 64).withColumnRenamed("id", "cell")
    full = every.join(parts, "cell", "left").select("cell", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    return full.agg(F.transform(F.array_sort(F.collect_list(F.struct("cell", "bits"))), lambda x: x["bits"]).alias("t"))


def _candidates(df: DataFrame, windows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(__id, __text_hash, n_words, found): per row of ``df`` its windows whose
    hash is in the table, as (at, len, words)."""
    lengths = [r["len"] for r in windows.select("len").distinct().collect()]  # WINDOW values at most
    base = df.select(*text_identity(df, id_col, text_col), normal_words(F.col(text_col)).alias("ws"))
    none = F.array().cast("array<struct<at:int,len:int,words:string>>")
    if lengths:
        n_bits = LEAST_BITS
        while n_bits < min(MOST_BITS, BITS_PER_WINDOW * windows.count()):
            n_bits *= 2
        base = base.withColumn("hs", F.transform("ws", lambda w: F.xxhash64(w)))
        table = _bit_table(windows, n_bits)
    for n in lengths:
        # referenced once, so Spark puts the subquery's array into the expression and not into every row
        base = base.withColumn(f"h{n}", _window_hashes(F.col("hs"), n)).withColumn("table", table.scalar())

        def passes(h):
            cell = h.bitwiseAND(F.lit(n_bits - 1))
            return F.bit_get(F.get(F.col("table"), F.floor(cell / 64).cast("int")), (cell % 64).cast("int")) == 1
        at = F.filter(F.transform(f"h{n}", lambda h, i: F.when(passes(h), i)), lambda i: i.isNotNull())
        base = base.withColumn(f"at{n}", at).drop("table", f"h{n}")

    def texts(n):
        return F.transform(f"at{n}", lambda i: F.struct(
            i.alias("at"), F.lit(n).alias("len"), F.array_join(F.slice("ws", i + 1, n), " ").alias("words")))
    return base.select("__id", "__text_hash", F.size("ws").cast("long").alias("n_words"),
                       F.concat(none, *[texts(n) for n in lengths]).alias("found"))


def hits(df: DataFrame, items: DataFrame, n: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
         item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(__id, __text_hash, n_words, covered, items): one row per row of ``df``;
    ``covered`` are the positions, among its words, that lie in an occurrence
    of an item's window, ascending, and ``items`` the ids, as strings in
    order, of the items with such a window.  Both are empty where nothing is hit.

    Null text has no words; null ids are a value like any other; rows that
    agree in id and text have the same hits; texts of any length are scanned
    whole.  Without items, or with items without words, nothing is hit; an
    empty table gives an empty result.  Other columns are not looked at.
    """
    windows = cut(item_windows(items, n, item_id, item_text))
    base = cut(_candidates(df, windows, id_col, text_col))
    key = ["__id", "__text_hash"]
    found = (base.where(F.size("found") > 0).select(*key, F.explode("found").alias("f"))
             .select(*key, "f.at", "f.len", "f.words"))
    # a place counts once, however many rows repeat the document
    met = cut(join_small(found.groupBy(*key, "at", "len", "words").agg(F.count("*").alias("n")),
                         windows.select("words").distinct(), "words"))
    reach = F.flatten(F.transform(F.collect_list(F.struct("at", "len")),
                                  lambda x: F.sequence(x["at"], x["at"] + x["len"] - 1)))
    places = met.groupBy(*key).agg(F.array_sort(F.array_distinct(reach)).alias("covered"))
    names = join_small(met.select(*key, "words").distinct(), windows.select("words", "item"), "words")
    listed = names.select(*key, "item").distinct().groupBy(*key).agg(F.array_sort(F.collect_list("item")).alias("items"))

    def same(right):
        return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{right}{k}")) for k in key])
    out = base.select(*key, "n_words")
    for side, rows in (("p", places), ("l", listed)):
        rows = rows.withColumnsRenamed({k: f"{side}{k}" for k in key})
        out = out.join(rows, same(side), "left").drop(*[f"{side}{k}" for k in key])
    return out.select(*key, "n_words", F.coalesce("covered", F.array().cast("array<int>")).alias("covered"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def _without(text: Column, covered: Column) -> Column:
    """A text without the covered words and what stands between two of them."""
    ws = F.array_remove(F.split(text, GAP_ANY_CASE), "")
    gaps = F.split(text, WORD_ANY_CASE)
    pieces = F.flatten(F.zip_with(ws, F.slice(gaps, 2, F.size(ws)), lambda w, g: F.array(w, g)))
    between = F.array_intersect(covered, F.transform(covered, lambda c: c - 1))
    gone = F.concat(F.transform(covered, lambda c: c * 2), F.transform(between, lambda c: c * 2 + 1))
    stay = F.array_except(F.sequence(F.lit(0), 2 * F.size(ws) - 1), gone)
    return F.concat(F.get(gaps, F.lit(0)), F.array_join(F.transform(stay, lambda i: F.get(pieces, i)), ""))


def decontaminated(df: DataFrame, items: DataFrame, n: int = WINDOW, max_share: float | None = 0.5,
                   id_col: str = "doc_id", text_col: str = "text", **item_columns) -> DataFrame:
    """``df``, columns unchanged, without what ``items`` share with it.

    Hit words go with what stands between them; a document of whose words
    more than ``max_share`` are hit goes as a whole (``None``: all stay,
    0.0: every contaminated one goes).  Rows without a hit, null texts among
    them, stay as they are.  Cases as in ``hits``; other columns are carried
    along whatever their names.
    """
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                       F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    hit = (hits(packed, items, n, "id", "text", **item_columns).where(F.size("covered") > 0)
           .groupBy("__id", "__text_hash").agg(F.first("covered").alias("covered"), F.first("n_words").alias("n_words")))
    if max_share is not None:
        hit = hit.withColumn("whole", F.size("covered") > F.lit(max_share) * F.col("n_words"))
    else:
        hit = hit.withColumn("whole", F.lit(False))
    at = F.col("id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__text_hash"))
    joined = packed.join(hit, at, "left").where(~F.coalesce("whole", F.lit(False)))
    text = F.when(F.col("covered").isNull(), F.col("text")).otherwise(_without(F.col("text"), F.col("covered")))
    return joined.select(F.col("row").withField(f"`{text_col}`", text).alias("row")).select("row.*")
