r"""Spelling variants by pivotal grams.

Two words are near if one inserted, deleted or replaced code point turns one
into the other.  A word's bigrams are put in one order for all words, rare
ones first; its prefix are the first three of them (all that tie with the
third).  One edit spoils at most one of two disjoint bigrams, so of two near
words the one whose prefix ends earlier in the order has one of its two
pivots, disjoint bigrams of its prefix, in the prefix of the other.  The
pivots are the rarest such pair, chosen by dynamic programming along the
word.  The index holds the places of every prefix bigram: position, length
and the side of the word that an edit elsewhere leaves alone; a pivot looks
up the places it can have in a word of its length, one longer or one
shorter.  The words found are compared in full.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import Scratch, lower_az

RUN = "[A-Za-zÀ-ÿ]"
#: A bigram is known by its hash modulo this; the frequencies of all go to every task.
GRAM_SLOTS = 1 << 16
#: Words of fewer code points need not have three bigrams, two of them disjoint.
LEAST_CHARS = 4
#: A place with fewer known code points than this takes up to so many more as context.
KNOWN, CONTEXT = 8, 3


def word_counts(df: DataFrame, min_chars: int = 7, min_count: int = 2, id_col: str = "doc_id", text_col: str = "text",
                edit: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """(word, n): the maximal runs of letters, A-Z lower-cased, of at least
    ``min_chars`` code points and ``min_count`` occurrences in all texts.
    ``edit(id, run)`` may change a run before it is counted; it must not
    lengthen it."""
    runs = F.regexp_extract_all(F.col(f"`{text_col}`"), F.lit(f"{RUN}{{{min_chars},}}"), F.lit(0))
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.explode(runs).alias("run")).select(
        "id", lower_az(F.col("run")).alias("run"))
    word = edit(F.col("id"), F.col("run")) if edit else F.col("run")
    return (rows.select(word.alias("word")).where(F.length("word") >= min_chars)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count))


def _slot(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(GRAM_SLOTS)).cast("int")


def _grams(chars: str) -> Column:
    """The slots of a word's bigrams, in place order."""
    return F.transform(F.sequence(F.lit(0), F.size(chars) - 2),
                       lambda i: _slot(F.concat(F.get(chars, i), F.get(chars, i + 1))))


def _gram_order(grams: DataFrame) -> DataFrame:
    """One row, one array: for every slot a number that orders it, by its
    occurrences, then by itself."""
    n = grams.select(F.explode("slots").alias("slot")).groupBy("slot").agg(F.count("*").alias("n"))
    every = grams.sparkSession.range(GRAM_SLOTS).select(F.col("id").cast("int").alias("slot"))
    order = F.coalesce("n", F.lit(0)) * GRAM_SLOTS + F.col("slot")
    full = every.join(n, "slot", "left").select("slot", order.alias("o"))
    return full.agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", "o"))), lambda x: x["o"]).alias("t"))


def _pivots(prefix: str) -> Column:
    """Places of the two disjoint bigrams of least total order among a prefix
    in place order: a pass along the word that holds the best single bigram
    before the last one, the last one, and the best pair so far."""
    inf = F.lit(2 ** 62).cast("long")
    single = "struct<o:bigint,at:int>"
    none = F.struct(inf.alias("o"), F.lit(-2).alias("at")).cast(single)
    start = F.struct(none.alias("before"), none.alias("last"),
                     F.struct(inf.alias("o"), F.lit(-2).alias("a"), F.lit(-2).alias("b")).alias("best"))

    def step(s, g):
        here = F.struct(g["o"].alias("o"), g["at"].alias("at"))
        free = F.when(s["last"]["at"] <= g["at"] - 2, F.least(s["before"], s["last"])).otherwise(s["before"])
        pair = F.when(free["at"] >= 0, F.struct((free["o"] + g["o"]).alias("o"), free["at"].alias("a"), g["at"].alias("b")))
        return F.struct(F.least(s["before"], s["last"]).alias("before"), here.alias("last"),
                        F.least(s["best"], pair).alias("best"))
    return F.aggregate(prefix, start, step, lambda s: s["best"])


def _signed(words: DataFrame) -> DataFrame:
    """(word, n, len, letters, prefix, pivots) of every word; ``letters`` is a
    64-bit set."""
    chars = words.withColumn("chars", F.regexp_extract_all(F.col("word"), F.lit("(?s)."), F.lit(0)))
    slots = chars.withColumn("slots", _grams("chars"))
    # referenced once, so Spark puts the subquery's array into the expression and not into every row
    ordered = slots.withColumn("table", _gram_order(slots).scalar()).withColumn(
        "os", F.transform("slots", lambda s: F.get("table", s))).drop("table")
    ordered = ordered.withColumn("last", F.get(F.sort_array("os"), F.lit(2)))
    prefix = F.filter(F.transform("os", lambda o, i: F.struct(o.alias("o"), i.alias("at"))), lambda g: g["o"] <= F.col("last"))
    letters = F.aggregate("chars", F.lit(0).cast("long"), lambda acc, ch: acc.bitwiseOR(
        F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.ascii(ch), F.lit(64)))))
    return ordered.select("word", "n", F.size("chars").alias("len"), letters.alias("letters"),
                          prefix.alias("prefix")).withColumn("pivots", _pivots("prefix"))


def _places(signed: DataFrame, name: str, grams: Column, moves: list[int]) -> DataFrame:
    """(key, word, n, letters), columns prefixed: the places of a word's
    ``grams``, as they are in a word that is longer by each of ``moves``.

    A place is a bigram, its position, the length and all of the word on one
    side of it: an edit behind the bigram leaves what is before it, an edit
    before it moves it and leaves what is behind.  Where that side is short,
    the other side's half that the edit spares belongs to the place as well:
    its start or its end, ``CONTEXT`` code points at most, one key each.
    """
    rows = signed.select("word", "n", "len", "letters", F.explode(grams).alias("g")).select(
        "word", "n", "len", "letters", "g.o", "g.at")
    word, n, at = F.col("word"), F.col("len"), F.col("at")
    first = F.lit(1)
    before, behind = F.substring(word, first, at + 2), F.substring(word, at + 1, n)
    keys = []
    for move in moves:
        length, there = n + move, at + move
        rest = length - at - 2  # code points behind the bigram, in the other word
        half = F.least(F.lit(CONTEXT), (rest / 2).cast("int"))
        short = (at + 2 < KNOWN) & (rest >= 2)
        keys += [F.xxhash64(F.lit(0), "o", at, length, before, F.when(short, F.substring(word, at + 3, half))),
                 F.when(short, F.xxhash64(F.lit(1), "o", at, length, before, F.substring(word, n - half + 1, half)))]
        half = F.least(F.lit(CONTEXT), (there / 2).cast("int"))
        short = (n - at < KNOWN) & (there >= 2)
        keys += [F.xxhash64(F.lit(2), "o", there, length, behind, F.when(short, F.substring(word, at - half + 1, half))),
                 F.when(short, F.xxhash64(F.lit(3), "o", there, length, behind, F.substring(word, first, half)))]
    return rows.select(F.explode(F.array(*keys)).alias("key"), *[F.col(x).alias(f"{name}_{x}") for x in (
        "word", "n", "letters")]).where("key is not null")


def near_pairs(words: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b, n_a, n_b): every two near words of (word, n), a before b."""
    signed = scratch.table(_signed(words))
    c = F.col
    pivots = F.filter("prefix", lambda g: (g["at"] == c("pivots.a")) | (g["at"] == c("pivots.b")))
    met = _places(signed, "p", pivots, [-1, 0, 1]).join(_places(signed, "i", c("prefix"), [0]), "key").where(
        (c("p_word") != c("i_word")) & (F.bit_count(c("p_letters").bitwiseXOR(c("i_letters"))) <= 2)
        & (F.levenshtein("p_word", "i_word", 1) == 1))
    first = c("p_word") < c("i_word")
    pairs = met.select(F.least("p_word", "i_word").alias("a"), F.greatest("p_word", "i_word").alias("b"),
                       F.when(first, c("p_n")).otherwise(c("i_n")).alias("n_a"),
                       F.when(first, c("i_n")).otherwise(c("p_n")).alias("n_b"))
    return pairs.distinct()


def variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of (word, n).

    ``n_near`` counts the near words.  The form is the near word of largest n
    (ties: the smaller word) if that n is at least ``ratio`` times the word's
    own, else null; the root is where following forms ends, the word itself
    if it has none.  Counts grow with every step, so chains are short: a few
    rounds of pointer doubling reach every root.

    Words are distinct, not null, of 4 code points or more (fewer are an
    error); counts are positive; ``ratio`` is 2 or more.  An empty table
    gives an empty result; other columns are not looked at.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more")
    c = F.col
    scratch = Scratch(words.sparkSession, "spelling")
    long_enough = F.when(F.length("word") >= LEAST_CHARS, c("word")).otherwise(
        F.raise_error(F.lit(f"words must have {LEAST_CHARS} code points or more")))
    words = scratch.table(words.select(long_enough.alias("word"), "n"))
    pairs = near_pairs(words, scratch)
    ends = F.array(F.struct(c("a").alias("word"), (-c("n_b")).alias("m"), c("b").alias("near")),
                   F.struct(c("b").alias("word"), (-c("n_a")).alias("m"), c("a").alias("near")))
    near = pairs.select(F.explode(ends).alias("e")).select("e.*").groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct("m", "near")).alias("best"))
    strong = -c("best.m") >= ratio * c("n")
    formed = scratch.table(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(strong, c("best.near")).alias("form"), F.when(strong, -c("best.m")).alias("form_n")))
    roots = formed.where("form is not null").select("word", c("form").alias("root"))
    least, most = words.agg(F.min("n"), F.max("n")).first()
    steps = math.log(most / least, ratio) + 1 if most else 1  # links in the longest chain, at most
    for _ in range(math.ceil(math.log2(max(steps, 1)))):
        on = roots.select(c("word").alias("at"), c("root").alias("beyond"))
        roots = scratch.table(roots.join(on, c("root") == c("at"), "left")
                              .select("word", F.coalesce("beyond", "root").alias("root")))
    return scratch.result(formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
