r"""Source divergence audit over count-level bitmaps.

Terms are counted per (language, source) group.  A term's smoothed share p of
a group depends on its count there alone, so a sum of ``f(p, q)`` over all
terms of a language, for two groups, is a sum over pairs of counts: the
number of terms that have the one count here and the other there, times f.
For every (group, count) the ids of its terms are kept as a bitset, in
64-id words of which the empty ones are not stored; AND and popcount of two
groups' words give the joint cells, and the cells with a count of zero
follow as complements.  Ids go by falling frequency, so that a word's terms
have few different counts.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardflow.llm.common import Scratch, join_small, ship_by_value

ONE = 1_000_000_000
_TERM = re.compile(rb"[a-z\x80-\xff]+")
#: A task sends its counts on when it holds so many of them.
HELD_COUNTS = 500_000
#: A count and a number of rows in one integer.
_ROW = 1 << 40


def _count_rows(batches):
    """Counts of a stream of (lang, source, text) rows, as batches of (lang,
    source, term, n, docs).  In UTF-8 the bytes of a term are a-z and those
    above 0x7F."""
    groups, held = {}, 0

    def sent():
        for (lang, source), counts in groups.items():
            k = len(counts)
            values = list(counts.values())
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * k, pa.string()), pa.array([source] * k, pa.string()), pa.array(list(counts), pa.string()),
                 pa.array([v & (_ROW - 1) for v in values], pa.int64()), pa.array([v >> 40 for v in values], pa.int64())],
                names=["lang", "source", "term", "n", "docs"])

    for b in batches:
        for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            counts = groups.setdefault((lang, source), {})
            held -= len(counts)
            get = counts.get
            for term, k in Counter(_TERM.findall(text.as_py().encode().lower())).items():
                counts[term] = get(term, 0) + k + _ROW
            held += len(counts)
            if held > HELD_COUNTS:
                yield from sent()
                groups, held = {}, 0
    yield from sent()


def term_counts(df: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences of a term in a group and the
    number of the group's rows that hold it.  Tasks count Arrow batches of
    rows and hold a bounded number of counts; the sums follow in Spark."""
    ship_by_value(__name__)
    rows = df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (lang_col, source_col, text_col)])
    counted = rows.mapInArrow(_count_rows, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: str | Column, total: Column, v: Column) -> Column:
    """1 + floor(1e9 (n + 1) / (total + v)), exact at any count."""
    top = (F.col(n) if isinstance(n, str) else n).cast("decimal(20,0)") + F.lit(1).cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", F.lit(ONE).cast("decimal(10,0)") * top,
                                                   (total + v).cast("decimal(20,0)"))


def f_value(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q).  Shares sum to about 1e9, so squares and their
    sums stay below 2^63; were they not, ANSI arithmetic would fail the query."""
    return F.call_function("div", (p - q) * (p - q), q)


def _pair_values(bits: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every ordered pair of a language's groups."""
    c = F.col
    a = bits.select("lang", "block", *[c(x).alias(f"a_{x}") for x in ("source", "p", "p0", "bits")])
    b = bits.select("lang", "block", *[c(x).alias(f"b_{x}") for x in ("source", "p", "p0", "bits")])
    both = c("a_bits").bitwiseAND(c("b_bits"))
    met = (a.join(b, ["lang", "block"]).where((c("a_source") < c("b_source")) & (both != 0))
           .select("lang", "a_source", "b_source", "a_p", "a_p0", "b_p", "b_p0", F.bit_count(both).cast("long").alias("k")))
    cells = met.groupBy("lang", "a_source", "b_source", "a_p", "a_p0", "b_p", "b_p0").agg(F.sum("k").alias("k"))

    def joint(x, y):
        """What a cell of two positive counts adds to the cells with a zero, which count it too."""
        return c("k") * (f_value(c(f"{x}_p"), c(f"{y}_p")) - f_value(c(f"{x}_p"), c(f"{y}_p0"))
                         - f_value(c(f"{x}_p0"), c(f"{y}_p")) + f_value(c(f"{x}_p0"), c(f"{y}_p0")))

    def row(source, item, value):
        return F.struct(c(source).alias("source"), c(item).alias("item"), value.alias("value"))

    def rows(df, *structs):
        return df.select("lang", F.explode(F.array(*structs)).alias("r")).select("lang", "r.*")
    sums = cells.groupBy("lang", "a_source", "b_source").agg(
        F.sum(joint("a", "b")).alias("ab"), F.sum(joint("b", "a")).alias("ba"))
    joint_rows = rows(sums, row("a_source", "b_source", c("ab")), row("b_source", "a_source", c("ba")))
    # a count here against zero there, as if every term were at zero there
    mine = bits.groupBy("lang", "source", "p", "p0").agg(F.sum(F.bit_count("bits").cast("long")).alias("k"))
    other = groups.select("lang", c("source").alias("o_source"), c("p0").alias("o_p0"))
    edge = mine.join(other, "lang").where(c("source") != c("o_source"))
    here = c("k") * (f_value(c("p"), c("o_p0")) - f_value(c("p0"), c("o_p0")))
    there = c("k") * (f_value(c("o_p0"), c("p")) - f_value(c("o_p0"), c("p0")))
    edge = edge.groupBy("lang", "source", "o_source").agg(F.sum(here).alias("here"), F.sum(there).alias("there"))
    edge_rows = rows(edge, row("source", "o_source", c("here")), row("o_source", "source", c("there")))
    # all terms at zero in both
    zero = groups.join(other, "lang").where(c("source") != c("o_source")).select(
        "lang", "source", c("o_source").alias("item"), F.when(c("v") > 0, c("v") * f_value(c("p0"), c("o_p0")))
        .otherwise(F.lit(0)).cast("long").alias("value"))
    return (joint_rows.unionByName(edge_rows).unionByName(zero)
            .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))


def audit(df: DataFrame, min_docs: int = 3, top_terms: int = 200, lang_col: str = "lang", source_col: str = "source",
          text_col: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank) of every group.

    A language keeps the terms that at least ``min_docs`` of its rows hold.
    Part ``pair``: every other source of the language, by how far the group's
    shares lie from its; part ``term``: the ``top_terms`` kept terms of the
    group with a share above the language's, by that distance.  Ranks go by
    falling value, then by the item in UTF-8 order.

    Null text, language and source read as empty; groups without terms keep
    their pairs, and with no kept term their value is 0; repeated rows count
    each; texts of any length are counted whole; an empty table gives an
    empty result.  Other columns are not looked at.
    """
    c = F.col
    scratch = Scratch(df.sparkSession, "divergence")
    counts = scratch.table(term_counts(df, lang_col, source_col, text_col))
    # ids: a word of 64 is a stretch of the terms of one language in order of frequency
    kept = (counts.groupBy("lang", "term").agg(F.sum("n").alias("in_lang"), F.sum("docs").alias("docs"))
            .where(c("docs") >= min_docs).orderBy("lang", c("in_lang").desc(), "term"))
    terms = scratch.table(kept.select("lang", "term", "in_lang", F.monotonically_increasing_id().alias("id")))
    langs = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("in_lang").alias("lang_n"))
    here = scratch.table(counts.select("lang", "source", "term", "n").join(terms, ["lang", "term"]))
    # every occurring group
    zero = F.lit(0).cast("long")
    occurring = df.select(*[F.coalesce(c(f"`{x}`").cast("string"), F.lit("")).alias(n)
                            for x, n in ((lang_col, "lang"), (source_col, "source"))]).distinct()
    groups = (occurring.join(here.groupBy("lang", "source").agg(F.sum("n").alias("group_n")), ["lang", "source"], "left")
              .join(langs, "lang", "left")
              .select("lang", "source", *[F.coalesce(x, zero).alias(x) for x in ("group_n", "v", "lang_n")]))
    groups = scratch.table(groups.withColumn("p0", F.when(c("v") > 0, _share(zero, c("group_n"), c("v"))).otherwise(zero)))
    words = here.groupBy("lang", "source", "n", F.shiftright("id", 6).alias("block")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), c("id").bitwiseAND(F.lit(63)).cast("int"))).alias("bits"))
    bits = scratch.table(join_small(words, groups, ["lang", "source"]).select(
        "lang", "source", "block", "bits", _share("n", c("group_n"), c("v")).alias("p"), "p0"))
    pairs = _pair_values(bits, groups).withColumn("part", F.lit("pair"))
    shares = join_small(here, groups, ["lang", "source"]).select(
        "lang", "source", c("term").alias("item"), _share("n", c("group_n"), c("v")).alias("p"),
        _share("in_lang", c("lang_n"), c("v")).alias("q"))
    over = shares.where("p > q").select("lang", "source", "item", f_value(c("p"), c("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(c("value").desc(), "item")
    rank = F.row_number().over(order).alias("rank")
    cols = ["lang", "source", "part", "item", "value", "rank"]
    top = over.select("*", rank).where(c("rank") <= top_terms).withColumn("part", F.lit("term"))
    return scratch.result(pairs.select("*", rank).select(cols).unionByName(top.select(cols)))
