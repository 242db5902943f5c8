"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger keeps the measurements
and one failure bit per rule.  Policies are versioned sets of rules: applying
one is a bitwise AND, and the effect of leaving a rule out (its ablation) is
a bitwise aggregation over the ledger, without touching a text again.
DataFrame functions only.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import words

SYMBOLS = r"#*$%&|<>"
HAS_WORD = r"[^ \t\n\x0B\f\r]"
WINDOW = 8


class Rule(NamedTuple):
    name: str
    fails: Column


def rules() -> list[Rule]:
    """All rules over the measurements; a rule's position is its bit, so new
    rules go at the end and old ledgers stay readable."""
    c = F.col
    return [
        Rule("few_words", c("n_words") < 20),
        Rule("repeated_words", 100 * c("n_repeat_words") > 30 * c("n_words")),
        Rule("symbols", 10 * c("n_symbols") > c("n_words")),
        Rule("upper_case", 10 * c("n_upper") > 3 * c("word_chars")),
        Rule("exclamations", 10 * c("n_exclaim") > c("n_words")),
        Rule("repeated_lines", 2 * c("n_dup_lines") > c("n_lines")),
        Rule("word_length", (c("word_chars") < 2 * c("n_words")) | (c("word_chars") > 12 * c("n_words"))),
        Rule("echoed_words", 5 * c("n_echoes") > c("n_words")),
    ]


#: Policies by version: the rules whose failure rejects a document.
POLICIES = {
    "base-1": ("few_words", "repeated_words"),
    "prose-2": ("few_words", "repeated_words", "symbols", "upper_case", "exclamations", "repeated_lines",
                "word_length", "echoed_words"),
}

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_exclaim", "n_echoes")


def mask(names) -> int:
    """The bits of the named rules."""
    bits = {r.name: 1 << i for i, r in enumerate(rules())}
    return sum(bits[n] for n in names)


def _kept_chars(text: Column, char_class: str) -> Column:
    """Number of characters of a class in a text."""
    return F.length(F.regexp_replace(text, f"[^{char_class}]+", ""))


def measured(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, measurements) of every text, each from the whole text.

    ``n_repeat_words`` counts the words covered by eight-word windows that
    occur twice or more in the text.  Windows are compared by 64-bit hash
    within one text.  The steps are kept as columns of their own so that no
    array is built twice.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(HAS_WORD))
    df = df.select(F.col(id_col).alias("__id"), text.alias("__text"), words(F.col(text_col)).alias("__words"),
                   lines.alias("__lines"))
    df = df.withColumn("__windows", F.when(
        F.size("__words") >= WINDOW,
        F.transform(F.sequence(F.lit(1), F.size("__words") - (WINDOW - 1)),
                    lambda i: F.xxhash64(F.slice("__words", i, WINDOW))))
        .otherwise(F.array().cast("array<long>")))
    # most texts repeat no window; only the others are sorted
    df = df.withColumn("__sorted", F.when(
        F.size(F.array_distinct("__windows")) < F.size("__windows"),
        F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))

    def twice(x, j):
        def same(k):
            return F.coalesce(F.get("__sorted", k)["h"] == x["h"], F.lit(False))
        return same(j - 1) | same(j + 1)

    df = df.withColumn("__at", F.filter("__sorted", twice))
    df = df.withColumn("__at", F.sort_array(F.transform("__at", lambda x: x["i"])))
    gaps = F.transform("__at", lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get("__at", j + 1) - p, F.lit(WINDOW))))
    covered = F.coalesce(F.aggregate(gaps, F.lit(0), lambda a, x: a + x), F.lit(0))
    measures = {
        "n_words": F.size("__words"),
        "word_chars": F.length(F.array_join("__words", "")),
        "n_symbols": _kept_chars(F.col("__text"), SYMBOLS),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_repeat_words": covered,
        "n_lines": F.size("__lines"),
        "n_upper": _kept_chars(F.col("__text"), "A-Z"),
        "n_exclaim": _kept_chars(F.col("__text"), "!"),
        # words equal to the word before
        "n_echoes": F.size(F.filter("__words", lambda x, i: F.coalesce(F.get("__words", i - 1) == x, F.lit(False)))),
    }
    return df.select("__id", *[m.cast("long").alias(n) for n, m in measures.items()])


def ledger(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``__id``, the measurements and ``fail_bits``.

    Null text has no words and fails like an empty one.  Null and repeated
    ids are kept, a row each.  Texts are measured whole.  An empty table
    gives an empty ledger; other columns of ``df`` are not looked at.
    """
    m = measured(df, id_col, text_col)
    bits = F.lit(0).cast("long")
    for i, r in enumerate(rules()):
        bits = bits.bitwiseOR(F.when(r.fails, F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return m.withColumn("fail_bits", bits)


def failed(bits: Column, names) -> Column:
    """Whether any of the named rules has failed."""
    return bits.bitwiseAND(F.lit(mask(names)).cast("long")) != 0


def ablations(ledger_df: DataFrame, version: str) -> DataFrame:
    """(rule, n_failed, n_kept, n_kept_without) for every rule of a policy:
    documents that fail the rule, that the policy keeps, and that it would
    keep without the rule.  One partial aggregation by failure bits (at most
    2^rules groups), then bitwise sums.  An empty ledger gives zeros."""
    names = POLICIES[version]
    whole = mask(names)
    counts = (ledger_df.groupBy(F.col("fail_bits").bitwiseAND(F.lit(whole).cast("long")).alias("bits"))
              .agg(F.count("*").alias("n")))
    rule = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(mask([n])).cast("long").alias("bit"))
                               for n in names]))
    table = ledger_df.sparkSession.range(1).select(rule.alias("r")).select("r.*")

    def total(cond):
        return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    bits, bit = F.col("bits"), F.col("bit")
    per_rule = counts.select("bits", "n", rule.alias("r")).select("bits", "n", "r.*")
    sums = per_rule.groupBy("rule").agg(
        total(bits.bitwiseAND(bit) != 0).alias("n_failed"), total(bits == 0).alias("n_kept"),
        total(bits.bitwiseAND(F.bitwise_not(bit)) == 0).alias("n_kept_without"))
    return table.select("rule").join(sums, "rule", "left").na.fill(0)
