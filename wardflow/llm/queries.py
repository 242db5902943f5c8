"""The queries of the training-data operators, each over its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm import (chat, decontaminate, divergence, fingerprints, langid, licenses, line_dedup, mixing, oracle,
                          packing, quality, rollups, simhash_dedup, spelling)
from wardflow.llm.common import cut, documents
from wardflow.session import checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op1_simhash_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: 3-word shingles, 2 bits."""
    groups = simhash_dedup.near_dup_groups(documents(spark, sf_dir), n=3, max_bits=2)
    return groups.select(F.col("__id").alias("doc_id"),
                         F.lower(F.lpad(F.hex("__fp"), 16, "0")).alias("fingerprint"),
                         F.col("__component").alias("component_id"))


@register("op3_source_mix", oracle.SOURCE_MIX)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: weights 5, 2, 1 in turn, 150 % of all words, at most 2 copies."""
    mix = mixing.with_copies(documents(spark, sf_dir, "doc_id", "text", "source"), (5, 2, 1), 1.5, 2.0, "mix")
    return mix.select("doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"),
                      F.col("__target").alias("target"), (F.col("__copies") * F.col("__size")).alias("taken"),
                      F.col("__copies").alias("copies"))


@register("op4_quality_rules", oracle.QUALITY_RULES)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule ledger of all documents and the verdict of policy prose-2."""
    names = quality.POLICIES["prose-2"]
    bits = F.col("fail_bits")
    whole = bits.bitwiseAND(F.lit(quality.mask(names)).cast("long"))
    base_failed = quality.failed(bits, quality.POLICIES["base-1"])
    return quality.ledger(documents(spark, sf_dir, "doc_id", "text")).select(
        F.col("__id").alias("doc_id"), *quality.MEASURES[:5], base_failed.alias("base_failed"),
        (~base_failed & ~quality.failed(bits, names)).alias("kept"), "fail_bits",
        # the document's part in the ablations: the one rule without which it would be kept
        F.when(F.bit_count(whole) == 1, whole).otherwise(F.lit(0).cast("long")).alias("sole_failure"))


@register("op10_line_dedup", oracle.LINE_DEDUP)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line dedup over all documents; the cleaned text as length and digest."""
    out = line_dedup.without_repeated_lines(documents(spark, sf_dir, "doc_id", "text"))
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"),
                      F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("text_md5"))


@register("op8_best_fit_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packing.pack(documents(spark, sf_dir, "doc_id", "text")).drop("__row")


@register("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, learnt from those not held out."""
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    model = langid.learn_from_open(docs)
    rows = docs.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "text")
    return langid.predict(rows, model, F.col("text")).select(
        "doc_id", "held_out", F.col("__lang_pred").alias("lang_pred"), F.col("__score").alias("score"),
        F.col("__lang_share").alias("lang_share"))


@register("op6_document_fingerprints")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all texts and their edited texts; for every 50th id
    also the number of other documents within 3 bits."""
    out = fingerprints.with_edited(documents(spark, sf_dir, "doc_id", "text"))
    asked = F.coalesce(F.col("doc_id") % 50 == 0, F.lit(False))
    near = fingerprints.neighbour_counts(out, asked)
    return out.join(near, "fingerprint", "left").withColumn("n_near", F.when(asked, F.col("n_near") - 1)).select(
        *out.columns, "n_near")


@register("op2_chat_preferences", oracle.CHAT_PREFERENCES)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against itself with the next one's ending: prompt
    and completions as digests, trained spans in full."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    pairs = chat.preference_pairs(turns, chat.swapped_ending(turns))

    def spans(c):
        return F.array_join(F.transform(c, lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return pairs.select("conv_id", F.col("prompt_turns").cast("long").alias("prompt_turns"),
                        *[F.md5(c).alias(f"{c}_md5") for c in ("prompt", "chosen", "rejected")],
                        spans("chosen_spans").alias("chosen_spans"), spans("rejected_spans").alias("rejected_spans"), "differs")


@register("op5_license_scan")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License blocks of all documents."""
    return licenses.license_blocks(documents(spark, sf_dir, "doc_id", "text"))


@register("op9_token_counts")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals after three batches over all documents: all inserted,
    those with crc32(id) = 3 modulo 10 deleted (sent twice), those with 5
    revised to their text from its second line on; then compacted."""
    bucket = F.crc32(F.col("doc_id").cast("string")) % 10
    rest = F.expr("if(contains(text, '\n'), substr(text, instr(text, '\n') + 1), text)")
    counts = cut(rollups.with_token_counts(
        documents(spark, sf_dir, "text", "doc_id", "source", "lang"), [F.col("source"), F.col("lang"), bucket.alias("bucket")],
        {"n_tokens": F.col("text"), "n_revised": F.when(bucket == 5, rest)}))
    return _three_batches(counts)


def _three_batches(counts: DataFrame) -> DataFrame:
    """Totals of (source, lang, tokenizer, bucket, n_tokens, n_revised) rows,
    each a document under a tokenizer, by signed batches."""
    spark = counts.sparkSession
    rollup = rollups.TokenRollup(spark, f"{checkpoint_dir(spark)}/token-counts-{uuid.uuid4().hex}")
    gone, revised = counts.where("bucket = 3"), counts.where("bucket = 5")
    rollup.commit("load", rollups.changes(None, counts))
    rollup.commit("delete", rollups.changes(gone, None))
    rollup.commit("revise", rollups.changes(revised, revised.withColumn("n_tokens", F.col("n_revised"))))
    rollup.commit("delete", rollups.changes(gone, None))
    rollup.compact()
    return rollup.totals()


def _misprint(doc_id, run):
    """A run whose crc32 with its document's id divides by 31 loses a code point."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = F.pmod(h, F.length(run).cast("long")).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % 31 == 0, shorter).otherwise(run)


@register("op11_spelling_variants", oracle.SPELLING_VARIANTS)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants of all words of 7 code points and 2 occurrences or more."""
    counts = spelling.word_counts(documents(spark, sf_dir, "doc_id", "text"), 7, 2, edit=_misprint)
    return spelling.variants(counts, ratio=10)


@register("op12_benchmark_decontamination", oracle.BENCHMARK_HITS)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and items of every document that windows of ten benchmark words hit."""
    found = decontaminate.hits(documents(spark, sf_dir, "doc_id", "text"),
                               spark.read.parquet(f"{sf_dir}/benchmark.parquet"), n=10)
    n_hit = F.size("covered").cast("long")
    return found.select(F.col("__id").alias("doc_id"), "n_words", n_hit.alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


@register("op13_source_divergence", oracle.SOURCE_DIVERGENCE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far every source's terms lie from each other source of its language, and its 200 furthest terms."""
    return divergence.audit(documents(spark, sf_dir, "lang", "source", "text"), min_docs=3, top_terms=200)
