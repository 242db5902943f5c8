"""Vocabulary, token encoding and sequence assembly.

Conventions of the sequence loader the reference script uses: words are
ranked by frequency (ties by the word), a word's id is its rank plus
``index_from`` (3), only ids below ``num_words`` are kept, every sequence
starts with ``start_id`` (1), and words outside the vocabulary become
``oov_id`` (2).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardflow.functions import lookup
from wardflow.functions.arrays import pad_vectors

# FIXED VALUES (sequence loader conventions and script settings)
NUM_WORDS = 20000
MAX_LEN = 80
START_ID, OOV_ID, INDEX_FROM = 1, 2, 3
TOKEN_PATTERN = r"[^\p{L}\p{N}]+"


def tokenize(text) -> Column:
    """Lower-cased word tokens: split on runs of non-letter, non-digit
    characters; empty tokens dropped.  The whole text is tokenized."""
    t = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.lower(t), TOKEN_PATTERN), "")


def token_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(token, count) over all documents; a partial aggregate runs before
    the shuffle, so a very common word never piles up in one task."""
    return (docs.select(F.explode(tokenize(text)).alias("token"))
            .groupBy("token").agg(F.count(F.lit(1)).alias("count")))


def build_vocab(docs: DataFrame, num_words: int = NUM_WORDS, text: str = "text",
                index_from: int = INDEX_FROM) -> DataFrame:
    """The ``num_words - index_from - 1`` most frequent words with ids.

    ``orderBy(...).limit(k)`` plans as a per-partition top-k plus a merge
    (TakeOrderedAndProject), so only k rows per partition move; the id
    numbering then runs over those k rows only (bounded by ``num_words``).
    """
    k = num_words - index_from - 1
    top = token_counts(docs, text).orderBy(F.desc("count"), F.asc("token")).limit(k)
    rank = F.row_number().over(W.orderBy(F.desc("count"), F.asc("token")))
    return top.select("token", (rank + index_from).cast("int").alias("id"), "count")


def encode(docs: DataFrame, vocab: DataFrame, key: str = "doc_id", text: str = "text",
           start_id: int = START_ID, oov_id: int = OOV_ID, last_n: int | None = None) -> DataFrame:
    """K2: (key, ids) with ids in token order, OOV -> ``oov_id``, prefixed
    with ``start_id``; one row per row of ``docs``, NULL text has no tokens.

    The vocabulary (at most ``lookup.MAX_ENTRIES`` words, more fail the
    query; ``num_words`` bounds it) becomes one hash table in an array, and
    every token is looked up where it stands: documents are neither exploded
    nor shuffled.  With ``last_n`` only the last n tokens of a document are
    kept, what padding to n ids keeps anyway.
    """
    tokens = F.coalesce(tokenize(text), F.array().cast("array<string>"))
    if last_n is not None:
        tokens = F.slice(tokens, F.greatest(F.size(tokens) - (last_n - 1), F.lit(1)), F.lit(last_n))
    ids = lookup.with_values(docs.select(key, tokens.alias("__tokens")), "__tokens", "__ids",
                             vocab.select("token", F.col("id").cast("int").alias("id")), "token", "id", F.lit(oov_id))
    return ids.select(key, F.concat(F.array(F.lit(start_id)), F.col("__ids")).alias("ids"))


def encode_by_join(docs: DataFrame, vocab: DataFrame, key: str = "doc_id", text: str = "text",
                   start_id: int = START_ID, oov_id: int = OOV_ID) -> DataFrame:
    """K2 for a vocabulary of any size: tokens are exploded with their
    position, joined to the vocabulary and gathered back per ``key``."""
    toks = docs.select(key, F.posexplode_outer(tokenize(text)).alias("pos", "token"))
    v = vocab.select("token", "id")
    ided = toks.join(v, "token", "left").select(
        key, F.when(F.col("pos").isNotNull(),
                    F.struct("pos", F.coalesce(F.col("id"), F.lit(oov_id)).alias("id")))
              .alias("t"))
    # a document without tokens keeps one row (pos NULL) and gets an empty list
    seqs = ided.groupBy(key).agg(F.array_sort(F.collect_list("t")).alias("s"))
    ids = F.transform("s", lambda x: x["id"])
    return seqs.select(key, F.concat(F.array(F.lit(start_id)), ids).alias("ids"))


def to_sequences(features: DataFrame, cols: list[str], n: int = MAX_LEN,
                 stay: str = "icustay_id", order: str = "tw_hour_idx") -> DataFrame:
    """K4: per stay, the feature vectors of its windows in window order,
    left-padded with zero vectors / truncated to the last ``n`` windows
    (NULL values become 0.0; the mask columns carry missingness).

    Only the last ``n`` windows of a stay are gathered, so a group never
    exceeds ``n`` rows however long the stay.
    """
    last_first = W.partitionBy(stay).orderBy(F.col(order).desc())
    vec = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols])
    kept = (features.select(stay, order, vec.alias("v"),
                            F.row_number().over(last_first).alias("__r"))
            .where(F.col("__r") <= n))
    g = kept.groupBy(stay).agg(F.array_sort(F.collect_list(F.struct(order, "v"))).alias("s"),
                               F.count(F.lit(1)).alias("n_steps"))
    steps = F.transform("s", lambda x: x["v"])
    return g.select(stay, "n_steps", pad_vectors(steps, n, len(cols)).alias("steps"))
