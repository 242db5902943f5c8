"""Document fingerprints: weighted SimHash and permuted block tables.

A text's terms are its words and its pairs of adjacent words (A-Z
lower-cased); a term counts ``1 + ln(occurrences)``, a pair more than a
word.  Each term's 64-bit hash votes with that weight for or against every
bit.  Search: a fingerprint is cut into blocks, and for every choice of
blocks that must stay equal when ``radius`` others may differ there is a
table of fingerprints permuted so that those blocks come first; equality on
the chosen blocks, then a check on all bits, finds every fingerprint within
the radius.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wardflow.llm.common import cut, ship_by_value

BITS = 64
PAIR_WEIGHT = 2.0
#: Word hashes a worker keeps at most; terms that vote at once.
CACHE_WORDS = 200_000
TERMS_AT_ONCE = 1 << 15


def _mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Fingerprinter:
    """Fingerprints with a bounded cache of word hashes."""

    def __init__(self):
        self.cache: dict[bytes, int] = {}

    def word_hashes(self, text: str | None) -> np.ndarray:
        w = (text or "").encode("utf-8", "surrogatepass").lower().split()
        cache = self.cache
        try:
            h = [cache[x] for x in w]
        except KeyError:
            if len(cache) > CACHE_WORDS:
                cache.clear()
            h = []
            for x in w:
                v = cache.get(x)
                if v is None:
                    v = xxhash.xxh64_intdigest(x, 1)
                    if len(x) <= 64:
                        cache[x] = v
                h.append(v)
        return np.array(h, np.uint64)

    def fingerprint(self, text: str | None) -> int:
        """A bit is set if the votes for it outweigh those against; a text
        without words gives zero."""
        h = self.word_hashes(text)
        votes = np.zeros(BITS)
        pairs = _mix(h[:-1] * np.uint64(3) + h[1:] * np.uint64(0x9E3779B97F4A7C15))
        for terms, weight in ((h, 1.0), (pairs, PAIR_WEIGHT)):
            terms, n = np.unique(terms, return_counts=True)
            w = (weight * (1.0 + np.log(n))).astype(np.float32)
            for lo in range(0, len(terms), TERMS_AT_ONCE):
                part = terms[lo:lo + TERMS_AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
                bits = np.unpackbits(part, axis=1, bitorder="little").astype(np.float32)
                here = w[lo:lo + TERMS_AT_ONCE]
                votes += 2.0 * (here @ bits) - here.sum(dtype=np.float64)
        return int(np.packbits(votes > 0, bitorder="little").view("<u8")[0])


def likeness(a: int, b: int) -> float:
    """Share of equal bits."""
    return 1.0 - (a ^ b).bit_count() / BITS


def hex64(fp: int) -> str:
    return f"{fp:016x}"


# ---------------------------------------------------------------------------
# fingerprints of texts and of their edited texts
# ---------------------------------------------------------------------------

_RESULT = [("n_chars", T.LongType()), ("edited_sha256", T.StringType()), ("fingerprint", T.StringType()),
           ("edited_fingerprint", T.StringType()), ("near_edited", T.DoubleType()), ("near_next", T.DoubleType())]


def _compare(f: Fingerprinter, text: str, fp: int, following: str, following_fp: int) -> tuple:
    """The result columns of a text followed by another."""
    k = len(text) // 3
    edited = text[:len(text) - k] + following[:k]
    edited_fp = f.fingerprint(edited) if edited != text else fp
    return (len(text), hashlib.sha256(edited.encode()).hexdigest(), hex64(fp), hex64(edited_fp),
            likeness(fp, edited_fp), likeness(fp, following_fp))


def with_edited(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next) of every text.  The edited text is the text with
    its last third replaced by as much of the start of the next document in
    descending id order (after the last: the first).

    Texts are shuffled once, range-partitioned by (id, text hash, row), so a
    repeated id or text fills no partition; each task compares neighbours as
    they stream by.  Only a partition's last row lacks its neighbour: it
    leaves with its text, as does the partition's first text, and the two
    meet in a join of one row per partition.

    Null text is empty.  Null ids come last, ties go by text hash, and of
    repeated rows each is the next of the one before.  A single document is
    its own next.  An empty table gives an empty result; other columns are
    not looked at.
    """
    ship_by_value(__name__)
    text = F.coalesce(F.col(text_col), F.lit(""))
    order = [F.col("id").desc_nulls_last(), F.col("hash"), F.col("row")]
    inp = (df.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("hash"),
                     F.monotonically_increasing_id().alias("row"), text.alias("text"))
           .repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text"))
    id_field = T.StructField("id", inp.schema["id"].dataType)
    result = [T.StructField(n, t) for n, t in _RESULT]
    streamed = T.StructType([T.StructField("kind", T.StringType()), T.StructField("part", T.IntegerType()), id_field,
                             T.StructField("text", T.StringType()), *result])

    def rows_to_batch(rows, id_type):
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), pa.array(cols[2], id_type),
             pa.array(cols[3], pa.string()), pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.string()),
             pa.array(cols[6], pa.string()), pa.array(cols[7], pa.string()), pa.array(cols[8], pa.float64()),
             pa.array(cols[9], pa.float64())], names=streamed.names)

    def stream(batches):
        f, part, last, id_type = Fingerprinter(), TaskContext.get().partitionId(), None, None
        none = (None,) * len(_RESULT)
        for b in batches:
            id_type = b.schema.field(0).type
            rows = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                t = t.as_py()
                fp = f.fingerprint(t)
                if last is None:
                    rows.append(("head", part, None, t, *none))
                else:
                    rows.append(("done", part, last[0], None, *_compare(f, last[1], last[2], t, fp)))
                last = (i, t, fp)
            if rows:
                yield rows_to_batch(rows, id_type)
        if last is not None:
            yield rows_to_batch([("open", part, last[0], last[1], *none)], id_type)

    seen = cut(inp.mapInArrow(stream, streamed))
    # one row per partition from here on
    heads = seen.where("kind = 'head'").select(F.col("part").alias("head_part"), F.col("text").alias("following"))
    by_part = Window.orderBy("head_part")
    nexts = heads.select(F.col("head_part").alias("part"), F.coalesce(
        F.lead("head_part").over(by_part), F.first("head_part").over(by_part)).alias("next_part"))
    opened = (seen.where("kind = 'open'").select("part", "id", "text").join(nexts, "part")
              .join(heads, F.col("next_part") == F.col("head_part")).select("id", "text", "following"))

    def finish(batches):
        f = Fingerprinter()
        for b in batches:
            rows = [("done", 0, i, None, *_compare(f, t, f.fingerprint(t), n, f.fingerprint(n)))
                    for i, t, n in zip(*(c.to_pylist() for c in b.columns))]
            if rows:
                yield rows_to_batch(rows, b.schema.field(0).type).select([2, *range(4, 4 + len(_RESULT))])

    done = opened.mapInArrow(finish, T.StructType([id_field, *result]))
    cols = ["id", *[n for n, _ in _RESULT]]
    return seen.where("kind = 'done'").select(*cols).unionByName(done).withColumnRenamed("id", id_col)


# ---------------------------------------------------------------------------
# search within a radius
# ---------------------------------------------------------------------------

def _block_masks(radius: int) -> list[int]:
    """For every choice of the blocks that stay equal, their bits: 2 * radius
    blocks of which at most ``radius`` can hold a differing bit."""
    n = max(2 * radius, 1)
    bounds = [BITS * i // n for i in range(n + 1)]
    blocks = [((1 << hi) - (1 << lo)) for lo, hi in zip(bounds, bounds[1:])]
    masks = [sum(c) for c in combinations(blocks, n - radius)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def _tables(df: DataFrame, masks: list[int], fp: str) -> DataFrame:
    """One row per table: the table's number and the fingerprint's bits in
    its leading blocks (what a permuted table is sorted by)."""
    entry = F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.col(fp).bitwiseAND(F.lit(m)).alias("lead"))
                                for i, m in enumerate(masks)]))
    return df.select(fp, entry.alias("e")).select(fp, "e.t", "e.lead")


def within_radius(queries: DataFrame, all_fps: DataFrame, radius: int = 3) -> DataFrame:
    """(q, fp): every pair of a fingerprint in column ``q`` of ``queries`` and
    one in column ``fp`` of ``all_fps`` (signed longs, both distinct) that
    differ in at most ``radius`` bits, equal ones included.  Nulls match
    nothing; empty tables give an empty result."""
    masks = _block_masks(radius)
    met = _tables(queries, masks, "q").join(_tables(all_fps, masks, "fp"), ["t", "lead"])
    return met.where(F.bit_count(F.col("q").bitwiseXOR(F.col("fp"))) <= radius).select("q", "fp").distinct()


def neighbour_counts(df: DataFrame, is_query: Column, fingerprint: str = "fingerprint", radius: int = 3) -> DataFrame:
    """(fingerprint as hex, n_near): for the fingerprints of rows with
    ``is_query``, the number of rows of ``df`` within the radius, all rows of
    equal fingerprint included.  Rows of one fingerprint are counted before
    anything is joined, so groups of copies stay one row each."""
    signed = F.conv(F.col(fingerprint), 16, -10).cast("long")
    fps = cut(df.groupBy(signed.alias("fp")).agg(F.count("*").alias("n"), F.max(is_query).alias("asked"))
              .where("fp is not null"))
    pairs = within_radius(fps.where("asked").select(F.col("fp").alias("q")), fps.select("fp"), radius)
    near = pairs.join(fps.select("fp", "n"), "fp").groupBy("q").agg(F.sum("n").alias("n_near"))
    return near.select(F.lower(F.lpad(F.hex("q"), 16, "0")).alias(fingerprint), "n_near")
