"""SimHash near-dedup by deletion-variant signatures.

A fingerprint is cut into ``k // 2 + 1`` segments, so two fingerprints within
``k`` bits agree in one segment up to at most one bit.  Each segment is
indexed whole and with one bit left out in turn (its one-wildcard variants);
fingerprints meet by an equality join on (variant, remaining bits) and are
verified on all 64 bits.  In a one-wildcard bucket only members that differ
in the left-out bit are paired: those that agree there meet in the whole
segment's bucket already.

Buckets are counted first (partial aggregation).  A bucket that would make
more than ``PAIRS_PER_MEMBER`` pairs per member is not paired but cut again:
its members are indexed by the same rule on the bits the bucket leaves open,
until buckets are small.  The rule is exact at every size (a bucket that
fixes all bits but the wildcards has at most four members for k <= 2), so no
group of near copies is ever paired quadratically and no link is lost.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.llm.common import cut, ship_by_value, text_identity
from wardflow.llm.components import connected_components

BITS = 64
#: A bucket is paired as it stands while that makes at most this many pairs per member.
PAIRS_PER_MEMBER = 33
HASHES_AT_ONCE = 1 << 16


# ---------------------------------------------------------------------------
# fingerprints
# ---------------------------------------------------------------------------

def shingles(text: str | None, n: int) -> list[bytes]:
    """Word n-grams of a text with A-Z lower-cased, words joined by a space,
    repeats included; fewer words than n: the whole sequence; none: none."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return []
    if len(w) <= n:
        return [b" ".join(w)]
    joined = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    return [joined[s:e] for s, e in zip(starts[:len(w) - n + 1].tolist(), ends[n - 1:].tolist())]


def fingerprint(text: str | None, n: int = 3, seed: int = 42) -> int:
    """64-bit SimHash: a bit is set if it is set in over half of the
    shingles' XXH64 values; a text without words gives zero."""
    grams = shingles(text, n)
    if not grams:
        return 0
    count = np.zeros(BITS, np.int64)
    for lo in range(0, len(grams), HASHES_AT_ONCE):
        part = grams[lo:lo + HASHES_AT_ONCE]
        h = np.fromiter((xxhash.xxh64_intdigest(g, seed) for g in part), np.uint64, len(part))
        count += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                               bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > len(grams), bitorder="little").view("<u8")[0])


def with_fingerprints(df: DataFrame, id_cols: list[Column], text: Column, n: int) -> DataFrame:
    """``id_cols`` plus ``__fp`` (the fingerprint as a signed long)."""
    ship_by_value(__name__)
    inp = df.select(*id_cols, text.alias("__text"))
    out = T.StructType([f for f in inp.schema.fields if f.name != "__text"] + [T.StructField("__fp", T.LongType())])

    def run(batches):
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), n) for t in b.column(b.num_columns - 1)),
                              np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fps.view(np.int64))],
                                             names=[*b.schema.names[:-1], "__fp"])

    return inp.mapInArrow(run, out)


# ---------------------------------------------------------------------------
# deletion-variant index
# ---------------------------------------------------------------------------

class Variant(NamedTuple):
    fixed: frozenset[int]     # bits that must agree
    wild: tuple[int, ...]     # bits in which the two must differ
    rest: tuple[int, ...]     # bits still open
    left: int                 # differing bits allowed among them


def cut_open_bits(v: Variant) -> list[Variant]:
    """The variants of one more cut of ``v``'s open bits."""
    if not v.rest:
        return []
    m = v.left // 2 + 1
    bounds = [len(v.rest) * i // m for i in range(m + 1)]
    out = []
    for lo, hi in zip(bounds, bounds[1:]):
        seg, others = v.rest[lo:hi], v.rest[:lo] + v.rest[hi:]
        if not seg:
            continue
        out.append(Variant(v.fixed | set(seg), v.wild, others, v.left))
        if v.left:
            out += [Variant(v.fixed | set(seg) - {p}, v.wild + (p,), others, v.left - 1) for p in seg]
    return out


def _mask(bits) -> int:
    m = sum(1 << b for b in bits)
    return m - (1 << BITS) if m >> (BITS - 1) else m


def _index(rows: DataFrame, parents: dict[int, Variant], first_id: int) -> tuple[DataFrame, dict[int, Variant]]:
    """One row (path, key, side, fp) per variant of each row's path.  The
    variant table is fixed by the bit layout (a few thousand rows at most),
    never by the data, and is broadcast.  Rows are dealt out evenly first:
    each becomes dozens, however few files they come in."""
    spark = rows.sparkSession
    rows = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "fp")
    made: dict[int, Variant] = {}
    table = []
    for pid, parent in parents.items():
        for v in cut_open_bits(parent):
            vid = first_id + len(made)
            made[vid] = v
            w0 = v.wild[0] if v.wild else None
            table.append((pid, vid, _mask(v.fixed), _mask(v.wild[1:]), w0))
    vt = spark.createDataFrame(table, "path int, variant int, fixed long, wild long, w0 int")
    side = F.when(F.col("w0").isNull(), 0).otherwise(
        F.expr("shiftrightunsigned(fp, w0)").bitwiseAND(F.lit(1))).cast("byte")
    # in further wildcard bits the two must differ as well: compare them relative to the first
    flipped = F.when(F.col("side") == 1, F.bitwise_not("fp")).otherwise(F.col("fp"))
    idx = (rows.join(F.broadcast(vt), "path").withColumn("side", side)
           .select(F.col("variant").alias("path"),
                   F.col("fp").bitwiseAND(F.col("fixed"))
                   .bitwiseOR(flipped.bitwiseAND(F.col("wild"))).alias("key"), "side", "fp"))
    return idx, made


def _exact_paths(made: dict[int, Variant]) -> list[int]:
    return [i for i, v in made.items() if not v.wild]


def linked_pairs(fps: DataFrame, k: int) -> DataFrame:
    """(a, b), a <> b: all pairs of the distinct fingerprints in column
    ``fp`` that differ in at most ``k`` bits."""
    def close(a, b):
        return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= k

    start = {0: Variant(frozenset(), (), tuple(range(BITS)), k)}
    rows, parents, found, first_id = fps.select(F.lit(0).alias("path"), "fp"), start, [], 1
    while True:
        idx, made = _index(rows, parents, first_id)
        first_id += len(made)
        exact = F.col("path").isin(_exact_paths(made))
        n, n1 = F.col("n"), F.col("n1")
        pairs = F.when(exact, n * (n - 1) / 2).otherwise((n - n1) * n1)
        met = cut(idx.groupBy("path", "key")
                  .agg(F.count("*").alias("n"), F.sum("side").alias("n1"),
                       F.min("fp").alias("lo"), F.max("fp").alias("hi"))
                  .withColumn("pairs", pairs).where("pairs > 0"))
        found.append(met.where("n = 2").where(close("lo", "hi")).select("lo", "hi"))
        more = met.where("n > 2").select("path", "key", (F.col("pairs") > PAIRS_PER_MEMBER * n).alias("hot"))
        if more.isEmpty():
            break
        members = cut(idx.join(more, ["path", "key"]))
        cold = members.where(~F.col("hot"))
        b = cold.select("path", "key", F.col("side").alias("side_b"), F.col("fp").alias("hi"))
        meet = F.when(exact, F.col("lo") < F.col("hi")).otherwise(F.col("side") < F.col("side_b"))
        found.append(cold.withColumnRenamed("fp", "lo").join(b, ["path", "key"])
                     .where(meet & close("lo", "hi")).select("lo", "hi"))
        hot = members.where("hot")
        paths = [r[0] for r in hot.select("path").distinct().collect()]  # at most one per variant
        if not paths:
            break
        # a fingerprint in several hot buckets of one path is indexed once
        rows = hot.select("path", "fp").distinct()
        parents = {i: made[i] for i in paths}
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out.select(F.least("lo", "hi").alias("a"), F.greatest("lo", "hi").alias("b")).distinct()


def near_dup_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    n: int = 3, max_bits: int = 2) -> DataFrame:
    """Fingerprint every text and group documents whose fingerprints are
    linked by steps of at most ``max_bits`` differing bits.

    Returns one row per input row: ``__id``, ``__text_hash``, ``__fp`` (signed
    long), ``__component`` (smallest id reachable, the row's own included)
    and ``__root`` (the fingerprint that names the component).

    Null text counts as empty; texts without words have fingerprint zero and
    link like any other.  A null id is the component id only where a
    whole component has no other.  Repeated rows and repeated ids are kept, one row each.
    Whole texts are read whatever their length.  An empty table gives an
    empty result; other columns of ``df`` are not looked at.
    """
    docs = cut(with_fingerprints(df, text_identity(df, id_col, text_col), F.col(text_col), n))
    fps = cut(docs.groupBy(F.col("__fp").alias("fp")).agg(F.min("__id").alias("id")))
    roots = connected_components(linked_pairs(fps, max_bits), "a", "b")
    grouped = fps.join(roots, fps["fp"] == roots["node"], "left").select(
        "fp", "id", F.coalesce("root", "fp").alias("root"))
    low = grouped.groupBy("root").agg(F.min("id").alias("__component"))
    named = grouped.join(low, "root").select(F.col("fp").alias("__fp"), F.col("root").alias("__root"), "__component")
    return docs.join(named, "__fp").select("__id", "__text_hash", "__fp", "__component", "__root")


def keep_one_per_group(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       n: int = 3, max_bits: int = 2) -> DataFrame:
    """``df`` with one row of each near-duplicate group: the one with the
    smallest (id, text hash).  All columns stay as they are.

    Null, empty, repeated and long texts as in ``near_dup_groups``; of rows
    that repeat id and text one stays.
    """
    groups = near_dup_groups(df, id_col, text_col, n, max_bits)
    sizes = groups.groupBy("__root", "__id", "__text_hash").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("__id").isNull().alias("z"), "__id", "__text_hash", "n"))
    best = cut(sizes.groupBy("__root").agg(first.alias("w")).select("w.__id", "w.__text_hash", "w.n"))
    cols = [F.col(f"d.`{c}`") for c in df.columns]
    match = [F.col(f"d.`{id_col}`").eqNullSafe(F.col("__id")),
             F.xxhash64(F.col(f"d.`{text_col}`")) == F.col("__text_hash")]
    single = df.alias("d").join(best.where("n = 1"), match, "left_semi").select(*cols)
    repeated = best.where("n > 1")
    if repeated.isEmpty():
        return single
    again = (df.alias("d").join(repeated, match, "left_semi").select(*cols)
             .withColumn("__key_text", F.xxhash64(F.col(text_col)))
             .dropDuplicates([id_col, "__key_text"]).select(*df.columns))
    return single.union(again)
