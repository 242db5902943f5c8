"""Bloom filters as a column test.

A set of keys becomes a table of bits in one array of longs; a scalar
subquery hands it to every task, and a row is tested where it is scanned.
The table's size is bounded, whatever the number of keys: too many keys only
let more rows through, to the exact join that follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASHES = 4
#: 2 MB; about 1 % of other keys pass at 1.7 million keys.
DEFAULT_BITS = 1 << 24
MOST_BITS = 1 << 26


def _places(keys: list[Column], n_bits: int) -> Column:
    """The bits of a key (NULL where a part of it is NULL)."""
    known = keys[0].isNotNull()
    for k in keys[1:]:
        known = known & k.isNotNull()
    return F.when(known, F.array(*[F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(n_bits)) for seed in range(HASHES)]))


def _check(n_bits: int) -> None:
    if not 64 <= n_bits <= MOST_BITS or n_bits % 64:
        raise ValueError(f"n_bits must be a multiple of 64 up to {MOST_BITS}")


def bloom_table(keys: DataFrame, on: list[str], n_bits: int = DEFAULT_BITS) -> DataFrame:
    """One row, one array column ``bits``: the filter of ``keys``."""
    _check(n_bits)
    place = keys.select(F.explode(_places([F.col(c) for c in on], n_bits)).alias("b"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("b") % 64).cast("int"))
    cells = place.groupBy(F.floor(F.col("b") / 64).alias("cell")).agg(F.bit_or(bit).alias("bits"))
    every = keys.sparkSession.range(n_bits // 64).withColumnRenamed("id", "cell")
    full = every.join(cells, "cell", "left").select("cell", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    return full.agg(F.transform(F.array_sort(F.collect_list(F.struct("cell", "bits"))), lambda x: x["bits"]).alias("bits"))


def maybe_in(df: DataFrame, keys: DataFrame, on: list[str], n_bits: int = DEFAULT_BITS) -> DataFrame:
    """The rows of ``df`` whose key is in ``keys``, and a small share of others."""
    def is_set(b):
        # the table's column is referenced once, so Spark puts the subquery into this test and not into the rows
        return F.bit_get(F.get(F.col("__bits"), F.floor(b / 64).cast("int")), (b % 64).cast("int")) == 1
    held = df.withColumn("__bits", bloom_table(keys, on, n_bits).scalar())
    return held.where(F.forall(_places([F.col(c) for c in on], n_bits), is_set)).drop("__bits")
