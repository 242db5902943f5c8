"""Constant-time lookup of array elements in a small table (K2).

A table of (key, value) rows becomes a hash table held in one array: slot
``xxhash64(key) mod slots`` has the entries of the keys that fall there,
about one where there are as many slots as keys.  The array comes from a
scalar subquery, so Spark builds it once per query and every task has it;
elements are then looked up by slot inside ``transform``, without a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 1 << 15
#: A table goes to every task: more entries than this fail the query.
MAX_ENTRIES = 1 << 20


def _slot(key: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def hash_table(rows: DataFrame, key: str, value: str, slots: int = SLOTS, max_entries: int = MAX_ENTRIES) -> DataFrame:
    """One row, one column ``buckets``: per slot an array of (k, v), NULL where
    there is none.  Keys are expected to be distinct; NULL keys are left out."""
    entry = F.struct(F.col(key).alias("k"), F.col(value).alias("v"))
    filled = (rows.where(F.col(key).isNotNull()).groupBy(_slot(F.col(key), slots).alias("slot"))
              .agg(F.collect_list(entry).alias("bucket")))
    every = rows.sparkSession.range(slots).select(F.col("id").cast("int").alias("slot"))
    buckets = F.transform(F.array_sort(F.collect_list(F.struct("slot", "bucket"))), lambda x: x["bucket"])
    n = F.coalesce(F.sum(F.when(F.col("bucket").isNotNull(), F.size("bucket"))), F.lit(0))
    return every.join(filled, "slot", "left").agg(F.when(n <= max_entries, buckets).otherwise(
        F.raise_error(F.lit(f"a lookup table holds at most {max_entries} entries"))).alias("buckets"))


def with_values(df: DataFrame, keys: str, name: str, table: DataFrame, key: str, value: str, default: Column,
                slots: int = SLOTS) -> DataFrame:
    """``df`` with a column ``name``: the values of the elements of array column
    ``keys``, ``default`` for those that ``table`` does not have."""
    def find(k):
        # the table's column is referenced once, so Spark puts the subquery into this expression and not into the rows
        bucket = F.get(F.col("__buckets"), _slot(k, slots))
        return F.coalesce(F.get(F.transform(F.filter(bucket, lambda e: e["k"] == k), lambda e: e["v"]), F.lit(0)), default)
    held = df.withColumn("__buckets", hash_table(table, key, value, slots).scalar())
    return held.withColumn(name, F.transform(keys, find)).drop("__buckets")
