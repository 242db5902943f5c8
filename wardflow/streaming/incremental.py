"""Incrementally maintained aggregated relations (A3).

The reference rebuilds its daily totals and window means from all events.
Here a relation is kept as mergeable partial states, one row per key: sums,
counts and maxima.  Every micro-batch adds the states of its own rows as one
folder, named by the batch's id; readers merge the folders by key, which is
the upsert.  A folder appears by a rename once it is complete, so a batch is
counted whole or not at all, and a batch that is sent again finds its folder
and changes nothing.  ``compact`` merges what has been committed into a base
folder, named by the last batch in it; later reads start from there.

A late event is a row like any other: its key's state grows.  One writer at
a time, as Structured Streaming has for a query; ids grow from batch to batch.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.functions.timecols import window_column
from wardflow.operators.aggregate import DAILY_VALUE
from wardflow.session import checkpoint_dir

MERGE = {"sum": F.sum, "max": F.max}


class MaintainedRelation:
    """Partial states by key under ``spark.checkpoint.dir``.

    ``keys`` and ``states`` are columns computed from a batch's rows; a state
    is (how two of them merge, ``sum`` or ``max``, and its value for one row,
    NULL where the row has no part in it)."""

    def __init__(self, spark: SparkSession, name: str, keys: dict[str, Column], states: dict[str, tuple[str, Column]],
                 where: Column | None = None):
        self.spark, self.keys, self.states, self.where = spark, keys, states, where
        self.folder = os.path.join(checkpoint_dir(spark), "relations", name)
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _ids(self, kind: str) -> list[int]:
        base = self._path(os.path.join(self.folder, kind))
        if not self._fs.exists(base):
            return []
        return sorted(int(f.getPath().getName()) for f in self._fs.listStatus(base))

    def _commit(self, df: DataFrame, kind: str, number: int) -> None:
        staged = os.path.join(self.folder, "staged", uuid.uuid4().hex)
        df.write.parquet(staged)
        target = self._path(os.path.join(self.folder, kind, str(number)))
        self._fs.mkdirs(target.getParent())
        if not self._fs.rename(self._path(staged), target):
            raise RuntimeError(f"{target} could not be committed")

    def _parts(self) -> tuple[list[str], int]:
        """Folders that make up the relation, and the last batch in its base."""
        bases = self._ids("base")
        last = bases[-1] if bases else -1
        folders = [os.path.join(self.folder, "base", str(last))] if bases else []
        return folders + [os.path.join(self.folder, "batch", str(i)) for i in self._ids("batch") if i > last], last

    def upsert(self, rows: DataFrame, batch_id: int) -> bool:
        """Count a batch's rows; False if this batch has been counted before."""
        if batch_id <= self._parts()[1] or batch_id in self._ids("batch"):
            return False
        rows = rows if self.where is None else rows.where(self.where)
        partial = rows.groupBy(*[c.alias(k) for k, c in self.keys.items()]).agg(
            *[MERGE[how](c).alias(s) for s, (how, c) in self.states.items()])
        self._commit(partial, "batch", batch_id)
        return True

    def read(self) -> DataFrame:
        """(keys, states) of all batches; an error before the first."""
        parts = self._parts()[0]
        if not parts:
            raise ValueError("no batch has been committed")
        return self.spark.read.parquet(*parts).groupBy(*self.keys).agg(
            *[MERGE[how](s).alias(s) for s, (how, _) in self.states.items()])

    def compact(self) -> None:
        """Merge the committed batches into a base.  The base before it stays
        for readers that still hold it, older ones and merged batches go."""
        batches = self._ids("batch")
        last = self._parts()[1]
        if batches and batches[-1] > last:
            self._commit(self.read(), "base", batches[-1])
        bases = self._ids("base")
        old = [("base", i) for i in bases[:-2]] + [("batch", i) for i in batches if len(bases) > 1 and i <= bases[-2]]
        for kind, i in old:
            self._fs.delete(self._path(os.path.join(self.folder, kind, str(i))), True)

    def start(self, stream: DataFrame, to_rows: Callable[[DataFrame], DataFrame] = lambda df: df, available_now: bool = True):
        """Keep the relation up with a stream; ``to_rows`` prepares a batch."""
        w = (stream.writeStream.foreachBatch(lambda df, batch_id: self.upsert(to_rows(df), batch_id) and None)
             .option("checkpointLocation", os.path.join(self.folder, "checkpoint")))
        return (w.trigger(availableNow=True) if available_now else w).start()


class WindowMeans(MaintainedRelation):
    """D3: means of the positive values per (stay, window, category)."""

    def __init__(self, spark: SparkSession, name: str, window_hours: int, stay: str = "icustay_id"):
        positive = F.col("valuenum") > 0
        super().__init__(spark, name, {
            stay: F.col(stay), "tw_hour_idx": F.col(window_column(window_hours)), "category": F.lower("itemcat")},
            {"total": ("sum", F.col("valuenum")), "n": ("sum", F.lit(1).cast("long"))}, positive)

    def means(self) -> DataFrame:
        """The rows of ``aggregate.window_means``."""
        return self.read().select(*self.keys, (F.col("total") / F.col("n")).alias("valuenum"))


class DailyTotals(MaintainedRelation):
    """Daily total of one category per stay, and whether any of it is positive."""

    def __init__(self, spark: SparkSession, name: str, category: str = "urine", stay: str = "icustay_id"):
        super().__init__(spark, name, {stay: F.col(stay), "tw_24hr": F.col("tw_24hr")},
                         {DAILY_VALUE: ("sum", F.col("valuenum")), "any_positive": ("max", F.col("valuenum") > 0)},
                         F.lower("itemcat") == category)

    def totals(self) -> DataFrame:
        """The rows of ``aggregate.daily_total``."""
        return self.read().drop("any_positive")
