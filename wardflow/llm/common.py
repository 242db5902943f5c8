"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import string
import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.session import checkpoint_dir

#: ASCII white space; a word is a run of anything else.
SPACE_CLASS = r"[ \t\n\x0B\f\r]"


def documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """The whole ``documents`` table (or the named columns of it)."""
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return df.select(*cols) if cols else df


def ship_by_value(name: str) -> None:
    """Send a module's functions with the task (pickled by value), so Python
    workers do not need this package on their path."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared folder ``spark.checkpoint.dir`` and
    go on from the written files; a lost executor costs a re-read."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: A table measured to be no larger than this may be broadcast.
BROADCAST_BYTES = 8 << 20


def measured_bytes(df: DataFrame) -> int:
    """Size of a (checkpointed) table, by its rows and characters."""
    chars = [F.coalesce(F.sum(F.length(c)), F.lit(0)) for c, t in df.dtypes if t == "string"]
    n, *lengths = df.agg(F.count("*"), *chars).first()
    return n * (32 + 16 * len(df.columns)) + 4 * sum(lengths)


def join_small(big: DataFrame, small: DataFrame, on: str) -> DataFrame:
    """Equi join of large rows to a table that is nearly always small: it is
    broadcast if it is measured to be, so that the large side is not
    shuffled by a hot key; otherwise an ordinary join whose skew Spark splits."""
    return big.join(F.broadcast(small) if measured_bytes(small) <= BROADCAST_BYTES else small, on)


def quoted(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame, **named: str) -> DataFrame:
    """``df`` as the columns ``named`` (new name = its name in ``df``) and one
    struct ``__row`` of all others, so that no other name can clash."""
    rest = [quoted(c).alias(c) for c in df.columns if c not in named.values()]
    row = F.struct(*rest) if rest else F.lit(None).cast("struct<none:int>")
    return df.select(row.alias("__row"), *[quoted(c).alias(n) for n, c in named.items()])


def unpacked(df: DataFrame, columns: list[str], **named: str) -> list[Column]:
    """The columns of the frame that was packed, in its order and under its names."""
    new = {c: n for n, c in named.items()}
    return [(df[new[c]] if c in new else df["__row"].getField(c)).alias(c) for c in columns]


class Scratch:
    """Tables of one run in the shared folder ``spark.checkpoint.dir``, as
    Parquet: read back by column, in parts or more than once; a lost executor
    costs a re-read.  ``result`` writes the run's last rows as a checkpoint
    and then removes the tables."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.n = spark, 0
        self.folder = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def table(self, df: DataFrame) -> DataFrame:
        self.n += 1
        df.write.parquet(f"{self.folder}/{self.n}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{self.n}")

    def result(self, df: DataFrame) -> DataFrame:
        out = cut(df)
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        return out


def lower_az(text: Column) -> Column:
    """A-Z lower-cased, all other characters as they are."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    """The words of a text as an array (null text: no words)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), "")


def text_identity(df: DataFrame, id_col: str, text_col: str) -> list[Column]:
    """Two columns that name a document: its id and a hash of its text (rows
    that agree in both are copies of one document)."""
    return [F.col(id_col).alias("__id"), F.xxhash64(F.col(text_col)).alias("__text_hash")]
