"""A5: labelled token-sequence source with a fixed train/test split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.sources.tables import load


def load_sequences(spark: SparkSession, base: str, label: str = "quality",
                   test_buckets: int = 1, buckets: int = 5) -> DataFrame:
    """documents joined to their labels, with a deterministic split: a
    document is ``test`` when the first 32 bits of its id's md5, modulo
    ``buckets``, are below ``test_buckets`` (the same in every engine and
    at every cluster size, no shuffle beyond the join)."""
    docs = load(spark, base, "documents").select("doc_id", "text")
    labels = load(spark, base, "labels").select("doc_id", F.col(label).alias("label"))
    head = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 8), 16, 10).cast("long")
    split = F.when(head % buckets < test_buckets, "test").otherwise("train")
    return docs.join(labels, "doc_id").select("doc_id", "text", "label", split.alias("split"))
