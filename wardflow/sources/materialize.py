"""A3: materialised relations (the reference's materialised views).

Tables are written as parquet under the shared folder named by
``spark.checkpoint.dir`` (``wardflow.session.checkpoint_dir``), which also
cuts the lineage: the returned DataFrame reads the written files, so a lost
executor never recomputes the upstream plan.  Refresh is a full rewrite, as
``REFRESH MATERIALIZED VIEW`` is; ``wardflow.streaming`` appends
incrementally instead.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame

from wardflow.session import checkpoint_dir


BUCKET_BYTES = 256 * 1024 * 1024
#: Versions of a table that stay: the current one and the one readers may still hold.
KEPT_VERSIONS = 2


def table_path(spark, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), "tables", name)


def bucket_count(df: DataFrame) -> int:
    """Buckets of about ``BUCKET_BYTES`` of the files that ``df`` reads (a
    measured size: the optimizer's estimate multiplies the sides of joins),
    at least one per default parallel task."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    size = 0
    for folder in {os.path.dirname(f) for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        size += path.getFileSystem(conf).getContentSummary(path).getLength()
    return max(spark.sparkContext.defaultParallelism, -(-size // BUCKET_BYTES))


def _drop_old_versions(spark, name: str) -> None:
    jvm = spark._jvm
    base = jvm.org.apache.hadoop.fs.Path(table_path(spark, name))
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    versions = sorted(fs.listStatus(base), key=lambda f: -f.getModificationTime())
    for old in versions[KEPT_VERSIONS:]:
        spark.sql(f"DROP TABLE IF EXISTS `{name}_{old.getPath().getName()}`")
        fs.delete(old.getPath(), True)


def materialize(df: DataFrame, name: str, bucket_by: str | None = None, buckets: int = 0,
                partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` and return a DataFrame over the written table.

    Each write is a version of its own; the one before it stays for readers
    that still hold it, older ones are removed.

    ``bucket_by`` (with ``buckets``, by default from the data's size)
    hash-buckets and sorts the files by that key and registers the version in
    the session catalog, so later aggregations, joins and windows keyed by it
    need no shuffle.  All rows of a key share one bucket: use it when a
    key's row count is bounded; the unbucketed table keeps the
    partial-aggregate plan that spreads a hot key over many tasks.
    """
    spark = df.sparkSession
    version = uuid.uuid4().hex
    path = os.path.join(table_path(spark, name), version)
    n = buckets or (bucket_count(df) if bucket_by else 0)
    # one shuffle by the bucket key first, so each bucket is written by one
    # task as one file (otherwise every task writes a file per bucket)
    w = (df.repartition(n, bucket_by) if bucket_by else df).write.mode("overwrite").format("parquet")
    w = w.option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        table = f"{name}_{version}"
        w.bucketBy(n, bucket_by).sortBy(bucket_by).saveAsTable(table)
        out = spark.table(table)
    else:
        w.save()
        out = spark.read.parquet(path)
    _drop_old_versions(spark, name)
    return out


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into ``spark.checkpoint.dir`` (eager): the data is
    computed once and later passes read the written files; a lost executor
    never recomputes the upstream plan.  For inputs that a multi-pass job
    reads several times."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
