"""SparkSession helpers.

The library never hard-codes cluster settings; it only sets what result
parity depends on (UTC session time zone, ANSI arithmetic) and leaves sizing
(shuffle partitions, broadcast threshold, executor memory) to the caller.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings the library's results depend on.
REQUIRED_CONF = {
    # date_part('epoch') semantics on timestamp_ntz columns.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Settings that make plans adapt to data size at run time (AQE).
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "wardflow", extra: dict | None = None) -> SparkSession:
    """A local-mode session for tests and the bench (UI off, UTC, AQE on)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("WARDFLOW_DRIVER_MEMORY", "8g"))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         # Python call-site capture per Column call is a debugging aid; it costs
         # several py4j round trips per expression when plans are built
         .config("spark.python.sql.dataFrameDebugging.enabled", "false")
         # aggregated window rows are few bytes but CPU-heavy (LOCF, scores):
         # keep AQE from coalescing them onto one or two cores
         .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
         # delete reliable checkpoint files once their data is no longer referenced
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         # one BLAS thread per Python worker: Spark already runs one worker per core
         .config("spark.executorEnv.OPENBLAS_NUM_THREADS", "1")
         .config("spark.executorEnv.OMP_NUM_THREADS", "1"))
    for k, v in {**REQUIRED_CONF, **ADAPTIVE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_conf(spark)
    return spark


def ensure_conf(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on (idempotent, cheap)."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set by the deployment (a file system that all
    executors share): unset is an error there.  In local mode, where driver
    and executors are one process, a folder is chosen if none is set.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share "
                             f"(master {master!r})")
        d = tempfile.mkdtemp(prefix="wardflow-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def cluster_conf(input_bytes: int, total_cores: int, executor_memory_gb: float = 16.0,
                 cores_per_executor: int = 8) -> dict[str, str]:
    """Suggested settings for a cluster run (nothing here is applied by the
    library).  Sizes follow from the data, not from local testing:

    * file splits of 512 MB (fewer, larger scan tasks; at least 4 waves);
    * initial shuffle partitions so a partition of the largest shuffle
      (taken as a tenth of the input after column pruning and partial
      aggregation) is about 200 MB, never fewer than 2x the cores; AQE then
      coalesces by size (``parallelismFirst`` off) and splits skew;
    * broadcast up to 64 MB (e.g. one row per stay for millions of stays),
      bounded by an eighth of an executor's per-core memory.
    """
    mb = 1024 * 1024
    split = 512 * mb
    while input_bytes / split < 4 * total_cores and split > 64 * mb:
        split //= 2
    shuffle = max(2 * total_cores, int(input_bytes / 10 / (200 * mb)))
    per_core = executor_memory_gb * 1024 * mb / max(cores_per_executor, 1)
    bcast = int(min(64 * mb, per_core / 8))
    return {
        **REQUIRED_CONF, **ADAPTIVE_CONF,
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * mb),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * mb),
        "spark.sql.autoBroadcastJoinThreshold": str(bcast),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(bcast),
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.executorEnv.OPENBLAS_NUM_THREADS": "1",
        "spark.executorEnv.OMP_NUM_THREADS": "1",
    }
