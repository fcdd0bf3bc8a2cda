"""Spark session defaults for the library.

Everything here is ordinary Spark configuration: adaptive execution (runtime
broadcast decisions from measured stage sizes, partition coalescing, skew-join
splitting), ANSI mode kept on so strict casts stay strict, UTC session time.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Runtime (AQE) broadcast threshold: a join side is broadcast only after its
# shuffle stage has run and its measured size is below this bound; above it the
# join stays a sort-merge join with skew splitting.
ADAPTIVE_BROADCAST_BYTES = 64 * 1024 * 1024


def cluster_conf(input_bytes: int, target_partition_bytes: int = 128 * 1024 * 1024) -> dict[str, str]:
    """Partition sizing for a run over ``input_bytes`` of source data.

    Shuffles start with enough partitions that the largest possible shuffle
    (every input byte) still lands at about ``target_partition_bytes`` per
    partition; adaptive execution then coalesces small shuffles (most here are
    aggregates) back down to the advisory size and splits skewed ones. Scans
    read splits of the same size. Example: 100 TiB -> 819,200 initial
    partitions, 128 MiB advisory size.
    """
    n = max(200, -(-input_bytes // target_partition_bytes))
    size = str(target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": size,
    }


def get_spark(
    master: str | None = None,
    app_name: str = "tussock",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(ADAPTIVE_BROADCAST_BYTES),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Rows sent to Python workers per Arrow batch; pages are large records.
        "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
        "spark.sql.parquet.filterPushdown": "true",
        # Remove checkpoint files once the checkpointed DataFrame is unreachable.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is always honoured.
    Only when it is unset in a session on one machine (``local[...]``, as in
    tests) is a scratch folder created and registered, so
    ``DataFrame.checkpoint()`` has somewhere to write; on a cluster that is an
    error, as executors would not see the driver's folder. With a
    remote (Connect) session the server's own setting applies and nothing is
    changed here.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no driver-side context
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="tussock-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path
