"""Session settings the jobs are tuned for.

On a cluster the session comes from ``spark-submit``; ``tune`` only sets the
SQL options the plans rely on (AQE with skew splitting, UTC).  ``local_session``
is for tests and the benchmark.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Runtime SQL options the plans are designed around.
RECOMMENDED_SQL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # AQE turns a sort-merge join into a shuffled hash join when every
    # partition of the measured build side fits this size: no sort of the
    # entries side when joining balanced groups back.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
}
# Sizes for cluster runs (not set in local sessions): scan splits of 256 MiB,
# ~128 MB shuffle partitions / output files after AQE coalescing and splitting.
CLUSTER_SQL_CONF = {
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
}
TARGET_PARTITION_BYTES = 128 * 1024 * 1024
SPLIT_BYTES = 256 * 1024 * 1024
MIN_BLOCK_BYTES = 16 * 1024


def shuffle_partitions_for(input_bytes: int, target_bytes: int = TARGET_PARTITION_BYTES) -> int:
    """Initial shuffle partition count for a job reading ``input_bytes``.

    AQE can merge small partitions but only splits skewed ones, so the
    initial count must be large enough that an average partition fits a task
    comfortably (no spill): about one per ``target_bytes`` of input.  Every map
    task writes a block for every partition, so the count is also kept where an
    average block has ``MIN_BLOCK_BYTES`` (a map task reads ``SPLIT_BYTES``):
    beyond about 2 TiB partitions get larger and spill, instead of the blocks
    getting too small to serve.
    """
    return max(200, min(-(-input_bytes // target_bytes), SPLIT_BYTES // MIN_BLOCK_BYTES))


def tune(spark: SparkSession, shuffle_partitions: int | None = None,
         cluster: bool = False) -> SparkSession:
    """Set the SQL options the plans rely on; with ``cluster`` also the split
    and partition sizes, and ``shuffle_partitions`` (see
    ``shuffle_partitions_for``) as the initial partition count."""
    conf = dict(RECOMMENDED_SQL_CONF)
    if cluster:
        conf.update(CLUSTER_SQL_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        spark.conf.set(k, v)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "netzero", extra: dict[str, str] | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("NETZERO_DRIVER_MEMORY", "8g"))
    )
    for k, v in {**RECOMMENDED_SQL_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
