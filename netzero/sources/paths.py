"""Dataset path resolution and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def resolve_path(path: str, root: str | None = None) -> str:
    """Resolve a dataset path named in a request.

    Full URIs (``s3a://…``, ``hdfs://…``, ``file:/…``) pass through unchanged.
    A relative path — leading ``/`` stripped — is placed under ``root``
    (for example ``s3a://bucket``).  Without a root the path is used as given.
    """
    if "://" in path or path.startswith("file:"):
        return path
    if root is None:
        return path
    return f"{root.rstrip('/')}/{path.lstrip('/')}"


def shared_root(spark: SparkSession) -> str:
    """Folder shared by driver and executors for written intermediates.

    It is the cluster's ``spark.checkpoint.dir``.  Only a local-mode session
    without one (tests) gets a fresh local folder, registered as the
    checkpoint dir so later calls agree; on a cluster a machine-local folder
    would not be shared, so a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="netzero-"))
        root = spark.sparkContext.getCheckpointDir()
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """New, unused folder under the shared root for one run of one job."""
    root = shared_root(spark)
    return f"{root.rstrip('/')}/netzero/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a scratch folder and read back: computed once, and read
    again rather than recomputed after a lost executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
