"""Object-store and Parquet settings (S3-compatible stores through S3A).

These are deployment settings, passed to ``spark-submit --conf`` or the
session builder; nothing here computes.  Credentials are not handled here:
use the cluster's credential provider chain.
"""

from __future__ import annotations

# Multipart upload size, connection timeout, attempts, and the
# Parquet codec used for results.
MULTIPART_BYTES = 128 * 1024 * 1024
CONNECTION_TIMEOUT_MS = 60_000
MAX_ATTEMPTS = 10
DEFAULT_CODEC = "snappy"


def s3a_settings(endpoint: str | None = None, path_style: bool = True, ssl: bool = True,
                 multipart_bytes: int = MULTIPART_BYTES, connection_timeout_ms: int = CONNECTION_TIMEOUT_MS,
                 max_attempts: int = MAX_ATTEMPTS) -> dict[str, str]:
    """Spark confs for an S3-compatible endpoint (``spark.hadoop.fs.s3a.*``)."""
    conf = {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
        "spark.hadoop.fs.s3a.multipart.size": str(multipart_bytes),
        "spark.hadoop.fs.s3a.connection.timeout": str(connection_timeout_ms),
        "spark.hadoop.fs.s3a.attempts.maximum": str(max_attempts),
        "spark.hadoop.fs.s3a.fast.upload": "true",
    }
    if endpoint:
        conf["spark.hadoop.fs.s3a.endpoint"] = endpoint
    return conf


def parquet_settings(codec: str = DEFAULT_CODEC) -> dict[str, str]:
    """Session-wide Parquet write codec (``write_result`` also takes it per write)."""
    return {"spark.sql.parquet.compression.codec": codec}
