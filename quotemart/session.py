"""Spark session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits a hot shuffle partition of a sort-merge join, also when that costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A load compiles some hundred stages; the default of 100 would compile them anew on every run.
    "spark.sql.codegen.cache.maxEntries": "2000",
    # Listing a table by day takes this many tasks at most, not one for each day.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.parquet.compression.codec": "snappy",
}


# Shuffled bytes per task; adaptive execution joins partitions that turn out small.
TASK_BYTES = 256 * 1024 * 1024


def shuffle_partitions(input_bytes: int) -> int:
    """Shuffle partitions for an input of this size, so that each fits in a task's memory."""
    return max(200, -(-input_bytes // TASK_BYTES))


def build_session(
    app: str = "quotemart", master: str | None = None, input_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with the defaults above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if input_bytes:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions(input_bytes)))
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder the cluster names in ``spark.checkpoint.dir``.

    Executors on other machines must see what is staged here, so a machine-local folder is taken
    only for a local master without that setting, as in tests.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="quotemart-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
