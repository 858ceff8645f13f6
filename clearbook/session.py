"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import functools
import re
import tempfile

from pyspark.sql import SparkSession

# Runtime settings every job expects.
JOB_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Rows may hold whole texts: a batch that goes to Python and back is in memory several times.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


# Fixed value: without this, every column expression asks the JVM where in the Python code it was written.
_NO_TRACING = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime options above on a live session and return it."""
    for key, value in JOB_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def wide_rows(spark: SparkSession) -> None:
    """From here on, compile steps over tens of columns operator by operator.

    As one method such a step is so long that the JVM compiles it badly or not at all: a join of pairs over 59 columns took
    9 microseconds a row as one method of 4,335 bytes.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "3000")


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None, **options: str) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own and calls ``apply_settings``."""
    builder = SparkSession.builder.master(master).appName("clearbook").config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**JOB_SETTINGS, **_NO_TRACING, **options}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder for written intermediate tables, visible to every executor.

    The cluster names it in ``spark.checkpoint.dir``. Only a single-process (local) session may fall back to a fresh
    temporary folder; elsewhere a missing setting is an error, because executors do not share a local disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_dir()


@functools.cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="clearbook-")
