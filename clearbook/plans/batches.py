"""Batches that run side by side, each as a job of its own: one that fails does not take the others with it."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from clearbook.sources.tables import remove_folder

log = logging.getLogger(__name__)

STATUS = "batch string, stored boolean, n_rows long, reason string"


def run_batches(
    spark: SparkSession, batches: Mapping[str, Callable[[], DataFrame]], path: str, side_by_side: int = 4
) -> tuple[DataFrame | None, DataFrame]:
    """Build and write every batch, and return the rows of those that worked and a status row for each.

    A batch is a function that builds a frame. It is written to a folder of its own below ``path`` under a job tag
    (``batch:<name>``), by which it can be cancelled; starting it again replaces the folder. An error while it is built or
    while it runs ends this batch only: its folder is removed, and its status has the reason. Rows are united by column
    name, absent columns NULL, with the name of their batch in ``batch``; they are None if no batch worked.
    """

    def work(name: str) -> tuple[str, bool, int, str | None]:
        seen, target = Observation(), f"{path}/{_folder(name)}"
        spark.addTag(f"batch:{_folder(name)}")
        try:
            batches[name]().observe(seen, F.count("*").alias("n")).write.mode("overwrite").parquet(target)
            return name, True, seen.get["n"], None
        except (PySparkException, ValueError, OSError) as error:
            log.error("batch %s failed: %s", name, error)
            remove_folder(spark, target)
            return name, False, 0, reason_of(error)
        finally:
            spark.removeTag(f"batch:{_folder(name)}")

    with ThreadPoolExecutor(max(1, side_by_side)) as pool:
        runs = [pool.submit(inheritable_thread_target(spark)(work), name) for name in batches]
        status = [run.result() for run in runs]
    kept = [
        spark.read.parquet(f"{path}/{_folder(name)}").withColumn("batch", F.lit(name)) for name, stored, _, _ in status if stored
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), kept) if kept else None
    return rows, spark.createDataFrame(status, STATUS)


def _folder(name: str) -> str:
    """A folder name for a batch: hex where the name has other characters than letters, digits and dashes."""
    plain = name.replace("-", "").isalnum() and name.isascii()
    return f"batch-{name}" if plain else f"batch_{name.encode().hex()}"


def reason_of(error: Exception) -> str:
    """Error class and first line of an error, as a status reason."""
    condition = error.getCondition() if isinstance(error, PySparkException) else None
    text = str(error).strip().splitlines()
    return f"{condition or type(error).__name__}: {text[0] if text else ''}"
