"""Loads of files that report what became of their rows, counted while they are written."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from clearbook.operators.quality import Rule, check_rows

STATES = ("stored", "skipped", "rejected")
REPORT = "file string, n_read long, n_stored long, n_skipped long, n_rejected long"


def load_with_report(
    spark: SparkSession,
    files: Mapping[str, DataFrame],
    rules: list[Rule],
    stored: DataFrame,
    path: str,
    date: str = "delivery_date",
    side_by_side: int = 4,
) -> tuple[DataFrame, DataFrame]:
    """(rows, report): every file's rows with their state, and one row for each file with its counts.

    A row that breaks a rule is ``rejected``, with its ``reasons``; one whose date is stored already is ``skipped``; the
    others are ``stored``. A file is read once: one write puts its rows into a folder for each state below ``path``, and the
    counts are observed on the way. Writing a file again replaces what is there of it.
    """
    known = stored.select(F.col(date).alias("_known")).distinct()
    known = F.broadcast(known) if dict(stored.dtypes)[date] == "date" else known

    def load(name: str) -> tuple:
        judged = check_rows(files[name], rules).join(known, F.col(date) == F.col("_known"), "left")
        state = F.when(F.size("reasons") > 0, "rejected").when(F.col("_known").isNotNull(), "skipped").otherwise("stored")
        seen = Observation()
        counts = [F.count_if(F.col("state") == wanted).alias(wanted) for wanted in STATES]
        rows = judged.withColumn("state", state).drop("_known").observe(seen, F.count("*").alias("n"), *counts)
        rows.write.mode("overwrite").partitionBy("state").parquet(f"{path}/file={name.encode().hex()}")
        return name, seen.get["n"], *(seen.get[wanted] for wanted in STATES)

    with ThreadPoolExecutor(max(1, side_by_side)) as pool:
        runs = [pool.submit(inheritable_thread_target(spark)(load), name) for name in files]
        report = [run.result() for run in runs]
    written = [
        spark.read.schema(_with_state(files[name])).parquet(f"{path}/file={name.encode().hex()}").withColumn("file", F.lit(name))
        for name in files
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), written), spark.createDataFrame(report, REPORT)


def _with_state(frame: DataFrame) -> str:
    fields = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in frame.schema)
    return f"{fields}, reasons array<string>, state string"
