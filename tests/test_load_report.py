from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clearbook.operators.quality import Rule
from clearbook.plans.load_report import load_with_report

LAYOUT = "delivery_date date, n int"
ONE, TWO = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def test_states_and_counts(spark, rows, tmp_path):
    stored = spark.createDataFrame([(ONE, 0), (None, 0)], LAYOUT)
    files = {
        "a.csv": spark.createDataFrame([(ONE, 1), (TWO, 1), (TWO, 1), (ONE, -1), (None, 1), (TWO, None)], LAYOUT),
        "b/é.csv": spark.createDataFrame([], LAYOUT),
    }
    rules = [Rule("n: not positive", F.col("n") > 0)]
    for _ in range(2):
        loaded, report = load_with_report(spark, files, rules, stored, str(tmp_path / "out"))
        assert rows(report) == [("a.csv", 6, 3, 1, 2), ("b/é.csv", 0, 0, 0, 0)]
        assert rows(loaded, "delivery_date", "n", "state", "file") == sorted(
            [(ONE, 1, "skipped", "a.csv"), (TWO, 1, "stored", "a.csv"), (TWO, 1, "stored", "a.csv"), (ONE, -1, "rejected", "a.csv"),
             (None, 1, "stored", "a.csv"), (TWO, None, "rejected", "a.csv")],
            key=lambda r: tuple((v is not None, str(v)) for v in r),
        )


def test_a_broken_file_is_an_error(spark, tmp_path):
    bad = spark.createDataFrame([(ONE, 1)], LAYOUT).withColumn("n", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        load_with_report(spark, {"bad": bad}, [], bad.limit(0).select("delivery_date"), str(tmp_path / "out"))
