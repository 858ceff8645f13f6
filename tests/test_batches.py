from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from clearbook.plans import batches, update
from tests.market import market, price


def day(number, month=1):
    return dt.date(2024, month, number)


def dated(spark, *days):
    return spark.createDataFrame([(d,) for d in days], "delivery_date date")


def test_a_failing_batch_leaves_the_others(spark, rows, tmp_path):
    numbers = spark.range(6)
    work = {
        "good": lambda: numbers.withColumn("x", F.lit("a")),
        "fails at row 3": lambda: numbers.withColumn("y", F.when(F.col("id") == 3, F.raise_error(F.lit("no")).cast("int"))),
        "not built": lambda: numbers.select("nothing"),
        "empty": lambda: numbers.limit(0),
    }
    for _ in range(2):
        kept, status = batches.run_batches(spark, work, str(tmp_path / "out"), 3)
        assert rows(kept, "batch", "id", "x") == [("good", i, "a") for i in range(6)]
        assert {r.batch: (r.stored, r.n_rows, r.reason and r.reason.split(":")[0]) for r in status.collect()} == {
            "good": (True, 6, None), "empty": (True, 0, None),
            "fails at row 3": (False, 0, "USER_RAISED_EXCEPTION"), "not built": (False, 0, "UNRESOLVED_COLUMN.WITH_SUGGESTION"),
        }
    assert not (tmp_path / "out" / batches._folder("fails at row 3")).exists()
    none, status = batches.run_batches(spark, {"bad": work["not built"]}, str(tmp_path / "none"))
    assert none is None and status.count() == 1


def test_islands_and_gaps(spark, rows):
    stored = {
        "a": dated(spark, day(3), day(4), day(4), day(7), None),
        "b": dated(spark, *(day(n) for n in range(1, 11))),
        "c": dated(spark).limit(0),
    }
    assert rows(update.date_islands(stored)) == [
        ("a", day(3), day(4), 2), ("a", day(7), day(7), 1), ("b", day(1), day(10), 10)
    ]
    assert rows(update.date_gaps(stored, "2024-01-02", "2024-01-08")) == [
        ("a", day(2), day(2), 1), ("a", day(5), day(6), 2), ("a", day(8), day(8), 1), ("c", day(2), day(8), 7)
    ]
    assert rows(update.date_gaps({"b": stored["b"]}, "2024-01-01", "2024-01-10")) == []
    assert rows(update.date_gaps(stored, "2024-01-08", "2024-01-02")) == []


def test_ranges_merge():
    assert update.merged_ranges([(day(5), day(6)), (day(1), day(2)), (day(3), day(3)), (day(6), day(9))]) == [
        (day(1), day(3)), (day(5), day(9))
    ]
    assert update.merged_ranges([]) == []


def test_only_the_holes_are_loaded(spark, rows):
    from clearbook.sources import tables

    database = "market_gaps"
    tables.create_tables(spark, database)
    try:
        source = market(spark, prices=[price(float(n), day=day(n)) for n in (1, 2, 3, 5)])
        now = dt.datetime(2024, 6, 1)
        tables.append_rows(source.prices.filter("delivery_date = '2024-01-02'").withColumn("price", F.lit(9.0)), f"{database}.prices", now)
        settled = []
        for _ in range(2):
            gaps = update.fill_gaps(source, database, "2024-01-01", "2024-01-05", now, lambda a, b: settled.append((a, b)))
        assert [g for g in gaps if g[0] == "prices"] == [("prices", day(4), day(4))]
        assert rows(spark.table(f"{database}.prices"), "delivery_date", "price") == [
            (day(1), 1.0), (day(2), 9.0), (day(3), 3.0), (day(5), 5.0)
        ]
        assert settled == [(day(1), day(1)), (day(3), day(3)), (day(5), day(5))]
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")
