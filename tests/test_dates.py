from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clearbook.functions import dates


def apply(spark, values, expression, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [row[0] for row in df.orderBy("i").select(expression(F.col("v"))).collect()]


GOLDENS = {
    "2024-06-01": "2024-06-01",
    "06/01/2024": "2024-06-01",
    "01/06/2024": "2024-06-01",
    "2024/06/01": "2024-06-01",
    "2024-13-01": "2024-13-01",
    "notadate": "notadate",
    "": "",
    None: None,
    "12345": "12345",
    "2024-02-29": "2024-02-29",
    "02/29/2024": "2024-02-29",
    "29/02/2024": "2024-02-29",
    "  2024-06-01 ": "2024-06-01",
    "06-01-2024": "2024-06-01",
    "1/13/2024": "2024-01-13",
    "2023-02-29": "2023-02-29",
}


def test_normalize_goldens(spark):
    assert apply(spark, list(GOLDENS), dates.normalize_date) == list(GOLDENS.values())


def test_day_first_rule_can_be_switched_off(spark):
    plain = apply(spark, ["01/06/2024", "02/06/2024"], lambda c: dates.normalize_date(c, day_first_when_one=False))
    assert plain == ["2024-01-06", "2024-02-06"]


def test_stored_dates(spark):
    texts = ["2024-05-06", "05/06/2024", "2024-05-06T10:00:00", "6.5.2024", None]
    day = dt.date(2024, 5, 6)
    assert apply(spark, texts, dates.parse_stored_date) == [day, day, day, None, None]


def test_flexible_bounds(spark):
    texts = ["2024-02-10", "2024-02", "2023-2", "x"]
    low, high = (apply(spark, texts, lambda c, s=s: dates.flexible_bound(c, s)) for s in (True, False))
    assert low == [dt.date(2024, 2, 10), dt.date(2024, 2, 1), dt.date(2023, 2, 1), None]
    assert high == [dt.date(2024, 2, 10), dt.date(2024, 2, 29), dt.date(2023, 2, 28), None]
    assert dates.parse_bound("2024-02", False) == dt.date(2024, 2, 29)
    assert dates.parse_bound("2024-12", False) == dt.date(2024, 12, 31)
    assert dates.parse_bound("2024-02", True) == dt.date(2024, 2, 1)
    with pytest.raises(ValueError):
        dates.parse_bound("Feb 2024", True)


def batches(spark, *args):
    rows = dates.date_batches(spark, *args).orderBy("batch").collect()
    return [(str(row.batch_start), str(row.batch_end)) for row in rows]


def test_first_day_batches(spark):
    assert batches(spark, "2024-01-01", "2024-01-05", 2, "first_day") == [
        ("2024-01-01", "2024-01-01"),
        ("2024-01-02", "2024-01-03"),
        ("2024-01-04", "2024-01-05"),
    ]
    assert batches(spark, "2024-01-01", "2024-01-03", 5, "first_day") == [("2024-01-01", "2024-01-03")]
    assert batches(spark, "2024-01-01", "2024-01-03", 2, "first_day") == [("2024-01-01", "2024-01-03")]


def test_forward_batches_are_capped(spark):
    assert batches(spark, "2024-01-01", "2024-01-05", 2, "forward") == [
        ("2024-01-01", "2024-01-02"),
        ("2024-01-03", "2024-01-04"),
        ("2024-01-05", "2024-01-05"),
    ]
    assert len(batches(spark, "2024-01-01", "2024-12-31", 500, "forward")) == 4
    with pytest.raises(ValueError, match="before it begins"):
        dates.date_batches(spark, "2024-01-02", "2024-01-01", 2)


def test_backward_batches(spark):
    assert batches(spark, "2024-01-01", "2024-01-05", 2, "backward") == [
        ("2024-01-04", "2024-01-05"),
        ("2024-01-02", "2024-01-03"),
        ("2024-01-01", "2024-01-01"),
    ]


def split(spark, start, end):
    df = spark.createDataFrame([(dt.date.fromisoformat(start), dt.date.fromisoformat(end))], "s date, e date")
    parts = df.select(dates.split_at_cutoff(F.col("s"), F.col("e"), "2024-01-10").alias("p")).first().p
    return [None if part is None else (str(part.start), str(part.end)) for part in (parts.archive, parts.current)]


def test_cutoff(spark):
    assert split(spark, "2024-01-01", "2024-01-05") == [("2024-01-01", "2024-01-05"), None]
    assert split(spark, "2024-01-10", "2024-01-12") == [None, ("2024-01-10", "2024-01-12")]
    assert split(spark, "2024-01-08", "2024-01-10") == [("2024-01-08", "2024-01-09"), ("2024-01-10", "2024-01-10")]


def test_months(spark, rows):
    assert rows(dates.months_of_range(spark, "2023-11-15", "2024-01-02", extra=1)) == [
        ("2023-11",), ("2023-12",), ("2024-01",), ("2024-02",)
    ]
    needed = dates.required_months(dates.days_of_range(spark, "2024-01-01", "2024-01-03"), "day", 60)
    assert rows(needed) == [("2024-03",)]
    wider = dates.required_months(dates.days_of_range(spark, "2024-01-01", "2024-02-03"), "day", 60)
    assert rows(wider) == [("2024-03",), ("2024-04",)]
