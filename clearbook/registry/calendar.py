"""Dates, lags, months, cutoff and batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearbook.functions import dates
from clearbook.registry import query
from clearbook.registry.settlement import text_dates
from clearbook.standin import interval_prices, table


def _order_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))


# Layouts the order dates are spelled in for the date checks, by order key.
_LAYOUTS = ["yyyy-MM-dd", "yyyy/M/d", "MM/dd/yyyy", "d/M/yyyy", "M-d-yyyy", "' 'yyyy-M-d' '", "yyyy-MM", "MMM yyyy"]
_SQL_LAYOUTS = ["%Y-%m-%d", "%Y/%-m/%-d", "%m/%d/%Y", "%-d/%-m/%Y", "%-m-%-d-%Y", " %Y-%-m-%-d ", "%Y-%m", "%b %Y"]


def _spelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as text in changing layouts, with blank and missing ones in between."""
    key = F.col("o_orderkey") % 10
    text = F
    for number, layout in enumerate(_LAYOUTS):
        text = text.when(key == number, F.date_format("day", layout))
    return _order_dates(spark, sf_dir).select("o_orderkey", text.when(key == 8, F.lit(" ")).alias("text"))


_SPELLED_SQL = (
    "WITH spelled AS (SELECT o_orderkey, CASE o_orderkey % 10 "
    + " ".join(f"WHEN {n} THEN strftime(o_orderdate, '{layout}')" for n, layout in enumerate(_SQL_LAYOUTS))
    + " WHEN 8 THEN ' ' END AS text FROM orders)"
)


@query(
    f"""{_SPELLED_SQL}
SELECT o_orderkey, text, CASE WHEN trim(text) = '' THEN text ELSE coalesce(strftime(coalesce(
  try_strptime(trim(text), '%Y-%m-%d'), try_strptime(trim(text), '%Y/%m/%d'),
  CASE WHEN regexp_matches(trim(text), '^0?1/(0?[1-9]|1[0-2])/') THEN try_strptime(trim(text), '%d/%m/%Y') END,
  try_strptime(trim(text), '%m/%d/%Y'), try_strptime(trim(text), '%d/%m/%Y'),
  try_strptime(trim(text), '%m-%d-%Y')), '%Y-%m-%d'), trim(text)) END AS normalized
FROM spelled"""
)
def normalize_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO text of dates in several layouts; unreadable text stays."""
    return _spelled(spark, sf_dir).select("o_orderkey", "text", dates.normalize_date(F.col("text")).alias("normalized"))


@query(
    f"""{_SPELLED_SQL}
SELECT o_orderkey, strftime(coalesce(d, m), '%Y-%m-%d') AS first_day,
  strftime(coalesce(d, last_day(m)), '%Y-%m-%d') AS final_day
FROM (SELECT o_orderkey, try_strptime(text, '%Y-%m-%d') AS d, try_strptime(text, '%Y-%m') AS m FROM spelled
  WHERE text = trim(text) UNION ALL SELECT o_orderkey, NULL, NULL FROM spelled WHERE text IS NULL OR text <> trim(text))"""
)
def flexible_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day, or a month as its first and last day."""
    bounds = _spelled(spark, sf_dir).select(
        "o_orderkey",
        dates.flexible_bound(F.col("text"), True).alias("first_day"),
        dates.flexible_bound(F.col("text"), False).alias("final_day"),
    )
    return text_dates(bounds)


@query(
    """SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) - 60, '%Y-%m-%d') AS minus_60,
  strftime(CAST(o_orderdate AS DATE) + 60, '%Y-%m-%d') AS plus_60,
  strftime(o_orderdate + INTERVAL 2 MONTH, '%Y-%m-%d') AS plus_2_months,
  strftime(CAST(o_orderdate AS DATE) - 1, '%Y-%m-%d') AS day_before FROM orders"""
)
def lag_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signed lags in days and months."""
    day = F.col("day")
    shifted = _order_dates(spark, sf_dir).select(
        "o_orderkey",
        dates.shift(day, -60).alias("minus_60"),
        dates.shift(day, 60).alias("plus_60"),
        dates.shift(day, months=2).alias("plus_2_months"),
        dates.shift(day, -1).alias("day_before"),
    )
    return text_dates(shifted)


@query(
    """SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month_start,
  strftime(last_day(o_orderdate), '%Y-%m-%d') AS month_end, strftime(o_orderdate, '%Y-%m') AS month_key,
  strftime(date_trunc('year', o_orderdate), '%Y-%m-%d') AS year_start,
  strftime(o_orderdate, '%Y') || '-12-31' AS year_end FROM orders"""
)
def month_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month and year bounds and the month key."""
    day = F.col("day")
    keys = _order_dates(spark, sf_dir).select(
        "o_orderkey",
        dates.month_start(day).alias("month_start"),
        dates.month_end(day).alias("month_end"),
        dates.month_key(day).alias("month_key"),
        dates.year_start(day).alias("year_start"),
        dates.year_end(day).alias("year_end"),
    )
    return text_dates(keys)


@query("SELECT DISTINCT strftime(CAST(ts AS DATE) + INTERVAL 60 DAY, '%Y-%m') AS month FROM events")
def required_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publication months of the priced dates under a lag of sixty days."""
    return dates.required_months(interval_prices(spark, sf_dir), "delivery_date", 60)


@query(
    """SELECT CASE WHEN o_orderdate < DATE '1998-03-15' THEN 'archive' ELSE 'current' END AS source,
  strftime(min(o_orderdate), '%Y-%m-%d') AS first_day, strftime(max(o_orderdate), '%Y-%m-%d') AS final_day
FROM orders GROUP BY 1"""
)
def cutoff_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date range per source, split at a cutoff."""
    labelled = _order_dates(spark, sf_dir).withColumn("source", dates.source_for_date(F.col("day"), "1998-03-15"))
    return text_dates(dates.bounds_by(labelled, ["source"], "day", "first_day", "final_day"))


def _batched(spark: SparkSession, sf_dir: str, days: int, mode: str) -> DataFrame:
    number = dates.batch_number(F.col("day"), "1995-01-01", "2001-08-01", days, mode)
    labelled = _order_dates(spark, sf_dir).withColumn("batch", number)
    return text_dates(dates.bounds_by(labelled, ["batch"], "day", "batch_start", "batch_end"))


def _batch_sql(number: str) -> str:
    return f"""SELECT CAST({number} AS INTEGER) AS batch, strftime(min(o_orderdate), '%Y-%m-%d') AS batch_start,
  strftime(max(o_orderdate), '%Y-%m-%d') AS batch_end FROM orders GROUP BY 1"""


_OFFSET_SQL = "date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE))"


@query(_batch_sql(f"{_OFFSET_SQL} // 100"))
def date_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of days from the start; 250 asked for, capped at 100."""
    return _batched(spark, sf_dir, 250, "forward")


@query(_batch_sql(f"CASE WHEN {_OFFSET_SQL} = 0 THEN 0 ELSE 1 + ({_OFFSET_SQL} - 1) // 45 END"))
def date_batches_first_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first day alone, then runs of days."""
    return _batched(spark, sf_dir, 45, "first_day")


@query(_batch_sql("date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-01') // 30") + " ORDER BY batch_start DESC")
def date_batches_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of days from the end, newest first."""
    return _batched(spark, sf_dir, 30, "backward").orderBy(F.desc("batch_start"))
