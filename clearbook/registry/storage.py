"""Sinks, yearly partitions, file listings and the ledger."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearbook.functions.dates import month_key
from clearbook.registry import query
from clearbook.registry.settlement import text_dates
from clearbook.session import shared_dir
from clearbook.sources import listing as listings
from clearbook.sources import tables
from clearbook.standin import MARKET_SQL, interval_prices, table


def fresh_path(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/clearbook-{what}-{uuid.uuid4().hex}"


@query(
    f"""{MARKET_SQL}
SELECT CAST(p.delivery_date AS VARCHAR) AS delivery_date, hour_ending, settlement_point, "interval", price, dst_flag
FROM prices p, range(2)"""
)
def append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices appended twice to a date-partitioned table and read back; a second append repeats the rows."""
    path = fresh_path(spark, "prices")
    prices = interval_prices(spark, sf_dir).drop("event_id")
    tables.write_by_date(prices, path)
    tables.write_by_date(prices, path)
    stored = spark.read.schema(prices.schema).parquet(path)
    return text_dates(stored.select("delivery_date", "hour_ending", "settlement_point", "interval", "price", "dst_flag"))


@query(
    "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey, o_totalprice FROM orders"
)
def yearly_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written with one partition per year, cleared first, and read back by partition."""
    path = fresh_path(spark, "orders")
    tables.write_by_year(table(spark, sf_dir, "orders"), path, date="o_orderdate", clear=True)
    return spark.read.parquet(path).select("year", "o_orderkey", "o_totalprice")


# Fixed value: first day of the file listing derived from the documents.
_LISTING_START = "1995-01-01"


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file listing out of the documents: posted over some 900 days, named by source and month."""
    posted = F.date_add(F.lit(_LISTING_START).cast("date"), (F.col("doc_id") % 900).cast("int"))
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.col("doc_id").alias("position"),
        F.concat(F.date_format(posted, "yyyy-MM-dd"), F.lit("T00:00:00")).alias("post_datetime"),
        F.concat_ws("_", "source", F.date_format(posted, "yyyy-MM"), "lang").alias("friendly_name"),
        "lang",
        "source",
    )


_LISTING_SQL = f"""WITH listing AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, doc_id AS position,
  strftime(DATE '{_LISTING_START}' + CAST(doc_id % 900 AS INTEGER), '%Y-%m-%d') || 'T00:00:00' AS post_datetime,
  source || '_' || strftime(DATE '{_LISTING_START}' + CAST(doc_id % 900 AS INTEGER), '%Y-%m') || '_' || lang
    AS friendly_name, lang, source FROM documents),
months AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month FROM orders)"""


def _wanted_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(month_key(F.col("o_orderdate")).alias("month")).distinct()


@query(
    f"""{_LISTING_SQL}, named AS (
  SELECT month, arg_min(doc_id, position) AS doc_id, arg_min(post_datetime, position) AS post_datetime,
    arg_min(friendly_name, position) AS friendly_name
  FROM months JOIN listing ON contains(friendly_name, month) GROUP BY month),
top AS (SELECT * FROM listing ORDER BY position LIMIT 1)
SELECT m.month, CAST(n.doc_id IS NOT NULL AS VARCHAR) AS exact, coalesce(n.doc_id, t.doc_id) AS doc_id,
  coalesce(n.post_datetime, t.post_datetime) AS post_datetime, coalesce(n.friendly_name, t.friendly_name) AS friendly_name
FROM months m LEFT JOIN named n ON m.month = n.month CROSS JOIN top t"""
)
def pick_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per month the first file named after it, else the first file of the listing."""
    chosen = listings.named_or_first(_listing(spark, sf_dir), _wanted_months(spark, sf_dir), "position")
    return chosen.withColumn("exact", F.col("exact").cast("string"))


@query(
    f"""{_LISTING_SQL}
SELECT substr(post_datetime, 1, 7) AS month, doc_id, post_datetime, friendly_name FROM listing
WHERE substr(post_datetime, 1, 7) IN (SELECT month FROM months)"""
)
def files_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files posted in a month that has orders."""
    files = listings.files_posted_in(_listing(spark, sf_dir), _wanted_months(spark, sf_dir))
    return files.select("month", "doc_id", "post_datetime", "friendly_name")


_LEDGER_SQL = f"""{_LISTING_SQL}, candidates AS (
  SELECT source AS product, substr(post_datetime, 1, 7) AS month, doc_id, position FROM listing),
ledger AS (SELECT product, month, arg_min(c.doc_id, c.position) AS doc_id FROM candidates c
  JOIN labels l ON l.doc_id = c.position AND l.quality = 1 GROUP BY product, month)"""


def _candidates_and_ledger(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    candidates = _listing(spark, sf_dir).select(
        F.col("source").alias("product"), F.substring("post_datetime", 1, 7).alias("month"), "doc_id", "position"
    )
    good = table(spark, sf_dir, "labels").filter(F.col("quality") == 1).select(F.col("doc_id").alias("position"))
    known = candidates.join(good, "position").groupBy("product", "month")
    return candidates, known.agg(F.min_by("doc_id", "position").alias("doc_id"))


@query(
    f"""{_LEDGER_SQL}
SELECT product, month, arg_min(doc_id, position) AS doc_id FROM candidates c
WHERE NOT EXISTS (SELECT 1 FROM ledger l WHERE l.product = c.product AND l.month = c.month) GROUP BY product, month"""
)
def ledger_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose product and month are not in the ledger, the first of each."""
    candidates, ledger = _candidates_and_ledger(spark, sf_dir)
    return listings.new_entries(candidates, ledger, "position").select("product", "month", "doc_id")


@query(
    f"""{_LEDGER_SQL}
SELECT c.product, c.month, c.doc_id, l.doc_id AS known_doc_id FROM candidates c JOIN ledger l
  ON l.product = c.product AND l.month = c.month WHERE l.doc_id <> c.doc_id"""
)
def ledger_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that disagree with the recorded one."""
    candidates, ledger = _candidates_and_ledger(spark, sf_dir)
    return listings.conflicting_entries(candidates, ledger).drop("position")
