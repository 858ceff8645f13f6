"""Hourly prices, profiles, distinct values and high-water marks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearbook.operators import prices as price_ops
from clearbook.operators import quality, sets
from clearbook.plans import update
from clearbook.registry import query
from clearbook.registry.settlement import rounded, text_dates
from clearbook.standin import MARKET_SQL, interval_prices, line_rows, table


def _gappy_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interval prices with some hours and prices missing and some prices not a number."""
    event = F.col("event_id")
    price = F.when(event % 17 == 0, F.lit(float("nan"))).when(event % 19 != 0, F.col("price"))
    return interval_prices(spark, sf_dir).withColumns(
        {"hour_ending": F.when(event % 23 != 0, F.col("hour_ending")), "price": price}
    )


_GAPPY_SQL = f"""{MARKET_SQL}, gappy AS (SELECT * REPLACE (
  CASE WHEN event_id % 23 <> 0 THEN hour_ending END AS hour_ending,
  CASE WHEN event_id % 17 <> 0 AND event_id % 19 <> 0 THEN price END AS price) FROM prices)"""

_FIRSTS_SQL = """arg_min("interval", event_id) AS "interval", arg_min(point_type, event_id) AS point_type,
  round(avg(price), 7) AS price,
  arg_min(dst_flag, CASE WHEN dst_flag IS NOT NULL THEN event_id END) AS dst_flag"""


@query(
    f"""{_GAPPY_SQL}
SELECT CAST(delivery_date AS VARCHAR) AS delivery_date, hour_ending,
  arg_min(settlement_point, event_id) AS settlement_point, {_FIRSTS_SQL}
FROM gappy GROUP BY delivery_date, hour_ending"""
)
def spp_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: mean price per date and hour over all points; rows without an hour form their own group."""
    hourly = price_ops.hourly_by_hour(_gappy_prices(spark, sf_dir), F.col("event_id"))
    return text_dates(rounded(hourly.drop("event_id"), "price"))


@query(
    f"""{_GAPPY_SQL}
SELECT CAST(delivery_date AS VARCHAR) AS delivery_date, hour_ending, settlement_point, {_FIRSTS_SQL}
FROM gappy WHERE hour_ending IS NOT NULL GROUP BY delivery_date, hour_ending, settlement_point"""
)
def spp_hourly_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: mean price per date, hour and point; rows without an hour drop out."""
    hourly = price_ops.hourly_by_point(_gappy_prices(spark, sf_dir), F.col("event_id"))
    return text_dates(rounded(hourly.drop("event_id"), "price"))


@query("SELECT round(avg(value), 7) AS avg_price FROM events WHERE event_type = 'click'")
def point_avg_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean price of one point."""
    return rounded(price_ops.point_average(interval_prices(spark, sf_dir), "click"), "avg_price")


@query("SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS delivery_date FROM orders")
def distinct_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: distinct stored dates."""
    dates = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("delivery_date"))
    return text_dates(sets.distinct_values(dates, "delivery_date"))


@query(
    """SELECT CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS latest FROM orders WHERE o_orderkey % 4 <> 3"""
)
def high_water(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest date of text dates in several layouts, some unreadable."""
    kind, date = F.col("o_orderkey") % 4, F.col("o_orderdate")
    text = (
        F.when(kind == 0, F.date_format(date, "yyyy-MM-dd"))
        .when(kind == 1, F.date_format(date, "MM/dd/yyyy"))
        .when(kind == 2, F.date_format(date, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format(date, "dd.MM.yyyy"))
    )
    stored = table(spark, sf_dir, "orders").select(text.alias("delivery_date"))
    return text_dates(update.high_water(stored))


@query(
    """WITH l AS (SELECT l_orderkey, l_linenumber, l_returnflag,
  CASE WHEN l_linenumber <> 3 THEN l_linestatus END AS l_linestatus FROM lineitem)
SELECT 'l_linenumber' AS column_name, count(DISTINCT l_linenumber) AS n_distinct,
  CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_special FROM l
UNION ALL SELECT 'l_returnflag', count(DISTINCT l_returnflag), count(*), 0 FROM l
UNION ALL SELECT 'l_linestatus', count(DISTINCT l_linestatus), count(*), count(*) - count(l_linestatus) FROM l
UNION ALL SELECT '*', count(*), CAST(sum(n) AS BIGINT), CAST(sum(n - 1) AS BIGINT)
  FROM (SELECT count(*) AS n FROM l GROUP BY l_orderkey, l_linenumber, l_returnflag, l_linestatus)"""
)
def load_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct and missing values per column, and rows that repeat another in full."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        F.when(F.col("l_linenumber") != 3, F.col("l_linestatus")).alias("l_linestatus"),
    )
    return quality.load_profile(lines, ["l_linenumber", "l_returnflag", "l_linestatus"])


@query(
    """SELECT source, count(*) AS n_in, count(*) FILTER (n_chars > 500) AS n_stored,
  count(*) - count(*) FILTER (n_chars > 500) AS n_skipped FROM documents GROUP BY source"""
)
def rows_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that came in, were stored and were skipped, per source."""
    documents = table(spark, sf_dir, "documents").select("source", "n_chars")
    return quality.stored_and_skipped(documents, documents.filter(F.col("n_chars") > 500), "source")


@query(
    f"""{MARKET_SQL}, names AS (SELECT CASE WHEN l_suppkey % 3 = 0 THEN lower(qse_name) ELSE qse_name END AS qse_name
  FROM li)
SELECT string_agg(qse_name, ',' ORDER BY qse_name) AS names
FROM (SELECT DISTINCT qse_name FROM names WHERE starts_with(qse_name, 'Q'))"""
)
def q_name_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted comma list of the names starting with a capital Q."""
    name = F.when(F.col("l_suppkey") % 3 == 0, F.lower("qse_name")).otherwise(F.col("qse_name"))
    return sets.q_name_list(line_rows(spark, sf_dir).select(name.alias("qse_name")))
