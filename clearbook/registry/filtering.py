"""Filters, list semi joins and anti joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearbook.functions.dates import shift
from clearbook.operators import filters, joins, sets
from clearbook.plans import update
from clearbook.registry import query
from clearbook.registry.settlement import HOURLY_SQL, PRICED_PAIRS_SQL, rounded, text_dates, text_prices
from clearbook.sources import participants
from clearbook.standin import MARKET_SQL, ROW_ORDER, interval_prices, market_tables, table

_AWARD = ["delivery_date", "hour_ending", "settlement_point", "qse_name", "order_id", "award_mw"]
_AWARD_SQL = (
    "CAST(delivery_date AS VARCHAR) AS delivery_date, hour_ending, settlement_point, qse_name, order_id, award_mw"
)
_PRICE = ["delivery_date", "hour_ending", "interval", "settlement_point", "price", "event_id"]
_PRICE_SQL = (
    'CAST(delivery_date AS VARCHAR) AS delivery_date, hour_ending, "interval", settlement_point, price, event_id'
)

TRACKED_SQL = "SELECT 'Q' || CAST(n_nationkey AS VARCHAR) AS qse_name FROM nation WHERE n_regionkey = 1"


def tracked_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Participants tracked in the checks: those numbered like the nations of one region."""
    nations = table(spark, sf_dir, "nation").filter(F.col("n_regionkey") == 1)
    return nations.select(F.concat(F.lit("Q"), F.col("n_nationkey").cast("string")).alias("qse_name"))


def _awards_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bid awards where every seventh supplier leaves the participant out."""
    awards = market_tables(spark, sf_dir).bid_awards
    return awards.withColumn("qse_name", F.when(F.col("l_suppkey") % 7 != 0, F.col("qse_name")))


_GAPS_SQL = f"""{MARKET_SQL}, gaps AS (
  SELECT * REPLACE (CASE WHEN l_suppkey % 7 <> 0 THEN qse_name END AS qse_name) FROM bid_awards)"""


@query(f"{_GAPS_SQL} SELECT {_AWARD_SQL} FROM gaps WHERE qse_name IN ({TRACKED_SQL})")
def qse_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """awards of tracked participants, exact match."""
    kept = filters.keep_qses(_awards_with_gaps(spark, sf_dir), tracked_names(spark, sf_dir))
    return text_dates(kept.select(*_AWARD))


@query(
    f"{_GAPS_SQL} SELECT {_AWARD_SQL.replace('qse_name', 'lower(qse_name) AS qse_name')} FROM gaps "
    f"WHERE upper(qse_name) IN ({TRACKED_SQL})"
)
def qse_filter_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    """awards of tracked participants whatever the case of the name."""
    awards = _awards_with_gaps(spark, sf_dir).withColumn("qse_name", F.lower("qse_name"))
    return text_dates(filters.keep_qses_any_case(awards, tracked_names(spark, sf_dir)).select(*_AWARD))


@query(
    f"""{MARKET_SQL}
SELECT {_PRICE_SQL.replace("settlement_point", '"settlementPointName"')} FROM (SELECT *,
  CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE settlement_point END AS "settlementPointName" FROM prices)
WHERE "settlementPointName" IN ('click', 'error')"""
)
def point_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """prices at listed points; the first spelling of the point column decides, NULL and blank drop out."""
    prices = interval_prices(spark, sf_dir)
    name = F.when(F.col("event_id") % 5 == 1, F.lit("")).when(F.col("event_id") % 5 != 0, F.col("settlement_point"))
    spelled = prices.withColumn("settlementPointName", name).withColumnRenamed("settlement_point", "settlementPoint")
    kept = filters.keep_points(spelled, ["click", "error"])
    return text_dates(kept.select(*[c if c != "settlement_point" else "settlementPointName" for c in _PRICE]))


@query(f"{MARKET_SQL} SELECT {_PRICE_SQL} FROM prices")
def point_filter_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """an empty point list filters nothing under ``on_empty="pass"``."""
    prices = interval_prices(spark, sf_dir)
    nowhere = table(spark, sf_dir, "events").filter(F.col("value").isNull()).select("event_type")
    return text_dates(filters.keep_points(prices, nowhere, on_empty="pass").select(*_PRICE))


@query(f"{MARKET_SQL} SELECT {_PRICE_SQL} FROM prices WHERE delivery_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-11'")
def date_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    """prices of an inclusive date range."""
    kept = filters.between_dates(interval_prices(spark, sf_dir), "2024-01-05", "2024-01-11")
    return text_dates(kept.select(*_PRICE))


@query(
    """SELECT o_orderkey, status, day, amount, 'x' AS inserted_at FROM (SELECT o_orderkey,
  CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus WHEN o_orderkey % 2 = 0 THEN ' ' END AS status,
  CASE WHEN o_orderkey % 5 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '' END AS day,
  CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS amount FROM orders)
WHERE trim(status) <> '' OR day <> '' OR amount IS NOT NULL"""
)
def drop_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rows with a value outside the bookkeeping columns, here the key and the load time."""
    key = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        key,
        F.when(key % 3 != 0, F.col("o_orderstatus")).when(key % 2 == 0, F.lit(" ")).alias("status"),
        F.when(key % 5 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("").alias("day"),
        F.when(key % 7 != 0, F.col("o_totalprice")).alias("amount"),
        F.lit("x").alias("inserted_at"),
    )
    return filters.drop_empty(rows, meta=("o_orderkey", "inserted_at"))


@query(
    f"""{MARKET_SQL}
SELECT settlement_point FROM bid_awards WHERE award_mw > 0 UNION SELECT settlement_point FROM offer_awards
WHERE award_mw > 0"""
)
def active_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct points with a positive award on either side."""
    tables = market_tables(spark, sf_dir)
    return sets.active_points(tables.bid_awards, tables.offer_awards, positive_only=True)


#: The points on a list that is kept beside the market tables: three of the five, by the regions of the nations.
LISTED_SQL = """SELECT DISTINCT CASE n_regionkey % 3 WHEN 0 THEN 'click' WHEN 1 THEN 'view' ELSE 'error' END AS settlement_point
  FROM nation"""


def listed_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    point = F.element_at(F.array(F.lit("click"), F.lit("view"), F.lit("error")), (F.col("n_regionkey") % 3 + 1).cast("int"))
    return table(spark, sf_dir, "nation").select(point.alias("settlement_point")).distinct()


@query(
    f"""{MARKET_SQL}, listed AS ({LISTED_SQL}), active AS (
  SELECT settlement_point FROM bid_awards WHERE award_mw > 0 UNION SELECT settlement_point FROM offer_awards WHERE award_mw > 0)
SELECT {_PRICE_SQL} FROM prices
WHERE settlement_point IN (SELECT settlement_point FROM active WHERE settlement_point IN (SELECT settlement_point FROM listed))"""
)
def active_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices at the listed points where awards were made."""
    tables = market_tables(spark, sf_dir)
    active = sets.active_points(tables.bid_awards, tables.offer_awards, positive_only=True)
    kept = joins.prices_at_points(tables.prices, filters.keep_points(active, listed_points(spark, sf_dir)))
    return text_dates(kept.select(*_PRICE))


@query(
    f"""{MARKET_SQL}
SELECT CAST(delivery_date AS VARCHAR) AS delivery_date, hour_ending FROM bid_awards
INTERSECT SELECT CAST(delivery_date AS VARCHAR), hour_ending FROM bids
INTERSECT SELECT CAST(delivery_date AS VARCHAR), hour_ending FROM prices
INTERSECT SELECT CAST(delivery_date AS VARCHAR), hour_ending FROM offers
INTERSECT SELECT CAST(delivery_date AS VARCHAR), hour_ending FROM offer_awards
ORDER BY 1, 2"""
)
def common_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(date, hour) pairs present in all five tables, in order."""
    pairs = sets.common_pairs(market_tables(spark, sf_dir).all())
    return text_dates(pairs).orderBy("delivery_date", "hour_ending")


_SHIP_SQL = """WITH incoming AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  CASE WHEN l_linenumber < 7 THEN CAST(l_shipdate AS DATE) END AS delivery_date FROM lineitem),
stored AS (SELECT CAST(o_orderdate AS DATE) AS delivery_date FROM orders
  WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')"""


@query(
    f"""{_SHIP_SQL}
SELECT * REPLACE (CAST(delivery_date AS VARCHAR) AS delivery_date) FROM incoming i
WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.delivery_date = i.delivery_date)"""
)
def new_rows_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose date is not stored yet; a missing date counts as new."""
    date = F.when(F.col("l_linenumber") < 7, F.to_date("l_shipdate")).alias("delivery_date")
    incoming = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", date)
    urgent = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P")
    stored = table(spark, sf_dir, "orders").filter(urgent).select(F.to_date("o_orderdate").alias("delivery_date"))
    return text_dates(joins.new_by_date(incoming, stored))


@query(
    f"""{MARKET_SQL}, incoming AS (SELECT * REPLACE (
    CASE WHEN event_id % 11 <> 0 THEN delivery_date END AS delivery_date,
    CASE WHEN event_id % 13 <> 0 THEN hour_ending END AS hour_ending) FROM prices),
stored AS (SELECT * FROM prices WHERE settlement_point = 'click' AND delivery_date < DATE '2024-01-20')
SELECT {_PRICE_SQL} FROM incoming i
WHERE CASE WHEN delivery_date IS NULL THEN TRUE
  WHEN hour_ending IS NULL OR "interval" IS NULL
    THEN NOT EXISTS (SELECT 1 FROM stored s WHERE s.delivery_date = i.delivery_date)
  ELSE NOT EXISTS (SELECT 1 FROM stored s WHERE s.delivery_date = i.delivery_date AND s.hour_ending = i.hour_ending
    AND s."interval" = i."interval") END"""
)
def new_rows_by_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price rows whose (date, hour, interval) is not stored yet; judged by date where the hour is missing."""
    prices = interval_prices(spark, sf_dir)
    incoming = prices.withColumns(
        {
            "delivery_date": F.when(F.col("event_id") % 11 != 0, F.col("delivery_date")),
            "hour_ending": F.when(F.col("event_id") % 13 != 0, F.col("hour_ending")),
        }
    )
    stored = prices.filter((F.col("settlement_point") == "click") & (F.col("delivery_date") < "2024-01-20"))
    return text_dates(joins.new_by_interval(incoming, stored).select(*_PRICE))


@query(
    """SELECT DISTINCT trim(short) AS qse_name FROM (
  SELECT CASE WHEN s_suppkey % 9 = 0 THEN '  ' WHEN s_suppkey % 10 <> 0
    THEN ' Q' || CAST(s_suppkey % 20 AS VARCHAR) || ' ' END AS short FROM supplier) WHERE trim(short) <> ''"""
)
def qse_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct trimmed short names of a tracking list."""
    key = F.col("s_suppkey")
    named = F.concat(F.lit(" Q"), (key % 20).cast("string"), F.lit(" "))
    short = F.when(key % 9 == 0, F.lit("  ")).when(key % 10 != 0, named)
    return participants.short_names(table(spark, sf_dir, "supplier").select(short.alias(participants.SHORT_NAME)))


@query(
    f"""{MARKET_SQL}, late AS (SELECT * REPLACE (CAST(delivery_date + 59 AS DATE) AS delivery_date) FROM prices)
SELECT 'prices' AS what, CAST(delivery_date AS VARCHAR) AS delivery_date, hour_ending, settlement_point, price AS amount
FROM late WHERE delivery_date = DATE '2024-03-10' - 1
UNION ALL
SELECT 'awards', CAST(delivery_date AS VARCHAR), hour_ending, settlement_point, award_mw
FROM bid_awards WHERE delivery_date = DATE '2024-03-10' - 60"""
)
def daily_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """yesterday's prices and the awards of sixty days ago; prices are moved to where a live feed has them."""
    tables = market_tables(spark, sf_dir)
    late = tables.prices.withColumn("delivery_date", shift(F.col("delivery_date"), 59))
    prices, awards = update.daily_slice(late, tables.bid_awards, "2024-03-10")
    common = ["delivery_date", "hour_ending", "settlement_point"]
    return text_dates(
        prices.select(F.lit("prices").alias("what"), *common, F.col("price").alias("amount")).unionAll(
            awards.select(F.lit("awards").alias("what"), *common, F.col("award_mw").alias("amount"))
        )
    )


def _tracked_cte(name: str) -> str:
    return f"""{name} AS (SELECT * FROM all_{name} WHERE qse_name IN ({TRACKED_SQL})
  AND delivery_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-25')"""


_UPDATE_MARKET = MARKET_SQL
for _name in ("bids", "bid_awards", "offers", "offer_awards", "prices"):
    _UPDATE_MARKET = _UPDATE_MARKET.replace(f"\n{_name} AS (", f"\nall_{_name} AS (")


@query(
    f"""{_UPDATE_MARKET}, {_tracked_cte("bids")}, {_tracked_cte("bid_awards")}, {_tracked_cte("offers")},
{_tracked_cte("offer_awards")},
prices AS (SELECT * FROM all_prices WHERE delivery_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
  AND settlement_point IN (SELECT settlement_point FROM bid_awards WHERE award_mw > 0
    UNION SELECT settlement_point FROM offer_awards WHERE award_mw > 0)),
{HOURLY_SQL}, {PRICED_PAIRS_SQL}
SELECT CAST(pairs.delivery_date AS VARCHAR) AS delivery_date, pairs.hour_ending, pairs.settlement_point, qse_name,
  bid_id, offer_id, bid_award_mw, offer_award_mw, round(p.price, 7) AS market_price
FROM pairs JOIN hourly p ON pairs.delivery_date = p.delivery_date AND pairs.hour_ending = p.hour_ending
  AND pairs.settlement_point = p.settlement_point
WHERE p.price IS NOT NULL"""
)
def update_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: pair settlement rows an incremental update appends, tracked participants only."""
    rows = update.update_slice(
        market_tables(spark, sf_dir),
        tracked_names(spark, sf_dir),
        ("2024-01-03", "2024-01-25"),
        ("2024-01-05", "2024-01-20"),
        ROW_ORDER,
        F.col("event_id"),
        text_prices,
    )
    keys = ["delivery_date", "hour_ending", "settlement_point", "qse_name", "bid_id", "offer_id"]
    return rows.select(*keys, "bid_award_mw", "offer_award_mw", "market_price")
