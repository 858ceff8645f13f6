"""Stand-in market tables over the sample tables.

The sample tables hold no market data, so the five inputs of the settlement jobs are derived from ``lineitem`` (orders
and awards) and ``events`` (prices), row by row, over the whole tables. ``MARKET_SQL`` is the same derivation as SQL
text for the cross-check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearbook.plans.classic import MarketTables

# The settlement points are the five event types.
POINTS = ["click", "view", "error", "signup", "purchase"]
# On every fifth day the offer market is taken to close at this hour, so that not every (date, hour) pair is common.
LAST_OFFER_HOUR = 20
LEVELS = range(1, 11)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` with the market keys added."""
    point = F.element_at(F.array(*[F.lit(name) for name in POINTS]), (F.col("l_suppkey") % 5 + 1).cast("int"))
    return table(spark, sf_dir, "lineitem").withColumns(
        {
            "delivery_date": F.date_add(F.lit("2024-01-01").cast("date"), (F.col("l_orderkey") % 30).cast("int")),
            "hour_ending": (F.col("l_partkey") % 24 + 1).cast("int"),
            "settlement_point": F.when(F.col("l_suppkey") % 50 != 0, point),
            "qse_name": F.when(
                F.col("l_partkey") % 60 != 0, F.concat(F.lit("Q"), (F.col("l_suppkey") % 20).cast("string"))
            ),
            "order_id": F.when(
                F.col("l_orderkey") % 70 != 0,
                F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")),
            ),
        }
    )


# Total order of the derived rows, standing for "position in the file".
ROW_ORDER = ["l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax"]

_KEYS = ["delivery_date", "hour_ending", "settlement_point", "qse_name"]


def _level(level: int) -> tuple[str, str]:
    """Quantity and price of a level: the first with a quantity is 1 to 7, or there is none; prices may be missing."""
    return (
        f"CASE WHEN l_partkey % 8 < 7 AND l_partkey % 8 < {level} THEN l_quantity * {level} END AS mw{level}",
        f"CASE WHEN (l_suppkey + {level}) % 7 <> 0 THEN l_extendedprice + {level} END AS price{level}",
    )


def _orders(lines: DataFrame) -> DataFrame:
    return lines.selectExpr(
        *_KEYS,
        *[column for level in LEVELS for column in _level(level)],
        "order_id",
        "CASE WHEN l_linenumber % 2 = 0 THEN 'Y' ELSE 'N' END AS multi_hour_block",
        "CASE WHEN l_linenumber % 3 = 0 THEN 'V' ELSE '' END AS block_curve",
        *ROW_ORDER,
    )


def _awards(lines: DataFrame) -> DataFrame:
    return lines.selectExpr(
        *_KEYS, "l_quantity AS award_mw", "l_extendedprice / l_quantity AS award_price", "order_id", *ROW_ORDER
    )


def interval_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarter-hour prices, with ``event_id`` as the position in the file."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.to_date("ts").alias("delivery_date"),
        (F.hour("ts") + 1).cast("int").alias("hour_ending"),
        (F.floor(F.minute("ts") / 15) + 1).cast("int").alias("interval"),
        F.col("event_type").alias("settlement_point"),
        F.lit("LZ").alias("point_type"),
        F.col("value").alias("price"),
        F.when(F.col("event_id") % 2 == 0, F.lit("N")).alias("dst_flag"),
        "event_id",
    )


def market_tables(spark: SparkSession, sf_dir: str) -> MarketTables:
    """The five stand-in tables; prices are raw intervals. Every line is an award of one side, nine of ten an order."""
    lines = line_rows(spark, sf_dir)
    bid, offer, ordered = (F.col("l_linenumber") % 2 == 1), (F.col("l_linenumber") % 2 == 0), (F.col("l_partkey") % 10 != 9)
    closed = (F.col("l_orderkey") % 5 == 0) & (F.col("hour_ending") > LAST_OFFER_HOUR)
    return MarketTables(
        bids=_orders(lines.filter(bid & ordered)),
        bid_awards=_awards(lines.filter(bid)),
        offers=_orders(lines.filter(offer & ordered & ~closed)),
        offer_awards=_awards(lines.filter(offer)),
        prices=interval_prices(spark, sf_dir),
    )


_LEVELS_SQL = ",\n    ".join(column for level in LEVELS for column in _level(level))

_ORDERS_SQL = f"""SELECT delivery_date, hour_ending, settlement_point, qse_name,
    {_LEVELS_SQL},
    order_id,
    CASE WHEN l_linenumber % 2 = 0 THEN 'Y' ELSE 'N' END AS multi_hour_block,
    CASE WHEN l_linenumber % 3 = 0 THEN 'V' ELSE '' END AS block_curve,
    l_partkey, l_suppkey, l_extendedprice, l_discount, l_tax
  FROM li"""

_AWARDS_SQL = """SELECT delivery_date, hour_ending, settlement_point, qse_name,
    l_quantity AS award_mw, l_extendedprice / l_quantity AS award_price, order_id,
    l_partkey, l_suppkey, l_extendedprice, l_discount, l_tax
  FROM li"""

MARKET_SQL = f"""WITH li AS (
  SELECT *,
    CAST(DATE '2024-01-01' + CAST(l_orderkey % 30 AS INTEGER) AS DATE) AS delivery_date,
    CAST(l_partkey % 24 + 1 AS INTEGER) AS hour_ending,
    CASE WHEN l_suppkey % 50 = 0 THEN NULL ELSE CASE l_suppkey % 5 WHEN 0 THEN 'click' WHEN 1 THEN 'view' WHEN 2 THEN 'error' WHEN 3 THEN 'signup'
      ELSE 'purchase' END END AS settlement_point,
    CASE WHEN l_partkey % 60 <> 0 THEN 'Q' || CAST(l_suppkey % 20 AS VARCHAR) END AS qse_name,
    CASE WHEN l_orderkey % 70 <> 0 THEN CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END AS order_id
  FROM lineitem),
bids AS ({_ORDERS_SQL} WHERE l_linenumber % 2 = 1 AND l_partkey % 10 <> 9),
bid_awards AS ({_AWARDS_SQL} WHERE l_linenumber % 2 = 1),
offers AS ({_ORDERS_SQL} WHERE l_linenumber % 2 = 0 AND l_partkey % 10 <> 9
  AND NOT (l_orderkey % 5 = 0 AND hour_ending > {LAST_OFFER_HOUR})),
offer_awards AS ({_AWARDS_SQL} WHERE l_linenumber % 2 = 0),
prices AS (
  SELECT CAST(ts AS DATE) AS delivery_date, CAST(hour(ts) + 1 AS INTEGER) AS hour_ending,
    CAST(minute(ts) // 15 + 1 AS INTEGER) AS "interval", event_type AS settlement_point, 'LZ' AS point_type,
    value AS price, CASE WHEN event_id % 2 = 0 THEN 'N' END AS dst_flag, event_id
  FROM events)"""
