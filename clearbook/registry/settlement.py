"""Settlement tables and the joins they consist of."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearbook import schemas
from clearbook.operators.prices import hourly_by_point
from clearbook.operators.skew import PAIRS_PER_TASK
from clearbook.plans import paired
from clearbook.plans.classic import classic_final as build_classic_final
from clearbook.registry import query
from clearbook.standin import MARKET_SQL, ROW_ORDER, market_tables

HOURLY_SQL = """hourly AS (
  SELECT delivery_date, hour_ending, settlement_point, avg(price) AS price,
    arg_min("interval", event_id) AS "interval", arg_min(point_type, event_id) AS point_type,
    arg_min(dst_flag, CASE WHEN dst_flag IS NOT NULL THEN event_id END) AS dst_flag
  FROM prices GROUP BY ALL)"""


def text_dates(df: DataFrame) -> DataFrame:
    """Dates as ISO text, so that both engines hand out the same value."""
    return df.withColumns({name: F.col(name).cast("string") for name, dtype in df.dtypes if dtype == "date"})


def rounded(df: DataFrame, *columns: str, digits: int = 7) -> DataFrame:
    """Averages and ratios rounded, because engines differ in the last bits."""
    return df.withColumns({name: F.round(F.col(name), digits) for name in columns})


def text_prices(df: DataFrame) -> DataFrame:
    """Both of these on rows with a market price."""
    return text_dates(rounded(df, "market_price"))


def hourly_tables(spark: SparkSession, sf_dir: str):
    """Stand-in tables with prices averaged per hour and point."""
    tables = market_tables(spark, sf_dir)
    hourly = hourly_by_point(tables.prices, F.col("event_id")).drop("event_id")
    return type(tables)(tables.bids, tables.bid_awards, tables.offers, tables.offer_awards, hourly)


def _branch_sql(side: str, awards: str, orders: str) -> str:
    def own(column: str, dtype: str, of: str) -> str:
        return column if of == side else f"CAST(NULL AS {dtype})"

    price = "CASE " + " ".join(f"WHEN o.mw{i} IS NOT NULL THEN o.price{i}" for i in range(1, 6)) + " END"
    size = "CASE " + " ".join(f"WHEN o.mw{i} IS NOT NULL THEN o.mw{i}" for i in range(1, 6)) + " END"
    return f"""SELECT CAST(a.delivery_date AS VARCHAR) AS delivery_date, a.hour_ending, a.settlement_point, a.qse_name,
    round(coalesce(p.price, a.award_price), 7) AS settlement_price, round(p.price, 7) AS mark_price,
    o.block_curve, '{side}' AS source_type,
    {own("a.award_mw", "DOUBLE", "Bid")} AS bid_award_mw, {own("a.order_id", "VARCHAR", "Bid")} AS bid_id,
    {own(price, "DOUBLE", "Bid")} AS bid_price, {own(size, "DOUBLE", "Bid")} AS bid_size,
    {own("a.award_mw", "DOUBLE", "Offer")} AS offer_award_mw, {own("a.order_id", "VARCHAR", "Offer")} AS offer_id,
    {own(price, "DOUBLE", "Offer")} AS offer_price, {own(size, "DOUBLE", "Offer")} AS offer_size
  FROM {awards} a
  JOIN common c ON a.delivery_date = c.delivery_date AND a.hour_ending = c.hour_ending
  LEFT JOIN {orders} o ON a.order_id = o.order_id AND a.delivery_date = o.delivery_date
    AND a.hour_ending = o.hour_ending
  LEFT JOIN hourly p ON a.settlement_point = p.settlement_point AND a.delivery_date = p.delivery_date
    AND a.hour_ending = p.hour_ending"""


COMMON_SQL = """common AS (
  SELECT delivery_date, hour_ending FROM bid_awards INTERSECT SELECT delivery_date, hour_ending FROM bids
  INTERSECT SELECT delivery_date, hour_ending FROM prices INTERSECT SELECT delivery_date, hour_ending FROM offers
  INTERSECT SELECT delivery_date, hour_ending FROM offer_awards)"""


@query(
    f"""{MARKET_SQL}, {HOURLY_SQL}, {COMMON_SQL}
{_branch_sql("Bid", "bid_awards", "bids")}
UNION ALL
{_branch_sql("Offer", "offer_awards", "offers")}"""
)
def classic_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per award of both sides, with order figures and hourly market price."""
    final = build_classic_final(hourly_tables(spark, sf_dir))
    return text_dates(rounded(final, "settlement_price", "mark_price"))


def first_sql(table: str, keys: list[str], order: list[str]) -> str:
    return (
        f"SELECT * FROM {table} QUALIFY row_number() OVER "
        f"(PARTITION BY {', '.join(keys)} ORDER BY {', '.join(order)}) = 1"
    )


def combined_sql(side: str) -> str:
    """CTE text of a combined table: first row per key on both inputs, NULL-safe match."""
    match = " AND ".join(f"a.{key} IS NOT DISTINCT FROM o.{key}" for key in schemas.ORDER_KEYS)
    curve = ["multi_hour_block", "block_curve", *schemas.LEVEL_COLUMNS]
    return f"""combined_{side}s AS (
  SELECT a.delivery_date, a.hour_ending, a.settlement_point, a.qse_name, a.order_id AS {side}_id,
    {", ".join(f"o.{name} AS {side}_{name}" for name in curve)},
    a.award_mw AS {side}_award_mw, a.award_price AS {side}_award_price
  FROM ({first_sql(f"{side}s", schemas.ORDER_KEYS, ROW_ORDER)}) o
  RIGHT JOIN ({first_sql(f"{side}_awards", schemas.ORDER_KEYS, ROW_ORDER)}) a ON {match})"""


PAIR_MATCH = " AND ".join(f"b.{key} IS NOT DISTINCT FROM o.{key}" for key in schemas.PAIR_KEYS)

@query(
    f"""{MARKET_SQL}, {combined_sql("bid")}
SELECT * REPLACE (CAST(delivery_date AS VARCHAR) AS delivery_date) FROM combined_bids"""
)
def combined_bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bid awards with their bids, first row per key, NULL keys matching."""
    return text_dates(paired.combined_bids(market_tables(spark, sf_dir), ROW_ORDER))


@query(
    f"""{MARKET_SQL}, {combined_sql("offer")}
SELECT * REPLACE (CAST(delivery_date AS VARCHAR) AS delivery_date) FROM combined_offers"""
)
def combined_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offer awards with their offers."""
    return text_dates(paired.combined_offers(market_tables(spark, sf_dir), ROW_ORDER))


@query(
    f"""{MARKET_SQL}, {combined_sql("bid")}, {combined_sql("offer")}
SELECT b.* REPLACE (CAST(b.delivery_date AS VARCHAR) AS delivery_date),
  o.* EXCLUDE ({", ".join(schemas.PAIR_KEYS)})
FROM combined_bids b JOIN combined_offers o ON {PAIR_MATCH}"""
)
def merged_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every bid award with every offer award of the same participant, point, date and hour."""
    tables = market_tables(spark, sf_dir)
    hot = paired.dense_cells(tables.bid_awards, tables.offer_awards, PAIRS_PER_TASK)
    return paired.pair_bids_with_offers(
        paired.combined_bids(tables, ROW_ORDER), paired.combined_offers(tables, ROW_ORDER), hot, text_dates
    )


PRICED_PAIRS_SQL = f"""{combined_sql("bid")}, {combined_sql("offer")}, pairs AS (
  SELECT b.*, o.* EXCLUDE ({", ".join(schemas.PAIR_KEYS)})
  FROM combined_bids b JOIN combined_offers o ON {PAIR_MATCH})"""

@query(
    f"""{MARKET_SQL}, {HOURLY_SQL}, {PRICED_PAIRS_SQL}, final AS (
  SELECT pairs.*, p.hour_ending AS delivery_hour, p."interval", p.point_type, p.price, p.dst_flag
  FROM pairs LEFT JOIN hourly p ON pairs.delivery_date IS NOT DISTINCT FROM p.delivery_date
    AND pairs.hour_ending IS NOT DISTINCT FROM p.hour_ending
    AND pairs.settlement_point IS NOT DISTINCT FROM p.settlement_point
  QUALIFY row_number() OVER (PARTITION BY {", ".join("pairs." + key for key in schemas.PAIR_KEYS)}, bid_id, offer_id
    ORDER BY p."interval") = 1)
SELECT * EXCLUDE (price) REPLACE (CAST(delivery_date AS VARCHAR) AS delivery_date), round(price, 7) AS market_price
FROM final WHERE price IS NOT NULL"""
)
def paired_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priced pairs of bid and offer awards."""
    tables = hourly_tables(spark, sf_dir)
    return paired.paired_final(tables, order=ROW_ORDER, price_order=["interval"], finish=text_prices)
