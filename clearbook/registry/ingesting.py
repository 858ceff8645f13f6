"""Round trips through files: CSV scan by header, streaming ingest, price load, source cutoff."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearbook.operators.conform import conform_table, publish
from clearbook.plans.backfill import select_source
from clearbook.plans.price_load import new_prices
from clearbook.registry import query
from clearbook.registry.filtering import LISTED_SQL, listed_points
from clearbook.registry.settlement import rounded, text_dates
from clearbook.registry.storage import fresh_path
from clearbook.schemas import AWARDS, CLASSIC_NAMES
from clearbook.sources.delimited import scan_by_header
from clearbook.standin import MARKET_SQL, interval_prices, market_tables, table
from clearbook.streaming.ingest import ingest_files


@query(
    f"""{MARKET_SQL}
SELECT CAST(delivery_date AS VARCHAR) AS delivery_date, hour_ending, settlement_point, qse_name, award_mw, award_price,
  order_id FROM bid_awards WHERE award_mw <= 25
UNION ALL SELECT CAST(delivery_date AS VARCHAR), hour_ending, settlement_point, qse_name, award_mw, NULL, order_id
FROM bid_awards WHERE award_mw > 25"""
)
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Awards written as CSV files of two different layouts, read back by each file's own header."""
    path = fresh_path(spark, "csv")
    awards = market_tables(spark, sf_dir).bid_awards.select(*AWARDS.names)
    low, high = awards.filter("award_mw <= 25"), awards.filter("award_mw > 25")
    publish(low, CLASSIC_NAMES["bid_awards"]).write.option("header", True).csv(f"{path}/a")
    high.select(
        F.col("order_id").alias("Bid ID"),
        F.date_format("delivery_date", "yyyy/M/d").alias("Delivery Date"),
        F.col("qse_name").alias("QSE Name"),
        F.col("hour_ending").alias("Hour Ending"),
        F.col("settlement_point").alias("Settlement Point"),
        F.col("award_mw").alias("Energy Only Bid Award in MW"),
    ).write.option("header", True).csv(f"{path}/b")
    scanned = scan_by_header(spark, [f"{path}/a", f"{path}/b"], "bid_awards")
    return text_dates(conform_table(scanned, "bid_awards"))


# Fixed value: published header of the price files.
_PRICE_HEADER = [name for column, name in CLASSIC_NAMES["prices"].items() if column != "inserted_at"]


@query(
    f"""{MARKET_SQL}
SELECT CAST(delivery_date AS VARCHAR) AS delivery_date, hour_ending, settlement_point, "interval", price, dst_flag
FROM prices"""
)
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price files taken in by a stream in two drops and a third run without news; every row arrives once."""
    path = fresh_path(spark, "stream")
    prices = interval_prices(spark, sf_dir).drop("event_id")
    drops = [prices.filter("delivery_date < '2024-01-15'"), prices.filter("delivery_date >= '2024-01-15'"), None]
    for drop in drops:
        if drop is not None:
            publish(drop, CLASSIC_NAMES["prices"]).write.mode("append").option("header", True).csv(f"{path}/drop")
        run = ingest_files(spark, f"{path}/drop", _PRICE_HEADER, "prices", f"{path}/prices", f"{path}/checkpoint")
        run.awaitTermination()
    stored = spark.read.parquet(f"{path}/prices")
    return text_dates(stored.select("delivery_date", "hour_ending", "settlement_point", "interval", "price", "dst_flag"))


@query(
    f"""{MARKET_SQL}, stored AS (SELECT * FROM prices WHERE settlement_point = 'click' AND delivery_date < DATE '2024-01-20')
SELECT CAST(delivery_date AS VARCHAR) AS delivery_date, hour_ending, settlement_point, round(avg(price), 7) AS price,
  arg_min("interval", event_id) AS "interval", 'LZ' AS point_type,
  arg_min(dst_flag, CASE WHEN dst_flag IS NOT NULL THEN event_id END) AS dst_flag
FROM prices p WHERE settlement_point IN ({LISTED_SQL}) AND NOT EXISTS (
  SELECT 1 FROM stored s WHERE s.delivery_date = p.delivery_date AND s.hour_ending = p.hour_ending
    AND s."interval" = p."interval")
GROUP BY delivery_date, hour_ending, settlement_point"""
)
def price_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records under published names to new hourly prices at listed points."""
    prices = interval_prices(spark, sf_dir)
    stored = prices.filter((F.col("settlement_point") == "click") & (F.col("delivery_date") < "2024-01-20"))
    records = publish(prices, CLASSIC_NAMES["prices"] | {"event_id": "event_id"})
    points = listed_points(spark, sf_dir)
    return text_dates(rounded(new_prices(records, stored, "event_id", points=points), "price"))


@query(
    """SELECT 'archive' AS source, o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS delivery_date FROM orders
WHERE o_orderdate < DATE '1998-03-15'
UNION ALL SELECT 'current', l_orderkey, strftime(l_shipdate, '%Y-%m-%d') FROM lineitem
WHERE l_shipdate >= DATE '1998-03-15'"""
)
def source_by_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows before a cutoff from one source, rows on and after it from the other."""
    archive = table(spark, sf_dir, "orders").select(
        F.lit("archive").alias("source"), F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").alias("delivery_date")
    )
    current = table(spark, sf_dir, "lineitem").select(
        F.lit("current").alias("source"), F.col("l_orderkey").alias("id"), F.to_date("l_shipdate").alias("delivery_date")
    )
    return text_dates(select_source(archive, current, "1998-03-15"))
