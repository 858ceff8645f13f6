"""Headers, load times, required columns, empty inputs, load reports, and the scenario over day files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearbook import schemas
from clearbook.operators import conform as conforming
from clearbook.operators import filters, joins, quality
from clearbook.operators.bounded import SmallList
from clearbook.operators.sketches import BOUND, column_sketches, merged_sketches, sketched_profile
from clearbook.plans.load_report import load_with_report
from clearbook.registry import query
from clearbook.registry.filtering import TRACKED_SQL, tracked_names
from clearbook.registry.jobs import LOADED_AT, fresh_database
from clearbook.registry.settlement import COMMON_SQL, HOURLY_SQL, _branch_sql, rounded, text_dates
from clearbook.registry.storage import fresh_path
from clearbook.schemas import AWARDS, CLASSIC_NAMES, ORDERS
from clearbook.sources import tables
from clearbook.sources.delimited import scan_by_header, scan_prices
from clearbook.standin import MARKET_SQL, interval_prices, market_tables, table
from clearbook.streaming.hourly import ingest_hourly, read_hourly
from clearbook.streaming.ingest import batch_writer, ingest_and_merge


def _misspelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bid awards under headers that differ from the published ones; the price is not there, a note is."""
    return market_tables(spark, sf_dir).bid_awards.select(
        F.col("delivery_date").alias(" DELIVERY date"), F.col("hour_ending").alias("Hour-Ending"),
        F.col("settlement_point").alias("SETTLTMENTPOINT"), F.col("qse_name").alias("QSE Name "),
        F.col("award_mw").alias("EnergyOnlyBidAwardInMW"), F.col("order_id").alias("bid_id"),
        F.col("l_partkey").alias(" Load Note"),
    )


@query(
    f"""{MARKET_SQL}
SELECT CAST(delivery_date AS VARCHAR) AS delivery_date, hour_ending, settlement_point, qse_name, award_mw, order_id,
  l_partkey AS load_note FROM bid_awards"""
)
def renamed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Misspelled headers corrected, an unknown one in its plain form."""
    return text_dates(conforming.rename_by_alias(_misspelled(spark, sf_dir), "bid_awards", unknown="snake"))


@query(
    f"""{MARKET_SQL}, counted AS (
  SELECT count(delivery_date) AS delivery_date, count(hour_ending) AS hour_ending, count(settlement_point) AS settlement_point,
    count(qse_name) AS qse_name, count(award_mw) AS award_mw, count(order_id) AS order_id, count(l_partkey) AS " Load Note"
  FROM bid_awards)
SELECT field, CASE field WHEN ' Load Note' THEN 'extra' ELSE 'present' END AS state, n_values
FROM (UNPIVOT counted ON COLUMNS(*) INTO NAME field VALUE n_values)
UNION ALL SELECT 'award_price', 'missing', 0"""
)
def field_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which fields of the layout the records have, lack, or have beyond it, with their numbers of values."""
    renamed, missing, extra = conforming.rename_with_report(_misspelled(spark, sf_dir), "bid_awards")
    states = {name: "missing" if name in missing else "extra" if name in extra else "present" for name in [*renamed.columns, *missing]}
    counted = [(F.count(F.col(f"`{name}`")) if name in renamed.columns else F.lit(0)).cast("long") for name in states]
    cells = [
        F.struct(F.lit(name).alias("field"), F.lit(state).alias("state"), n.alias("n_values"))
        for (name, state), n in zip(states.items(), counted)
    ]
    return renamed.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


@query(
    f"""{MARKET_SQL}
SELECT CAST(delivery_date AS VARCHAR) AS delivery_date, order_id, award_mw, '{LOADED_AT:%Y-%m-%d %H:%M:%S}' AS inserted_at
FROM offer_awards"""
)
def stamped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rows carry the load time."""
    database = fresh_database(spark)
    tables.append_rows(market_tables(spark, sf_dir).offer_awards, f"{database}.offer_awards", LOADED_AT)
    stored = spark.table(f"{database}.offer_awards").select("delivery_date", "order_id", "award_mw", "inserted_at")
    return text_dates(stored).withColumn("inserted_at", F.date_format("inserted_at", "yyyy-MM-dd HH:mm:ss"))


@query(
    f"""{MARKET_SQL}
SELECT 'bid_awards' AS table_name, '' AS lacking, count(*) AS n_rows FROM bid_awards
UNION ALL SELECT 'bids', 'mw1,price1', 0 FROM bids HAVING count(*) > 0
UNION ALL SELECT 'prices', 'point_type', 0 FROM prices HAVING count(*) > 0"""
)
def required_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames that lack required columns are refused with the names; a complete one is counted."""
    market = market_tables(spark, sf_dir)
    frames = {
        "bid_awards": (market.bid_awards, AWARDS.names),
        "bids": (market.bids.drop("mw1", "price1"), ORDERS.names),
        "prices": (market.prices.drop("point_type"), schemas.PRICES.names),
    }
    rows = []
    for name, (frame, wanted) in frames.items():
        try:
            quality.require_columns(frame, wanted, name)
            lacking, counted = "", frame
        except ValueError:
            lacking, counted = ",".join(sorted(set(wanted) - set(frame.columns))), frame.limit(0)
        rows.append(counted.agg(F.lit(name).alias("table_name"), F.lit(lacking).alias("lacking"), F.count("*").alias("n_rows")))
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query(
    f"""{MARKET_SQL}
SELECT 'bids' AS table_name, count(*) AS n_rows FROM bids UNION ALL SELECT 'prices', count(*) FROM prices"""
)
def empty_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """of several frames to be stored, absent and empty ones are passed over."""
    database, market = fresh_database(spark), market_tables(spark, sf_dir)
    none = market.offers.filter(F.col("hour_ending") > 99)
    frames = {"bids": market.bids, "offers": none, "bid_awards": None, "prices": market.prices}
    written = tables.append_tables(frames, database, LOADED_AT)
    counted = [
        spark.table(f"{database}.{name}").agg(F.lit(name).alias("table_name"), F.count("*").alias("n_rows")) for name in written
    ]
    return counted[0].unionByName(counted[1])


#: The price files of a load: each has the prices of one point.
_FILES = ["click", "view", "error", "signup", "purchase"]
_SMALL = 50


@query(
    f"""{MARKET_SQL}, judged AS (
  SELECT settlement_point AS file, CASE WHEN price IS NULL OR price < {_SMALL} THEN 'rejected'
    WHEN delivery_date < DATE '2024-01-11' THEN 'skipped' ELSE 'stored' END AS state FROM prices)
SELECT file, count(*) AS n_read, count(*) FILTER (state = 'stored') AS n_stored,
  count(*) FILTER (state = 'skipped') AS n_skipped, count(*) FILTER (state = 'rejected') AS n_rejected
FROM judged WHERE file IS NOT NULL GROUP BY file"""
)
def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per file of a load the rows read, stored, skipped as known, and rejected, counted while they are written."""
    market = interval_prices(spark, sf_dir)
    stored = market.filter(F.col("delivery_date") < "2024-01-11").select("delivery_date")
    rules = [quality.Rule("price: too small", F.col("price") >= _SMALL)]
    files = {name: market.filter(F.col("settlement_point") == name) for name in _FILES}
    return load_with_report(spark, files, rules, stored, fresh_path(spark, "report"))[1]


@query(
    f"""{MARKET_SQL}, kept AS (SELECT * FROM bid_awards WHERE qse_name IN ({TRACKED_SQL}))
SELECT k.settlement_point, count(*) AS n_awards, any_value(s.avg_price) AS avg_price
FROM kept k JOIN (SELECT settlement_point, round(avg(price), 7) AS avg_price FROM prices GROUP BY ALL) s
  ON k.settlement_point = s.settlement_point
GROUP BY k.settlement_point"""
)
def day_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Awards and prices as files, kept by a tracking list; per point that both have, awards and the mean price."""
    path, market = fresh_path(spark, "day"), market_tables(spark, sf_dir)
    for name, frame, layout in (("bid_awards", market.bid_awards, AWARDS), ("prices", market.prices, schemas.PRICES)):
        published = conforming.publish(frame.select(*layout.names), CLASSIC_NAMES[name])
        published.write.option("header", True).csv(f"{path}/{name}")
    awards = conforming.conform_table(scan_by_header(spark, f"{path}/bid_awards", "bid_awards"), "bid_awards")
    spot = conforming.conform_table(scan_prices(spark, f"{path}/prices"), "prices")
    kept = filters.keep_qses(awards, tracked_names(spark, sf_dir))
    # The points of the awards are those that are counted: one pass over the award files gives both.
    counted = SmallList(kept.groupBy("settlement_point").agg(F.count("*").alias("n_awards"))).frame
    overlap = joins.prices_at_points(spot, counted.select("settlement_point"))
    mean = overlap.groupBy("settlement_point").agg(F.round(F.avg("price"), 7).alias("avg_price"))
    return counted.join(mean, "settlement_point")


@query(
    f"""{MARKET_SQL}, {HOURLY_SQL}, {COMMON_SQL}
{_branch_sql("Bid", "bid_awards", "bids")}
UNION ALL
{_branch_sql("Offer", "offer_awards", "offers")}"""
)
def stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Award files taken in by a stream in two drops; after each the settlement of the touched dates is rebuilt."""
    root, market = fresh_path(spark, "merge"), market_tables(spark, sf_dir)
    for name in ("bids", "offers", "offer_awards", "prices"):
        rows = getattr(market, name).select(*schemas.TABLES[name].names)
        batch_writer(root, name, lambda dates, session: None)(rows, 0)
    header = [CLASSIC_NAMES["bid_awards"][name] for name in AWARDS.names]
    early = F.col("delivery_date") < "2024-01-16"
    for part in (early, ~early):
        rows = market.bid_awards.filter(part).select(*AWARDS.names)
        conforming.publish(rows, CLASSIC_NAMES["bid_awards"]).write.mode("append").option("header", True).csv(f"{root}-drop")
        run = ingest_and_merge(spark, f"{root}-drop", header, "bid_awards", root, f"{root}-checkpoint", 1)
        run.awaitTermination()
    return text_dates(rounded(spark.read.parquet(f"{root}/final"), "settlement_price", "mark_price"))


@query(
    f"""{MARKET_SQL}
SELECT CAST(delivery_date AS VARCHAR) AS delivery_date, hour_ending, settlement_point, round(avg(price), 7) AS price,
  min("interval") AS "interval", count(*) AS n_intervals
FROM prices WHERE settlement_point IS NOT NULL GROUP BY ALL"""
)
def stream_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price files taken in by a stream in three drops, out of order and cutting through hours."""
    path = fresh_path(spark, "hourly")
    header = [CLASSIC_NAMES["prices"][name] for name in schemas.PRICES.names]
    market = interval_prices(spark, sf_dir).select(*schemas.PRICES.names)
    late, third = F.col("delivery_date") >= "2024-01-16", F.col("interval") == 3
    for part in (late & ~third, ~late | F.col("delivery_date").isNull(), late & third):
        published = conforming.publish(market.filter(part), CLASSIC_NAMES["prices"])
        published.write.mode("append").option("header", True).csv(f"{path}/drop")
        run = ingest_hourly(spark, f"{path}/drop", header, f"{path}/hourly", f"{path}/checkpoint")
        run.awaitTermination()
    return text_dates(rounded(read_hourly(spark, f"{path}/hourly"), "price"))


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) AS n_rows, count(*) - count(v) AS n_missing, 'true' AS within_bound "
        f"FROM (SELECT {name} AS v FROM lineitem)"
        for name in ["l_suppkey", "l_partkey", "l_orderkey", "l_linenumber"]
    )
)
def sketch_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of four loads, kept and merged: rows, and whether the estimated distinct values keep to their bound."""
    lines, names = table(spark, sf_dir, "lineitem"), ["l_suppkey", "l_partkey", "l_orderkey", "l_linenumber"]
    path = fresh_path(spark, "sketches")
    for load in range(4):
        column_sketches(lines.filter(F.col("l_partkey") % 4 == load), names).write.mode("append").parquet(path)
    merged = sketched_profile(merged_sketches(spark.read.parquet(path)))
    exact = lines.agg(F.array(*(F.struct(F.lit(n).alias("column_name"), F.count_distinct(n).alias("n")) for n in names)).alias("c"))
    both = merged.join(exact.select(F.inline("c")), "column_name")
    within = F.abs(F.col("n_distinct") - F.col("n")) <= BOUND * F.col("n")
    return both.select("column_name", "n_rows", "n_missing", within.cast("string").alias("within_bound"))
