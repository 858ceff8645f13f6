"""Header and value cleaning, layout conforming, validation, JSON pages, routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearbook.functions import cleaning
from clearbook.functions.curve import first_present as first_of
from clearbook.operators import conform as conforming
from clearbook.operators import quality, sets
from clearbook.registry import query
from clearbook.registry.settlement import text_dates
from clearbook.sources import json_pages as pages
from clearbook.sources.routing import table_for_file
from clearbook.standin import MARKET_SQL, line_rows, market_tables, table


def _cycle(key: Column, values: list[Column | str | None]) -> Column:
    """One of several values by a row's key; strings are taken as text."""
    choice = F
    for number, value in enumerate(values):
        choice = choice.when(key % len(values) == number, value if isinstance(value, Column) else F.lit(value))
    return choice


def _cycle_sql(key: str, values: list[str]) -> str:
    return f"CASE {key} % {len(values)} " + " ".join(f"WHEN {n} THEN {value}" for n, value in enumerate(values)) + " END"


@query(
    """SELECT o_orderkey, upper(regexp_replace(o_orderpriority || ' / ' || o_orderstatus, '[^A-Za-z0-9]', '', 'g'))
  AS header FROM orders"""
)
def header_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header text reduced to upper-case letters and digits."""
    header = F.concat_ws(" / ", "o_orderpriority", "o_orderstatus")
    return table(spark, sf_dir, "orders").select("o_orderkey", cleaning.header_key_of(header).alias("header"))


@query(
    f"""{MARKET_SQL}
SELECT CAST(delivery_date AS VARCHAR) AS delivery_date,
  {_cycle_sql("l_partkey", ["7", "7", "CAST(NULL AS INTEGER)", "CAST(NULL AS INTEGER)", "CAST(NULL AS INTEGER)"])}
    AS hour_ending, settlement_point,
  CASE WHEN l_suppkey % 7 <> 0 THEN qse_name END AS qse_name, award_mw, CAST(NULL AS DOUBLE) AS award_price, order_id
FROM bid_awards"""
)
def conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text under published headers to the award layout; price absent, extra column dropped."""
    awards = market_tables(spark, sf_dir).bid_awards
    raw = awards.select(
        F.date_format("delivery_date", "yyyy/M/d").alias("Delivery Date"),
        _cycle(F.col("l_partkey"), ["7", "7.0", "7.5", "x", F.lit(None).cast("string")]).alias("hour_ending"),
        F.concat(F.lit(" "), "settlement_point").alias("settlementPointName"),
        F.when(F.col("l_suppkey") % 7 != 0, F.col("qse_name")).otherwise(" ").alias("QSE Name"),
        F.col("award_mw").cast("string").alias("Energy Only Bid Award in MW"),
        F.col("order_id").alias("Bid ID"),
        F.lit("x").alias("Comment"),
    )
    return text_dates(conforming.conform_table(raw, "bid_awards"))


@query(
    """SELECT l_orderkey, CAST(l_partkey AS INTEGER) AS l_partkey, l_linenumber,
  CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE) AS price, CAST(CAST(l_tax AS FLOAT) AS DOUBLE) AS tax FROM lineitem"""
)
def narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: numbers at half width, shown widened again."""
    lines = table(spark, sf_dir, "lineitem")
    slim = conforming.narrow(
        lines.select("l_partkey", "l_linenumber", "l_extendedprice", "l_tax", F.col("l_orderkey").cast("string").alias("k"))
    )
    return slim.select(
        F.col("k").cast("long").alias("l_orderkey"),
        "l_partkey",
        "l_linenumber",
        F.col("l_extendedprice").cast("double").alias("price"),
        F.col("l_tax").cast("double").alias("tax"),
    )


_PADDED = ["'  '", "''", "' ' || o_orderpriority || ' '", "CAST(NULL AS VARCHAR)", "o_orderstatus"]


@query(f"SELECT o_orderkey, nullif(trim({_cycle_sql('o_orderkey', _PADDED)}), '') AS value FROM orders")
def blank_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trimmed text, blank as missing."""
    padded = F.concat(F.lit(" "), "o_orderpriority", F.lit(" "))
    value = _cycle(F.col("o_orderkey"), ["  ", "", padded, F.lit(None).cast("string"), F.col("o_orderstatus")])
    return conforming.trim_blank_columns(table(spark, sf_dir, "orders").select("o_orderkey", value.alias("value")))


@query(
    """SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END,
  CASE WHEN o_orderkey % 3 = 1 THEN o_orderpriority END, CAST(o_custkey AS VARCHAR)) AS value FROM orders"""
)
def first_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First of several fields a row has."""
    key = F.col("o_orderkey")
    value = first_of(
        F.when(key % 3 == 0, F.col("o_orderstatus")),
        F.when(key % 3 == 1, F.col("o_orderpriority")),
        F.col("o_custkey").cast("string"),
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", value.alias("value"))


# Flag spellings with their truth value, for the check.
_FLAGS = {
    "Y": "true", "yes": "true", "True": "true", " t ": "true", "1": "true", "v": "true",
    "N": "false", "no": "false", "FALSE": "false", "f": "false", "0": "false", " ": "false", "": "false",
    "maybe": "NULL", "2": "NULL",
}


@query(
    "SELECT o_orderkey, "
    + _cycle_sql("o_orderkey", [f"CAST({v if v == 'NULL' else repr(v)} AS VARCHAR)" for v in _FLAGS.values()])
    + " AS flag, CASE WHEN o_custkey % 5 <> 0 THEN CAST(o_custkey % 2 <> 0 AS VARCHAR) END AS number_flag FROM orders"
)
def bool_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags from words and from numbers, shown as text."""
    number = F.when(F.col("o_custkey") % 5 != 0, F.col("o_custkey") % 2)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        cleaning.parse_boolean(_cycle(F.col("o_orderkey"), list(_FLAGS)), T.StringType()).cast("string").alias("flag"),
        cleaning.parse_boolean(number, T.LongType()).cast("string").alias("number_flag"),
    )


@query(
    """SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN value END AS amount,
  CASE WHEN event_id % 3 <> 0 THEN event_type END AS label FROM events"""
)
def nan_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NaN and the word ``nan`` as missing."""
    event = F.col("event_id")
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(event % 4 != 0, F.col("value")).otherwise(F.lit(float("nan"))).alias("amount"),
        F.when(event % 3 != 0, F.col("event_type")).otherwise(" NaN").alias("label"),
    )
    return conforming.nan_columns_to_null(rows)


def _suspect_awards(spark: SparkSession, sf_dir: str) -> DataFrame:
    awards = market_tables(spark, sf_dir).bid_awards
    part, supplier = F.col("l_partkey"), F.col("l_suppkey")
    hour = _cycle(part, [F.col("hour_ending").cast("string"), "25", "0", "3.5", F.lit(None).cast("string")])
    return awards.select(
        F.col("delivery_date").cast("string").alias("delivery_date"),
        hour.alias("hour_ending"),
        "settlement_point",
        F.when(supplier % 7 != 0, F.col("qse_name")).alias("qse_name"),
        _cycle(supplier, [F.col("award_mw").cast("string"), "n/a", F.lit(None).cast("string")]).alias("award_mw"),
        F.col("award_price").alias("award_price"),
        F.when(supplier % 11 != 0, F.col("order_id")).alias("order_id"),
    )


_SUSPECT_SQL = f"""{MARKET_SQL}, suspect AS (SELECT CAST(delivery_date AS VARCHAR) AS delivery_date,
  {_cycle_sql("l_partkey", ["CAST(hour_ending AS VARCHAR)", "'25'", "'0'", "'3.5'", "CAST(NULL AS VARCHAR)"])} AS hour_ending, settlement_point,
  CASE WHEN l_suppkey % 7 <> 0 THEN qse_name END AS qse_name,
  {_cycle_sql("l_suppkey", ["CAST(award_mw AS VARCHAR)", "'n/a'", "CAST(NULL AS VARCHAR)"])} AS award_mw, award_price,
  CASE WHEN l_suppkey % 11 <> 0 THEN order_id END AS order_id FROM bid_awards)"""

_HOUR_OK = (
    "coalesce(TRY_CAST(hour_ending AS DOUBLE) = floor(TRY_CAST(hour_ending AS DOUBLE)) "
    "AND TRY_CAST(hour_ending AS DOUBLE) BETWEEN 1 AND 24, FALSE)"
)
_MW_OK = "(award_mw IS NULL OR TRY_CAST(award_mw AS DOUBLE) IS NOT NULL)"


@query(
    f"""{_SUSPECT_SQL}
SELECT delivery_date, CAST(CAST(hour_ending AS DOUBLE) AS INTEGER) AS hour_ending, settlement_point, qse_name,
  CAST(award_mw AS DOUBLE) AS award_mw, award_price, order_id
FROM (SELECT * FROM suspect WHERE {_HOUR_OK} AND {_MW_OK} AND qse_name IS NOT NULL
  AND order_id IS NOT NULL AND settlement_point IS NOT NULL)"""
)
def validate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that pass all rules, cast to the award layout."""
    accepted, _ = quality.split_valid(_suspect_awards(spark, sf_dir), quality.award_rules())
    return text_dates(conforming.conform_table(accepted, "bid_awards"))


@query(
    f"""{_SUSPECT_SQL}
SELECT reason, count(*) AS n FROM (
  SELECT 'hour_ending: not a whole number in 1..24' AS reason FROM suspect WHERE NOT {_HOUR_OK}
  UNION ALL SELECT 'award_mw: not a number' FROM suspect WHERE NOT {_MW_OK}
  UNION ALL SELECT 'qse_name: missing' FROM suspect WHERE qse_name IS NULL
  UNION ALL SELECT 'settlement_point: missing' FROM suspect WHERE settlement_point IS NULL
  UNION ALL SELECT 'order_id: missing' FROM suspect WHERE order_id IS NULL) GROUP BY reason"""
)
def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """how often each rule was broken."""
    _, rejected = quality.split_valid(_suspect_awards(spark, sf_dir), quality.award_rules())
    return quality.reason_counts(rejected)


@query(
    """SELECT o_orderkey AS id, o_totalprice AS amount, CAST(NULL AS VARCHAR) AS label FROM orders
UNION ALL SELECT event_id, value, event_type FROM events
UNION ALL SELECT doc_id, CAST(NULL AS DOUBLE), source FROM documents"""
)
def concat_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U4: batches with differing columns under one another; one that cannot be built is skipped."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"))
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("label"), F.col("event_id").alias("id"), F.col("value").alias("amount")
    )

    def documents() -> DataFrame:
        return table(spark, sf_dir, "documents").select(F.col("source").alias("label"), F.col("doc_id").alias("id"))

    return sets.concat_batches([orders, events, documents, lambda: table(spark, sf_dir, "no_such_table")])


# Routes of the check, document source to table; the first fragment that occurs wins.
_ROUTES = {"src1": "bids", "src2": "bid_awards", "src3": "offers"}


@query(
    """SELECT doc_id, CASE WHEN contains(source, 'src1') THEN 'bids' WHEN contains(source, 'src2') THEN 'bid_awards'
  WHEN contains(source, 'src3') THEN 'offers' END AS target FROM documents
WHERE contains(source, 'src1') OR contains(source, 'src2') OR contains(source, 'src3')"""
)
def route_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target table by a fragment of the source name; unmatched ones are skipped."""
    routed = table(spark, sf_dir, "documents").select("doc_id", table_for_file(F.col("source"), _ROUTES).alias("target"))
    return routed.filter(F.col("target").isNotNull())


@query("SELECT event_id, CAST(regexp_extract(props, '\"k\": ([0-9]+)', 1) AS BIGINT) AS k FROM events")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One object per text, its field typed."""
    events = table(spark, sf_dir, "events")
    items = pages.flatten_pages(events, "props", carry=["event_id"])
    return items.select("event_id", pages.item_field("k", "bigint"))


@query(
    """WITH k AS (SELECT event_id, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) AS k FROM events)
SELECT event_id, k FROM k WHERE event_id % 6 <> 5
UNION ALL SELECT event_id, k FROM k WHERE event_id % 6 IN (1, 3)"""
)
def json_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All page shapes; items that are no objects, and broken pages, give nothing."""
    props = F.col("props")
    page = _cycle(
        F.col("event_id"),
        [
            props,
            F.concat(F.lit("["), props, F.lit(', 5, "x", '), props, F.lit("]")),
            F.concat(F.lit('{"_meta": {"totalPages": 1}, "data": ['), props, F.lit(", [1, 2]]}")),
            F.concat(F.lit('{"data": {"a": ['), props, F.lit('], "b": '), props, F.lit(', "c": 7}}')),
            F.concat(F.lit("["), props, F.lit("]")),
            F.concat(F.lit("["), props),
        ],
    )
    rows = table(spark, sf_dir, "events").select("event_id", page.alias("page"))
    return pages.flatten_pages(rows, carry=["event_id"]).select("event_id", pages.item_field("k", "bigint"))


@query(
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS "deliveryDate", CAST(hour(ts) + 1 AS VARCHAR) AS "deliveryHour",
  event_type AS "settlementPointName", CAST(user_id AS VARCHAR) AS "settlementPointPrice" FROM events"""
)
def positional_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List records to named columns by a fixed field list."""
    values = F.array(
        F.date_format("ts", "yyyy-MM-dd"),
        (F.hour("ts") + 1).cast("string"),
        F.lit("1"),
        F.col("event_type"),
        F.lit("LZ"),
        F.col("user_id").cast("string"),
    )
    page = F.concat(F.lit("["), F.to_json(values), F.lit("]"))
    rows = table(spark, sf_dir, "events").select("event_id", page.alias("page"))
    named = pages.positional_rows(pages.flatten_pages(rows, keep="lists", carry=["event_id"]), pages.PRICE_FIELDS)
    return named.select("event_id", "deliveryDate", "deliveryHour", "settlementPointName", "settlementPointPrice")


@query(
    f"""{MARKET_SQL}
SELECT DISTINCT qse_name, settlement_point FROM li"""
)
def tracked_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: distinct participant and point combinations."""
    return line_rows(spark, sf_dir).select("qse_name", "settlement_point").distinct()
