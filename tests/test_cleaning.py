from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearbook import schemas
from clearbook.functions import cleaning
from clearbook.operators import conform, quality


def test_parse_boolean(spark):
    texts = ["V", "", "maybe", None, " yes ", "n", "0", "1"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(texts)], "i int, v string").orderBy("i")
    got = [row[0] for row in df.select(cleaning.parse_boolean(F.col("v"), T.StringType())).collect()]
    assert got == [True, False, None, None, True, False, False, True]
    numbers = spark.createDataFrame([(0, 0.0), (1, 2.5), (2, float("nan")), (3, None)], "i int, v double").orderBy("i")
    got = [row[0] for row in numbers.select(cleaning.parse_boolean(F.col("v"), T.DoubleType())).collect()]
    assert got == [False, True, None, None]


def test_to_int(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(["5", "5.0", "5.5", "x", None])], "i int, v string")
    assert [row[0] for row in df.orderBy("i").select(cleaning.to_int(F.col("v"))).collect()] == [5, 5, None, None, None]


@pytest.mark.parametrize(
    ("table", "header", "column"),
    [
        ("prices", "settlementPoint", "settlement_point"),
        ("prices", "dst_flag", "dst_flag"),
        ("prices", "DeliveryHour", "hour_ending"),
        ("bid_awards", "Energy Only Bid Award in MW", "award_mw"),
        ("bid_awards", "energy_only_bid_award_mw", "award_mw"),
        ("bid_awards", "settlement point price", "award_price"),
        ("bid_awards", "BidId", "order_id"),
        ("bids", "energy only bid mw10", "mw10"),
        ("bids", "Multi-Hour Block Indicator", "multi_hour_block"),
        ("bids", "energyOnlyBidPrice1", "price1"),
        ("offers", "block/curve_indicator", "block_curve"),
        ("offers", "energy_only_offer_id", "order_id"),
        ("offer_awards", "SETTLTMENTPOINT", "settlement_point"),
        ("offer_awards", "energyOnlyOfferAwardInMW", "award_mw"),
    ],
)
def test_alias(spark, table, header, column):
    df = spark.createDataFrame([("x",)], T.StructType([T.StructField(header, T.StringType())]))
    assert conform.rename_by_alias(df, table).columns == [column]


def test_alias_collision_and_unknown(spark, rows):
    df = spark.createDataFrame([(None, "b", "c"), ("a", "b", "c")], "`Bid ID` string, bid_id string, `Some Note` string")
    first = conform.rename_by_alias(df, "bid_awards", unknown="snake")
    assert first.columns == ["order_id", "some_note"]
    assert rows(first) == [("a", "c"), ("b", "c")]
    last = conform.rename_by_alias(df, "bid_awards", collision="last")
    assert rows(last, "order_id") == [("b",), ("b",)]


def test_conform_fills_and_orders(spark):
    df = spark.createDataFrame([("1", "x")], "`Hour Ending` string, extra string")
    out = conform.conform_table(df, "bid_awards")
    assert out.schema == schemas.AWARDS
    assert out.first().hour_ending == 1
    assert conform.missing_columns(df, schemas.AWARDS) == schemas.AWARDS.names


def test_rename_reports_what_is_missing_and_unknown(spark):
    df = spark.createDataFrame([("a", "b")], "bidId string, note string")
    renamed, missing, unknown = conform.rename_with_report(df, "bid_awards")
    assert renamed.columns == ["order_id", "note"] and unknown == ["note"]
    assert missing == [name for name in schemas.AWARDS.names if name != "order_id"]


def test_flags_are_parsed_before_blanks_vanish(spark):
    df = spark.createDataFrame([("", "V")], "`Multi-Hour Block Indicator` string, `Block/Curve indicator` string")
    row = conform.conform_table(df, "bids", T.BooleanType()).first()
    assert (row.multi_hour_block, row.block_curve) == (False, True)
    text = conform.conform_table(df, "bids").first()
    assert (text.multi_hour_block, text.block_curve) == (None, "V")


def test_headers(spark):
    df = spark.createDataFrame([(1, 2)], "`Settlement Point (x)` int, ` Col_A ` int")
    assert conform.normalize_headers(df).columns == ["SETTLEMENTPOINTX", "COLA"]
    assert conform.snake_headers(df).columns == ["settlement_point_(x)", "col_a"]


def test_numeric_blanks_only(spark):
    df = spark.createDataFrame([(" ", " ")], "AWARDINMW string, NOTE string")
    assert tuple(conform.trim_blank_columns(df, only_numeric_names=True).first()) == (None, " ")


def test_publish_names_and_order(spark):
    df = spark.createDataFrame([], schemas.AWARDS)
    names = conform.publish(df, schemas.CLASSIC_NAMES["bid_awards"]).columns
    assert names == [
        "DeliveryDate", "HourEnding", "SettlementPoint", "QSEName", "EnergyOnlyBidAwardInMW", "SettlementPointPrice",
        "BidId",
    ]
    with pytest.raises(Exception, match="order_id"):
        conform.publish(df.drop("order_id"), schemas.CLASSIC_NAMES["bid_awards"])


def test_rejects_award_without_quantity(spark, rows):
    df = spark.createDataFrame(
        [("2024-01-01", "1", "P", "Q", "1.5", "2", "a"), ("2024-01-01", "1", "P", "Q", None, "2", "b")],
        "delivery_date string, hour_ending string, settlement_point string, qse_name string, award_mw string, "
        "award_price string, order_id string",
    )
    accepted, rejected = quality.split_valid(df, quality.strict_award_rules())
    assert rows(accepted, "order_id") == [("a",)]
    assert rejected.first().reasons == ["award_mw: not a number"]
    lenient, refused = quality.split_valid(df, quality.award_rules())
    assert rows(lenient, "order_id") == [("a",), ("b",)] and refused.isEmpty()


def test_every_row_is_accepted_or_rejected(spark):
    df = spark.createDataFrame(
        [(d, h, "P", q, "1", "1", i) for d in ("d", None) for h in ("0", "24", "x", None) for q in ("Q", None) for i in ("i", None)],
        "delivery_date string, hour_ending string, settlement_point string, qse_name string, award_mw string, "
        "award_price string, order_id string",
    )
    accepted, rejected = quality.split_valid(df, quality.award_rules())
    assert accepted.count() == 1
    assert accepted.count() + rejected.count() == df.count()


def test_price_hours(spark, rows):
    df = spark.createDataFrame(
        [("d", h, "P", "LZ", "1") for h in ("0", "23", "24", "-1")],
        "delivery_date string, hour_ending string, settlement_point string, point_type string, price string",
    )
    assert rows(quality.split_valid(df, quality.price_rules())[0], "hour_ending") == [("0",), ("23",)]


def test_required_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    quality.require_columns(df, ["a"])
    with pytest.raises(ValueError, match="Missing required fields"):
        quality.require_columns(df, ["a", "b"])


def test_emptiness(spark):
    empty = spark.createDataFrame([], "a int")
    assert quality.is_empty(None) and quality.is_empty(empty) and quality.is_empty(empty.select())
    assert not quality.is_empty(spark.createDataFrame([(None,)], "a int"))


def test_profiles(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (2, None)], "k int, v string")
    assert quality.duplicate_rows(df).first()[0] == 3
    assert rows(quality.value_profile(df, ["v"])) == [("v", None, 3), ("v", "a", 2)]
    assert rows(quality.load_profile(df, ["k", "v"])) == [("*", 2, 5, 3), ("k", 2, 5, 0), ("v", 1, 5, 3)]
    assert quality.duplicate_rows(df.filter("k > 5")).first()[0] == 0
