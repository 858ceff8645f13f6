"""Table layouts, header aliases, key lists and output names.

Bids and offers have the same shape here (``ORDERS``), as have their awards (``AWARDS``); which side a row belongs to
is a matter of the table it is in, or of the ``side`` column once both are unioned.
"""

from __future__ import annotations

from pyspark.sql import types as T

MAX_LEVEL = 10

BID, OFFER = "Bid", "Offer"


def _struct(spec: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in spec])


_WHERE_WHEN = [
    ("delivery_date", T.DateType()),
    ("hour_ending", T.IntegerType()),
    ("settlement_point", T.StringType()),
    ("qse_name", T.StringType()),
]

LEVEL_COLUMNS = [f"{part}{level}" for level in range(1, MAX_LEVEL + 1) for part in ("mw", "price")]


def orders_schema(flag_type: T.DataType | None = None) -> T.StructType:
    """Order curves; the two indicators are text as published, or boolean after ``parse_boolean``."""
    flag = flag_type or T.StringType()
    return _struct(
        _WHERE_WHEN
        + [(name, T.DoubleType()) for name in LEVEL_COLUMNS]
        + [("order_id", T.StringType()), ("multi_hour_block", flag), ("block_curve", flag)]
    )


ORDERS = orders_schema()
AWARDS = _struct(
    _WHERE_WHEN
    + [("award_mw", T.DoubleType()), ("award_price", T.DoubleType()), ("order_id", T.StringType())]
)
PRICES = _struct(
    [
        ("delivery_date", T.DateType()),
        ("hour_ending", T.IntegerType()),
        ("interval", T.IntegerType()),
        ("settlement_point", T.StringType()),
        ("point_type", T.StringType()),
        ("price", T.DoubleType()),
        ("dst_flag", T.StringType()),
    ]
)
CLASSIC_FINAL = _struct(
    [
        ("delivery_date", T.DateType()),
        ("hour_ending", T.IntegerType()),
        ("settlement_point", T.StringType()),
        ("qse_name", T.StringType()),
        ("settlement_price", T.DoubleType()),
        ("mark_price", T.DoubleType()),
        ("block_curve", T.StringType()),
        ("source_type", T.StringType()),
        ("bid_award_mw", T.DoubleType()),
        ("bid_id", T.StringType()),
        ("bid_price", T.DoubleType()),
        ("bid_size", T.DoubleType()),
        ("offer_award_mw", T.DoubleType()),
        ("offer_id", T.StringType()),
        ("offer_price", T.DoubleType()),
        ("offer_size", T.DoubleType()),
    ]
)
TRACKED_QSE = _struct(
    [
        ("name", T.StringType()),
        ("short_name", T.StringType()),
        ("duns_number", T.DoubleType()),
        ("participant_type", T.StringType()),
        ("ref_date", T.StringType()),
        ("web01", T.StringType()),
        ("web02", T.StringType()),
        ("aw_flag02", T.IntegerType()),
        ("active_power_group", T.IntegerType()),
    ]
)
LEDGER = _struct(
    [
        ("product", T.StringType()),
        ("month", T.StringType()),
        ("doc_id", T.StringType()),
        ("post_datetime", T.StringType()),
        ("friendly_name", T.StringType()),
    ]
)

#: Hours that a stored table has of a date, one bit each.
PRESENCE = _struct([("table_name", T.StringType()), ("hours", T.LongType()), ("delivery_date", T.DateType())])

TABLES = {
    "bids": ORDERS,
    "bid_awards": AWARDS,
    "offers": ORDERS,
    "offer_awards": AWARDS,
    "prices": PRICES,
    "tracked_qse": TRACKED_QSE,
}

# Row identity for keep-first deduplication.
ORDER_KEYS = ["delivery_date", "hour_ending", "qse_name", "settlement_point", "order_id"]
PRICE_KEYS = ["delivery_date", "hour_ending", "interval", "settlement_point"]
PAIR_KEYS = ["delivery_date", "hour_ending", "settlement_point", "qse_name"]
PRICE_JOIN_KEYS = ["delivery_date", "hour_ending", "settlement_point"]

# Header spellings after removing everything but letters and digits and upper-casing.
_WHERE_WHEN_ALIASES = {
    "DELIVERYDATE": "delivery_date",
    "HOURENDING": "hour_ending",
    "SETTLEMENTPOINT": "settlement_point",
    "SETTLEMENTPOINTNAME": "settlement_point",
    "SETTLTMENTPOINT": "settlement_point",
    "QSENAME": "qse_name",
}
_PRICE_ALIASES = {
    "DELIVERYDATE": "delivery_date",
    "DELIVERYHOUR": "hour_ending",
    "DELIVERYINTERVAL": "interval",
    "SETTLEMENTPOINT": "settlement_point",
    "SETTLEMENTPOINTNAME": "settlement_point",
    "SETTLEMENTPOINTTYPE": "point_type",
    "SETTLEMENTPOINTPRICE": "price",
    "AVGSETTLEMENTPOINTPRICE": "price",
    "DSTFLAG": "dst_flag",
}
_TRACKED_ALIASES = {
    "NAME": "name",
    "SHORTNAME": "short_name",
    "DUNSNUMBER": "duns_number",
    "MARKETPARTICIPANTTYPE": "participant_type",
    "REFDATE": "ref_date",
    "WEB01": "web01",
    "WEB02": "web02",
    "AWFLAG02": "aw_flag02",
    "ACTVPWRGRP": "active_power_group",
}


def _order_aliases(side: str) -> dict[str, str]:
    side = side.upper()
    levels = {
        f"ENERGYONLY{side}{part}{level}": f"{part.lower()}{level}"
        for level in range(1, MAX_LEVEL + 1)
        for part in ("MW", "PRICE")
    }
    return {
        **_WHERE_WHEN_ALIASES,
        **levels,
        f"ENERGYONLY{side}ID": "order_id",
        f"{side}ID": "order_id",
        "MULTIHOURBLOCKINDICATOR": "multi_hour_block",
        "MULTIHOURBLOCK": "multi_hour_block",
        "BLOCKCURVEINDICATOR": "block_curve",
        "BLOCKCURVE": "block_curve",
    }


def _award_aliases(side: str) -> dict[str, str]:
    side = side.upper()
    return {
        **_WHERE_WHEN_ALIASES,
        f"ENERGYONLY{side}AWARDINMW": "award_mw",
        f"ENERGYONLY{side}AWARDMW": "award_mw",
        "SETTLEMENTPOINTPRICE": "award_price",
        f"ENERGYONLY{side}ID": "order_id",
        f"{side}ID": "order_id",
    }


ALIASES = {
    "bids": _order_aliases("bid"),
    "bid_awards": _award_aliases("bid"),
    "offers": _order_aliases("offer"),
    "offer_awards": _award_aliases("offer"),
    "prices": _PRICE_ALIASES,
    "tracked_qse": _TRACKED_ALIASES,
}

# Fragment of a published file name -> table it feeds.
FILE_ROUTES = {
    "60d_DAM_EnergyBidAwards-": "bid_awards",
    "60d_DAM_EnergyBids-": "bids",
    "60d_DAM_EnergyOnlyOfferAwards-": "offer_awards",
    "60d_DAM_EnergyOnlyOffers-": "offers",
}
PRICE_FILE_FRAGMENT = "SPP"


def _level_names(pattern: str) -> dict[str, str]:
    return {
        f"{short}{level}": pattern.format(part=part, level=level)
        for level in range(1, MAX_LEVEL + 1)
        for short, part in (("mw", "MW"), ("price", "Price"))
    }


# Published column names of the two table families, used when a result must carry them.
CLASSIC_NAMES = {
    "prices": {
        "delivery_date": "DeliveryDate",
        "hour_ending": "DeliveryHour",
        "interval": "DeliveryInterval",
        "settlement_point": "SettlementPointName",
        "point_type": "SettlementPointType",
        "price": "SettlementPointPrice",
        "dst_flag": "DSTFlag",
        "inserted_at": "INSERTED_AT",
    },
    "bids": {
        "delivery_date": "DeliveryDate",
        "hour_ending": "HourEnding",
        "settlement_point": "SettlementPoint",
        "qse_name": "QSEName",
        **_level_names("EnergyOnlyBid{part}{level}"),
        "order_id": "EnergyOnlyBidID",
        "multi_hour_block": "MultiHourBlockIndicator",
        "block_curve": "BlockCurveIndicator",
        "inserted_at": "INSERTED_AT",
    },
    "bid_awards": {
        "delivery_date": "DeliveryDate",
        "hour_ending": "HourEnding",
        "settlement_point": "SettlementPoint",
        "qse_name": "QSEName",
        "award_mw": "EnergyOnlyBidAwardInMW",
        "award_price": "SettlementPointPrice",
        "order_id": "BidId",
        "inserted_at": "INSERTED_AT",
    },
    "offers": {
        "delivery_date": "DeliveryDate",
        "hour_ending": "HourEnding",
        "settlement_point": "SettlementPoint",
        "qse_name": "QSEName",
        **_level_names("EnergyOnlyOffer{part}{level}"),
        "order_id": "EnergyOnlyOfferID",
        "multi_hour_block": "MultiHourBlockIndicator",
        "block_curve": "BlockCurveIndicator",
        "inserted_at": "INSERTED_AT",
    },
    "offer_awards": {
        "delivery_date": "DeliveryDate",
        "hour_ending": "HourEnding",
        "settlement_point": "SettlementPoint",
        "qse_name": "QSEName",
        "award_mw": "EnergyOnlyOfferAwardMW",
        "award_price": "SettlementPointPrice",
        "order_id": "OfferID",
        "inserted_at": "INSERTED_AT",
    },
    "final": {
        "delivery_date": "deliveryDate",
        "hour_ending": "hourEnding",
        "settlement_point": "settlementPointName",
        "qse_name": "qseName",
        "settlement_price": "settlementPointPrice",
        "mark_price": "MARK_PRICE",
        "block_curve": "blockCurve",
        "source_type": "sourceType",
        "bid_award_mw": "energyOnlyBidAwardInMW",
        "bid_id": "bidId",
        "bid_price": "BID_PRICE",
        "bid_size": "BID_SIZE",
        "offer_award_mw": "energyOnlyOfferAwardMW",
        "offer_id": "offerId",
        "offer_price": "OFFER_PRICE",
        "offer_size": "OFFER_SIZE",
        "inserted_at": "INSERTED_AT",
    },
}

PAIRED_NAMES = {
    "prices": {
        "delivery_date": "DELIVERYDATE",
        "hour_ending": "DELIVERYHOUR",
        "interval": "DELIVERYINTERVAL",
        "settlement_point": "SETTLEMENTPOINTNAME",
        "point_type": "SETTLEMENTPOINTTYPE",
        "price": "AVGSETTLEMENTPOINTPRICE",
        "dst_flag": "DSTFLAG",
        "inserted_at": "INSERTEDAT",
    },
    "bid_awards": {
        "delivery_date": "DELIVERYDATE",
        "hour_ending": "HOURENDING",
        "settlement_point": "SETTLEMENTPOINTNAME",
        "qse_name": "QSENAME",
        "award_mw": "ENERGYONLYBIDAWARDINMW",
        "award_price": "SETTLEMENTPOINTPRICE",
        "order_id": "BIDID",
        "inserted_at": "INSERTEDAT",
    },
    "bids": {
        "delivery_date": "DELIVERYDATE",
        "hour_ending": "HOURENDING",
        "settlement_point": "SETTLEMENTPOINTNAME",
        "qse_name": "QSENAME",
        "order_id": "BIDID",
        "multi_hour_block": "MULTIHOURBLOCK",
        "block_curve": "BLOCKCURVE",
        **{short: name.upper() for short, name in _level_names("EnergyOnlyBid{part}{level}").items()},
        "inserted_at": "INSERTEDAT",
    },
    "offer_awards": {
        "delivery_date": "DELIVERYDATE",
        "hour_ending": "HOURENDING",
        "settlement_point": "SETTLEMENTPOINTNAME",
        "qse_name": "QSENAME",
        "award_mw": "ENERGYONLYOFFERAWARDINMW",
        "award_price": "SETTLEMENTPOINTPRICE",
        "order_id": "OFFERID",
        "inserted_at": "INSERTEDAT",
    },
    "offers": {
        "delivery_date": "DELIVERYDATE",
        "hour_ending": "HOURENDING",
        "settlement_point": "SETTLEMENTPOINTNAME",
        "qse_name": "QSENAME",
        "order_id": "OFFERID",
        "multi_hour_block": "MULTIHOURBLOCK",
        "block_curve": "BLOCKCURVE",
        **{short: name.upper() for short, name in _level_names("EnergyOnlyOffer{part}{level}").items()},
        "inserted_at": "INSERTEDAT",
    },
}


def _paired_side(side: str, suffix: str) -> dict[str, str]:
    """Published names of one side of the pair tables; the two indicators need a suffix to stay apart."""
    levels = {
        f"{side}_{part.lower()}{level}": f"ENERGYONLY{side.upper()}{part}{level}"
        for level in range(1, MAX_LEVEL + 1)
        for part in ("MW", "PRICE")
    }
    return {
        f"{side}_id": f"{side.upper()}ID",
        f"{side}_multi_hour_block": f"MULTIHOURBLOCK{suffix}",
        f"{side}_block_curve": f"BLOCKCURVE{suffix}",
        **levels,
        f"{side}_award_mw": f"{side.upper()}_AWARD_MW",
        f"{side}_award_price": f"{side.upper()}_AWARD_PRICE",
    }


_PAIR_WHERE_WHEN = {
    "delivery_date": "DELIVERYDATE",
    "hour_ending": "HOURENDING",
    "settlement_point": "SETTLEMENTPOINTNAME",
    "qse_name": "QSENAME",
}
PAIRED_NAMES["combined_bids"] = {**_PAIR_WHERE_WHEN, **_paired_side("bid", ""), "inserted_at": "INSERTEDAT"}
PAIRED_NAMES["combined_offers"] = {**_PAIR_WHERE_WHEN, **_paired_side("offer", ""), "inserted_at": "INSERTEDAT"}
PAIRED_NAMES["merged_pairs"] = {
    **_PAIR_WHERE_WHEN,
    **_paired_side("bid", "_BID"),
    **_paired_side("offer", "_OFFER"),
    "inserted_at": "INSERTEDAT",
}
PAIRED_NAMES["final"] = {
    **_PAIR_WHERE_WHEN,
    **_paired_side("bid", "_BID"),
    **_paired_side("offer", "_OFFER"),
    "delivery_hour": "DELIVERYHOUR",
    "interval": "DELIVERYINTERVAL",
    "point_type": "SETTLEMENTPOINTTYPE",
    "market_price": "AVGSETTLEMENTPOINTPRICE",
    "dst_flag": "DSTFLAG",
    "inserted_at": "INSERTEDAT",
}
