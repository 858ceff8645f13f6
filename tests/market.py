"""Small hand-made market tables for the tests."""

from __future__ import annotations

import datetime as dt

from clearbook import schemas
from clearbook.plans.classic import MarketTables

DAY = dt.date(2024, 1, 1)


def order(order_id, point="HB", qse="QA", hour=1, day=DAY, levels=(), seq=0, flags=("N", "V")):
    """``levels`` are (mw, price) pairs from level 1 on."""
    cells = [cell for pair in levels for cell in pair]
    return (day, hour, point, qse, *cells, *[None] * (20 - len(cells)), order_id, *flags, seq)


def award(order_id, point="HB", qse="QA", hour=1, day=DAY, mw=10.0, price=20.0, seq=0):
    return (day, hour, point, qse, mw, price, order_id, seq)


def price(value, point="HB", hour=1, interval=1, day=DAY, kind="LZ", flag="N", seq=0):
    return (day, hour, interval, point, kind, value, flag, seq)


def frame(spark, schema, rows):
    ddl = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in schema) + ", seq int"
    return spark.createDataFrame(rows, ddl)


def market(spark, bids=(), bid_awards=(), offers=(), offer_awards=(), prices=()):
    return MarketTables(
        bids=frame(spark, schemas.ORDERS, list(bids)),
        bid_awards=frame(spark, schemas.AWARDS, list(bid_awards)),
        offers=frame(spark, schemas.ORDERS, list(offers)),
        offer_awards=frame(spark, schemas.AWARDS, list(offer_awards)),
        prices=frame(spark, schemas.PRICES, list(prices)),
    )
