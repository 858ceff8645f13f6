"""The one-row-per-award settlement table."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearbook import schemas
from clearbook.functions.curve import LADDER_LEVELS, ladder_price, ladder_size, settlement_price
from clearbook.operators.filters import between_dates
from clearbook.operators.joins import AWARD_ORDER_KEYS, award_order_left, award_price_left
from clearbook.operators.presence import at_masks, common_masks
from clearbook.operators.skew import ROWS_PER_SALT, hot_keys


@dataclass(frozen=True)
class MarketTables:
    """The five inputs of a settlement job, in the column names of ``schemas``."""

    bids: DataFrame
    bid_awards: DataFrame
    offers: DataFrame
    offer_awards: DataFrame
    prices: DataFrame

    def all(self) -> list[DataFrame]:
        return [self.bid_awards, self.bids, self.prices, self.offers, self.offer_awards]

    def between(self, start: dt.date | str, end: dt.date | str) -> MarketTables:
        return self.map(lambda df: between_dates(df, start, end))

    def map(self, change) -> MarketTables:
        names = ("bids", "bid_awards", "offers", "offer_awards", "prices")
        return MarketTables(**{name: change(getattr(self, name)) for name in names})


def _both_sides(bids: DataFrame, offers: DataFrame) -> DataFrame:
    """Bid and offer rows in one frame, told apart by ``side``; one join then serves both branches of the union."""
    sided = [df.select(F.lit(side).alias("side"), "*") for df, side in ((bids, schemas.BID), (offers, schemas.OFFER))]
    return sided[0].unionByName(sided[1])


def order_summary(orders: DataFrame, max_level: int = LADDER_LEVELS) -> DataFrame:
    """What the settlement needs of an order: key, curve indicator, ladder price and size.

    Taken before the join, so that two numbers travel through the shuffle and not the whole curve.
    """
    return orders.select(
        "order_id",
        "delivery_date",
        "hour_ending",
        "block_curve",
        ladder_price(max_level).alias("order_price"),
        ladder_size(max_level).alias("order_size"),
    )


def classic_final(
    tables: MarketTables,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
    max_level: int = LADDER_LEVELS,
    restrict_to_common_pairs: bool = True,
    rows_per_salt: int | None = ROWS_PER_SALT,
    common: DataFrame | None = None,
) -> DataFrame:
    """One row per award, bids and offers together, with order curve figures and market price.

    Awards count only for (date, hour) pairs present in all five tables. An award without order or price stays; its
    settlement price falls back to its own. Raw interval prices multiply the rows, hourly prices do not. An order id
    with very many orders in one hour is spread over tasks of ``rows_per_salt`` rows; None trusts there is none.

    Common pairs are a mask of hours per date, from the tables themselves or, in ``common``, from what was kept of them when
    they were loaded; hours are numbers from 0 to 63. Awards are cut to them before anything is shuffled, and with kept masks,
    which take no pass over the tables, all inputs are.
    """
    if start is not None and end is not None:
        tables = tables.between(start, end)
    if restrict_to_common_pairs and common is not None:
        tables = tables.map(lambda df: at_masks(df, common))
    awards = _both_sides(tables.bid_awards, tables.offer_awards)
    if restrict_to_common_pairs and common is None:
        awards = at_masks(awards, common_masks(tables.all()))
    orders = _both_sides(order_summary(tables.bids, max_level), order_summary(tables.offers, max_level))
    # The id comes first: a sort by these keys then tells most rows apart by their first bytes.
    keys = [*AWARD_ORDER_KEYS, "side"]
    hot = hot_keys(orders.dropna(subset=keys), keys, rows_per_salt) if rows_per_salt else None
    with_orders = award_order_left(awards, orders, keys, hot)
    return _final_columns(award_price_left(with_orders, tables.prices))


def _final_columns(settled: DataFrame) -> DataFrame:
    def only(side: str, column: str):
        return F.when(F.col("side") == side, F.col(column))

    return settled.select(
        "delivery_date",
        "hour_ending",
        "settlement_point",
        "qse_name",
        settlement_price(F.col("mark_price"), F.col("award_price")).alias("settlement_price"),
        "mark_price",
        "block_curve",
        F.col("side").alias("source_type"),
        only(schemas.BID, "award_mw").alias("bid_award_mw"),
        only(schemas.BID, "order_id").alias("bid_id"),
        only(schemas.BID, "order_price").alias("bid_price"),
        only(schemas.BID, "order_size").alias("bid_size"),
        only(schemas.OFFER, "award_mw").alias("offer_award_mw"),
        only(schemas.OFFER, "order_id").alias("offer_id"),
        only(schemas.OFFER, "order_price").alias("offer_price"),
        only(schemas.OFFER, "order_size").alias("offer_size"),
    )
