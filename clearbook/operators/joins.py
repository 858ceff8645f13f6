"""Award, order, pair and price joins, and the semi and anti joins around them.

Two families of joins exist because the two settlement views differ on missing keys: the one-row-per-award view uses
plain equality (a NULL key matches nothing), the pair view treats NULL keys as equal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearbook import schemas
from clearbook.operators.bounded import SmallList, keep_listed
from clearbook.operators.dedup import keep_first
from clearbook.operators.presence import not_in_cells
from clearbook.operators.skew import left_join_hot_right, many_to_many, null_safe_join, pair_join_hot

AWARD_ORDER_KEYS = ["order_id", "delivery_date", "hour_ending"]
LIST_KEY = "_key"


def award_order_left(
    awards: DataFrame, orders: DataFrame, keys: list[str] | None = None, hot: SmallList | None = None
) -> DataFrame:
    """Every award with the order curves of the same id, date and hour; several such orders give several rows.

    Columns of the order that an award has too (point and participant) are dropped from the order side. ``hot`` are
    the order keys with very many rows, from ``hot_keys``.
    """
    keys = keys or AWARD_ORDER_KEYS
    shared = [name for name in orders.columns if name in awards.columns and name not in keys]
    return left_join_hot_right(awards, orders.drop(*shared), keys, hot)


def award_price_left(awards: DataFrame, prices: DataFrame, hourly: bool = True) -> DataFrame:
    """Every award with the market price of its point, date and hour as ``mark_price``.

    Hourly prices give one row; raw interval prices give one row per interval. With ``hourly=False`` the join is dealt by
    the rows that it makes, as an hour may have very many intervals.
    """
    market = prices.select(*schemas.PRICE_JOIN_KEYS, F.col("price").alias("mark_price"))
    if hourly:
        return awards.join(market, schemas.PRICE_JOIN_KEYS, "left")
    return many_to_many(awards, market, schemas.PRICE_JOIN_KEYS, "left")


def keyed(df: DataFrame, keys: list[str]) -> DataFrame:
    """Fold the key columns into one struct column.

    Structs compare field by field with NULL equal to NULL, so a plain equality on the struct is the NULL-safe match.
    It also lets a deduplication and the join after it agree on one partitioning.
    """
    rest = [name for name in df.columns if name not in keys]
    return df.select(F.struct(*keys).alias(LIST_KEY), *rest)


def combine(orders: DataFrame, awards: DataFrame, order: list[str | Column], side: str) -> DataFrame:
    """Every award of one side with its order, both reduced to the first row per key.

    Keys are date, hour, point, participant and id; NULL keys match. Both inputs are shuffled once, by the key: the
    deduplication partitions them just as the join needs them. ``order`` ranks rows within a key on both inputs and
    may name columns that are not part of the layouts. Columns come out prefixed by ``side`` (``bid`` or ``offer``).
    """
    orders, awards = (keep_first(keyed(df, schemas.ORDER_KEYS), [LIST_KEY], order) for df in (orders, awards))
    flags = ["multi_hour_block", "block_curve"]
    curve = [name for name in [*flags, *schemas.LEVEL_COLUMNS] if name in orders.columns]
    joined = awards.select(LIST_KEY, "award_mw", "award_price").join(
        orders.select(LIST_KEY, *curve), [LIST_KEY], "left"
    )
    return joined.selectExpr(
        *[f"{LIST_KEY}.{name}" for name in schemas.PAIR_KEYS],
        f"{LIST_KEY}.order_id AS {side}_id",
        *[f"{name} AS {side}_{name}" for name in [*curve, "award_mw", "award_price"]],
    )


def pair_bids_with_offers(
    combined_bids: DataFrame,
    combined_offers: DataFrame,
    hot: SmallList | None = None,
    finish: Callable[[DataFrame], DataFrame] | None = None,
    undated: bool = True,
) -> DataFrame:
    """Every bid award with every offer award of the same participant, point, date and hour; NULL keys match.

    ``hot`` are the (date, hour, point, participant) cells with very many pairs, from ``hot_cells``; these are made by
    many tasks. ``finish`` changes the rows of the bids, before they are paired. Without ``undated`` every row has a date, and
    the pairs of a task come out by date.
    """
    return pair_join_hot(combined_bids, combined_offers, schemas.PAIR_KEYS, hot, finish, undated)


def first_price(prices: DataFrame, order: list[str | Column]) -> DataFrame:
    """The one price row per (date, hour, point) the pair view settles on, the first in ``order``."""
    chosen = keep_first(prices, schemas.PRICE_JOIN_KEYS, order)
    return chosen.select(
        *schemas.PRICE_JOIN_KEYS,
        F.col("hour_ending").alias("delivery_hour"),
        "interval",
        "point_type",
        F.col("price").alias("market_price"),
        "dst_flag",
    )


def with_market_price(df: DataFrame, prices: DataFrame, how: str = "left") -> DataFrame:
    """Rows with the chosen market price of their point, date and hour; NULL keys match."""
    return null_safe_join(df, prices, schemas.PRICE_JOIN_KEYS, how)


def prices_at_points(prices: DataFrame, points: DataFrame, on_empty: str = "drop") -> DataFrame:
    """Prices at the given points; an empty list drops everything or, with ``pass``, nothing."""
    listed = SmallList(points.select("settlement_point").distinct())
    if listed.is_empty and on_empty == "pass":
        return prices
    return keep_listed(prices, listed, ["settlement_point"])


def new_by_date(incoming: DataFrame, stored: DataFrame, date: str = "delivery_date") -> DataFrame:
    """Rows of dates not stored yet; a NULL date counts as new. Repeats within the incoming rows stay.

    No job runs while this is built. Dates of type DATE are as many as the calendar has, so they are broadcast; others are
    left to Spark.
    """
    known = stored.select(F.col(date).alias("_stored")).distinct()
    side = F.broadcast(known) if dict(stored.dtypes)[date] == "date" else known
    return incoming.join(side, F.col(date) == F.col("_stored"), "left_anti")


def new_by_interval(
    incoming: DataFrame, stored: DataFrame, date: str = "delivery_date", hour: str = "hour_ending", interval: str = "interval"
) -> DataFrame:
    """Rows of (date, hour, interval) cells not stored yet, by bitmaps of the stored cells; no job runs while it is built.

    A row without hour or interval is judged by its date alone; one without a date is new.
    """
    return not_in_cells(incoming, stored, date, hour, interval)
