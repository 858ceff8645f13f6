"""Bitmaps of what a table holds: which hours of a date, which intervals of its hours.

A date's hours, 0 to 63, are one 64-bit mask, and its cells of hour and interval, intervals 0 to 15, are sixteen of them. A
bitmap table thus has a row per calendar day, whatever the size of the table it stands for: that bounds what is broadcast
when rows are looked up in it. Bitmaps of parts are joined by OR, so they can be kept with a table and extended by each load;
what several tables have in common is their AND.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hours of a mask, and intervals of an hour.
HOURS, INTERVALS = 64, 16
DATE, HOUR, INTERVAL = "delivery_date", "hour_ending", "interval"
MASKS = "table_name string, delivery_date date, hours long"


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def _has(mask: Column, place: Column) -> Column:
    return F.getbit(mask, place)


def _listed_hour() -> Column:
    return F.col(HOUR).between(0, HOURS - 1)


def hour_masks(df: DataFrame) -> DataFrame:
    """(delivery_date, hours): a mask of the hours that each date has rows of; other hours and missing keys have none."""
    held = df.filter(_listed_hour() & F.col(DATE).isNotNull())
    return held.groupBy(DATE).agg(F.bit_or(_bit(F.col(HOUR))).alias("hours"))


def common_masks(tables: list[DataFrame]) -> DataFrame:
    """(delivery_date, hours): a mask of the hours that every table has rows of; dates without any are left out.

    One grouped union: each table sends a mask per date and task.
    """
    tagged = [df.select(DATE, HOUR, F.lit(number).alias("_table")) for number, df in enumerate(tables)]
    held = reduce(DataFrame.unionAll, tagged).filter(_listed_hour() & F.col(DATE).isNotNull())
    masks = [
        F.coalesce(F.bit_or(F.when(F.col("_table") == number, _bit(F.col(HOUR)))), F.lit(0)) for number in range(len(tables))
    ]
    return _shared(held.groupBy(DATE).agg(reduce(Column.bitwiseAND, masks).alias("hours")))


def common_stored(masks: DataFrame, names: list[str]) -> DataFrame:
    """``common_masks`` out of stored masks (table_name, delivery_date, hours), of which there may be several per date."""
    each = [F.coalesce(F.bit_or(F.when(F.col("table_name") == name, F.col("hours"))), F.lit(0)) for name in names]
    return _shared(masks.groupBy(DATE).agg(reduce(Column.bitwiseAND, each).alias("hours")))


def _shared(masks: DataFrame) -> DataFrame:
    return masks.filter(F.col("hours") != 0)


def at_masks(df: DataFrame, masks: DataFrame) -> DataFrame:
    """Rows whose date and hour are in the masks: a semi join by broadcast, before anything is shuffled."""
    side = F.broadcast(masks.select(F.col(DATE).alias("_date"), F.col("hours").alias("_hours")))
    found = (F.col(DATE) == F.col("_date")) & _listed_hour()
    return df.join(side, found & (_has(F.col("_hours"), F.col(HOUR) % HOURS) == 1), "left_semi")


def _cell(hour: str, interval: str) -> Column:
    return F.col(hour) * INTERVALS + F.col(interval)


def _in_cells(hour: str, interval: str) -> Column:
    """Whether a cell has a place in the bitmaps; NULL where a key is missing."""
    return F.col(hour).between(0, HOURS - 1) & F.col(interval).between(0, INTERVALS - 1)


def cell_masks(df: DataFrame, date: str = DATE, hour: str = HOUR, interval: str = INTERVAL) -> DataFrame:
    """(_date, _cells): for each date with rows, masks of its cells of hour and interval, sixty-four to a mask."""
    cell = F.when(_in_cells(hour, interval), _cell(hour, interval))
    parts = [
        F.coalesce(F.bit_or(F.when(F.floor(cell / 64) == part, _bit((cell % 64).cast("int")))), F.lit(0))
        for part in range(HOURS * INTERVALS // 64)
    ]
    return df.filter(F.col(date).isNotNull()).groupBy(F.col(date).alias("_date")).agg(F.array(*parts).alias("_cells"))


def not_in_cells(
    incoming: DataFrame, stored: DataFrame, date: str = DATE, hour: str = HOUR, interval: str = INTERVAL
) -> DataFrame:
    """Incoming rows whose (date, hour, interval) is not stored; without hour or interval the date alone decides.

    A row without a date is new. Cells that have no place in the bitmaps are compared by a join of their own.
    """
    known = F.broadcast(cell_masks(stored, date, hour, interval))
    cell = _cell(hour, interval)
    found = _has(F.get("_cells", F.floor(cell / 64).cast("int")), (cell % 64).cast("int")) == 1
    partial = F.col(hour).isNull() | F.col(interval).isNull()
    seen = F.when(partial, F.lit(True)).when(_in_cells(hour, interval), found).otherwise(F.lit(False))
    near = incoming.join(known, F.col(date) == F.col("_date"), "left")
    fresh = near.filter(F.col("_date").isNull() | ~seen).select(*incoming.columns)
    far = F.coalesce(~_in_cells(hour, interval), F.lit(False)) & ~partial & F.col(date).isNotNull()
    odd = stored.filter(far).select(*(F.col(name).alias(f"_odd_{name}") for name in (date, hour, interval))).distinct()
    same = reduce(Column.__and__, [F.col(name) == F.col(f"_odd_{name}") for name in (date, hour, interval)])
    return fresh.filter(~far).unionByName(fresh.filter(far).join(odd, same, "left_anti"))
