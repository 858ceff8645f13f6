"""Load interval prices from records of a report service."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearbook import schemas
from clearbook.operators.bounded import SmallList, keep_listed
from clearbook.operators.conform import conform_table, rename_by_alias
from clearbook.operators.dedup import keep_first
from clearbook.operators.joins import new_by_interval, prices_at_points
from clearbook.operators.prices import hourly_by_hour, hourly_by_point
from clearbook.operators.quality import is_empty, require_columns
from clearbook.operators.sets import active_points
from clearbook.operators.skew import null_safe_join
from clearbook.session import shared_dir
from clearbook.sources import tables

INTERVAL_KEYS = ["delivery_date", "hour_ending", "interval", "settlement_point"]


def new_prices(
    records: DataFrame,
    stored: DataFrame,
    order: str | Column,
    by_point: bool = True,
    points: DataFrame | None = None,
) -> DataFrame:
    """Hourly prices of the records that are not stored yet.

    Records must have all seven price fields under any known spelling. Averages are per point, or across points with
    ``by_point=False``. ``points`` keeps the listed settlement points only; an empty list keeps all.
    """
    renamed = rename_by_alias(records, "prices")
    require_columns(renamed, schemas.PRICES.names, "prices")
    order_column = F.col(order) if isinstance(order, str) else order
    typed = conform_table(records.withColumn("_order", order_column), "prices", carry=["_order"])
    fresh = new_by_interval(typed, stored)
    average = hourly_by_point if by_point else hourly_by_hour
    hourly = average(fresh, F.col("_order")).drop("_order")
    return hourly if points is None else prices_at_points(hourly, points, on_empty="pass")


def new_intervals(records: DataFrame, stored: DataFrame) -> DataFrame:
    """Interval rows of the records whose date, hour, interval and point are not stored; NULL keys match.

    Records must have all seven price fields under any known spelling. Of rows that repeat a key within the load the one
    with the smallest values counts.
    """
    renamed = rename_by_alias(records, "prices")
    require_columns(renamed, schemas.PRICES.names, "prices")
    fresh = keep_first(conform_table(records, "prices"), INTERVAL_KEYS, ["price", "point_type", "dst_flag"])
    return null_safe_join(fresh, stored.select(*INTERVAL_KEYS).distinct(), INTERVAL_KEYS, "left_anti")


def load_prices(
    records: DataFrame,
    database: str,
    loaded_at: dt.datetime,
    by_point: bool = True,
    only_awarded: bool = False,
) -> None:
    """Add the intervals of the records to the interval table and average the hours of their dates anew.

    Loading the same records again changes nothing, and an interval that comes later corrects its hour. The dates touched
    are replaced in the price table; hourly rows there that have no stored interval stay. ``only_awarded`` keeps points
    that have an award.
    """
    if is_empty(records):
        return
    spark = records.sparkSession
    intervals, hourly = f"{database}.price_intervals", f"{database}.prices"
    touched_dates = conform_table(records, "prices").select(tables.DATE).filter(F.col(tables.DATE).isNotNull())
    touched = SmallList(touched_dates.distinct())
    stored = tables.read_or_empty(spark, intervals, schemas.PRICES)
    # Rows without a date are compared with all that have none: they are in no hour, and stored once like others.
    undated = stored.filter(F.col(tables.DATE).isNull())
    known = keep_listed(stored, touched, [tables.DATE]).unionByName(undated)
    tables.append_rows(new_intervals(records, known), intervals, loaded_at)
    raw = keep_listed(spark.table(intervals), touched, [tables.DATE]).drop("inserted_at")
    average = hourly_by_point if by_point else hourly_by_hour
    averaged = average(raw, F.struct("interval", "price"))
    if only_awarded:
        awards = [tables.read_or_empty(spark, f"{database}.{name}", schemas.AWARDS) for name in ("bid_awards", "offer_awards")]
        averaged = prices_at_points(averaged, active_points(*awards), on_empty="pass")
    stored = keep_listed(tables.read_or_empty(spark, hourly, schemas.PRICES), touched, [tables.DATE]).drop("inserted_at")
    keys = schemas.PRICE_JOIN_KEYS if by_point else ["delivery_date", "hour_ending"]
    rest = null_safe_join(stored, averaged.select(*keys), keys, "left_anti")
    columns = schemas.PRICES.names
    together = averaged.select(*columns).unionByName(rest.select(*columns))
    # A table cannot be replaced while it is read: the new rows go through a folder of their own.
    stage = f"{shared_dir(spark)}/clearbook-prices-{uuid.uuid4().hex}"
    together.write.parquet(stage)
    tables.overwrite_dates(spark.read.schema(together.schema).parquet(stage), hourly, loaded_at)
    tables.remove_folder(spark, stage)
