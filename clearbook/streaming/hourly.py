"""Hourly prices out of a stream of interval prices: a late interval corrects its hour."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clearbook.operators.bounded import SmallList, keep_listed
from clearbook.operators.prices import HOUR_POINT_KEYS
from clearbook.operators.skew import null_safe_join
from clearbook.sources.tables import DATE, replace_dates
from clearbook.streaming.ingest import stream_files

HOURLY = "delivery_date date, hour_ending int, settlement_point string, price double, interval int, n_intervals long"


def hourly_stream(prices: DataFrame, late: str) -> DataFrame:
    """Mean price, first interval and number of intervals per date, hour and point of a stream of prices.

    Rows without one of the keys drop out, missing and NaN prices are not averaged. An hour stays open until the newest hour
    seen is ``late`` after it; an interval that comes later than that is lost to it, and the stream's metrics count it.
    """
    begins = F.timestamp_add("HOUR", F.col("hour_ending"), F.col(DATE).cast("timestamp")).alias("begins")
    timed = prices.dropna(subset=HOUR_POINT_KEYS).select("*", begins).withWatermark("begins", late)
    price = F.when(~F.isnan("price"), F.col("price"))
    hours = timed.groupBy("begins", *HOUR_POINT_KEYS).agg(
        F.avg(price).alias("price"), F.min("interval").alias("interval"), F.count("*").alias("n_intervals")
    )
    return hours.drop("begins")


def read_hourly(spark: SparkSession, target: str) -> DataFrame:
    """The hourly prices stored so far."""
    try:
        return spark.read.schema(HOURLY).parquet(target)
    except AnalysisException:
        return spark.createDataFrame([], HOURLY)


def hour_writer(target: str, stage: str) -> Callable[[DataFrame, int], None]:
    """Batch function for ``foreachBatch``: the hours of a batch take the place of what is stored of them.

    A batch has the whole value of each hour that it changes, so one that is delivered again changes nothing. Only the dates
    touched are written anew; rows go through a folder of their own, as a date cannot be replaced while it is read.
    """

    def write(hours: DataFrame, batch_id: int) -> None:
        spark = hours.sparkSession
        fresh = f"{stage}/batch={batch_id}"
        hours.write.mode("overwrite").parquet(f"{fresh}/changed")
        changed = spark.read.schema(hours.schema).parquet(f"{fresh}/changed")
        touched = SmallList(changed.select(DATE).distinct())
        if touched.is_empty:
            return
        stored = keep_listed(read_hourly(spark, target), touched, [DATE])
        rest = null_safe_join(stored, changed.select(*HOUR_POINT_KEYS), HOUR_POINT_KEYS, "left_anti")
        names = changed.columns
        rest.select(*names).unionByName(changed).write.mode("overwrite").parquet(f"{fresh}/whole")
        replace_dates(spark.read.schema(changed.schema).parquet(f"{fresh}/whole"), target)

    return write


def ingest_hourly(
    spark: SparkSession, source: str, header: list[str], target: str, checkpoint: str, late: str = "40 days"
) -> StreamingQuery:
    """Take in the price files not seen before and keep the hourly prices below ``target`` current, then stop."""
    hours = hourly_stream(stream_files(spark, source, header, "prices"), late)
    writer = hours.writeStream.outputMode("update").foreachBatch(hour_writer(target, f"{checkpoint}-stage"))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
