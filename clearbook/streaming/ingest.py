"""Take in new files only, exactly once, and keep the settlement of the touched dates current."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clearbook import schemas
from clearbook.operators.bounded import SmallList, keep_listed
from clearbook.operators.conform import conform_table
from clearbook.operators.filters import drop_empty
from clearbook.operators.prices import hourly_by_point
from clearbook.plans.classic import MarketTables, classic_final
from clearbook.sources.tables import DATE, FEW_DATES
from clearbook.streaming import compaction
from clearbook.streaming.compaction import COMPACT_EVERY


def stream_files(spark: SparkSession, source: str, header: list[str], table: str, files_per_trigger: int = 1_000) -> DataFrame:
    """Stream of typed rows out of the CSV files that appear in a folder.

    ``header`` is the published header of the product; a file with another header fails the stream. Rows without any
    value are left out.
    """
    raw = T.StructType([T.StructField(name, T.StringType()) for name in header])
    lines = spark.readStream.schema(raw).options(
        header=True, enforceSchema=False, maxFilesPerTrigger=files_per_trigger
    )
    return conform_table(drop_empty(lines.csv(source)), table)


def ingest_files(
    spark: SparkSession, source: str, header: list[str], table: str, target: str, checkpoint: str
) -> StreamingQuery:
    """Append the rows of all files not seen before to a date-partitioned folder, then stop.

    The file sink and the checkpoint together give exactly-once output; a failed run resumes where it stopped.
    """
    rows = stream_files(spark, source, header, table)
    writer = rows.writeStream.format("parquet").partitionBy(DATE).option("path", target)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def batch_writer(
    root: str, table: str, after: Callable[[DataFrame, SparkSession], None], compact_every: int = COMPACT_EVERY
) -> Callable[[DataFrame, int], None]:
    """Batch function for ``foreachBatch``: store the batch under its number, then call ``after`` with its dates.

    A batch that is delivered again replaces its own folder, so replays do not repeat rows. Once ``compact_every`` batches
    have gathered they are merged, see ``compaction``, before the next is stored: a stream hands over a batch only when all
    earlier ones are done. A batch of few dates is written by the tasks that read it; merging sees to the size of its files.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        if batch_id <= compaction.manifest(spark, root, table).last:
            return
        compaction.compact(spark, root, table, schemas.TABLES[table], batch_id, compact_every)
        target = f"{root}/{table}/batch_id={batch_id}"
        few = SmallList(rows.select(DATE).distinct(), FEW_DATES).is_small
        placed = rows if few else rows.hint("rebalance", F.col(DATE))
        placed.write.mode("overwrite").partitionBy(DATE).parquet(target)
        # The stored form can be read no sooner than something was written.
        stored = read_table(spark, root, table).filter(F.col("batch_id") == batch_id)
        after(stored.select(DATE).distinct(), spark)

    return write


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All stored batches of a table; no rows when nothing was stored yet."""
    return compaction.read_batches(spark, root, table, schemas.TABLES[table])


def merge_touched(dates: DataFrame, spark: SparkSession, root: str) -> None:
    """Rebuild the settlement of the given dates and replace just those."""
    touched = SmallList(dates.filter(F.col(DATE).isNotNull()))
    names = ("bids", "bid_awards", "offers", "offer_awards", "prices")
    stored = {name: keep_listed(read_table(spark, root, name), touched, [DATE]).drop("batch_id") for name in names}
    order = F.struct("interval", "price")
    stored["prices"] = hourly_by_point(stored["prices"], order)
    final = classic_final(MarketTables(**stored))
    days = touched.literals()
    few = days is not None and len(days) <= FEW_DATES
    writer = (final if few else final.hint("rebalance", F.col(DATE))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(DATE).parquet(f"{root}/final")


def ingest_and_merge(
    spark: SparkSession, source: str, header: list[str], table: str, root: str, checkpoint: str,
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """``ingest_files`` with the settlement of the touched dates rebuilt after every batch."""
    write = batch_writer(root, table, lambda dates, session: merge_touched(dates, session, root), compact_every)
    stream = stream_files(spark, source, header, table).writeStream.foreachBatch(write)
    return stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
