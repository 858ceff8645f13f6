"""Stored tables: tolerant reads, creation, appends and overwrites.

Tables are Parquet, partitioned by delivery date. Writers ask for a rebalance by the partition column first: Spark then
splits a large date over several tasks and merges small ones, so that neither a hot date nor many tiny files result. Loads
of few dates, whose writers say so, are written by the tasks that make the rows, and not shuffled once more.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearbook import schemas
from clearbook.operators.conform import conform, stamp
from clearbook.operators.quality import is_empty

DATE = "delivery_date"
#: Rows of so many dates, a month, make few files even if each task writes a file for each date.
FEW_DATES = 31

STORED = {
    "bids": schemas.ORDERS,
    "bid_awards": schemas.AWARDS,
    "offers": schemas.ORDERS,
    "offer_awards": schemas.AWARDS,
    "prices": schemas.PRICES,
    "price_intervals": schemas.PRICES,
    "final": schemas.CLASSIC_FINAL,
    "ledger": schemas.LEDGER,
    "presence": schemas.PRESENCE,
}


def with_load_time(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("inserted_at", T.TimestampType(), True)])


def read_or_empty(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """The table, or no rows in its layout when it does not exist."""
    if spark.catalog.tableExists(table):
        return spark.table(table)
    return spark.createDataFrame([], schema)


def read_if_present(spark: SparkSession, table: str) -> DataFrame | None:
    return spark.table(table) if spark.catalog.tableExists(table) else None


def create_tables(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create the database and its tables where they are absent; existing ones are left as they are."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}" + (f" LOCATION '{location}'" if location else ""))
    for name, schema in STORED.items():
        fields = with_load_time(schema).fields
        columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in fields)
        partition = f" PARTITIONED BY (`{DATE}`)" if DATE in schema.names else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet{partition}")


def _in_table_order(df: DataFrame, table: str, rebalance: bool) -> DataFrame:
    spark = df.sparkSession
    columns = spark.table(table).schema
    placed = conform(df, columns)
    return placed.hint("rebalance", F.col(DATE)) if rebalance and DATE in columns.names else placed


def append_rows(df: DataFrame, table: str, loaded_at: dt.datetime, rebalance: bool = True) -> None:
    """Append rows in the table's column order; a second run appends them again.

    Without ``rebalance`` they are written by the tasks that make them, for rows of ``FEW_DATES`` at most.
    """
    _in_table_order(stamp(df, loaded_at), table, rebalance).write.mode("append").insertInto(table)


def append_tables(frames: dict[str, DataFrame | None], database: str, loaded_at: dt.datetime) -> list[str]:
    """Append several frames to the tables of the same name; absent and empty ones are skipped. Returns what was written."""
    written = [name for name, frame in frames.items() if not is_empty(frame)]
    for name in written:
        append_rows(frames[name], f"{database}.{name}", loaded_at)
    return written


def table_location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE FORMATTED {table}").filter(F.col("col_name") == "Location")
    return described.first()["data_type"]


def overwrite_dates(df: DataFrame, table: str, loaded_at: dt.datetime, rebalance: bool = True) -> None:
    """Replace the delivery dates the rows belong to and leave all others: repeating it changes nothing.

    The files are written to the table's folder with a write option; no setting of the session is changed, so writers of
    one session do not disturb each other. ``rebalance`` as for ``append_rows``.
    """
    spark = df.sparkSession
    writer = _in_table_order(stamp(df, loaded_at), table, rebalance).write.mode("overwrite").partitionBy(DATE)
    writer.option("partitionOverwriteMode", "dynamic").parquet(table_location(spark, table))
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    spark.catalog.refreshTable(table)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediate files, wherever it is stored."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_by_date(df: DataFrame, path: str, mode: str = "append", column: str = DATE, rebalance: bool = True) -> None:
    """Write a folder of Parquet files partitioned by date; without ``rebalance`` by the tasks that make the rows."""
    placed = df.hint("rebalance", F.col(column)) if rebalance else df
    placed.write.mode(mode).partitionBy(column).parquet(path)


def replace_dates(df: DataFrame, path: str, column: str = DATE, rebalance: bool = True) -> None:
    """Replace the dates of a folder that the rows belong to and leave all others: repeating it changes nothing."""
    placed = df.hint("rebalance", F.col(column)) if rebalance else df
    writer = placed.write.mode("overwrite").partitionBy(column)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def write_by_year(df: DataFrame, path: str, date: str = DATE, clear: bool = False) -> None:
    """Write a folder with one partition per calendar year, optionally clearing it first."""
    yearly = with_year(df, date).hint("rebalance", F.col("year"))
    yearly.write.mode("overwrite" if clear else "append").partitionBy("year").parquet(path)


def with_year(df: DataFrame, date: str = DATE) -> DataFrame:
    return df.withColumn("year", F.year(date))
