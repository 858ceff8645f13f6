"""Batches of a stream merged by date, so that reading a table does not take longer with every batch.

A batch is a folder below ``<root>/<table>``. When enough of them have gathered, the dates that they touch are written anew,
together with what had been merged of these dates, as a version below ``<root>/_merged/<table>``. A manifest says up to which
batch the table is merged, and which version holds each date. It is written in one step after its version: a merge that is
killed before leaves the batches as they were, one that is killed later leaves folders that nobody reads and the next merge
removes. Files are as many as the dates take, and a merge rewrites touched dates only.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearbook.sources.loads import Files
from clearbook.sources.tables import DATE

COMPACT_EVERY = 20
_NONE = "none"


@dataclass(frozen=True)
class Manifest:
    """The last batch that is merged, -1 for none, and the version that holds each merged date."""

    last: int = -1
    dates: dict[str, int] = field(default_factory=dict)


def _manifests(root: str, table: str) -> str:
    return f"{root}/_merged/{table}/_manifest"


def _version(root: str, table: str, version: int) -> str:
    return f"{root}/_merged/{table}/version={version}"


def manifest(spark: SparkSession, root: str, table: str) -> Manifest:
    """The newest manifest of a table."""
    files = Files(spark, root)
    versions = [int(name[:-5]) for name in files.names(_manifests(root, table)) if name.endswith(".json")]
    if not versions:
        return Manifest()
    return Manifest(**json.loads(files.read(f"{_manifests(root, table)}/{max(versions)}.json")))


def _layout(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])


def _of_dates(dates: list[str]) -> Column:
    named = F.col(DATE).isin([F.lit(day).cast("date") for day in dates if day != _NONE])
    return named | F.col(DATE).isNull() if _NONE in dates else named


def _merged(spark: SparkSession, root: str, table: str, schema: T.StructType, known: Manifest, only: set[str] | None = None) -> list[DataFrame]:
    """The merged rows, a frame for each version that is still read, of all dates or of ``only`` some."""
    of_version: dict[int, list[str]] = {}
    for day, version in known.dates.items():
        if only is None or day in only:
            of_version.setdefault(version, []).append(day)
    names = _layout(schema).names
    return [
        spark.read.schema(_layout(schema)).parquet(_version(root, table, version)).filter(_of_dates(days)).select(*names)
        for version, days in sorted(of_version.items())
    ]


def _batches(spark: SparkSession, root: str, table: str, schema: T.StructType, after: int) -> DataFrame:
    try:
        rows = spark.read.schema(_layout(schema)).parquet(f"{root}/{table}")
    except AnalysisException:
        rows = spark.createDataFrame([], _layout(schema))
    return rows.filter(F.col("batch_id") > after).select(*_layout(schema).names)


def read_batches(spark: SparkSession, root: str, table: str, schema: T.StructType) -> DataFrame:
    """All rows of a table with their ``batch_id``; no rows when nothing was stored yet."""
    known = manifest(spark, root, table)
    fresh = _batches(spark, root, table, schema, known.last)
    return reduce(DataFrame.unionByName, _merged(spark, root, table, schema, known), fresh)


def compact(spark: SparkSession, root: str, table: str, schema: T.StructType, before: int, every: int) -> bool:
    """Merge the batches before number ``before`` if at least ``every`` have gathered; whether it was done."""
    files, known = Files(spark, root), manifest(spark, root, table)
    numbers = [int(name[9:]) for name in files.names(f"{root}/{table}") if name.startswith("batch_id=")]
    waiting = [number for number in numbers if known.last < number < before]
    if len(waiting) < every:
        return False
    rows = _batches(spark, root, table, schema, known.last).filter(F.col("batch_id") < before)
    # At most one value for each day of the calendar.
    touched = {str(row[0]) if row[0] is not None else _NONE for row in rows.select(DATE).distinct().collect()}
    whole = reduce(DataFrame.unionByName, _merged(spark, root, table, schema, known, touched), rows)
    writer = whole.hint("rebalance", F.col(DATE)).write.mode("overwrite").partitionBy(DATE)
    writer.parquet(_version(root, table, before))
    merged = Manifest(max(waiting), {**known.dates, **{day: before for day in touched}})
    files.mark(f"{_manifests(root, table)}/{before}.json", json.dumps({"last": merged.last, "dates": merged.dates}))
    _remove_unread(files, root, table, merged, before)
    return True


def _remove_unread(files: Files, root: str, table: str, known: Manifest, newest: int) -> None:
    for name in files.names(f"{root}/{table}"):
        if name.startswith("batch_id=") and int(name[9:]) <= known.last:
            files.remove(f"{root}/{table}/{name}")
    for name in files.names(f"{root}/_merged/{table}"):
        if name.startswith("version=") and int(name[8:]) not in known.dates.values():
            files.remove(f"{root}/_merged/{table}/{name}")
    for name in files.names(_manifests(root, table)):
        if name != f"{newest}.json":
            files.remove(f"{_manifests(root, table)}/{name}")
