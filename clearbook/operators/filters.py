"""Row filters by participant, settlement point, date and emptiness."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearbook.functions.cleaning import blank_to_null
from clearbook.operators.bounded import SMALL_ROWS, SmallList, keep_listed, name_frame

# Spellings of the settlement point column, in the order they are looked for.
POINT_NAMES = ["SettlementPoint", "settlementPointName", "SettlementPointName", "settlementPoint", "settlement_point"]


def names_frame(df: DataFrame, names: DataFrame | Iterable[str], column: str) -> DataFrame:
    if isinstance(names, DataFrame):
        return names.toDF(column)
    return name_frame(df.sparkSession, names, column)


def keep_qses(df: DataFrame, names: DataFrame | Iterable[str], column: str = "qse_name") -> DataFrame:
    """Rows of the listed participants, exact match. No list means no rows, and neither does a missing column."""
    if column not in df.columns:
        return df.filter(F.lit(False))
    return keep_listed(df, SmallList(names_frame(df, names, column).distinct()), [column])


def keep_qses_any_case(df: DataFrame, names: DataFrame | Iterable[str], column: str = "qse_name") -> DataFrame:
    """Rows of the listed participants ignoring case; an empty list, or a missing column, filters nothing."""
    if column not in df.columns:
        return df
    listed = SmallList(names_frame(df, names, "_name").select(F.upper("_name").alias("_name")).distinct())
    if listed.is_empty:
        return df
    return df.join(listed.side(), F.upper(F.col(column)) == F.col("_name"), "left_semi")


def first_column(df: DataFrame, candidates: list[str]) -> str | None:
    """First of several possible column names the frame really has (exact case)."""
    return next((name for name in candidates if name in df.columns), None)


def keep_points(
    df: DataFrame,
    points: DataFrame | Iterable[str],
    candidates: list[str] | None = None,
    on_empty: str = "drop",
    max_rows: int = SMALL_ROWS,
) -> DataFrame:
    """Rows at the listed settlement points.

    Only the first existing spelling of the point column counts; NULL and blank points drop out. An empty list keeps
    nothing, or with ``on_empty="pass"`` everything.
    """
    column = first_column(df, candidates or POINT_NAMES)
    if column is None:
        return df.filter(F.lit(False))
    listed = SmallList(names_frame(df, points, column).filter(F.col(column) != "").distinct(), max_rows)
    if listed.is_empty:
        return df if on_empty == "pass" else df.filter(F.lit(False))
    return keep_listed(df, listed, [column])


def between_dates(df: DataFrame, start: dt.date | str, end: dt.date | str, column: str = "delivery_date") -> DataFrame:
    """Rows of an inclusive date range; on a date-partitioned table this prunes partitions."""
    return df.filter(F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def positive(df: DataFrame, column: str = "award_mw") -> DataFrame:
    return df.filter(F.col(column) > 0)


def present(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a value in every given column."""
    return df.dropna(how="any", subset=columns)


def drop_empty(df: DataFrame, meta: tuple[str, ...] = ("inserted_at",)) -> DataFrame:
    """Rows with at least one value, NULL or blank not counting, outside the bookkeeping columns."""
    values = [blank_to_null(F.col(f"`{name}`").cast("string")) for name in df.columns if name not in meta]
    return df.filter(F.coalesce(*values).isNotNull())
