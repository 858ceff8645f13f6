"""Lists that must stay small: measured before they are broadcast."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearbook.functions.cleaning import all_of

# A filter list up to this many rows is shipped to every executor; a longer one is joined by shuffle.
SMALL_ROWS = 200_000
# A one-column list up to this many rows is written into the filter itself.
LITERAL_ROWS = 1_000


class SmallList:
    """A distinct list of keys, held on the driver when it is proven small.

    At most ``max_rows + 1`` rows ever reach the driver. Past the bound the list stays a distributed plan, and the
    joins built on it are left to shuffles and adaptive skew handling; the result is the same either way.
    """

    def __init__(self, keys: DataFrame, max_rows: int = SMALL_ROWS) -> None:
        fetched = keys.limit(max_rows + 1).toArrow()
        self.is_small = fetched.num_rows <= max_rows
        self.is_empty = fetched.num_rows == 0
        self._rows = fetched if self.is_small else None
        self.frame = keys.sparkSession.createDataFrame(fetched, keys.schema) if self.is_small else keys

    def side(self, names: list[str] | None = None) -> DataFrame:
        """The list as a join side, renamed if wanted: with a broadcast hint only when its size has been checked."""
        frame = self.frame.toDF(*names) if names else self.frame
        return F.broadcast(frame) if self.is_small else frame

    def literals(self) -> list | None:
        """Values of a one-column list that is short enough to be written into a filter, NULL left out."""
        if self._rows is None or self._rows.num_columns != 1 or self._rows.num_rows > LITERAL_ROWS:
            return None
        return [value for value in self._rows.column(0).to_pylist() if value is not None]

    def bounds(self, column: str) -> tuple | None:
        """Least and greatest value of a column of a small list; None when there is none."""
        values = [] if self._rows is None else [v for v in self._rows.column(column).to_pylist() if v is not None]
        return (min(values), max(values)) if values else None


def _list_join(df: DataFrame, keys: SmallList, on: list[str], how: str) -> DataFrame:
    """Semi or anti join by condition and not by name, which would move the key columns to the front."""
    hidden = [f"_listed_{number}" for number in range(len(on))]
    matches = [F.col(f"`{name}`") == F.col(other) for name, other in zip(on, hidden)]
    return df.join(keys.side(hidden), all_of(matches), how)


def keep_listed(df: DataFrame, keys: SmallList, on: list[str]) -> DataFrame:
    """Rows whose key is in the list, which has its columns in the order of ``on``; NULL keys never are.

    A short one-column list becomes a filter, which reaches the scan and prunes partitions.
    """
    values = keys.literals()
    if values is not None:
        return df.filter(F.col(f"`{on[0]}`").isin(values) if values else F.lit(False))
    return _list_join(df, keys, on, "left_semi")


def drop_listed(df: DataFrame, keys: SmallList, on: list[str]) -> DataFrame:
    """Rows whose key is not in the list; NULL keys stay."""
    values = keys.literals()
    if values is not None:
        column = F.col(f"`{on[0]}`")
        return df.filter(column.isNull() | ~column.isin(values)) if values else df
    return _list_join(df, keys, on, "left_anti")


def name_frame(spark: SparkSession, names: Iterable[str], column: str) -> DataFrame:
    """One-column frame of the distinct names given as a parameter."""
    schema = T.StructType([T.StructField(column, T.StringType())])
    return spark.createDataFrame([(name,) for name in sorted(set(names))], schema)
