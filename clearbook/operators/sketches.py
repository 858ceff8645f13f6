"""Load profiles that can be merged: sketches of distinct values and of frequent values, a row per column and load.

Sketches of loads are kept as they are and merged by union: a profile over many loads reads a few kilobytes for each, and not
their rows. The number of distinct values is an estimate, whose relative standard error is 1.04 / sqrt(2 ** ``SIZE``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Logarithm of the registers of a sketch of distinct values; values that a sketch of frequent values tracks.
SIZE, TRACKED = 12, 1_000
#: Relative error that the estimate keeps to in all but a few of a thousand cases: three standard errors.
BOUND = 3 * 1.04 / 2 ** (SIZE / 2)


def column_sketches(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column_name``, ``n_rows``, ``n_missing``, ``distinct``, ``frequent``: one pass over the rows for all columns."""
    cells = []
    for name in columns:
        value = F.col(f"`{name}`").cast("string")
        cells.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.count("*").alias("n_rows"),
                F.count_if(value.isNull()).alias("n_missing"),
                F.hll_sketch_agg(value, SIZE).alias("distinct"),
                F.call_function("approx_top_k_accumulate", value, F.lit(TRACKED)).alias("frequent"),
            )
        )
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """One row per column out of the sketches of several loads; merging merged ones again gives the same."""
    return sketches.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_missing").alias("n_missing"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.call_function("approx_top_k_combine", F.col("frequent"), F.lit(TRACKED)).alias("frequent"),
    )


def sketched_profile(sketches: DataFrame, k: int = 5) -> DataFrame:
    """``column_name``, ``n_rows``, ``n_missing``, ``n_distinct`` (estimated) and the ``k`` most frequent values with counts."""
    return sketches.select(
        "column_name",
        "n_rows",
        "n_missing",
        F.hll_sketch_estimate("distinct").alias("n_distinct"),
        F.call_function("approx_top_k_estimate", F.col("frequent"), F.lit(k)).alias("most_frequent"),
    )
