"""Lists of tracked participants."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearbook.operators.bounded import name_frame
from clearbook.operators.conform import conform_table
from clearbook.operators.quality import split_valid, tracked_rules

# Fixed value: column of a tracking list that holds the participant's short name.
SHORT_NAME = "SHORT NAME"


def short_names(listing: DataFrame, column: str = SHORT_NAME) -> DataFrame:
    """Distinct trimmed short names, blanks left out, as ``qse_name``; none when the column is missing."""
    if column not in listing.columns:
        return name_frame(listing.sparkSession, [], "qse_name")
    name = F.trim(F.col(f"`{column}`"))
    return listing.select(name.alias("qse_name")).filter(F.col("qse_name") != "").distinct()


def load_short_names(spark: SparkSession, path: str) -> DataFrame:
    """Short names of a tracking list file; a missing file gives none."""
    try:
        return short_names(spark.read.option("header", True).csv(path))
    except AnalysisException:
        return name_frame(spark, [], "qse_name")


def inline_names(spark: SparkSession, text: str) -> DataFrame:
    """Names of a comma separated parameter."""
    return name_frame(spark, [name.strip() for name in text.split(",") if name.strip()], "qse_name")


def first_column_names(listing: DataFrame) -> DataFrame:
    """Distinct values of the first column, as they are; the fallback for lists without a short name column."""
    return listing.select(F.col(f"`{listing.columns[0]}`").alias("qse_name")).dropna().distinct()


def tracked_participants(listing: DataFrame) -> DataFrame:
    """Valid rows of a tracking list in its full layout; ``nan`` counts as missing."""
    conformed = conform_table(listing, "tracked_qse")
    return split_valid(conformed, tracked_rules())[0]
