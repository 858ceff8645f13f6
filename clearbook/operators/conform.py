"""Bring differently spelled records to a fixed table layout, and publish results under their external names."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearbook import schemas
from clearbook.functions.cleaning import (
    blank_to_null,
    header_key,
    nan_to_null,
    parse_boolean,
    snake_header,
    to_type,
)

# Parts of a header that mark a numeric column whose blanks mean "missing".
NUMERIC_MARKS = ["MW", "PRICE", "AWARD"]


def normalize_headers(df: DataFrame) -> DataFrame:
    """Every column name reduced to upper-case letters and digits."""
    return df.toDF(*[header_key(name) for name in df.columns])


def snake_headers(df: DataFrame) -> DataFrame:
    """Every column name trimmed, lower-cased, with underscores for blanks."""
    return df.toDF(*[snake_header(name) for name in df.columns])


def rename_by_alias(df: DataFrame, table: str, unknown: str = "keep", collision: str = "first") -> DataFrame:
    """Rename known header spellings of ``table`` to its column names in one projection.

    Unknown columns keep their name, or get the plain form with ``unknown="snake"``. Several spellings of one column
    fold into one: ``collision="first"`` takes the first that is not NULL, ``"last"`` takes the last column as it is.
    """
    aliases = schemas.ALIASES.get(table, {})
    groups: dict[str, list[Column]] = {}
    for position, name in enumerate(df.columns):
        fallback = snake_header(name) if unknown == "snake" else name
        target = aliases.get(header_key(name), name if name in aliases.values() else fallback)
        groups.setdefault(target, []).append(F.col(f"`{name}`") if df.columns.count(name) == 1 else df[position])
    merged = {
        name: (F.coalesce(*columns) if collision == "first" else columns[-1]) if len(columns) > 1 else columns[0]
        for name, columns in groups.items()
    }
    return df.select([column.alias(name) for name, column in merged.items()])


def missing_columns(df: DataFrame, schema: T.StructType) -> list[str]:
    """Columns of the layout the frame does not have, in layout order."""
    return [name for name in schema.names if name not in df.columns]


def rename_with_report(df: DataFrame, table: str) -> tuple[DataFrame, list[str], list[str]]:
    """``rename_by_alias`` with the layout columns the frame lacks and the columns it has beyond the layout."""
    renamed, schema = rename_by_alias(df, table), schemas.TABLES[table]
    return renamed, missing_columns(renamed, schema), [name for name in renamed.columns if name not in schema.names]


def trim_blank_columns(df: DataFrame, only_numeric_names: bool = False) -> DataFrame:
    """Trim text columns and turn blanks to NULL, everywhere or only where the name says the column is a number."""

    def applies(field: T.StructField) -> bool:
        if not isinstance(field.dataType, T.StringType):
            return False
        return not only_numeric_names or any(mark in field.name.upper() for mark in NUMERIC_MARKS)

    return df.select(
        [
            blank_to_null(F.col(field.name)).alias(field.name) if applies(field) else F.col(field.name)
            for field in df.schema
        ]
    )


def nan_columns_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NaN, or the word ``nan``, to NULL in the given columns (all by default)."""
    return df.select(
        [
            nan_to_null(F.col(field.name), field.dataType).alias(field.name)
            if columns is None or field.name in columns
            else F.col(field.name)
            for field in df.schema
        ]
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of the layout, in its order and types; absent ones are NULL, extra ones go."""
    present = {field.name: field.dataType for field in df.schema}

    def column(field: T.StructField) -> Column:
        if field.name not in present:
            return F.lit(None).cast(field.dataType).alias(field.name)
        source = F.col(field.name)
        if present[field.name] == field.dataType:
            return source
        if isinstance(field.dataType, T.BooleanType):
            return parse_boolean(source, present[field.name]).alias(field.name)
        return to_type(source, field.dataType, present[field.name]).alias(field.name)

    return df.select([column(field) for field in schema])


def conform_table(
    df: DataFrame, table: str, flag_type: T.DataType | None = None, carry: list[str] | None = None
) -> DataFrame:
    """Raw records to a table layout: alias rename, flags, blanks, types.

    With ``flag_type=BooleanType()`` the indicators of an order are parsed as booleans, before blanks become NULL,
    because a blank indicator means false. ``carry`` names further columns to keep, such as the position in the file.
    """
    renamed = rename_by_alias(df, table)
    schema = schemas.TABLES[table]
    if flag_type is not None and table in ("bids", "offers"):
        schema = schemas.orders_schema(flag_type)
        types = {field.name: field.dataType for field in renamed.schema}
        flags = [name for name in ("multi_hour_block", "block_curve") if name in types]
        renamed = renamed.withColumns({name: parse_boolean(F.col(name), types[name]) for name in flags})
    carried = [field for field in renamed.schema if field.name in (carry or [])]
    return conform(nan_columns_to_null(trim_blank_columns(renamed)), T.StructType([*schema.fields, *carried]))


def narrow(df: DataFrame) -> DataFrame:
    """Halve the width of numbers: LONG to INT, DOUBLE to FLOAT. Not meant for columns that are joined on."""
    slim = {"bigint": "int", "double": "float"}
    return df.select([F.col(name).cast(slim.get(dtype, dtype)).alias(name) for name, dtype in df.dtypes])


def stamp(df: DataFrame, loaded_at: dt.datetime) -> DataFrame:
    """Add the load time, one literal for the whole run."""
    return df.withColumn("inserted_at", F.lit(loaded_at).cast("timestamp"))


def publish(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Select the columns of an external layout, in its order and under its names; a missing column is an error."""
    optional = {"inserted_at"}
    return df.select([F.col(name).alias(out) for name, out in names.items() if name in df.columns or name not in optional])
