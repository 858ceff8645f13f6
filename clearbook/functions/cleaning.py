"""Text cleaning and tolerant casts as column expressions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spellings of the two truth values, upper case.
TRUE_WORDS = ["Y", "YES", "TRUE", "T", "1", "V"]
FALSE_WORDS = ["N", "NO", "FALSE", "F", "0", ""]


def blank_to_null(text: Column) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(F.trim(text), F.lit(""))


def nan_to_null(value: Column, dtype: T.DataType) -> Column:
    """NULL for a floating NaN or for the word ``nan`` in text, else the value."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(value), value)
    if isinstance(dtype, T.StringType):
        return F.when(F.lower(F.trim(value)) != "nan", value)
    return value


def parse_boolean(value: Column, dtype: T.DataType) -> Column:
    """Boolean from a flag: numbers by being non-zero, text by the word lists; anything else is NULL.

    Blank text means false, so this must run before ``blank_to_null``.
    """
    if isinstance(dtype, T.BooleanType):
        return value
    if isinstance(dtype, T.NumericType):
        return nan_to_null(value, dtype) != 0
    word = F.upper(F.trim(value))
    return F.when(word.isin(TRUE_WORDS), F.lit(True)).when(word.isin(FALSE_WORDS), F.lit(False))


def header_key(name: str) -> str:
    """Header reduced to its letters and digits, upper case."""
    return re.sub("[^A-Za-z0-9]", "", str(name)).upper()


def header_key_of(text: Column) -> Column:
    """``header_key`` for header text held in a column."""
    return F.upper(F.regexp_replace(text, "[^A-Za-z0-9]", ""))


def snake_header(name: str) -> str:
    """Plain header form used for columns no alias covers: trimmed, lower case, blanks to underscores."""
    return name.strip().lower().replace(" ", "_")


def to_double(value: Column) -> Column:
    return value.try_cast("double")


def to_int(value: Column) -> Column:
    """Integer from text or number; ``5`` and ``5.0`` pass, ``5.5`` and words become NULL."""
    number = value.try_cast("double")
    return F.when(number == F.floor(number), number).try_cast("int")


def to_type(value: Column, dtype: T.DataType, source: T.DataType | None = None) -> Column:
    """Tolerant cast to a column type of the table layouts; ``source`` is the type of the value, where it is known.

    Dates and timestamps become dates by their type. Text that begins with an ISO date and goes on with a time of day is
    that date.
    """
    from clearbook.functions.dates import parse_market_date

    if isinstance(dtype, T.IntegerType):
        return to_int(value)
    if isinstance(dtype, T.DateType):
        if isinstance(source, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return value.cast("date")
        text = value.cast("string")
        return parse_market_date(F.regexp_replace(text, r"^(\s*\d{4}-\d{2}-\d{2})[T ]\s*\d{1,2}:\d{2}.*$", "$1"))
    if isinstance(dtype, T.StringType):
        return value.cast("string")
    return value.try_cast(dtype)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
