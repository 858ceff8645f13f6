"""Date parsing, lags, months, source cutoff and date batches as column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The accepted layouts besides ISO, in the order they are tried. One-letter fields take one or two digits.
ISO_SLASH, MONTH_FIRST, DAY_FIRST, MONTH_FIRST_DASH = "yyyy/M/d", "M/d/yyyy", "d/M/yyyy", "M-d-yyyy"
AMBIGUOUS_ONE = "^0?1/(0?[1-9]|1[0-2])/"
ISO_SHAPE = "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
MAX_BATCH_DAYS = 100


def _as_column(value: Column | str | dt.date) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def _iso_date(text: Column) -> Column:
    """DATE from ISO text, by the plain cast, which is much faster than a pattern."""
    return F.when(text.rlike(ISO_SHAPE), text.try_cast("date"))


def parse_market_date(text: Column, day_first_when_one: bool = True) -> Column:
    """Text to DATE over all accepted layouts, NULL when none fits.

    ``01/06/2024`` is read day-first because its first field is 1 and its second could be a month; any other slash date
    is month-first, and day-first only where month-first is impossible. ``day_first_when_one=False`` drops the special
    case.
    """
    text = F.trim(text)
    attempts = [_iso_date(text), F.try_to_date(text, ISO_SLASH)]
    if day_first_when_one:
        attempts.append(F.when(text.rlike(AMBIGUOUS_ONE), F.try_to_date(text, DAY_FIRST)))
    attempts += [F.try_to_date(text, layout) for layout in (MONTH_FIRST, DAY_FIRST, MONTH_FIRST_DASH)]
    return F.coalesce(*attempts)


def normalize_date(text: Column, day_first_when_one: bool = True) -> Column:
    """ISO text of a date in any accepted layout; other text comes back trimmed, blank text untouched."""
    parsed = F.date_format(parse_market_date(text, day_first_when_one), "yyyy-MM-dd")
    return F.when(F.trim(text) == "", text).otherwise(F.coalesce(parsed, F.trim(text)))


def parse_stored_date(text: Column) -> Column:
    """DATE from stored text: ISO, else month-first, else an ISO prefix of ten characters, else NULL."""
    prefix = F.substring(text, 1, 10)
    return F.coalesce(_iso_date(text), F.try_to_date(text, MONTH_FIRST), _iso_date(prefix))


def flexible_bound(text: Column, is_start: bool) -> Column:
    """A day, or a month widened to its first (``is_start``) or last day; NULL for anything else."""
    month = F.try_to_date(text, "yyyy-M")
    return F.coalesce(_iso_date(text), month if is_start else F.last_day(month))


def parse_bound(text: str, is_start: bool) -> dt.date:
    """``flexible_bound`` for one parameter of a job; raises on text that is neither a day nor a month."""
    for layout in ("%Y-%m-%d", "%Y-%m"):
        try:
            parsed = dt.datetime.strptime(text, layout).date()
        except ValueError:
            continue
        if layout == "%Y-%m-%d" or is_start:
            return parsed
        return (parsed.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)
    raise ValueError(f"{text!r} is neither a day such as 2024-01-31 nor a month such as 2024-01")


def shift(date: Column, days: int = 0, months: int = 0) -> Column:
    """Move a date by a signed lag."""
    return F.date_add(F.add_months(date, months) if months else date, days)


def month_start(date: Column) -> Column:
    return F.trunc(date, "month").cast("date")


def month_end(date: Column) -> Column:
    return F.last_day(date)


def month_key(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def year_start(date: Column) -> Column:
    return F.make_date(F.year(date), F.lit(1), F.lit(1))


def year_end(date: Column) -> Column:
    return F.make_date(F.year(date), F.lit(12), F.lit(31))


def required_months(dates: DataFrame, date: str, lag_days: int) -> DataFrame:
    """Publication months that hold the rows of the given delivery dates, one row per month."""
    return dates.select(month_key(shift(F.col(date), lag_days)).alias("month")).distinct()


def days_of_range(spark: SparkSession, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """One row per calendar day of an inclusive range."""
    return spark.range(1).select(F.explode(F.sequence(_as_column(start), _as_column(end))).alias("day"))


def months_of_range(spark: SparkSession, start: str | dt.date, end: str | dt.date, extra: int = 0) -> DataFrame:
    """One row per month from the month of ``start`` to that of ``end`` plus ``extra`` months."""
    first, last = month_start(_as_column(start)), F.add_months(month_start(_as_column(end)), extra)
    months = F.explode(F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))).alias("day")
    return spark.range(1).select(months).select(month_key(F.col("day")).alias("month"))


def source_for_date(date: Column, cutoff: str | dt.date) -> Column:
    """``archive`` before the cutoff, ``current`` on and after it."""
    return F.when(date < _as_column(cutoff), F.lit("archive")).when(date.isNotNull(), F.lit("current"))


def needs_archive(start: Column, end: Column, cutoff: str | dt.date) -> Column:
    """True when any part of a range lies before the cutoff."""
    return (start < _as_column(cutoff)) | (end < _as_column(cutoff))


def split_at_cutoff(start: Column, end: Column, cutoff: str | dt.date) -> Column:
    """Struct of the part of a range before the cutoff and the part on or after it; an empty part is NULL."""
    cut = _as_column(cutoff)
    before = F.when(start < cut, F.struct(start.alias("start"), F.least(end, F.date_sub(cut, 1)).alias("end")))
    after = F.when(end >= cut, F.struct(F.greatest(start, cut).alias("start"), end.alias("end")))
    return F.struct(before.alias("archive"), after.alias("current"))


def batch_number(
    date: Column,
    start: str | dt.date | Column,
    end: str | dt.date | Column,
    days: int,
    mode: str = "forward",
    max_days: int | None = MAX_BATCH_DAYS,
) -> Column:
    """Batch a date falls into.

    ``forward``: runs of ``days``, but of ``max_days`` at most unless that is None, from the start. ``first_day``: the first day alone, then runs of
    ``days``; one single batch when the range has at most ``days`` + 1 days. ``backward``: runs of ``days`` from the
    end, newest run first.
    """
    start, end = _as_column(start), _as_column(end)
    offset = F.datediff(date, start)
    if mode == "forward":
        number = F.floor(offset / F.lit(days if max_days is None else min(days, max_days)))
    elif mode == "first_day":
        later = F.lit(1) + F.floor((offset - 1) / F.lit(days))
        number = F.when((F.datediff(end, start) <= days) | (offset == 0), F.lit(0)).otherwise(later)
    elif mode == "backward":
        number = F.floor(F.datediff(end, date) / F.lit(days))
    else:
        raise ValueError(f"unknown batch mode {mode!r}")
    return number.cast("int")


def date_batches(
    spark: SparkSession,
    start: str | dt.date,
    end: str | dt.date,
    days: int,
    mode: str = "forward",
    max_days: int | None = MAX_BATCH_DAYS,
) -> DataFrame:
    """Batches of a date range, ``batch``, ``batch_start``, ``batch_end``; raises when the range is reversed."""
    if dt.date.fromisoformat(str(start)) > dt.date.fromisoformat(str(end)):
        raise ValueError(f"range ends ({end}) before it begins ({start})")
    labelled = days_of_range(spark, start, end).withColumn(
        "batch", batch_number(F.col("day"), start, end, days, mode, max_days)
    )
    return bounds_by(labelled, ["batch"], "day", "batch_start", "batch_end")


def bounds_by(df: DataFrame, by: list[str], date: str, low: str, high: str) -> DataFrame:
    """First and last date per group."""
    return df.groupBy(*by).agg(F.min(date).alias(low), F.max(date).alias(high))
