"""Interval and date/time columns."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.functions.directives import print_datetime, read_datetimes

def quoted(name: str) -> Column:
    """Column by literal name, whatever spaces, dots or brackets it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def moment_literal(value: date | datetime | str) -> Column:
    """A wall-clock moment as a literal that no time zone setting can move."""
    return F.lit(value if isinstance(value, str) else value.isoformat()).cast("timestamp_ntz")


def add_days_within(
    df: DataFrame, start: str = "Start Date", end: str = "End Date", name: str = "Days Within"
) -> DataFrame:
    """Number of days an interval covers, both ends counted."""
    return df.withColumn(name, F.datediff(quoted(end), quoted(start)) + 1)


def timeline(start: Column, end: Column, reference: Column) -> Column:
    """Where a reference date falls for an interval: Current, Past or Future."""
    inside = F.coalesce((start <= reference) & (reference <= end), F.lit(False))
    begun = F.coalesce(start < reference, F.lit(False))
    return F.when(inside, "Current").when(begun, "Past").otherwise("Future")


def add_timeline_evaluation(
    df: DataFrame,
    reference_date,
    remove_reference_date: bool = True,
    start: str = "Start Date",
    end: str = "End Date",
    name: str = "Timeline Evaluation",
    reference_name: str = "Reference Date",
) -> DataFrame:
    """Evaluate every interval against one date; optionally keep that date as a column."""
    reference = reference_date if isinstance(reference_date, Column) else moment_literal(reference_date)
    if not remove_reference_date:
        df = df.withColumn(reference_name, reference)
    return df.withColumn(name, timeline(quoted(start), quoted(end), reference))


def add_weekday_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """``Weekday for <column>`` with the full English day name."""
    return df.withColumns({f"Weekday for {c}": F.date_format(quoted(c), "EEEE") for c in columns})


def datetime_to_string(df: DataFrame, columns: list[str], strftime_format: str) -> DataFrame:
    """Print several datetime columns in place."""
    return df.withColumns({c: print_datetime(quoted(c), strftime_format) for c in columns})


def string_to_datetime(
    df: DataFrame, columns: list[str], strftime_format: str, lenient: bool = False, check_weekday: bool = True
) -> DataFrame:
    """Parse several text columns in place; a bad value fails the query unless ``lenient``."""
    return read_datetimes(df, [quoted(c) for c in columns], columns, strftime_format, lenient, check_weekday)


def now_utc() -> Column:
    """Wall clock in UTC, one value for the whole query."""
    return F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("timestamp_ntz")


def now_local() -> Column:
    """Wall clock in the session time zone, one value for the whole query."""
    return F.current_timestamp().cast("timestamp_ntz")


def epoch_to_timestamp(seconds: Column | str) -> Column:
    """Seconds since 1970 to a timestamp."""
    return F.timestamp_seconds(quoted(seconds) if isinstance(seconds, str) else seconds)


def epoch_to_string(seconds: Column | str, strftime_format: str = "%Y-%m-%d %H:%M:%S.%f") -> Column:
    """Seconds since 1970 as text, the way file times are reported."""
    return F.trim(print_datetime(epoch_to_timestamp(seconds), strftime_format))


def age_verdict(moment: Column, reference: Column) -> Column:
    """``newer``, ``same`` or ``older`` than a reference instant."""
    return F.when(moment > reference, "newer").when(moment == reference, "same").otherwise("older")
