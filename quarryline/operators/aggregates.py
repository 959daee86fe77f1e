"""Aggregations."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.functions.dates import quoted


def min_max_by_group(
    df: DataFrame,
    group_by: str | list[str],
    calculation: str,
    renames: dict[str, str] | None = None,
    sort: bool = False,
) -> DataFrame:
    """Smallest and largest value of a column per group, as ``<column>_min`` and ``<column>_max``.

    Rows without a key are left out, and NaN counts as missing; sorting the result by key is optional.
    """
    keys = [group_by] if isinstance(group_by, str) else list(group_by)
    low, high = f"{calculation}_min", f"{calculation}_max"
    floats = {name for name, kind in df.dtypes if kind in ("double", "float")}
    has_key = reduce(and_, [quoted(k).isNotNull() & (~F.isnan(quoted(k)) if k in floats else F.lit(True)) for k in keys])
    measured = quoted(calculation)
    if calculation in floats:
        measured = F.when(~F.isnan(measured), measured)
    result = (
        df.where(has_key)
        .groupBy(*[quoted(k) for k in keys])
        .agg(F.min(measured).alias(low), F.max(measured).alias(high))
    )
    if sort:
        result = result.orderBy(*[quoted(k) for k in keys])
    return result.withColumnsRenamed(renames or {})


def _position(order_by: list[str]) -> Column:
    """One sort key; a single column stays as it is, which keeps the aggregation hash-based."""
    if len(order_by) == 1:
        return quoted(order_by[0])
    return F.struct(*[quoted(c) for c in order_by])


def first_and_last(
    df: DataFrame, column: str, order_by: list[str], group_by: list[str] | None = None
) -> DataFrame:
    """Value of a column in the first and the last row of an order (which must be total)."""
    position = _position(order_by)
    return df.groupBy(*[quoted(c) for c in group_by or []]).agg(
        F.min_by(quoted(column), position).alias("first"),
        F.max_by(quoted(column), position).alias("last"),
    )


def first_current_and_last(
    df: DataFrame,
    column: str,
    order_by: list[str],
    group_by: list[str] | None = None,
    timeline: str = "Timeline Evaluation",
) -> DataFrame:
    """First and last value, and the largest value among the rows evaluated as Current."""
    position = _position(order_by)
    return df.groupBy(*[quoted(c) for c in group_by or []]).agg(
        F.min_by(quoted(column), position).alias("first"),
        F.max(F.when(quoted(timeline) == "Current", quoted(column))).alias("current"),
        F.max_by(quoted(column), position).alias("last"),
    )


def every_true(flag: Column) -> Column:
    """Aggregate: true when no row is false or null; true over no rows."""
    return F.coalesce(F.bool_and(F.coalesce(flag, F.lit(False))), F.lit(True))


def row_count(df: DataFrame, name: str = "rows_counted") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def file_count(df: DataFrame, name: str = "files_counted") -> DataFrame:
    """Number of source files the rows of a file-based DataFrame come from."""
    return df.agg(F.count_distinct(F.col("_metadata.file_path")).alias(name))
