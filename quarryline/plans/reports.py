"""Ready-made compositions of operators."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from quarryline.functions.dates import add_days_within, add_timeline_evaluation, add_weekday_columns
from quarryline.operators.aggregates import min_max_by_group


def interval_timeline(
    df: DataFrame, entity: str | list[str], moment: str, reference_date: date | str
) -> DataFrame:
    """First and last moment per entity as an interval, measured and placed on the time line."""
    names = {f"{moment}_min": "Start Date", f"{moment}_max": "End Date"}
    intervals = min_max_by_group(df, entity, moment, names)
    measured = add_days_within(intervals)
    placed = add_timeline_evaluation(measured, reference_date)
    return add_weekday_columns(placed, ["Start Date", "End Date"])
