"""Calculated-date expressions as Spark columns.

An expression reads ``CalculatedDate_<alias>`` or ``CalculatedDate_<alias>_<offset>``. The alias
names a period (year, half, quarter, ISO week, ...) and the offset moves the reference date by
that many units of the period before it is printed.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.functions.dates import moment_literal

# Both aliases of every period.
ALIASES = {
    "year": ("CY", "CurrentYear"),
    "semester": ("CYCS", "CurrentYearCurrentSemester"),
    "semester_week": ("CYCSCW", "CurrentYearCurrentSemesterCurrentWeek"),
    "just_semester": ("CS", "CurrentSemester"),
    "quarter": ("CYCQ", "CurrentYearCurrentQuarter"),
    "quarter_week": ("CYCQCW", "CurrentYearCurrentQuarterCurrentWeek"),
    "just_quarter": ("CQ", "CurrentQuarter"),
    "fiscal_period": ("CYCFP", "CurrentYearCurrentFiscalPeriod"),
    "just_fiscal_period": ("CFP", "FiscalPeriod"),
    "month": ("CYCM", "CurrentYearCurrentMonth"),
    "just_month": ("CM", "CurrentMonth"),
    "week": ("CYCW", "CurrentYearCurrentWeek"),
    "just_week": ("CW", "CurrentWeek"),
    "day": ("CYCMCD", "CurrentYearCurrentMonthCurrentDay"),
    "just_day": ("CD", "CurrentDay"),
    "hour": ("CYCMCDCH", "CurrentYearCurrentMonthCurrentDayCurrentHour"),
}

# What one offset step of a period is worth.
OFFSET_UNITS = {
    "year": ("months", 12),
    "semester": ("months", 6),
    "semester_week": ("days", 7),
    "quarter": ("months", 3),
    "quarter_week": ("days", 7),
    "fiscal_period": ("months", 1),
    "month": ("months", 1),
    "week": ("days", 7),
    "day": ("days", 1),
    "hour": ("hours", 1),
}

# Spark patterns of the periods that are plain calendar formatting.
CALENDAR_PATTERNS = {
    "year": "yyyy",
    "fiscal_period": "yyyy'0'MM",
    "just_fiscal_period": "'0'MM",
    "month": "yyyyMM",
    "just_month": "MM",
    "day": "yyyyMMdd",
    "just_day": "dd",
    "hour": "yyyyMMddHHmmssSSSSSS",
}

# Periods with a total order in time, and the unit a barrier is truncated to.
BARRIER_UNITS = {
    "year": "YEAR",
    "fiscal_period": "MONTH",
    "month": "MONTH",
    "day": "DAY",
    "hour": None,
}

PERIOD_OF_ALIAS = {alias: period for period, pair in ALIASES.items() for alias in pair}

TOKEN_PATTERN = r"CalculatedDate_([A-Za-z]{2,75})(?:_(-?[0-9]{1,2}))?"

MONTH_END_POLICIES = ("roll_forward", "clamp")


@dataclass(frozen=True)
class CalculatedDate:
    """A parsed expression: the period it prints and the offset applied first."""

    period: str
    offset: int

    @classmethod
    def parse(cls, expression: str) -> "CalculatedDate":
        found = re.fullmatch(TOKEN_PATTERN, expression)
        if found is None:
            raise ValueError(f"not a calculated date expression: {expression!r}")
        return cls.from_match(found)

    @classmethod
    def from_match(cls, found: re.Match) -> "CalculatedDate":
        alias, offset = found.groups()
        if alias not in PERIOD_OF_ALIAS:
            raise ValueError(f"unknown calculated date alias: {alias!r}")
        return cls(PERIOD_OF_ALIAS[alias], int(offset or 0))


def offset_unit(period: str) -> tuple[str, int]:
    return OFFSET_UNITS[period.removeprefix("just_")]


def _as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def add_months_exact(ts: Column, months: Column | int, month_end: str = "roll_forward") -> Column:
    """Move by months, keeping the time of day.

    ``roll_forward`` lands on the first of the next month when the target month is too short
    (31 January + 1 month = 1 March); ``clamp`` is Spark's own rule (last day of February).
    """
    if month_end not in MONTH_END_POLICIES:
        raise ValueError(f"month_end must be one of {MONTH_END_POLICIES}, not {month_end!r}")
    months = F.lit(months) if isinstance(months, int) else months
    moved = ts + F.make_ym_interval(F.lit(0), months)
    if month_end == "clamp":
        return moved
    too_short = F.dayofmonth(moved) < F.dayofmonth(ts)
    return F.when(too_short, moved + F.make_dt_interval(F.lit(1))).otherwise(moved)


def shift_period(
    ts: Column | str, period: str, offset: Column | int, month_end: str = "roll_forward"
) -> Column:
    """Move a timestamp by ``offset`` units of a period."""
    ts = _as_column(ts)
    unit, size = offset_unit(period)
    if isinstance(offset, int):
        if offset == 0:
            return ts
        steps = F.lit(offset * size)
    else:
        steps = offset * F.lit(size)
    if unit == "months":
        return add_months_exact(ts, steps, month_end)
    if unit == "days":
        return ts + F.make_dt_interval(steps)
    return ts + F.make_dt_interval(F.lit(0), steps)


def _week_anchor(ts: Column, week_start: int | Column) -> Column:
    """The date whose ISO week is meant: weeks that start on Sunday look one day ahead."""
    day = ts.cast("date")
    if isinstance(week_start, Column):
        return F.when(week_start == 7, F.date_add(day, 1)).otherwise(day)
    return F.date_add(day, 1) if week_start == 7 else day


def iso_week(ts: Column | str, week_start: int | Column = 1) -> Column:
    """ISO week as two digits; ``week_start=7`` lets weeks begin on Sunday."""
    return F.lpad(F.weekofyear(_week_anchor(_as_column(ts), week_start)).cast("string"), 2, "0")


def iso_week_year(ts: Column | str, week_start: int | Column = 1) -> Column:
    """The ISO year a week belongs to, as text."""
    return F.extract(F.lit("YEAROFWEEK"), _week_anchor(_as_column(ts), week_start)).cast("string")


def format_period(ts: Column | str, period: str, week_start: int | Column = 1) -> Column:
    """Print a timestamp as a period."""
    ts = _as_column(ts)
    if period in CALENDAR_PATTERNS:
        return F.date_format(ts, CALENDAR_PATTERNS[period])
    week = F.weekofyear(_week_anchor(ts, week_start))
    week_text = iso_week(ts, week_start)
    iso_year = iso_week_year(ts, week_start)
    calendar_year = F.date_format(ts, "yyyy")
    half = F.concat(F.lit("H"), F.ceil(week / 26).cast("string"))
    quarter = F.concat(F.lit("Q"), F.least(week, F.quarter(ts)).cast("string"))
    parts = {
        "semester": (calendar_year, half),
        "semester_week": (iso_year, half, F.lit("wk"), week_text),
        "just_semester": (half,),
        "quarter": (calendar_year, quarter),
        "quarter_week": (iso_year, quarter, F.lit("wk"), week_text),
        "just_quarter": (quarter,),
        "week": (iso_year, week_text),
        "just_week": (week_text,),
    }
    if period not in parts:
        raise ValueError(f"unknown period: {period!r}")
    return F.concat(*parts[period])


def calculated_date(
    ts: Column | str, expression: str, week_start: int = 1, month_end: str = "roll_forward"
) -> Column:
    """Evaluate one expression against a timestamp or date column."""
    parsed = CalculatedDate.parse(expression)
    moved = shift_period(_as_column(ts), parsed.period, parsed.offset, month_end)
    return format_period(moved, parsed.period, week_start)


def barrier(ts: Column | str, expression: str, month_end: str = "roll_forward") -> Column:
    """The instant an expression stands for; only for periods that are ordered in time."""
    parsed = CalculatedDate.parse(expression)
    if parsed.period not in BARRIER_UNITS:
        raise ValueError(
            f"{expression!r} has no place on the time line; use one of {sorted(BARRIER_UNITS)}"
        )
    moved = shift_period(_as_column(ts), parsed.period, parsed.offset, month_end)
    unit = BARRIER_UNITS[parsed.period]
    return moved if unit is None else F.date_trunc(unit, moved).cast("timestamp_ntz")


def alias_table(spark: SparkSession) -> DataFrame:
    """The aliases as a table: alias, period, offset unit and size."""
    values = ", ".join(
        "('{}', '{}', '{}', {})".format(alias, period, *offset_unit(period))
        for alias, period in PERIOD_OF_ALIAS.items()
    )
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(alias, period, offset_unit, offset_size)")


def alias_map() -> Column:
    """The aliases as a map literal (alias -> period)."""
    return F.create_map(*[F.lit(text) for pair in PERIOD_OF_ALIAS.items() for text in pair])


def render_text(
    text: Column | str,
    ts: Column | str,
    week_start: int = 1,
    month_end: str = "roll_forward",
) -> Column:
    """Replace every expression found in a text column by its value for the row's timestamp.

    The tokens may differ from row to row. The text is cut at the tokens and put together again,
    so one token being the prefix of another does no harm.
    """
    text, ts = _as_column(text), _as_column(ts)
    aliases = F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), 1)
    offsets = F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), 2)

    def moved(alias: Column, offset_text: Column) -> Column:
        offset = F.coalesce(F.nullif(offset_text, F.lit("")).cast("int"), F.lit(0))
        shifted = ts
        for unit, size in dict.fromkeys(OFFSET_UNITS.values()):
            periods = [p for p in ALIASES if offset_unit(p) == (unit, size)]
            named = [name for p in periods for name in ALIASES[p]]
            shifted = F.when(alias.isin(*named), shift_period(ts, periods[0], offset, month_end)).otherwise(shifted)
        return F.struct(alias.alias("alias"), shifted.alias("moment"))

    def value(token: Column) -> Column:
        unknown = F.concat(F.lit("unknown calculated date alias: "), token["alias"])
        shown = F.raise_error(unknown).cast("string")
        for period, pair in ALIASES.items():
            printed = format_period(token["moment"], period, week_start)
            shown = F.when(token["alias"].isin(*pair), printed).otherwise(shown)
        return shown

    values = F.transform(F.zip_with(aliases, offsets, moved), value)
    pieces = F.split(text, TOKEN_PATTERN, -1)
    rendered = F.zip_with(pieces, values, lambda piece, v: F.concat(piece, F.coalesce(v, F.lit(""))))
    return F.when(F.size(aliases) == 0, text).otherwise(F.array_join(rendered, ""))


def render_literals(
    spark: SparkSession,
    texts: list[str],
    as_of,
    week_start: int = 1,
    month_end: str = "roll_forward",
) -> list[str]:
    """Replace the expressions in driver-side texts (parameters, output names).

    All tokens are evaluated by the same column code as tables are, in one constant query.
    """
    tokens = sorted({m.group(0) for text in texts for m in re.finditer(TOKEN_PATTERN, text)})
    if not tokens:
        return list(texts)
    moment = moment_literal(as_of)
    row = spark.sql("VALUES (1)").select(
        *[calculated_date(moment, t, week_start, month_end).alias(f"v{i}") for i, t in enumerate(tokens)]
    ).first()
    known = dict(zip(tokens, row))
    return [re.sub(TOKEN_PATTERN, lambda m: known[m.group(0)], text) for text in texts]


def barrier_literal(spark: SparkSession, expression: str, as_of, month_end: str = "roll_forward"):
    """A barrier as a driver-side datetime."""
    moment = moment_literal(as_of)
    return spark.sql("VALUES (1)").select(barrier(moment, expression, month_end).alias("b")).first().b
