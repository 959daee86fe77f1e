"""Calculated dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarryline.functions import calendar
from quarryline.functions.calendar import ALIASES
from quarryline.operators.columns import inherit
from quarryline.workload.registry import query, register, table

STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"
STAMP_SQL = "%Y-%m-%d %H:%M:%S.%f"


def period_sql(x: str, period: str, week_start: int = 1) -> str:
    """DuckDB text for a period; ``x`` is a timestamp expression."""
    w = f"({x} + INTERVAL 1 DAY)" if week_start == 7 else f"({x})"
    week = f"week({w})"
    week_text = f"lpad(CAST({week} AS VARCHAR), 2, '0')"
    iso_year = f"CAST(isoyear({w}) AS VARCHAR)"
    year = f"strftime({x}, '%Y')"
    half = f"'H' || CAST(CAST(ceil({week} / 26.0) AS INTEGER) AS VARCHAR)"
    quarter = f"'Q' || CAST(least({week}, quarter({x})) AS VARCHAR)"
    return {
        "year": year,
        "semester": f"{year} || {half}",
        "semester_week": f"{iso_year} || {half} || 'wk' || {week_text}",
        "just_semester": half,
        "quarter": f"{year} || {quarter}",
        "quarter_week": f"{iso_year} || {quarter} || 'wk' || {week_text}",
        "just_quarter": quarter,
        "fiscal_period": f"strftime({x}, '%Y0%m')",
        "just_fiscal_period": f"strftime({x}, '0%m')",
        "month": f"strftime({x}, '%Y%m')",
        "just_month": f"strftime({x}, '%m')",
        "week": f"{iso_year} || {week_text}",
        "just_week": week_text,
        "day": f"strftime({x}, '%Y%m%d')",
        "just_day": f"strftime({x}, '%d')",
        "hour": f"strftime({x}, '%Y%m%d%H%M%S%f')",
    }[period]


def moved_sql(x: str, unit: str, steps: int) -> str:
    """DuckDB text for an offset; months roll over to the next month when the day is missing."""
    if unit != "months":
        return f"({x} + INTERVAL ({steps}) {'DAY' if unit == 'days' else 'HOUR'})"
    moved = f"({x} + INTERVAL ({steps}) MONTH)"
    rolled = f"date_trunc('month', {moved}) + INTERVAL 1 MONTH + ({x} - date_trunc('day', {x}))"
    return f"(CASE WHEN day({moved}) < day({x}) THEN {rolled} ELSE {moved} END)"


def _register_period(name: str, period: str, week_start: int) -> None:
    short, long = ALIASES[period]
    unit, size = calendar.offset_unit(period)

    def run(spark, sf_dir):
        return table(spark, sf_dir, "events").select(
            "event_id",
            calendar.calculated_date("ts", f"CalculatedDate_{short}", week_start).alias("value"),
            calendar.calculated_date("ts", f"CalculatedDate_{long}_-13", week_start).alias("back_13"),
        )

    back = moved_sql("ts", unit, -13 * size)
    register(
        name,
        run,
        f"SELECT event_id, {period_sql('ts', period, week_start)} AS value, "
        f"{period_sql(back, period, week_start)} AS back_13 FROM events",
    )


def _register_period_on_orders(name: str, period: str, week_start: int) -> None:
    short, _ = ALIASES[period]

    def run(spark, sf_dir):
        return table(spark, sf_dir, "orders").select(
            "o_orderkey",
            calendar.calculated_date("o_orderdate", f"CalculatedDate_{short}", week_start).alias("value"),
        )

    sql = f"SELECT o_orderkey, {period_sql('o_orderdate', period, week_start)} AS value FROM orders"
    register(name, run, sql)


WEEK_PERIODS = (
    "semester", "semester_week", "just_semester", "quarter", "quarter_week", "just_quarter", "week", "just_week",
)

for _number, _period in enumerate(ALIASES, start=1):
    if _period == "hour":
        _register_period(f"D{_number}_{_period}", _period, 1)
    else:
        _register_period_on_orders(f"D{_number}_{_period}", _period, 1)
    if _period in WEEK_PERIODS:
        _register_period_on_orders(f"D{_number}_{_period}_sunday_start", _period, 7)

_OFFSET_CASES = {
    "D17a_offset_year": ("year", (1, -1, 4)),
    "D17b_offset_semester": ("semester", (1, -1, 3)),
    "D17c_offset_semester_week": ("semester_week", (1, -70)),
    "D17d_offset_quarter": ("quarter", (1, -1, 5)),
    "D17e_offset_quarter_week": ("quarter_week", (2, -53)),
    "D17f_offset_fiscal_period": ("fiscal_period", (1, -1, 13)),
    "D17g_offset_month": ("month", (1, -1, -13)),
    "D17h_offset_week": ("week", (1, -70)),
    "D17i_offset_day": ("day", (33, -33)),
    "D17j_offset_hour": ("hour", (5, -3)),
}


def _label(offset: int) -> str:
    return f"plus_{offset}" if offset >= 0 else f"minus_{-offset}"


def _register_offset(name: str, period: str, offsets: tuple[int, ...]) -> None:
    source, key, ts = ("events", "event_id", "ts") if period == "hour" else ("orders", "o_orderkey", "o_orderdate")
    unit, size = calendar.offset_unit(period)

    def run(spark, sf_dir):
        return table(spark, sf_dir, source).select(
            key,
            *[F.date_format(calendar.shift_period(ts, period, n), STAMP).alias(_label(n)) for n in offsets],
        )

    columns = ", ".join(
        f"strftime({moved_sql(ts, unit, n * size)}, '{STAMP_SQL}') AS {_label(n)}" for n in offsets
    )
    register(name, run, f"SELECT {key}, {columns} FROM {source}")


for _name, (_period, _offsets) in _OFFSET_CASES.items():
    _register_offset(_name, _period, _offsets)


@query(
    "D17_offset_clamped",
    f"""SELECT o_orderkey, strftime(o_orderdate + INTERVAL 1 MONTH, '{STAMP_SQL}') AS clamped,
        {period_sql("(o_orderdate + INTERVAL 6 MONTH)", "semester")} AS semester FROM orders""",
)
def offset_clamped(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_format(calendar.shift_period("o_orderdate", "month", 1, "clamp"), STAMP).alias("clamped"),
        calendar.calculated_date("o_orderdate", "CalculatedDate_CYCS_1", month_end="clamp").alias("semester"),
    )


@query(
    "D17_offset_then_print",
    "SELECT o_orderkey, "
    + ", ".join(
        f"{period_sql(moved_sql('o_orderdate', u, s), p)} AS {p}"
        for p, u, s in (
            ("semester", "months", -6), ("just_semester", "months", 6), ("quarter", "months", 3),
            ("just_quarter", "months", -3), ("week", "days", -490), ("quarter_week", "days", 7),
            ("month", "months", 1), ("just_fiscal_period", "months", -1),
        )
    )
    + " FROM orders",
)
def offset_then_print(spark, sf_dir):
    wanted = {
        "semester": "CYCS_-1", "just_semester": "CS_1", "quarter": "CYCQ_1", "just_quarter": "CQ_-1",
        "week": "CYCW_-70", "quarter_week": "CYCQCW_1", "month": "CYCM_1", "just_fiscal_period": "CFP_-1",
    }
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        *[calendar.calculated_date("o_orderdate", f"CalculatedDate_{e}").alias(n) for n, e in wanted.items()],
    )


@query(
    "D18_iso_week",
    """SELECT o_orderkey, CAST(isoyear(o_orderdate) AS VARCHAR) AS year_monday,
        lpad(CAST(week(o_orderdate) AS VARCHAR), 2, '0') AS week_monday,
        CAST(isoyear(o_orderdate + INTERVAL 1 DAY) AS VARCHAR) AS year_sunday,
        lpad(CAST(week(o_orderdate + INTERVAL 1 DAY) AS VARCHAR), 2, '0') AS week_sunday FROM orders""",
)
def iso_week(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        calendar.iso_week_year("o_orderdate").alias("year_monday"),
        calendar.iso_week("o_orderdate").alias("week_monday"),
        calendar.iso_week_year("o_orderdate", 7).alias("year_sunday"),
        calendar.iso_week("o_orderdate", 7).alias("week_sunday"),
    )


@query(
    "D19_week_start_default_and_inheritance",
    """SELECT o_orderkey, week_start,
        CAST(isoyear(o_orderdate + to_days(CASE WHEN week_start = 7 THEN 1 ELSE 0 END)) AS VARCHAR) ||
        lpad(CAST(week(o_orderdate + to_days(CASE WHEN week_start = 7 THEN 1 ELSE 0 END)) AS VARCHAR), 2, '0') AS week
        FROM (SELECT *, CASE o_orderstatus WHEN 'F' THEN 7 WHEN 'O' THEN 7 ELSE 1 END AS week_start FROM orders)""",
)
def week_start_inheritance(spark, sf_dir):
    own = F.when(F.col("o_orderstatus") == "F", "inherit-from-parent").when(
        F.col("o_orderstatus") == "O", "inherit-from-grand-parent"
    )
    week_start = inherit(own, F.lit("7"), F.lit("7"), F.lit("1")).cast("int")
    return (
        table(spark, sf_dir, "orders")
        .withColumn("week_start", week_start)
        .select(
            "o_orderkey", "week_start",
            calendar.format_period("o_orderdate", "week", F.col("week_start")).alias("week"),
        )
    )


_PRIORITY_ALIASES = {
    "1-URGENT": "CYCM", "2-HIGH": "CurrentWeek", "3-MEDIUM": "CYCFP", "4-NOT SPECIFIED": "FiscalPeriod",
}


def _priority_alias():
    alias = F.lit("CYCMCDCH")
    for priority, name in _PRIORITY_ALIASES.items():
        alias = F.when(F.col("o_orderpriority") == priority, name).otherwise(alias)
    return alias


_PRIORITY_ALIAS_SQL = (
    "CASE o_orderpriority "
    + " ".join(f"WHEN '{p}' THEN '{a}'" for p, a in _PRIORITY_ALIASES.items())
    + " ELSE 'CYCMCDCH' END"
)


@query(
    "D20_alias_table",
    f"""SELECT alias, period, offset_unit, offset_size, count(*) AS n
        FROM (SELECT {_PRIORITY_ALIAS_SQL} AS alias FROM orders) JOIN (VALUES {", ".join(
            "('{}', '{}', '{}', {})".format(a, p, *calendar.offset_unit(p))
            for a, p in calendar.PERIOD_OF_ALIAS.items()
        )}) AS t(alias, period, offset_unit, offset_size) USING (alias) GROUP BY ALL""",
)
def alias_table(spark, sf_dir):
    counted = table(spark, sf_dir, "orders").groupBy(_priority_alias().alias("alias")).count()
    return counted.join(F.broadcast(calendar.alias_table(spark)), "alias").select(
        "alias", "period", "offset_unit", "offset_size", F.col("count").alias("n")
    )


@query(
    "D20_alias_map",
    f"""SELECT o_orderkey, CASE {_PRIORITY_ALIAS_SQL} WHEN 'CYCM' THEN 'month' WHEN 'CurrentWeek' THEN 'just_week'
        WHEN 'CYCFP' THEN 'fiscal_period' WHEN 'FiscalPeriod' THEN 'just_fiscal_period' ELSE 'hour' END AS period
        FROM orders""",
)
def alias_map(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.element_at(calendar.alias_map(), _priority_alias()).alias("period")
    )


_MONTH_BACK = moved_sql("o_orderdate", "months", -1)


@query(
    "D21_expressions_in_text",
    f"""SELECT o_orderkey, CASE o_orderstatus
        WHEN 'F' THEN 'report_' || strftime({_MONTH_BACK}, '%Y%m') || '_' || CAST(o_orderkey AS VARCHAR) || '.csv'
        WHEN 'O' THEN strftime(o_orderdate, '%Y') || '/' || {period_sql('o_orderdate', 'week')} || '/all.csv'
        ELSE 'plain_' || o_orderstatus END AS name FROM orders""",
)
def expressions_in_text(spark, sf_dir):
    text = (
        F.when(
            F.col("o_orderstatus") == "F",
            F.concat(F.lit("report_CalculatedDate_CYCM_-1_"), F.col("o_orderkey").cast("string"), F.lit(".csv")),
        )
        .when(F.col("o_orderstatus") == "O", "CalculatedDate_CY/CalculatedDate_CYCW/all.csv")
        .otherwise(F.concat(F.lit("plain_"), F.col("o_orderstatus")))
    )
    return (
        table(spark, sf_dir, "orders")
        .withColumn("text", text)
        .select("o_orderkey", calendar.render_text("text", "o_orderdate").alias("name"))
    )


@query(
    "D22_barriers",
    f"""SELECT event_id, strftime(date_trunc('year', ts), '{STAMP_SQL}') AS year,
        strftime(date_trunc('month', {moved_sql('ts', 'months', -1)}), '{STAMP_SQL}') AS month,
        strftime(date_trunc('month', ts), '{STAMP_SQL}') AS fiscal_period,
        strftime(date_trunc('day', ts - INTERVAL 7 DAY), '{STAMP_SQL}') AS day,
        strftime(ts - INTERVAL 48 HOUR, '{STAMP_SQL}') AS hour FROM events""",
)
def barriers(spark, sf_dir):
    wanted = {
        "year": "CY", "month": "CYCM_-1", "fiscal_period": "CYCFP", "day": "CYCMCD_-7", "hour": "CYCMCDCH_-48",
    }
    return table(spark, sf_dir, "events").select(
        "event_id",
        *[
            F.date_format(calendar.barrier("ts", f"CalculatedDate_{e}"), STAMP).alias(n)
            for n, e in wanted.items()
        ],
    )
