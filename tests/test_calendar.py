"""Calculated dates: pinned values, a sweep against the ISO calendar, and expressions in text."""

import math
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quarryline.functions import calendar

# Reference moment, expression, first weekday, expected text.
PINNED = [
    ("2020-01-31", "CY", 1, "2020"),
    ("2020-01-31", "CurrentYear_-1", 1, "2019"),
    ("2020-01-31", "CYCS_1", 1, "2020H2"),
    ("2020-01-31", "CYCS_-1", 1, "2019H2"),
    ("2020-01-31", "CYCM_-13", 1, "201812"),
    ("2020-05-03", "CYCW_-1", 7, "202018"),
    ("2020-05-03", "CYCW_-70", 7, "201901"),
    ("2020-01-31 19:00:00", "CYCMCDCH_-3", 1, "20200131160000000000"),
    ("2020-06-28 19:00:00", "CYCSCW", 7, "2020H2wk27"),
    ("2019-12-30", "CYCW", 1, "202001"),
    ("2019-12-30", "CYCS", 1, "2019H1"),
    ("2019-12-30", "CYCQ", 1, "2019Q1"),
    ("2020-12-31", "CYCS", 1, "2020H3"),
    ("2020-12-31", "CYCSCW", 1, "2020H3wk53"),
    ("2021-01-01", "CYCS", 1, "2021H3"),
    ("2021-01-01", "CYCQ", 1, "2021Q1"),
    ("2021-01-01", "CYCQCW", 1, "2020Q1wk53"),
    ("2022-01-01", "CYCS", 1, "2022H2"),
    ("2022-01-01", "CYCW", 1, "202152"),
    ("2020-01-31", "CYCM_1", 1, "202003"),
    ("2020-11-30", "CYCFP", 1, "2020011"),
    ("2020-11-30", "CFP", 1, "011"),
    ("2020-12-15", "FiscalPeriod", 1, "012"),
    ("2020-01-05", "CW", 3, "01"),
]


@pytest.mark.parametrize("moment,expression,week_start,expected", PINNED)
def test_pinned(spark, moment, expression, week_start, expected):
    column = calendar.calculated_date(
        F.lit(moment).cast("timestamp_ntz"), f"CalculatedDate_{expression}", week_start
    )
    assert spark.sql("VALUES (1)").select(column.alias("v")).first().v == expected


def _expected(day: date, period: str, week_start: int) -> str:
    shown = day + timedelta(days=1) if week_start == 7 else day
    iso_year, week, _ = shown.isocalendar()
    half, quarter = f"H{math.ceil(week / 26)}", f"Q{min(week, (day.month + 2) // 3)}"
    return {
        "year": f"{day:%Y}", "semester": f"{day:%Y}{half}", "semester_week": f"{iso_year}{half}wk{week:02}",
        "just_semester": half, "quarter": f"{day:%Y}{quarter}", "quarter_week": f"{iso_year}{quarter}wk{week:02}",
        "just_quarter": quarter, "fiscal_period": f"{day:%Y0%m}", "just_fiscal_period": f"{day:0%m}",
        "month": f"{day:%Y%m}", "just_month": f"{day:%m}", "week": f"{iso_year}{week:02}", "just_week": f"{week:02}",
        "day": f"{day:%Y%m%d}", "just_day": f"{day:%d}", "hour": f"{day:%Y%m%d}000000000000",
    }[period]


@pytest.mark.parametrize("week_start", [1, 7])
def test_sweep_of_sixteen_years(spark, week_start):
    days = spark.sql("SELECT explode(sequence(DATE '2015-01-01', DATE '2030-12-31')) AS d")
    printed = days.select("d", *[calendar.format_period("d", p, week_start).alias(p) for p in calendar.ALIASES])
    seen = printed.collect()
    assert len(seen) == 5844
    for row in seen:
        for period in calendar.ALIASES:
            assert row[period] == _expected(row.d, period, week_start)


@pytest.mark.parametrize(
    "moment,months,rolled,clamped",
    [
        ("2020-01-31", 1, "2020-03-01", "2020-02-29"),
        ("2019-01-29", 1, "2019-03-01", "2019-02-28"),
        ("2020-03-31", -1, "2020-03-01", "2020-02-29"),
        ("2020-02-29", 12, "2021-03-01", "2021-02-28"),
        ("2020-05-15", -5, "2019-12-15", "2019-12-15"),
    ],
)
def test_month_end(spark, moment, months, rolled, clamped):
    ts = F.lit(f"{moment} 10:11:12").cast("timestamp_ntz")
    row = spark.sql("VALUES (1)").select(
        calendar.add_months_exact(ts, months).cast("string").alias("r"),
        calendar.add_months_exact(ts, months, "clamp").cast("string").alias("c"),
    ).first()
    assert (row.r, row.c) == (f"{rolled} 10:11:12", f"{clamped} 10:11:12")


def test_bad_expressions():
    for bad in ("CalculatedDate_XYZ", "CalculatedDate_CY_x", "Something", "CalculatedDate_CYCM_123"):
        with pytest.raises(ValueError):
            calendar.CalculatedDate.parse(bad)
    with pytest.raises(ValueError):
        calendar.add_months_exact(F.col("x"), 1, "other")


def test_aliases_are_complete(spark):
    assert len(calendar.PERIOD_OF_ALIAS) == 32
    assert calendar.alias_table(spark).count() == 32


AS_OF = datetime(2020, 1, 31, 19, 0, 0)


def test_literals(spark):
    texts = [
        "report_CalculatedDate_CYCM_-1.csv",
        "CalculatedDate_CY/CalculatedDate_CYCM/CalculatedDate_CYCM_-12/x",
        "offset CalculatedDate_CYCM_123 keeps a digit",
        "CalculatedDate_CYCM_final",
        "nothing",
    ]
    assert calendar.render_literals(spark, texts, AS_OF) == [
        "report_201912.csv", "2020/202001/201901/x", "offset 2021013 keeps a digit", "202001_final", "nothing",
    ]
    with pytest.raises(ValueError):
        calendar.render_literals(spark, ["CalculatedDate_Nope"], AS_OF)


def test_text_column_equals_literals(spark):
    texts = [
        "a_CalculatedDate_CYCM_-1_CalculatedDate_CYCM_-12", "CalculatedDate_CY", "CalculatedDate_CYCW_-70 x",
        "CalculatedDate_CurrentYearCurrentQuarterCurrentWeek", "no token", "", "CalculatedDate_CYCMCDCH_-3.",
    ]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    column = calendar.render_text("t", F.lit(str(AS_OF)).cast("timestamp_ntz"), 7)
    seen = [r.v for r in frame.select("i", column.alias("v")).orderBy("i").collect()]
    assert seen == calendar.render_literals(spark, texts, AS_OF, 7)


def test_barriers(spark):
    expected = {
        "CY": datetime(2020, 1, 1), "CYCM_-1": datetime(2019, 12, 1), "CYCFP_1": datetime(2020, 3, 1),
        "CYCMCD_-1": datetime(2020, 1, 30), "CYCMCDCH_-48": datetime(2020, 1, 29, 19),
    }
    for expression, moment in expected.items():
        assert calendar.barrier_literal(spark, f"CalculatedDate_{expression}", AS_OF) == moment
    for unordered in ("CYCW", "CM", "CYCQ"):
        with pytest.raises(ValueError):
            calendar.barrier_literal(spark, f"CalculatedDate_{unordered}", AS_OF)
