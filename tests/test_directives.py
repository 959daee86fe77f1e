"""Formats printed and read as Python's own do, and what is refused."""

import random
from datetime import datetime, timedelta

import pytest

from quarryline.functions import dates
from quarryline.functions.directives import Reading, pieces

PRINTED = [
    "%a %A %w %u %d %e %b %B %h %m %y %Y %H %I %k %p %M %S %f %j", "%U|%W|%V|%G|%u|%C", "%c", "%D %F %T %R %r", "%x %X", "100%% it's %Y[a]{b}#",
    "%z%Z", "plain text", "%n%t%d", "T%HZ", "",
]
READ = [
    "%Y-%m-%d %H:%M:%S.%f", "%d/%m/%Y", "%d%m%Y", "%A %Y-%m-%d", "%a, %d %b %Y %I:%M %p", "%B %d, %Y", "%c", "%D %T", "%F", "%j %Y %k",
    "%Y week %U day %w", "%Y %W %a", "%G-W%V-%u", "%e.%m.%y", "(%Y) [%m] %d? a.b*c", "%H:%M", "%y%j", "%I %p",
]


def moments(count, seed):
    rng = random.Random(seed)
    fixed = [datetime(2020, 1, 5), datetime(2019, 12, 30), datetime(2021, 1, 3, 23, 59, 59, 999999), datetime(2024, 2, 29, 12), datetime(2000, 1, 1), datetime(2015, 12, 31)]
    return fixed + [datetime(1970, 1, 1) + timedelta(seconds=rng.randrange(2_500_000_000), microseconds=rng.randrange(10**6)) for _ in range(count)]


@pytest.mark.parametrize("pattern", PRINTED)
def test_printing(spark, pattern):
    values = moments(150, 1)
    frame = spark.createDataFrame([(i, m) for i, m in enumerate([*values, None])], "i int, t timestamp_ntz")
    seen = dict(dates.datetime_to_string(frame, ["t"], pattern).collect())
    assert seen == {i: None if m is None else m.strftime(pattern) for i, m in enumerate([*values, None])}


def test_zone_of_instants(spark):
    frame = spark.sql("SELECT TIMESTAMP_LTZ '2024-03-01 00:00:00 UTC' AS t")
    assert dates.datetime_to_string(frame, ["t"], "%Y%z %Z").first()[0] == "2024+0000 UTC"


def without_zeros(text, rng):
    """A text with some leading zeros of its numbers gone."""
    return "".join("" if c == "0" and i + 1 < len(text) and text[i + 1].isdigit() and (i == 0 or text[i - 1] in "/-.: ") and rng.random() < 0.5 else c for i, c in enumerate(text))


@pytest.mark.parametrize("pattern", READ)
def test_reading_is_that_of_python(spark, pattern):
    rng = random.Random(2)
    texts = []
    for moment in moments(120, 3):
        text = moment.strftime(pattern)
        texts += [text, text.upper(), without_zeros(text, rng), text + "x", text.replace(" ", "  "), text[1:], text.replace("2", "3")]
    texts += ["", "31/2/2020", "1/2/2020", "Sunday 2020-01-05", "99", "\x01", "\x012020"]

    def truth(text):
        try:
            # Shorthands and blank-padded fields are unknown there.
            return datetime.strptime(text, "".join(pieces(pattern)).replace("%e", "%d").replace("%k", "%H"))
        except ValueError:
            return None

    frame = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "i int, t string")
    seen = dict(dates.string_to_datetime(frame, ["t"], pattern, lenient=True, check_weekday=False).collect())
    wrong = [(t, seen[i], truth(t)) for i, t in enumerate(texts) if seen[i] != truth(t)]
    assert not wrong and seen[len(texts)] is None


def test_weekdays_are_checked(spark):
    frame = spark.createDataFrame([("Sunday 2020-01-05",), ("Monday 2020-01-05",), ("Funday 2020-01-05",)], "t string")
    seen = [r[0] for r in dates.string_to_datetime(frame, ["t"], "%A %Y-%m-%d", lenient=True).collect()]
    assert seen == [datetime(2020, 1, 5), None, None]
    for bad in ("Monday 2020-01-05", "Funday 2020-01-05"):
        with pytest.raises(Exception, match="could not be parsed"):
            dates.string_to_datetime(frame.where(frame["t"] == bad), ["t"], "%A %Y-%m-%d").collect()
    assert dates.string_to_datetime(frame.where("t like 'Sun%'"), ["t"], "%A %Y-%m-%d").first()[0] == datetime(2020, 1, 5)


def test_offsets_give_utc(spark):
    frame = spark.createDataFrame([("2020-01-01 01:30:00 +0200",), ("2020-01-01 01:30:00 -05:30",), ("2020-01-01 01:30:00 Z",)], "t string")
    seen = [r[0] for r in dates.string_to_datetime(frame, ["t"], "%F %T %z").collect()]
    assert seen == [datetime(2019, 12, 31, 23, 30), datetime(2020, 1, 1, 7, 0), datetime(2020, 1, 1, 1, 30)]


def test_other_columns_stay_in_place(spark):
    frame = spark.createDataFrame([(1, "1/2/2020", "3/4/2021", "z")], "`a.b` int, `from` string, `t o` string, last string")
    read = dates.string_to_datetime(frame, ["from", "t o"], "%d/%m/%Y")
    assert read.columns == frame.columns
    assert tuple(read.first()) == (1, datetime(2020, 2, 1), datetime(2021, 4, 3), "z")


@pytest.mark.parametrize("pattern", ["%Q", "%d %e", "%Y %y", "%G %V", "%G %V %u %m", "100%"])
def test_refused_formats(pattern):
    with pytest.raises(ValueError):
        Reading(pattern)


def test_shorthands():
    assert pieces("%D") == ["%m", "/", "%d", "/", "%y"]
