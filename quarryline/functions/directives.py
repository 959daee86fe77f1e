"""Date and time directives (``%Y``, ``%d``, ...) compiled to Columns, for printing and for reading.

A format is cut into directives and plain text once, on the driver. To print, neighbouring directives that Spark has
pattern letters for become one ``date_format``; the others are computed. To read, the format becomes one regular
expression with a group per directive. It is run once per text, and the groups are folded into a timestamp.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Directives that stand for others.
SHORTHANDS = {
    "%c": "%a %b %e %H:%M:%S %Y",
    "%D": "%m/%d/%y",
    "%F": "%Y-%m-%d",
    "%h": "%b",
    "%n": "\n",
    "%R": "%H:%M",
    "%r": "%I:%M:%S %p",
    "%T": "%H:%M:%S",
    "%t": "\t",
    "%x": "%m/%d/%y",
    "%X": "%H:%M:%S",
}

# Directives and the Spark pattern letters that print the same.
PRINTED_BY_PATTERN = {
    "%Y": "yyyy",
    "%y": "yy",
    "%m": "MM",
    "%d": "dd",
    "%H": "HH",
    "%I": "hh",
    "%M": "mm",
    "%S": "ss",
    "%f": "SSSSSS",
    "%j": "DDD",
    "%A": "EEEE",
    "%a": "EEE",
    "%B": "MMMM",
    "%b": "MMM",
    "%p": "a",
    "%%": "%",
}

MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Separates the groups of a text that was read; no directive can match it.
_BETWEEN = "\x01"


def pieces(strftime_format: str) -> list[str]:
    """Directives and plain texts of a format in order, shorthands spelled out."""
    found = []
    for part in re.findall(r"%.|%$|[^%]+", strftime_format, re.DOTALL):
        found += pieces(SHORTHANDS[part]) if part in SHORTHANDS else [part]
    return found


def _refused(part: str) -> ValueError:
    return ValueError(f"format directive {part!r} is not known")


# Printing


def _two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def _week_of_year(moment: Column, first_day: int) -> Column:
    """Weeks since the first such weekday of the year (Sunday 1 to Saturday 7); 0 before it."""
    since = F.pmod(F.dayofweek(moment) - F.lit(first_day), F.lit(7))
    return F.floor((F.dayofyear(moment) + 6 - since) / 7)


def _with_zone(moment: Column, printed: Column) -> Column:
    """Nothing for wall times, which have no zone."""
    return F.when(F.typeof(moment).isin("timestamp_ntz", "date"), "").otherwise(printed)


def _computed(moment: Column) -> dict[str, Column]:
    """Directives without pattern letters."""
    return {
        "%G": F.lpad(F.extract(F.lit("YEAROFWEEK"), moment).cast("string"), 4, "0"),
        "%V": _two_digits(F.weekofyear(moment)),
        "%u": F.extract(F.lit("DAYOFWEEK_ISO"), moment).cast("string"),
        "%w": (F.dayofweek(moment) - 1).cast("string"),
        "%U": _two_digits(_week_of_year(moment, 1)),
        "%W": _two_digits(_week_of_year(moment, 2)),
        "%C": _two_digits(F.floor(F.year(moment) / 100)),
        "%e": F.lpad(F.dayofmonth(moment).cast("string"), 2, " "),
        "%k": F.lpad(F.hour(moment).cast("string"), 2, " "),
        "%z": _with_zone(moment, F.date_format(moment, "xx")),
        "%Z": _with_zone(moment, F.date_format(moment, "z")),
    }


def spark_pattern(strftime_format: str) -> str:
    """A format that pattern letters can say; plain text is quoted for Spark."""
    found = []
    for part in pieces(strftime_format):
        if part.startswith("%"):
            if part not in PRINTED_BY_PATTERN:
                raise _refused(part)
            found.append(PRINTED_BY_PATTERN[part])
        else:
            found.append(re.sub(r"[A-Za-z'\[\]#{}]+", lambda m: "'" + m.group(0).replace("'", "''") + "'", part))
    return "".join(found)


def print_datetime(moment: Column, strftime_format: str) -> Column:
    """Text of a datetime; null for null."""
    computed = _computed(moment)
    fields, plain = [], ""
    for part in [*pieces(strftime_format), None]:
        if part is not None and part not in computed:
            plain += part
            continue
        if plain:
            fields.append(F.date_format(moment, spark_pattern(plain)) if "%" in plain else F.lit(plain))
            plain = ""
        if part is not None:
            fields.append(computed[part])
    return F.when(moment.isNotNull(), F.concat(*fields) if fields else F.lit(""))


# Reading


def _numbers(low: int, high: int, blank: bool = False) -> str:
    """Expression for the numbers of a range: with leading zeros first, then ever shorter."""
    found = []
    for width in range(len(str(high)), 0, -1):
        texts = [str(i).zfill(width) for i in range(high, low - 1, -1) if len(str(i)) <= width]
        for head in dict.fromkeys(text[:-1] for text in texts):
            last = sorted(text[-1] for text in texts if text[:-1] == head)
            found.append(f"{head}[{last[0]}-{last[-1]}]")
    if blank:
        found.append(f" [{low}-9]")
    return "|".join(found)


def _names(names: list[str]) -> str:
    return "|".join(sorted(names, key=len, reverse=True))


def _expressions() -> dict[str, str]:
    """What a directive matches."""
    return {
        "%Y": r"\d{4}",
        "%G": r"\d{4}",
        "%y": r"\d{2}",
        "%m": _numbers(1, 12),
        "%B": _names(MONTHS),
        "%b": _names([m[:3] for m in MONTHS]),
        "%d": _numbers(1, 31, blank=True),
        "%e": _numbers(1, 31, blank=True),
        "%j": _numbers(1, 366),
        "%H": _numbers(0, 23),
        "%k": _numbers(0, 23, blank=True),
        "%I": _numbers(1, 12, blank=True),
        "%p": "AM|PM",
        "%M": _numbers(0, 59),
        "%S": _numbers(0, 59),
        "%f": r"\d{1,6}",
        "%A": _names(WEEKDAYS),
        "%a": _names([d[:3] for d in WEEKDAYS]),
        "%u": "[1-7]",
        "%w": "[0-6]",
        "%U": _numbers(0, 53),
        "%W": _numbers(0, 53),
        "%V": _numbers(1, 53),
        "%z": r"Z|[+-]\d{2}:?[0-5]\d(?::?[0-5]\d)?",
        "%Z": "UTC|GMT|Z",
    }


# Directives that say the same thing, of which a format has one at most.
_SLOTS = {"%y": "%Y", "%B": "%m", "%b": "%m", "%e": "%d", "%I": "%H", "%k": "%H", "%a": "%A", "%u": "%A", "%w": "%A"}


class Reading:
    """A compiled format: the regular expression, and the folds of its groups into a day and a time."""

    def __init__(self, strftime_format: str):
        expressions = _expressions()
        self.groups: dict[str, int] = {}
        text, taken = "", set()
        for part in pieces(strftime_format):
            if part in expressions:
                slot = _SLOTS.get(part, part)
                if slot in taken:
                    raise ValueError(f"format directive {part!r} repeats what another one says")
                taken.add(slot)
                text += f"({expressions[part]})"
                self.groups[part] = len(self.groups) + 1
            elif part == "%%":
                text += "%"
            elif part.startswith("%"):
                raise _refused(part)
            else:
                text += "".join(r"\s+" if piece.isspace() else re.sub(r"([^\w\s])", r"\\\1", piece) for piece in re.findall(r"\s+|\S+", part))
        weekday = taken & {"%A"}
        if "%G" in taken or "%V" in taken:
            if not ({"%G", "%V"} <= taken and weekday) or taken & {"%Y", "%m", "%d", "%j", "%U", "%W"}:
                raise ValueError("an ISO year goes with an ISO week and a weekday, and with no other date")
        self.expression = f"(?i)\\A(?:{text})\\z"

    def split(self, text: Column) -> Column:
        """Groups of a text that matches, with one entry before them; null for any other text."""
        marked = _BETWEEN + _BETWEEN.join(f"${i}" for i in self.groups.values())
        replaced = F.regexp_replace(text, self.expression, marked)
        return F.when(replaced != text, F.split(replaced, _BETWEEN))

    def has(self, *names: str) -> str | None:
        """The first of some directives that the format has."""
        return next((name for name in names if name in self.groups), None)

    def _number(self, parts: Column, name: str | None, default: int = 0) -> Column:
        return F.lit(default) if name is None else F.trim(F.get(parts, self.groups[name])).cast("int")

    def _named(self, parts: Column, name: str, names: list[str]) -> Column:
        """Place of a name (from 0) by its first three letters."""
        heads = "".join(n[:3] for n in names).lower()
        head = F.lower(F.substring(F.get(parts, self.groups[name]), 1, 3))
        return F.floor(F.instr(F.lit(heads), head) / 3).cast("int")

    def _weekday(self, parts: Column) -> Column | None:
        """Monday 0 to Sunday 6."""
        if (name := self.has("%A", "%a")) is not None:
            return self._named(parts, name, WEEKDAYS)
        if self.has("%u"):
            return self._number(parts, "%u") - 1
        return F.pmod(self._number(parts, "%w") + 6, F.lit(7)) if self.has("%w") else None

    @property
    def by_month(self) -> bool:
        return self.has("%m", "%B", "%b", "%d", "%e") is not None

    def day(self, parts: Column) -> Column:
        """Midnight of the date that the groups say; null where there is none."""
        has = self.has

        def number(name: str | None, default: int = 0) -> Column:
            return self._number(parts, name, default)

        year = number(has("%Y"), 1900)
        if has("%y"):
            year = number("%y") + F.when(number("%y") < 69, 2000).otherwise(1900)
        month = self._named(parts, has("%B", "%b"), MONTHS) + 1 if has("%B", "%b") else number(has("%m"), 1)
        of_week, week = self._weekday(parts), has("%U", "%W")

        def midnight(y: Column, m: Column, d: Column) -> Column:
            zero = F.lit(0)
            return F.try_make_timestamp_ntz(y, m, d, zero, zero, zero.cast("decimal(16,6)"))

        def later(moment: Column, days: Column) -> Column:
            return moment + F.make_dt_interval(days)

        one = F.lit(1)
        if has("%G"):
            fourth = midnight(number("%G"), one, F.lit(4))
            return later(fourth, of_week - F.weekday(fourth) + 7 * (number("%V") - 1))
        if self.by_month:
            return midnight(year, month, number(has("%d", "%e"), 1))
        if has("%j"):
            return later(midnight(year, one, one), number("%j") - 1)
        if week and of_week is not None:
            # Days of weeks that begin on Sunday (%U) or Monday (%W), counted from the first of January.
            shift = 1 if week == "%U" else 0
            first = midnight(year, one, one)
            lead, own = F.pmod(F.weekday(first) + shift, F.lit(7)), F.pmod(of_week + shift, F.lit(7))
            whole = number(week) - F.when((lead == 0) & (number(week) > 0), 1).otherwise(0)
            return later(first, own - lead + 7 * whole)
        return midnight(year, one, one)

    def moment(self, parts: Column, day: Column, check_weekday: bool) -> Column:
        """The time of the groups on a day; null where the day is not the one they name."""
        has = self.has

        def number(name: str | None, default: int = 0) -> Column:
            return self._number(parts, name, default)

        def field(name: str) -> Column:
            return F.get(parts, self.groups[name])

        of_week = self._weekday(parts)
        right = F.lit(True)
        if has("%G"):
            # Not every year has a week 53.
            right = F.extract(F.lit("YEAROFWEEK"), day) == number("%G")
        elif check_weekday and of_week is not None and (self.by_month or has("%j")):
            # A weekday can be checked only where it was not needed to find the date.
            right = F.weekday(day) == of_week
        day = F.when(right, day)
        hour = number(has("%H", "%k", "%I"))
        if has("%I"):
            late = F.upper(field("%p")) == "PM" if has("%p") else F.lit(False)
            hour = F.pmod(hour, F.lit(12)) + F.when(late, 12).otherwise(0)
        second = number(has("%S")).cast("decimal(16,6)")
        if has("%f"):
            second = second + (F.rpad(field("%f"), 6, "0").cast("decimal(16,6)") / 1_000_000).cast("decimal(16,6)")
        moment = day + F.make_dt_interval(F.lit(0), hour, number(has("%M")), second.cast("decimal(18,6)"))
        if has("%z"):
            digits = F.rpad(F.regexp_replace(field("%z"), "[^0-9]", ""), 6, "0")
            away = F.make_dt_interval(
                F.lit(0),
                F.substring(digits, 1, 2).cast("int"),
                F.substring(digits, 3, 2).cast("int"),
                F.substring(digits, 5, 2).cast("decimal(18,6)"),
            )
            moment = F.when(field("%z").startswith("-"), moment + away).otherwise(moment - away)
        return moment


def read_datetimes(
    df: DataFrame, columns: list[Column], names: list[str], strftime_format: str, lenient: bool = False, check_weekday: bool = True
) -> DataFrame:
    """Columns ``names`` with the wall times that texts say.

    Fields may have one digit or two, names match in any case, missing fields are those of 1900-01-01, blanks match any
    white space. With ``%z`` the result is the wall time in UTC. A text that does not match, a date that does not exist and (unless
    told otherwise) a weekday that is not that of the date fail the query, or give null when ``lenient``.
    """
    reading = Reading(strftime_format)
    kept = df.columns
    own = {name: f"__{i} {name}" for i, name in enumerate(names)}
    # The groups are a column of their own, so that the expression runs once a text.
    df = df.withColumns({f"{own[n]} text": c for n, c in zip(names, columns)})
    df = df.withColumns({f"{own[n]} parts": reading.split(F.col(f"`{own[n]} text`")) for n in names})
    # So are the day and the time, as each is looked at more than once.
    df = df.withColumns({f"{own[n]} day": reading.day(F.col(f"`{own[n]} parts`")) for n in names})
    df = df.withColumns(
        {f"{own[n]} moment": reading.moment(F.col(f"`{own[n]} parts`"), F.col(f"`{own[n]} day`"), check_weekday) for n in names}
    )
    done = {}
    for name in names:
        text, moment = (F.col(f"`{own[name]} {kind}`") for kind in ("text", "moment"))
        if not lenient:
            message = F.concat(F.lit("text could not be parsed by the format "), F.lit(strftime_format), F.lit(": "), text)
            moment = F.when(text.isNotNull() & moment.isNull(), F.raise_error(message).cast("timestamp_ntz")).otherwise(moment)
        done[name] = moment
    df = df.withColumns(done)
    wanted = [*kept, *(name for name in names if name not in kept)]
    return df.select(*(F.col("`" + name.replace("`", "``") + "`") for name in wanted))
