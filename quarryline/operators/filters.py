"""Filters and file-age verdicts."""

from __future__ import annotations

import math
import re
import struct
from collections.abc import Mapping
from datetime import date, datetime
from decimal import Decimal, InvalidOperation, localcontext

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, StringType, StructField, StructType

from quarryline.functions.dates import age_verdict, moment_literal, quoted
from quarryline.operators.row_index import add_row_index
from quarryline.operators.validation import resolvable

# Longer value lists are joined instead of being spelled out in the plan.
IN_LIST_LIMIT = 1_000

# Stands between the values of a long list in one literal.
VALUES_APART = "\x1f"

# A band this wide or narrower is read as two top-k queries around the reference row.
TOP_K_LIMIT = 1_000

# Buckets of one pass over a leading key, and rows that are few enough to be put in order at once.
BUCKETS = 1_000
FEW_ROWS = 10_000

# Names of doubles that are no numbers, and of truth values.
NOT_FINITE = {"nan": "NaN", "inf": "Infinity", "infinity": "Infinity", "-inf": "-Infinity", "-infinity": "-Infinity"}
TRUE = ("true", "t", "yes", "y")
FALSE = ("false", "f", "no", "n")

INTEGRAL = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}


def _type_of(df: DataFrame, column: str) -> DataType:
    return df.select(quoted(column)).schema[0].dataType


def _typed(kind: DataType, value) -> Column:
    """A value in the type of the column it is compared with; null when the text is no such value."""
    if isinstance(value, (date, datetime)):
        value = value.isoformat()
    return F.lit(value).try_cast(kind)


def _number(value) -> Decimal | None:
    try:
        number = Decimal(int(value) if isinstance(value, bool) else str(value).strip())
    except InvalidOperation:
        return None
    return number if number.is_finite() else None


def _moment(value) -> datetime | None:
    """Time of a date, a datetime or an ISO text, whose month and day may have one digit."""
    if isinstance(value, datetime):
        return value
    text = value.isoformat() if isinstance(value, date) else str(value).strip()
    text = re.sub(r"^(\d{4})-(\d{1,2})-(\d{1,2})(?!\d)", lambda m: "-".join(part.zfill(2) for part in m.groups()), text)
    try:
        return datetime.fromisoformat(text)
    except ValueError:
        return None


def _as_integral(kind: DataType, value) -> str | None:
    number, bound = _number(value), 1 << (INTEGRAL[kind.simpleString()] - 1)
    if number is None or number != number.to_integral_value() or not -bound <= number < bound:
        return None
    return str(int(number))


def _as_decimal(kind: DecimalType, value) -> str | None:
    number = _number(value)
    if number is None:
        return None
    with localcontext() as exact:
        exact.prec = 100
        scaled = number.scaleb(kind.scale)
        fits = scaled == scaled.to_integral_value() and abs(scaled) < 10**kind.precision
    return format(number, "f") if fits else None


def _as_floating(kind: DataType, value) -> str | None:
    """A number that a double (or float) holds as it is written; the shortest text of a fraction names it too."""
    if isinstance(value, str) and value.strip().lower() in NOT_FINITE or isinstance(value, float) and not math.isfinite(value):
        return NOT_FINITE[str(value).strip().lower()]
    number = _number(value)
    if number is None:
        return None
    held = float(number)
    if kind.simpleString() == "float":
        try:
            held = struct.unpack("f", struct.pack("f", held))[0]
        except OverflowError:
            return None
    if not math.isfinite(held):
        return None
    # 0.1 is meant as the nearest double, but a whole number must be that number.
    whole = number == number.to_integral_value()
    if whole and Decimal(held) != number:
        return None
    return repr(held) if whole or kind.simpleString() == "double" else str(number)


def _as_boolean(kind: DataType, value) -> str | None:
    number, text = _number(value), str(value).strip().lower()
    if number is not None:
        return {0: "false", 1: "true"}.get(number)
    return "true" if text in TRUE else "false" if text in FALSE else None


def _as_date(kind: DataType, value) -> str | None:
    moment = _moment(value)
    if moment is None or moment != moment.replace(hour=0, minute=0, second=0, microsecond=0) or moment.tzinfo is not None:
        return None
    return moment.date().isoformat()


def _as_moment(kind: DataType, value) -> str | None:
    if isinstance(value, (bool, int, float, Decimal)):
        return None
    moment = _moment(value)
    # A wall time has no zone that could be compared.
    return None if moment is None or (moment.tzinfo is not None and kind.simpleString() == "timestamp_ntz") else moment.isoformat()


def _printed_number(value: float | Decimal) -> str:
    """A number as Spark prints it in a text."""
    number = Decimal(repr(value)) if isinstance(value, float) else value
    if isinstance(value, Decimal) or not number or Decimal("1e-3") <= abs(number) < Decimal("1e7"):
        text = format(number, "f")
        return text if "." in text or isinstance(value, Decimal) else text + ".0"
    sign, digits, exponent = number.as_tuple()
    rest = "".join(map(str, digits[1:])).rstrip("0") or "0"
    return f"{'-' * sign}{digits[0]}.{rest}E{exponent + len(digits) - 1}"


def _exact_text(kind: DataType, value) -> str | None:
    """A value as a text that casts to exactly this value in a column's type; nothing when the type cannot hold it."""
    name = kind.simpleString()
    if name in INTEGRAL:
        return _as_integral(kind, value)
    if isinstance(kind, DecimalType):
        return _as_decimal(kind, value)
    if name in ("double", "float"):
        return _as_floating(kind, value)
    if name == "boolean":
        return _as_boolean(kind, value)
    if name == "date":
        return _as_date(kind, value)
    if name in ("timestamp", "timestamp_ntz"):
        return _as_moment(kind, value)
    if isinstance(value, (date, datetime)):
        return value.isoformat()
    # Texts of numbers and booleans are those that Spark prints.
    if isinstance(value, float) and not math.isfinite(value):
        return NOT_FINITE[str(value)]
    if isinstance(value, (float, Decimal)):
        return _printed_number(value)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).decode("utf-8")
    return str(value).lower() if isinstance(value, bool) else str(value)


def _exact(kind: DataType, value) -> Column | None:
    """The literal of a value that a column can hold."""
    text = _exact_text(kind, value)
    return None if text is None else F.lit(text).try_cast(kind)


def filter_equal(df: DataFrame, column: str, value) -> DataFrame:
    """Rows with this value; none when the column's type cannot hold it."""
    literal = None if value is None else _exact(_type_of(df, column), value)
    if literal is None:
        return df.where(F.lit(False))
    return df.where(quoted(column) == literal)


def filter_different(df: DataFrame, column: str, value) -> DataFrame:
    """Rows with another value; rows without a value are kept, and all when the column's type cannot hold it."""
    if value is None:
        return df.where(quoted(column).isNotNull())
    literal = _exact(_type_of(df, column), value)
    if literal is None:
        return df
    return df.where(~(quoted(column).eqNullSafe(literal) & literal.isNotNull()))


def filter_multiple_match(df: DataFrame, column: str, values) -> DataFrame:
    """Rows whose value is in a set (the values of a mapping, or a list), however long.

    Values that the column's type cannot hold, and missing ones, match nothing.
    """
    values = list(values.values()) if isinstance(values, Mapping) else list(values)
    kind = _type_of(df, column)
    texts = list(dict.fromkeys(t for v in values if v is not None and (t := _exact_text(kind, v)) is not None))
    if len(texts) <= IN_LIST_LIMIT:
        return df.where(quoted(column).isin(*[F.lit(text).try_cast(kind) for text in texts]))
    # One literal for all values, however many, and one row each.
    rows = df.sparkSession.range(1).select(F.explode(F.split(F.lit(VALUES_APART.join(texts)), VALUES_APART)).alias(column))
    if any(VALUES_APART in text for text in texts):
        rows = df.sparkSession.createDataFrame([(text,) for text in texts], StructType([StructField(column, StringType())]))
    return resolvable(df, rows.select(quoted(column).try_cast(kind).alias(column)), [column])


def apply_filter(df: DataFrame, column_to_filter: str, filter_to_apply: str, filter_values) -> DataFrame:
    """Dispatch on the filter type used in configuration."""
    filters = {
        "equal": filter_equal,
        "different": filter_different,
        "multiple_match": filter_multiple_match,
    }
    if filter_to_apply not in filters:
        raise ValueError(f"filter type must be one of {sorted(filters)}, not {filter_to_apply!r}")
    return filters[filter_to_apply](df, column_to_filter, filter_values)


def filter_expression(df: DataFrame, expression: str) -> DataFrame:
    """Rows for which a SQL predicate given as text holds."""
    return df.where(F.expr(expression))


def _sort_key(order_by: list[str]) -> Column:
    return F.struct(*[quoted(name).alias(f"k{i}") for i, name in enumerate(order_by)])


def _compare(df: DataFrame, order_by: list[str], reference, beyond: str) -> Column:
    """Column-wise comparison with a reference position, so that it reaches the scan; nulls come first.

    The first conjunct bounds the leading column alone: parquet can skip row groups with it.
    """
    after = beyond == "at or after"
    result = F.lit(after)
    for name, value in reversed(list(zip(order_by, reference))):
        column = quoted(name)
        if value is None:
            step, same = (column.isNotNull() if after else F.lit(False)), column.isNull()
        else:
            literal = _typed(_type_of(df, name), value)
            step, same = (column > literal if after else column.isNull() | (column < literal)), column == literal
        result = step | (same & result)
    lead, value = quoted(order_by[0]), reference[0]
    if value is None:
        bound = F.lit(True) if after else lead.isNull()
    else:
        literal = _typed(_type_of(df, order_by[0]), value)
        bound = lead >= literal if after else lead.isNull() | (lead <= literal)
    return bound & result


def filter_band(
    df: DataFrame,
    expression: str,
    order_by: list[str],
    lower: int | None = None,
    upper: int | None = None,
) -> DataFrame:
    """Rows at most ``lower`` before and ``upper`` after the first row matching an expression.

    ``order_by`` must be a total order, in which nulls come first. A missing side is unbounded; when
    nothing matches, all rows come back. The reference position is one row on the driver. Bounded
    sides are top-k queries, so no global index is built. The ends of bands wider than ``TOP_K_LIMIT`` are found by
    rank, see ``_kth``, which leaves a plain filter; only where the leading key is no number or time they
    go through an index.
    """
    if lower is None and upper is None:
        return df
    matching = df.where(F.expr(expression))
    position = matching.agg(F.min(_sort_key(order_by)).alias("ref")).first().ref
    if position is None:
        return df
    if max(lower or 0, upper or 0) > TOP_K_LIMIT:
        try:
            return _band_by_rank(df, tuple(position), order_by, lower, upper)
        except _NoHistogram:
            return _band_by_index(df, tuple(position), order_by, lower, upper)
    after = df.where(_compare(df, order_by, position, "at or after"))
    before = df.where(_compare(df, order_by, position, "before"))
    if upper is not None:
        after = after.orderBy(*[quoted(c).asc() for c in order_by]).limit(upper + 1)
    if lower is not None:
        before = before.orderBy(*[quoted(c).desc() for c in order_by]).limit(lower)
    return before.unionByName(after)


class _NoHistogram(Exception):
    """The leading key cannot be put on a scale."""


def _on_scale(df: DataFrame, name: str) -> Column:
    """A key as a double that never falls while the key rises; different keys may share one."""
    kind = _type_of(df, name)
    text = kind.simpleString()
    if isinstance(kind, DecimalType) or text in INTEGRAL or text in ("double", "float"):
        return quoted(name).cast("double")
    if text == "date":
        return F.unix_date(quoted(name)).cast("double")
    if text == "timestamp":
        return F.unix_micros(quoted(name)).cast("double")
    if text == "timestamp_ntz":
        zero = F.lit("1970-01-01").cast("timestamp_ntz")
        return F.timestamp_diff("MICROSECOND", zero, quoted(name)).cast("double")
    raise _NoHistogram


def _kth(df: DataFrame, order_by: list[str], k: int, down: bool) -> tuple | None:
    """Values of the order keys of the ``k``-th row, from the first (nulls come first) or ``down`` from the last; None if there are fewer.

    Counts in buckets of the leading key, one pass each, tell which bucket holds the row, and the next pass looks into this
    bucket alone, until it holds ``FEW_ROWS`` rows at most. Rows that share the leading value go on by the next key. Nothing is
    shuffled but counts, and the driver sees ``BUCKETS`` of them.
    """
    name, rest = order_by[0], order_by[1:]
    lead, kind, scale = quoted(name), _type_of(df, name), _on_scale(df, name)
    facts = df.agg(F.count("*").alias("n"), F.count(lead).alias("m"), F.min(lead).alias("low"), F.max(lead).alias("high")).first()
    if k > facts["n"]:
        return None
    nulls = facts["n"] - facts["m"]
    if k > facts["m"] if down else k <= nulls:
        return None, *(_kth(df.where(lead.isNull()), rest, k - facts["m"] if down else k, down) if rest else ())
    k -= 0 if down else nulls
    rows, low, high = facts["m"], facts["low"], facts["high"]
    within = df.where(lead.isNotNull())
    while rows > FEW_ROWS and low != high:
        ends = df.sparkSession.range(1).select(_typed(kind, low).alias(name), _typed(kind, high).alias("__high"))
        first, last = (ends.select(value.alias(name)).select(scale).first()[0] for value in (quoted(name), F.col("__high")))
        if not math.isfinite(last - first) or first == last:
            raise _NoHistogram
        bucket = F.least(F.floor((scale - first) / (last - first) * BUCKETS), F.lit(BUCKETS - 1))
        counted = within.groupBy(bucket.alias("b")).agg(F.count("*").alias("n"), F.min(lead).alias("low"), F.max(lead).alias("high"))
        for found in sorted(counted.collect(), key=lambda r: r["b"], reverse=down):
            if k <= found["n"]:
                break
            k -= found["n"]
        rows, low, high = found["n"], found["low"], found["high"]
        within = within.where(lead.between(_typed(kind, low), _typed(kind, high)))
    if rows > FEW_ROWS and rest:
        return low, *_kth(within, rest, k, down)
    keys = [quoted(c).desc_nulls_last() if down else quoted(c).asc_nulls_first() for c in order_by]
    nearest = within.orderBy(*keys).limit(k).select(_sort_key(order_by).alias("at"))
    return tuple(nearest.agg((F.min if down else F.max)("at").alias("at")).first()["at"])


def _same(df: DataFrame, order_by: list[str], position: tuple) -> Column:
    result = F.lit(True)
    for name, value in zip(order_by, position):
        result = result & quoted(name).eqNullSafe(_typed(_type_of(df, name), value))
    return result


def _band_by_rank(df: DataFrame, position: tuple, order_by: list[str], lower, upper) -> DataFrame:
    """The band as a filter between the exact positions of its first and its last row."""
    after = df.where(_compare(df, order_by, position, "at or after"))
    before = df.where(_compare(df, order_by, position, "before"))
    if upper is not None and (end := _kth(after, order_by, upper + 1, down=False)) is not None:
        after = after.where(_compare(df, order_by, end, "before") | _same(df, order_by, end))
    if lower == 0:
        return after
    if lower is not None and (end := _kth(before, order_by, lower, down=True)) is not None:
        before = before.where(_compare(df, order_by, end, "at or after"))
    return before.unionByName(after)


def _band_by_index(df: DataFrame, position: tuple, order_by: list[str], lower, upper) -> DataFrame:
    indexed = add_row_index(df, order_by, name="__row_idx")
    at = indexed.where(_same(df, order_by, position)).agg(F.min("__row_idx").alias("i")).first().i
    if lower is not None:
        indexed = indexed.where(F.col("__row_idx") >= at - lower)
    if upper is not None:
        indexed = indexed.where(F.col("__row_idx") <= at + upper)
    return indexed.drop("__row_idx")


def add_age_verdict(df: DataFrame, moment: str, reference, name: str = "verdict") -> DataFrame:
    """Tell for every row whether a timestamp is newer, same or older than a reference."""
    reference = reference if isinstance(reference, Column) else moment_literal(reference)
    return df.withColumn(name, age_verdict(quoted(moment), reference))


def filter_by_age(df: DataFrame, moment: str, reference, verdict: str) -> DataFrame:
    """Keep the rows with one verdict; a plain comparison, so it can be pushed to the scan."""
    reference = reference if isinstance(reference, Column) else moment_literal(reference)
    conditions = {
        "newer": quoted(moment) > reference,
        "same": quoted(moment) == reference,
        "older": quoted(moment) < reference,
    }
    if verdict not in conditions:
        raise ValueError(f"verdict must be one of {sorted(conditions)}, not {verdict!r}")
    return df.where(conditions[verdict])
