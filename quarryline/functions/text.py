"""String columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the shape of an acceptable web address (matched from the start of the text).
URL_PATTERN = r"(?U)^https?://(?:www)?(?:[\w-]{2,255}(?:\.\w{2,66}){1,2})"


# The characters that count as blank, as a pattern and one by one.
BLANK = r"(?U)[\s\x1c-\x1f]"
BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def single_line(text: Column | str) -> Column:
    """Fold a multi-line text into one line with single spaces."""
    flat = F.replace(F.replace(_column(text), F.lit("\n"), F.lit(" ")), F.lit("\r"), F.lit(" "))
    folded = F.replace(F.regexp_replace(flat, BLANK + "{2,100}", " "), F.lit(" , "), F.lit(", "))
    return F.btrim(folded, F.lit(BLANKS))


def pad_zeros(text: Column | str, digits: int) -> Column:
    """Left-pad with zeros; longer texts stay whole."""
    text = _column(text)
    return F.when(F.length(text) < digits, F.lpad(text, digits, "0")).otherwise(text)


def is_url(text: Column | str) -> Column:
    return _column(text).rlike(URL_PATTERN)


def plain_number_text(value: Column | str) -> Column:
    """Text of a value; a floating-point number without a fraction is printed without ``.0``.

    Such numbers are printed in plain digits from 0.0001 on and below 10^16, beyond with an exponent; NaN is missing.
    Texts stay as they are.
    """
    value = _column(value)
    text = value.cast("string")
    size = F.abs(text.try_cast("double"))
    digits = F.regexp_replace(text.try_cast("decimal(38,18)").cast("string"), r"\.?0+$", "")
    spelled = F.when(text.contains("E") & (size >= 1e-4) & (size < 1e16), digits).otherwise(F.regexp_replace(text, r"\.0$", ""))
    return F.when(F.typeof(value).isin("double", "float"), F.when(text != "NaN", spelled)).otherwise(text)


def fill_empty(value: Column | str, replacement) -> Column:
    """Text of a value, with empties replaced."""
    return F.coalesce(plain_number_text(value), F.lit(str(replacement)))


def base_name(path: Column | str) -> Column:
    return F.element_at(F.split(_column(path), "/"), -1)


def count_placeholders(text: Column | str, placeholder: str = "%s") -> Column:
    return F.regexp_count(_column(text), F.lit(placeholder))


def enum_or_default(value: Column | str, allowed: Iterable[str], default: str) -> Column:
    """The value when it is one of the allowed ones, else the default."""
    value = _column(value)
    return F.when(value.isin(*allowed), value).otherwise(F.lit(default))


def render_list(items: Column | str, glue: str = ", ", prefix: str = "", suffix: str = "") -> Column:
    """Join an array column into one text."""
    return F.concat(F.lit(prefix), F.array_join(_column(items), glue), F.lit(suffix))


def render_dict(items: Column | str, glue: str = ", ", prefix: str = "IN (", suffix: str = ")") -> Column:
    """Join the values of a map column into one text."""
    return render_list(F.map_values(_column(items)), glue, prefix, suffix)
