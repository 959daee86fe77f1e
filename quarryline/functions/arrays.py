"""Array columns and positional lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POSITIONS = ("first", "last", "before", "after")


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _check(position: str, reference) -> str:
    position = position.lower()
    if position not in POSITIONS:
        raise ValueError(f"position must be one of {POSITIONS}, not {position!r}")
    if position in ("before", "after") and reference is None:
        raise ValueError(f"position {position!r} needs a reference element")
    return position


def insert_element(array: Column | str, value, position: str, reference=None) -> Column:
    """Put a value first, last, or next to the first occurrence of a reference element.

    A row whose array lacks the reference fails the query, as a missing list element would.
    """
    array, position = _column(array), _check(position, reference)
    value = value if isinstance(value, Column) else F.lit(value)
    if position == "first":
        return F.array_prepend(array, value)
    if position == "last":
        return F.array_append(array, value)
    reference = reference if isinstance(reference, Column) else F.lit(reference)
    found = F.array_position(array, reference).cast("int")
    missing = F.raise_error(F.lit("reference element is not in the list")).cast("int")
    at = F.when(found == 0, missing).otherwise(found + (1 if position == "after" else 0))
    return F.array_insert(array, at, value)


def insert_name(names: list[str], value: str, position: str, reference: str | None = None) -> list[str]:
    """The same for a list of column names, as used to order a ``select``."""
    position = _check(position, reference)
    if position == "first":
        at = 0
    elif position == "last":
        at = len(names)
    else:
        at = names.index(reference) + (position == "after")
    return [*names[:at], value, *names[at:]]


def all_true(flags: Column | str) -> Column:
    """True when no element is false or null; an empty array is true."""
    return F.forall(_column(flags), lambda flag: F.coalesce(flag, F.lit(False)))
