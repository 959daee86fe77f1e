"""Adding, renaming, dropping, ordering and overriding columns; union of tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType

from quarryline.functions.arrays import insert_name
from quarryline.functions.dates import moment_literal, now_local, now_utc, quoted

# Words in configuration that take a property from a higher level.
FROM_PARENT = "inherit-from-parent"
FROM_GRAND_PARENT = "inherit-from-grand-parent"


def add_columns(df: DataFrame, additional_columns: list[dict], as_of=None) -> DataFrame:
    """Add one column per ``{"name", "value"}``: ``utcnow``, ``now`` or a constant.

    ``as_of`` fixes the clock: a wall time in the session time zone.
    """
    if as_of is None:
        clock = {"utcnow": now_utc(), "now": now_local()}
    else:
        local = moment_literal(as_of)
        clock = {"utcnow": F.convert_timezone(None, F.lit("UTC"), local), "now": local}

    def value(given) -> Column:
        return clock[given] if isinstance(given, str) and given in clock else F.lit(given)

    added = {column["name"]: value(column["value"]) for column in additional_columns}
    return df.withColumns(added) if added else df


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def drop_helper(df: DataFrame, column: str, removal: bool = True) -> DataFrame:
    """Drop a helper column unless removal is switched off."""
    return df.drop(quoted(column)) if removal else df


def select_fields(df: DataFrame, fields: list[str]) -> DataFrame:
    """Project a field list; ``*`` stands for everything."""
    return df.select(*["*" if f == "*" else quoted(f) for f in fields])


def insert_column(
    df: DataFrame, name: str, value: Column, position: str, reference: str | None = None
) -> DataFrame:
    """Add a column at a place: first, last, before or after another one."""
    order = insert_name(df.columns, name, position, reference)
    return df.select(*[value.alias(c) if c == name else quoted(c) for c in order])


def column_index(columns: list[str], name: str) -> int:
    """Zero-based place of a name: the last one when repeated, 0 when absent."""
    return max((i for i, c in enumerate(columns) if c == name), default=0)


def inherit(own: Column, parent: Column, grand_parent: Column, default: Column | None = None) -> Column:
    """Hierarchical override: own value, or the parent's or grand-parent's when it says so."""
    resolved = (
        F.when(own == FROM_PARENT, parent).when(own == FROM_GRAND_PARENT, grand_parent).otherwise(own)
    )
    return resolved if default is None else F.coalesce(resolved, default)


def union_tables(tables: list[DataFrame]) -> DataFrame:
    """Bag union by column name; columns a table lacks are null.

    Numbers of different kinds are widened; other differing types become text.
    """
    types: dict[str, set[DataType]] = {}
    for table in tables:
        for field in table.schema.fields:
            types.setdefault(field.name, set()).add(field.dataType)
    as_text = {
        name
        for name, kinds in types.items()
        if len(kinds) > 1 and not all(isinstance(kind, NumericType) for kind in kinds)
    }

    def aligned(table: DataFrame) -> DataFrame:
        casts = {c: quoted(c).cast("string") for c in table.columns if c in as_text}
        return table.withColumns(casts) if casts else table

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(aligned, tables))
