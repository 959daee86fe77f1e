"""Columns shifted up or down by rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarryline.functions.dates import quoted
from quarryline.functions.text import fill_empty
from quarryline.operators.row_index import CHUNK_ROWS, add_row_index
from quarryline.operators.skew import MAX_GROUP_ROWS, split_hot_groups
from quarryline.runtime import shuffle_width

def signed_offset(direction: str, deviation: int) -> int:
    """Rows to look back: positive moves values down, ``up`` looks ahead instead."""
    return -deviation if direction == "up" else deviation


def _shifted(spec: dict, window, group: str | None) -> Column:
    """One shifted column; with a ``group`` column the neighbour must belong to the same group."""
    offset = signed_offset(spec["Direction"], spec["Deviation"])

    def neighbour(column: Column) -> Column:
        return (F.lag(column, offset) if offset >= 0 else F.lead(column, -offset)).over(window)

    moved = neighbour(quoted(spec["Original Column"]))
    if group is not None:
        moved = F.when(neighbour(F.col(group)).eqNullSafe(F.col(group)), moved)
    return fill_empty(moved, spec["Empty Values Replacement"])


def _fold(df: DataFrame, specs: list[dict], window, group: str | None = None) -> DataFrame:
    for spec in specs:
        df = df.withColumn(spec["New Column"], _shifted(spec, window, group))
    return df


def add_shifted_columns(
    df: DataFrame,
    specs: list[dict],
    order_by: list[str],
    partition_by: list[str] | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Copy columns moved by rows, empties replaced, values as text.

    Each spec has ``New Column``, ``Original Column``, ``Direction`` (``up``, anything else is
    down), ``Deviation`` and ``Empty Values Replacement``; later specs may read columns made by
    earlier ones. ``partition_by`` restarts the shift for every group. Groups that
    fit a task go through one ordinary window. The rows of hot groups, and all rows without
    groups, are put in global order and cut into chunks of equal size, or joined by index when
    a shift reaches further than a chunk.
    """
    if not partition_by:
        return _shift_globally(df, specs, order_by, [], chunk_rows)
    split = split_hot_groups(df, partition_by, max_group_rows)
    window = Window.partitionBy(*[quoted(c) for c in partition_by]).orderBy(*[quoted(c) for c in order_by])
    ordinary = _fold(split.rest if split else df, specs, window)
    if split is None:
        return ordinary
    return ordinary.unionByName(_shift_globally(split.hot, specs, order_by, partition_by, chunk_rows))


def _shift_globally(
    df: DataFrame, specs: list[dict], order_by: list[str], partition_by: list[str], chunk_rows: int
) -> DataFrame:
    """Shift over a global order without ever holding all of it, or a whole group, in one task."""
    offsets = [signed_offset(s["Direction"], s["Deviation"]) for s in specs]
    back = sum(o for o in offsets if o > 0)
    ahead = sum(-o for o in offsets if o < 0)
    indexed = add_row_index(df, [*partition_by, *order_by], name="__idx")
    if max(back, ahead) > chunk_rows:
        return _shift_by_join(indexed, specs, partition_by)
    return _shift_in_chunks(indexed, specs, partition_by, chunk_rows, back, ahead, shuffle_width(df))


def _shift_in_chunks(
    indexed: DataFrame, specs: list[dict], partition_by: list[str], size: int, back: int, ahead: int, width: int
) -> DataFrame:
    """Windows of bounded size: chunk ``c`` holds the rows with index in ``[c * size, (c + 1) * size)``.

    Rows within reach of a chunk border are copied to the neighbour chunk as well, so that every
    window sees all it needs; the copies are dropped afterwards.
    """
    home = F.expr(f"__idx div {size}")
    within = F.col("__idx") - home * size
    next_chunk = F.when(within >= size - back, home + 1)
    previous_chunk = F.when((within < ahead) & (home > 0), home - 1)
    chunks = F.array_compact(F.array(home, next_chunk, previous_chunk))
    copied = indexed.withColumn("__home", home).withColumn("__chunk", F.explode(chunks))
    copied = copied.repartition(width, "__chunk")
    if partition_by:
        copied = copied.withColumn("__group", F.struct(*[quoted(c) for c in partition_by]))
    window = Window.partitionBy("__chunk").orderBy("__idx")
    shifted = _fold(copied, specs, window, "__group" if partition_by else None)
    return shifted.where(F.col("__chunk") == F.col("__home")).drop("__idx", "__home", "__chunk", "__group")


def _shift_by_join(indexed: DataFrame, specs: list[dict], partition_by: list[str]) -> DataFrame:
    """Far neighbours are met by their index, which is unique, so the join has no hot keys."""
    for spec in specs:
        offset = signed_offset(spec["Direction"], spec["Deviation"])
        keys = [quoted(c).alias(f"__k{i}") for i, c in enumerate(partition_by)]
        neighbours = indexed.select(
            (F.col("__idx") + offset).alias("__idx"), quoted(spec["Original Column"]).alias("__value"), *keys
        )
        value = F.col("__value")
        for i, name in enumerate(partition_by):
            value = F.when(F.col(f"__k{i}").eqNullSafe(quoted(name)), value)
        indexed = (
            indexed.join(neighbours, "__idx", "left")
            .withColumn(spec["New Column"], fill_empty(value, spec["Empty Values Replacement"]))
            .drop("__value", *[f"__k{i}" for i in range(len(partition_by))])
        )
    return indexed.drop("__idx")
