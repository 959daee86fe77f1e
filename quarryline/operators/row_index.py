"""A contiguous row index in a given order, without ever sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarryline.functions.dates import quoted
from quarryline.operators.skew import MAX_GROUP_ROWS, same_keys, split_hot_groups
from quarryline.runtime import scratch_path, shuffle_width

# Layout of monotonically_increasing_id(): partition number above, row number below this bit.
_ROW_BITS = 33

# Rows per task when a global order is cut into chunks.
CHUNK_ROWS = 1_000_000


def _ordered_table(df: DataFrame, order_by: list[str], partitions: int | None) -> DataFrame:
    """Range-partition and sort the rows, note each row's place, and write the result down.

    The written table pins the places: a task that is run again, or an executor that is lost,
    cannot move rows to other partitions between the two passes that follow.
    """
    spark = df.sparkSession
    keys = [quoted(name) for name in order_by]
    ranged = df.repartitionByRange(partitions or shuffle_width(df), *keys)
    placed = ranged.sortWithinPartitions(*keys).withColumn("__place", F.monotonically_increasing_id())
    path = scratch_path(spark, "ordered")
    placed.write.parquet(path)
    return spark.read.schema(placed.schema).parquet(path)


def add_row_index(
    df: DataFrame,
    order_by: list[str],
    name: str = "row_idx",
    partitions: int | None = None,
    partition_by: list[str] | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add the 0-based position of each row in the order of ``order_by``.

    One range shuffle; the second pass reads one column and counts rows per partition. The only
    broadcast holds one offset per shuffle partition. ``order_by`` must be a total order. With
    ``partition_by`` the index restarts for every group: by a window for groups that fit a task,
    from a global index for hot ones, so that a group of any size stays spread over partitions.
    """
    if partition_by:
        return _index_by_group(df, order_by, name, partitions, partition_by, max_group_rows, chunk_rows)
    placed = _ordered_table(df, order_by, partitions)
    part = F.shiftrightunsigned(F.col("__place"), _ROW_BITS)
    row = F.col("__place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    counts = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    offsets, seen = [], 0
    for part_number, n in sorted((r.part, r.n) for r in counts):
        offsets.append((part_number, seen))
        seen += n
    starts = df.sparkSession.createDataFrame(offsets, "__part long, __start long")
    indexed = placed.withColumn("__part", part).join(F.broadcast(starts), "__part")
    return indexed.withColumn(name, F.col("__start") + row).select(*[quoted(c) for c in df.columns], name)


def _index_by_group(
    df: DataFrame,
    order_by: list[str],
    name: str,
    partitions: int | None,
    partition_by: list[str],
    max_group_rows: int,
    chunk_rows: int,
) -> DataFrame:
    """A window for ordinary groups, the global index for hot ones."""
    split = split_hot_groups(df, partition_by, max_group_rows)
    window = Window.partitionBy(*[quoted(c) for c in partition_by]).orderBy(*[quoted(c) for c in order_by])
    ordinary = (split.rest if split else df).withColumn(name, F.row_number().over(window).cast("long") - 1)
    if split is None:
        return ordinary
    # A group is a run of the global index. Its start is joined by group and chunk of the run, so
    # the rows of a hot group meet it in many tasks.
    indexed = add_row_index(split.hot, [*partition_by, *order_by], "__idx", partitions)
    indexed = indexed.withColumn("__chunk", F.expr(f"__idx div {chunk_rows}"))
    starts = (
        indexed.groupBy(*[quoted(c).alias(f"__k{i}") for i, c in enumerate(partition_by)])
        .agg(F.min("__idx").alias("__first"), F.min("__chunk").alias("low"), F.max("__chunk").alias("high"))
        .withColumn("__start_chunk", F.explode(F.sequence("low", "high")))
        .drop("low", "high")
    )
    joined = indexed.join(starts, same_keys(partition_by, "__k") & (F.col("__chunk") == F.col("__start_chunk")))
    hot = joined.withColumn(name, F.col("__idx") - F.col("__first")).select(*[quoted(c) for c in df.columns], name)
    return ordinary.unionByName(hot)
