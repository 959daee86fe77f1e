"""What several operators of this subpackage share: tables pinned in the shared folder, components, row numbers."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.runtime import remove_output, scratch_path, ship_package

# Rounds after which component search gives up; stars halve the longest path, so this covers any real graph.
MAX_ROUNDS = 60


def prepare(spark: SparkSession) -> None:
    """Make functions of this package usable in tasks."""
    ship_package(spark)


def pinned(df: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder and read back: lineage is cut and lost executors cost nothing."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Stage:
    """Tables of a loop in the shared folder, of which only the last is kept."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.path = spark, label, None

    def keep(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, self.label)
        df.write.parquet(path)
        if self.path is not None:
            remove_output(self.spark, self.path)
        self.path = path
        return self.spark.read.schema(df.schema).parquet(path)


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from every node that has a link.

    ``edges`` has columns ``a`` and ``b`` of one ordered type; direction, repeated links, links of a node with
    itself and null ends do not matter. Returns ``node`` and ``root``, one row per node of a link between two
    different nodes. Large-star and small-star steps alternate until nothing changes: every step is one
    combinable minimum per node and one join of the links with these minima, so a node with very many links is
    split by Spark like any skewed join, and neighbours are never gathered in one row.
    """
    spark = edges.sparkSession
    stage = Stage(spark, "components")
    ordered = edges.where("a is not null and b is not null and a != b")
    ordered = ordered.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current = stage.keep(ordered)
    before = _signature(current)
    for _ in range(MAX_ROUNDS):
        if before[0] == 0:
            break
        # Large star: larger neighbours of a node move to the smallest node around it.
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        moved = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = moved.where("a != b").distinct()
        # Small star: a node and its smaller neighbours move to the smallest of these.
        least = moved.groupBy("a").agg(F.min("b").alias("m"))
        joined = moved.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        stepped = joined.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        current = stage.keep(stepped)
        after = _signature(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def shares(total: int, size: int) -> int:
    """How many parts of a size hold a total; at least one."""
    return max(1, math.ceil(total / size))


class DisjointSets:
    """Union-find over small integers inside one task."""

    def __init__(self, size: int):
        self.parent = list(range(size))

    def find(self, item: int) -> int:
        parent = self.parent
        while parent[item] != item:
            parent[item] = parent[parent[item]]
            item = parent[item]
        return item

    def union(self, one: int, other: int) -> bool:
        """True when two sets became one."""
        one, other = self.find(one), self.find(other)
        if one == other:
            return False
        self.parent[max(one, other)] = min(one, other)
        return True


def sorted_runs(batches: Iterator, keys: list[str], values: list[str]) -> Iterator[tuple[tuple, dict]]:
    """Runs of rows with equal integer keys in sorted batches, also across batches: the key and arrays of the values."""
    held: dict[str, list] = {name: [] for name in values}
    current = None
    for batch in batches:
        if not len(batch):
            continue
        columns = {name: batch[name].to_numpy() for name in keys + values}
        changes = np.zeros(len(batch), dtype=bool)
        changes[0] = True
        for name in keys:
            changes[1:] |= columns[name][1:] != columns[name][:-1]
        starts = np.flatnonzero(changes).tolist()
        for start, end in zip(starts, [*starts[1:], len(batch)]):
            key = tuple(int(columns[name][start]) for name in keys)
            if current is not None and key != current:
                yield current, {name: np.concatenate(parts) for name, parts in held.items()}
                held = {name: [] for name in values}
            current = key
            for name in values:
                held[name].append(columns[name][start:end])
    if current is not None:
        yield current, {name: np.concatenate(parts) for name, parts in held.items()}
