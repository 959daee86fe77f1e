"""Telling groups too big for one task from all others."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.functions.dates import quoted

# Groups with more rows than this are not handed to a single task.
MAX_GROUP_ROWS = 5_000_000


def same_keys(keys: list[str], prefix: str) -> Column:
    """Null-safe equality of key columns with columns named ``<prefix><number>``."""
    return reduce(and_, [quoted(k).eqNullSafe(F.col(f"{prefix}{i}")) for i, k in enumerate(keys)])


@dataclass(frozen=True)
class HotSplit:
    """Rows of hot groups, the rows of all other groups, and the hot keys (``__hot0``, ...)."""

    hot: DataFrame
    rest: DataFrame
    keys: DataFrame


def split_hot_groups(df: DataFrame, keys: list[str], max_rows: int = MAX_GROUP_ROWS) -> HotSplit | None:
    """Split off the groups with more than ``max_rows`` rows; nothing when there are none.

    Groups are counted per task before anything is shuffled. There can be at most
    ``rows / max_rows`` hot groups, which bounds what is collected and broadcast here.
    """
    sizes = df.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias("__n"))
    names = [quoted(k).alias(f"__hot{i}") for i, k in enumerate(keys)]
    big = sizes.where(F.col("__n") > max_rows).select(*names)
    found = big.collect()
    if not found:
        return None
    hot_keys = df.sparkSession.createDataFrame(found, big.schema)
    same = same_keys(keys, "__hot")
    return HotSplit(
        hot=df.join(F.broadcast(hot_keys), same, "left_semi"),
        rest=df.join(F.broadcast(hot_keys), same, "left_anti"),
        keys=hot_keys,
    )
