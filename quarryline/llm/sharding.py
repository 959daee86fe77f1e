"""Sharding by extendible hashing, in DataFrame functions only.

A row's address is a string of bits from the hash of its key. The directory maps address prefixes to shards: a
bucket within the byte limit is a shard, and only a larger one splits on the next bit. Bytes are summed by prefix
once for all depths, to a depth that ordinary buckets never need; buckets still too large there, as of a key with
very many rows, go on alone in further rounds. The last bits of an address are dealt to rows at random, once, so
that the rows of one key split too.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarryline.llm.common import pinned

SHARD_BYTES = 1 << 20
KEY_BITS = 36
# A key may fill 2 ** 26 shards of its own, which is 64 TiB at the default limit.
SALT_BITS = 26
BITS = KEY_BITS + SALT_BITS
# Bits that a round looks beyond the depth that even buckets need.
SPARE_BITS = 4
ROUND_BITS = 8


def key_address(key: Column) -> Column:
    """The first bits of the MD5 of a key as text; null counts as empty text."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, KEY_BITS // 4)
    return F.conv(digits, 16, 10).cast("long")


def _fits(size: str, rows: str, depth: Column, limit: int) -> Column:
    return (F.col(size) <= limit) | (F.col(rows) <= 1) | (depth >= BITS)


def assign(documents: DataFrame, key: str = "doc_id", text: str = "text", limit: int = SHARD_BYTES) -> DataFrame:
    """Shard of every row: ``key``, ``shard`` (prefix bits), ``depth``, ``shard_bytes``, ``shard_rows``.

    A row weighs the UTF-8 bytes of its text, null texts nothing. No shard weighs more than ``limit``, except shards
    of one row that does so alone (and rows that agree in all address bits, one in 2 ** 26 of a key). One shard with
    an empty prefix holds all when they fit. Null keys count as one key; repeated rows are rows. An empty table
    gives no rows. Other columns are not looked at.
    """
    return _placed(documents, F.col(key), key, text, limit).select(
        F.col("carried").alias(key), "shard", "depth", F.col("bytes").alias("shard_bytes"), F.col("rows").alias("shard_rows")
    )


def _placed(documents: DataFrame, carried: Column, key: str, text: str, limit: int) -> DataFrame:
    """Shard, depth, bytes and rows of the shard next to what is carried of every row."""
    weight = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << SALT_BITS))
    address = key_address(F.col(key)) * (1 << SALT_BITS) + salt
    # Written once: whatever is run again later finds the same salts.
    rows = pinned(documents.select(carried.alias("carried"), weight.alias("bytes"), address.alias("address")), "addresses")
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    low, high = 0, min(BITS, max(0, math.ceil(math.log2(max(1.0, total / limit)))) + SPARE_BITS)
    done, first = [], True
    while True:
        cells = rows.groupBy(F.shiftright("address", BITS - high).alias("cell")).agg(
            F.sum("bytes").alias("bytes"), F.count("*").alias("rows")
        )
        cells = pinned(cells, "cells")
        depths = F.sequence(F.lit(low if first else low + 1), F.lit(high))
        nodes = cells.select("*", F.explode(depths).alias("depth")).withColumn(
            "prefix", F.expr(f"shiftright(cell, {high} - depth)")
        )
        nodes = nodes.groupBy("depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
        # The two halves of a bucket.
        halves = Window.partitionBy("depth", F.shiftright("prefix", 1))
        nodes = nodes.withColumns({"up_bytes": F.sum("bytes").over(halves), "up_rows": F.sum("rows").over(halves)})
        fits = _fits("bytes", "rows", F.col("depth"), limit)
        splits = (F.col("depth") == 0) | ~_fits("up_bytes", "up_rows", F.col("depth") - 1, limit)
        shards = pinned(nodes.where(fits & splits).select("depth", "prefix", "bytes", "rows"), "shards")
        span = shards.agg(F.min("depth"), F.max("depth")).first()
        if span[0] is not None:
            covered = cells.select("cell", F.explode(F.sequence(F.lit(span[0]), F.lit(span[1]))).alias("depth"))
            covered = covered.withColumn("prefix", F.expr(f"shiftright(cell, {high} - depth)"))
            directory = covered.join(shards, ["depth", "prefix"])
            placed = rows.withColumn("cell", F.shiftright("address", BITS - high)).drop("bytes").join(directory, "cell")
            done.append(placed.select("carried", "depth", "prefix", "bytes", "rows"))
        over = cells.where(~_fits("bytes", "rows", F.lit(high), limit)).select("cell")
        if over.isEmpty():
            break
        rows = pinned(rows.join(over, F.shiftright("address", BITS - high) == F.col("cell"), "left_semi"), "addresses")
        low, high, first = high, min(BITS, high + ROUND_BITS), False
    if not done:
        done = [rows.select("carried", F.lit(0).alias("depth"), F.lit(0).cast("long").alias("prefix"), "bytes", F.lit(0).cast("long").alias("rows"))]
    return reduce(DataFrame.unionByName, done).select(
        "carried",
        F.lpad(F.bin("prefix"), F.col("depth"), F.lit("0")).alias("shard"),
        F.col("depth").cast("int").alias("depth"),
        "bytes",
        "rows",
    )


def write_shards(documents: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = SHARD_BYTES) -> None:
    """Write the rows as Parquet, one folder a shard; null and repeated keys are rows like any other."""
    # Whole rows go through the address table, so nothing is joined by key.
    row = F.struct(*[F.col(f"`{name}`") for name in documents.columns])
    placed = _placed(documents, row, key, text, limit).select("carried.*", F.concat(F.lit("s"), "shard").alias("shard"))
    placed.repartition("shard").write.partitionBy("shard").parquet(path)
