"""Best-fit packing under conflicts.

Texts are cut into pieces of at most one bin. Pieces are dealt evenly, by hash, to parts of bounded size, and a task
packs a part: largest piece first, into the bin with the least room that takes it. Bins are kept in order of the
room left, and each carries bitmaps of the sources and duplicate clusters in it; the search starts at the first bin
with enough room and goes on to its successors until one is compatible, which is then the tightest such bin.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.llm.common import pinned, prepare, shares

CAPACITY = 8192
PART_PIECES = 4096


def pack(pieces: list[tuple[int, int | None, int | None]], capacity: int) -> list[int]:
    """Bin of each piece (size, source, cluster); pieces come largest first.

    Sources and clusters are small numbers or nothing. Two pieces of one source, or of one cluster, never share a
    bin. Among bins with equal room the one opened first is taken.
    """
    rooms: list[tuple[int, int]] = []  # (room left, bin), sorted
    sources: list[int] = []
    clusters: list[int] = []
    placed = []
    for size, source, cluster in pieces:
        source_bit = 0 if source is None else 1 << source
        cluster_bit = 0 if cluster is None else 1 << cluster
        at = bisect_left(rooms, (size, -1))
        while at < len(rooms):
            target = rooms[at][1]
            if not (sources[target] & source_bit or clusters[target] & cluster_bit):
                break
            at += 1
        if at < len(rooms):
            room, target = rooms.pop(at)
        else:
            room, target = capacity, len(sources)
            sources.append(0)
            clusters.append(0)
        sources[target] |= source_bit
        clusters[target] |= cluster_bit
        # A full bin stays: pieces of size zero still fit.
        insort(rooms, (room - size, target))
        placed.append(target)
    return placed


def _numbers(values: pd.Series) -> list[int | None]:
    codes, _ = pd.factorize(values)
    return [None if code < 0 else int(code) for code in codes]


def _pack_part(capacity: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "key", "piece", "digest"], ascending=[False, True, True, True], ignore_index=True)
        pieces = list(zip(rows["size"].tolist(), _numbers(rows["source"]), _numbers(rows["cluster"])))
        bins = pack(pieces, capacity)
        rows["bin_id"] = [(int(key[0]) << 32) + b for b in bins]
        return rows[["key", "piece", "start", "size", "source", "cluster", "bin_id"]]

    return run


def best_fit(
    documents: DataFrame,
    cluster: Column | None = None,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    capacity: int = CAPACITY,
    part_pieces: int = PART_PIECES,
) -> DataFrame:
    """Bins for all texts: ``key``, ``piece`` (from 0), ``start`` (from 0), ``size``, ``source``, ``cluster``, ``bin_id``.

    Sizes are code points. A text longer than ``capacity`` is cut into pieces of that size and a rest; joined in order
    they are the text again. Pieces of one source or one duplicate cluster never share a bin; ``cluster`` is a Column
    of a string, by default equal texts. Null sources and null clusters conflict with nothing. Null and empty texts
    are one piece of size zero in no cluster. Null keys and repeated rows are kept (repeats conflict as copies).
    An empty table gives no rows. Other columns are not looked at.

    Every part of about ``part_pieces`` pieces is packed by itself, so one source or cluster, however large, is
    spread over all parts; bins are the tightest compatible ones of their part.
    """
    spark = documents.sparkSession
    prepare(spark)
    digest = F.md5(F.col(text).cast("binary"))
    shown = F.when(F.length(text) > 0, digest if cluster is None else cluster.cast("string"))
    whole = documents.select(
        # As text: pandas would turn whole numbers beside nulls into floating point.
        F.col(key).cast("string").alias("key"),
        F.coalesce(F.length(text), F.lit(0)).cast("long").alias("length"),
        F.col(source).cast("string").alias("source"),
        shown.alias("cluster"),
        F.coalesce(digest, F.lit("")).alias("digest"),
    )
    last = F.greatest(F.ceil(F.col("length") / capacity) - 1, F.lit(0)).cast("int")
    pieces = whole.select("*", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    start = F.col("piece").cast("long") * capacity
    pieces = pieces.select(
        "key", "piece", start.alias("start"), F.least(F.col("length") - start, F.lit(capacity)).alias("size"), "source", "cluster", "digest"
    )
    # A row's number spreads repeated rows; it is fixed by writing it.
    pieces = pinned(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    parts = shares(pieces.count(), part_pieces)
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)).cast("long")).drop("row")
    schema = "key string, piece int, start long, size long, source string, cluster string, bin_id long"
    packed = dealt.groupBy("part").applyInPandas(_pack_part(capacity), schema)
    return packed.select(F.col("key").cast(documents.schema[key].dataType).alias(key), *packed.columns[1:])
