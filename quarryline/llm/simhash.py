"""SimHash near-dedup by BK-trees over fingerprints.

Fingerprints of whole texts are computed in tasks. Equal fingerprints become one node, so groups of copies cost
one node each. Two fingerprints that differ in at most ``radius`` bits agree in at least one of ``radius + 1``
blocks of bits; each block value is a shard. A task builds the BK-tree of its shard (children keyed by the
integer distance to the parent), and a search follows only child edges within ``radius`` of the distance to the
parent. Shards larger than ``SHARD_ROWS`` are cut into tiles: every pair of tiles is a task of its own, which
searches the tree of one tile with the fingerprints of the other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarryline.llm.common import DisjointSets, connected_components, pinned, prepare, sorted_runs

SEED = 42
WORDS = 3
RADIUS = 3
BITS = 64
# Fingerprints in one tree; larger shards are tiled.
SHARD_ROWS = 2048
# Shingles hashed before their bits are counted; bounds the memory of a task on very long texts.
HASH_CHUNK = 65_536

_SHIFTS = np.arange(BITS, dtype=np.uint64)


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Unsigned fingerprint of a text; zero without words.

    A-Z are lower-cased, words are runs of anything but ASCII white space, a text with fewer words than a shingle
    is one shingle. A bit is set when more than half of the shingle hashes (repeats included) have it.
    """
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    count = max(1, len(parts) - words + 1)
    joined = b" ".join(parts)
    starts, at = [], 0
    for part in parts:
        starts.append(at)
        at += len(part) + 1
    ends = [start - 1 for start in starts[min(words, len(parts)):]] + [len(joined)]
    set_bits = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for low in range(0, count, HASH_CHUNK):
        high = min(low + HASH_CHUNK, count)
        hashes = np.fromiter(
            (digest(joined[s:e], SEED) for s, e in zip(starts[low:high], ends[low:high])), np.uint64, high - low
        )
        # Little-endian bytes unpacked little-end first: column i is bit i.
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    return int((1 << _SHIFTS)[set_bits * 2 > count].sum(dtype=np.uint64)) if (set_bits * 2 > count).any() else 0


class BKTree:
    """Tree over distinct fingerprints; children are keyed by their distance to the parent."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> int:
        """Insert a value and return its position; an equal value is not inserted twice."""
        if not self.values:
            self.values.append(value)
            self.children.append({})
            return 0
        at = 0
        while True:
            distance = (value ^ self.values[at]).bit_count()
            if distance == 0:
                return at
            below = self.children[at].get(distance)
            if below is None:
                self.values.append(value)
                self.children.append({})
                self.children[at][distance] = len(self.values) - 1
                return len(self.values) - 1
            at = below

    def within(self, value: int, radius: int) -> list[int]:
        """Positions of all values within the radius."""
        if not self.values:
            return []
        found, todo = [], [0]
        values, children = self.values, self.children
        while todo:
            at = todo.pop()
            distance = (value ^ values[at]).bit_count()
            if distance <= radius:
                found.append(at)
            low, high = distance - radius, distance + radius
            todo += [below for key, below in children[at].items() if low <= key <= high]
        return found


def tree_links(left: list[int], right: list[int] | None, radius: int) -> list[tuple[int, int]]:
    """Links that connect what lies within the radius: inside ``left``, or between ``left`` and ``right``.

    Only links that join two sets found so far are returned, so there are fewer links than fingerprints, and
    what they connect is exactly what all links would connect.
    """
    tree, links = BKTree(), []
    if right is None:
        sets = DisjointSets(len(left))
        for value in left:
            near = tree.within(value, radius)
            at = tree.add(value)
            for other in near:
                if sets.union(at, other):
                    links.append((value, tree.values[other]))
        return links
    for value in left:
        tree.add(value)
    sets = DisjointSets(len(left) + len(right))
    for offset, value in enumerate(right):
        for other in tree.within(value, radius):
            if sets.union(len(left) + offset, other):
                links.append((value, tree.values[other]))
    return links


def _fingerprints(words: int):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            values = [fingerprint(text, words) for text in texts]
            yield pd.Series(np.array(values, dtype=np.uint64).view(np.int64))

    return F.pandas_udf(run, T.LongType())


def with_fingerprint(documents: DataFrame, text: str = "text", name: str = "fingerprint", words: int = WORDS) -> DataFrame:
    """The rows with the signed 64-bit fingerprint of a text column."""
    prepare(documents.sparkSession)
    return documents.withColumn(name, _fingerprints(words)(F.col(text)))


SHARD = ["block", "code", "tile_a", "tile_b"]


def _shard_links(radius: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for links in links_of(sorted_runs(batches, SHARD, ["value", "tile"])):
            yield pd.DataFrame(np.array(links, dtype=np.uint64).reshape(-1, 2).view(np.int64), columns=["a", "b"])

    def links_of(shards: Iterator[tuple[tuple, dict]]) -> Iterator[list[tuple[int, int]]]:
        held: list[tuple[int, int]] = []
        for (_, _, tile_a, tile_b), rows in shards:
            values = rows["value"].view(np.uint64)
            if tile_a == tile_b:
                held += tree_links(np.sort(values).tolist(), None, radius)
            else:
                own = rows["tile"] == tile_a
                held += tree_links(np.sort(values[own]).tolist(), np.sort(values[~own]).tolist(), radius)
            if len(held) >= HASH_CHUNK:
                yield held
                held = []
        yield held

    return run


def tiled(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Distinct rows (block, code, value) of shards with two or more, once for every pair of tiles they belong to."""
    # A shard with one fingerprint has no links, and shards beyond the limit are tiled.
    sizes = rows.groupBy("block", "code").agg(F.count("*").alias("n")).where("n > 1")
    tiles = F.ceil(F.col("n") / F.lit(shard_rows)).cast("int")
    rows = rows.join(sizes, ["block", "code"]).withColumn("tiles", tiles)
    rows = rows.withColumn("tile", F.pmod(F.xxhash64("value"), F.col("tiles")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    rows = rows.select("block", "code", "value", "tile", other.alias("other"))
    return rows.select(
        "block", "code", F.least("tile", "other").alias("tile_a"), F.greatest("tile", "other").alias("tile_b"), "value", "tile"
    )


def links_in_tiles(rows: DataFrame, run, schema: str) -> DataFrame:
    """Links found by ``run`` in the sorted shards of tiled rows."""
    # Most shards are tiny, so a task goes through its shards in sorted order instead of starting anew for each.
    return rows.repartition(*SHARD).sortWithinPartitions(*SHARD).mapInPandas(run, schema)


def near_links(nodes: DataFrame, value: str = "fingerprint", radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Links (a, b) between distinct fingerprints; they connect all that differ in ``radius`` bits or fewer."""
    prepare(nodes.sparkSession)
    blocks = radius + 1
    width = BITS // blocks
    codes = []
    for block in range(blocks):
        size = width if block < blocks - 1 else BITS - width * (blocks - 1)
        part = F.shiftrightunsigned(F.col(value), block * width)
        mask = (1 << size) - 1 if size < BITS else -1
        codes.append(F.struct(F.lit(block).alias("block"), part.bitwiseAND(F.lit(mask)).alias("code")))
    rows = nodes.select(F.col(value).alias("value"), F.explode(F.array(*codes)).alias("s")).select("value", "s.*")
    return links_in_tiles(tiled(rows, shard_rows), _shard_links(radius), "a long, b long")


def simhash_components(documents: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """Fingerprint and component of every row.

    Returns ``key``, ``fingerprint`` (16 lowercase hex digits) and ``component_id``: the smallest key of all rows
    whose fingerprints are reachable by steps of at most ``radius`` bits, the row's own included. Null texts count
    as texts without words (fingerprint zero). Null keys are kept and pass as larger than any other; a component
    of null keys only has a null component. Repeated rows are kept. An empty table gives no rows. Further
    columns of the input are not looked at.
    """
    source = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    rows = pinned(with_fingerprint(source, "text", "value", words).select("key", "value"), "fingerprints")
    nodes = rows.groupBy("value").agg(F.min("key").alias("least"))
    roots = connected_components(near_links(nodes, "value", radius))
    joined = nodes.join(roots, nodes["value"] == roots["node"], "left")
    joined = joined.select("value", "least", F.coalesce("root", "value").alias("root"))
    smallest = joined.groupBy("root").agg(F.min("least").alias("component"))
    labels = joined.join(smallest, "root").select("value", "component")
    digits = F.lower(F.lpad(F.hex("value"), 16, "0"))
    return rows.join(labels, "value").select(
        F.col("key").alias(key), digits.alias("fingerprint"), F.col("component").alias("component_id")
    )


def one_of_each(documents: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows without near copies: one row of each component stays, the one with the smallest key.

    Rows that share this key too are settled by their other columns, so exactly one row stays. Columns are as
    in the input.
    """
    spark = documents.sparkSession
    prepare(spark)
    columns = documents.columns
    marked = with_fingerprint(documents.select(F.struct(*columns).alias("row")).select("row", F.col(f"row.`{text}`").alias("text")), "text", "value", words)
    ids = pinned(marked.select(F.col(f"row.`{key}`").alias("key"), "value", F.xxhash64("row").alias("digest")), "fingerprints")
    nodes = ids.groupBy("value").agg(F.min(F.struct(F.col("key").isNull().alias("last"), "key", "digest")).alias("best"))
    return first_of_each(documents, nodes, connected_components(near_links(nodes, "value", radius)), key)


def first_of_each(documents: DataFrame, nodes: DataFrame, roots: DataFrame, key: str) -> DataFrame:
    """One row of every component: ``nodes`` has a value and its ``best`` (last, key, digest), ``roots`` joins values."""
    columns = documents.columns
    joined = nodes.join(roots, nodes["value"] == roots["node"], "left")
    keep = joined.groupBy(F.coalesce("root", "value").alias("root")).agg(F.min("best").alias("best"))
    keep = keep.select(F.col("best.key").alias("key"), F.col("best.digest").alias("digest"))
    source = documents.select(F.struct(*columns).alias("row"))
    source = source.select("row", F.col(f"row.`{key}`").alias("key"), F.xxhash64("row").alias("digest"))
    picked = source.join(keep, source["key"].eqNullSafe(keep["key"]) & (source["digest"] == keep["digest"]), "left_semi")
    # Rows equal in every column have one digest; of these one stays.
    return picked.dropDuplicates(["key", "digest"]).select("row.*")
