"""Near copies: texts whose sets of five-word shingles have a similarity of 0.8 or more.

Texts of similarity 0.8 differ in about 155 of 1,024 bits of a SimHash over these sets, unrelated ones in 512. So few
equal bits in a row would be a poor shard; shards are bands of min-hashes of the same sets instead, one of which such
texts share. In a shard, the BK-tree of ``simhash`` finds what lies within the radius. A fingerprint only estimates, so
what the tree finds is compared by the shingles themselves before it links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.llm.common import DisjointSets, connected_components, pinned, prepare, sorted_runs
from quarryline.llm.simhash import SHARD, SHARD_ROWS, BKTree, first_of_each, links_in_tiles, tiled

WORDS = 5
SIMILARITY = 0.8
LANES = 16  # of 64 bits
# 155 bits are expected at similarity 0.8, with a deviation of 11.5; sets of four and five shingles reach 192.
RADIUS = 230
BANDS, ROWS = 12, 4
SEED = 42
# Words hashed at once, and fingerprints whose bits a byte can count.
HASH_CHUNK = 65_536
BIT_CHUNK = 255
# Links a task holds before it hands them on.
LINK_CHUNK = 65_536

_rng = np.random.default_rng(SEED)
_MASKS, _FACTORS = _rng.integers(0, 2**63, (2, BANDS * ROWS), dtype=np.uint64)
_FACTORS |= np.uint64(1)
_LANES = _rng.integers(0, 2**63, LANES, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(values: np.ndarray) -> np.ndarray:
    """Bits of each value spread over all 64."""
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])]


def shingle_hashes(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text; A-Z are lower-cased, fewer words than a shingle are one."""
    parts = (text or "").encode("utf-8", "replace").lower().split()
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    hashed = np.fromiter((digest(part, SEED) for part in parts), np.uint64, len(parts))
    size = min(words, len(parts))
    count = len(parts) - size + 1
    chunks = []
    for low in range(0, count, HASH_CHUNK):
        high = min(low + HASH_CHUNK, count)
        rolled = np.full(high - low, size, dtype=np.uint64)
        for at in range(size):
            rolled = _mixed(rolled * _STEP + hashed[low + at : high + at])
        chunks.append(_distinct(rolled))
    return _distinct(np.concatenate(chunks)) if len(chunks) > 1 else chunks[0]


def sketch(text: str | None, words: int = WORDS) -> tuple[bytes, bytes, list[int]]:
    """Name of a text's shingle set, its fingerprint (little-endian) and its band codes; all zero without words."""
    hashes = shingle_hashes(text, words)
    if not len(hashes):
        return bytes(16), bytes(LANES * 8), [0] * BANDS
    ones = np.zeros(LANES * 64, dtype=np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for low in range(0, len(hashes), BIT_CHUNK):
        part = hashes[low : low + BIT_CHUNK, None]
        lanes = _mixed(part ^ _LANES)
        bits = np.unpackbits(lanes.view(np.uint8).reshape(len(part), -1), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint8)
        np.minimum(least, ((part ^ _MASKS) * _FACTORS).min(axis=0), out=least)
    finger = np.packbits(ones * 2 > len(hashes), bitorder="little").tobytes()
    codes = [xxhash.xxh64_intdigest(band.tobytes()) for band in least.reshape(BANDS, ROWS)]
    return xxhash.xxh3_128_digest(hashes.tobytes()), finger, np.array(codes, dtype=np.uint64).view(np.int64).tolist()


def _sketches(words: int):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([sketch(text, words) for text in texts], columns=["node", "finger", "codes"])

    return F.pandas_udf(run, "node binary, finger binary, codes array<long>")


def _shingles(words: int):
    """Shingle sets as sorted 32-bit numbers."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([np.unique(shingle_hashes(text, words) >> np.uint64(32)).astype("<u4").tobytes() for text in texts])

    return F.pandas_udf(run, "binary")


class Shard:
    """Rows of one shard: names, fingerprints and shingle sets."""

    def __init__(self, names: list[bytes], fingers: list[bytes], shingles: list[bytes]):
        self.names = names
        self.fingers = [int.from_bytes(finger, "little") for finger in fingers]
        sets = [np.frombuffer(packed, "<u4") for packed in shingles]
        self.ends = np.cumsum([0, *map(len, sets)]).tolist()
        # Shingles numbered within the shard, so that a set can be marked in a table.
        distinct, self.flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.marks = np.zeros(len(distinct), dtype=bool)

    def _set(self, row: int) -> np.ndarray:
        return self.flat[self.ends[row] : self.ends[row + 1]]

    def links(self, seeds: list[int], queries: list[int] | None, radius: int, similarity: float) -> list[tuple[bytes, bytes]]:
        """Links of similar rows: among ``seeds``, or from ``queries`` to ``seeds``; only those that join two sets.

        What these links connect is exactly what all similar pairs within the radius would connect.
        """
        tree, at, joined, found = BKTree(), {}, DisjointSets(len(self.names)), []

        def add(row: int) -> None:
            at.setdefault(tree.add(self.fingers[row]), []).append(row)

        if queries is not None:
            for row in seeds:
                add(row)
        for row in seeds if queries is None else queries:
            own, finger = self._set(row), self.fingers[row]
            near = [other for position in tree.within(finger, radius) for other in at[position]]
            # The nearest first: once joined, the others of its group need no comparison.
            near.sort(key=lambda other: (finger ^ self.fingers[other]).bit_count())
            self.marks[own] = True
            for other in near:
                if joined.find(row) == joined.find(other):
                    continue
                theirs = self._set(other)
                small, large = sorted((len(own), len(theirs)))
                if not large or small / large < similarity:
                    continue
                both = int(np.count_nonzero(self.marks[theirs]))
                if both / (small + large - both) >= similarity:
                    joined.union(row, other)
                    found.append((self.names[row], self.names[other]))
            self.marks[own] = False
            if queries is None:
                add(row)
        return found


def _links(radius: int, similarity: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[bytes, bytes]] = []
        for (_, _, tile_a, tile_b), rows in sorted_runs(batches, SHARD, ["value", "finger", "shingles", "tile"]):
            shard = Shard(rows["value"].tolist(), rows["finger"].tolist(), rows["shingles"].tolist())
            order = sorted(range(len(shard.names)), key=shard.names.__getitem__)
            if tile_a == tile_b:
                held += shard.links(order, None, radius, similarity)
            else:
                own = rows["tile"] == tile_a
                held += shard.links([i for i in order if own[i]], [i for i in order if not own[i]], radius, similarity)
            if len(held) >= LINK_CHUNK:
                yield pd.DataFrame(held, columns=["a", "b"])
                held = []
        yield pd.DataFrame(held, columns=["a", "b"])

    return run


def one_of_each(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    similarity: float = SIMILARITY,
    radius: int = RADIUS,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """The rows without near copies: of each component of links one row stays, the one with the smallest key.

    Texts link whose sets of distinct ``words``-word shingles have a Jaccard similarity of ``similarity`` or more, and
    no others. At exactly 0.8 one pair in some 500 shares no band and is missed, above 0.85 practically none. Null
    texts, and texts without words, are copies of each other. Null keys pass as larger than any other; rows that share
    the smallest key are settled by their other columns, so exactly one row stays. An empty table gives no rows.
    Columns are as in the input.
    """
    prepare(documents.sparkSession)
    rows = documents.select(F.struct(*documents.columns).alias("row"))
    rows = rows.select(F.col(f"row.`{key}`").alias("key"), F.xxhash64("row").alias("digest"), F.col(f"row.`{text}`").cast("string").alias("text"))
    ids = pinned(rows.select("key", "digest", _sketches(words)("text").alias("s")).select("key", "digest", "s.*"), "sketches")
    # Texts of equal shingle sets count once.
    best = F.min(F.struct(F.col("key").isNull().alias("last"), "key", "digest")).alias("best")
    nodes = pinned(ids.groupBy(F.col("node").alias("value")).agg(best, F.first("finger").alias("finger"), F.first("codes").alias("codes")), "nodes")
    members = pinned(tiled(nodes.select("value", F.posexplode("codes").alias("block", "code")), shard_rows), "members")
    # Whole shingle sets travel only for one row of each set that meets another in a shard.
    met = nodes.join(members.select("value").distinct(), "value")
    met = met.select("value", "finger", F.col("best.key").alias("its_key"), F.col("best.digest").alias("its_digest"))
    texts = rows.join(met, rows["key"].eqNullSafe(met["its_key"]) & (rows["digest"] == met["its_digest"]))
    texts = texts.dropDuplicates(["key", "digest"]).select("value", "finger", _shingles(words)("text").alias("shingles"))
    links = links_in_tiles(members.join(texts, "value"), _links(radius, similarity), "a binary, b binary")
    return first_of_each(documents, nodes.select("value", "best"), connected_components(links), key)
