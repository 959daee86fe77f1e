"""Exact top-k inner product search on a bit-sliced index.

Rows are cut into blocks. A block holds, for every attribute and every bit of the quantised attribute, one bitmap
over its rows. A query adds up these slices with bitmap arithmetic (ripple-carry adders on whole bitmaps), once for
every set bit of its weights, which gives the slices of a quantised score. Walking these from the most significant
slice down selects the rows that hold the k-th largest quantised score. What quantisation can hide is known
exactly, so all rows within that distance of the k-th are resolved by the exact integer product.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarryline.llm.common import pinned, prepare, shares
from quarryline.llm.vectors import usable

SCALE = 256
K = 5
# Bits kept of every attribute.
SLICES = 7
BLOCK_ROWS = 8192
# Queries broadcast at once; more queries take further passes over the index.
QUERY_CHUNK = 16_384
# Queries that share one pass over a block's bitmaps.
QUERY_GROUP = 64


def quantised(values) -> np.ndarray | None:
    """floor(256 * x) of every component, or nothing for vectors that take no part."""
    vector = usable(values)
    if vector is None:
        return None
    scaled = np.floor(vector * SCALE)
    if np.abs(scaled).max() >= 2.0**63:
        raise OverflowError("a component of a vector leaves 64 bits")
    return scaled.astype(np.int64)


class Block:
    """Bit-sliced index of some rows of one dimension."""

    def __init__(self, values: np.ndarray, slices: int = SLICES):
        """``values``: integers, one row of the table per row."""
        self.values = values
        self.rows, self.dims = values.shape
        self.base = values.min(axis=0)
        spans = values - self.base
        bits = max(int(spans.max()).bit_length(), 1)
        self.drop = max(0, bits - slices)
        self.bits = bits - self.drop
        self.span = (1 << bits) - 1
        coarse = (spans >> self.drop).astype(np.int64)
        words = -(-self.rows // 64)
        padded = np.zeros((self.dims, self.bits, words * 64), dtype=np.uint8)
        for bit in range(self.bits):
            padded[:, bit, : self.rows] = ((coarse >> bit) & 1).T
        self.slices = np.packbits(padded, axis=2, bitorder="little").view(np.uint64)
        self.valid = np.packbits(
            np.arange(words * 64) < self.rows, bitorder="little"
        ).view(np.uint64)

    def scores(self, queries: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Slices (bit, query, word) of each query's quantised score, in units of ``1 << drop``, and the error of it.

        A negative weight adds the complement of an attribute, which shifts all scores of a query alike, so
        order is kept. The exact (shifted) score lies between the quantised one and that plus the error.
        """
        weights = np.abs(queries)
        total: list[np.ndarray] = []
        full = np.uint64(0xFFFFFFFFFFFFFFFF)
        count = len(queries)
        zero = np.zeros((count, self.slices.shape[2]), dtype=np.uint64)
        top = int(weights.max()).bit_length() if weights.size else 0
        for j in range(self.dims):
            flip = np.where(queries[:, j] < 0, full, np.uint64(0))[:, None]
            addend = [self.slices[j, bit][None, :] ^ flip for bit in range(self.bits)]
            for place in range(top):
                chosen = (weights[:, j] >> place) & 1
                if not chosen.any():
                    continue
                mask = np.where(chosen == 1, full, np.uint64(0))[:, None]
                carry = zero
                for bit in range(place, place + self.bits):
                    while len(total) <= bit:
                        total.append(zero.copy())
                    add = addend[bit - place] & mask
                    half = total[bit] ^ add
                    carry_out = (total[bit] & add) | (half & carry)
                    total[bit] = half ^ carry
                    carry = carry_out
                bit = place + self.bits
                while carry.any():
                    if len(total) <= bit:
                        total.append(zero.copy())
                    total[bit], carry = total[bit] ^ carry, total[bit] & carry
                    bit += 1
        for plane in total:
            plane &= self.valid
        error = weights.sum(axis=1) * ((1 << self.drop) - 1)
        return total, error

    def candidates(self, total: list[np.ndarray], error: np.ndarray, wanted: list[int]) -> np.ndarray:
        """Bitmap per query of all rows that can be among its ``wanted`` rows of largest exact score."""
        count = len(error)
        sure = np.zeros((count, self.slices.shape[2]), dtype=np.uint64)
        open_ = np.broadcast_to(self.valid, sure.shape).copy()
        kth = [0] * count
        need = np.minimum(wanted, self.rows)
        for bit in range(len(total) - 1, -1, -1):
            upper = sure | (open_ & total[bit])
            enough = np.bitwise_count(upper).sum(axis=1) >= need
            for q in np.flatnonzero(enough):
                kth[q] |= 1 << bit
            pick = enough[:, None]
            sure, open_ = np.where(pick, sure, upper), np.where(pick, open_ & total[bit], open_ & ~total[bit])
        floor = [max(0, -(-((value << self.drop) - int(e)) >> self.drop)) for value, e in zip(kth, error)]
        # score >= floor, by the same walk
        above = np.zeros_like(sure)
        equal = np.broadcast_to(self.valid, sure.shape).copy()
        for bit in range(max([len(total), *(f.bit_length() for f in floor)]) - 1, -1, -1):
            one = np.array([(f >> bit) & 1 for f in floor], dtype=bool)[:, None]
            plane = total[bit] if bit < len(total) else np.zeros_like(sure)
            above = np.where(one, above, above | (equal & plane))
            equal = np.where(one, equal & plane, equal & ~plane)
        return above | equal


def best_of_block(block: Block, keys: np.ndarray, queries: np.ndarray, query_keys: list[int], k: int) -> list[tuple]:
    """The k best rows of a block for each query, as (query, score, key); rows with the query's own key are left out."""
    out, repeats = [], Counter(keys.tolist())
    for low in range(0, len(queries), QUERY_GROUP):
        group = queries[low : low + QUERY_GROUP]
        owners = query_keys[low : low + QUERY_GROUP]
        total, error = block.scores(group)
        marks = block.candidates(total, error, [k + repeats[own] for own in owners])
        for q, own in enumerate(owners):
            rows = np.flatnonzero(np.unpackbits(marks[q].view(np.uint8), bitorder="little"))
            rows = rows[keys[rows] != own]
            exact = block.values[rows] @ group[q]
            order = np.lexsort((keys[rows], -exact))[:k]
            out += [(own, int(exact[i]), int(keys[rows[i]])) for i in order]
    return out


def _blocks(batches: Iterator[pd.DataFrame], block_rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys and integer vectors, in blocks of one dimension each."""
    held: dict[int, tuple[list, list]] = {}
    for batch in batches:
        for key, packed in zip(batch["key"], batch["vector"]):
            keys, vectors = held.setdefault(len(packed), ([], []))
            keys.append(key)
            vectors.append(np.frombuffer(packed, dtype=np.int64))
            if len(keys) == block_rows:
                done = held.pop(len(packed))
                yield np.array(done[0]), np.stack(done[1])
    for keys, vectors in held.values():
        yield np.array(keys), np.stack(vectors)


def _exact_of_block(keys: np.ndarray, vectors: np.ndarray, queries: np.ndarray, query_keys: list[int], k: int) -> list[tuple]:
    """As ``best_of_block``, in Python's integers, for components too large for sums of 64 bits."""
    out, wide = [], vectors.astype(object)
    for own, query in zip(query_keys, queries.astype(object)):
        hits = ((score, key) for score, key in zip(wide @ query, keys.tolist()) if key != own)
        out += [(own, score, key) for score, key in heapq.nsmallest(k, hits, key=lambda x: (-x[0], x[1]))]
    return out


def _search(shared, k: int, block_rows: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked: dict[int, tuple[list, list]] = {}
        for key, packed in shared.value:
            keys, vectors = asked.setdefault(len(packed) // 8, ([], []))
            keys.append(key)
            vectors.append(np.frombuffer(packed, dtype=np.int64))
        best: dict[int, list[tuple[int, int]]] = {}
        for keys, vectors in _blocks(batches, block_rows):
            dims = vectors.shape[1]
            if dims not in asked:
                continue
            query_keys, queries = asked[dims][0], np.stack(asked[dims][1])
            largest = max(abs(int(x)) for part in (vectors, queries) for x in (part.min(), part.max()))
            if largest * largest * dims * 4 < 1 << 62:
                found = best_of_block(Block(vectors), keys, queries, query_keys, k)
            else:
                found = _exact_of_block(keys, vectors, queries, query_keys, k)
            for own, score, key in found:
                best.setdefault(own, []).append((-score, key))
            for own in {x[0] for x in found}:
                best[own] = sorted(best[own])[:k]
        rows = [(own, key, -score) for own, hits in best.items() for score, key in hits]
        yield pd.DataFrame(np.array(rows, dtype=np.int64).reshape(-1, 3), columns=["query_id", "vec_id", "score"])

    return run


def _integers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        vectors = [quantised(values) for values in batch["vector"]]
        keep = np.array([v is not None for v in vectors], dtype=bool)
        yield pd.DataFrame({"key": batch["key"][keep], "vector": [v.tobytes() for v in vectors if v is not None]})


def top_k(
    rows: DataFrame,
    is_query,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    block_rows: int = BLOCK_ROWS,
    query_chunk: int = QUERY_CHUNK,
) -> DataFrame:
    """The ``k`` rows with the largest integer inner product for every row that ``is_query`` (a Column) marks.

    Components are floor(256 x). Returns ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``; ties go to the smaller
    key, rows with the query's own key are no candidates, and a query with fewer candidates gets them all. Rows
    with a null key, and vectors that are null, empty or hold null or non-finite components take no part; vectors
    of different length do not meet. A query key that occurs several times asks with the smallest of its vectors;
    other repeated rows are candidates each. A component or score beyond 64 bits raises. An empty table, or
    one without queries, gives no rows. Other columns are not looked at.

    Queries go to the tasks in chunks of ``query_chunk``, one pass over the index each, so a broadcast has a
    fixed bound. A task keeps ``k`` hits a query over all its blocks; these are merged by query.
    """
    spark = rows.sparkSession
    prepare(spark)
    kept = rows.where(F.col(key).isNotNull())
    source = kept.select(F.col(key).cast("long").alias("key"), F.col(vector).alias("vector"), is_query.alias("asks"))
    listed = source.select("key", "vector").mapInPandas(_integers, "key long, vector binary")
    index = pinned(listed, "index")
    asking = source.where("asks").select("key", "vector").mapInPandas(_integers, "key long, vector binary")
    queries = pinned(asking.groupBy("key").agg(F.min("vector").alias("vector")), "queries")
    chunks = shares(queries.count(), query_chunk)
    parts = []
    for chunk in range(chunks):
        mine = queries.where(F.pmod(F.xxhash64("key"), F.lit(chunks)) == chunk)
        shared = spark.sparkContext.broadcast([(r["key"], bytes(r["vector"])) for r in mine.collect()])
        hits = index.mapInPandas(_search(shared, k, block_rows), "query_id long, vec_id long, score long")
        place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        parts.append(hits.withColumn("rank", place).where(F.col("rank") <= k))
    return reduce(DataFrame.unionByName, parts).select("query_id", "rank", "vec_id", "score")
