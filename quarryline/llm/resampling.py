"""Importance resampling towards a target corpus.

Features of a text are its runs of words, dealt to a fixed number of buckets. Counts of the buckets over all documents
and over all target texts give every bucket a gain; a document weighs the mean gain of its features, looked up in one
array. Exponential noise from a seed makes drawing the highest scores a draw without replacement.

The draw sorts in parallel by regular sampling: every task sorts its own rows and the sorted runs are written. Rows at
regular distances in the runs give regular splitters, the segments between splitters are counted, and the sums of
the counts before a segment are the rank of its first row. Only segments that begin within the draw are exchanged;
each is sorted by itself and numbered from its offset on. A row number makes all sort keys different, so neither equal scores
nor repeated keys can pile up in one segment.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.llm.common import pinned, prepare, shares
from quarryline.llm.word_bytes import fold, slices

BUCKETS = 10_000
LONGEST = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
# Rows a segment should hold, and samples for each segment. The samples (24 bytes each) go to the driver: one for
# every 16,384 rows, or ``SAMPLES`` for every shuffle partition of a small table.
SEGMENT_ROWS = 1 << 20
SAMPLES = 64

# Letters a-z and digits, and every byte of a character beyond ASCII; A-Z are lower-cased first.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
WORD = np.zeros(256, dtype=bool)
WORD[0x30:0x3A] = WORD[0x41:0x5B] = WORD[0x61:0x7B] = WORD[0x80:] = True


def _crc_table() -> np.ndarray:
    """One step of the reflected CRC-32 polynomial for every byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return table


_CRC = _crc_table()
_ONES = 0xFFFFFFFF


def _crc_step(state: np.ndarray, data: np.ndarray) -> np.ndarray:
    return _CRC[(state ^ data) & np.uint32(255)] ^ (state >> np.uint32(8))


def _crc_whole(state: int, word: bytes) -> int:
    return zlib.crc32(word, state ^ _ONES) ^ _ONES


def features(texts: pa.Array, buckets: int, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of a batch: first row, number of words of every text, and text and bucket of every feature."""
    for part in slices(texts, WORD):
        data, owner = LOWER[part.data], part.owner()
        owners, found = [], []
        state = np.full(len(owner), _ONES, dtype=np.uint32)
        for words in range(1, longest + 1):
            if words > 1:
                # Runs grow by a blank and the next word, as far as the text goes.
                state = _crc_step(state[:-1], np.uint8(0x20))
            state = fold(data, part.starts[words - 1 :], part.ends[words - 1 :], state, _crc_step, _crc_whole)
            whole = owner[: len(state)] == owner[words - 1 :]
            owners.append(owner[: len(state)][whole])
            found.append((state[whole] ^ np.uint32(_ONES)) % np.uint32(buckets))
            if len(state) < 2:
                break
        yield part.first_row, part.counts, np.concatenate(owners), np.concatenate(found).astype(np.int64)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """Features of all texts (one column) by bucket; a task sends at most one row a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, _, _, found in features(batch.column(0), buckets, longest):
                counts += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], ["bucket", "n"])

    counted = texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    total = np.zeros(buckets, dtype=np.int64)
    for row in counted.collect():
        total[row["bucket"]] = row["n"]
    return total


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the smoothed log ratio of every bucket, floored."""
    buckets, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((float(t) + 1) * (s_all + buckets) / ((float(s) + 1) * (t_all + buckets))))
            for s, t in zip(corpus.tolist(), target.tolist())
        ],
        dtype=np.int64,
    )


def noise(seed: int, key: int | None) -> int:
    """Thousandths of a Gumbel deviate from a digest of seed and key, floored; a null key is an empty text."""
    head = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((head + 0.5) / 4294967296)))


def _score(gain: np.ndarray, longest: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            size, words, weight = (np.zeros(batch.num_rows, dtype=np.int64) for _ in range(3))
            for first, counts, owner, found in features(texts, len(gain), longest):
                rows = slice(first, first + len(counts))
                n = np.bincount(owner, minlength=len(counts))
                # Sums of whole numbers far below 2 to the 53rd are exact in doubles.
                total = np.bincount(owner, weights=gain[found], minlength=len(counts)).astype(np.int64)
                size[rows], words[rows], weight[rows] = n, counts, np.where(n > 0, total // np.maximum(n, 1), 0)
            score = weight + np.fromiter((noise(seed, key) for key in keys.to_pylist()), np.int64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [keys, *(pa.array(column) for column in (size, words, weight, score))],
                ["key", "n_features", "n_words", "weight", "score"],
            )

    return run


def _sampled(step: int):
    """Every so-manieth row of the sorted runs of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            yield batch.take(pa.array(np.arange((-seen - 1) % step, batch.num_rows, step)))
            seen += batch.num_rows

    return run


def _segmented(splitters: np.ndarray):
    """Number of the segment of every row: the splitters not after it in the order of the draw."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.stack([batch.column(name).to_numpy() for name in ("falling", "place", "row")], axis=1)
            both = np.concatenate([splitters, keys])
            is_splitter = np.arange(len(both)) < len(splitters)
            order = np.lexsort((~is_splitter, both[:, 2], both[:, 1], both[:, 0]))
            segment = np.empty(len(both), dtype=np.int64)
            segment[order] = np.cumsum(is_splitter[order])
            yield batch.append_column("segment", pa.array(segment[len(splitters) :].astype(np.int32)))

    return run


def _ranked(offsets: np.ndarray):
    """Rows sorted by segment and key, numbered from the offset of their segment on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, seen = -1, 0
        for batch in batches:
            segments = batch.column("segment").to_numpy()
            ranks = np.empty(len(segments), dtype=np.int64)
            starts = np.flatnonzero(np.diff(segments, prepend=-1)).tolist()
            for start, end in zip(starts, [*starts[1:], len(segments)]):
                if segments[start] != current:
                    current, seen = segments[start], 0
                ranks[start:end] = offsets[current] + 1 + seen + np.arange(end - start)
                seen += end - start
            yield batch.append_column("rank", pa.array(ranks))

    return run


def draw(scored: DataFrame, percent: int, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """``rank`` among the rows that may be drawn (``able``) for the highest scores, null for all others.

    ``scored`` has ``key`` (long), ``score`` (long) and ``able``; the other columns go along. Equal scores go to the
    smaller key, nulls last; rows that share a key stand in any order, fixed by a written row number. ``percent`` of
    the able rows, rounded down, are drawn.
    """
    spark = scored.sparkSession
    columns = scored.columns
    order = ["falling", "place", "row"]
    rows = scored.withColumns(
        {
            "falling": -F.col("score"),
            "place": F.coalesce("key", F.lit((1 << 63) - 1)),
            "row": F.monotonically_increasing_id(),
        }
    )
    runs = pinned(rows.sortWithinPartitions(*order), "runs")
    able = runs.where("able")
    total = able.count()
    drawn = total * percent // 100
    segments = max(shares(total, segment_rows), int(spark.conf.get("spark.sql.shuffle.partitions")))
    step = max(1, total // (segments * SAMPLES))
    sampled = able.select(*order).mapInArrow(_sampled(step), "falling long, place long, row long").toPandas()
    regular = sampled.sort_values(order).to_numpy(dtype=np.int64).reshape(-1, 3)
    places = np.unique(np.arange(1, segments) * len(regular) // segments)
    splitters = regular[places[places < len(regular)]]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in runs.schema)
    dealt = pinned(able.mapInArrow(_segmented(splitters), f"{schema}, segment int"), "segments")
    sizes = np.zeros(len(splitters) + 1, dtype=np.int64)
    for row in dealt.groupBy("segment").count().collect():
        sizes[row["segment"]] = row["count"]
    offsets = np.cumsum(sizes) - sizes
    # At least one segment is exchanged, so that an empty draw has the same plan.
    reached = max(1, int(np.count_nonzero(offsets < drawn)))
    exchanged = dealt.where(F.col("segment") < reached).repartitionById(reached, F.col("segment"))
    ranked = exchanged.sortWithinPartitions("segment", *order).mapInArrow(
        _ranked(offsets), f"{schema}, segment int, rank long"
    )
    ranked = ranked.select(*columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
    undrawn = [*columns, F.lit(None).cast("long").alias("rank")]
    beyond = dealt.where(F.col("segment") >= reached).select(*undrawn)
    return ranked.unionByName(beyond).unionByName(runs.where("not able").select(*undrawn))


def resample(
    documents: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Weight, score and rank in the draw of every document.

    Returns one row per input row: ``key``, ``n_features``, ``weight``, ``score`` and ``rank``, all long; ``rank`` is
    null where not drawn. Keys are integers. Null and empty texts have no features and weigh 0; a null key draws its
    noise as an empty text and comes after all keys among equal scores. Repeated rows are drawn each for itself, with
    equal scores next to each other. An empty target makes every gain that of the smoothing alone; an empty table
    gives no rows. Whole texts count, of any length; other columns are not looked at.
    """
    prepare(documents.sparkSession)
    rows = documents.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    wanted = bucket_counts(target.select(F.col(target_text).cast("string").alias("text")), buckets, longest)
    gain = gains(bucket_counts(rows.select("text"), buckets, longest), wanted)
    schema = "key long, n_features long, n_words long, weight long, score long"
    scored = rows.mapInArrow(_score(gain, longest, seed), schema).withColumn("able", F.col("n_words") >= least_words)
    done = draw(scored, percent, segment_rows)
    return done.select(F.col("key").alias(key), "n_features", "weight", "score", "rank")
