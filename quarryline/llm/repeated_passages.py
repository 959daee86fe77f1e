"""Substring dedup by level-wise doubling: words inside windows that occur more than once are removed.

A window of W words is reached from a quarter of its length over a half, and only what is repeated at one length is
extended to twice that length:

1. Every window of W words has a *core*, its quarter-length window of least hash (the leftmost of equal ones). Equal windows have
   equal cores at equal distances, so a window whose core occurs once cannot be repeated. Cores are picked by content alone,
   about one in W/2 positions.
2. Cores that occur more than once are extended to half the length, to the right where the window allows, else to
   the left. Consecutive windows of one core are a *run*. Where the half-length window occurs once, its run ends here.
3. The rest is extended to the whole length. A run that occurs more than once, word for word, settles all of its windows at
   once. Only where different runs share a half-length window are their windows compared one by one, each different run once.

Hashes are built by doubling too: a window's hash mixes those of its two halves. Those of the first two lengths
have 64 bits and only thin out candidates; whole windows are told apart by 128 bits. Every level is one combinable count by hash
and one join with the hashes counted more than once, so frequent windows are split like any skewed join; no group of
copies is gathered anywhere but for the places of one document in its row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.llm.common import pinned, prepare
from quarryline.llm.word_bytes import NOT_BLANK, Slice, fold, slices

WINDOW = 35

_PRIME = np.uint64(0x100000001B3)
_START = 0xCBF29CE484222325
# Odd multipliers of the two families of window hashes.
_FAMILIES = ((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F), (0xD6E8FEB86659FD93, 0xA0761D6478BD642F))


def _word_step(state: np.ndarray, data: np.ndarray) -> np.ndarray:
    state = (state ^ data) * _PRIME
    return state ^ (state >> np.uint64(29))


def _mixed(left: np.ndarray, right: np.ndarray, family: int = 0) -> np.ndarray:
    one, other = (np.uint64(k) for k in _FAMILIES[family])
    h = left * one + (right ^ (right >> np.uint64(31))) * other
    h ^= h >> np.uint64(32)
    h *= one
    return h ^ (h >> np.uint64(29))


class Codes:
    """Hashes of the words of a slice, and of windows by doubling."""

    def __init__(self, part: Slice):
        state = np.full(len(part.starts), _START, dtype=np.uint64)
        words = fold(part.data, part.starts, part.ends, state, _word_step, lambda seed, word: xxhash.xxh64_intdigest(word, seed))
        self.known = {(1, family): words for family in range(len(_FAMILIES))}

    def of(self, length: int, family: int = 0) -> np.ndarray:
        """Hash of the window of a length that starts at each word; shorter by that length less one."""
        if (length, family) not in self.known:
            half = 1
            while 2 * half < length:
                half *= 2
            parts = self.of(half, family)
            reach = length - half
            self.known[length, family] = _mixed(parts[: max(0, len(parts) - reach)], parts[reach:], family)
        return self.known[length, family]


class Runs:
    """Consecutive windows with one core in the texts of a slice: first window, number of windows, core."""

    def __init__(self, part: Slice, codes: Codes, window: int):
        self.base, self.half = (window + 3) // 4, (window + 1) // 2
        owner = part.owner()
        value = codes.of(self.base)
        index = np.arange(len(value))
        width, reach = 1, window - self.base + 1
        while width < reach:
            step = min(width, reach - width)
            left = value[:-step] <= value[step:] if len(value) > step else np.zeros(0, dtype=bool)
            value = np.where(left, value[: len(left)], value[step : step + len(left)])
            index = np.where(left, index[: len(left)], index[step : step + len(left)])
            width += step
        starts = np.flatnonzero(owner[: len(value)] == owner[window - 1 : window - 1 + len(value)])
        at = index[starts]
        fresh = np.ones(len(starts), dtype=bool)
        fresh[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
        first = np.flatnonzero(fresh)
        self.low, self.core = starts[first], at[first]
        self.count = np.diff(np.append(first, len(starts)))
        self.owner = owner[self.low]

    def only(self, chosen: np.ndarray) -> None:
        for name in ("low", "core", "count", "owner"):
            setattr(self, name, getattr(self, name)[chosen])

    def extended(self, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Runs cut by the side their core grows to: text, first window, number, start of the half-length window."""
        furthest = window - self.half  # of a core that can grow to the right inside its window
        high = self.low + self.count - 1
        cut = np.clip(self.core - furthest, self.low, high + 1)
        parts = [
            (self.owner, self.low, cut - self.low, self.core - (self.half - self.base)),
            (self.owner, cut, high + 1 - cut, self.core),
        ]
        owner, low, count, start = (np.concatenate(columns) for columns in zip(*parts))
        some = count > 0
        return owner[some], low[some], count[some], start[some]


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _emit(batch: pa.RecordBatch, row: np.ndarray, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """Key and check of the rows, and the columns beside them."""
    names, at = ["key", "check"], pa.array(row)
    return pa.RecordBatch.from_arrays(
        [*(batch.column(name).take(at) for name in names), *columns.values()], [*names, *columns]
    )


def _lists(column: pa.Array, part: Slice) -> tuple[np.ndarray, pa.Array]:
    """The lists of a slice's texts, flat, with the text of each entry."""
    own = column.slice(part.first_row, part.rows)
    return np.asarray(pa.compute.list_parent_indices(own)), own.flatten()


def _cores(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text"), NOT_BLANK):
                codes = Codes(part)
                runs = Runs(part, codes, window)
                place = pa.array((runs.core - part.first_word[runs.owner]).astype(np.int32))
                code = _signed(codes.of(runs.base)[runs.core])
                yield _emit(batch, part.first_row + runs.owner, {"place": place, "code": code})

    return run


def _runs(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text"), NOT_BLANK):
                codes = Codes(part)
                runs = Runs(part, codes, window)
                owner, place = _lists(batch.column("places"), part)
                runs.only(np.isin(runs.core, part.first_word[owner] + place.to_numpy()))
                owner, low, count, start = runs.extended(window)
                high = low + count - 1
                half = codes.of(runs.half)[start]
                # The side is part of the half-length window's name: equal windows agree in it.
                side = (start < low).astype(np.uint64)
                whole = []
                for family in range(len(_FAMILIES)):
                    code = codes.of(window, family)
                    whole.append(_mixed(_mixed(code[low], code[high], family), count.astype(np.uint64), family))
                yield _emit(
                    batch,
                    part.first_row + owner,
                    {
                        "low": pa.array((low - part.first_word[owner]).astype(np.int32)),
                        "n": pa.array(count.astype(np.int32)),
                        "half": _signed(_mixed(half, side)),
                        "code1": _signed(whole[0]),
                        "code2": _signed(whole[1]),
                    },
                )

    return run


def _windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text"), NOT_BLANK):
                codes = Codes(part)
                owner, wanted = _lists(batch.column("places"), part)
                low, count, settled = (wanted.field(i).to_numpy(zero_copy_only=False) for i in range(3))
                # Every window of every run: its place in the run counted up beside the repeated row.
                row = np.repeat(np.arange(len(low)), count)
                place = low[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                at = part.first_word[owner[row]] + place
                yield _emit(
                    batch,
                    part.first_row + owner[row],
                    {
                        "low": pa.array(place.astype(np.int32)),
                        "settled": pa.array(settled[row]),
                        "code1": _signed(codes.of(window, 0)[at]),
                        "code2": _signed(codes.of(window, 1)[at]),
                    },
                )

    return run


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the words inside their stretches."""
    for batch in batches:
        counts, removed, texts = [], [], []
        for part in slices(batch.column("text"), NOT_BLANK):
            owner, stretches = _lists(batch.column("places"), part)
            change = np.zeros(len(part.starts) + 1, dtype=np.int64)
            np.add.at(change, part.first_word[owner] + stretches.field(0).to_numpy(), 1)
            np.add.at(change, part.first_word[owner] + stretches.field(1).to_numpy(), -1)
            stay = np.cumsum(change[:-1]) == 0
            data = part.data.tobytes()
            before = np.concatenate([[0], np.cumsum(stay)])[part.first_word]
            words = [data[s:e] for s, e in zip(part.starts[stay].tolist(), part.ends[stay].tolist())]
            texts += [b" ".join(words[low:high]).decode("utf-8") for low, high in zip(before[:-1].tolist(), before[1:].tolist())]
            counts.append(part.counts)
            removed.append(part.counts - np.diff(before))
        if texts:
            columns = [pa.array(np.concatenate(c).astype(np.int64)) for c in (counts, removed)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *columns, pa.array(texts)], ["key", "n_words", "n_removed", "kept"])


def _repeated(rows: DataFrame, by: list[str], weight: Column) -> DataFrame:
    """Hashes counted more than once; written, so that a join with them is free to split a frequent hash."""
    return pinned(rows.groupBy(*by).agg(F.sum(weight).alias("times")).where("times > 1").drop("times"), "repeated")


def _beside(texts: DataFrame, rows: DataFrame, places: Column, how: str = "inner") -> DataFrame:
    """Texts with the places that rows hold for them, as one list; a document cannot have more than it has words."""
    listed = rows.groupBy(F.col("key").alias("its_key"), F.col("check").alias("its_check")).agg(F.collect_set(places).alias("places"))
    same = F.col("key").eqNullSafe(F.col("its_key")) & (F.col("check") == F.col("its_check"))
    return texts.join(listed, same, how).select("key", "check", "text", "places")


def without_repeats(documents: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Every document without the words covered by a window of ``window`` words that starts anywhere else as well.

    Returns one row per input row: ``key``, ``n_words``, ``n_removed`` and ``kept`` (the words that stay, joined by one
    blank). Words are what stands between ASCII white space, unchanged. Windows are judged on the input: both
    occurrences go, also inside one document. Null and empty texts have no words and an empty ``kept``; texts shorter than
    a window keep all. Repeated rows count as occurrences of each other, whatever their keys, null keys included. An
    empty table gives no rows; other columns are not looked at. Texts may be of any length.
    """
    if window < 1:
        raise ValueError("a window has one word at least")
    prepare(documents.sparkSession)
    texts = documents.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    # Rows are known by key and a hash of the text, so keys may repeat.
    texts = texts.select("key", F.xxhash64("text").alias("check"), "text")
    named = f"key {texts.schema['key'].dataType.simpleString()}, check long"
    once = F.lit(1)

    cores = pinned(texts.mapInArrow(_cores(window), f"{named}, place int, code long"), "cores")
    cores = cores.join(_repeated(cores, ["code"], once), "code")

    found = _beside(texts, cores, F.col("place")).mapInArrow(
        _runs(window), f"{named}, low int, n int, half long, code1 long, code2 long"
    )
    runs = pinned(found, "runs")
    by_run = ["half", "code1", "code2"]
    kinds = runs.groupBy(*by_run).agg(
        F.count("*").alias("times"), *(F.first(c).alias(c) for c in ("key", "check", "low", "n"))
    )
    kinds = pinned(kinds, "kinds")
    # Half-length windows with different runs, one of which occurs once.
    open_halves = kinds.groupBy("half").agg(F.count("*").alias("kinds"), F.min("times").alias("least"))
    open_halves = pinned(open_halves.where("kinds > 1 and least = 1").select("half"), "halves")
    each = kinds.join(open_halves, "half").withColumn("settled", F.col("times") > 1)

    windows = _beside(texts, each, F.struct("low", "n", "settled")).mapInArrow(
        _windows(window), f"{named}, low int, settled boolean, code1 long, code2 long"
    )
    windows = pinned(windows, "windows")
    by_window = ["code1", "code2"]
    again = _repeated(windows, by_window, F.when(F.col("settled"), 2).otherwise(1))
    single = windows.where("not settled").join(again, by_window).withColumn("n", F.lit(1))
    whole = runs.join(kinds.where("times > 1").select(*by_run), by_run)

    covered = single.select("key", "check", "low", "n").unionByName(whole.select("key", "check", "low", "n"))
    stretch = F.struct(F.col("low").alias("start"), (F.col("low") + F.col("n") + (window - 1)).alias("end"))
    done = _beside(texts, covered, stretch, "left").mapInArrow(
        _kept, f"key {texts.schema['key'].dataType.simpleString()}, n_words long, n_removed long, kept string"
    )
    return done.select(F.col("key").alias(key), "n_words", "n_removed", "kept")
