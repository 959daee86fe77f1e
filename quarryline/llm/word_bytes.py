"""Words of many texts at once, as runs of bytes in one array.

Texts of a batch are joined by a line end into slices of bounded size (a longer text is a slice of its own), and the
words of a slice are found and hashed by array operations. UTF-8 keeps every byte of a non-ASCII character above
127, so byte classes say the same as character classes of ASCII characters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Bytes of text handled at once; bounds the arrays of a task, one longer text apart.
SLICE_BYTES = 1 << 20
# Words with more bytes than this are hashed one by one.
LONG_WORD = 48

# Everything but blank, tab, line feed, vertical tab, form feed and carriage return.
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False


@dataclass(frozen=True)
class Slice:
    """Some texts of a batch: their rows, joined bytes, and the words of all of them in order."""

    first_row: int
    rows: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first_word: np.ndarray  # by text, and the number of all words at the end

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first_word)

    def owner(self) -> np.ndarray:
        """Text of every word."""
        return np.repeat(np.arange(self.rows), self.counts)


def slices(texts: pa.Array, kind: np.ndarray, slice_bytes: int = SLICE_BYTES) -> Iterator[Slice]:
    """A batch of texts (null: empty) in slices; words are maximal runs of bytes of a kind."""
    held, size, first = [], 0, 0
    for row, text in enumerate(texts.cast(pa.large_binary()).to_pylist()):
        text = text or b""
        if held and size + len(text) > slice_bytes:
            yield _slice(first, held, kind)
            held, size, first = [], 0, row
        held.append(text)
        size += len(text) + 1
    if held:
        yield _slice(first, held, kind)


def _slice(first: int, texts: list[bytes], kind: np.ndarray) -> Slice:
    data = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = kind[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    lengths = np.fromiter((len(text) + 1 for text in texts), np.int64, len(texts))
    begins = np.concatenate([[0], np.cumsum(lengths)])
    starts = edges[::2]
    return Slice(first, len(texts), data, starts, edges[1::2], np.searchsorted(starts, begins))


def fold(
    data: np.ndarray,
    starts: np.ndarray,
    ends: np.ndarray,
    state: np.ndarray,
    step: Callable[[np.ndarray, np.ndarray], np.ndarray],
    whole: Callable[[int, bytes], int],
) -> np.ndarray:
    """States of all words after all of their bytes; ``whole`` does a long word in one go."""
    state, lengths = state.copy(), ends - starts
    for i in np.flatnonzero(lengths > LONG_WORD).tolist():
        state[i] = whole(int(state[i]), data[starts[i] : ends[i]].tobytes())
    left = np.flatnonzero((lengths > 0) & (lengths <= LONG_WORD))
    at = 0
    while len(left):
        state[left] = step(state[left], data[starts[left] + at])
        at += 1
        left = left[lengths[left] > at]
    return state
