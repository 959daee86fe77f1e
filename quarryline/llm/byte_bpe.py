"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For every prefix of a piece there is exactly one token that can end its encoding. It is found from the tokens that
are suffixes of the prefix: the right one follows the last token of the remaining, shorter prefix in a pair that
merging would leave alone. The table of these last tokens grows byte by byte, so appending costs only the new
bytes, and an edit only what follows it. Reading the table backwards gives the encoding.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.llm.common import prepare

# Entries kept by a worker in its memory of pieces and of token pairs; both start over when full.
PIECES_KEPT = 600_000
PAIRS_KEPT = 600_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: a base64 token and its rank on every line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """Plain merging of a short piece: the lowest-ranked neighbour pair first, the leftmost of equals."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        options = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not options:
            break
        at = min(options)[1]
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Vocabulary:
    """Ranks with a memory of which neighbouring tokens stay apart."""

    def __init__(self, ranks: dict[bytes, int]):
        missing = [i for i in range(256) if bytes([i]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks {len(missing)} single bytes")
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        # Tokens that merging can never produce cannot end a prefix.
        self.usable = {token: rank for token, rank in ranks.items() if len(token) == 1 or merged(token, ranks) == [token]}
        # The longest token that ends in each pair of bytes.
        self.reach: dict[bytes, int] = {}
        for token in self.usable:
            self.reach[token[-2:]] = max(self.reach.get(token[-2:], 0), len(token))
        self.pairs: dict[tuple[int, int], bool] = {}

    def apart(self, left: int, right: int) -> bool:
        """Whether merging leaves this pair of tokens as it is."""
        known = self.pairs.get((left, right))
        if known is None:
            one, other = self.tokens[left], self.tokens[right]
            known = merged(one + other, self.ranks) == [one, other]
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs.clear()
            self.pairs[left, right] = known
        return known

    def decode(self, ids) -> bytes:
        """Bytes of a sequence of ids."""
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids])


class PrefixTable:
    """Last tokens of all prefixes of one piece, open to appends and edits."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b""):
        self.vocabulary = vocabulary
        self.piece = b""
        self.last: list[int] = []
        self.append(piece)

    def append(self, more: bytes) -> None:
        """Add bytes at the end; earlier entries stay."""
        vocabulary = self.vocabulary
        usable, reach, pairs, apart = vocabulary.usable, vocabulary.reach, vocabulary.pairs, vocabulary.apart
        last = self.last
        start = len(last)
        self.piece = piece = self.piece + more
        for end in range(start + 1, len(piece) + 1):
            longest = reach.get(piece[end - 2 : end], 1) if end > 1 else 1
            for begin in range(max(0, end - longest), end):
                token = usable.get(piece[begin:end])
                if token is None:
                    continue
                if begin:
                    pair = (last[begin - 1], token)
                    stays = pairs.get(pair)
                    if not (apart(*pair) if stays is None else stays):
                        continue
                last.append(token)
                break

    def edit(self, start: int, end: int, replacement: bytes) -> None:
        """Replace a span of bytes; only entries from its start on are computed again."""
        tail = replacement + self.piece[end:]
        self.piece = self.piece[:start]
        del self.last[start:]
        self.append(tail)

    def ids(self, length: int | None = None) -> list[int]:
        """Encoding of the piece, or of its first ``length`` bytes."""
        at = len(self.piece) if length is None else length
        out = []
        while at:
            token = self.last[at - 1]
            out.append(token)
            at -= len(self.vocabulary.tokens[token])
        return out[::-1]


def compiled(pattern: str) -> regex.Pattern:
    """The splitting pattern with white space as Unicode defines it, also for control characters."""
    return regex.compile(pattern.replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}"))


class Encoder:
    """Encodes whole texts; equal pieces are encoded once as long as they are remembered."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.vocabulary = Vocabulary(ranks)
        self.pattern = compiled(pattern)
        # A blank before anything but white space starts a new match of the known patterns only.
        self.blank_splits = pattern == KNOWN_PATTERN
        self.memory: dict[str, bytes] = {}

    def _match(self, match: str) -> bytes:
        """Packed ids of one match of the pattern."""
        piece = match.encode("utf-8", "replace")
        whole = self.vocabulary.usable.get(piece)
        ids = [whole] if whole is not None else PrefixTable(self.vocabulary, piece).ids()
        return np.array(ids, dtype="<u4").tobytes()

    def _chunk(self, chunk: str) -> bytes:
        """Packed ids of a stretch of text that starts and ends between two matches."""
        memory, out = self.memory, []
        for match in self.pattern.findall(chunk):
            packed = memory.get(match)
            if packed is None:
                packed = self._match(match)
                if len(memory) >= PIECES_KEPT:
                    memory.clear()
                if len(match) < 64:
                    memory[match] = packed
            out.append(packed)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if not self.blank_splits:
            return self._chunk(text)
        memory, out, held = self.memory, [], None
        for at, word in enumerate(text.split(" ")):
            chunk = " " + word if at else word
            if not word or word[0].isspace() or not at:
                # White space runs over the blank: keep together what cannot be split here.
                held = chunk if held is None else held + chunk
                continue
            if held is not None:
                out.append(self._chunk(held))
                held = None
            packed = memory.get(chunk)
            if packed is None:
                packed = self._chunk(chunk)
                if len(memory) >= PIECES_KEPT:
                    memory.clear()
                if len(chunk) < 64:
                    memory[chunk] = packed
            out.append(packed)
        if held is not None:
            out.append(self._chunk(held))
        return b"".join(out)

    def decode(self, packed: bytes) -> bytes:
        """Bytes of packed ids."""
        return self.vocabulary.decode(np.frombuffer(packed, dtype="<u4").tolist())


# Fixed value: the splitting pattern for which a blank before a non-space always begins a match.
KNOWN_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_encoders: dict[str, Encoder] = {}


def _encoder(shared, pattern: str) -> Encoder:
    """One encoder for each vocabulary in a worker, used again by later tasks."""
    ranks = shared.value
    name = hashlib.sha256(repr((len(ranks), sorted(ranks.items())[:1000], pattern)).encode()).hexdigest()
    if name not in _encoders:
        _encoders.clear()
        _encoders[name] = Encoder(ranks, pattern)
    return _encoders[name]


def _digest_batches(shared, pattern: str):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(shared, pattern)
        for texts in batches:
            rows = []
            for text in texts:
                packed = encoder.encode(text or "")
                decoded = encoder.decode(packed)
                rows.append((len(packed) // 4, hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return F.pandas_udf(run, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def _inputs(documents: DataFrame, ranks_path: str, key: str, text: str):
    spark = documents.sparkSession
    prepare(spark)
    # A vocabulary file has a fixed size of about a megabyte.
    shared = spark.sparkContext.broadcast(read_ranks(ranks_path))
    return documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")), shared


def encode(documents: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``ids`` (array of int) of every whole text; see ``digests`` for the treatment of odd rows."""
    rows, shared = _inputs(documents, ranks_path, key, text)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = _encoder(shared, pattern)
        for texts in batches:
            yield pd.Series([np.frombuffer(encoder.encode(text or ""), dtype="<u4").astype(np.int32) for text in texts], dtype=object)

    return rows.select(F.col("key").alias(key), F.pandas_udf(run, "array<int>")("text").alias("ids"))


def decode(tokens: DataFrame, ranks_path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key`` and ``bytes`` of every array of ids; null arrays count as empty, an id outside the vocabulary raises."""
    spark = tokens.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        by_rank = {rank: token for token, rank in shared.value.items()}
        for lists in batches:
            yield pd.Series([b"".join([by_rank[i] for i in ([] if x is None else x)]) for x in lists], dtype=object)

    return tokens.select(F.col(key).alias(key), F.pandas_udf(run, "binary")(F.col(ids)).alias("bytes"))


def digests(documents: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Token count and digests of the ids and of the decoded bytes of every whole text.

    Returns one row per input row: ``key`` (nulls and repeats stay), ``n_tokens``, ``ids_sha256`` (ids as
    little-endian unsigned 32-bit integers), ``decoded_sha256``. Null texts count as empty, which gives no tokens
    and digests of nothing. Special tokens are not recognised. Any length of text is encoded whole. An empty
    table gives no rows; other columns are not looked at.
    """
    rows, shared = _inputs(documents, ranks_path, key, text)
    done = rows.select("key", _digest_batches(shared, pattern)("text").alias("digests"))
    return done.select(F.col("key").alias(key), "digests.*")
