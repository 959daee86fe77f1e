"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages: windows of its UTF-8 bytes, all of them. A passage is encoded from what it is made of
(kinds of characters and their changes, variety of its four-byte sequences) by a layer of the network; gated
attention weighs the passages; the weighted sum is scored. Only labels of documents are needed: encoder, attention
and score are learned together, in numpy, on a bounded sample.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.llm.common import prepare
from quarryline.llm.language_id import held_out

THRESHOLD = 0.7
PASSAGE = 256
HIDDEN = 16
GATE = 8
# Labelled documents to learn from, about.
SAMPLE_DOCUMENTS = 5000
EPOCHS = 30
BATCH = 128
RATE = 0.01
DECAY = 1e-4
SEED = 11
# Passages encoded at once.
CHUNK = 4096

# Kinds of bytes: padding, lower, upper, beyond ASCII, digit, blank, line end, stop, pipe, other signs, control.
_KINDS = 11
_KIND = np.full(256, 10, dtype=np.uint8)
for _byte in range(256):
    _char = chr(_byte)
    if _byte >= 128:
        _KIND[_byte] = 3
    elif _char.islower():
        _KIND[_byte] = 1
    elif _char.isupper():
        _KIND[_byte] = 2
    elif _char.isdigit():
        _KIND[_byte] = 4
    elif _char in " \t":
        _KIND[_byte] = 5
    elif _char in "\r\n":
        _KIND[_byte] = 6
    elif _char in ".,;:'\"-()?":
        _KIND[_byte] = 7
    elif _char == "|":
        _KIND[_byte] = 8
    elif _char.isprintable():
        _KIND[_byte] = 9
FEATURES = _KINDS - 1 + 5


def windows(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all passages, how many bytes each has, and how many passages each text has (at least one)."""
    raw = [(text or "").encode("utf-8", "replace") for text in texts]
    counts = np.array([max(1, -(-len(b) // PASSAGE)) for b in raw], dtype=np.int64)
    joined = b"".join(b.ljust(n * PASSAGE, b"\0") for b, n in zip(raw, counts.tolist()))
    lengths = np.full(int(counts.sum()), PASSAGE, dtype=np.int64)
    ends = np.cumsum(counts) - 1
    lengths[ends] = [len(b) - (n - 1) * PASSAGE for b, n in zip(raw, counts.tolist())]
    return np.frombuffer(joined, dtype=np.uint8).reshape(-1, PASSAGE), lengths, counts


def features(passages: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """One row of numbers for each passage."""
    out = np.zeros((len(passages), FEATURES), dtype=np.float32)
    place = np.arange(PASSAGE)
    for low in range(0, len(passages), CHUNK):
        part, size = passages[low : low + CHUNK], lengths[low : low + CHUNK]
        kinds = _KIND[part]
        kinds[place[None, :] >= size[:, None]] = 0
        rows = np.arange(len(part), dtype=np.int64)[:, None]
        counts = np.bincount((kinds + rows * _KINDS).ravel(), minlength=len(part) * _KINDS).reshape(-1, _KINDS)
        share = counts[:, 1:] / np.maximum(size, 1)[:, None]
        out[low : low + CHUNK, : _KINDS - 1] = np.sqrt(share)
        # Variety of four-byte sequences.
        wide = part.astype(np.uint32)
        grams = wide[:, :-3] | wide[:, 1:-2] << 8 | wide[:, 2:-1] << 16 | wide[:, 3:] << 24
        grams[place[None, 3:] >= size[:, None]] = 0
        grams.sort(axis=1)
        distinct = (np.diff(grams, axis=1) != 0).sum(axis=1)
        extra = out[low : low + CHUNK, _KINDS - 1 :]
        extra[:, 0] = distinct / np.maximum(size - 3, 1)
        extra[:, 1] = size / PASSAGE
        gaps = (kinds == 5) | (kinds == 6)
        words = (gaps[:, 1:] & ~gaps[:, :-1]).sum(axis=1) + 1
        extra[:, 2] = np.log1p(size / words) / 3
        # Signs and pipes beside other kinds, capitals after capitals.
        signs = kinds >= 8
        extra[:, 3] = (signs[:, 1:] != signs[:, :-1]).sum(axis=1) / np.maximum(size, 1)
        extra[:, 4] = ((kinds[:, 1:] == 2) & (kinds[:, :-1] == 2)).sum(axis=1) / np.maximum(size, 1)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class AttentionMIL:
    """Encoder, gated attention and score of bags of passages."""

    def __init__(self, seed: int = SEED, hidden: int = HIDDEN, gate: int = GATE):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = np.zeros(FEATURES), np.ones(FEATURES)
        self.w = {
            "e": rng.normal(0, FEATURES**-0.5, (FEATURES, hidden)), "eb": np.zeros(hidden),
            "v": rng.normal(0, hidden**-0.5, (hidden, gate)), "u": rng.normal(0, hidden**-0.5, (hidden, gate)),
            "a": rng.normal(0, gate**-0.5, gate), "s": rng.normal(0, hidden**-0.5, hidden), "sb": np.zeros(1),
        }

    def _forward(self, x: np.ndarray, counts: np.ndarray):
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        bag = np.repeat(np.arange(len(counts)), counts)
        h = np.tanh(x @ self.w["e"] + self.w["eb"])
        tv, su = np.tanh(h @ self.w["v"]), _sigmoid(h @ self.w["u"])
        logit = (tv * su) @ self.w["a"]
        weight = np.exp(logit - np.maximum.reduceat(logit, starts)[bag])
        weight /= np.add.reduceat(weight, starts)[bag]
        pooled = np.add.reduceat(h * weight[:, None], starts, axis=0)
        score = _sigmoid(pooled @ self.w["s"] + self.w["sb"][0])
        return score, (starts, bag, h, tv, su, weight, pooled)

    def scores(self, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each bag."""
        return self._forward((x - self.mean) / self.scale, counts)[0]

    def gradients(self, x: np.ndarray, counts: np.ndarray, truth: np.ndarray) -> tuple[float, dict]:
        """Mean cross-entropy of the bags and its gradients; ``x`` is standardised."""
        score, (starts, bag, h, tv, su, weight, pooled) = self._forward(x, counts)
        clipped = np.clip(score, 1e-7, 1 - 1e-7)
        loss = -float(np.mean(truth * np.log(clipped) + (1 - truth) * np.log(1 - clipped)))
        d_score = (score - truth) / len(truth)
        d_pooled = d_score[:, None] * self.w["s"]
        d_h = weight[:, None] * d_pooled[bag]
        d_weight = (h * d_pooled[bag]).sum(axis=1)
        d_logit = weight * (d_weight - np.add.reduceat(weight * d_weight, starts)[bag])
        d_gated = d_logit[:, None] * self.w["a"]
        d_v, d_u = d_gated * su * (1 - tv**2), d_gated * tv * su * (1 - su)
        d_h = d_h + d_v @ self.w["v"].T + d_u @ self.w["u"].T
        d_e = d_h * (1 - h**2)
        return loss, {
            "e": x.T @ d_e, "eb": d_e.sum(axis=0), "v": h.T @ d_v, "u": h.T @ d_u, "a": (tv * su).T @ d_logit,
            "s": pooled.T @ d_score, "sb": np.array([d_score.sum()]),
        }

    def fit(self, bags: list[np.ndarray], truth: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> list[float]:
        """Adam over batches of bags; returns the mean loss of each epoch."""
        rng = np.random.default_rng(seed)
        every = np.concatenate(bags)
        self.mean, self.scale = every.mean(axis=0), every.std(axis=0) + 1e-3
        bags = [(bag - self.mean) / self.scale for bag in bags]
        moments = {name: (np.zeros_like(v), np.zeros_like(v)) for name, v in self.w.items()}
        losses, step = [], 0
        for epoch in range(epochs):
            order, total = rng.permutation(len(bags)), 0.0
            pace = rate * (1 - epoch / epochs) + rate / 20
            for low in range(0, len(order), BATCH):
                members = order[low : low + BATCH]
                counts = np.array([len(bags[i]) for i in members])
                loss, grads = self.gradients(np.concatenate([bags[i] for i in members]), counts, truth[members])
                total += loss * len(members)
                step += 1
                for name, grad in grads.items():
                    m, v = moments[name]
                    m += 0.1 * (grad - m)
                    v += 0.001 * (grad**2 - v)
                    self.w[name] = self.w[name] - pace * (
                        (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8) + DECAY * self.w[name]
                    )
            losses.append(total / max(1, len(bags)))
        return losses


def _bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        passages, lengths, counts = windows(batch["text"].tolist())
        parts = np.split(features(passages, lengths), np.cumsum(counts)[:-1]) if len(counts) else []
        yield pd.DataFrame({"key": batch["key"], "label": batch["label"], "bag": [part.tobytes() for part in parts]})


def train(
    documents: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample_documents: int = SAMPLE_DOCUMENTS,
) -> AttentionMIL | None:
    """A classifier fitted on labelled documents that are not held out; nothing unless both labels occur.

    About ``sample_documents`` labelled rows are drawn by a hash of the key, so the driver holds a bounded sample of
    passage features. Rows with a null key or label teach nothing; of rows with one key and label one teaches.
    """
    spark = documents.sparkSession
    prepare(spark)
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
    known = known.where(~held_out(F.col("key")) & F.col("key").isNotNull() & F.col("label").isin(0, 1)).distinct()
    total = known.count()
    if not total:
        return None
    share = min(1 << 30, int(sample_documents / total * (1 << 30)) + 1)
    drawn = known.where(F.pmod(F.xxhash64("key", F.lit(SEED)), F.lit(1 << 30)) < share)
    rows = documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    # The sample of labels is bounded, so it is sent to the documents instead of moving these.
    picked = rows.join(F.broadcast(drawn), "key").select(F.xxhash64("key").alias("key"), "text", "label")
    bags = picked.mapInPandas(_bags, "key long, label int, bag binary")
    # However many rows have a key, one of them is enough.
    sample = bags.groupBy("key", "label").agg(F.min("bag").alias("bag")).collect()
    truth = np.array([r["label"] for r in sample], dtype=np.float64)
    if len(np.unique(truth)) < 2:
        return None
    sample.sort(key=lambda r: (r["label"], bytes(r["bag"])))
    model = AttentionMIL()
    bags = [np.frombuffer(r["bag"], dtype=np.float32).reshape(-1, FEATURES).astype(np.float64) for r in sample]
    model.fit(bags, np.array([r["label"] for r in sample], dtype=np.float64))
    return model


def _scores(model: AttentionMIL, texts: list[str | None]) -> np.ndarray:
    """Scores in portions of bounded size; only a single text can be larger."""
    out, held, size = [], [], 0

    def flush() -> None:
        nonlocal held, size
        if held:
            passages, lengths, counts = windows(held)
            out.append(model.scores(features(passages, lengths), counts))
        held, size = [], 0

    for text in texts:
        held.append(text)
        size += len(text or "")
        if size > CHUNK * PASSAGE:
            flush()
    flush()
    return np.concatenate(out) if out else np.zeros(0)


def _score_column(spark, model: AttentionMIL):
    prepare(spark)
    shared = spark.sparkContext.broadcast(pickle.dumps(model))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = pickle.loads(shared.value)
        for texts in batches:
            yield pd.Series(_scores(own, texts.tolist()))

    return F.pandas_udf(run, "double")


def score(documents: DataFrame, model: AttentionMIL | None, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Quality of every whole text: ``key``, ``held_out``, ``score`` (0 to 1), ``predicted`` (1 from ``threshold`` on).

    Null texts count as empty, which is one empty passage. Null keys count as not held out; repeated rows are kept.
    Without a model all scores are 1. An empty table gives no rows. Only the text decides.
    """
    rows = documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    value = F.lit(1.0) if model is None else _score_column(documents.sparkSession, model)("text")
    rows = rows.select("key", value.alias("score"))
    return rows.select(
        F.col("key").alias(key), held_out(F.col("key")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def accepted(documents: DataFrame, model: AttentionMIL | None, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score at least the threshold; all rows without a model."""
    if model is None:
        return documents
    return documents.where(_score_column(documents.sparkSession, model)(F.col(text).cast("string")) >= threshold)
