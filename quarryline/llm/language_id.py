"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads runs of letters, byte by byte, in both directions, and labels every byte with a distribution over
languages; a document pools these labels over all its letter bytes. State starts anew at every byte that is no
letter (one boundary byte stands for it on either side) and after ``RUN`` bytes, so what a run contributes
depends on its bytes alone, and a worker computes equal runs once. Training is backpropagation through time
in numpy on a bounded sample; predictions read whole texts.
"""

from __future__ import annotations

import pickle
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.llm.common import prepare

UNKNOWN = "und"
HIDDEN = 16
RUN = 32
# The sample for training: documents of a language (about), and runs taken from each.
SAMPLE_DOCUMENTS = 400
SAMPLE_RUNS = 48
MAX_LANGUAGES = 512
EPOCHS = 6
BATCH = 256
RATE = 0.01
SEED = 7
# Neighbouring labels of a run repeat each other; evidence is divided by this before documents are pooled.
SOFTEN = 8.0
# Runs a worker remembers; it starts over when they are more.
RUNS_KEPT = 400_000

# ASCII bytes without letters become boundaries; other alphabets' bytes stay.
_LETTERS = bytes(i if i >= 128 or chr(i).isalpha() else 32 for i in range(256))
_LETTER = re.compile(r"[^\W\d_]")


def runs_of(text: str) -> list[bytes]:
    """Runs of letter bytes of a text in lower case, in order; runs longer than ``RUN`` are cut."""
    words = text.lower().encode("utf-8", "replace").translate(_LETTERS).split()
    if max(map(len, words), default=0) <= RUN:
        return words
    return [word[i : i + RUN] for word in words for i in range(0, len(word), RUN)]


def has_letter(text: str | None) -> bool:
    """Whether a text has any letter."""
    return bool(text) and _LETTER.search(text) is not None


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class BiGRU:
    """Embedding rows for 256 bytes and two gated recurrent layers, one per direction, under one output layer."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.languages, self.hidden = languages, hidden
        self.w: dict[str, np.ndarray] = {}
        for side in ("f", "b"):
            # Input weights of the update, reset and candidate parts are rows picked by the byte.
            self.w[f"x{side}"] = rng.normal(0, 0.3, (256, 3 * hidden))
            self.w[f"u{side}"] = rng.normal(0, hidden**-0.5, (hidden, 2 * hidden))
            self.w[f"c{side}"] = rng.normal(0, hidden**-0.5, (hidden, hidden))
            self.w[f"o{side}"] = rng.normal(0, hidden**-0.5, (hidden, len(languages)))
        self.w["o"] = np.zeros(len(languages))
        self.w = {name: value.astype(np.float32) for name, value in self.w.items()}

    def _direction(self, codes: np.ndarray, side: str, keep: bool):
        """Hidden states (step, run, hidden) in the order of the steps, and what training needs of them."""
        h, wx, wu, wc = self.hidden, self.w[f"x{side}"], self.w[f"u{side}"], self.w[f"c{side}"]
        state = np.zeros((len(codes), h), dtype=np.float32)
        states, tape = [], []
        for t in range(codes.shape[1]):
            x = wx[codes[:, t]]
            gates = _sigmoid(x[:, : 2 * h] + state @ wu)
            update, reset = gates[:, :h], gates[:, h:]
            gated = reset * state
            candidate = np.tanh(x[:, 2 * h :] + gated @ wc)
            if keep:
                tape.append((state, update, reset, gated, candidate))
            state = state + update * (candidate - state)
            states.append(state)
        return np.stack(states), tape

    def labels(self, codes: np.ndarray, keep: bool = False):
        """Log-probabilities (run, position, language) for runs of one length with a boundary byte at both ends."""
        forward, tape_f = self._direction(codes, "f", keep)
        backward, tape_b = self._direction(codes[:, ::-1], "b", keep)
        logits = forward @ self.w["of"] + backward[::-1] @ self.w["ob"] + self.w["o"]
        logits = logits - logits.max(axis=2, keepdims=True)
        logits -= np.log(np.exp(logits).sum(axis=2, keepdims=True))
        return logits.transpose(1, 0, 2), (forward, backward, tape_f, tape_b)

    def _back(self, codes: np.ndarray, side: str, tape: list, states_grad: np.ndarray, grads: dict) -> None:
        """Backpropagation through time of one direction."""
        h, wu, wc = self.hidden, self.w[f"u{side}"], self.w[f"c{side}"]
        dx, du, dc = grads[f"x{side}"], grads[f"u{side}"], grads[f"c{side}"]
        carried = np.zeros_like(states_grad[0])
        for t in range(len(tape) - 1, -1, -1):
            before, update, reset, gated, candidate = tape[t]
            grad = carried + states_grad[t]
            d_candidate = grad * update * (1 - candidate**2)
            d_gated = d_candidate @ wc.T
            d_update = grad * (candidate - before) * update * (1 - update)
            d_reset = d_gated * before * reset * (1 - reset)
            d_gates = np.concatenate([d_update, d_reset], axis=1)
            dc += gated.T @ d_candidate
            du += before.T @ d_gates
            np.add.at(dx, codes[:, t], np.concatenate([d_gates, d_candidate], axis=1))
            carried = grad * (1 - update) + d_gated * reset + d_gates @ wu.T

    def gradients(self, codes: np.ndarray, truth: np.ndarray) -> tuple[float, dict]:
        """Mean loss over all positions, and its gradients; ``truth`` is a language number for each run."""
        logs, (forward, backward, tape_f, tape_b) = self.labels(codes, keep=True)
        count = logs.shape[0] * logs.shape[1]
        loss = -float(logs[np.arange(len(codes)), :, truth].sum()) / count
        error = np.exp(logs)
        error[np.arange(len(codes)), :, truth] -= 1
        error = (error / count).transpose(1, 0, 2).astype(np.float32)
        grads = {name: np.zeros_like(value) for name, value in self.w.items()}
        grads["o"] += error.sum(axis=(0, 1))
        grads["of"] += np.tensordot(forward, error, axes=([0, 1], [0, 1]))
        grads["ob"] += np.tensordot(backward[::-1], error, axes=([0, 1], [0, 1]))
        self._back(codes, "f", tape_f, error @ self.w["of"].T, grads)
        self._back(codes[:, ::-1], "b", tape_b, (error @ self.w["ob"].T)[::-1], grads)
        return loss, grads

    def fit(self, runs: list[bytes], truth: list[int], epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> list[float]:
        """Adam on batches of runs of equal length; returns the mean loss of each epoch."""
        rng = np.random.default_rng(seed)
        truth = np.array(truth)
        lengths = np.array([len(run) for run in runs])
        moments = {name: (np.zeros_like(v), np.zeros_like(v)) for name, v in self.w.items()}
        losses, step = [], 0
        for epoch in range(epochs):
            order = rng.permutation(len(runs))
            order = order[np.argsort(lengths[order], kind="stable")]
            cuts = np.flatnonzero(np.diff(lengths[order])) + 1
            groups = [part[i : i + BATCH] for part in np.split(order, cuts) for i in range(0, len(part), BATCH)]
            total = 0.0
            for g in rng.permutation(len(groups)):
                members = groups[g]
                loss, grads = self.gradients(_codes([runs[i] for i in members]), truth[members])
                total += loss * len(members)
                step += 1
                pace = rate * (0.3 if epoch >= epochs // 2 else 1.0)
                for name, grad in grads.items():
                    m, v = moments[name]
                    m += 0.1 * (grad - m)
                    v += 0.001 * (grad**2 - v)
                    self.w[name] -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            losses.append(total / max(1, len(runs)))
        return losses

    def pooled(self, runs: list[bytes]) -> np.ndarray:
        """Sum over the letter positions of each run of its log-probabilities."""
        out = np.zeros((len(runs), len(self.languages)), dtype=np.float32)
        lengths = np.array([len(run) for run in runs])
        for length in np.unique(lengths):
            members = np.flatnonzero(lengths == length)
            for i in range(0, len(members), 4096):
                part = members[i : i + 4096]
                logs, _ = self.labels(_codes([runs[j] for j in part]))
                out[part] = logs[:, 1:-1].sum(axis=1)
        return out


def _codes(runs: list[bytes]) -> np.ndarray:
    """Bytes of runs of one length, with a boundary on either side."""
    return np.frombuffer(b"".join(b" " + run + b" " for run in runs), dtype=np.uint8).reshape(len(runs), -1)


def held_out(key: Column) -> Column:
    """Whether a row is kept from training; rows with a null key are not."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _sampled(runs_each: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, lang, text in zip(batch["key"], batch["lang"], batch["text"]):
                runs = runs_of(text)
                if runs:
                    picks = random.Random(zlib.crc32(text.encode("utf-8", "replace"))).choices(runs, k=runs_each)
                    rows.append((key, lang, b" ".join(picks)))
            yield pd.DataFrame(rows, columns=["key", "lang", "runs"])

    return run


def train(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    sample_documents: int = SAMPLE_DOCUMENTS,
    sample_runs: int = SAMPLE_RUNS,
) -> BiGRU | None:
    """A network fitted on documents that are not held out; nothing without labelled text.

    About ``sample_documents`` documents of each language are drawn by a hash of their key, one for each key, and
    ``sample_runs`` runs of letters at random from the whole text of each, so the driver holds a bounded sample.
    """
    prepare(documents.sparkSession)
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.where(~held_out(F.col("key")) & F.col("lang").isNotNull() & (F.length("text") > 0))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return None
    languages = sorted(counts)
    shares = documents.sparkSession.createDataFrame(
        [(name, min(1 << 30, int(sample_documents / n * (1 << 30)) + 1)) for name, n in counts.items()], "lang string, share long"
    )
    # One small row a language.
    drawn = rows.join(F.broadcast(shares), "lang").where(F.pmod(F.xxhash64("key", F.lit(SEED)), F.lit(1 << 30)) < F.col("share"))
    drawn = drawn.select(F.xxhash64("key").alias("key"), "lang", "text")
    sampled = drawn.mapInPandas(_sampled(sample_runs), "key long, lang string, runs binary")
    # However many rows have a key, one of them is enough.
    sample = sampled.groupBy("key", "lang").agg(F.min("runs").alias("runs")).collect()
    pairs = sorted((bytes(run), languages.index(r["lang"])) for r in sample for run in bytes(r["runs"]).split(b" "))
    if not pairs:
        return None
    model = BiGRU(languages)
    model.fit([run for run, _ in pairs], [number for _, number in pairs])
    return model


_memory: dict[str, object] = {}


class Predictor:
    """A model with the runs that a worker has seen."""

    def __init__(self, model: BiGRU):
        self.model = model
        self.numbers: dict[bytes, int] = {}
        self.sums = np.zeros((0, len(model.languages)), dtype=np.float32)

    def documents(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and probability of each text."""
        numbers, flat, sizes, fresh = self.numbers, [], [], []
        if len(numbers) > RUNS_KEPT:
            numbers.clear()
            self.sums = self.sums[:0]
        for text in texts:
            runs = runs_of(text) if has_letter(text) else []
            found = [numbers.get(run) for run in runs]
            if None in found:
                for i, known in enumerate(found):
                    if known is None:
                        run = runs[i]
                        known = numbers.get(run)
                        if known is None:
                            known = numbers[run] = len(numbers)
                            fresh.append(run)
                        found[i] = known
            flat.append(np.array(found, dtype=np.int64))
            sizes.append(len(found))
        if fresh:
            self.sums = np.concatenate([self.sums, self.model.pooled(fresh)])
        langs, scores = [], []
        for found, size in zip(flat, sizes):
            if not size:
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            logits = self.sums[found].sum(axis=0, dtype=np.float64) / SOFTEN
            weights = np.exp(logits - logits.max())
            best = int(weights.argmax())
            langs.append(self.model.languages[best])
            scores.append(float(weights[best] / weights.sum()))
        return langs, scores


def _predict(shared, name: str):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if name not in _memory:
            _memory.clear()
            _memory[name] = Predictor(pickle.loads(shared.value)) if shared.value else None
        predictor = _memory[name]
        for batch in batches:
            langs, scores = [], []
            for low in range(0, len(batch), 2000):
                part = batch.iloc[low : low + 2000].tolist()
                done = predictor.documents(part) if predictor else ([UNKNOWN] * len(part), [0.0] * len(part))
                langs += done[0]
                scores += done[1]
            yield pd.DataFrame({"lang_pred": langs, "score": scores})

    return F.pandas_udf(run, "lang_pred string, score double")


def predict(documents: DataFrame, model: BiGRU | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Language of every whole text: ``key``, ``held_out``, ``lang_pred``, ``score`` (0 to 1).

    Texts that are null or have no letter are ``und`` with score 0, and so is all without a model. Null keys count as
    not held out; repeated rows are kept. An empty table gives no rows. Only the text decides.
    """
    spark = documents.sparkSession
    prepare(spark)
    packed = pickle.dumps(model) if model is not None else b""
    shared = spark.sparkContext.broadcast(packed)
    rows = documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    name = f"{zlib.crc32(packed)}-{len(packed)}"
    done = rows.select("key", _predict(shared, name)("text").alias("found"))
    return done.select(F.col("key").alias(key), held_out(F.col("key")).alias("held_out"), "found.lang_pred", "found.score")


def learned_bytes(model: BiGRU) -> np.ndarray:
    """Which of the 256 bytes training has met: the input weights of all others are still as they were drawn."""
    return (model.w["xf"] != BiGRU(model.languages, model.hidden).w["xf"]).any(axis=1)


def _letter_shares(model: BiGRU, learned: np.ndarray, runs: list[bytes]) -> np.ndarray:
    """Sum over the letter positions of each run of its probabilities; bytes never met have none."""
    out = np.zeros((len(runs), len(model.languages)), dtype=np.float32)
    lengths = np.array([len(run) for run in runs])
    for length in np.unique(lengths):
        members = np.flatnonzero(lengths == length)
        for i in range(0, len(members), 4096):
            part = members[i : i + 4096]
            codes = _codes([runs[j] for j in part])
            logs, _ = model.labels(codes)
            out[part] = (np.exp(logs[:, 1:-1]) * learned[codes[:, 1:-1], None]).sum(axis=1)
    return out


class Recogniser:
    """How well the best language fits: the mean over all letter bytes of a text of that language's probability.

    Unlike a probability of the whole text this does not grow with its length, so what belongs to no learned language
    stays near chance however long it is. Bytes of alphabets that training has not met count as 0. The runs that a worker
    has seen are remembered.
    """

    def __init__(self, model: BiGRU):
        self.model = model
        self.learned = learned_bytes(model)
        self.places: dict[bytes, int] = {}
        self.shares = np.zeros((0, len(model.languages)), dtype=np.float32)

    def fits(self, texts: list[str | None]) -> list[float]:
        """From 0 to 1 for each text; 0 without letters."""
        if len(self.places) > RUNS_KEPT:
            self.places.clear()
            self.shares = self.shares[:0]
        split = [runs_of(text) if has_letter(text) else [] for text in texts]
        fresh = [run for run in dict.fromkeys(run for runs in split for run in runs) if run not in self.places]
        if fresh:
            self.places.update(zip(fresh, range(len(self.places), len(self.places) + len(fresh))))
            self.shares = np.concatenate([self.shares, _letter_shares(self.model, self.learned, fresh)])
        found = []
        for runs in split:
            sums = self.shares[[self.places[run] for run in runs]].sum(axis=0, dtype=np.float64) if runs else np.zeros(1)
            found.append(float(sums.max()) / max(1, sum(map(len, runs))))
        return found


def _fit(shared, name: str):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if name not in _memory:
            _memory.clear()
            _memory[name] = Recogniser(pickle.loads(shared.value))
        for batch in batches:
            texts = batch.tolist()
            yield pd.Series([fit for low in range(0, len(texts), 2000) for fit in _memory[name].fits(texts[low : low + 2000])], dtype=float)

    return F.pandas_udf(run, "double")


def accepted(documents: DataFrame, model: BiGRU | None, least: float, text: str = "text") -> DataFrame:
    """The rows whose best language has at least this mean probability over the letter bytes; all rows without a model.

    Null texts and texts without letters go when ``least`` is above 0. Repeated rows and all columns are kept.
    """
    if model is None:
        return documents
    spark = documents.sparkSession
    prepare(spark)
    packed = pickle.dumps(model)
    shared = spark.sparkContext.broadcast(packed)
    name = f"fit {zlib.crc32(packed)}-{len(packed)}"
    return documents.where(_fit(shared, name)(F.col(text).cast("string")) >= least)
