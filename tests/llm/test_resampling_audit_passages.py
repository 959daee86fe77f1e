"""Importance resampling, the filter audit and substring dedup against brute force, and on odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarryline.llm import filter_audit, repeated_passages, resampling
from quarryline.llm.word_bytes import NOT_BLANK, slices

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, key string, score string, row string, part string"
ODD = ["", None, " \t\n", "x" * 30_000, "ß漢😀 é\x1c\x00 a\xa0b", "Zwölf BOXKÄMPFER jagen", "a " * 3000, "\x0b\x0c\r", "q" * 49 + " " + "q" * 48]


def documents(spark, rows):
    """Rows (doc_id, text, source) as documents with more columns of clashing names."""
    full = [(i, t, "en", s, 0, "k", "s", "r", "p") for i, t, s in rows]
    return spark.createDataFrame(full, DOCUMENTS)


def some_rows(count, seed, words="alpha beta Gamma delta 12 $x"):
    rng = random.Random(seed)
    texts = [" ".join(rng.choices(words.split(), k=rng.randint(0, 60))) for _ in range(count)]
    texts += rng.choices(texts, k=count // 4) + ODD * 2
    ids = [rng.choice([None, rng.randrange(3 * count)]) if rng.random() < 0.2 else i for i in range(len(texts))]
    sources = [rng.choice(["hot", "hot", "b", None, ""]) for _ in texts]
    # Repeated rows, and one key with different texts.
    rows = list(zip(ids, texts, sources))
    return rows + rows[:5] + [(3, "one", "hot"), (3, "two", "hot")]


def test_words_of_slices():
    texts = [*ODD, "a b", " a  b ", None, "\n"]
    for size in (1, 40, 1 << 20):
        found = []
        for part in slices(pa.array(texts), NOT_BLANK, size):
            words = [part.data[s:e].tobytes().decode() for s, e in zip(part.starts, part.ends)]
            found += [words[low:high] for low, high in zip(part.first_word, part.first_word[1:])]
        assert found == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]


# Resampling


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def features(text, longest):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def drawn(rows, targets, buckets, longest, least, percent, seed):
    def tally(texts):
        found = Counter()
        for text in texts:
            found.update(zlib.crc32(f.encode()) % buckets for f in features(text, longest)[1])
        return found

    s, t = tally(text for _, text, _ in rows), tally(targets)
    every_s, every_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (every_s + buckets) / ((s[b] + 1) * (every_t + buckets)))) for b in range(buckets)]
    scored = []
    for key, text, _ in rows:
        words, found = features(text, longest)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append([key, len(found), weight, weight + noise, None, len(words) >= least])
    able = sorted((r for r in scored if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, row in enumerate(able[: len(able) * percent // 100], 1):
        row[4] = place
    return [tuple(r[:5]) for r in scored]


@pytest.mark.parametrize(("buckets", "longest", "percent", "segment"), [(10_000, 1, 10, 1 << 20), (50, 3, 60, 7), (1, 2, 100, 3)])
def test_resampling_is_brute_force(spark, buckets, longest, percent, segment):
    rows, targets = some_rows(250, 4), ["beta beta gamma", None, "", "12 DELTA"]
    frame = resampling.resample(
        documents(spark, rows), spark.createDataFrame([(t,) for t in targets], "text string"),
        buckets=buckets, longest=longest, least_words=5, percent=percent, segment_rows=segment,
    )
    assert frame.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {f.dataType.simpleString() for f in frame.schema} == {"bigint"}
    # Ranks of rows with equal key and score are settled by nothing else, so compare them apart.
    ours = [tuple(r) for r in frame.collect()]
    wanted = drawn(rows, targets, buckets, longest, 5, percent, 2024)
    by = lambda r: repr(r)
    assert sorted((r[:4] for r in ours), key=by) == sorted((r[:4] for r in wanted), key=by)
    ranked = lambda found: sorted((r[4], r[3], r[0]) for r in found if r[4] is not None)
    assert [(r[0], r[1]) for r in ranked(ours)] == [(r[0], r[1]) for r in ranked(wanted)]
    unique = {k for k, n in Counter(r[0] for r in ours).items() if n == 1}
    pick = lambda found: {r[0]: r for r in found if r[0] in unique}
    assert pick(ours) == pick(wanted)


def test_one_key_and_score_for_all_rows(spark):
    scored = spark.range(500).select(F.lit(7).cast("long").alias("key"), F.lit(1).cast("long").alias("score"), F.lit(True).alias("able"))
    ranks = sorted(r["rank"] for r in resampling.draw(scored, 50, segment_rows=20).collect() if r["rank"] is not None)
    assert ranks == list(range(1, 251))


def test_resampling_without_rows(spark):
    empty = documents(spark, [])
    assert resampling.resample(empty, empty.select("text")).count() == 0
    assert resampling.resample(documents(spark, some_rows(9, 1)), empty.select("text")).where("rank is not null").count() <= 2


# Filter audit


def audited(rows, labels):
    first = {}
    for key, text, _ in rows:
        if key is not None:
            first[text or ""] = min(key, first.get(text or "", key))
    counts = Counter()
    for key, text, source in rows:
        whole = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", whole)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", whole)) > 2 * len(whole),
            "D": re.search("[#$%&*|]", whole) is not None,
            "E": whole in first and (key is None or key > first[whole]),
        }
        marks = [m for m in labels if m[0] == key and key is not None]
        counts[source or "", frozenset(f for f in fails if fails[f]), any(m[1] == 1 for m in marks), any(m[2] == 1 for m in marks)] += 1
    for part in {kind[0] for kind in counts}:
        own = {kind[1:]: n for kind, n in counts.items() if kind[0] == part}
        lines, total = [], Counter()
        for order in permutations("ABCDE"):
            for step, name in enumerate(order, 1):
                before = set(order[: step - 1])
                hit = lambda k: name in k[0]  # noqa: E731, B023
                gone = lambda k: bool(k[0] & before)  # noqa: E731, B023
                count = lambda test: sum(n for k, n in own.items() if test(k))  # noqa: E731, B023
                removed = count(lambda k: hit(k) and not gone(k))  # noqa: B023
                total[name] += removed
                lines.append((
                    part, "".join(order), step, count(lambda k: not hit(k) and not gone(k)), removed, count(lambda k: hit(k) and gone(k)),  # noqa: B023
                    count(lambda k: k[0] == {name}), count(lambda k: hit(k) and not gone(k) and k[1]), count(lambda k: hit(k) and not gone(k) and k[2]),  # noqa: B023
                ))
        yield from ((*line, total[line[1][line[2] - 1]]) for line in lines)


def test_audit_is_every_order_played_out(spark):
    rng = random.Random(2)
    rows = some_rows(60, 9) + [(900 + i, " ".join(f"w{rng.randrange(400)}" for _ in range(230)), "b") for i in range(6)]
    rows += [(950, rows[-1][1], "hot"), (None, rows[-1][1], "hot"), (960, "A" * 300, None)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 80)] + [(1, 1, 0), (None, 1, 1), (99_999, 1, 1)]
    frame = filter_audit.audit(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert frame.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(tuple(r) for r in frame.collect()) == sorted(audited(rows, labels))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(documents(spark, []), none).count() == 0
    assert filter_audit.audit(documents(spark, rows[:3]), none).agg(F.sum("good_lost")).first()[0] == 0


def test_potentials_are_shapley_values(spark):
    """Marginal gains averaged over all orders, for a game that is no count of documents."""
    rng = random.Random(6)
    worth = [0] + [rng.randrange(1000) for _ in range(31)]
    found = spark.range(1).select(filter_audit._potentials(F.array(*(F.lit(w).cast("long") for w in worth))).alias("q")).first()["q"]
    for i in range(5):
        gain = 0
        for order in permutations(range(5)):
            before = sum(1 << j for j in order[: order.index(i)])
            gain += worth[before | 1 << i] - worth[before]
        assert found[31] - 5 * found[31 - (1 << i)] == gain


# Substring dedup


def stripped(rows, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text, _ in rows]
    places = {}
    for at, own in enumerate(words):
        for start in range(len(own) - window + 1):
            places.setdefault(tuple(own[start : start + window]), []).append((at, start))
    gone = {(at, start + i) for found in places.values() if len(found) > 1 for at, start in found for i in range(window)}
    for at, (key, _, _) in enumerate(rows):
        kept = [w for i, w in enumerate(words[at]) if (at, i) not in gone]
        yield key, len(words[at]), len(words[at]) - len(kept), " ".join(kept)


def passages(count, seed, letters):
    """Texts pasted together from few passages, with single words between, so that repeats start and end anywhere."""
    rng = random.Random(seed)
    stock = [[rng.choice(letters) for _ in range(rng.randint(1, 60))] for _ in range(count // 2)]
    texts = []
    for _ in range(count):
        own = []
        for _ in range(rng.randint(0, 4)):
            piece = rng.choice(stock)
            low = rng.randrange(len(piece))
            own += piece[low : low + rng.randint(1, 60)] + [rng.choice(letters) for _ in range(rng.randint(0, 2))]
        texts.append("  ".join(own))
    return texts


@pytest.mark.parametrize("window", [1, 2, 3, 4, 5, 8, 13, 35])
@pytest.mark.parametrize("letters", ["ab", [f"w{i}" for i in range(500)]], ids=["two words", "many words"])
def test_passages_are_brute_force(spark, window, letters):
    rng = random.Random(window)
    texts = passages(60, window, letters) + ODD * 2 + ["z " * 34, "y " * 35, "x " * 36 + "é" * 60]
    rows = [(rng.choice([i, i, None, 5]), text, "a") for i, text in enumerate(texts)]
    rows += rows[:3]
    frame = repeated_passages.without_repeats(documents(spark, rows), window=window)
    assert frame.columns == ["doc_id", "n_words", "n_removed", "kept"]
    assert sorted((tuple(r) for r in frame.collect()), key=repr) == sorted(stripped(rows, window), key=repr)


def test_passages_without_rows_and_with_text_keys(spark):
    assert repeated_passages.without_repeats(documents(spark, [])).count() == 0
    frame = spark.createDataFrame([("a", "u v w"), ("b", "x u v"), (None, None)], "name string, body string")
    found = repeated_passages.without_repeats(frame, key="name", text="body", window=2)
    assert {tuple(r) for r in found.collect()} == {("a", 3, 2, "w"), ("b", 3, 2, "x"), (None, 0, 0, "")}
    with pytest.raises(ValueError):
        repeated_passages.without_repeats(frame, key="name", text="body", window=0)


def test_window_hashes_tell_windows_apart():
    """No two different windows of a long random text share both hashes, and equal ones always do."""
    rng = np.random.default_rng(1)
    text = " ".join(rng.choice(["a", "b", "c"], 20_000))
    part = next(slices(pa.array([text]), NOT_BLANK))
    codes, words = repeated_passages.Codes(part), text.split()
    for length in (9, 18, 35):
        pairs = list(zip(codes.of(length, 0).tolist(), codes.of(length, 1).tolist()))
        spelled = [tuple(words[i : i + length]) for i in range(len(words) - length + 1)]
        assert len(pairs) == len(spelled) and len(set(zip(pairs, spelled))) == len(set(pairs)) == len(set(spelled))
