"""The pipeline's stages, each on its own input."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quarryline.llm import language_id

FOREIGN = [
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
    "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
    "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。",
]


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_stages(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["quality"](spark, docs, folder)
    assert clean.columns == docs.columns
    good, bad = labels.where("quality = 1"), labels.where("quality = 0")
    assert clean.join(good, "doc_id").count() >= 0.97 * docs.join(good, "doc_id").count()
    assert clean.join(bad, "doc_id").count() <= 0.2 * docs.join(bad, "doc_id").count()
    known = stages["language"](spark, docs, folder)
    assert known.columns == docs.columns and known.count() >= 0.99 * docs.count()
    single = stages["near_copies"](spark, docs, folder)
    assert single.columns == docs.columns
    texts = {r["doc_id"]: shingles(r["text"]) for r in docs.collect()}
    kept = {r[0] for r in single.select("doc_id").collect()}
    by_shingle = {}
    for doc, parts in texts.items():
        for part in parts:
            by_shingle.setdefault(part, []).append(doc)
    # Of two texts of similarity 0.8 only one stays, and whatever goes is as similar to another text.
    for doc in texts:
        others = {other for part in texts[doc] for other in by_shingle[part]} - {doc}
        similar = [len(texts[doc] & texts[o]) / len(texts[doc] | texts[o]) for o in others if doc in kept and o in kept]
        assert max(similar, default=0) < 0.8
        if doc not in kept:
            assert max((len(texts[doc] & texts[o]) / len(texts[doc] | texts[o]) for o in others), default=not texts[doc]) >= 0.8
    packed = stages["packing"](spark, docs, folder)
    assert packed.agg({"size": "sum"}).first()[0] == docs.agg({"n_chars": "sum"}).first()[0]


def test_run(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_copies", "packing"]


def test_unlearned_languages_go(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet")
    model = language_id.train(docs)
    rng = random.Random(3)
    kana = " ".join("".join(rng.choice("あいうえおかきくけこさしすせそ") for _ in range(5)) for _ in range(80))
    texts = [*FOREIGN, kana, FOREIGN[0] * 500, "12 . ?", "", None]
    frame = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "doc_id long, text string")
    assert language_id.accepted(frame, model, corpus_pipeline.LEAST_LANGUAGE_FIT).count() == 0
    kept = language_id.accepted(docs, model, corpus_pipeline.LEAST_LANGUAGE_FIT)
    assert kept.count() >= 0.99 * docs.where(F.col("text").rlike("[A-Za-z]")).count()
    assert language_id.accepted(docs.limit(0), model, 0.4).count() == 0


def test_remembered_runs_equal_a_plain_pass(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language_id.train(docs)
    texts = [r["text"] for r in docs.select("text").collect()] + FOREIGN + [None, "", "x" * 70]
    learned = language_id.learned_bytes(model)
    assert learned[ord("e")] and not learned[0xE3]
    fits = language_id.Recogniser(model).fits(texts)
    langs, scores = language_id.Predictor(model).documents(texts)
    for text, fit, lang, score in zip(texts, fits, langs, scores):
        runs = language_id.runs_of(text) if language_id.has_letter(text) else []
        if not runs:
            assert (fit, lang, score) == (0.0, language_id.UNKNOWN, 0.0)
            continue
        labels = np.concatenate([model.labels(language_id._codes([run]))[0][0, 1:-1] for run in runs]).astype(float)
        met = learned[np.frombuffer(b"".join(runs), dtype=np.uint8)]
        assert fit == pytest.approx((np.exp(labels) * met[:, None]).mean(axis=0).max(), abs=1e-4)
        pooled = labels.sum(axis=0) / language_id.SOFTEN
        weights = np.exp(pooled - pooled.max())
        assert score == pytest.approx(weights.max() / weights.sum(), abs=1e-3)
        if weights.max() / weights.sum() > 0.6:
            assert lang == model.languages[int(weights.argmax())]


def test_stages_on_odd_rows(spark, sf_dir):
    """Null, empty, very long and repeated texts, null keys, an empty table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = docs.where("length(text) > 200").first()["text"]
    odd = [(None, text), (-1, None), (-2, ""), (-3, text * 400), (-4, text), (-4, text), (None, None)]
    columns = [F.lit(None).cast(kind).alias(name) for name, kind in docs.dtypes if name not in ("doc_id", "text")]
    rows = spark.createDataFrame(odd, "doc_id long, text string").select("doc_id", "text", *columns).select(docs.columns)
    frame = docs.unionByName(rows)
    for name, stage in corpus_pipeline.STAGES:
        done = stage(spark, frame, sf_dir)
        empty = stage(spark, docs.limit(0), sf_dir)
        assert empty.count() == 0
        if name != "packing":
            assert done.columns == docs.columns and empty.columns == docs.columns
            assert done.count() == done.intersectAll(frame).count()
        else:
            whole = frame.agg(F.sum(F.coalesce(F.length("text"), F.lit(0)))).first()[0]
            assert done.agg(F.sum("size")).first()[0] == whole
            pieces = done.groupBy("bin_id").agg(F.sum("size").alias("used"))
            assert pieces.where("used > 8192").count() == 0
        if name == "language":
            assert done.where("text IS NULL OR text = ''").count() == 0
            assert done.where(F.col("doc_id") == -4).count() == 2
