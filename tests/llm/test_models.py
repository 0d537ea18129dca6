"""Toxicity and language: parts against brute force, results by held-out accuracy."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvio.llm import language, queries, toxicity

MIDDLE, LARGER = "/root/testdata/sf0.01", "/root/testdata/sf0.1"


def test_nearest_examples_are_exact():
    draw = np.random.default_rng(6)
    idf = draw.random(40) + 0.1
    vectors = []
    for i in range(700):
        terms = sorted(draw.choice(40, draw.integers(0, 8), replace=False).tolist())
        vectors.append((i, int(draw.random() < 0.3), terms, draw.integers(1, 5, len(terms)).tolist()))
    index = toxicity.Index(vectors, idf, {0: 1.0, 1: 1.0})
    dense = np.zeros((len(index.keys), 40))
    by_key = {v[0]: v for v in vectors}
    for place, key in enumerate(index.keys):
        terms, weights = index.weigh(*by_key[key][2:])
        dense[place, terms] = weights
    for _, _, terms, counts in vectors[:80]:
        t, w = index.weigh(terms, counts)
        scores = dense[:, t] @ w if len(t) else np.zeros(len(dense))
        best = sorted(((-s, p) for p, s in enumerate(scores) if s > 1e-12))[: toxicity.K]
        got = index.nearest(t, w)
        assert np.allclose([s for s, _ in got], [-s for s, _ in best])
        assert index.score(terms, counts)["score"] <= 1.0


def test_toxicity_held_out(spark):
    scored = queries.op6_toxicity(spark, LARGER)
    assert scored.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = scored.join(spark.read.parquet(f"{LARGER}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    clean = [r.score for r in rows if r.held_out and not r.toxic]
    toxic = [r.score for r in rows if r.held_out and r.toxic]
    above = np.mean([[(t > c) + (t == c) / 2 for c in clean] for t in toxic])
    assert above > 0.95 and np.mean([t >= 0.5 for t in toxic]) > 0.85 and np.mean([c >= 0.5 for c in clean]) < 0.02


def test_toxicity_awkward(spark, awkward, no_docs):
    labels = spark.createDataFrame([(0, 1), (0, None), (3, 0), (None, 1), (14, 1), (99, 0), (12, 0), (12, 1)], "doc_id bigint, toxic int")
    scored = toxicity.score(awkward, labels, F.lit(True))
    assert scored.count() == awkward.count() and scored.where("toxicity.score is null or not toxicity.score between 0 and 1").count() == 0
    assert toxicity.score(awkward, labels.where("false"), F.lit(True)).agg(F.max("toxicity.score")).first()[0] == 0.0
    assert toxicity.score(no_docs, labels, F.lit(True)).count() == 0


def test_gradients():
    network = language.Network(["a", "b", "c"], hidden=3)
    x, y = np.frombuffer(b"abcabd", np.uint8).reshape(2, 3), np.array([0, 2])
    _, gradients = network.gradients(x, y)
    for name, values in network.parameters().items():
        place = np.unravel_index(np.abs(gradients[name]).argmax(), values.shape)
        held = values[place]
        losses = []
        for step in (1e-2, -1e-2):
            values[place] = held + step
            losses.append(network.gradients(x, y)[0])
        values[place] = held
        assert gradients[name][place] == pytest.approx((losses[0] - losses[1]) / 2e-2, rel=0.05)


def test_every_position_is_labelled():
    network = language.Network(["a", "b"], hidden=3)
    text = "one " + "x" * 100 + " é"
    labelled = network.label(text)
    assert b"".join(piece for piece, _ in labelled) == text.replace(" ", "").encode()
    assert all(len(piece) == len(labels) <= language.PIECE for piece, labels in labelled)
    # Pooling remembers pieces: the answer does not depend on what else was seen.
    pooler = language.Pooler(network)
    alone = pooler.predict([text])
    assert language.Pooler(network).predict(["one two", text, None])[1] == alone[0]


def test_language_held_out(spark):
    found = queries.op7_language(spark, MIDDLE).join(spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_language_awkward(spark, awkward, no_docs, monkeypatch):
    monkeypatch.setattr(language, "EPOCHS", 1)
    network = language.fit(awkward, F.lit(True))
    assert network.languages == ["de", "en", "fr"]
    rows = {r.doc_id: r.language for r in language.predict(awkward.select("doc_id", "text"), network).collect()}
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 for i in (4, 5, 6, 7))
    assert rows[9].lang_pred in network.languages and rows[8].lang_pred in network.languages
    empty = language.fit(no_docs, F.lit(True))
    assert {r.language.lang_pred for r in language.predict(awkward.select("text"), empty).collect()} == {"und"}
    assert language.predict(no_docs.select("text"), network).count() == 0
