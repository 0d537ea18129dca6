"""The stages, each judged on its own input."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from pluvio.llm import chosen_path, suffix
from pluvio.llm.common import staged
from pluvio.llm.decontaminate import words

SMALL = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, states = docs.columns, [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SMALL), name)
        states.append(docs.collect())
        assert docs.columns == columns or name == "tokens"
    start, good, single, cut, clean, coded = states
    good_ids = {r.doc_id for r in good}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    assert all(labels.get(r.doc_id) != 1 for r in start if r.doc_id not in good_ids)
    # Near duplicates: who goes is linked to someone smaller; who stays is linked to nobody that stays.
    sets = {r.doc_id: set(chosen_path.shingles(r.text).tolist()) for r in good}
    near = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    stay = {r.doc_id for r in single}
    assert not any(near(a, b) for a in stay for b in stay if a < b)
    assert all(any(near(a, b) for b in good_ids - {a}) for a in good_ids - stay)
    # Repeats: the same cut by brute force.
    texts = [r.text.encode() for r in single]
    seen: dict[bytes, int] = {}
    for t in texts:
        for i in range(len(t) - 199):
            seen[t[i : i + 200]] = seen.get(t[i : i + 200], 0) + 1
    after = {r.doc_id: r for r in cut}
    for row, t in zip(single, texts):
        rest = suffix.kept(t, suffix.union([(i, i + 200) for i in range(len(t) - 199) if seen[t[i : i + 200]] > 1])).decode("utf-8", "ignore")
        assert after[row.doc_id].text == rest and after[row.doc_id].n_chars == (len(rest) if len(rest) != len(row.text) else row.n_chars)
    # Benchmark: windows of thirteen words.
    windows = set()
    for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect():
        w = words(r.text)
        n = min(13, len(w))
        windows |= {tuple(w[i : i + n]) for i in range(len(w) - n + 1) if n}
    sizes = {len(w) for w in windows}
    kept = {r.doc_id for r in clean}
    for r in cut:
        w = words(r.text)
        hit = {p for n in sizes for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in windows for p in range(i, i + n)}
        assert (r.doc_id in kept) == (not hit or 20 * len(hit) < len(w))
    assert {r.doc_id: r.decoded_sha256 for r in coded} == {r.doc_id: hashlib.sha256(r.text.encode()).hexdigest() for r in clean}


def test_registered(spark):
    names = set(__spark_entry__.queries())
    assert {f"op{n}_" for n in range(1, 11)} <= {x.split("_")[0] + "_" for x in names if x.startswith("op")} and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= names


def test_awkward_documents_pass_every_stage(spark, awkward, no_docs):
    for docs in (awkward, no_docs):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = staged(stage(spark, docs, SMALL), name)
            assert docs.columns == columns or name == "tokens"
    assert docs.select(F.count("*")).first()[0] == 0
