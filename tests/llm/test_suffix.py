from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from pluvio.llm import queries, suffix


def removed(texts: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """By brute force: the spans of every text."""
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    return [suffix.union([(i, i + length) for i in range(len(t) - length + 1) if seen[t[i : i + length]] > 1]) for t in texts]


@pytest.mark.parametrize("length", [3, 8, 20])
def test_shard_equals_brute_force(length):
    draw = random.Random(length)
    for _ in range(60):
        letters = draw.choice([b"ab", b"abc", b"abcdefgh"])
        texts = [bytes(draw.choices(letters, k=draw.randint(length, 60))) for _ in range(draw.randint(1, 8))] + [b"a" * draw.randint(length, 90)]
        got = [suffix.union([(a, b + length - 1) for a, b in suffix.runs(m)]) for m in suffix.repeated_windows(texts, length)]
        assert got == removed(texts, length)


def test_equal_windows_have_equal_names():
    draw = random.Random(2)
    shared = bytes(draw.choices(b"abcdef ", k=400))
    names = []
    for text in (b"x" * 50 + shared + b"tail" * 60, bytes(draw.choices(b"qrs", k=333)) + shared):
        name, first, many, _ = suffix.segments(text)
        assert first[0] == 0 and many.sum() == len(text) - 199 and (first[1:] == first[:-1] + many[:-1]).all()
        start = text.index(shared)
        names.append(np.repeat(name, many)[start : start + 201])
    assert (names[0] == names[1]).all()


def test_texts_beyond_one_step(monkeypatch):
    text = bytes(random.Random(1).choices(b"abc ", k=3000))
    whole = np.repeat(*suffix.segments(text)[::2])
    monkeypatch.setattr(suffix, "_STEP", 700)
    assert (np.repeat(*suffix.segments(text)[::2]) == whole).all()


def check(spark, frame, folder):
    texts = [(r.text or "").encode() for r in frame.select("text").collect()]
    expected = []
    for row, spans in zip(frame.select("doc_id", "text").collect(), removed(texts, 200)):
        text = (row.text or "").encode()
        rest = suffix.kept(text, spans)
        expected.append(str((row.doc_id, len(text), len(text) - len(rest), len(spans), hashlib.sha256(rest).hexdigest())))
    got = [str((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in queries.op5_repeats(spark, folder).collect()]
    assert sorted(got) == sorted(expected)


@pytest.mark.parametrize("shard", [1 << 20, 600])
def test_query_equals_brute_force(spark, awkward, as_tables, monkeypatch, shard):
    monkeypatch.setattr(suffix, "SHARD", shard)  # 600: nearly every name is spread over several shards
    folder, _ = as_tables(documents=awkward)
    check(spark, awkward, folder)


def test_filter_keeps_columns_and_whole_characters(spark, awkward, no_docs):
    cut = suffix.without_repeats(awkward)
    assert cut.columns == awkward.columns and cut.count() == awkward.count()
    rows = {r.doc_id: r for r in cut.collect() if r.doc_id is not None}
    assert rows[0].text == "" and rows[5].text is None and rows[14].text == "one" and rows[10].text == ""
    assert rows[-5].text and rows[-5].n_chars == len(rows[-5].text)
    assert suffix.without_repeats(no_docs).count() == 0
