from __future__ import annotations

import base64
import hashlib
import random
from array import array

import public_tokenizers
import pytest
import tiktoken

from pluvio.llm import bpe, queries

RAW = bpe.load_ranks(public_tokenizers.path(queries.RANKS))


@pytest.fixture(scope="module")
def peer():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, RAW.splitlines())}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: array("I", own.encode_ordinary(text or "")).tobytes()


def test_tree_equals_library_with_tiny_leaves(monkeypatch, peer):
    monkeypatch.setattr(bpe, "LEAF_CHARS", 7)
    monkeypatch.setattr(bpe, "LEAF_BYTES", 5)
    monkeypatch.setattr(bpe, "LEAF_IDS", 3)
    codec, draw = bpe.Codec(RAW, public_tokenizers.PATTERN), random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "'", "'s", "'ll", "'l", "é", "1", "12", "!", "the", "ing", "日", "\t", "🙂", "s", "re"]
    for _ in range(3000):
        text = "".join(draw.choices(parts, k=draw.randint(0, 60)))
        assert codec.encode(text) == peer(text), repr(text)
        assert codec.decode(codec.encode(text)) == text.encode()
    for text in ("a" * 4000, "th" * 1500, " " * 999 + "x", "ab" * 700 + "c", "éè" * 300):
        assert codec.encode(text) == peer(text)


def test_vocabulary_that_does_not_reach_its_tokens_is_refused():
    lines = [base64.b64encode(bytes([i])) + b" %d" % i for i in range(256)] + [base64.b64encode(b"abc") + b" 256"]
    with pytest.raises(ValueError, match="do not encode to themselves"):
        bpe.Codec(b"\n".join(lines), public_tokenizers.PATTERN)


def test_query_on_awkward_documents(awkward, no_docs, as_tables, spark, peer):
    folder, _ = as_tables(documents=awkward)
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op1_bpe(spark, folder).collect())
    expected = []
    for row in awkward.select("doc_id", "text").collect():
        ids = peer(row.text)
        expected.append((str(row.doc_id), len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((row.text or "").encode()).hexdigest()))
    assert got == sorted(expected)
    assert bpe.encode(no_docs, RAW, public_tokenizers.PATTERN).count() == 0
