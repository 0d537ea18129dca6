from __future__ import annotations

import random
import zlib
from collections import defaultdict
from functools import cache

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pluvio.llm import packing, queries

RANKS = public_tokenizers.path(queries.PACKING_RANKS)
PATTERN, SPECIAL = public_tokenizers.PATTERN, queries.PACKING_SPECIAL


@pytest.fixture(scope="module")
def codec():
    return packing.Codec(packing.read_ranks(RANKS), PATTERN, SPECIAL)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check_pieces(rows, texts, tokenizer, full):
    """Every id in exactly one piece, sequences without gaps, digests of the tokenizer's own ids."""
    left, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        left[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= full
    wanted = defaultdict(list)
    for doc, text in texts:
        wanted[doc].append([*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END])
    assert set(left) == set(wanted)
    for doc, parts in left.items():
        cover = sorted((r["start"], r["length"], r["doc_tokens"], r["ids_crc32"]) for r in parts)
        if len(wanted[doc]) > 1:
            assert sum(r["length"] for r in parts) == sum(map(len, wanted[doc]))
            continue
        ids, at = wanted[doc][0], 0
        for start, length, total, crc in cover:
            assert (start, total) == (at, len(ids))
            assert crc == zlib.crc32(np.array(ids[at : at + length], "<u4").tobytes())
            at += length
        assert at == len(ids)


def test_query_on_awkward_documents(spark, awkward, as_tables, tokenizer):
    more = spark.createDataFrame(
        [(900 + i, t) for i, t in enumerate(["a<|endoftext|> b", "<|endoftext|>", "<|endoftext", "3.14 is. So!\n\nYes? x 　 y", "ab " * 3000])], "doc_id bigint, text string"
    )
    folder, _ = as_tables(documents=awkward.unionByName(more, allowMissingColumns=True))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = queries.op12_packing(spark, folder).collect()
    check_pieces(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], tokenizer, 1024)


def test_hardly_any_padding_and_order_is_kept(spark):
    draw = random.Random(3)
    texts = [" ".join(f"{' '.join(draw.choices(['one', 'other', 'thing', 'wonderful'], k=draw.randint(3, 20)))}." for _ in range(draw.randint(1, 60))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    pieces = packing.pack(docs, RANKS, PATTERN, SPECIAL)
    found = packing.padded(pieces).first()
    assert found["padding"] < 0.005 * found["tokens"]
    rows = pieces.orderBy("sequence_id", "offset").collect()
    assert [r["doc_id"] for r in rows] == sorted(r["doc_id"] for r in rows)


def test_cuts_cost_as_little_as_any(codec):
    full = 8
    for seed in range(300):
        draw = random.Random(seed)
        places = np.cumsum([draw.choice([1, 2, 3, 5, 9, 20]) for _ in range(draw.randint(1, 9))]).tolist()
        penalties = [draw.choice([0, packing.SENTENCE]) for _ in places]
        free = dict(zip(places, penalties, strict=True))

        @cache
        def least(q):
            if q == places[-1]:
                return 0
            ways = [packing.padding(p - q, full) + x + packing.SEQUENCE + least(p) for p, x in free.items() if q < p <= q + full]
            if q + full not in free and q + full < places[-1] and (q == 0 or q in free or not ways):
                ways.append(packing.INSIDE + packing.SEQUENCE + least(q + full))
            return min(ways)

        found = packing.cuts(places, penalties, full)
        cost = sum(packing.padding(b - a, full) + packing.SEQUENCE + free.get(b, packing.INSIDE) for a, b in zip(found, found[1:]))
        assert found[0] == 0 and found[-1] == places[-1] and cost == least(0)


def test_chunks_lose_nothing(codec):
    draw = random.Random(1)
    texts = ["word " * draw.choice([0, 1, 5, 40, 900]) + "end." for _ in range(60)]
    for chunk, left_open in ((50, 20), (300, 64), (10**6, 64)):
        stream = packing.Stream(codec, 32, chunk, left_open)
        pieces = [p for i, t in enumerate(texts) for p in stream.add(i, t)] + stream.close()
        for i, text in enumerate(texts):
            assert b"".join(p[6] for p in pieces if p[0] == i) == codec.ids(text).tobytes()
        assert [p[4] for p in pieces] == sorted(p[4] for p in pieces)


def test_long_texts_are_encoded_in_parts(codec, monkeypatch):
    text = "Some words, and 12 more  words\n\nof a TEXT. " * 40
    whole = codec.ids(text)
    monkeypatch.setattr(packing, "PIECE", 25)
    assert (codec.ids(text) == whole).all()
    assert (codec.ids("a" * 200) == codec.ids("a" * 200)).all()


def test_powers_need_no_padding():
    for n in range(1, 2200):
        steps = list(packing.powers(n))
        assert sum(steps) == n and all(packing.padding(s) == 0 and s <= 1024 for s in steps)


def test_empty_table_and_kept_columns(spark, no_docs, awkward):
    assert packing.pack(no_docs, RANKS, PATTERN, SPECIAL).count() == 0
    kept = packing.pack(awkward.select("text", "lang", "source"), RANKS, PATTERN, SPECIAL, keep=("lang", "source"))
    assert kept.columns[:2] == ["lang", "source"] and kept.agg(F.sum("length")).first()[0] > 0
