from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvio.llm import lexical, queries
from tests.llm.conftest import prose, same_rows


@pytest.fixture(scope="module")
def items(spark):
    long = " ".join(f"word{i % 977}" for i in range(3000))
    rows = [(1, prose(1, 40)), (2, "one"), (3, ""), (4, None), (5, prose(9, 13)), (5, prose(2, 5)), (6, "AB ab"), (7, "nowhere"), (8, "ONE"), (None, prose(7, 9)), (9, long), (10, "é x\x00日本語"), (11, "!!!")]
    return spark.createDataFrame([(*r, 7, "z") for r in rows], "item_id bigint, text string, rank int, score string")


def ranked(frame):
    return sorted(map(str, frame.collect()))


def test_query_equals_sql_on_awkward_documents(spark, awkward, items, as_tables):
    folder, database = as_tables(documents=awkward, benchmark=items)
    assert same_rows(queries.op13_lexical_search(spark, folder), database.sql(queries.OP13_SQL))


def test_blocks_give_the_same_ranks(spark, awkward, items):
    whole = ranked(lexical.rank(awkward, items))
    assert whole == ranked(lexical.rank(awkward, items, pairs=20)) and len(whole) > 20


def test_vocabulary_beyond_the_broadcast_bound_is_joined(spark, awkward, items, monkeypatch):
    whole = ranked(lexical.rank(awkward, items))
    monkeypatch.setattr(lexical, "BYTES", 10)
    monkeypatch.setattr(lexical, "PIECE", 50)
    assert whole == ranked(lexical.rank(awkward, items))


def test_ties_go_by_id_and_null_last(spark):
    docs = spark.createDataFrame([(3, "a b"), (None, "a b"), (1, "a b"), (2, "b a"), (1, "a b"), (4, "c")], "doc_id bigint, text string")
    items = spark.createDataFrame([("x", "a"), ("x", "a a")], "item_id string, text string")
    found = lexical.rank(docs, items, k=4).orderBy("rank").collect()
    assert [(r["item_id"], r["rank"], r["doc_id"]) for r in found] == [("x", 1, 1), ("x", 2, 1), ("x", 3, 2), ("x", 4, 3)]
    assert [r["doc_id"] for r in lexical.rank(docs, items).orderBy("rank").collect()] == [1, 1, 2, 3, None]


def test_empty_tables(spark, awkward, items, no_docs):
    assert lexical.rank(no_docs, items).count() == 0
    none = lexical.rank(awkward, items.where(F.lit(False)))
    assert none.count() == 0 and none.columns == ["item_id", "rank", "doc_id", "score"]


def test_graph_sums_as_every_query_alone_and_shares(spark):
    draw = random.Random(5)
    common = [draw.sample(range(60), 12) for _ in range(4)]
    asked = [sorted({*draw.choice(common), *draw.choice(common), *draw.sample(range(60), 3)}) for _ in range(50)]
    nodes, made = lexical.mine(asked)
    graph = lexical.Graph(60, nodes, made)
    values = np.array([[draw.randint(0, 10**6) for _ in range(8)] for _ in range(60)])
    places, columns = np.nonzero(values)
    got = graph.scores(places, columns, values[places, columns], 8)
    assert (got == np.array([values[q].sum(axis=0) for q in asked])).all()
    assert sum(map(len, nodes)) + sum(map(len, made)) < 0.7 * sum(map(len, asked))


def test_terms_of_long_texts_are_counted_in_pieces(monkeypatch):
    text = ("Alpha beta-9 É " * 50).encode()
    whole = lexical.term_counts(text)
    monkeypatch.setattr(lexical, "PIECE", 7)
    assert lexical.term_counts(text) == whole == {b"alpha": 50, b"beta": 50, b"9": 50, "É".encode(): 50}
