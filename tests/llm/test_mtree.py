from __future__ import annotations

import numpy as np

from pluvio.llm import mtree, queries
from tests.llm.conftest import same_rows


def test_tree_search_equals_brute_force():
    draw = np.random.default_rng(4)
    centres = draw.integers(-900, 900, (12, 8))
    vectors = centres[draw.integers(0, 12, 3000)] + draw.integers(-40, 40, (3000, 8))
    vectors[100:400] = vectors[100]  # many ties
    ids = draw.permutation(3000).astype(np.int64)
    tree = mtree.Tree(ids, vectors)
    for i in [100, 150, *range(0, 3000, 97)]:
        scores = vectors @ vectors[i]
        order = [j for j in np.lexsort((ids, -scores)) if j != i][:10]
        got = sorted(tree.search(vectors[i].astype(np.int64), 10, int(ids[i])), key=lambda x: (-x[0], x[1]))
        assert got == [(int(scores[j]), int(ids[j])) for j in order]


def test_query_equals_sql_on_awkward_vectors(spark, as_tables):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.25]), (100, [0.1, 0.2]), (100, [0.1, 0.2]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 0.0]), (5, []), (None, [1.0, 1.0]), (6, [0.5, -0.25]), (7, [0.5, -0.25]), (8, [-0.0001, 0.0001]), (9, [0.5]), (200, [0.5]), (10, [0.0, 0.0])]
    rows += [(1000 + i, [((i * 37) % 101) / 50 - 1, ((i * 53) % 97) / 48 - 1]) for i in range(300)]
    frame = spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], "vec_id bigint, embedding array<float>, label int, id int, v string")
    folder, database = as_tables(embeddings=frame)
    assert same_rows(queries.op8_top_k(spark, folder), database.sql(queries.OP8_SQL))


def test_empty_table(spark, as_tables):
    folder, _ = as_tables(embeddings=spark.createDataFrame([], "vec_id bigint, embedding array<float>"))
    assert queries.op8_top_k(spark, folder).count() == 0
