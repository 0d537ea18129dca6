from __future__ import annotations

import numpy as np
import pytest

from pluvio.llm import chosen_path, queries
from tests.llm.conftest import prose


def by_hand(rows):
    """class_id and n_links of every row that has an id and words, by comparing all pairs."""
    found = [(i, set(chosen_path.shingles(t).tolist())) for i, t in rows]
    parent = list(range(len(found)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(found)
    for a in range(len(found)):
        for b in range(a):
            (i, x), (j, y) = found[a], found[b]
            if i is not None and j is not None and x and y and len(x & y) >= 0.8 * len(x | y):
                links[a] += 1
                links[b] += 1
                parent[root(a)] = root(b)
    lowest: dict[int, int] = {}
    for a, (i, x) in enumerate(found):
        if i is not None:
            lowest[root(a)] = min(i, lowest.get(root(a), i))
    return sorted(str((i, i if i is None or not x else lowest[root(a)], links[a])) for a, (i, x) in enumerate(found))


def family(size: int, edits: int):
    """Variants of one text, each with a few words of its own, and some that change one word only."""
    base = prose(40, 150).split()
    made = []
    for k in range(size):
        words = list(base)
        for e in range(edits):
            words[(k * 37 + e * 61) % 150] = f"own{k}{e}"
        made.append((1000 + k, " ".join(words)))
    return made


def test_query_equals_all_pairs(spark, awkward, as_tables):
    folder, _ = as_tables(documents=awkward)
    got = sorted(str((r.doc_id, r.class_id, r.n_links)) for r in queries.op3_similar(spark, folder).collect())
    assert got == by_hand([tuple(r) for r in awkward.select("doc_id", "text").collect()])


@pytest.mark.parametrize("large", [1024, 12])
def test_family_of_near_copies(spark, monkeypatch, large):
    monkeypatch.setattr(chosen_path, "LARGE", large)  # 12: buckets are split further, and in blocks
    rows = family(60, 2) + [(2000 + k, prose(100 + k, 80)) for k in range(40)] + [(3000, family(1, 2)[0][1])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(str((r.doc_id, r.class_id, r.n_links)) for r in chosen_path.join(frame).collect())
    assert got == by_hand(rows)


def test_runs_reach_the_target():
    # The survival of a pair at the threshold, simulated on sketches that agree in 0.8 of their places.
    draw, met = np.random.default_rng(3), 0
    for _ in range(150):
        a = draw.integers(0, 2**32, chosen_path.SKETCH, dtype=np.uint64).astype(np.uint32)
        b = np.where(draw.random(chosen_path.SKETCH) < 0.8, a, a + np.uint32(1))
        x = y = chosen_path.roots(chosen_path.runs_needed(0.8))
        for _ in range(chosen_path.DEPTH):
            x, y = chosen_path.children(x, a), chosen_path.children(y, b)
        met += bool(len(np.intersect1d(x, y)))
    assert met >= 147


def test_one_of_each_keeps_columns(spark, awkward, no_docs):
    kept = chosen_path.one_of_each(awkward)
    assert kept.columns == awkward.columns
    ids = sorted(str(r.doc_id) for r in kept.select("doc_id").collect())
    # 1 and 2 go with 0, 17 too (case is folded); 15 with 14; the second row 3; 10**15 with 18. Rows without id or words stay.
    assert ids == sorted(map(str, [0, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, None, None, 14, 16, 18, -5]))
    assert chosen_path.one_of_each(no_docs).count() == 0
    assert chosen_path.join(no_docs).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "`set` bigint, root bigint")
    assert {tuple(r) for r in chosen_path.components(edges).collect()} == {(i, 0) for i in range(1, 41)} | {(101, 100)}
