from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from pluvio.llm import prefix_trie, queries
from tests.llm.conftest import same_rows

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, path string, n string, list string"


def conversations(seed: int, n: int, words=("a", "b b", "c")) -> list[tuple]:
    draw = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(draw.choice([1, 1, 2, 3, 4, 9])):
            rows.append((c, turn, draw.choice(["user", "bot"]), draw.choice(words), 1, "p", "q", "r"))
    draw.shuffle(rows)
    return rows


AWKWARD = [
    (None, 0, "user", "lost", 1, "", "", ""), (-3, 1, None, None, 1, "", "", ""), (-3, None, "user", "first", 1, "", "", ""),
    (7, 0, "user", "only", 1, "", "", ""), (20, 0, "user", "x  y\tz\nw", 1, "", "", ""), (20, 0, "user", "x  y\tz\nw", 1, "", "", ""),
    (23, 5, "u", "", 1, "", "", ""), (23, 5, "u", "t", 1, "", "", ""), (10**15, 0, "user", "long " * 5000, 1, "", "", ""), (10**15 + 1, 0, "user", "x", 1, "", "", ""),
    (41, 0, "a", "bc", 1, "", "", ""), (42, 0, "ab", "c", 1, "", "", ""), (61, 0, "é", "日本 語", 1, "", "", ""),
]


def brute_force(rows) -> list[tuple]:
    """The contract word by word, every prefix a dictionary entry."""
    own = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v, key=lambda t: (t[0], t[1] or 0))] for c, v in own.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = own.get(c - int(abs(c) % 20) * (1 if c >= 0 else -1), [])
        made[c] = tuple(base[:h] + turns[h:])
    members, kids = {}, {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
            if d:
                kids.setdefault(turns[: d - 1], set()).add(turns[:d])
    found = []
    for p, convs in members.items():
        below = [q for q in members if q[: len(p)] == p]
        saved = sum((len(members[q]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) for q in below if q)
        ends = ",".join(str(c) for c in sorted(c for c in convs if made[c] == p))
        found.append((
            min(convs), len(p), min(members[p[:-1]]) if p else None, len(convs), len(kids.get(p, ())), sum(q not in kids for q in below), saved,
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(found, key=str)


def built(spark, rows, parts=None):
    turns = prefix_trie.ordered_turns(spark.createDataFrame(rows, SCHEMA))
    conv = F.col("conv_id")
    whole = prefix_trie.rebuilt(turns, F.crc32(conv.cast("string").cast("binary")) % 4, conv - conv % 20, 3)
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(whole, parts).collect()), key=str)


def test_query_equals_sql_on_awkward_conversations(spark, as_tables):
    folder, database = as_tables(conversations=spark.createDataFrame(conversations(1, 90) + AWKWARD, SCHEMA))
    assert same_rows(queries.op11_prefix_trie(spark, folder), database.sql(queries.OP11_SQL))


@pytest.mark.parametrize("parts", [1, 2, 40])
def test_forests_of_any_number_of_partitions_make_one_trie(spark, parts, monkeypatch):
    monkeypatch.setattr(prefix_trie, "FANIN", 3)
    rows = conversations(parts, 130)
    assert built(spark, rows, parts) == brute_force(rows)


def test_hot_beginnings_and_copies(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS", 7)
    rows = [(c, t, "user", f"turn {t}" if c % 3 else f"own {c % 2}", 1, "", "", "") for c in range(150) for t in range(5)]
    assert built(spark, rows, 12) == brute_force(rows)


def test_forest_by_union_find_on_random_sequences():
    import numpy as np
    import pandas as pd

    draw = random.Random(8)
    for _ in range(200):
        seqs = sorted({b"".join(bytes([draw.randint(0, 2)]) * 16 for _ in range(draw.randint(0, 5))) for _ in range(draw.randint(1, 25))})
        frame = pd.DataFrame({"path": seqs, "words": [np.arange(1, len(s) // 16 + 1) for s in seqs]})
        for c, v in (("n", 1), ("kids", 0), ("leaves", 0), ("saved", 0)):
            frame[c] = v
        frame["first"], frame["ends"] = range(len(seqs)), "x"
        made = prefix_trie.Forest(frame).grown(last=True)
        prefixes = {s[: 16 * d] for s in seqs for d in range(len(s) // 16 + 1)}
        counts = sorted((len(p) // 16, sum(s.startswith(p) for s in seqs), min(i for i, s in enumerate(seqs) if s.startswith(p))) for p in prefixes)
        assert sorted(zip(made["depth"], made["n_convs"], made["conv_id"], strict=True)) == counts


def test_no_conversations(spark):
    found = built(spark, [])
    assert found == []
    assert built(spark, [AWKWARD[0]]) == []
