from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvio.llm import quality, queries

SMALL = "/root/testdata/sf0.001"


def test_model_equals_the_formula(spark):
    texts = ["the cat sat on the mat. the cat ran.", "a cat and a hat", "that hat is flat", "the rat sat at the mat"]
    tables = quality.model(spark.createDataFrame([(t,) for t in texts], "text string"))
    log = quality.dense(tables)
    p = np.exp(log).reshape(-1, quality.SYMBOLS)
    assert p.shape[0] == quality.SYMBOLS**3 and np.allclose(p.sum(1), 1, atol=1e-3)
    # The interpolated formula, written out over dictionaries of symbol tuples.
    seen: dict[int, dict[tuple, int]] = {4: {}}
    for t in texts:
        codes = [0, 0, 0, *(int(quality._symbols()[ord(c)]) for c in t)]
        for i in range(3, len(codes)):
            g = tuple(codes[i - 3 : i + 1])
            seen[4][g] = seen[4].get(g, 0) + 1
    for order in (3, 2, 1):
        seen[order] = {}
        for g in seen[order + 1]:
            seen[order][g[1:]] = seen[order].get(g[1:], 0) + 1
    discounts = {}
    for order, counts in seen.items():
        n = [sum(c == i for c in counts.values()) for i in range(5)]
        y = n[1] / (n[1] + 2 * n[2]) if all(n[1:]) else None
        discounts[order] = [min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.05), i - 0.05 if i > 1 else 0.95) for i in (1, 2, 3)] if y else [0.5, 1.0, 1.5]

    def probability(g: tuple) -> float:
        order = len(g)
        if not order:
            return 1 / quality.SYMBOLS
        inside = [c for h, c in seen[order].items() if h[:-1] == g[:-1]]
        if not inside:
            return probability(g[1:])
        off = lambda c: discounts[order][min(c, 3) - 1]
        c = seen[order].get(g, 0)
        return ((c - off(c)) if c else 0) / sum(inside) + sum(map(off, inside)) / sum(inside) * probability(g[1:])

    draw = np.random.default_rng(1)
    for code in [*draw.integers(0, 1 << 24, 40).tolist(), *[int("".join(f"{s:06b}" for s in g), 2) for g in list(seen[4])[:60]]]:
        g = tuple(code >> 6 * k & 63 for k in (3, 2, 1, 0))
        assert np.exp(log[code]) == pytest.approx(probability(g), rel=1e-4)


def test_junk_goes_and_clean_documents_stay(spark):
    judged = queries.op2_quality(spark, SMALL).join(spark.read.parquet(f"{SMALL}/labels.parquet"), "doc_id")
    counts = {(r.quality, r.keep): r["count"] for r in judged.groupBy("quality", "keep").count().collect()}
    assert counts.get((1, False), 0) == 0 and counts.get((0, False), 0) >= 0.6 * sum(n for (q, _), n in counts.items() if q == 0)


def test_awkward_documents(spark, awkward, no_docs):
    ids = spark.createDataFrame([(0,), (0,), (3,), (12,), (13,), (18,), (None,), (10**15,), (77,)], "id bigint")
    judged = quality.judge(awkward, ids)
    assert judged.columns == [*awkward.columns, "quality"] == [*dict.fromkeys(judged.columns)] or "quality" in awkward.columns
    kept = quality.accepted(awkward, ids)
    assert kept.columns == awkward.columns
    left = [r.doc_id for r in kept.select("doc_id").collect()]
    assert {0, 3, 4, 5, 12, 13, 18}.issubset(left)
    assert quality.accepted(no_docs, ids).count() == 0
    assert quality.accepted(awkward, ids.where(F.lit(False))).count() == awkward.count()


def exact(spark, texts, hot=None):
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    return quality.exact_model(frame, quality.model(frame), hot)


def nats(spark, model, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    return [r.nats for r in quality.log_perplexity(frame, model, "text", "nats").orderBy("id").collect()]


def test_exact_orders_equal_the_formula(spark):
    texts = ["the cat sat on the mat. the cat ran.", "жил был кот и был он рыж", "a cat and a hat", "жил был пёс", "the rat sat at the mat"]
    asked = ["the cat sat", "the cat sat", "был кот", "тык лыб", "zzz", "", None, "the hat и кот", "🙂 日本語"]
    whole, split = exact(spark, texts), exact(spark, texts, hot=40)
    assert whole.rest is None and split.rest is not None and len(split.keys) <= 40
    low, high = quality.EXACT
    pad = lambda t: [None] * (high - 1) + list(t)
    seen = {high: {}}
    for t in texts:
        p = pad(t)
        for i in range(high - 1, len(p)):
            g = tuple(p[i - high + 1 : i + 1])
            seen[high][g] = seen[high].get(g, 0) + 1
    seen[low] = {}
    for g in seen[high]:
        seen[low][g[1:]] = seen[low].get(g[1:], 0) + 1
    log = quality.dense(whole.tables)

    def probability(g: tuple, base: float) -> float:
        order = len(g)
        if order < low:
            return base
        counts = seen[order]
        n = [sum(c == i for c in counts.values()) for i in range(5)]
        y = n[1] / (n[1] + 2 * n[2]) if all(n[1:]) else None
        d = [min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.05), i - 0.05 if i > 1 else 0.95) for i in (1, 2, 3)] if y else [0.5, 1.0, 1.5]
        inside = [c for h, c in counts.items() if h[:-1] == g[:-1]]
        shorter = probability(g[1:], base)
        if not inside:
            return shorter
        c = counts.get(g, 0)
        return ((c - d[min(c, 3) - 1]) if c else 0) / sum(inside) + sum(d[min(x, 3) - 1] for x in inside) / sum(inside) * shorter

    for t, one, two in zip(asked, nats(spark, whole, asked), nats(spark, split, asked)):
        assert one == two
        if not t:
            assert one is None
            continue
        share = dict(zip(whole.tables["point"], whole.tables["share"]))
        p, base = pad(t), np.exp(log[quality.grams([t])[0]].astype(float) + [share.get(ord(c), 0.0) for c in t])
        made = [probability(tuple(p[i : i + high]), base[i]) for i in range(len(t))]
        assert one == pytest.approx(-np.mean(np.log(made)), abs=1e-4)


def test_letters_beyond_a_to_z_are_told_apart(spark):
    trusted = ["жил был у бабушки серый козлик", "бабушка козлика очень любила"] * 3
    known, shuffled = nats(spark, exact(spark, trusted), ["бабушка любила козлика", "аукшабб алибюл акилзок"])
    # Both are the same 64 symbols.
    assert (quality.grams(["бабушка любила козлика"])[0] == quality.grams(["аукшабб алибюл акилзок"])[0]).all()
    assert known + 0.5 < shuffled


def test_every_language_has_its_own_threshold(spark):
    rows = [("en", 1 + i % 100 / 1000, 2000) for i in range(6000)]
    few = [("de", 2 + i % 10 / 100, 2000) for i in range(20)]
    _, limits = quality.thresholds(spark.createDataFrame([*rows, *few], "lang string, nats double, chars int"), 0.995, 0.0)
    assert 2.05 < limits["de"] < 2.2 and limits["en"] < 1.15
    near = [quality.thresholds(spark.createDataFrame([*rows, *[("de", 2 + i / 1000, 2000) for i in range(n)]], "lang string, nats double, chars int"), 0.995, 0.0)[1]["de"] for n in (199, 200)]
    assert abs(near[0] - near[1]) < 0.01


def test_a_worker_holds_one_table_of_symbols(spark):
    import tracemalloc

    frame = spark.createDataFrame([("the cat sat on the mat",), ("жил был кот",)], "text string")
    tables = quality.model(frame) | quality.shares(frame)
    log = quality.dense(tables)
    quality._DENSE.clear()
    tracemalloc.start()
    value, ends = quality.base(["the cat", "кот!"], tables)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    quality._DENSE.clear()
    assert peak < 160e6 and ends.tolist() == [0, 7, 11]
    share = dict(zip(tables["point"], tables["share"]))
    made = [log[g] + share.get(ord(c), 0.0) for g, c in zip(quality.grams(["the cat", "кот!"])[0], "the catкот!")]
    assert np.allclose(value / quality.UNIT, made, atol=1e-5)


def test_look_up_is_small_and_exact():
    draw = np.random.default_rng(2)
    keys = np.unique(np.concatenate([draw.integers(-(1 << 63), 1 << 63, 200_000), draw.integers(0, 5000, 5000) << 50, [0, -1]]))
    draw.shuffle(keys)
    entries = draw.integers(-9_000_000, 9_000_000, len(keys)).astype(np.int32)
    hot = quality.Hot(keys, entries)
    found, hit = hot.find(keys)
    assert hit.all() and (found == entries).all()
    other = np.setdiff1d(draw.integers(-(1 << 63), 1 << 63, 50_000), keys)
    found, hit = hot.find(other)
    assert not hit.any() and not found.any()
    assert sum(x.nbytes for v in vars(hot).values() for x in (v if isinstance(v, list) else [v]) if isinstance(x, np.ndarray)) < 40 * len(keys)
    assert not quality.Hot(keys[:0], entries[:0]).find(keys)[1].any()


def test_n_grams_meet_once_as_characters(spark):
    texts = ["the cat sat on the mat", "the cat", "", None, "🙂🙂🙂🙂🙂🙂🙂 жил"] * 3
    counted = quality.exact_counts(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    assert counted._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(") == 1
    found = {}
    for r in counted.collect():
        assert len(r.ends) == len(r.n) == len(set(r.ends))
        for e, n in zip(r.ends, r.n):
            points = [e >> 21, r.a >> 21, r.a % 2**21, r.b >> 21, r.b % 2**21, e % 2**21]
            key = "".join(chr(p - 1) if p else "\0" for p in points)
            assert key not in found
            found[key] = n
    wanted = {}
    for t in texts:
        padded = "\0" * 5 + (t or "")
        for i in range(len(t or "")):
            wanted[padded[i : i + 6]] = wanted.get(padded[i : i + 6], 0) + 1
    assert found == wanted


def test_n_grams_of_no_trusted_text_are_not_sent(spark):
    trusted = ["the cat sat on the mat. the cat ran.", "жил был кот и был он рыж"]
    split = exact(spark, trusted, hot=10)
    keys = np.array([r.key for r in split.rest.collect()])
    scorer = quality.Scorer(split, spark)
    left = scorer.sums(["QQQQQQQQ ZZZZZZZ XXXXXX"])[2]
    # Trusted texts have nothing of it but the two contexts before a text.
    assert len(left) <= 2 and np.isin(left, keys).all()
    assert len(np.unique(scorer.sums(trusted)[2])) == len(keys)


def test_a_worker_holds_little_of_the_model(spark):
    """Every worker of an executor, idle ones too, had 64 MB of symbols' 4-grams and a look-up of 22 bytes an entry beside the model it was sent."""
    import tracemalloc

    draw = np.random.default_rng(3)
    frame = spark.createDataFrame([("the cat sat on the mat",), ("жил был кот",)], "text string")
    tables = quality.model(frame) | quality.shares(frame)
    keys = np.unique(draw.integers(-(1 << 63), 1 << 63, 1_000_000))
    asked = "the cat sat at a кот 🙂"
    numbers = quality.exact_grams([asked])["g6"]
    keys = np.unique(np.concatenate([keys, numbers[:3]]))
    entries = np.where(np.isin(keys, numbers[:3]), 1_000_000_000, 0).astype(np.int32)
    scorer = quality.Scorer(quality.Exact(tables, keys, entries, None), spark)
    scorer.shipped.value  # what is sent, 14 bytes an entry
    quality._DENSE.clear()
    tracemalloc.start()
    total, places, left = scorer.sums([asked])
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 16e6 and peak < 32e6
    alone = quality.base([asked], tables)[0].sum()
    assert total[0] == alone + 3_000_000_000 and len(left) == 4 * (len(asked) - 3)
    quality._DENSE.clear()


def test_symbols_in_less_memory_are_the_dense_table(spark):
    draw = np.random.default_rng(4)
    words = ["".join(draw.choice(list("etaoinshrdlu ETA.,!0é"), 9)) for _ in range(300)]
    tables = quality.model(spark.createDataFrame([(w,) for w in words], "text string"))
    log = quality.dense(tables)
    gram = np.concatenate([draw.integers(0, 1 << 24, 20_000), tables["seen4.key"], np.array([0, (1 << 24) - 1])]).astype(np.int32)
    assert np.abs(quality.Symbols(tables).find(gram) - np.rint(log[gram].astype(float) * quality.UNIT)).max() <= 1


def test_look_up_of_crowded_numbers():
    keys = np.concatenate([np.arange(100) * 3, [-5, 1 << 62]])
    hot = quality.Hot(keys, np.arange(len(keys), dtype=np.int32))
    asked = np.concatenate([keys, keys + 1])
    found, hit = hot.find(asked)
    assert hit.tolist() == [True] * len(keys) + [False] * len(keys) and (found[: len(keys)] == np.arange(len(keys))).all()


def test_the_model_is_sent_once(spark, monkeypatch):
    made = []
    monkeypatch.setattr(quality, "Scorer", lambda *x, old=quality.Scorer: made.append(old(*x)) or made[-1])
    whole = exact(spark, ["the cat sat on the mat. the cat ran."])
    assert nats(spark, whole, ["the cat", "a dog"])[0] == nats(spark, whole, ["the cat"])[0] and len(made) == 1
