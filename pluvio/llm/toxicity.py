"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

Examples are a bounded sample of labelled rows: at most ``EXAMPLES`` per label,
every labelled row with the same chance. Terms are words in lower case and their
first four to six letters, so that inflected forms meet. Cosine forgets how often
a term stands in a text, so a term that stands there twice or three times counts
as further terms of its own. The vocabulary is the at most ``TERMS`` terms whose
presence differs between the two labels far beyond chance and at least threefold. One pass over all documents keeps the counts of
these terms, and document frequencies come from all documents.

The examples form an inverted index in blocks of ``BLOCK`` examples, ordered so
that examples with the same strongest term are neighbours. For each term and
block it holds the largest weight. A document's query visits blocks in order of
their upper bound and stops when no bound exceeds its ``K``-th similarity, so the
neighbours are the exact ones. Neighbours vote with the inverse of their cosine
distance, each label scaled up from its sampled to its true number, and the share
of label 1 among examples without any term counts as one more weak vote; that
share alone is the score of a document without terms, empty and null texts
included. The neighbours are returned as evidence.

Without any labelled example every score is 0. Ties go to the example that comes
first in the index. Repeated rows get the same score each.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import col, staged, with_values

EXAMPLES = 4000
TERMS = 1024
K = 15
BLOCK = 64
#: G-squared beyond this is by chance as unlikely as one in ten thousand.
SIGNIFICANT = 15.0
LIFT = 3.0
MEMORY = 500_000
_WORD = re.compile(r"[^\W\d_]+")


def terms_of(word: str) -> tuple[str, ...]:
    return (word, *(f"{word[:n]}*" for n in (4, 5, 6) if len(word) >= n))


def present(text: str | None) -> set[str]:
    """The terms of a text, repeated ones included."""
    words = Counter(_WORD.findall((text or "").lower()))
    counts: Counter[str] = Counter()
    for word, n in words.items():
        for term in terms_of(word):
            counts[term] += n
    return {name for term, n in counts.items() for name in repeated(term)[: min(n, 3)]}


def repeated(term: str) -> tuple[str, str, str]:
    """The term, and what it is called from its second and third place on."""
    return term, f"{term}+", f"{term}++"


def examples(labels: DataFrame, learn: Column, id_col: str, label_col: str, limit: int = EXAMPLES) -> tuple[dict[object, int], dict[int, float]]:
    """At most ``limit`` labelled ids per label, and by how much each label was thinned out."""
    known = labels.where(learn & col(label_col).isin(0, 1) & col(id_col).isNotNull()).groupBy(col(id_col).alias("id")).agg(F.max(col(label_col)).cast("int").alias("label"))
    known = staged(known, "labelled")
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen: dict[object, int] = {}
    for label in counts:
        # A quarter more than wanted are drawn by hash, so the tasks send few ids to be ordered.
        draw, parts = F.pmod(F.xxhash64(F.lit(17), "id"), F.lit(1 << 30)), 1 << 30
        drawn = known.where((F.col("label") == label) & (draw < min(parts, (limit + limit // 4 + 100) * parts // counts[label])))
        rows = drawn.orderBy(draw, "id").limit(limit).collect()
        chosen |= {r["id"]: label for r in rows}
    return chosen, {label: n / min(n, limit) for label, n in counts.items()}


def select_terms(texts: DataFrame, limit: int = TERMS) -> list[str]:
    """Terms that tell the labels of (text, label) rows apart, the most telling first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {0: Counter(), 1: Counter()}
        seen = {0: 0, 1: 0}
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found[label].update(present(text))
                seen[label] += 1
        for label, counter in found.items():
            counter[""] = seen[label]
            yield pa.RecordBatch.from_arrays([pa.array(list(counter)), pa.array([label] * len(counter), pa.int32()), pa.array(list(counter.values()), pa.int64())], ["term", "label", "n"])

    parts = texts.mapInArrow(run, "term string, label int, n bigint")
    counted = parts.groupBy("term").agg(*[F.sum(F.when(F.col("label") == y, F.col("n")).otherwise(0)).cast("double").alias(f"n{y}") for y in (0, 1)])
    counted = staged(counted, "terms")
    totals = counted.where("term = ''").first()
    if totals is None or not totals["n0"] or not totals["n1"]:
        return []
    t0, t1 = totals["n0"], totals["n1"]
    have, n = F.col("n0") + F.col("n1"), t0 + t1
    cell = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    g2 = 2 * (
        cell(F.col("n1"), have * (t1 / n)) + cell(F.col("n0"), have * (t0 / n))
        + cell(t1 - F.col("n1"), (n - have) * (t1 / n)) + cell(t0 - F.col("n0"), (n - have) * (t0 / n))
    )
    share1, share0 = (F.col("n1") + 0.5) / (t1 + 1), (F.col("n0") + 0.5) / (t0 + 1)
    telling = (share1 >= LIFT * share0) | (share0 >= LIFT * share1)
    rows = counted.where((F.col("term") != "") & telling).withColumn("g2", g2).where(F.col("g2") >= SIGNIFICANT).orderBy(F.desc("g2"), "term").limit(limit).collect()
    return [r["term"] for r in rows]


def count_terms(docs: DataFrame, vocabulary: list[str], text_col: str, as_col: str) -> DataFrame:
    """The documents with ``as_col``: numbers and counts of the vocabulary's terms in the whole text."""
    number = {term: i for i, term in enumerate(vocabulary)}
    bases = {term.rstrip("+") for term in vocabulary}
    shipped = docs.sparkSession.sparkContext.broadcast({base: tuple(number.get(x) for x in repeated(base)) for base in bases})
    memory: dict[str, tuple[str, ...]] = {}

    def run(texts: list) -> list[dict]:
        numbers = shipped.value
        made = []
        for text in texts:
            counts: Counter[str] = Counter()
            for word in _WORD.findall((text or "").lower()):
                hits = memory.get(word)
                if hits is None:
                    if len(memory) >= MEMORY:
                        memory.clear()
                    hits = memory[word] = tuple(t for t in terms_of(word) if t in numbers)
                if hits:
                    counts.update(hits)
            found = sorted((i, n if place == 0 else 1) for t, n in counts.items() for place, i in enumerate(numbers[t][: min(n, 3)]) if i is not None)
            made.append({"term": [i for i, _ in found], "n": [n for _, n in found]})
        return made

    kind = pa.struct([("term", pa.list_(pa.int32())), ("n", pa.list_(pa.int32()))])
    return with_values(docs, text_col, as_col, "struct<term:array<int>, n:array<int>>", kind, run)


def document_frequency(counted: DataFrame) -> DataFrame:
    """(term, n) over all rows with ``counts``, added up in the tasks before they meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[int] = Counter()
        for batch in batches:
            seen.update(batch.column(0).flatten().to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int32()), pa.array(list(seen.values()), pa.int64())], ["term", "n"])

    parts = counted.select(F.col("counts.term").alias("term")).mapInArrow(run, "term int, n bigint")
    return parts.groupBy("term").agg(F.sum("n").alias("n"))


class Index:
    """The examples' inverted index with the largest weight of each term in each block."""

    def __init__(self, vectors: list[tuple[object, int, list[int], list[int]]], idf: np.ndarray, scale: dict[int, float]):
        self.idf = idf
        weighed = [(key, label, *self.weigh(terms, counts)) for key, label, terms, counts in vectors]
        empty = [label for _, label, terms, _ in weighed if not len(terms)]
        self.plain = sum(scale[y] for y in empty if y) / max(1e-9, sum(scale[y] for y in empty)) if empty else 0.0
        filled = [x for x in weighed if len(x[2])]
        filled.sort(key=lambda x: (int(x[2][x[3].argmax()]), str(x[0])))
        self.keys, self.labels = [x[0] for x in filled], np.array([x[1] for x in filled], np.int64)
        self.votes = np.array([scale[x[1]] for x in filled])
        blocks = -(-len(filled) // BLOCK)
        self.most = np.zeros((len(idf), blocks), np.float64)
        postings: dict[tuple[int, int], list[tuple[int, float]]] = defaultdict(list)
        for place, (_, _, terms, weights) in enumerate(filled):
            for term, weight in zip(terms, weights):
                postings[int(term), place // BLOCK].append((place % BLOCK, weight))
                self.most[term, place // BLOCK] = max(self.most[term, place // BLOCK], weight)
        self.postings = {k: (np.array([p for p, _ in v]), np.array([w for _, w in v])) for k, v in postings.items()}

    def weigh(self, terms: list[int], counts: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Unit TF-IDF weights; terms without weight are left out."""
        terms = np.array(terms, np.int64)
        weights = (1 + np.log(np.array(counts, np.float64))) * self.idf[terms]
        terms, weights = terms[weights > 0], weights[weights > 0]
        return terms, weights / max(1e-12, math.sqrt(float(weights @ weights)))

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int = K) -> list[tuple[float, int]]:
        """The ``k`` highest (cosine, place) above zero."""
        bounds = weights @ self.most[terms] if len(terms) else np.zeros(0)
        best: list[tuple[float, int]] = []
        for block in np.argsort(-bounds, kind="stable"):
            if bounds[block] <= 0 or (len(best) == k and bounds[block] + 1e-12 < best[-1][0]):
                break
            scores = np.zeros(BLOCK)
            for term, weight in zip(terms, weights):
                found = self.postings.get((int(term), int(block)))
                if found is not None:
                    scores[found[0]] += weight * found[1]
            best += [(float(scores[i]), int(block) * BLOCK + int(i)) for i in np.flatnonzero(scores > 0)]
            best = sorted(best, key=lambda x: (-x[0], x[1]))[:k]
        return best

    def score(self, terms: list[int], counts: list[int]) -> dict:
        near = self.nearest(*self.weigh(terms, counts)) if len(self.keys) else []
        votes = [(1 / (1.1 - min(1.0, s)) * self.votes[p], int(self.labels[p])) for s, p in near]
        weak = 0.1
        total = sum(v for v, y in votes if y) + weak * self.plain
        evidence = [{"example": str(self.keys[p]), "similarity": s, "label": int(self.labels[p])} for s, p in near]
        return {"score": float(min(1.0, total / (sum(v for v, _ in votes) + weak))) if votes else float(self.plain), "evidence": evidence}


def score(docs: DataFrame, labels: DataFrame, learn: Column, as_col: str = "toxicity", id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """``id_col`` and ``as_col`` (score, evidence) for every document; ``learn`` is over ``labels``."""
    chosen, scale = examples(labels, learn, id_col, label_col)
    spark = docs.sparkSession
    rows = docs.select(col(id_col).alias("id"), col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    picked = spark.createDataFrame([(k, y) for k, y in chosen.items()], f"id {kind}, label int")
    sampled = rows.join(F.broadcast(picked), "id").select("text", "label")  # at most 2 * EXAMPLES ids
    vocabulary = select_terms(sampled)
    counted = staged(count_terms(rows, vocabulary, "text", "counts").select("id", "counts"), "term-counts")
    frequency = document_frequency(counted).collect()  # at most TERMS rows
    total = counted.count()
    idf = np.zeros(max(1, len(vocabulary)))
    for r in frequency:
        idf[r["term"]] = math.log(1 + total / r["n"])
    vectors = counted.join(F.broadcast(picked), "id").dropDuplicates(["id"]).select("id", "label", "counts").collect()
    index = Index([(r["id"], r["label"], r["counts"]["term"], r["counts"]["n"]) for r in vectors], idf, scale)
    shipped = spark.sparkContext.broadcast(index)  # bounded by EXAMPLES and TERMS
    evidence = pa.list_(pa.struct([("example", pa.string()), ("similarity", pa.float64()), ("label", pa.int32())]))
    made = pa.struct([("score", pa.float64()), ("evidence", evidence)])
    ddl = "struct<score:double, evidence:array<struct<example:string, similarity:double, label:int>>>"
    scored = with_values(counted, "counts", "found", ddl, made, lambda found: [shipped.value.score(c["term"], c["n"]) for c in found])
    return scored.select(F.col("id").alias(id_col), F.col("found").alias(as_col))
