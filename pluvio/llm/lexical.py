"""Ranked lexical search for many items at once.

Multi-query common-subexpression evaluation. Items with one term set are one
query. Queries are cut into blocks of alike ones; in a block, term sets that
several queries share are mined into nodes: first the terms that the same
queries hold, then, round after round, neighbouring nodes that occur together in
two or more queries. The nodes form a query-sharing graph, a Spark table of at
most ``PAIRS`` term places a block. Of every document, the partial sum of a node is
computed once, from those of its parts, and every query that contains the node
takes it from there. Scores are whole numbers, so the order of sums is free.

Documents are read once. What is staged of one is its length and how often it
holds each term of the queries. While the queries are one block, its vocabulary
is broadcast (at most ``PAIRS`` terms and ``BYTES`` bytes); beyond that, the
documents' terms are joined with the vocabulary, salted by document, and dealt to
the blocks. Every task keeps the best ``k`` of each query, and those meet in a
window that ranks them before the shuffle too.

Terms are maximal runs of ASCII letters and digits and of characters outside
ASCII; only A to Z are lower-cased. Null, empty and term-free texts have no terms:
such a document is not counted, such an item finds nothing. Rows with one
``item_id`` are one item with the terms of all its texts, a null id included. Each
document row is a document of its own; equal scores go by ascending ``doc_id``,
null behind all others. No documents or no items give no rows. Long texts are
counted piece by piece. Other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pluvio.llm.common import ROWS, col, staged
from pluvio.session import fresh_path

#: Term places of the queries of a block, and bytes of a vocabulary that is broadcast.
PAIRS, BYTES = 2**16, 2**24
#: Cells of partial sums a task holds at once, and bytes of text it splits at once.
CELLS, PIECE = 2**21, 2**20
#: A document's terms meet the vocabulary in one of so many copies.
SALTS = 16

OTHER = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

POSTINGS = "doc_id bigint, n bigint, places array<int>, counts array<int>"
PLAN = "block bigint, place int, word binary, query string, parts array<int>"


def term_counts(text: bytes) -> Counter:
    """How often a text, as UTF-8, holds each term."""
    counts, start, text = Counter(), 0, text.translate(FOLD)
    while start < len(text):
        end = text.find(b" ", start + PIECE)
        end = len(text) if end < 0 else end
        counts.update(text[start:end].split())
        start = end
    return counts


def mine(queries: list[list[int]]) -> tuple[list[list[int]], list[list[int]]]:
    """Nodes shared by queries, and the queries made of nodes.

    Places from 0 are terms; the nodes follow them in the order of the list, each
    made of two or more earlier places.
    """
    holders: dict[int, list[int]] = defaultdict(list)
    for q, terms in enumerate(queries):
        for term in terms:
            holders[term].append(q)
    first = 1 + max(holders, default=-1)
    nodes: list[list[int]] = []
    uses = {}

    def node(parts: list[int], used: int) -> int:
        nodes.append(parts)
        uses[first + len(nodes) - 1] = used
        return first + len(nodes) - 1

    together = defaultdict(list)
    for term, held in holders.items():
        together[tuple(held)].append(term)
    rows: list[list[int]] = [[] for _ in queries]
    for held, terms in together.items():
        uses[terms[0]] = len(held)
        whole = terms[0] if len(terms) == 1 else node(terms, len(held))
        for q in held:
            rows[q].append(whole)
    rows = [sorted(row, key=lambda p: (-uses[p], p)) for row in rows]
    while True:
        often = Counter(pair for row in rows for pair in zip(row, row[1:], strict=False))
        made: dict[tuple[int, int], int] = {}
        for q, row in enumerate(rows):
            new, i = [], 0
            while i < len(row):
                here = often.get(tuple(row[i : i + 2]), 0)
                if here > 1 and here >= often.get(tuple(row[i + 1 : i + 3]), 0):
                    pair = (row[i], row[i + 1])
                    if pair not in made:
                        made[pair] = node(list(pair), here)
                    new.append(made[pair])
                    i += 2
                else:
                    new.append(row[i])
                    i += 1
            rows[q] = new
        if not made:
            return nodes, rows


class Graph:
    """A block's nodes by level, ready to be summed for many documents together."""

    def __init__(self, terms: int, nodes: list[list[int]], queries: list[list[int]]) -> None:
        self.terms, self.size, self.queries = terms, terms + len(nodes), self._flat(queries)
        height = [0] * terms
        levels: dict[int, list[int]] = defaultdict(list)
        for i, parts in enumerate(nodes):
            height.append(1 + max(height[p] for p in parts))
            levels[height[-1]].append(i)
        self.levels = [(np.array(levels[h]) + terms, *self._flat([nodes[i] for i in levels[h]])) for h in sorted(levels)]

    @staticmethod
    def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        ends = np.cumsum([0] + [len(parts) for parts in lists])
        return np.array([p for parts in lists for p in parts], np.int64), ends[:-1]

    def scores(self, places: np.ndarray, columns: np.ndarray, values: np.ndarray, width: int) -> np.ndarray:
        """Sums of every query for ``width`` documents; a value stands at a term's place and a document's column."""
        sums = np.zeros((self.size, width), np.int64)
        sums[places, columns] = values
        for own, parts, starts in self.levels:
            sums[own] = np.add.reduceat(sums[parts], starts, axis=0)
        parts, starts = self.queries
        return np.add.reduceat(sums[parts], starts, axis=0)


def _items(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """Every item with its sorted terms and the name of its query, the digest of the term set."""
    words = F.array_remove(F.split(F.translate(col(text), UPPER, LOWER), OTHER), "")
    rows = items.select(col(item_id).alias("item_id"), F.explode(F.array_distinct(words)).alias("word")).distinct()
    sets = rows.groupBy("item_id").agg(F.sort_array(F.collect_set("word")).alias("words"))
    return sets.withColumn("query", F.sha2(F.concat_ws(" ", "words").cast("binary"), 256))


def _plan(queries: DataFrame, total: int, pairs: int) -> DataFrame:
    """The query-sharing graph of every block: its terms, nodes and queries with their parts."""
    likeness = F.array_min(F.transform("words", lambda w: F.xxhash64(w)))
    near = queries.withColumn("likeness", likeness).repartitionByRange(-(-total // pairs), "likeness", "query")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            blocks = []
            for n in pa.compute.list_value_length(batch.column("words")).to_pylist():
                held += n
                if held > pairs and held > n:
                    block, held = block + 1, n
                blocks.append(block)
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), batch.column("query"), batch.column("words")], ["block", "query", "words"])

    def graph(rows: pd.DataFrame) -> pd.DataFrame:
        words = sorted({w for words in rows["words"] for w in words})
        places = {w: i for i, w in enumerate(words)}
        nodes, queries = mine([[places[w] for w in row] for row in rows["words"]])
        made = [(place, word.encode(), None, None) for word, place in places.items()]
        made += [(len(words) + i, None, None, parts) for i, parts in enumerate(nodes)]
        made += [(i, None, query, parts) for i, (query, parts) in enumerate(zip(rows["query"], queries, strict=True))]
        found = pd.DataFrame(made, columns=["place", "word", "query", "parts"])
        found.insert(0, "block", rows["block"].iloc[0])
        return found

    if total <= pairs:
        cut_up = queries.select(F.lit(0).cast("bigint").alias("block"), "query", "words")
    else:
        cut_up = near.sortWithinPartitions("likeness", "query").select("query", "words").mapInArrow(cut, "block bigint, query string, words array<string>")
    return staged(cut_up.groupBy("block").applyInPandas(graph, PLAN), "search-plan")


def _known_postings(docs: DataFrame, places: dict[bytes, int]) -> DataFrame:
    """Documents with terms, and how often they hold those of a broadcast vocabulary."""
    known = docs.sparkSession.sparkContext.broadcast(places)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = known.value
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                rows = []
                part = batch.slice(start, ROWS)
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    counts = term_counts(text)
                    held = [w for w in counts if w in wanted]
                    rows.append((doc, counts.total(), [wanted[w] for w in held], [counts[w] for w in held]))
                rows = [r for r in rows if r[1]]
                kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["doc_id", "n", "places", "counts"])

    return docs.mapInArrow(run, POSTINGS)


def _joined_postings(docs: DataFrame, plan: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lengths of the documents, and per block and document the terms found in the blocks' vocabularies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                counted = [term_counts(text) for text in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([c.total() for c in counted], pa.int64()),
                        pa.array([list(c) for c in counted], pa.list_(pa.binary())),
                        pa.array([list(c.values()) for c in counted], pa.list_(pa.int32())),
                    ],
                    ["doc_id", "n", "words", "counts"],
                )

    counted = docs.mapInArrow(run, "doc_id bigint, n bigint, words array<binary>, counts array<int>").where("n > 0")
    # Written at once, so a row keeps the number it has here.
    counted = staged(counted.withColumn("row", F.monotonically_increasing_id()), "search-terms")
    salt = F.pmod("row", F.lit(SALTS)).alias("salt")
    held = counted.select("row", "doc_id", "n", salt, F.explode(F.arrays_zip("words", "counts")).alias("t"))
    held = held.select("row", "doc_id", "n", "salt", F.col("t.words").alias("word"), F.col("t.counts").alias("count"))
    vocabulary = plan.where("word is not null").select("block", "place", "word", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    vocabulary = vocabulary.withColumn("salt", F.col("salt").cast("bigint"))
    met = held.join(vocabulary, ["word", "salt"]).groupBy("block", "row", "doc_id", "n").agg(F.collect_list(F.struct("place", "count")).alias("t"))
    found = met.select("doc_id", "n", F.col("t.place").alias("places"), F.col("t.count").alias("counts"), "block")
    path = fresh_path(docs.sparkSession, "search-postings")
    found.write.partitionBy("block").parquet(path)
    return counted.select("n"), docs.sparkSession.read.schema(f"{POSTINGS}, block bigint").parquet(path)


def _holding(postings: DataFrame) -> DataFrame:
    """In how many documents each place of a block occurs, added up in the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for batch in batches:
            found = np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=len(counts))
            found[: len(counts)] += counts
            counts = found
        places = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), pa.array(counts[places], pa.int64())], ["place", "df"])

    counted = postings.select("places").mapInArrow(run, "place int, df bigint")
    return counted.groupBy("place").agg(F.sum("df").alias("df"))


def _top(found: tuple[np.ndarray, ...], k: int) -> tuple[np.ndarray, ...]:
    """Of rows (query, score, id missing, id), the best ``k`` of each query."""
    query, score, missing, doc = found
    order = np.lexsort((doc, missing, -score, query))
    query = query[order]
    first = np.searchsorted(query, query, "left")
    order = order[np.arange(len(query)) - first < k]
    return tuple(x[order] for x in found)


def _best(postings: DataFrame, graph: Graph, weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """The best ``k`` documents of every query among those of each task."""
    shared = postings.sparkSession.sparkContext.broadcast((graph, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph, weights = shared.value
        n_queries = len(graph.queries[1])
        best = tuple(np.zeros(0, t) for t in (np.int64, np.int64, bool, np.int64))
        least = np.ones(n_queries, np.int64)
        width = max(1, CELLS // (graph.size + n_queries))
        for batch in batches:
            for start in range(0, batch.num_rows, width):
                part = batch.slice(start, width)
                length = part.column("n").to_numpy()
                lists = part.column("places")
                columns = np.repeat(np.arange(part.num_rows), pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))
                places = lists.flatten().to_numpy(zero_copy_only=False)
                tf = part.column("counts").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                m = 10 + (90 * length * n_docs) // n_terms
                values = weights[places] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[columns]))
                scores = graph.scores(places, columns, values, part.num_rows)
                query, at = np.nonzero(scores >= least[:, None])
                missing = part.column("doc_id").is_null().to_numpy(zero_copy_only=False)
                doc = part.column("doc_id").fill_null(0).to_numpy()
                new = (query, scores[query, at], missing[at], doc[at])
                best = _top(tuple(np.concatenate(x) for x in zip(best, new, strict=True)), k)
                full = np.bincount(best[0], minlength=n_queries) >= k
                lowest = np.full(n_queries, np.iinfo(np.int64).max)
                np.minimum.at(lowest, best[0], best[1])
                least = np.where(full, lowest, 1)
        query, score, missing, doc = best
        yield pa.RecordBatch.from_arrays(
            [pa.array(query, pa.int32()), pa.array(score), pa.array(doc, mask=missing)], ["place", "score", "doc_id"]
        )

    return postings.select("doc_id", "n", "places", "counts").mapInArrow(run, "place int, score bigint, doc_id bigint")


def rank(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", pairs: int = PAIRS) -> DataFrame:
    """Each item's ``k`` best documents: item_id, rank, doc_id, score. See the module for the score."""
    spark = docs.sparkSession
    members = staged(_items(items, item_id, text), "search-items")
    queries = members.groupBy("query").agg(F.any_value("words").alias("words"))
    size = queries.agg(F.sum(F.size("words")), F.sum(F.length(F.concat_ws(" ", "words").cast("binary")))).first()
    if not size[0]:
        return members.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("score")).where("false")
    plan = _plan(queries, size[0], pairs)
    blocks = [r[0] for r in plan.select("block").distinct().collect()]
    texts = docs.select(col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(col(text), F.lit("")).cast("binary").alias("text"))
    if len(blocks) == 1 and size[1] <= BYTES:
        places = {bytes(r["word"]): r["place"] for r in plan.where("word is not null").select("word", "place").collect()}
        postings = staged(_known_postings(texts, places), "search-postings").withColumn("block", F.lit(blocks[0]))
        lengths = postings.select("n")
    else:
        lengths, postings = _joined_postings(texts, plan)
    n_docs, n_terms = lengths.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    results = fresh_path(spark, "search-results")
    weight = F.floor(1000 * F.log((F.lit(2.0) * n_docs + 2) / (2.0 * F.coalesce("df", F.lit(0)) + 1)))
    for block in blocks:
        # At most PAIRS term places and their nodes come to the driver and go to the tasks.
        own = postings.where(F.col("block") == block)
        rows = plan.where(F.col("block") == block)
        terms = rows.where("word is not null").select("place").join(_holding(own), "place", "left").select("place", weight.alias("w")).collect()
        weights = np.zeros(len(terms), np.int64)
        for r in terms:
            weights[r["place"]] = r["w"]
        parts = rows.where("word is null").select("place", "query", "parts").collect()
        nodes = [r["parts"] for r in sorted((r for r in parts if r["query"] is None), key=lambda r: r["place"])]
        asked = sorted((r for r in parts if r["query"] is not None), key=lambda r: r["place"])
        graph = Graph(len(weights), nodes, [r["parts"] for r in asked])
        _best(own, graph, weights, n_docs, n_terms, k).withColumn("block", F.lit(block)).write.mode("append").parquet(results)
    found = spark.read.schema("place int, score bigint, doc_id bigint, block bigint").parquet(results)
    ordered = Window.partitionBy("block", "place").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    found = found.withColumn("rank", F.row_number().over(ordered)).where(F.col("rank") <= k)
    named = plan.where("query is not null").select("block", "place", "query")
    return found.join(named, ["block", "place"]).join(members.select("item_id", "query"), "query").select("item_id", "rank", "doc_id", "score")
