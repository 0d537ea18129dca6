"""Exact top-k inner products by best-first search of M-trees.

Components become whole numbers, ``floor(scale * x)``, so scores are exact
64-bit integers (components below 2**17 in size keep 256 of them in range).
Inner product is no metric, so a tree works on vectors with one more component:
``sqrt(M**2 - |v|**2)`` with the largest length ``M`` of its shard, and zero for
a query. There ``|q - v|**2 = |q|**2 + M**2 - 2 q.v``, and the nearest are the
highest scores. The tree decides only what to skip, with a margin for rounding;
the scores themselves are integers.

Vectors are spread by hash over shards of about ``SHARD`` rows. Each task builds
the M-tree of one shard: pages of routing objects with covering radii and the
distance to the parent's object, leaves with the distance of each vector to the
leaf's object. Trees are written once. Queries travel in blocks of about
``BLOCK``; every block meets every tree, each pair yields its ``k`` best, and a
group limit keeps ``k`` a query before the last shuffle.

A row takes no part if its id or vector is null, or the vector is empty or holds
a null or non-finite component. Rows alike in id and vector count once. Of two
rows with one id and different vectors each is a candidate of the other. Vectors
of different lengths are not compared. Ties go to the smaller id. A query with
fewer than ``k`` candidates returns them all.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pluvio.llm.common import col, staged

SHARD = 4096
BLOCK = 256
LEAF = 64
FAN = 16


class Tree:
    """An M-tree over the rows of one shard; rows are reordered so that a leaf is a slice."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.vectors = vectors.astype(np.int64)
        lengths = (self.vectors.astype(np.float64) ** 2).sum(1)
        self.top = float(lengths.max())
        self.points = np.hstack([self.vectors.astype(np.float64), np.sqrt(np.maximum(0.0, self.top - lengths))[:, None]])
        self.order: list[np.ndarray] = []
        self.filled = 0
        # Of each page: object, covering radius, distance to the parent's object, children or (first, behind) of a leaf.
        self.object: list[int] = []
        self.radius: list[float] = []
        self.to_parent: list[float] = []
        self.children: list[np.ndarray | None] = []
        self.span: list[tuple[int, int]] = []
        self._page(np.argsort(ids, kind="stable"), None)
        rows = np.concatenate(self.order)
        leaf_object = np.empty(len(rows), np.int64)
        for page, (first, behind) in enumerate(self.span):
            if self.children[page] is None:
                leaf_object[first:behind] = self.object[page]
        self.to_object = self._distance(self.points[rows], self.points[leaf_object])
        self.page_points = self.points[np.array(self.object)]
        self.radius, self.to_parent = np.array(self.radius), np.array(self.to_parent)
        self.ids, self.vectors = ids[rows], self.vectors[rows]
        del self.points, self.order, self.object

    @staticmethod
    def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.sqrt(((a - b) ** 2).sum(-1))

    def _page(self, rows: np.ndarray, parent: int | None) -> int:
        points = self.points[rows]
        middle = rows[np.argmin(((points - points.mean(0)) ** 2).sum(1))]
        distances = self._distance(points, self.points[middle])
        page = len(self.object)
        self.object.append(middle)
        self.radius.append(float(distances.max()))
        self.to_parent.append(0.0 if parent is None else float(self._distance(self.points[middle], self.points[parent])))
        self.children.append(None)
        self.span.append((self.filled, self.filled))
        if len(rows) <= LEAF:
            self.order.append(rows)
            self.span[page] = (self.filled, self.filled + len(rows))
            self.filled += len(rows)
        else:
            self.children[page] = np.array([self._page(part, middle) for part in self._split(rows, points)])
        return page

    @staticmethod
    def _split(rows: np.ndarray, points: np.ndarray) -> list[np.ndarray]:
        """Clusters around objects chosen farthest first; equal points are cut by order."""
        count = min(FAN, math.ceil(len(rows) / LEAF))
        chosen, nearest = [0], ((points - points[0]) ** 2).sum(1)
        home = np.zeros(len(rows), np.int64)
        while len(chosen) < count and nearest.max() > 0:
            chosen.append(int(nearest.argmax()))
            distance = ((points - points[chosen[-1]]) ** 2).sum(1)
            closer = distance < nearest
            home[closer], nearest[closer] = len(chosen) - 1, distance[closer]
        parts = [rows[home == i] for i in range(len(chosen))]
        parts = [part for part in parts if len(part)]
        if max(map(len, parts)) > 0.9 * len(rows):
            return np.array_split(rows, count)
        return parts

    def search(self, query: np.ndarray, k: int, own: int) -> list[tuple[int, int]]:
        """The ``k`` best (score, id), without the row that has the query's id and vector."""
        q = np.append(query.astype(np.float64), 0.0)
        length = float(q @ q)
        slack = 1e-9 * (length + self.top) + 1e-6
        best: list[tuple[int, int]] = []  # heap of (score, -id), the worst first
        highest = lambda near: (length + self.top - near * near) / 2 + slack
        at_root = float(self._distance(q, self.page_points[0]))
        heap = [(-highest(max(0.0, at_root - self.radius[0])), 0, at_root)]
        while heap:
            bound, page, distance = heapq.heappop(heap)
            if len(best) == k and -bound < best[0][0]:
                break
            limit = best[0][0] if len(best) == k else -math.inf
            children = self.children[page]
            if children is None:
                first, behind = self.span[page]
                # What the stored distance to the leaf's object already rules out is not computed.
                near = np.abs(distance - self.to_object[first:behind])
                rows = first + np.flatnonzero(highest(near) >= limit)
                scores = self.vectors[rows] @ query
                order = np.lexsort((self.ids[rows], -scores))
                for i in order:
                    entry = (int(scores[i]), -int(self.ids[rows[i]]))
                    if -entry[1] == own and np.array_equal(self.vectors[rows[i]], query):
                        continue
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
                    else:
                        break
            else:
                near = np.maximum(0.0, np.abs(distance - self.to_parent[children]) - self.radius[children])
                kept = children[highest(near) >= limit]
                distances = self._distance(self.page_points[kept], q)
                bounds = highest(np.maximum(0.0, distances - self.radius[kept]))
                for child, d, high in zip(kept, distances, bounds):
                    if high >= limit:
                        heapq.heappush(heap, (-float(high), int(child), float(d)))
        return [(score, -negative) for score, negative in best]


def whole(rows: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """Distinct (id, v) with whole components; rows that take no part are gone."""
    scaled = F.transform(col(vector_col), lambda x: x.cast("double"))
    good: Column = F.forall(scaled, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    taken = rows.select(col(id_col).cast("bigint").alias("id"), scaled.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & good)
    return taken.select("id", F.transform("v", lambda x: F.floor(x * scale).cast("bigint")).alias("v")).distinct()


def build(vectors: DataFrame) -> DataFrame:
    """One tree per shard: ``width``, ``shard``, ``tree``; written to the shared folder."""
    sizes = vectors.groupBy(F.size("v").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    placed = vectors.withColumn("width", F.size("v")).join(sizes.withColumn("shards", F.ceil(F.col("n") / SHARD)).select("width", "shards"), "width")
    placed = placed.withColumn("shard", F.pmod(F.xxhash64("id", "v"), F.col("shards")))

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        tree = Tree(group["id"].to_numpy(np.int64), np.stack(group["v"].to_numpy()))
        return pd.DataFrame({"width": [int(group["width"].iloc[0])], "shard": [int(group["shard"].iloc[0])], "shards": [int(group["shards"].iloc[0])], "tree": [pickle.dumps(tree)]})

    return staged(placed.groupBy("width", "shard").applyInPandas(grow, "width int, shard bigint, shards bigint, tree binary"), "trees")


def top_k(rows: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """For every row where ``queries`` (over the column ``id``) holds: query_id, rank, vec_id, score."""
    vectors = staged(whole(rows, id_col, vector_col, scale), "vectors")
    trees = build(vectors)
    asked = vectors.where(queries)
    blocks = 1 + asked.count() // BLOCK
    grouped = asked.groupBy(F.size("v").alias("width"), F.pmod(F.xxhash64("v", "id"), F.lit(blocks)).alias("block")).agg(F.collect_list(F.struct("id", "v")).alias("asked"))
    shards = trees.groupBy("width").agg(F.max("shards").alias("shards"))
    sent = grouped.join(shards, "width").withColumn("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shards") - 1))).drop("shards")
    pairs = trees.drop("shards").join(sent, ["width", "shard"])
    tasks = min(10_000, trees.count() * blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tree = pickle.loads(batch.column("tree")[i].as_py())
                made = []
                for ask in batch.column("asked")[i].as_py():
                    query = np.array(ask["v"], np.int64)
                    made += [(ask["id"], ask["v"], found, score) for score, found in tree.search(query, k, ask["id"])]
                columns = list(zip(*made)) or [(), (), (), ()]
                kinds = [pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], ["query_id", "v", "vec_id", "score"])

    found = pairs.repartition(max(1, tasks), "shard", "block").mapInArrow(run, "query_id bigint, v array<bigint>, vec_id bigint, score bigint")
    order = W.partitionBy("query_id", F.xxhash64("v")).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
