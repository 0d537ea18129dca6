"""N-gram Jaccard join by chosen paths.

Documents are sets of shingles (``width`` consecutive words; shorter texts are one
shingle). Documents with the same set form one class, and the join runs over
classes. A class's sketch has ``SKETCH`` min-hashes, so two sketches agree at a
position with probability equal to the Jaccard similarity.

*Splitting.* A run starts every set at a root. At each node every position of the
sketch is chosen with probability ``1 / (LAMBDA * SKETCH)``, by a hash of the node
and the position; the sets that agree there, having sampled a shared token, meet
in the child node. Sets less alike than ``LAMBDA`` are soon apart. Every run goes
``DEPTH`` levels down at once; buckets with more than ``LARGE`` members or
``HEAVY`` shingles are split further, level by level, to ``DEEPEST``, unless their
children show that their members are more alike than ``LAMBDA`` on average, when
splitting would only copy them. Buckets that stay large are cut into blocks and
every two blocks meet, so no bucket is dropped.

*Runs.* A pair at the threshold survives a run with at least the probability that
a branching process with mean ``threshold / LAMBDA`` never dies, whatever the
depth. Runs are repeated until that makes ``TARGET`` recall. Everything found is
verified on whole shingle sets, so nothing false is returned.

*Brute force.* A bucket's intersections are counted by a matrix product over the
shingles that several members share. A pair that meets in several buckets counts
in the one with the lowest id. Buckets hand back the number of links of each
member and a star for each connected part, never pairs. Stars are joined to
components by alternating star contractions.

Documents without words (null, empty, signs only) or without an id stand alone.
Documents with the same id are told apart by their sets; the operators that
return documents give each row the result of its own set.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pluvio.llm.common import col, free_name, kept_by, staged, with_values, working
from pluvio.llm.decontaminate import words

WIDTH, THRESHOLD, TARGET = 5, 0.8, 0.995
SKETCH, LAMBDA = 64, 0.5
DEPTH, DEEPEST = 3, 6
LARGE, HEAVY = 2048, 1 << 20
MEMORY = 500_000
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; wraps around."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    return x ^ (x >> np.uint64(27)) * _M1


_known: dict[bytes, int] = {}
kept_by("chosen_path", _known.clear)


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The text's distinct shingles as sorted 64-bit hashes."""
    working("chosen_path")
    found = words(text)
    if not found:
        return np.zeros(0, np.uint64)
    if len(_known) > MEMORY:
        _known.clear()
    numbers = []
    for word in found:
        number = _known.get(word)
        if number is None:
            number = _known[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        numbers.append(number)
    hashes = np.array(numbers, np.uint64)
    size = min(width, len(found))
    rolled = np.zeros(len(found) - size + 1, np.uint64)
    for k in range(size):
        rolled = _mix(rolled * _M1 + hashes[k : len(found) - size + 1 + k] + np.uint64(k + 1))
    return np.unique(rolled)


def set_id(found: np.ndarray) -> int | None:
    """The class: a 64-bit hash of the whole set; two of 10**10 different sets share one with odds of a few in all."""
    return int.from_bytes(hashlib.blake2b(found.tobytes(), digest_size=8).digest(), "little", signed=True) if len(found) else None


_SEEDS = _mix(np.arange(1, SKETCH + 1, dtype=np.uint64) * _M1)


def sketch(found: np.ndarray) -> np.ndarray:
    """The lower 32 bits of the min-hashes."""
    low = np.full(SKETCH, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(found), 4096):
        part = found[start : start + 4096]
        low = np.minimum(low, _mix(part[None, :] ^ _SEEDS[:, None]).min(1))
    return low.astype(np.uint32)


def children(nodes: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The child nodes of one set at ``nodes``."""
    position = np.arange(SKETCH, dtype=np.uint64)
    draw = _mix(nodes[:, None] ^ _mix(position * _M1 + np.uint64(77))[None, :])
    chosen, place = np.nonzero(draw < np.uint64(2**64 / (LAMBDA * SKETCH)))
    return np.unique(_mix(_mix(nodes[chosen] + position[place] * _M1) ^ values[place].astype(np.uint64) * _M2))


def runs_needed(threshold: float, target: float = TARGET) -> int:
    """Runs until a pair at the threshold has met with probability ``target``."""
    survives = 1.0
    for _ in range(200):
        survives = 1 - math.exp(-threshold / LAMBDA * survives)
    return math.ceil(math.log(1 - target) / math.log(1 - survives))


def roots(runs: int) -> np.ndarray:
    return _mix(np.arange(1, runs + 1, dtype=np.uint64) * _M2)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def with_sets(docs: DataFrame, text_col: str, as_col: str, width: int) -> DataFrame:
    """The documents with ``as_col``: class, number of shingles, sketch."""

    def run(texts: list) -> list[dict]:
        made = []
        for text in texts:
            found = shingles(text, width)
            made.append({"set": set_id(found), "n": len(found), "sketch": sketch(found).tobytes() if len(found) else None})
        return made

    kind = pa.struct([("set", pa.int64()), ("n", pa.int32()), ("sketch", pa.binary())])
    return with_values(docs, text_col, as_col, "struct<set:bigint, n:int, sketch:binary>", kind, run, rows=64)


def _paths(classes: DataFrame, runs: int) -> DataFrame:
    """(node, set, n): where each class is after ``DEPTH`` levels of every run."""
    start = roots(runs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                nodes, counts = [], []
                for value in part.column(2).to_pylist():
                    found, values = start, np.frombuffer(value, np.uint32)
                    for _ in range(DEPTH):
                        found = children(found, values)
                    nodes.append(found)
                    counts.append(len(found))
                place = pa.array(np.repeat(np.arange(part.num_rows), counts))
                yield pa.RecordBatch.from_arrays([pa.array(_signed(np.concatenate(nodes))), part.column(0).take(place), part.column(1).take(place)], ["node", "set", "n"])

    return classes.select("set", "n", "sketch").mapInArrow(run, "node bigint, set bigint, n int")


def _next_level(large: DataFrame, classes: DataFrame) -> DataFrame:
    """The large nodes' rows one level down, with the node they come from and its members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column(0).to_numpy().view(np.uint64)
            found = [children(nodes[i : i + 1], np.frombuffer(v, np.uint32)) for i, v in enumerate(batch.column(4).to_pylist())]
            place = pa.array(np.repeat(np.arange(batch.num_rows), [len(f) for f in found]))
            if len(place):
                yield pa.RecordBatch.from_arrays([pa.array(_signed(np.concatenate(found))), *[batch.column(k).take(place) for k in (1, 2, 0, 3)]], ["node", "set", "n", "parent", "above"])

    rows = large.select("node", "set", "n", "members").join(classes.select("set", "sketch"), "set").select("node", "set", "n", "members", "sketch")
    return rows.mapInArrow(run, "node bigint, set bigint, n int, parent bigint, above bigint")


def _sized(rows: DataFrame) -> DataFrame:
    """The rows whose node holds at least two classes, with the node's members and shingles."""
    # Counting the sets keeps the rows' columns the same for both sides, so they are made and dealt once.
    sizes = rows.groupBy("node").agg(F.count("set").alias("members"), F.sum("n").alias("weight")).where("members > 1")
    return rows.join(sizes, "node")


def buckets(classes: DataFrame, threshold: float) -> DataFrame:
    """(bucket, set): the small buckets of all runs, each membership once."""
    # Dealt by node once, for the sizes and for the join; the paths are walked once.
    paths = _paths(classes, runs_needed(threshold)).repartition("node")
    rows = staged(_sized(paths), "paths")
    small = (F.col("members") <= LARGE) & (F.col("weight") <= HEAVY)
    leaves, dense, large = [rows.where(small)], [], rows.where(~small)
    for _ in range(DEPTH, DEEPEST):
        if large.isEmpty():
            break
        below = staged(_next_level(large, classes), "paths")
        sizes = below.groupBy("parent", "node").agg(F.count(F.lit(1)).alias("members"), F.first("above").alias("above"))
        # The share of its members that a member meets again in a child is their mean similarity.
        alike = sizes.groupBy("parent").agg((F.sum(F.col("members") * F.col("members")) / F.sum("members") / F.first("above")).alias("alike"))
        alike = staged(alike.where(F.col("alike") >= LAMBDA).select(F.col("parent").alias("node")), "alike")
        dense.append(large.join(alike, "node", "left_semi"))
        rows = staged(_sized(below.join(alike.withColumnRenamed("node", "parent"), "parent", "left_anti").select("node", "set", "n")), "paths")
        leaves.append(rows.where(small))
        large = rows.where(~small)
    rest = large
    for more in dense:
        rest = rest.unionByName(more)
    listed = leaves[0]
    for leaf in leaves[1:]:
        listed = listed.unionByName(leaf)
    # Buckets with the same members are one; pairs of copies meet in most runs.
    grouped = listed.groupBy("node").agg(F.sort_array(F.collect_list("set")).alias("sets"))
    made = grouped.select(F.xxhash64("sets").alias("bucket"), "sets").dropDuplicates(["bucket"]).select("bucket", F.explode("sets").alias("set"))
    if not rest.isEmpty():
        blocks = F.ceil(F.greatest(F.col("members") / (LARGE // 2), F.col("weight") / (HEAVY // 2))).cast("int")
        own = F.pmod(F.xxhash64("set", F.lit(5)), F.col("blocks")).cast("int")
        pairs = rest.withColumn("blocks", blocks).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        made = made.unionByName(pairs.select(F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other")).alias("bucket"), "set"))
    return made


def similar(arrays: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which of the sets have at least the threshold's Jaccard similarity."""
    sizes = np.array([len(a) for a in arrays], np.int64)
    _, place, counts = np.unique(np.concatenate(arrays), return_inverse=True, return_counts=True)
    # Only shingles of two sets or more count; they are numbered in order.
    common = counts > 1
    number, n = np.cumsum(common) - 1, int(common.sum())
    inter = np.zeros((len(arrays), len(arrays)), np.float32)
    ends = np.cumsum(sizes)
    places = [number[p[common[p]]] for p in np.split(place, ends[:-1])] if n else []
    step = max(1, (8 << 20) // len(arrays))
    for start in range(0, n, step):
        part = np.zeros((len(arrays), min(step, n - start)), np.float32)
        for i, place in enumerate(places):
            a, b = np.searchsorted(place, [start, start + step])
            part[i, place[a:b] - start] = 1
        inter += part @ part.T
    union = sizes[:, None] + sizes[None, :] - inter
    return (inter.astype(np.float64) / union >= threshold - 1e-12) & ~np.eye(len(arrays), dtype=bool)


def _compared(bucket: int, parts: list[pa.RecordBatch], threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Set, links and root of the classes of one bucket that are linked in it."""
    sets, first = np.unique(np.concatenate([p.column("set").to_numpy() for p in parts]), return_index=True)
    if len(sets) < 2:
        return None
    shingles = [v for p in parts for v in p.column("shingles").to_pylist()]
    near = similar([np.frombuffer(shingles[i], np.uint64) for i in first], threshold)
    if not near.any():
        return None
    copies = np.concatenate([p.column("copies").to_numpy() for p in parts])[first]
    # Pairs that also meet in a bucket with a lower id count there.
    met = [v for p in parts for v in p.column("buckets").to_pylist()]
    lower = [np.array([b for b in met[i] if b < bucket], np.int64) for i in first]
    seen = np.unique(np.concatenate(lower))
    earlier = np.zeros(near.shape, np.float32)
    for start in range(0, len(seen), 8192):
        part = np.zeros((len(sets), min(8192, len(seen) - start)), np.float32)
        for i, found in enumerate(lower):
            place = np.searchsorted(seen, found) - start
            part[i, place[(place >= 0) & (place < part.shape[1])]] = 1
        earlier += part @ part.T
    links = ((near & (earlier == 0)) * copies[None, :]).sum(1)
    root = np.full(len(sets), -1)
    for i in range(len(sets)):
        if root[i] < 0:
            front = np.array([i])
            root[i] = i
            while len(front):
                reach = near[front].any(0) & (root < 0)
                root[reach] = i
                front = np.flatnonzero(reach)
    kept = (links > 0) | (root != np.arange(len(sets)))
    return sets[kept], links[kept], sets[root][kept]


def _brute(whole: DataFrame, threshold: float) -> DataFrame:
    """(set, links, root) of every bucket; rows of a bucket follow one another, most buckets are tiny."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bucket, made = [], None, []

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*made)], ["set", "links", "root"])

        for batch in batches:
            ids = batch.column("bucket").to_numpy()
            edges = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
            for a, b in zip(edges, edges[1:]):
                if held and ids[a] != bucket:
                    made.append(_compared(bucket, held, threshold))
                    held = []
                bucket = int(ids[a])
                held.append(batch.slice(a, b - a))
            made = [m for m in made if m is not None]
            if made:
                yield rows()
                made = []
        if held:
            made = [m for m in [_compared(bucket, held, threshold)] if m is not None]
            if made:
                yield rows()

    dealt = whole.select("bucket", "set", "copies", "buckets", "shingles").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "set bigint, links bigint, root bigint")


def components(edges: DataFrame) -> DataFrame:
    """(set, root) for every class in ``edges`` (set, root), by large and small stars."""
    edges = staged(edges.select(F.greatest("set", "root").alias("a"), F.least("set", "root").alias("b")).where("a != b").distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if state == before:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        large = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        edges = staged(small.where("a != b").distinct(), "edges")
    return edges.select(F.col("a").alias("set"), F.col("b").alias("root"))


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, threshold: float = THRESHOLD) -> DataFrame:
    """``id_col``, ``set``, ``class_id`` and ``n_links`` for every document.

    ``class_id`` is the smallest id among the documents linked directly or by
    way of others; ``n_links`` counts the other documents at the threshold or
    above, copies included.
    """
    rows = docs.select(col(id_col).alias("id"), col(text_col).alias("text"))
    found = staged(with_sets(rows, "text", "s", width).select("id", "s.set", "s.n", "s.sketch"), "sets")
    members = found.select("id", "set", "n").where("id is not null and set is not null")
    sizes = members.groupBy("set").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"))
    classes = staged(found.where("id is not null and set is not null").select("set", "n", "sketch").dropDuplicates(["set"]), "classes")
    placed = staged(buckets(classes, threshold), "buckets")
    meets = placed.groupBy("set").agg(F.collect_list("bucket").alias("buckets")).join(sizes.drop("n"), "set")

    def again(texts: list) -> list[dict]:
        made = []
        for text in texts:
            shingled = shingles(text, width)
            made.append({"set": set_id(shingled), "shingles": shingled.tobytes()})
        return made

    texts = rows.withColumnRenamed("id", "first").join(meets, "first")
    kind = pa.struct([("set", pa.int64()), ("shingles", pa.binary())])
    shingled = with_values(texts, "text", "again", "struct<set:bigint, shingles:binary>", kind, again, rows=64)
    whole = shingled.where(F.col("again.set") == F.col("set")).select("set", "copies", "buckets", F.col("again.shingles").alias("shingles"), F.explode("buckets").alias("bucket"))
    stars = staged(_brute(whole, threshold), "stars")
    links = stars.groupBy("set").agg(F.sum("links").alias("links"))
    parts = components(stars.where("set != root"))
    named = sizes.join(links, "set", "left").join(parts, "set", "left").withColumn("root", F.coalesce("root", "set"))
    lowest = named.groupBy("root").agg(F.min("first").alias("class_id"))
    result = named.join(lowest, "root").select("set", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return found.select("id", "set").join(staged(result, "linked"), "set", "left").select(
        F.col("id").alias(id_col), "set", F.coalesce(F.when(F.col("id").isNotNull(), F.col("class_id")), F.col("id")).alias("class_id"), F.coalesce(F.when(F.col("id").isNotNull(), F.col("n_links")), F.lit(0)).cast("long").alias("n_links")
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents, all their columns, that stay: of each class the one with the smallest id.

    Of rows with that id one row stays; rows that stand alone stay all.
    """
    linked = join(docs, id_col, text_col, **options).where(col(id_col).isNotNull())
    gone, gone_set, mark = (free_name(docs, name) for name in ("gone", "gone_set", "set_of_text"))
    doomed = linked.where(col(id_col) != F.col("class_id")).select(col(id_col).alias(gone), F.col("set").alias(gone_set)).distinct()

    def run(texts: list) -> list[int | None]:
        return [set_id(shingles(text, options.get("width", WIDTH))) for text in texts]

    marked = with_values(docs, text_col, mark, "bigint", pa.int64(), run, rows=64)
    kept = marked.join(doomed, (col(id_col) == col(gone)) & (col(mark) == col(gone_set)), "left_anti")
    place = free_name(docs, "place_of_row")
    order = W.partitionBy(col(id_col), col(mark), F.when(col(mark).isNull() | col(id_col).isNull(), F.monotonically_increasing_id())).orderBy(F.xxhash64(col(text_col)))
    return kept.withColumn(place, F.row_number().over(order)).where(col(place) == 1).select(*[col(c) for c in docs.columns])
