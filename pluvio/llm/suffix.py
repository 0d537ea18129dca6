"""Removal of repeated byte strings by suffix arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere
else, in another document or in the same one. All starts count alike, and they
are judged on the input. Matches never cross documents. Documents with one text
are one text with a number of copies; two or more copies repeat all of it.

*Shards.* Every window of ``LENGTH`` bytes is named by the smallest hash among its
strings of ``GRAM`` bytes, the leftmost if several are, so equal windows have the
same name at the same place. Windows that have one such string in common are a
segment; no two of them are equal. Only names that occur more than once go on. A
segment whose content occurs again is repeated as a whole. Names with several
contents are dealt to shards, every content once, and a name's windows are all in
one shard.

*In a shard* the contents' suffixes are sorted by Larsson-Sadakane refinement in
numpy (groups that agree on ``h`` bytes are sorted by the ranks ``h`` bytes on, and
only groups not yet apart are touched again), up to the window's length. Kasai's
walk gives the common prefix of neighbours, in step over all contents: a window is
repeated if it shares ``LENGTH`` bytes with a neighbour.

*Across shards.* A name with more content than a shard holds is spread over
several. Each sorts the 128-bit hashes of its windows and sends slices of the
hash range; slices of one range are merged by binary search, and what
occurs twice is sent back and found in the sorted windows by binary search.

Names, contents and texts are 64-bit hashes, texts are looked up by theirs; among
10**10 texts a few at most would share one. Null texts are empty. Nothing is
capped: a periodic text is many short segments of few contents.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import col, free_name, staged, with_values, working
from pluvio.session import fresh_path

LENGTH, GRAM = 200, 32
SHARD = 1 << 20
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_BYTES = (np.arange(1, 257, dtype=np.uint64) * _A) ^ ((np.arange(1, 257, dtype=np.uint64) * _B) >> np.uint64(31))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    return x ^ (x >> np.uint64(29))


def rolled(data: np.ndarray, length: int, factor: np.uint64 = _A) -> np.ndarray:
    """Hashes of all strings of ``length`` bytes, by doubling."""
    if len(data) < length:
        return np.zeros(0, np.uint64)
    power, level, made, done = factor, _BYTES[data], None, 0
    size = 1
    while True:
        if length & size:
            part = level[done:] if made is not None else level
            if made is None:
                made = level
            else:
                count = min(len(made), len(part))
                made = made[:count] * power + part[:count]
            done += size
        if done == length:
            return _mix(made[: len(data) - length + 1])
        level = level[:-size] * power + level[size:]
        power = np.uint64(int(power) * int(power) % 2**64)
        size *= 2


def smallest(hashes: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours."""
    low, size = hashes, 1
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    rest = width - size
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def text_hash(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


#: Low bits that hold a place, and windows looked at together.
_PLACE, _STEP = np.uint64((1 << 24) - 1), 1 << 23


def segments(data: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """Names, first windows and numbers of windows of a text's segments, and hashes of their content."""
    array, view = np.frombuffer(data, np.uint8), memoryview(data)
    gram = min(GRAM, length)
    names, firsts, counts = [], [], []
    for start in range(0, len(data) - length + 1, _STEP):
        hashes = rolled(array[start : start + _STEP + length - 1], gram)
        low = smallest((hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64), length - gram + 1) & _PLACE
        cuts = np.flatnonzero(low[1:] != low[:-1]) + 1
        first = np.concatenate([[0], cuts])
        names.append(hashes[low[first]].view(np.int64))
        firsts.append(first + start)
        counts.append(np.append(cuts, len(low)) - first)
    first, many = np.concatenate(firsts), np.concatenate(counts)
    content = [text_hash(view[a : a + n + length - 1]) for a, n in zip(first.tolist(), many.tolist())]
    return np.concatenate(names), first, many, content


def repeated_windows(contents: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each content, which of its windows start elsewhere too among the contents."""
    sizes = np.array([len(c) for c in contents], np.int64)
    starts = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(contents), np.uint8).astype(np.int64)
    n = len(data)
    owner = np.repeat(np.arange(len(contents)), sizes)
    end = np.repeat(starts + sizes, sizes)
    place = np.arange(n)
    # Suffix array: the first seven bytes, then Larsson-Sadakane refinement.
    key, left = np.zeros(n, np.int64), end - place
    ahead = np.concatenate([data + 1, np.zeros(7, np.int64)])
    for k in range(7):
        key *= 257
        key += np.where(left > k, ahead[k : k + n], 0)
    order = np.argsort(key)
    fresh = np.append(True, key[order][1:] != key[order][:-1])
    rank = np.empty(n, np.int64)
    heads = np.flatnonzero(fresh)
    rank[order] = heads[np.cumsum(fresh) - 1]
    grouped = ~(fresh & np.append(fresh[1:], True))
    slots, h = np.flatnonzero(grouped), 7
    while h < length and len(slots):
        p = order[slots]
        beyond = p + h
        inside = h < left[p]
        second = np.where(inside, rank[np.where(inside, beyond, 0)], -1 - owner[p])
        first = rank[p]
        # Both ranks in one number: one sort instead of two.
        sorted_ = np.argsort(first * (n + len(contents) + 1) + second + len(contents) + 1)
        p, first, second = p[sorted_], first[sorted_], second[sorted_]
        order[slots] = p
        fresh = np.append(True, (first[1:] != first[:-1]) | (second[1:] != second[:-1]))
        rank[p] = slots[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
        slots = slots[~(fresh & np.append(fresh[1:], True))]
        h *= 2
    rank[order] = place
    # Kasai's walk over all contents in step; common prefixes beyond ``length`` are not needed.
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    windows = np.maximum(sizes - length + 1, 0)
    common = np.zeros(n + 1, np.int64)
    by_length = np.argsort(-windows, kind="stable")
    shared, last = np.zeros(len(contents), np.int64), np.zeros(len(contents), np.int64)
    most = np.minimum(left, length)
    for t in range(int(windows.max(initial=0))):
        active = by_length[: np.searchsorted(-windows[by_length], -t, side="left")]
        p = starts[active] + t
        q = before[p]
        got = np.maximum(shared[active] - 1, 0)
        # One byte less carries over if the last neighbour's next suffix still comes first;
        # among suffixes alike beyond the sorted depth it may not.
        got[(q < 0) | (rank[np.minimum(last[active] + 1, n - 1)] > rank[p])] = 0
        grow = np.flatnonzero(q >= 0)
        while len(grow):
            one, two, g = p[grow], q[grow], got[grow]
            ok = (g < most[one]) & (g < most[two])
            ok &= ahead[one + g] == ahead[two + g]
            grow = grow[ok]
            got[grow] = g[ok] + 1
        shared[active], last[active] = got, q
        common[rank[p]] = got
    twice = common >= length
    found = twice[rank] | twice[rank + 1]
    return [found[s : s + w] for s, w in zip(starts.tolist(), windows.tolist())]


def runs(mask: np.ndarray) -> list[tuple[int, int]]:
    """The runs of true values as (first, behind)."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans joined."""
    made: list[tuple[int, int]] = []
    for first, behind in sorted(spans):
        if made and first <= made[-1][1]:
            made[-1] = (made[-1][0], max(made[-1][1], behind))
        else:
            made.append((first, behind))
    return made


def kept(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, place = [], 0
    for first, behind in spans:
        parts.append(data[place:first])
        place = behind
    return b"".join([*parts, data[place:]])


# Spark ------------------------------------------------------------------------


def _bucketed(df: DataFrame, key: str) -> DataFrame:
    """The rows as a table bucketed by ``key``, so that joins on it move only the other side."""
    spark = df.sparkSession
    name, buckets = f"texts_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).option("path", fresh_path(spark, "texts")).saveAsTable(name)
    return spark.table(name)


def packed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, size, z): each document's text hash, bytes and compressed text."""
    rows = docs.select(col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).cast("binary").alias("b"))

    def run(texts: list) -> list[dict]:
        press = zstandard.ZstdCompressor(level=1)
        return [{"text": text_hash(t), "size": len(t), "z": press.compress(t)} for t in texts]

    kind = pa.struct([("text", pa.int64()), ("size", pa.int64()), ("z", pa.binary())])
    return with_values(rows, "b", "p", "struct<text:bigint, size:bigint, z:binary>", kind, run).select("id", "p.text", "p.size", "p.z")


def _unpacked(z: bytes, size: int) -> bytes:
    return zstandard.ZstdDecompressor().decompress(z, max_output_size=size) if size else b""


def _segments(texts: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                parts = []
                working("suffix")
                for row in batch.slice(start, 64).to_pylist():
                    name, first, many, content = segments(_unpacked(row["z"], row["size"]), length)
                    parts.append((name, np.array(content, np.int64), np.full(len(first), row["text"], np.int64), first, many))
                if parts:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], ["name", "content", "text", "first", "many"])

    return texts.where(F.col("size") >= length).select("text", "size", "z").mapInArrow(run, "name bigint, content bigint, text bigint, first bigint, many bigint")


def _cut_out(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The wanted segments with their bytes."""
    listed = wanted.groupBy("text").agg(F.collect_list(F.struct("first", "many", "name", "content", "parts")).alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["name", "content", "parts", "text", "first", "data"]
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in ("text", "size", "z", "wanted")}
                data, w = _unpacked(row["z"], row["size"]), row["wanted"]
                yield pa.RecordBatch.from_arrays([
                    pa.array([x["name"] for x in w], pa.int64()), pa.array([x["content"] for x in w], pa.int64()), pa.array([x["parts"] for x in w], pa.int64()),
                    pa.array([row["text"]] * len(w), pa.int64()), pa.array([x["first"] for x in w], pa.int64()),
                    pa.array([data[x["first"] : x["first"] + x["many"] + length - 1] for x in w], pa.binary()),
                ], names)

    return texts.join(listed, "text").select("text", "size", "z", "wanted").mapInArrow(run, "name bigint, content bigint, parts bigint, text bigint, first bigint, data binary")


SPAN = "text bigint, first bigint, behind bigint"


def _in_shards(cut: DataFrame, shards: int, length: int) -> DataFrame:
    def run(group: pd.DataFrame) -> pd.DataFrame:
        made = []
        for text, first, mask in zip(group["text"].tolist(), group["first"].tolist(), repeated_windows(group["data"].tolist(), length)):
            made += [(text, first + a, first + b + length - 1) for a, b in runs(mask)]
        return pd.DataFrame(made, columns=["text", "first", "behind"]).astype("int64")

    return cut.withColumn("shard", F.pmod(F.xxhash64("name"), F.lit(shards))).groupBy("shard").applyInPandas(run, SPAN)


def _window_hashes(contents: list[bytes], length: int) -> list[np.ndarray]:
    made = []
    for content in contents:
        array = np.frombuffer(content, np.uint8)
        both = np.empty(len(array) - length + 1, [("a", np.uint64), ("b", np.uint64)])
        both["a"], both["b"] = rolled(array, length), rolled(array, length, _B)
        made.append(both)
    return made


def _across(cut: DataFrame, length: int) -> DataFrame:
    """Spans of names that are spread over several shards."""
    placed = cut.withColumn("part", F.pmod(F.xxhash64("content"), F.col("parts")))
    pair = [("a", np.uint64), ("b", np.uint64)]

    def send(group: pd.DataFrame) -> pd.DataFrame:
        unique, n = np.unique(np.concatenate(_window_hashes(group["data"].tolist(), length)), return_counts=True)
        slices = int(group["parts"].iloc[0])
        edges = np.array([int(2**64 * i / slices) for i in range(1, slices)], np.uint64)
        cuts = [0, *np.searchsorted(unique["a"], edges).tolist(), len(unique)]
        made = [(i, unique[a:b].tobytes(), (n[a:b] > 1).tobytes()) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
        return pd.DataFrame({"name": group["name"].iloc[0], "part": int(group["part"].iloc[0]), "slice": [m[0] for m in made], "hashes": [m[1] for m in made], "twice": [m[2] for m in made]})

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        lists = [np.frombuffer(h, pair) for h in group["hashes"]]
        merged = np.unique(np.concatenate(lists))
        seen = np.zeros(len(merged), np.int64)
        for hashes, twice in zip(lists, group["twice"]):
            seen[np.searchsorted(merged, hashes)] += 1 + np.frombuffer(twice, bool)
        back = [hashes[seen[np.searchsorted(merged, hashes)] > 1].tobytes() for hashes in lists]
        return pd.DataFrame({"name": group["name"], "part": group["part"], "hashes": back})

    def find(group: pd.DataFrame, back: pd.DataFrame) -> pd.DataFrame:
        made = []
        if len(group) and len(back):
            again = np.sort(np.concatenate([np.frombuffer(h, pair) for h in back["hashes"]]))
            for text, first, hashes in zip(group["text"].tolist(), group["first"].tolist(), _window_hashes(group["data"].tolist(), length)):
                place = np.minimum(np.searchsorted(again, hashes), max(0, len(again) - 1))
                mask = again[place] == hashes if len(again) else np.zeros(len(hashes), bool)
                made += [(text, first + a, first + b + length - 1) for a, b in runs(mask)]
        return pd.DataFrame(made, columns=["text", "first", "behind"]).astype("int64")

    sent = placed.groupBy("name", "part").applyInPandas(send, "name bigint, part bigint, slice bigint, hashes binary, twice binary")
    merged = staged(sent.groupBy("name", "slice").applyInPandas(merge, "name bigint, part bigint, hashes binary"), "merged")
    return placed.groupBy("name", "part").cogroup(merged.groupBy("name", "part")).applyInPandas(find, SPAN)


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three tables: (id, text) of the documents, the bucketed texts, and (text, spans) of texts with repeats.

    ``text`` is the hash of a document's text; spans are byte ranges, joined.
    """
    rows = packed(docs, id_col, text_col)
    texts = _bucketed(rows.groupBy("text").agg(F.first("z").alias("z"), F.first("size").alias("size"), F.count(F.lit(1)).alias("copies")), "text")
    found = staged(_segments(texts, length), "segments")
    names = found.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min("content").alias("least"), F.max("content").alias("most")).where("n > 1")
    again = staged(found.join(names.select("name", (F.col("least") != F.col("most")).alias("mixed")), "name"), "repeated-names")
    distinct = again.groupBy("name", "content").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("text", "first", "many")).alias("at"), F.first("mixed").alias("mixed"))
    distinct = staged(distinct.select("name", "content", "n", "at.*", "mixed"), "contents")
    whole = again.join(distinct.where("n > 1").select("name", "content"), ["name", "content"]).select("text", "first", (F.col("first") + F.col("many") + length - 1).alias("behind"))
    spans = [whole, texts.where((F.col("copies") > 1) & (F.col("size") >= length)).select("text", F.lit(0).cast("bigint").alias("first"), F.col("size").alias("behind"))]
    mixed = distinct.where("mixed")
    size = F.sum(F.col("many") + length - 1)
    weights = mixed.groupBy("name").agg(size.alias("bytes"))
    total = weights.agg(F.sum("bytes")).first()[0] or 0
    if total:
        wanted = mixed.join(weights, "name").withColumn("parts", F.ceil(F.col("bytes") / SHARD))
        cut = staged(_cut_out(texts, wanted, length), "cut-out")
        spans.append(_in_shards(cut.where("parts = 1"), 1 + total // SHARD, length))
        spread = cut.where("parts > 1")
        if not spread.isEmpty():
            spans.append(_across(spread, length))
    listed = spans[0]
    for more in spans[1:]:
        listed = listed.unionByName(more)
    collected = listed.groupBy("text").agg(F.collect_list(F.struct("first", "behind")).alias("spans"))
    kind = pa.list_(pa.struct([("first", pa.int64()), ("behind", pa.int64())]))
    joined = with_values(
        collected, "spans", "joined", "array<struct<first:bigint, behind:bigint>>", kind,
        lambda found: [[{"first": a, "behind": b} for a, b in union([(s["first"], s["behind"]) for s in spans])] for spans in found],
    ).select("text", F.col("joined").alias("spans"))
    return rows.select("id", "text"), texts, staged(joined, "spans")


def summary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """For each document its bytes, removed bytes, spans, and the SHA-256 of the rest."""
    rows, texts, spans = repeats(docs, id_col, text_col, length)

    def run(found: list) -> list[dict]:
        made = []
        for row in found:
            cuts = [(s["first"], s["behind"]) for s in row["spans"] or []]
            rest = kept(_unpacked(row["z"], row["size"]), cuts)
            made.append({"n_bytes": row["size"], "n_removed": row["size"] - len(rest), "n_spans": len(cuts), "kept_sha256": hashlib.sha256(rest).hexdigest()})
        return made

    kind = pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])
    joined = texts.join(spans, "text", "left").select("text", F.struct("z", "size", "spans").alias("row"))
    made = with_values(joined, "row", "made", "struct<n_bytes:bigint, n_removed:bigint, n_spans:bigint, kept_sha256:string>", kind, run)
    results = staged(made.select("text", "made.*"), "results")
    return rows.join(results, "text").drop("text").withColumnRenamed("id", id_col)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, chars_col: str | None = "n_chars") -> DataFrame:
    """The documents, all their columns, with repeated bytes cut out of their texts.

    A character that lost some of its bytes is dropped whole. Null texts stay
    null. ``chars_col``, if the documents have it, is counted anew where the text changed.
    """
    _, _, spans = repeats(docs, id_col, text_col, length)
    name, cuts, made = free_name(docs, "text_hash"), free_name(docs, "cuts"), free_name(docs, "rest")
    marked = with_values(docs, text_col, name, "bigint", pa.int64(), lambda texts: [text_hash((t or "").encode("utf-8", "replace")) for t in texts])
    joined = marked.join(spans.select(F.col("text").alias(name), F.col("spans").alias(cuts)), name, "left")
    pair = free_name(joined, "pair")
    paired = joined.withColumn(pair, F.struct(col(text_col).alias("text"), col(cuts).alias("spans")))

    def run(found: list) -> list[str | None]:
        return [
            row["text"] if row["text"] is None or not row["spans"]
            else kept(row["text"].encode("utf-8", "replace"), [(s["first"], s["behind"]) for s in row["spans"]]).decode("utf-8", "ignore")
            for row in found
        ]

    cut = with_values(paired, pair, made, "string", pa.string(), run)
    changed = {text_col: col(made)}
    if chars_col in docs.columns:
        kind = docs.schema[chars_col].dataType
        changed[chars_col] = F.when(F.size(col(cuts)) > 0, F.char_length(col(made)).cast(kind)).otherwise(col(chars_col))
    return cut.select(*[changed.get(c, col(c)).alias(c) for c in docs.columns])
