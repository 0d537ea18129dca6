"""Benchmark decontamination as a prefix-filtered set join.

An item's shingles are its windows of ``width`` consecutive words (the whole
item if it has fewer). The threshold is full containment, so of a window's words
in order of rarity one is the necessary prefix: its rarest, counted over all
documents. Documents are joined to windows on that word alone. A candidate must
then lie inside the document (length bound) with the word at its place in the
window (positional bound), and the window is compared word by word.

The windows of a block of items, at most ``BLOCK`` bytes of item text, are
broadcast; a larger benchmark is worked through in as many blocks as it needs,
each adding its finds to those before. Documents are never shuffled, and a word
that is in every document costs one comparison per place where it stands.

Words: A-Z in lower case, then runs of digits, a-z and everything beyond ASCII.
Null and empty texts have no words, and items without words match nothing.
Items without an id mark words but are not listed. Repeated documents are judged
each, repeated items count once.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import col, free_name, with_values

WIDTH = 13
BLOCK = 16 << 20
#: Everything that is no word byte becomes a space, A-Z become a-z.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("behind", pa.int64())]))
_FOUND = pa.struct([("n_words", pa.int64()), ("spans", _SPANS), ("items", pa.list_(pa.string()))])
FOUND = "struct<n_words:bigint, spans:array<struct<first:bigint, behind:bigint>>, items:array<string>>"


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_FOLD).split()


def windows(item: list[bytes], width: int) -> Iterator[tuple[bytes, ...]]:
    size = min(width, len(item))
    for start in range(len(item) - size + 1 if size else 0):
        yield tuple(item[start : start + size])


def word_counts(docs: DataFrame, text_col: str, vocabulary: set[bytes]) -> dict[bytes, int]:
    """In how many documents each word of a bounded vocabulary stands."""
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0):
                found.update(shipped.value.intersection(words(text.as_py())))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], ["word", "n"])

    parts = docs.select(col(text_col).alias("text")).mapInArrow(count, "word binary, n bigint")
    return {bytes(r["word"]): r["n"] for r in parts.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def _index(items: list[tuple[str | None, list[bytes]]], counts: dict[bytes, int], width: int) -> dict:
    """Prefix word -> its windows: place of the word, the window, the items that have it."""
    owners: dict[tuple[bytes, ...], set[str]] = defaultdict(set)
    for item, item_words in items:
        for window in windows(item_words, width):
            owners[window].update([item] if item is not None else [])
    index = defaultdict(list)
    for window, ids in owners.items():
        prefix = min(window, key=lambda word: (counts.get(word, 0), word))
        index[prefix].append((window.index(prefix), list(window), sorted(ids)))
    return dict(index)


def _find(text: str | None, index: dict, before: dict | None) -> dict:
    doc = words(text)
    spans = [(s["first"], s["behind"]) for s in before["spans"]] if before else []
    items = set(before["items"]) if before else set()
    for place, word in enumerate(doc):
        if word in index:
            for offset, window, ids in index[word]:
                first = place - offset
                if first >= 0 and first + len(window) <= len(doc) and doc[first : first + len(window)] == window:
                    spans.append((first, first + len(window)))
                    items.update(ids)
    joined: list[list[int]] = []
    for first, behind in sorted(spans):
        if joined and first <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], behind)
        else:
            joined.append([first, behind])
    return {"n_words": len(doc), "spans": [{"first": a, "behind": b} for a, b in joined], "items": sorted(items)}


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, limit: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """The items in blocks of about ``limit`` bytes of text."""
    items = benchmark.select(col(id_col).cast("string").alias("item"), col(text_col).alias("text")).where("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + size // limit
    for block in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        yield [(r["item"], words(r["text"])) for r in part.collect()]


def contamination(docs: DataFrame, benchmark: DataFrame, as_col: str = "contamination", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """The documents with ``as_col``: word count, hit runs of words, ids of the items found."""
    found = docs
    last: str | None = None
    for items in _blocks(benchmark, item_id, item_text, block):
        counts = word_counts(docs, text_col, {word for _, item in items for word in item})
        shipped = docs.sparkSession.sparkContext.broadcast(_index(items, counts, width))
        made = free_name(found, as_col)
        if last is None:
            found = with_values(found, text_col, made, FOUND, _FOUND, lambda texts, s=shipped: [_find(t, s.value, None) for t in texts])
        else:
            pair = free_name(found, "pair")
            paired = found.withColumn(pair, F.struct(col(text_col).alias("text"), col(last).alias("before")))
            both = with_values(paired, pair, made, FOUND, _FOUND, lambda rows, s=shipped: [_find(r["text"], s.value, r["before"]) for r in rows])
            found = both.drop(pair, last)
        last = made
    return found.withColumnRenamed(last, as_col) if last != as_col and as_col not in docs.columns else found


def n_hit(found):
    return F.aggregate(found["spans"], F.lit(0).cast("long"), lambda total, span: total + span["behind"] - span["first"])


def contaminated(found, share: int = 20):
    """Whether at least one word in ``share`` is hit."""
    return (n_hit(found) > 0) & (n_hit(found) * share >= found["n_words"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents, all their columns, that are not contaminated."""
    name = free_name(docs, "contamination")
    found = contamination(docs, benchmark, as_col=name, **options)
    return found.where(~contaminated(col(name))).select(*[col(c) for c in docs.columns])
