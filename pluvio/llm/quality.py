"""Quality by the perplexity of a modified Kneser-Ney model of trusted text.

The model is an interpolated n-gram model over characters as they are written, in
any script, up to ``LONGEST`` characters: nothing is folded, no n-gram is left out,
and its tables grow with the trusted text. Below them stands a 4-gram model over
``64`` symbols, into which characters are folded by case and kind: it says how
likely an n-gram is that trusted text does not have, and a character's share of
its symbol tells it from the others. A character new to the model counts as its
symbol, so that a script which trusted text lacks is no evidence of junk.

Counts come from all trusted documents: tasks count their share, and counts meet
sharded by n-gram. Continuation counts, context totals, discounts and the
interpolation with the next shorter order are joins and aggregates of these
sharded tables. An n-gram's entry in the finished model is how far it moves the
log probability from that of the next shorter one, a context's is its back-off
weight. A text's log probability is thus that of its symbols plus the entries of
its n-grams and contexts, so that one join and one sum score it. The ``HOT``
entries that trusted text needs most often go to every task, which keeps them out
of the join; a document's other n-grams, but for most of those that bits of the rest
show to be in no trusted text, are counted in the document and joined to the
sharded rest. Values are sums of integers (``UNIT``), so results depend neither
on this split nor on partitions. Documents meet their sums by a 64-bit hash of the
text.

Trusted documents of one fold are left out of the counts. Their perplexities,
those of unseen clean text, give every language its threshold: the ``QUANTILE``
of the fold, plus ``SLACK`` nats a character, so that hardly any clean document
is beyond it. With few such documents a quantile says little, so it is drawn
towards the language's mean plus the quantile of all languages' distances from
their means, which weighs as much as ``ENOUGH`` documents, and is never below the
language's own. Documents without a language, or of one the fold does not have,
take the threshold of all languages together. A text of a few
characters says little about itself: what is compared is the log perplexity as
if ``PRIOR`` characters of the fold's mean stood before the text.

A document is rejected if this level exceeds the threshold. Null and
empty texts have no characters: their log perplexity is null and they are kept,
as is everything if there is no trusted text. Repeated rows are judged each.
Trusted documents in the counts are judged too; only the fold is calibrated on.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pluvio.llm.common import by_slices, col, free_name, kept_by, staged, with_values, working

ORDER, BITS = 4, 6
SYMBOLS = 1 << BITS
QUANTILE = 0.995
SLACK = 0.1
PRIOR = 40
ENOUGH = 200
#: Orders over exact characters, above the symbols'.
EXACT = (5, 6)
LONGEST = EXACT[-1]
#: Bits of a character beside another in one number.
WIDTH = 21
#: So many entries at most (56 MB with their look-up) are sent to every task; a split of the work, not of the model.
HOT = 4_000_000
#: Two to this power are the bits (8 MB) that tell a task which n-grams the rest cannot have.
FILTER = 26
#: Model entries are whole multiples of one part in so many.
UNIT = 1_000_000
#: So many trusted ids at most (some 16 MB) are sent to every task; more are joined by shuffling.
BROADCAST_IDS = 1_000_000
#: Thresholds are found on a grid of log perplexities this fine.
GRID = 10_000


@lru_cache(maxsize=1)
def _symbols() -> np.ndarray:
    """The symbol of every character of the basic plane; 0 stands before the text."""
    table = np.full(1 << 16, 63, np.uint8)
    for c in range(1 << 16):
        ch, kind = chr(c), unicodedata.category(chr(c))
        if "a" <= ch <= "z":
            table[c] = 1 + c - ord("a")
        elif "A" <= ch <= "Z":
            table[c] = 27 + c - ord("A")
        elif ch == " ":
            table[c] = 54
        elif kind[0] == "Z" or ch in "\n\t\r":
            table[c] = 55
        elif ch == ".":
            table[c] = 56
        elif ch == ",":
            table[c] = 57
        elif kind == "Lu":
            table[c] = 59
        elif kind[0] in "LM":
            table[c] = 58
        elif kind[0] == "N":
            table[c] = 53
        elif ch in "'\"-()[]:;?/":
            table[c] = 60
        elif ch == "!":
            table[c] = 61
        elif c < 128 or kind[0] in "SP":
            table[c] = 62
    return table


def _fold(points: np.ndarray) -> np.ndarray:
    return np.where(points < (1 << 16), _symbols()[np.minimum(points, 0xFFFF)], 63).astype(np.int32)


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Every character's 4-gram, and where each text's begin (with the end behind the last)."""
    padded = ("\0" * (ORDER - 1)).join(["", *[t or "" for t in texts]])
    points = np.frombuffer(padded.encode("utf-32-le", "replace"), np.uint32)
    codes = _fold(points)
    lengths = np.array([len(t or "") for t in texts], np.int64)
    starts = np.cumsum(lengths + ORDER - 1) - lengths
    inside = np.ones(len(codes), bool)
    for k in range(ORDER - 1):
        gaps = starts - 1 - k
        codes[gaps], inside[gaps] = 0, False
    gram = codes.copy()
    for k in range(1, ORDER):
        gram[k:] |= codes[:-k] << (BITS * k)
    return gram[inside], np.concatenate([[0], np.cumsum(lengths)])


def counts(texts: DataFrame) -> DataFrame:
    """(gram, n) over all rows of a one-column frame of texts, counted in the tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, numbers, held, most = [], [], 0, 1_000_000

        def merged() -> tuple[np.ndarray, np.ndarray]:
            unique, place = np.unique(np.concatenate(keys), return_inverse=True)
            return unique, np.bincount(place, np.concatenate(numbers)).astype(np.int64)

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                found, n = np.unique(grams(batch.column(0).slice(start, 256).to_pylist())[0], return_counts=True)
                keys.append(found)
                numbers.append(n)
                held += len(found)
                if held > most:
                    merged_keys, merged_numbers = merged()
                    keys, numbers, held = [merged_keys], [merged_numbers], len(merged_keys)
                    most = max(most, 2 * held)
        if keys:
            unique, n = merged()
            yield pa.RecordBatch.from_arrays([pa.array(unique, pa.int32()), pa.array(n, pa.int64())], ["gram", "n"])

    return texts.mapInArrow(run, "gram int, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


def _discounts(table: DataFrame) -> list[float]:
    """D1, D2 and D3+ from the counts of counts."""
    row = table.agg(*[F.count_if(F.col("n") == i).alias(f"n{i}") for i in range(1, 5)]).first()
    return _from_counts([row[f"n{i}"] for i in range(1, 5)])


def _from_counts(of: list[int]) -> list[float]:
    n = [0, *of]
    if not all(of):
        return [0.5, 1.0, 1.5]
    y = n[1] / (n[1] + 2 * n[2])
    return [min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.05), i - 0.05 if i > 1 else 0.95) for i in (1, 2, 3)]


def model(texts: DataFrame) -> dict[str, np.ndarray] | None:
    """The interpolated model: seen n-grams' probabilities and contexts' back-off weights by order.

    Each table has at most 2**24 rows; they are collected because that bound
    does not depend on the corpus.
    """
    highest = staged(counts(texts), "grams")
    if highest.isEmpty():
        return None
    tables = {ORDER: highest}
    for order in range(ORDER - 1, 0, -1):
        longer = tables[order + 1]
        suffix = F.col("gram").bitwiseAND(F.lit((1 << BITS * order) - 1))
        tables[order] = staged(longer.groupBy(suffix.alias("gram")).agg(F.count(F.lit(1)).alias("n")), f"grams-{order}")
    made: dict[str, np.ndarray] = {}
    lower = None
    for order in range(1, ORDER + 1):
        table = tables[order].withColumn("context", F.shiftright("gram", BITS))
        d = _discounts(tables[order])
        contexts = table.groupBy("context").agg(
            F.sum("n").alias("total"),
            ((F.count_if(F.col("n") == 1) * d[0] + F.count_if(F.col("n") == 2) * d[1] + F.count_if(F.col("n") > 2) * d[2]) / F.sum("n")).alias("weight"),
        )
        off = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        joined = table.join(contexts, "context")
        if lower is None:
            shorter = F.lit(1.0 / SYMBOLS)
        else:
            joined = joined.withColumn("suffix", F.col("gram").bitwiseAND(F.lit((1 << BITS * (order - 1)) - 1))).join(lower, "suffix")
            shorter = F.col("shorter")
        seen = staged(joined.select("gram", ((F.col("n") - off) / F.col("total") + F.col("weight") * shorter).alias("p")), f"seen-{order}")
        lower = seen.select(F.col("gram").alias("suffix"), F.col("p").alias("shorter"))
        for name, frame in (("seen", seen), ("context", contexts.select("context", "weight"))):
            rows = frame.toArrow()
            made[f"{name}{order}.key"] = rows.column(0).to_numpy()
            made[f"{name}{order}.value"] = rows.column(1).to_numpy().astype(np.float32)
    return made


def _chances(tables: dict[str, np.ndarray], upto: int) -> np.ndarray:
    """The probability of every possible n-gram of so many symbols, seen or backed off."""
    p = np.full(SYMBOLS, 1.0 / SYMBOLS, np.float32)
    for order in range(1, upto + 1):
        weight = _weights(tables, order)
        if order > 1:  # first symbol and middle of the context, middle and symbol of the shorter one
            p = (weight.reshape(SYMBOLS, -1, 1) * p.reshape(1, -1, SYMBOLS)).reshape(-1)
        else:
            p = weight[0] * p
        p[tables[f"seen{order}.key"]] = tables[f"seen{order}.value"]
    return p


def _weights(tables: dict[str, np.ndarray], order: int) -> np.ndarray:
    weight = np.ones(1 << BITS * (order - 1), np.float32)
    weight[tables[f"context{order}.key"]] = tables[f"context{order}.value"]
    return weight


def dense(tables: dict[str, np.ndarray]) -> np.ndarray:
    """The log probability of every possible 4-gram, seen or backed off."""
    p = _chances(tables, ORDER)
    return np.log(p, out=p)


class Symbols:
    """What ``dense`` has, in parts of ``UNIT`` and in less memory: 4-grams that are seen, and what others back off to.

    A context has a bit for every symbol that is seen behind it; the bits before a
    4-gram's own say where its value stands.
    """

    def __init__(self, tables: dict[str, np.ndarray]):
        key = tables[f"seen{ORDER}.key"].astype(np.int64)
        order = np.argsort(key)
        key = key[order]
        self.values = self._parts(tables[f"seen{ORDER}.value"][order])
        self.seen = np.zeros(SYMBOLS ** (ORDER - 1), np.uint64)
        np.bitwise_or.at(self.seen, key >> BITS, np.uint64(1) << (key & (SYMBOLS - 1)).astype(np.uint64))
        each = np.bitwise_count(self.seen)
        self.before = np.cumsum(each, dtype=np.int32) - each
        self.weights, self.shorter = _weights(tables, ORDER), _chances(tables, ORDER - 1)

    @staticmethod
    def _parts(p: np.ndarray) -> np.ndarray:
        return np.rint(np.log(p).astype(np.float64) * UNIT).astype(np.int32)

    def find(self, gram: np.ndarray) -> np.ndarray:
        context, symbol = gram >> BITS, (gram & (SYMBOLS - 1)).astype(np.uint64)
        bits = self.seen[context]
        there = ((bits >> symbol) & np.uint64(1)).astype(bool)
        place = self.before[context] + np.bitwise_count(bits & ((np.uint64(1) << symbol) - np.uint64(1)))
        made = np.empty(len(gram), np.int64)
        made[there] = self.values[place[there]]
        other = ~there
        made[other] = self._parts(self.weights[context[other]] * self.shorter[gram[other] & ((1 << BITS * (ORDER - 1)) - 1)])
        return made


#: What a worker has made of the model, and the model it was made from.
_DENSE: dict = {}
kept_by("quality", _DENSE.clear)


def shares(texts: DataFrame) -> dict[str, np.ndarray]:
    """Characters and the log of their share of their symbol; there are no more rows than code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(0x110000, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                text = "".join(t or "" for t in batch.column(0).slice(start, 256).to_pylist())
                n += np.bincount(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), minlength=len(n))
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(n[seen])], ["point", "n"])

    rows = texts.mapInArrow(run, "point bigint, n bigint").groupBy("point").agg(F.sum("n").alias("n")).orderBy("point").toArrow()
    point, n = rows.column(0).to_numpy(), rows.column(1).to_numpy()
    symbol = _fold(point)
    total = np.bincount(symbol, n, minlength=SYMBOLS)
    return {"point": point, "share": np.log(n / total[symbol])}


def _by_symbols(gram: np.ndarray, points: np.ndarray, tables: dict[str, np.ndarray]) -> np.ndarray:
    """In parts of ``UNIT``: the log probability of characters that end the 4-grams."""
    working("quality")
    if _DENSE.get("for") is not tables:
        _DENSE.clear()
        share = np.zeros(0x110000, np.int32)
        share[tables["point"]] = np.rint(tables["share"] * UNIT)
        _DENSE.update({"for": tables, "symbols": Symbols(tables), "share": share})
    return _DENSE["symbols"].find(gram) + _DENSE["share"][points]


def base(texts: list[str | None], tables: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """In parts of ``UNIT``: every character's log probability by symbols, and where each text's begin."""
    gram, ends = grams(texts)
    points = np.frombuffer("".join(t or "" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return _by_symbols(gram, points, tables), ends


def _windows(texts: list[str | None]) -> list[np.ndarray]:
    """The ``LONGEST`` characters that end with each character, the first of all first; one more than the code point, 0 before the text."""
    pad = LONGEST - 1
    padded = ("\0" * pad).join(["", *[t or "" for t in texts]])
    points = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    lengths = np.array([len(t or "") for t in texts], np.int64)
    starts = np.cumsum(lengths + pad) - lengths
    inside = np.ones(len(points), bool)
    for k in range(pad):
        points[starts - 1 - k], inside[starts - 1 - k] = 0, False
    inside = np.flatnonzero(inside)
    return [points[inside - k] for k in range(pad, -1, -1)]


def _numbers(window: list[np.ndarray]) -> dict[str, np.ndarray]:
    """Numbers of the n-grams that end the windows (``g5``, ...) and of their contexts (``c5``, ...)."""
    made: dict[str, np.ndarray] = {}
    for order in EXACT:
        x = np.full(len(window[0]), order << 40, np.uint64)  # far from any code point
        for k in range(LONGEST - order, LONGEST):
            if k == LONGEST - 1:
                made[f"c{order}"] = x.view(np.int64)
            x = (x ^ window[k]) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(29)
        made[f"g{order}"] = x.view(np.int64)
    return made


def exact_grams(texts: list[str | None]) -> dict[str, np.ndarray]:
    """Numbers of the n-gram that ends with each character (``g5``, ...) and of its context (``c5``, ...)."""
    return _numbers(_windows(texts))


def _pair(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return ((high << np.uint64(WIDTH)) | low).view(np.int64)


def _unpair(both: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return both.view(np.uint64) >> np.uint64(WIDTH), both.view(np.uint64) & np.uint64((1 << WIDTH) - 1)


def exact_counts(texts: DataFrame) -> DataFrame:
    """A row per four characters in the middle of n-grams: these (``a``, ``b``), all pairs of ``ends`` around them, and their counts.

    An n-gram travels as its six characters. All that the orders 5 and 6 count
    has the middle in common: the context of the longer is a first character and
    the middle, the shorter n-gram the middle and a last one, its context the
    middle. So this is the only time that n-grams meet.
    """
    columns = ["a", "b", "ends", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        working("quality counts")  # lets a former model go, which counting does not need
        parts, held = [[] for _ in range(5)], 0

        def merge() -> None:
            """A column after the other, so that little is there twice."""
            number = np.concatenate(parts[0])
            parts[0].clear()
            number, place, back = np.unique(number, return_index=True, return_inverse=True)
            parts[0].append(number)
            for x in parts[1:4]:
                x[:] = [np.concatenate(x)[place]]
            parts[4][:] = [np.bincount(back, np.concatenate(parts[4])).astype(np.int64)]

        def made() -> pa.RecordBatch:
            found = [x[0] for x in parts[1:]]
            order = np.lexsort(found[2::-1])
            return pa.RecordBatch.from_arrays([pa.array(x[order], pa.int64()) for x in found], columns)

        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                w = _windows(batch.column(0).slice(start, 64).to_pylist())
                number, place, n = np.unique(_numbers(w)[f"g{LONGEST}"], return_index=True, return_counts=True)
                w = [x[place] for x in w]
                for x, more in zip(parts, [number, _pair(w[1], w[2]), _pair(w[3], w[4]), _pair(w[0], w[5]), n.astype(np.int64)]):
                    x.append(more)
                held += len(n)
                if held > 1_200_000:
                    merge()
                    held = len(parts[0][0])
                    if held > 600_000:
                        yield made()
                        parts, held = [[] for _ in range(5)], 0
        if held:
            merge()
            yield made()

    def middles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of rows in order: whole middles, once enough rows are there."""
        parts: list[list[np.ndarray]] = []
        held = 0

        def whole(last: bool) -> pa.RecordBatch | None:
            nonlocal parts, held
            a, b, ends, n = (np.concatenate(x) for x in zip(*parts))
            change = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            if last:
                upto = len(a)
            else:
                places = np.flatnonzero(change)
                if not len(places):
                    parts = [[a, b, ends, n]]
                    return None
                upto = int(places[-1]) + 1
            parts = [[a[upto:], b[upto:], ends[upto:], n[upto:]]]
            held = len(a) - upto
            a, b, ends, n, change = a[:upto], b[:upto], ends[:upto], n[:upto], change[: upto - 1]
            new = np.concatenate([[True], change | (ends[1:] != ends[:-1])])
            n = np.add.reduceat(n, np.flatnonzero(new))
            top = np.concatenate([[True], change])[new]
            a, b, ends = a[new], b[new], ends[new]
            starts = np.flatnonzero(top)
            offsets = pa.array(np.append(starts, len(a)), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int64())) for x in (ends, n)]
            return pa.RecordBatch.from_arrays([pa.array(a[starts], pa.int64()), pa.array(b[starts], pa.int64()), *lists], columns)

        for batch in batches:
            parts.append([c.to_numpy() for c in batch.columns])
            held += batch.num_rows
            if held > 500_000:
                made = whole(False)
                if made is not None:
                    yield from by_slices(lambda x: x, 10_000)([made])
        if held:
            yield from by_slices(lambda x: x, 10_000)([whole(True)])

    found = texts.mapInArrow(run, ", ".join(f"{c} bigint" for c in columns))
    dealt = found.repartition("a", "b").sortWithinPartitions("a", "b", "ends")
    return dealt.mapInArrow(middles, "a bigint, b bigint, ends array<bigint>, n array<bigint>")


def _middles(batches: Iterator[pa.RecordBatch]) -> Iterator[Middles]:
    """Of rows of ``exact_counts``, a thousand at a time: a worker holds some forty numbers for each of their n-grams."""
    for batch in batches:
        for start in range(0, batch.num_rows, 1000):
            yield Middles(batch.slice(start, 1000))


class Middles:
    """The n-grams of both orders, and their contexts, of a batch of rows of ``exact_counts``."""

    def __init__(self, batch: pa.RecordBatch):
        ends, n = batch.column(2), batch.column(3)
        size = np.diff(ends.offsets.to_numpy())
        self.a, self.b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        self.n = n.flatten().to_numpy()
        #: Of every 6-gram: its middle, characters around it, context and 5-gram, by place.
        self.middle = np.repeat(np.arange(len(size)), size)
        self.first, self.last = _unpair(np.ascontiguousarray(ends.flatten().to_numpy()))
        of = self.middle.astype(np.int64) << WIDTH
        self.long_contexts, self.long_context = np.unique(of | self.first.astype(np.int64), return_inverse=True)
        self.shorter, self.short = np.unique(of | self.last.astype(np.int64), return_inverse=True)
        #: Of every 5-gram: in how many 6-grams it is; how often each is needed.
        self.follows = np.bincount(self.short, minlength=len(self.shorter))
        self.often = {
            "g6": self.n, "c6": self._sum(self.long_context, self.n, len(self.long_contexts)),
            "g5": self._sum(self.short, self.n, len(self.shorter)), "c5": self._sum(self.middle, self.n, len(size)),
        }

    @staticmethod
    def _sum(place: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
        return np.rint(np.bincount(place, n, size)).astype(np.int64)

    def entries(self, discounts: dict[int, list[float]], tables: dict[str, np.ndarray]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
        """Numbers and entries by kind; all of a text's are added up."""
        off = {o: np.array([0.0, *d]) for o, d in discounts.items()}
        whole = lambda x: np.rint(x * UNIT).astype(np.int64)
        of, last = self.shorter >> WIDTH, (self.shorter & ((1 << WIDTH) - 1)).view(np.uint64)
        (p1, p2), (p3, p4) = (tuple(x.astype(np.int64) for x in _unpair(side[of])) for side in (self.a, self.b))
        gram = np.zeros(len(of), np.int64)
        for p in (p2, p3, p4, last.astype(np.int64)):
            gram = (gram << BITS) | np.where(p > 0, _fold(np.maximum(p - 1, 0)), 0)
        symbols = _by_symbols(gram, last.astype(np.int64) - 1, tables) / UNIT
        lost = off[5][np.minimum(self.follows, 3)]
        total = np.bincount(of, self.follows, len(self.a))
        weight = np.bincount(of, lost, len(self.a)) / total
        p = (self.follows - lost) / total[of] + weight[of] * np.exp(symbols)
        lost = off[6][np.minimum(self.n, 3)]
        long_total = np.bincount(self.long_context, self.n)
        long_weight = np.bincount(self.long_context, lost) / long_total
        back = long_weight[self.long_context] * p[self.short]
        chance = (self.n - lost) / long_total[self.long_context] + back
        zero = np.zeros(1, np.uint64)
        (a1, a2), (b1, b2) = (_unpair(side) for side in (self.a, self.b))
        window = lambda of, first, last: [first, *[x[of] for x in (a1, a2, b1, b2)], last]
        every = np.arange(len(self.a))
        long_of = self.long_contexts >> WIDTH
        return {
            "g6": (_numbers(window(self.middle, self.first, self.last))["g6"], whole(np.log(chance) - np.log(back))),
            "c6": (_numbers(window(long_of, (self.long_contexts & ((1 << WIDTH) - 1)).view(np.uint64), zero.repeat(len(long_of))))["c6"], whole(np.log(long_weight))),
            "g5": (_numbers(window(of, zero.repeat(len(of)), last))["g5"], whole(np.log(p) - np.log(weight[of]) - symbols)),
            "c5": (_numbers(window(every, zero.repeat(len(every)), zero.repeat(len(every))))["c5"], whole(np.log(weight))),
        }


@dataclass
class Exact:
    """The finished model: symbols' tables, the most needed entries in order, and the sharded rest if there is any, with its bits."""

    tables: dict[str, np.ndarray]
    keys: np.ndarray
    entries: np.ndarray
    rest: DataFrame | None
    bits: np.ndarray | None = None
    scorer: Scorer | None = None

    def sent(self, spark: SparkSession) -> Scorer:
        """What tasks score with; sent once, however many frames are scored."""
        if self.scorer is None:
            self.scorer = Scorer(self, spark)
        return self.scorer


def exact_model(texts: DataFrame, tables: dict[str, np.ndarray], hot: int | None = None) -> Exact:
    """The interpolated model of the ``EXACT`` orders above the symbols'."""
    hot = HOT if hot is None else hot
    tables = tables | shares(texts)
    counted = staged(exact_counts(texts), "exact")

    def tallies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How many n-grams of an order have a count, and how many entries are needed so often (order 0)."""
        for m in _middles(batches):
            for order, values in ((0, np.concatenate([*m.often.values()])), (5, m.follows), (6, m.n)):
                value, n = np.unique(values if not order else values[values <= 4], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), order), pa.int32()), pa.array(value, pa.int64()), pa.array(n, pa.int64())], ["order", "value", "n"])

    found = counted.mapInArrow(tallies, "order int, value bigint, n bigint").groupBy("order", "value").agg(F.sum("n").alias("n"))
    found = staged(found, "tallies")
    few = {(r["order"], r["value"]): r["n"] for r in found.where("order > 0").collect()}
    discounts = {order: _from_counts([few.get((order, i), 0) for i in range(1, 5)]) for order in EXACT}
    # The least use an entry must have for all such entries to be within ``hot``.
    least, held = None, 0
    for r in found.where("order = 0").orderBy(F.desc("value")).toLocalIterator():
        held += r["n"]
        if held > hot:
            break
        least = r["value"]
    shipped = texts.sparkSession.sparkContext.broadcast(tables)

    def chosen(wanted: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for m in _middles(batches):
                made = m.entries(discounts, shipped.value)
                needed = {kind: often >= least if least is not None else np.zeros(len(often), bool) for kind, often in m.often.items()}
                if wanted:  # an n-gram needed so often stands for its shorter ones too, which are no less needed
                    more = made["c6"][1][m.long_context] + made["g5"][1][m.short] + made["c5"][1][m.middle]
                    made["g6"] = (made["g6"][0], made["g6"][1] + more)
                key, entry = (np.concatenate([made[kind][i][needed[kind] == wanted] for kind in made]) for i in (0, 1))
                for start in range(0, len(key), 100_000):
                    some = slice(start, start + 100_000)
                    yield pa.RecordBatch.from_arrays([pa.array(key[some], pa.int64()), pa.array(entry[some].astype(np.int32), pa.int32())], ["key", "entry"])

        return counted.mapInArrow(run, "key bigint, entry int")

    rows = chosen(True).toArrow()
    keys, entries = (rows.column(i).to_numpy() for i in (0, 1))
    del rows
    order = np.argsort(keys)
    keys, entries = keys[order], entries[order]
    made = Exact(tables, keys, entries, None)
    if held > hot:
        made.rest = chosen(False)
        made.bits = bits_of(made.rest.select("key"))
    return made


def _bit(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The word and the bit in it that stand for a number."""
    place = keys.view(np.uint64) >> np.uint64(64 - FILTER)
    return (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63))


def bits_of(keys: DataFrame) -> np.ndarray:
    """Bits of all numbers of a one-column frame: a number whose bit is not set is not in the frame."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(1 << FILTER - 6, np.uint64)
        for batch in batches:
            np.bitwise_or.at(words, *_bit(batch.column(0).to_numpy()))
        some = np.flatnonzero(words)
        for start in range(0, len(some), 100_000):
            part = some[start : start + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(words[part].view(np.int64), pa.int64())], ["word", "bits"])

    rows = keys.mapInArrow(run, "word int, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(1 << FILTER - 6, np.uint64)
    words[rows.column(0).to_numpy()] = rows.column(1).to_numpy().view(np.uint64)
    return words


class Hot:
    """A look-up of numbers: they and their entries in order, and where those of equal leading bits begin."""

    def __init__(self, keys: np.ndarray, entries: np.ndarray, first: np.ndarray | None = None):
        if first is None:
            if (keys[1:] < keys[:-1]).any():
                order = np.argsort(keys)
                keys, entries = keys[order], entries[order]
            bits = max(4, (len(keys) // 2).bit_length())
            first = np.zeros((1 << bits) + 1, np.int32)
            np.cumsum(np.bincount(self._lead(keys, bits), minlength=1 << bits), out=first[1:])
        self.keys, self.entries, self.first = keys, entries, first

    @staticmethod
    def _lead(keys: np.ndarray, bits: int) -> np.ndarray:
        return (keys >> (64 - bits)) + (1 << bits - 1)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The entries, zero where there is none, and whether there is one."""
        found, hit = np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        lead = self._lead(keys, (len(self.first) - 1).bit_length() - 1)
        at, end = self.first[lead], self.first[lead + 1]
        left = np.flatnonzero(at < end)
        at, end, some = at[left], end[left], keys[left]
        for _ in range(8):
            here = self.keys[at]
            there = here == some
            found[left[there]], hit[left[there]] = self.entries[at[there]], True
            at += 1
            go = np.flatnonzero((here < some) & (at < end))
            left, at, end, some = left[go], at[go], end[go], some[go]
            if not len(left):
                return found, hit
        at = np.minimum(np.searchsorted(self.keys, some), len(self.keys) - 1)
        there = self.keys[at] == some
        found[left[there]], hit[left[there]] = self.entries[at[there]], True
        return found, hit


class Scorer:
    """Texts' sums by what every task has of the model."""

    def __init__(self, model: Exact, spark: SparkSession):
        hot = Hot(model.keys, model.entries)  # made once; a worker has no copy beside what it is sent
        self.shipped = spark.sparkContext.broadcast((model.tables, hot.keys, hot.entries, hot.first, model.bits))

    def sums(self, texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every text's sum without the rest, and the places and n-grams that the rest may have."""
        tables, keys, entries, first, bits = self.shipped.value
        value, ends = base(texts, tables)
        hot = Hot(keys, entries, first)
        place = np.repeat(np.arange(len(texts), dtype=np.int64), np.diff(ends))
        window = _windows(texts)
        numbers = _numbers(window)
        found, hit = hot.find(numbers[f"g{LONGEST}"])
        value += found
        other = np.flatnonzero(~hit)
        left = [(place[other], numbers[f"g{LONGEST}"][other])]
        for kind in ("c6", "g5", "c5"):
            key = numbers[kind][other]
            found, hit = hot.find(key)
            value[other] += found
            left.append((place[other[~hit]], key[~hit]))
        total = np.concatenate([[0], np.cumsum(value)])
        places, keys = (np.concatenate(x) for x in zip(*left))
        if bits is not None:
            word, bit = _bit(keys)
            maybe = (bits[word] & bit) != 0
            places, keys = places[maybe], keys[maybe]
        return total[ends[1:]] - total[ends[:-1]], places, keys


def sums_by_text(docs: DataFrame, model: Exact, text_col: str) -> DataFrame | None:
    """Every text's hash and sum over the whole model; none if every task has the whole model."""
    if model.rest is None:
        return None
    scorer = model.sent(docs.sparkSession)

    def exploded(batch: pa.RecordBatch) -> pa.RecordBatch:
        """A row per text with its sum, and a row per text and other n-gram with its count."""
        number = batch.column(0).to_numpy()
        made, place, key = scorer.sums(batch.column(1).to_pylist())
        order = np.lexsort((key, place))
        place, key = place[order], key[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (place[1:] != place[:-1])
        starts = np.flatnonzero(new)
        n = np.diff(starts, append=len(key))
        columns = [
            pa.array(np.concatenate([number, number[place[starts]]])), pa.array(np.concatenate([number, key[starts]])),
            pa.array(np.concatenate([np.zeros(len(number), np.int64), n])), pa.array([*made.tolist(), *[None] * len(starts)], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["of", "key", "n", "sum"])

    of = F.xxhash64(col(text_col))
    texts = docs.where(F.char_length(col(text_col)) > 0).select(of.alias("of"), col(text_col).alias("text"))
    rows = texts.mapInArrow(by_slices(exploded, 64), "of bigint, key bigint, n bigint, sum bigint")
    hits = rows.join(model.rest, "key", "left").where("sum is not null or entry is not null")
    # Copies of a text each bring the same rows.
    wide = lambda x: F.sum(x.cast("decimal(28,0)"))
    total = (wide(F.col("sum")) + F.coalesce(wide(F.when(F.col("sum").isNull(), F.col("n") * F.col("entry"))), F.lit(0))) / F.count("sum")
    return staged(hits.groupBy("of").agg(total.cast("double").alias("total")), "sums")


def log_perplexity(docs: DataFrame, model: Exact, text_col: str, as_col: str, sums: DataFrame | None = None) -> DataFrame:
    """The documents with ``as_col``, nats a character over the whole text; null without characters.

    ``sums`` are those of ``sums_by_text`` for these documents and perhaps others.
    """
    if model.rest is None:
        scorer = model.sent(docs.sparkSession)
        alone = lambda texts: [-int(s) / UNIT / len(t) if t else None for t, s in zip(texts, scorer.sums(texts)[0])]
        return with_values(docs, text_col, as_col, "double", pa.float64(), alone, rows=64)
    if sums is None:
        sums = sums_by_text(docs, model, text_col)
    key, total = free_name(docs, "of_"), free_name(docs, "total_")
    sums = sums.select(F.col("of").alias(key), F.col("total").alias(total))
    chars = F.nullif(F.char_length(col(text_col)), F.lit(0))
    return docs.withColumn(key, F.xxhash64(col(text_col))).join(sums, key, "left").withColumn(as_col, -col(total) / UNIT / chars).drop(key, total)


def level(nats: Column, chars: Column, mean: float) -> Column:
    """The log perplexity with ``PRIOR`` characters of the mean before the text."""
    return (nats * chars + PRIOR * mean) / (chars + PRIOR)


def thresholds(scored: DataFrame, quantile: float, slack: float) -> tuple[float, dict[str | None, float]]:
    """The mean, and the highest accepted level by language (None: all), from (lang, nats, chars) rows.

    Everything is counted on the grid, so the result does not depend on the
    order of rows, and a language has a bounded number of counts.
    """
    known = scored.where("nats is not null")
    total = known.agg(F.sum(F.ceil(F.col("nats") * GRID)).alias("sum"), F.count(F.lit(1)).alias("n")).first()
    mean = total["sum"] / total["n"] / GRID if total["n"] else 0.0
    bins = known.select("lang", F.ceil(level(F.col("nats"), F.col("chars"), mean) * GRID).alias("bin"))
    by_lang = bins.where("lang is not null").groupBy("lang", "bin").agg(F.count(F.lit(1)).alias("n"))
    each = W.partitionBy("lang")
    by_lang = by_lang.withColumn("middle", F.round(F.sum(F.col("bin") * F.col("n")).over(each) / F.sum("n").over(each)).cast("bigint"))
    nothing = F.lit(None).cast("string").alias("lang")
    every = bins.groupBy(nothing, "bin").agg(F.count(F.lit(1)).alias("n")).select("lang", F.lit("all").alias("kind"), "bin", "n", F.lit(0).cast("bigint").alias("middle"))
    spread = by_lang.groupBy((F.col("bin") - F.col("middle")).alias("bin")).agg(F.sum("n").alias("n")).select(nothing, F.lit("spread").alias("kind"), "bin", "n", F.lit(0).cast("bigint").alias("middle"))
    both = by_lang.select("lang", F.lit("own").alias("kind"), "bin", "n", "middle").unionByName(every).unionByName(spread)
    one = W.partitionBy("kind", "lang")
    ranked = both.withColumn("upto", F.sum("n").over(one.orderBy("bin"))).withColumn("total", F.sum("n").over(one))
    reached = ranked.where(F.col("upto") >= F.col("total") * quantile).groupBy("kind", "lang").agg(F.min("bin").alias("bin"), F.first("total").alias("total"), F.first("middle").alias("middle"))
    rows = reached.collect()
    around = next((r["bin"] for r in rows if r["kind"] == "spread"), 0)

    def limit(r) -> float:
        if r["kind"] == "all":
            return r["bin"]
        return max(r["bin"], (r["total"] * r["bin"] + ENOUGH * (r["middle"] + around)) / (r["total"] + ENOUGH))

    return mean, {r["lang"]: limit(r) / GRID + slack for r in rows if r["kind"] != "spread"}


def judge(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", as_col: str = "quality", quantile: float = QUANTILE, slack: float = SLACK) -> DataFrame:
    """The documents with ``as_col``: nats, perplexity, level, threshold, and whether the document is kept.

    ``trusted`` has a column ``id`` with the ids of trusted documents.
    """
    ids = trusted.select(F.col("id").alias("id_")).where("id_ is not null").distinct()
    fold = F.pmod(F.crc32(F.col("id_").cast("string").cast("binary")), F.lit(4)) == 0
    texts = docs.select(col(id_col).alias("id_"), col(lang_col).alias("lang"), col(text_col).alias("text"))
    if ids.count() <= BROADCAST_IDS:
        good = texts.join(F.broadcast(ids), "id_", "left_semi")
    else:  # the texts are shuffled once
        good = staged(texts.join(ids, "id_", "left_semi"), "trusted")
    tables = model(good.where(~fold).select("text"))
    if tables is None:
        unknown = [F.lit(None).cast("double").alias(name) for name in ("nats", "perplexity", "level", "threshold")]
        return docs.withColumn(as_col, F.struct(*unknown, F.lit(True).alias("keep")))
    exact = exact_model(good.where(~fold).select("text"), tables)
    sums = sums_by_text(docs, exact, text_col)
    held = log_perplexity(good.where(fold).select("lang", "text"), exact, "text", "nats", sums).select("lang", "nats", F.char_length("text").alias("chars"))
    mean, limits = thresholds(staged(held, "held-out"), quantile, slack)
    named = [F.lit(x) for lang, most in limits.items() if lang is not None for x in (lang, most)]
    everything = F.lit(limits.get(None)).cast("double")
    limit = F.coalesce(F.create_map(*named)[col(lang_col)], everything) if named else everything
    nats = free_name(docs, "nats")
    scored = log_perplexity(docs, exact, text_col, nats, sums)
    value = col(nats)
    found = level(value, F.char_length(col(text_col)), mean)
    made = F.struct(value.alias("nats"), F.exp(value).alias("perplexity"), found.alias("level"), limit.alias("threshold"), F.coalesce(found <= limit, F.lit(True)).alias("keep"))
    return scored.withColumn(as_col, made).drop(nats)


def accepted(docs: DataFrame, trusted: DataFrame, **options) -> DataFrame:
    """The documents that are kept, all their columns."""
    name = free_name(docs, "quality")
    return judge(docs, trusted, as_col=name, **options).where(col(name)["keep"]).select(*[col(c) for c in docs.columns])


def trusted_ids(labels: DataFrame, trust: Column, id_col: str = "doc_id") -> DataFrame:
    return labels.where(trust).select(col(id_col).alias("id"))
