"""Documents packed into sequences of at most ``LENGTH`` tokens.

Order-preserving dynamic programming. Each task packs the stream of its documents,
in the table's order, every document's ids followed by an end id. A cut may stand
behind a document (free), behind a sentence (``SENTENCE``), or, at the end of a full
window only, inside a sentence (``INSIDE``). The least total of padding and
penalties up to a cut is found from the cuts at most one window before it: padding
to a full window is ``LENGTH - (p - q)``, so the best earlier cut is the head of a
monotone queue over cost plus position; windows that are full or a power of two
long, down to a sixteenth, are not padded and are tried beside it. All but the last windows of a
chunk are final; the rest goes on with the next documents. At the end of a
stream what is left is cut into powers of two, so nothing is padded there either.

No shuffle and no state beyond one chunk: a stream is a task's input split, and a
hot key plays no part. A lost task packs its split again with the same result.
``sequence_id`` is unique over all tasks: the partition's number in the upper bits.

Null and empty texts are the end id alone. Repeated rows are packed each by itself.
A text of any length is encoded whole; parts over ``PIECE`` characters are cut
where a letter, a space and a letter meet, which no token crosses. An empty table
gives no rows. Other columns, clashing ones too, are not looked at unless named in
``keep``.
"""

from __future__ import annotations

import base64
from array import array
from collections import deque
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import col

#: Tokens of a full window, and what a cut behind a sentence or inside one costs, in tokens of padding.
LENGTH, SENTENCE, INSIDE = 1024, 1, 6
#: Every sequence counts as so many tokens of padding, so that full ones are preferred.
SEQUENCE = 12
#: Tokens that are packed together, and those at the end of a chunk that stay open.
CHUNK, OPEN = 2**17, 2**13
#: Tokens in which one sentence end at most is a place to cut.
GRAIN = 16
#: Characters of a text that are encoded at once.
PIECE = 2**19
END = 0
WORDS = regex.compile(r"(?<=\p{L}) (?=\p{L})")
SENTENCE_END = regex.compile(r"[.!?…。！？]['\"»”’)\]]*$")

PIECES = "start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"


class Codec:
    """Token ids of texts by a vocabulary of byte ranks, and which ids may end a sentence.

    ``special`` are texts that are one id wherever they stand, as added tokens of
    a tokenizer file are.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, special: dict[str, int]) -> None:
        self.encoding = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        self.special = frozenset(special)
        size = 1 + max([*ranks.values(), *special.values(), END])
        self.ends, self.opens, self.breaks = (np.zeros(size, bool) for _ in range(3))
        for token, rank in ranks.items():
            text = token.decode("utf-8", "ignore")
            self.ends[rank] = SENTENCE_END.search(text) is not None
            self.opens[rank] = text[:1].isspace()
            self.breaks[rank] = text.endswith("\n")

    def ids(self, text: str) -> np.ndarray:
        """The ids of a whole text and the end id behind them."""
        found, start = [], 0
        while len(text) - start > PIECE:
            cut = WORDS.search(text, start + PIECE)
            if cut is None:
                break
            found += self._encoded(text[start : cut.start()])
            start = cut.start()
        found += self._encoded(text[start:])
        found.append(END)
        return np.frombuffer(array("I", found), np.uint32)

    def _encoded(self, text: str) -> list[int]:
        if any(word in text for word in self.special):
            return self.encoding.encode(text, allowed_special=self.special, disallowed_special=())
        return self.encoding.encode_ordinary(text)

    def sentences(self, ids: np.ndarray) -> np.ndarray:
        """Positions behind a sentence, the end of the document left out; the first in every ``GRAIN`` tokens."""
        here, behind = ids[:-2], ids[1:-1]
        found = 1 + np.flatnonzero((self.ends[here] & self.opens[behind]) | self.breaks[here])
        stretch = found // GRAIN
        return np.append(found[:1], found[1:][stretch[1:] != stretch[:-1]])


def padding(length: int, full: int = LENGTH) -> int:
    return 0 if length & (length - 1) == 0 else full - length


def cuts(places: Sequence[int], penalties: Sequence[int], full: int = LENGTH) -> list[int]:
    """The cheapest cuts from 0 to the last place, both included.

    ``places`` are ascending candidate cuts after 0, ``penalties`` what each
    costs. Where a window ends inside a sentence, its end is a candidate too.
    """
    end = places[-1]
    cost, before = {0: 0}, {}
    values, starts, head = [0], [0], 0  # the queue from ``head`` on: cost + place and place, both ascending
    pending, due = [full], 0  # ends of full windows that start at a candidate, from ``due`` on
    steps = [1 << k for k in range(full.bit_length()) if full >> 4 <= 1 << k <= full]
    get = cost.get
    for place, penalty in zip(places, penalties, strict=True):
        while due < len(pending) and pending[due] < place:
            # A cut inside a sentence, only at the end of a full window. Its own full
            # window may end inside a sentence again only if no candidate is in reach.
            inner = pending[due]
            due += 1
            if inner in cost:
                continue
            value = cost[inner - full] + INSIDE + SEQUENCE
            cost[inner], before[inner] = value, inner - full
            value += inner
            while len(values) > head and values[-1] >= value:
                del values[-1], starts[-1]
            values.append(value)
            starts.append(inner)
            if place > inner + full:
                pending.append(inner + full)
        first = place - full
        while starts[head] < first:
            head += 1
        at = starts[head]
        length = place - at
        best = cost[at] + (full - length if length & (length - 1) else 0)
        for step in steps:
            value = get(place - step)
            if value is not None and value <= best:
                best, at = value, place - step
        best += penalty + SEQUENCE
        cost[place], before[place] = best, at
        value = best + place
        while len(values) > head and values[-1] >= value:
            del values[-1], starts[-1]
        values.append(value)
        starts.append(place)
        pending.append(place + full)
    found = [end]
    while found[-1]:
        found.append(before[found[-1]])
    return found[::-1]


def powers(length: int, full: int = LENGTH) -> Iterator[int]:
    """Lengths that need no padding and add up to ``length``."""
    while length:
        step = min(full, 1 << (length.bit_length() - 1))
        yield step
        length -= step


class Stream:
    """Packs documents one after the other; hands out pieces as (row, start, length, sequence, offset, ids)."""

    def __init__(self, codec: Codec, full: int = LENGTH, chunk: int = CHUNK, left_open: int = OPEN) -> None:
        self.codec, self.full, self.chunk, self.left_open = codec, full, chunk, left_open
        self.rows: deque = deque()  # (row, ids, first position) of documents not yet packed whole
        self.places: list[int] = []
        self.penalties: list[int] = []
        self.base = self.end = self.sequence = 0

    def add(self, row, text: str) -> list[tuple]:
        ids = self.codec.ids(text)
        at = self.codec.sentences(ids) + self.end
        self.places += [*at.tolist(), self.end + len(ids)]
        self.penalties += [SENTENCE] * len(at) + [0]
        self.rows.append((row, ids, self.end))
        self.end += len(ids)
        return self._pack(False) if self.end - self.base >= self.chunk else []

    def close(self) -> list[tuple]:
        return self._pack(True) if self.end > self.base else []

    def _pack(self, last: bool) -> list[tuple]:
        found = [c + self.base for c in cuts([p - self.base for p in self.places], self.penalties, self.full)]
        if last:
            # The windows that are padded at the very end give way to powers of two.
            start = found[-2]
            if padding(found[-1] - start, self.full):
                found[-1:] = (start + np.cumsum(list(powers(found[-1] - start, self.full)))).tolist()
        else:
            keep = max(i for i, c in enumerate(found) if c <= max(self.end - self.left_open, found[1]))
            found = found[: keep + 1]
        pieces = []
        for start, stop in zip(found, found[1:], strict=False):
            pieces += self._pieces(start, stop)
            self.sequence += 1
        self.base = found[-1]
        kept = [(p, x) for p, x in zip(self.places, self.penalties, strict=True) if p > self.base]
        self.places, self.penalties = [p for p, _ in kept], [x for _, x in kept]
        return pieces

    def _pieces(self, start: int, stop: int) -> Iterator[tuple]:
        at = start
        while at < stop:
            row, ids, first = self.rows[0]
            upto = min(stop, first + len(ids))
            yield row, at - first, upto - at, len(ids), self.sequence, at - start, ids[at - first : upto - first].tobytes()
            if upto == first + len(ids):
                self.rows.popleft()
            at = upto


def read_ranks(path: str) -> dict[bytes, int]:
    """A file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=1)
def codec_of(path: str, pattern: str, special: tuple[tuple[str, int], ...]) -> Codec:
    """A worker's codec, made once; it holds a vocabulary and nothing that grows."""
    return Codec(read_ranks(path), pattern, dict(special))


def pack(docs: DataFrame, ranks: str, pattern: str, special: dict[str, int], text: str = "text", keep: Sequence[str] = ("doc_id",), length: int = LENGTH) -> DataFrame:
    """One row per piece: the columns ``keep`` of its document, then ``PIECES``.

    ``ids`` are the piece's token ids as little-endian unsigned 32-bit numbers,
    ``start`` the document's ids before it, ``doc_tokens`` all its ids, ``offset``
    the place in its sequence. ``ranks`` is a vocabulary file, shipped to the tasks.
    """
    spark = docs.sparkSession
    spark.sparkContext.addFile(ranks)
    name = ranks.rsplit("/", 1)[-1]
    kept = [docs.schema[c] for c in keep]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    made = ["start", "length", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = Stream(codec_of(SparkFiles.get(name), pattern, tuple(special.items())), length)
        first = TaskContext.get().partitionId() << 33

        def batch_of(pieces: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
            columns = [pa.array([p[0][i] for p in pieces], f.type) for i, f in enumerate(schema)]
            numbers = [[p[i] for p in pieces] for i in (1, 2, 3)] + [[first + p[4] for p in pieces], [p[5] for p in pieces]]
            columns += [pa.array(n, pa.int64()) for n in numbers] + [pa.array([p[6] for p in pieces], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, [*schema.names, *made, "ids"])

        schema = None
        for batch in batches:
            texts, others = batch.column(0), pa.RecordBatch.from_arrays(batch.columns[1:], batch.schema.names[1:])
            schema = others.schema
            for i in range(batch.num_rows):
                row = tuple(c[i].as_py() for c in others.columns)
                pieces = stream.add(row, texts[i].as_py() or "")
                if pieces:
                    yield batch_of(pieces, schema)
        pieces = stream.close()
        if pieces:
            yield batch_of(pieces, schema)

    source = docs.select(col(text).alias("_text"), *[col(c) for c in keep])
    return source.mapInArrow(run, f"{kinds + ', ' if kinds else ''}{PIECES}")


def padded(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row: sequences, tokens and padding of packed pieces."""
    sizes = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    own = F.when(F.bit_count(F.col("n")) == 1, 0).otherwise(length - F.col("n"))
    return sizes.agg(F.count("*").alias("sequences"), F.sum("n").alias("tokens"), F.sum(own).alias("padding"))
