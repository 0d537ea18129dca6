"""Byte-level BPE encoding and decoding as a monoid tree reduction.

A text is cut into halves until a half is short, every leaf is split by the
vocabulary's pattern, and neighbours are joined again: only a window around
their boundary is split anew, and it grows until the pieces outside it cannot
change. A long piece is encoded the same way on its bytes: halves are encoded
and joined by merging a window of tokens around the boundary, which grows until
its outermost tokens come out as they were.

Why the outside is settled. *Pieces*: a match depends only on where it starts
and on the characters the pattern looks at, which end at most ``LOOK_AHEAD``
behind the match (or three behind its start, for a contraction). A left piece
that saw no end of its half is final; on the right, once a match of the window
ends where the right half had a piece end, all later pieces are those of the
right half. *Tokens*: a token sequence is the encoding of its bytes if every two
neighbours are the encoding of their joint bytes. Pairs outside the window were
neighbours before, pairs inside come from encoding the window, and the two pairs
at its rims are old ones because the outermost tokens are unchanged. This needs
a vocabulary in which every token encodes to itself; ``load_ranks`` checks that.

Null and empty texts have no tokens. Texts of any length, repeated rows and
empty tables need no special care: every row is encoded on its own.
"""

from __future__ import annotations

import base64
from array import array
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import col, kept_by, with_values, working

LOOK_AHEAD = 2
LEAF_CHARS = 8192
LEAF_BYTES = 16
LEAF_IDS = 4096
#: Pieces a worker remembers before it starts afresh.
CACHE = 400_000


def load_ranks(path: str) -> bytes:
    """The rank file's bytes (under a megabyte for 50,000 tokens), to be shipped with the task."""
    with open(path, "rb") as file:
        return file.read()


class Codec:
    """Encodes and decodes by one rank file and one pattern."""

    def __init__(self, ranks: bytes, pattern: str):
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        unstable = [token for token in self.ranks if self.merge(token) != [token]]
        if unstable:
            raise ValueError(f"{len(unstable)} tokens do not encode to themselves; joining needs that they do")
        self.cache: dict[str, bytes] = {}

    # Tokens of one piece ---------------------------------------------------

    def merge(self, piece: bytes) -> list[bytes]:
        """The leaf: apply the lowest-ranked merge until none is left."""
        rank = self.ranks.get
        parts = [piece[i : i + 1] for i in range(len(piece))]
        if len(parts) < 2:
            return parts
        none = len(self.ranks)
        pairs = [rank(parts[i] + parts[i + 1], none) for i in range(len(parts) - 1)]
        while pairs:
            best = min(pairs)
            if best == none:
                break
            i = pairs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = rank(parts[i - 1] + parts[i], none)
            if i < len(pairs):
                pairs[i] = rank(parts[i] + parts[i + 1], none)
        return parts

    def join_tokens(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        width = 1
        while True:
            a, b = left[-width:], right[:width]
            window = self.merge(b"".join(a + b))
            left_done = width >= len(left) or window[0] == a[0]
            right_done = width >= len(right) or window[-1] == b[-1]
            if left_done and right_done:
                return left[:-width] + window + right[width:]
            width *= 2

    def piece_tokens(self, piece: bytes) -> list[bytes]:
        if len(piece) <= LEAF_BYTES:
            return self.merge(piece)
        middle = len(piece) // 2
        return self.join_tokens(self.piece_tokens(piece[:middle]), self.piece_tokens(piece[middle:]))

    # Pieces of a text ------------------------------------------------------

    def join_pieces(self, left: list[str], right: list[str]) -> list[str]:
        # Left pieces that cannot have looked beyond the half are final.
        tail, first = 0, len(left)
        while first and tail < len(left[first - 1]) + 3:
            first -= 1
            tail += len(left[first])
        # Anything before that saw only characters of the left half.
        head = "".join(left[first:])
        count, width = 0, 0
        while True:
            grow = max(8, width)
            while count < len(right) and grow > 0:
                grow -= len(right[count])
                width += len(right[count])
                count += 1
            window = head + "".join(right[:count])
            whole = count == len(right)
            ends, place = {}, len(head)
            for i, piece in enumerate(right[:count], 1):
                place += len(piece)
                ends[place] = i
            made = []
            for match in self.pattern.finditer(window):
                start, end = match.span()
                if not whole and max(end + LOOK_AHEAD, start + 3) > len(window):
                    break
                made.append(match.group())
                if end in ends:
                    return left[:first] + made + right[ends[end] :]
            if whole:
                return left[:first] + made

    def pieces(self, text: str) -> list[str]:
        if len(text) <= LEAF_CHARS:
            return self.pattern.findall(text)
        middle = len(text) // 2
        return self.join_pieces(self.pieces(text[:middle]), self.pieces(text[middle:]))

    # Whole texts -----------------------------------------------------------

    def packed(self, piece: str) -> bytes:
        tokens = self.piece_tokens(piece.encode("utf-8"))
        ids = array("I", map(self.ranks.__getitem__, tokens)).tobytes()
        if len(self.cache) >= CACHE:
            self.cache.clear()
        if len(piece) <= 4 * LEAF_BYTES:
            self.cache[piece] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        get, packed = self.cache.get, self.packed
        return b"".join([get(piece) or packed(piece) for piece in self.pieces(text or "")])

    def decode(self, packed: bytes | None) -> bytes:
        """The bytes of packed ids, concatenated up the tree."""

        def span(ids: memoryview) -> bytes:
            if len(ids) <= LEAF_IDS:
                return b"".join(map(self.tokens.__getitem__, ids))
            middle = len(ids) // 2
            return span(ids[:middle]) + span(ids[middle:])

        return span(memoryview(packed or b"").cast("I"))


@lru_cache(maxsize=2)
def _codec(ranks: bytes, pattern: str) -> Codec:
    return Codec(ranks, pattern)


kept_by("bpe", _codec.cache_clear)


def encode(docs: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: its id, the columns to keep, ``ids`` (packed little-endian, four bytes each) and ``n_tokens``."""
    rows = docs.select(col(id_col), *[col(c) for c in keep], col(text_col).cast("string").alias("text_"))
    shipped = docs.sparkSession.sparkContext.broadcast(ranks)  # under a megabyte, fixed by the vocabulary

    def run(texts: list) -> list[bytes]:
        working("bpe")
        codec = _codec(shipped.value, pattern)
        return [codec.encode(text) for text in texts]

    coded = with_values(rows, "text_", "ids", "binary", pa.binary(), run)
    return coded.drop("text_").withColumn("n_tokens", (F.length("ids") / 4).cast("long"))


def decode(coded: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """The rows of ``encode`` with ``decoded``, the bytes of their ids."""
    shipped = coded.sparkSession.sparkContext.broadcast(ranks)

    def run(found: list) -> list[bytes]:
        working("bpe")
        codec = _codec(shipped.value, pattern)
        return [codec.decode(ids) for ids in found]

    return with_values(coded, "ids", "decoded", "binary", pa.binary(), run)
