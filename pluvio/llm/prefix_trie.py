"""The prefix trie of conversations, with what its shared beginnings save.

Conversations are compared by the 128-bit digests of their turns. Those that are
the same from the first turn to the last are one sequence; sequences are dealt to
partitions by range and sorted, so neighbours share the longest beginnings. In a
partition, the lengths of the common prefixes of neighbours are edges, and a
union-find joins them in descending depth: every merge of components makes a
branching node, and the turns between two branching nodes are nodes with the
members of the lower one.

A node that lies on the path of a partition's first or last sequence may go on
in the partition beside it. All others are final at once. What hangs below an open
node is contracted into it: members, smallest id, children, leaves and saved tokens.
The open nodes of ``FANIN`` neighbouring partitions, as sequences that end where the
nodes lie, then go through the same union-find together, until one forest is left.
A row whose parent was still open takes the parent's id from the level that closes it.

Of a conversation, 24 bytes a turn meet in one row; all else is bounded by a
partition. Turns before the start of a rebuilt conversation are taken from the
first few turns of the conversation they begin with. Ids of
conversations with one sequence, however many, are dealt by range, joined to texts
in blocks and hashed in order as a stream of blocks.

Null roles and texts are empty ones. Turns without ``conv_id`` belong to no conversation and
are left out. Turns are ordered by turn, null first; equal ones by the digest of
role and text, so repeated rows follow one another and count as turns. A
conversation without turns is a member of the root. Without conversations there
are no rows, not even a root. Extra columns, clashing ones too, are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import col, staged

#: Partitions whose open nodes meet in one task.
FANIN = 64
#: Turns of a partition of sequences: at most where there are many, about where there are few.
MOST_TURNS, FEW_TURNS = 2**20, 2**13
#: Ids joined to one text.
IDS = 2**16
#: Bytes of a turn's digest, and copies of an open node that its children are joined with.
WIDTH, SALTS = 16, 16
WORD = "[^\\x20\\x09-\\x0D]+"
NOTHING = hashlib.sha256(b"").hexdigest()

#: A sequence, or a contracted open node: its path, words of every turn, members that
#: end there or below, the smallest of them, contracted children, leaves and savings.
SEQUENCE = "path binary, words array<int>, n bigint, first bigint, kids bigint, leaves bigint, saved bigint, ends string"
NODE = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends_sha256 string"
)
#: ``part`` is the partition of an open node; ``name`` names a node, ``above`` the open node a row hangs from.
OUT = f"open boolean, part int, name binary, above binary, {NODE}, {SEQUENCE}"
NODE_NAMES = [c.split()[0] for c in NODE.split(", ")]
SEQUENCE_NAMES = [c.split()[0] for c in SEQUENCE.split(", ")]


def shared_turns(a: bytes, b: bytes) -> int:
    """How many turns two paths have in common from the start."""
    n = min(len(a), len(b)) // WIDTH
    same = np.frombuffer(a, np.uint64, 2 * n) == np.frombuffer(b, np.uint64, 2 * n)
    return n if same.all() else int(np.argmin(same)) // 2


def _name(path: bytes) -> bytes:
    return hashlib.blake2b(path, digest_size=WIDTH).digest()


class Forest:
    """Sorted sequences joined into a forest by union-find over their neighbours' common prefixes."""

    def __init__(self, rows: pd.DataFrame, named: bool = False) -> None:
        self.rows, self.named = rows, named  # with ``named``, nodes may have children that wait for them
        self.paths = rows["path"].tolist()
        n = len(self.paths)
        self.depth = [len(p) // WIDTH for p in self.paths]  # of nodes; the first n are the sequences
        self.where = list(range(n))  # a sequence below each node, which has its path
        self.parent = [-1] * n
        self.children: list[list[int]] = [[] for _ in range(n)]
        edges = np.array([shared_turns(a, b) for a, b in zip(self.paths, self.paths[1:], strict=False)], np.int64)
        component, top = list(range(n)), list(range(n))

        def find(i: int) -> int:
            while component[i] != i:
                component[i] = component[component[i]]
                i = component[i]
            return i

        for i in np.argsort(-edges, kind="stable").tolist():
            left, right, depth = find(i), find(i + 1), int(edges[i])
            a, b = top[left], top[right]
            if self.depth[a] != depth and self.depth[b] != depth:
                node = self._node(depth, i)
                self._under(a, node)
                self._under(b, node)
            elif self.depth[a] == depth == self.depth[b]:
                node = self._join(a, b)
            else:
                node, other = (a, b) if self.depth[a] == depth else (b, a)
                self._under(other, node)
            component[right] = left
            top[left] = node
        self.root = top[find(0)]

    def _node(self, depth: int, where: int) -> int:
        self.depth.append(depth)
        self.where.append(where)
        self.parent.append(-1)
        self.children.append([])
        return len(self.depth) - 1

    def _under(self, child: int, node: int) -> None:
        self.parent[child] = node
        self.children[node].append(child)

    def _join(self, a: int, b: int) -> int:
        """Two nodes of one path: the one with fewer children goes into the other."""
        keep, gone = (a, b) if len(self.children[a]) >= len(self.children[b]) else (b, a)
        for child in self.children[gone]:
            self._under(child, keep)
        self.children[gone] = []
        self.parent[gone] = keep
        self.depth[gone] = -1  # from now on a part of ``keep``
        return keep

    def grown(self, last: bool) -> pd.DataFrame:
        """Final nodes as rows, and open ones contracted; with ``last`` every node is final."""
        rows, size = self.rows, len(self.depth)
        own = {c: rows[c].to_numpy(np.int64) for c in ("n", "kids", "leaves", "saved")}
        n, kids, leaves, saved = (np.concatenate([own[c], np.zeros(size - len(rows), np.int64)]) for c in own)
        first = np.concatenate([rows["first"].to_numpy(np.int64), np.full(size - len(rows), np.iinfo(np.int64).max)])
        ends = [*rows["ends"].tolist(), *[None] * (size - len(rows))]
        for i in range(len(rows)):  # sequences that became a part of another node of their path
            if self.depth[i] < 0:
                node = self.parent[i]
                while self.depth[node] < 0:
                    node = self.parent[node]
                for values in (n, kids, leaves, saved):
                    values[node] += values[i]
                first[node] = min(first[node], first[i])
                ends[node] = ends[node] or ends[i]
        order, stack = [], [self.root]
        while stack:
            node = stack.pop()
            order.append(node)
            stack += self.children[node]
        open_nodes: set[int] = set()
        if not last:
            # The first sequence of all comes behind the open nodes on its path.
            left = 0
            while left + 1 < len(rows) and self.paths[left + 1].startswith(self.paths[left]):
                left += 1
            for node in (left, len(rows) - 1):
                while node >= 0:
                    if self.depth[node] >= 0:
                        open_nodes.add(node)
                    node = self.parent[node]
        words = rows["words"].tolist()
        below = np.zeros(size, np.int64)  # savings of the nodes from right under the parent on
        made: list[tuple] = []
        held_n, held_first = n.copy(), first.copy()  # what an open node holds itself once contracted
        for node in reversed(order):
            is_open, depth = node in open_nodes, self.depth[node]
            for child in self.children[node]:
                n[node] += n[child]
                first[node] = min(first[node], first[child])
                if child not in open_nodes:
                    kids[node] += 1
                    leaves[node] += leaves[child]
                    saved[node] += below[child]
                    held_n[node] += n[child]
                    held_first[node] = min(held_first[node], first[child])
            if is_open:
                continue
            if kids[node] == 0:
                leaves[node] = 1
            above = self.depth[self.parent[node]] if self.parent[node] >= 0 else -1
            turns = words[self.where[node]]
            costs = [int(turns[d - 1]) if d else 0 for d in range(above + 1, depth + 1)]
            totals = saved[node] + (n[node] - 1) * np.cumsum(costs[::-1])[::-1] if costs else np.zeros(0, np.int64)
            below[node] = totals[0]
            for place, d in enumerate(range(above + 1, depth + 1)):
                made.append((node, d, int(totals[place])))
        out: list[tuple] = []
        for node, d, total in made:
            up, top = self.parent[node], d == (self.depth[self.parent[node]] if self.parent[node] >= 0 else -1) + 1
            hangs = top and up in open_nodes
            path = self.paths[self.where[node]]
            lowest = d == self.depth[node]
            above_conv = None if top and (up < 0 or hangs) else int(first[up]) if top else int(first[node])
            out.append((
                False, None, _name(path[: WIDTH * d]) if self.named and lowest else None, _name(path[: WIDTH * (d - 1)]) if hangs else None,
                int(first[node]), d, above_conv, int(n[node]), int(kids[node]) if lowest else 1, int(leaves[node]), total,
                (ends[node] or NOTHING) if lowest else NOTHING, *[None] * len(SEQUENCE_NAMES),
            ))
        part = None if last else TaskContext.get().partitionId()
        for node in sorted(open_nodes, key=lambda v: self.depth[v]):
            d, at = self.depth[node], self.where[node]
            out.append((
                True, part, None, None, *[None] * len(NODE_NAMES), self.paths[at][: WIDTH * d], words[at][:d], int(held_n[node]), int(held_first[node]),
                int(kids[node]), int(leaves[node]), int(saved[node]), ends[node],
            ))
        return pd.DataFrame(out, columns=["open", "part", "name", "above", *NODE_NAMES, *SEQUENCE_NAMES], dtype=object)


def _arrow(frame: pd.DataFrame, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    yield from pa.Table.from_pandas(frame, schema, preserve_index=False).to_batches(max_chunksize=4096)


ARROW_OUT = pa.schema(
    [("open", pa.bool_()), ("part", pa.int32()), ("name", pa.binary()), ("above", pa.binary())]
    + [(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in NODE.split(", ")]
    + [
        ("path", pa.binary()), ("words", pa.list_(pa.int32())), ("n", pa.int64()), ("first", pa.int64()),
        ("kids", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.string()),
    ]
)


def _grow(sequences: DataFrame) -> DataFrame:
    """The forest of every partition of sorted sequences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            yield from _arrow(Forest(pa.Table.from_batches(held).to_pandas()).grown(last=False), ARROW_OUT)

    return sequences.mapInArrow(run, OUT)


def _close(opened: DataFrame, last: bool) -> DataFrame:
    """Open nodes of ``FANIN`` neighbouring partitions joined into one forest."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("path", kind="stable", ignore_index=True)
        group = int(rows["group"].iloc[0])
        made = Forest(rows, named=True).grown(last)
        made["part"] = np.where(made["open"], group, None)
        return made

    grouped = opened.withColumn("group", F.floor(F.col("part") / FANIN).cast("int"))
    return grouped.select("group", *SEQUENCE_NAMES).groupBy("group").applyInPandas(run, OUT)


def trie(sequences: DataFrame, parts: int) -> DataFrame:
    """All nodes of the trie of distinct sequences (``SEQUENCE``): the columns of ``NODE``."""
    dealt = sequences.repartitionByRange(parts, "path").sortWithinPartitions("path").select(*SEQUENCE_NAMES)
    levels = [staged(_grow(dealt), "trie-level")]
    while parts > 0:
        parts = -(-parts // FANIN)
        opened = levels[-1].where("open")
        levels.append(staged(_close(opened, last=parts == 1), "trie-level"))
        if parts == 1:
            break
    final = None
    for level in levels:
        rows = level.where("not open").select("name", "above", *NODE_NAMES)
        final = rows if final is None else final.unionByName(rows)
    closed = None
    for level in levels[1:]:
        rows = level.where("name is not null").select(F.col("name").alias("above"), F.col("conv_id").alias("_parent"))
        closed = rows if closed is None else closed.unionByName(rows)
    # The children of one open node may be most of all rows, so its id is joined in copies.
    salted = closed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    waiting = final.where("above is not null").withColumn("_salt", F.pmod(F.xxhash64("conv_id"), F.lit(SALTS)).cast("int"))
    found = waiting.join(salted, ["above", "_salt"]).withColumn("parent_conv_id", F.col("_parent"))
    return final.where("above is null").select(*NODE_NAMES).unionByName(found.select(*NODE_NAMES))


def _sha_of_ids(members: DataFrame, parts: int) -> DataFrame:
    """Per sequence: its members, the smallest, and the digest of all ids in ascending order."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []

        def block() -> pa.RecordBatch:
            text = ",".join(map(str, ids))
            return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([ids[0]]), pa.array([len(ids)]), pa.array([text])], ["key", "first", "n", "text"])

        for batch in batches:
            for one, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if ids and (one != key or len(ids) == IDS):
                    yield block()
                    ids = []
                key = one
                ids.append(conv)
        if ids:
            yield block()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, n, sha = None, 0, 0, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([first]), pa.array([n]), pa.array([sha.hexdigest()])], ["key", "first", "n", "ends"])

        for batch in batches:
            for one, low, count, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if one != key:
                    if key is not None:
                        yield done()
                    key, first, n, sha = one, low, 0, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(text.encode())
                n += count
        if key is not None:
            yield done()

    dealt = members.repartitionByRange(parts, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    texts = dealt.select("key", "conv_id").mapInArrow(blocks, "key binary, first bigint, n bigint, text string")
    return texts.repartition("key").sortWithinPartitions("key", "first").mapInArrow(digests, "key binary, first bigint, n bigint, ends string")


def rebuilt(turns: DataFrame, head: Column, base: Column, most: int) -> DataFrame:
    """Conversations (conv_id, list) whose first ``head`` turns are those of conversation ``base``.

    ``turns`` has conv_id and list, the ordered turns; ``head`` is at most ``most``,
    and the base of a base is itself.
    """
    heads = turns.where(base == F.col("conv_id")).select(F.col("conv_id").alias("_base"), F.slice("list", 1, most).alias("_head"))
    wanted = turns.withColumns({"_n": head.cast("int"), "_base": base})
    joined = wanted.join(heads, "_base", "left")
    taken = F.coalesce(F.slice("_head", F.lit(1), F.col("_n")), F.slice("list", 1, 0))
    own = F.slice("list", F.col("_n") + 1, F.size("list"))
    return joined.select("conv_id", F.concat(taken, own).alias("list"))


def ordered_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: conv_id, and list, the digest and number of words of every turn in order."""
    role_, text_ = (F.coalesce(col(c).cast("string"), F.lit("")) for c in (role, text))
    whole = F.concat(F.char_length(role_).cast("string"), F.lit(":"), role_, text_)
    digest = F.substring(F.sha2(whole.cast("binary"), 256), 1, 2 * WIDTH)
    rows = conversations.where(col(conv_id).isNotNull()).select(
        col(conv_id).cast("bigint").alias("conv_id"),
        F.struct(col(turn).isNotNull().alias("given"), col(turn).alias("turn"), digest.alias("digest"), F.regexp_count(text_, F.lit(WORD)).alias("words")).alias("t"),
    )
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return ordered.select("conv_id", F.transform("t", lambda x: F.struct(x["digest"].alias("digest"), x["words"].alias("words"))).alias("list"))


def prefix_trie(conversations: DataFrame, parts: int | None = None) -> DataFrame:
    """The trie of conversations (conv_id, list) as ``ordered_turns`` or ``rebuilt`` give them: ``NODE``."""
    path = F.unhex(F.concat_ws("", F.transform("list", lambda x: x["digest"])))
    whole = conversations.select("conv_id", path.alias("path"), F.transform("list", lambda x: x["words"]).alias("words"))
    whole = staged(whole.withColumn("key", F.unhex(F.substring(F.sha2("path", 256), 1, 2 * WIDTH))), "trie-conversations")
    turns = whole.agg(F.coalesce(F.sum(F.size("words")), F.lit(0)), F.count("*")).first()
    if turns[1] == 0:
        return whole.sparkSession.createDataFrame([], NODE)
    if parts is None:
        few = min(-(-turns[0] // FEW_TURNS), int(whole.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        parts = max(1, few, -(-turns[0] // MOST_TURNS))
    ends = _sha_of_ids(whole.select("key", "conv_id"), parts)
    paths = whole.groupBy("key").agg(F.any_value("path").alias("path"), F.any_value("words").alias("words"))
    zero = F.lit(0).cast("bigint")
    sequences = paths.join(ends, "key").select(
        "path", "words", "n", "first", zero.alias("kids"), zero.alias("leaves"), zero.alias("saved"), "ends"
    )
    return trie(sequences, parts)
