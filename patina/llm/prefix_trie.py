"""Trie of the turns that conversations begin with, from adaptive radix trees.

Each distinct turn (role and text) has an id of fixed width, the first 16 bytes of a SHA-256
in big-endian order, and a conversation is the string of its turns' ids. These strings are
sorted into ranges; equal ones become one key. A task reads its range in blocks of a
bounded number of keys and builds an adaptive radix tree of each. Only byte depths at which
a turn ends are nodes of the trie. What lies within one block is complete. The nodes on the
way to a block's first and last key may go on in the blocks beside it; only they are added
up between blocks. Texts never travel: ids and lengths do.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patina.llm.art import RadixTree, common_length
from patina.llm.shared import broadcast_below, ship, stored

WIDTH = 16  # bytes of a turn's id
BLOCK_BYTES = 4_000_000  # keys and lengths of one radix tree
CHUNK_IDS = 4096  # conversations whose ids travel as one text
BROADCAST_ROWS = 100_000  # nodes that several blocks share, some hundred bytes each

_CHUNKS = "key binary, chars array<bigint>, first_id bigint, n bigint, ids string, part int"
_NODES = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "all_chars bigint, new_chars bigint, ends_sha256 string, node binary, parent binary"
)
NOBODY = hashlib.sha256(b"").hexdigest()


def turn_sequences(messages: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, turns) with turns an array of (id, chars) in order: null turn numbers first.

    Equal turn numbers are ordered by id, which is a hash of role and text.
    """
    role_, text_ = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    told = F.concat(F.octet_length(role_).cast("string"), F.lit(":"), role_, text_)
    rows = messages.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.substring(F.sha2(told, 256), 1, 2 * WIDTH).alias("id"),
            F.length(text_).cast("bigint").alias("chars"),
        ).alias("row"),
    )
    turns = F.transform(F.array_sort(F.collect_list("row")), lambda r: F.struct(r["id"].alias("id"), r["chars"].alias("chars")))
    return rows.groupBy("conv_id").agg(turns.alias("turns"))


def share_openings(sequences: DataFrame, every: int = 100, choices: int = 6) -> DataFrame:
    """Give conversation c the first h turns of conversation c - c % ``every`` in place of its own.

    h is crc32(c) % ``choices``; fewer turns where that conversation has fewer.
    """
    heads = sequences.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, choices - 1).alias("opening")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % choices).cast("int")
    rows = sequences.select("*", (F.col("conv_id") - F.col("conv_id") % every).alias("base"), h.alias("h"))
    own = F.when(F.size("turns") > F.col("h"), F.expr("slice(turns, h + 1, size(turns) - h)"))
    none = F.expr("slice(turns, 1, 0)")
    opening = F.when(F.col("h") > 0, F.coalesce(F.slice("opening", F.lit(1), F.col("h")), none)).otherwise(none)
    return rows.join(heads, "base", "left").select("conv_id", F.concat(opening, F.coalesce(own, none)).alias("turns"))


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows with equal keys, in chunks of at most ``CHUNK_IDS`` conversations."""
    part = TaskContext.get().partitionId()
    names = ["key", "chars", "first_id", "n", "ids", "part"]
    kinds = [pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.string(), pa.int32()]
    key, chars, ids = None, None, []
    for batch in batches:
        rows = []
        columns = (batch.column(c).to_pylist() for c in ("key", "chars", "conv_id"))
        for k, c, i in zip(*columns, strict=True):
            if ids and (k != key or len(ids) == CHUNK_IDS):
                rows.append((key, chars, ids[0], len(ids), ",".join(map(str, ids)), part))
                ids = []
            key, chars = k, c
            ids.append(i)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
    if ids:
        last = (key, chars, ids[0], len(ids), ",".join(map(str, ids)), part)
        yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(last, kinds, strict=True)], names)


def _ends(chunks: DataFrame, part: str) -> list[tuple[int, bytes, bytes]]:
    """Number, first key and last key of each range, in order.

    The driver holds two keys for each range of the sort, and the session's settings bound
    the number of ranges.
    """
    found = chunks.groupBy(part).agg(F.min("key").alias("first"), F.max("key").alias("last")).collect()
    return sorted((r[part], bytes(r["first"]), bytes(r["last"])) for r in found)


def _gathered(chunks: DataFrame) -> DataFrame:
    """``chunks`` with ``owner``: a key that several ranges hold goes to the first of them."""
    moved, owner, last = [], None, None
    for part, first, end in _ends(chunks, "part"):
        if first == last:
            moved.append((part, first, owner))
        if end != last:
            owner = part
        last = end
    if not moved:
        return chunks.withColumn("owner", F.col("part"))
    to = chunks.sparkSession.createDataFrame(moved, "part int, key binary, owner int")
    owner_ = F.coalesce(F.col("owner"), F.col("part")).alias("owner")
    return chunks.join(F.broadcast(to), ["part", "key"], "left").select(*chunks.columns, owner_)


def _meetings(ends: list[tuple[int, bytes, bytes]]) -> dict[int, tuple[int, int, bool]]:
    """How each range meets its neighbours; see ``_Block``."""
    found = {}
    for k, (part, first, last) in enumerate(ends):
        start = common_length(ends[k - 1][2], first) // WIDTH if k else -1
        after = ends[k + 1][1] if k + 1 < len(ends) else None
        found[part] = (start, *_onward(last, after))
    return found


def _onward(last: bytes, after: bytes | None) -> tuple[int, bool]:
    if after is None:
        return -1, False
    return common_length(last, after) // WIDTH, after.startswith(last)


class _Block:
    """A radix tree of consecutive keys.

    ``start`` is the number of turns that its first key shares with the key before, -1
    where there is none.
    """

    def __init__(self, start: int) -> None:
        self.start, self.tree = start, RadixTree()
        self.first = self.last = b""
        self.size = 0

    def add(self, key: bytes, chars: list[int], n: int, least: int, ends: str) -> None:
        self.tree.insert(key, (key, chars, n, least, ends))
        self.first = self.first if self.size else key
        self.last = key
        self.size += 2 * len(key) + 64

    def nodes(self, stop: int, goes_on: bool) -> list[list]:
        """Rows of ``_NODES`` for all nodes of the trie that this block holds.

        ``stop`` is the number of turns that the last key shares with the key after, and
        ``goes_on`` says whether that key continues the last one.
        """
        rows: list[list] = []
        below: list[tuple] = []  # summaries of finished subtrees whose parent is still to come
        for node, length in self.tree.bottom_up():
            count = sum(1 for _ in node.children.items()) if node.children else 0
            parts = below[len(below) - count :]
            del below[len(below) - count :]
            key, chars, n, least, ends = node.value or (*(parts[0][:2] if parts else (b"", [])), 0, None, NOBODY)
            n += sum(p[2] for p in parts)
            least = min([p[3] for p in parts] + ([] if least is None else [least]), default=None)
            leaves, every, new, fresh = (sum(p[k] for p in parts) for k in range(4, 8))
            tops = [row for p in parts for row in p[8]]
            above = length - len(node.path)
            for depth in range(length // WIDTH, above // WIDTH, -1) if length else (0,):
                before = depth <= self.start and self.first.startswith(key[: depth * WIDTH])
                shared = before or depth == 0 or (depth <= stop and self.last.startswith(key[: depth * WIDTH]))
                if not tops:
                    leaves = 0 if goes_on and key == self.last else 1
                said = chars[depth - 1] if depth else 0
                every += n * said
                new += 0 if before else said
                name = hashlib.sha256(key[: depth * WIDTH]).digest()[:WIDTH] if shared else None
                for row in tops:
                    rows[row][2], rows[row][10] = least, name
                tops = [len(rows)]
                here = ends if depth * WIDTH == length else NOBODY
                rows.append([least, depth, None, n, fresh, leaves, every, new, here, name, None])
                fresh = 0 if before else 1
            below.append((key, chars, n, least, leaves, every, new, fresh, tops))
        return rows


def _build(batches: Iterator[pa.RecordBatch], meetings: dict[int, tuple[int, int, bool]]) -> Iterator[list[list]]:
    """Nodes of every block, from chunks in the order of owner, key and first id."""
    owner, key, chars, n, least, digest = None, None, [], 0, 0, None
    block: _Block | None = None

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("owner", "key", "chars", "first_id", "n", "ids"))
        for o, k, c, first, count, ids in zip(*columns, strict=True):
            if o == owner and k == key:
                digest.update(b"," + ids.encode())
                n += count
                continue
            if block is not None:
                block.add(key, chars, n, least, digest.hexdigest())
                if o != owner:
                    yield block.nodes(*meetings[owner][1:])
                elif block.size >= BLOCK_BYTES:
                    yield block.nodes(*_onward(key, k))
                    block = _Block(common_length(key, k) // WIDTH)
            if o != owner:
                block = _Block(meetings[o][0])
            owner, key, chars, n, least, digest = o, k, c, count, first, hashlib.sha256(ids.encode())
    if block is not None:
        block.add(key, chars, n, least, digest.hexdigest())
        yield block.nodes(*meetings[owner][1:])


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """Nodes of the trie of ``sequences`` (conv_id, turns).

    A node is a distinct sequence of first turns; its members are the conversations that
    begin with it, conversations without turns being members of the root alone. conv_id
    and parent_conv_id are the smallest members of a node and its parent, n_children and
    n_leaves count nodes below, saved_tokens adds up, over the subtree, the characters that
    each node's last turn would have been stored again, and ends_sha256 is the SHA-256 of the ids of
    conversations that end at the node, in order and joined by commas.

    Conversation ids must differ and not be null. An empty table has no nodes, not even a
    root. One conversation is one row of a task, at some forty bytes a turn; any number of
    equal ones or of conversations with the same opening are spread over tasks.
    """
    spark = sequences.sparkSession
    ship(spark)
    ids = F.transform("turns", lambda t: t["id"])
    keyed = sequences.select(
        F.unhex(F.array_join(ids, "")).alias("key"), F.transform("turns", lambda t: t["chars"]).alias("chars"), "conv_id"
    )
    ordered = keyed.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    chunks = stored(ordered.mapInArrow(_chunked, _CHUNKS))
    placed = _gathered(chunks)
    meetings = spark.sparkContext.broadcast(_meetings(_ends(placed, "owner")))
    kinds = [*[pa.int64()] * 8, pa.string(), pa.binary(), pa.binary()]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _NODES.split(", ")]
        for rows in _build(batches, meetings.value):
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names)

    in_order = placed.repartition("owner").sortWithinPartitions("owner", "key", "first_id")
    nodes = stored(in_order.select("owner", "key", "chars", "first_id", "n", "ids").mapInArrow(build, _NODES))
    added = ["n_convs", "n_children", "n_leaves", "all_chars", "new_chars"]
    shared = stored(
        nodes.where(F.col("node").isNotNull())
        .groupBy("node", "depth")
        .agg(
            F.min("conv_id").alias("conv_id"),
            *[F.sum(c).alias(c) for c in added],
            F.coalesce(F.max(F.when(F.col("ends_sha256") != NOBODY, F.col("ends_sha256"))), F.lit(NOBODY)).alias("ends_sha256"),
            F.max("parent").alias("parent"),
        )
    )
    columns = ["conv_id", "depth", *added, "ends_sha256", "parent"]
    own = nodes.where(F.col("node").isNull())
    known = own.where(F.col("parent").isNull()).select(*columns, "parent_conv_id")
    asking = own.where(F.col("parent").isNotNull()).select(*columns).unionByName(shared.select(*columns))
    parents = broadcast_below(shared.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id")), BROADCAST_ROWS)
    found = asking.join(parents, "parent", "left").select(*columns, "parent_conv_id").unionByName(known)
    return found.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        (F.col("all_chars") - F.col("new_chars")).alias("saved_tokens"),
        "ends_sha256",
    )
