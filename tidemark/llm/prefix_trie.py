"""Prefix trie of conversations by vertical bitmaps.

A node of depth d stands for one sequence of d turns (role and text); conversations that begin with
it are its members.

1. Turns become digests: md5 of role and text, and the number of words.  Texts are not shuffled.
2. Shards.  2 ** ``SHARD_BITS`` neighbouring conversation ids are a shard, whose members are the bits of a
   bitset.  A task reads a shard's turns by position, ``BLOCK`` positions at a time, and indexes
   (position, turn) to the bitset of the conversations that have it there.
3. Depth-first.  From the root's bitset on, the turn of a node's lowest member not yet dealt with names the
   next child: the node's bitset and that turn's posting are its members, and leave the rest.  Members
   without a turn there end in the node.  Nodes at the end of a block wait for the next, so a
   shard holds one block of turns and a bitset for each open node, however long a conversation is.
4. Shards together.  A node is known by the chained md5 of its turns.  Its shards' popcounts add up, the
   smallest member names it, end lists follow each other in order of shards.
5. Subtrees.  Every node is owned by the shard of its smallest member.  Shards are read once more, deepest nodes
   first; what a node owned here is worth (a child, a leaf, saved tokens) is added up to the root within the
   shard, and the shards' sums add up by node.  Rows are at most the nodes of all shards, never nodes
   times depth.

A hot prefix is one row per shard.  A conversation is read in order by one task; the SHA-256 of an end
list runs over the list in order, as bitsets, one row a shard.

Defined results: turns go by number, null first, those of one number by role, then by md5; null role or
text is empty; rows without a conversation id belong to no conversation; repeated rows are turns of
their own; an empty table gives no rows, not even a root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import prepare, rows_in, saved

SHARD_BITS = 8
BLOCK = 64       # positions of a shard that are indexed at a time
ROWS = 10_000    # rows of an Arrow batch

MEMBER, HEAD, OWN = -1, 0, 1  # kinds of rows of a conversation, in their order

_NODE = [("shard", pa.int64()), ("no", pa.int64()), ("parent", pa.int64()), ("path", pa.binary()), ("depth", pa.int64()),
         ("n", pa.int64()), ("least", pa.int64()), ("words", pa.int64()), ("inner", pa.bool_()), ("ends_at", pa.int64()),
         ("ends", pa.binary())]
NODE = ("shard long, no long, parent long, path binary, depth long, n long, least long, words long, inner boolean, "
        "ends_at long, ends binary")
_PART = [("path", pa.binary()), ("conv", pa.int64()), ("depth", pa.int64()), ("parent_conv", pa.int64()), ("n", pa.int64()),
         ("children", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64())]
PART = "path binary, conv long, depth long, parent_conv long, n long, children long, leaves long, saved long"


def batches_of(rows: Iterator[tuple], fields: list) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*held), fields)], [n for n, _ in fields])
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*held), fields)], [n for n, _ in fields])


def digests(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """(conv, at, key, words): the turns of every conversation, numbered from 0."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    plain = turns.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("key"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "key")
    return plain.select("conv", (F.row_number().over(order) - 1).cast("long").alias("at"), "key", "words")


def members(numbered: DataFrame) -> DataFrame:
    """One row of no turn per conversation of ``digests``."""
    return numbered.filter("at = 0").select("conv", F.lit(MEMBER).alias("kind"), F.lit(0).cast("long").alias("at"),
                                            F.lit(None).cast("binary").alias("key"), F.lit(0).cast("long").alias("words"))


def conversations(numbered: DataFrame) -> DataFrame:
    """The rows of every conversation as it is: (conv, kind, at, key, words)."""
    own = numbered.select("conv", F.lit(OWN).alias("kind"), "at", "key", "words")
    return own.unionByName(members(numbered))


def with_family_heads(numbered: DataFrame, family: int = 20, most: int = 4) -> DataFrame:
    """The rows of conversations that begin as the first of their family does: conversation c takes
    the first h = crc32(c) % ``most`` turns of conversation c - c % ``family`` (what there is), then
    its own turns after its first h."""
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % most).cast("long")
    own = numbered.filter(F.col("at") >= h).select("conv", F.lit(OWN).alias("kind"), "at", "key", "words")
    first = (numbered.filter((F.col("conv") % family == 0) & (F.col("at") < most - 1))
             .select(F.col("conv").alias("base"), "at", "key", "words"))
    heads = (numbered.filter("at = 0").select("conv", (F.col("conv") - F.col("conv") % family).alias("base"), h.alias("h"))
             .join(first, "base").filter("at < h").select("conv", F.lit(HEAD).alias("kind"), "at", "key", "words"))
    return own.unionByName(heads).unionByName(members(numbered))


class Shard:
    """The open nodes of one shard, and the block of turns being indexed."""

    def __init__(self, shard: int, bits: int):
        self.shard, self.first, self.made = shard, shard << bits, 1
        self.root = 0
        self.low = 0
        self.open: list[tuple] = []   # (no, parent, path, depth, bitset, words)
        self.turns: list[dict] = []   # by position of the block: conversation's bit -> (turn, words)
        self.postings: list[dict] = []  # by position: turn -> bitset

    def read(self, pos: int, conv: int, key: bytes | None, words: int) -> Iterator[tuple]:
        bit = conv - self.first
        if pos < 0:
            self.root |= 1 << bit
            return
        if not self.open and not self.turns:
            self.open = [(0, -1, b"", 0, self.root, 0)]
        if pos >= self.low + BLOCK:
            yield from self.descend()
            self.low += BLOCK
            self.turns, self.postings = [], []
        if pos - self.low == len(self.turns):
            self.turns.append({})
            self.postings.append({})
        self.turns[pos - self.low][bit] = (key, words)
        posting = self.postings[pos - self.low]
        posting[key] = posting.get(key, 0) | 1 << bit

    def close(self) -> Iterator[tuple]:
        if not self.open:
            self.open = [(0, -1, b"", 0, self.root, 0)]
        yield from self.descend()
        self.low, self.turns = self.low + BLOCK, []
        yield from self.descend()

    def descend(self) -> Iterator[tuple]:
        """Expand the open nodes depth first through the block; those at its end stay open."""
        stack, self.open = self.open, []
        high = self.low + BLOCK
        while stack:
            node = stack.pop()
            no, parent, path, depth, bitset, words = node
            if depth == high:
                self.open.append(node)
                continue
            ends, inner = bitset, False
            if depth - self.low < len(self.turns):
                turn, posting = self.turns[depth - self.low], self.postings[depth - self.low]
                rest, ends = bitset, 0
                while rest:
                    lowest = rest & -rest
                    here = turn.get(lowest.bit_length() - 1)
                    if here is None:
                        ends |= lowest
                        rest ^= lowest
                        continue
                    child = bitset & posting[here[0]]
                    rest ^= child
                    inner = True
                    stack.append((self.made, no, hashlib.md5(path + here[0]).digest(), depth + 1, child, here[1]))
                    self.made += 1
            least = (bitset & -bitset).bit_length() - 1
            at = bits = None
            if ends:
                at = (ends & -ends).bit_length() - 1
                bits = ends >> at
                at, bits = self.first + at, bits.to_bytes((bits.bit_length() + 7) // 8, "little")
            yield (self.shard, no, parent, path, depth, bitset.bit_count(), self.first + least, words, inner, at, bits)


def grown(rows: DataFrame, bits: int) -> DataFrame:
    """The nodes of every shard (``NODE``), from rows of conversations."""
    sharded = rows.withColumn("shard", F.shiftright("conv", bits)).repartition("shard")
    order = Window.partitionBy("shard", "conv").orderBy("kind", "at")
    placed = (sharded.withColumn("pos", (F.row_number().over(order) - 2).cast("long"))
              .select("shard", "pos", "conv", "key", "words").sortWithinPartitions("shard", "pos", "conv"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def nodes():
            at = None
            for columns in rows_in(batches, "shard", "pos", "conv", "key", "words"):
                for shard, pos, conv, key, words in zip(*columns):
                    if at is None or at.shard != shard:
                        if at is not None:
                            yield from at.close()
                        at = Shard(shard, bits)
                    yield from at.read(pos, conv, key, words)
            if at is not None:
                yield from at.close()

        yield from batches_of(nodes(), _NODE)

    return saved(placed.mapInArrow(run, NODE), "trie-nodes")


def subtree_sums(nodes: DataFrame) -> DataFrame:
    """(``PART``) per node of every shard: what of its children, leaves and saved tokens is owned
    here; its numbers where the node itself is."""
    every = Window.partitionBy("path")
    told = nodes.select("shard", "no", "parent", "path", "depth", "least", "words", F.sum("n").over(every).alias("n"),
                        F.min("least").over(every).alias("conv"), F.max("inner").over(every).alias("inner"))
    told = told.repartition("shard").sortWithinPartitions("shard", F.col("no").desc())
    names = told.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for columns in rows_in(batches, *names):
                yield from zip(*columns)

        def sums():
            for _, shard in groupby(rows(), key=lambda r: r[0]):
                held: dict[int, list] = {}     # by node still to come: children, leaves, saved below it
                waiting: dict[int, list] = {}  # by node still to come: its children, which need its name
                for _, no, parent, path, depth, least, words, n, conv, inner in shard:
                    children, leaves, spared = held.pop(no, (0, 0, 0))
                    own = least == conv
                    if own:
                        leaves += not inner
                        spared += (n - 1) * words
                    for p, c, d, m, *below in waiting.pop(no, ()):
                        if c is not None or any(below):
                            yield (p, c, d, conv if c is not None else None, m, *below)
                    row = (path, conv if own else None, depth if own else None, n if own else None, children, leaves, spared)
                    if parent < 0:
                        yield (*row[:3], None, *row[3:])
                    else:
                        up = held.setdefault(parent, [0, 0, 0])
                        up[0] += own
                        up[1] += leaves
                        up[2] += spared
                        waiting.setdefault(parent, []).append(row)

        yield from batches_of(sums(), _PART)

    return told.mapInArrow(run, PART)


def end_lists(nodes: DataFrame) -> DataFrame:
    """(path, ends_sha256) of nodes in which conversations end."""
    ends = nodes.filter(F.col("ends").isNotNull()).select("path", "shard", "ends_at", "ends")
    ends = ends.repartition("path").sortWithinPartitions("path", "shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for columns in rows_in(batches, "path", "ends_at", "ends"):
                yield from zip(*columns)

        def hashed():
            for path, parts in groupby(rows(), key=lambda r: r[0]):
                text, between = hashlib.sha256(), ""
                for _, at, bits in parts:
                    left = int.from_bytes(bits, "little")
                    ids = [str(at + k) for k in range(left.bit_length()) if left >> k & 1]
                    text.update((between + ",".join(ids)).encode())
                    between = ","
                yield path, text.hexdigest()

        yield from batches_of(hashed(), [("path", pa.binary()), ("ends_sha256", pa.string())])

    return ends.mapInArrow(run, "path binary, ends_sha256 string")


def prefix_trie(rows: DataFrame, bits: int = SHARD_BITS) -> DataFrame:
    """One row per node of the conversations in ``rows`` (see ``conversations``): (path, conv_id,
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)."""
    prepare(rows.sparkSession)
    nodes = grown(rows, bits)
    sums = subtree_sums(nodes).groupBy("path").agg(
        F.max("conv").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent_conv").alias("parent_conv_id"),
        F.max("n").alias("n_convs"), F.sum("children").alias("n_children"), F.sum("leaves").alias("n_leaves"),
        F.sum("saved").alias("saved_tokens"))
    none = hashlib.sha256(b"").hexdigest()
    return (sums.join(end_lists(nodes), "path", "left")
            .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(none))))
