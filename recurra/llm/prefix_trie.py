"""The trie of all conversations by their first turns, from range-partitioned sorted paths.

A turn is held as a 16-byte digest of its role and text and as the length of its text; texts are not
shuffled. The path of a conversation is the string of its digests, so paths sort by their turns and a
prefix comes first. Splitters cut the sorted paths into shards, one per shuffle partition. A node whose
conversations lie in two shards is a prefix of the splitter between them. The trie of the splitter paths
(the skeleton) is broadcast; each shard walks its sorted paths once and finishes every node that is not in
the skeleton. For skeleton nodes it hands on partial sums, which are added up per node and then along the
skeleton; the ids of the conversations that end at such a node are handed on in order, as pieces of text.

Bounds: splitters come from a sample of ``SAMPLED`` paths per shard and are cut after ``CUT`` turns, so the
skeleton holds at most ``CUT`` nodes per shard whatever the size of the table. Conversations with equal
paths are split by their ids, so a group of copies spreads over shards. The path of one conversation (20
bytes a turn) is held in one task.

Defined cases: turns are ordered by number, those without one first, equal numbers by their digests;
repeated rows are turns of their own; a null role or text is empty; rows without a conversation id belong
to none and are left out; an empty table has no nodes; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from itertools import accumulate, pairwise

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from recurra.llm.common import stored

WIDTH = 16  # bytes of a turn in a path
SHARED_TURNS = 6  # the first 0 to 5 turns come from another conversation
BLOCK = 100  # conversations that share their first turns
SAMPLED = 8
CUT = 64
PIECE = 4096  # ids in a piece
ROWS = 1 << 13
NONE = hashlib.sha256(b"").hexdigest()
LEAST_ID = -(1 << 63)
MEASURES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")


def paths(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id`` and its own ``turns``: an array of digest and length in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.substring(F.unhex(digest), 1, WIDTH).alias("digest"),
        F.length(text).alias("length"),
    )
    ordered = F.sort_array(F.collect_list(turn))
    return (
        turns.where(F.col(conv_col).isNotNull())
        .groupBy(F.col(conv_col).cast("long").alias("conv_id"))
        .agg(F.transform(ordered, lambda t: t.dropFields("turn")).alias("turns"))
    )


def rebuilt(own: DataFrame) -> DataFrame:
    """``own`` paths with the first turns taken from the first conversation of the block of 100."""
    heads = own.where(F.col("conv_id") % BLOCK == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, SHARED_TURNS - 1).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED_TURNS).cast("int")
    head = F.slice(F.coalesce("head", F.array().cast("array<struct<digest:binary,length:int>>")), F.lit(1), h)
    rest = F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))
    joined = own.join(heads, F.col("conv_id") - F.col("conv_id") % BLOCK == F.col("base"), "left")
    return joined.select("conv_id", F.concat(head, rest).alias("turns"))


class Skeleton:
    """The trie of the splitter paths and the shard of a path."""

    def __init__(self, sample: Iterable[tuple[bytes, int]], shards: int):
        keys = sorted({(p[: CUT * WIDTH], c if len(p) <= CUT * WIDTH else LEAST_ID) for p, c in sample})
        step = len(keys) / shards
        self.splitters = sorted({keys[int(i * step)] for i in range(1, shards)} - set(keys[:1])) if keys else []
        self.ids = {b"": 0}
        self.parents = [-1]
        for path, _ in self.splitters:
            for end in range(WIDTH, len(path) + 1, WIDTH):
                if path[:end] not in self.ids:
                    self.parents.append(self.ids[path[: end - WIDTH]])
                    self.ids[path[:end]] = len(self.ids)

    def shard(self, path: bytes, conv: int) -> int:
        return bisect_right(self.splitters, (path, conv))

    def ancestors(self, node: int) -> list[int]:
        above = []
        while (node := self.parents[node]) >= 0:
            above.append(node)
        return above


class _Node:
    """An open node of the path that is being walked."""

    __slots__ = ("depth", "length", "skeleton", "n", "least", "children", "leaves", "saved", "ends", "buffer")

    def __init__(self, depth: int, length: int, skeleton: int):
        self.depth, self.length, self.skeleton = depth, length, skeleton
        self.n = self.children = self.leaves = self.saved = 0
        self.least, self.ends, self.buffer = None, None, None


class _Walk:
    """One shard's sorted paths, walked depth first.

    Finished nodes wait at their parent, as numbers in two flat arrays, until the parent's smallest
    conversation is known; children of a skeleton node leave at once with the node's number.
    """

    def __init__(self, skeleton: Skeleton, shard: int):
        self.skeleton, self.shard = skeleton, shard
        self.stack, self.path = [_Node(0, 0, 0)], b""
        self.rows: list[tuple] = []
        self.full: list[pa.RecordBatch] = []
        self.piece: list[int] = []
        self.pieces = 0

    def add(self, path: bytes, lengths: list[int], conv: int) -> None:
        shared, limit = 0, min(len(path), len(self.path))
        if path[:limit] == self.path[:limit]:
            shared = limit // WIDTH
        else:
            while path[shared * WIDTH : (shared + 1) * WIDTH] == self.path[shared * WIDTH : (shared + 1) * WIDTH]:
                shared += 1
        if len(path) != len(self.path) or shared * WIDTH < len(path):
            self._cut_piece()
        while len(self.stack) > shared + 1:
            self._close()
        for depth in range(shared + 1, len(lengths) + 1):
            known = self.skeleton.ids.get(path[: depth * WIDTH], -1) if self.stack[-1].skeleton >= 0 else -1
            self.stack.append(_Node(depth, lengths[depth - 1], known))
        self.path, last = path, self.stack[-1]
        last.n += 1
        last.least = conv if last.least is None else min(last.least, conv)
        if last.skeleton >= 0:
            self.piece.append(conv)
            if len(self.piece) == PIECE:
                self._cut_piece()
        elif last.ends is None:
            last.ends = hashlib.sha256(str(conv).encode())
        else:
            last.ends.update(f",{conv}".encode())

    def _cut_piece(self) -> None:
        if self.piece:
            text = ",".join(map(str, self.piece))
            self.rows.append(("piece", self.stack[-1].skeleton, self.shard, self.pieces, text, *(None,) * 7))
            self.piece, self.pieces = [], self.pieces + 1

    def _close(self) -> None:
        node, parent = self.stack.pop(), self.stack[-1] if self.stack else None
        if parent:
            parent.n += node.n
            parent.least = node.least if parent.least is None else min(parent.least, node.least)
        if node.skeleton >= 0:
            sums = (node.least, node.depth, None, node.n, node.children, node.leaves, node.saved)
            self.rows.append(("partial", node.skeleton, self.shard, node.length, None, *sums))
            return
        leaves = node.leaves or 1
        saved = node.saved + (node.n - 1) * node.length
        self._leave(node)
        digest = node.ends.digest() if node.ends else bytes.fromhex(NONE)
        parent.children += 1
        parent.leaves += leaves
        parent.saved += saved
        if parent.skeleton >= 0:
            row = (node.least, node.depth, None, node.n, node.children, leaves, saved)
            self.rows.append(("node", parent.skeleton, self.shard, 0, digest.hex(), *row))
        else:
            if parent.buffer is None:
                parent.buffer = (array("q"), bytearray())
            parent.buffer[0].extend((node.least, node.depth, node.n, node.children, leaves, saved))
            parent.buffer[1].extend(digest)

    def _leave(self, node: _Node) -> None:
        """Hand on the finished children of a node whose smallest conversation is known by now."""
        if not node.buffer:
            return
        numbers, digests = node.buffer
        for i in range(len(digests) // 32):
            conv, depth, *rest = numbers[i * 6 : i * 6 + 6]
            self.rows.append(("node", -1, self.shard, 0, digests[i * 32 : i * 32 + 32].hex(), conv, depth, node.least, *rest))
            if len(self.rows) >= ROWS:
                self.full.append(_batch(self.rows))
                self.rows = []
        node.buffer = None

    def take(self) -> list[pa.RecordBatch]:
        """All rows handed on so far."""
        out, self.full, self.rows = [*self.full, *([_batch(self.rows)] if self.rows else [])], [], []
        return out

    def finish(self) -> None:
        self._cut_piece()
        while self.stack:
            self._close()


WALKED = (
    "kind string, skeleton int, shard int, part int, ends string, "
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
)
_TYPES = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string(), *(pa.int64(),) * 7]
_NAMES = [c.split()[0] for c in WALKED.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names=_NAMES)


def _walked(own: DataFrame, skeleton, shards: int) -> DataFrame:
    """Nodes, partial sums and pieces of all shards; ``own`` has ``conv_id`` and packed ``path`` and ``lengths``."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = skeleton.value
        for batch in batches:
            convs, packed = batch.column("conv_id"), batch.column("path")
            shard = [trie.shard(p.as_py(), c.as_py()) for p, c in zip(packed, convs, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), *batch.columns], names=["shard", *batch.schema.names])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Walk | None = None
        for batch in batches:
            for shard, conv, path, lengths in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or now.shard != shard:
                    if now:
                        now.finish()
                        yield from now.take()
                    now = _Walk(skeleton.value, shard)
                now.add(path, lengths, conv)
                if now.full or len(now.rows) >= ROWS:
                    yield from now.take()
        if now:
            now.finish()
            yield from now.take()

    dealt = own.mapInArrow(deal, "shard int, conv_id long, path binary, lengths array<int>")
    return dealt.repartitionById(shards, "shard").sortWithinPartitions("shard", "path", "conv_id").mapInArrow(walk, WALKED)


def _ends(pieces: DataFrame) -> DataFrame:
    """``skeleton`` and the digest of its pieces in order; a node's pieces are streamed, not gathered."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest, done = None, None, []
        for batch in batches:
            for at, text in zip(batch.column("skeleton").to_pylist(), batch.column("ends").to_pylist(), strict=True):
                if at == node:
                    digest.update(b"," + text.encode())
                    continue
                if digest:
                    done.append((node, digest.hexdigest()))
                node, digest = at, hashlib.sha256(text.encode())
        if digest:
            done.append((node, digest.hexdigest()))
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in done], pa.int32()), pa.array([d[1] for d in done], pa.string())], names=["skeleton", "sha"]
            )

    ordered = pieces.select("skeleton", "shard", "part", "ends").repartition("skeleton").sortWithinPartitions("skeleton", "shard", "part")
    return ordered.select("skeleton", "ends").mapInArrow(joined, "skeleton int, sha string")


def _reduced(spark: SparkSession, partial: DataFrame, pieces: DataFrame, trie: Skeleton) -> DataFrame:
    """The skeleton's nodes, whole: partial sums per node, then along the way to the root."""
    children = [0] * len(trie.parents)
    for parent in trie.parents[1:]:
        children[parent] += 1
    shape = spark.createDataFrame(
        [(i, p, children[i], trie.ancestors(i)) for i, p in enumerate(trie.parents)],
        "skeleton int, parent int, inner long, above array<int>",
    )
    sums = partial.groupBy("skeleton").agg(
        F.min("conv_id").alias("conv_id"),
        F.min("depth").alias("depth"),
        F.max("part").alias("length"),
        *(F.sum(c).alias(c) for c in MEASURES[3:]),
    )
    # A skeleton node lies on the path of a sampled conversation, so each has members and sums.
    whole = sums.join(F.broadcast(shape), "skeleton").withColumns(
        {
            "n_children": F.col("n_children") + F.col("inner"),
            "n_leaves": F.col("n_leaves") + F.when(F.col("n_children") + F.col("inner") == 0, 1).otherwise(0),
            "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("length"),
        }
    )
    whole = stored(whole, "skeleton")
    totals = (
        whole.select(F.explode(F.concat(F.array("skeleton"), "above")).alias("skeleton"), "n_leaves", "saved_tokens")
        .groupBy("skeleton")
        .agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    )
    names = whole.select(F.col("skeleton").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (
        whole.drop("n_leaves", "saved_tokens")
        .join(totals, "skeleton")
        .join(names, "parent", "left")
        .join(_ends(pieces), "skeleton", "left")
        .select("skeleton", *MEASURES, F.coalesce("sha", F.lit(NONE)).alias("ends_sha256"))
    )


def trie(own: DataFrame) -> DataFrame:
    """Every node of the trie of ``own`` (``conv_id`` and ``turns`` with digest and length)."""
    spark = own.sparkSession

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("turns")
            digests, lengths = lists.flatten().flatten()
            joined, ends = b"".join(digests.to_pylist()), [0, *accumulate(lists.value_lengths().to_pylist())]
            packed = [joined[a * WIDTH : b * WIDTH] for a, b in pairwise(ends)]
            sizes = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), lengths)
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(packed, pa.binary()), sizes], names=["conv_id", "path", "lengths"])

    packed = stored(own.select("conv_id", "turns").mapInArrow(pack, "conv_id long, path binary, lengths array<int>"), "paths")
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The smallest hashes are a sample of fixed size; paths are cut before they are sent to the driver.
    sample = (
        packed.select(F.substring("path", 1, CUT * WIDTH + 1).alias("path"), "conv_id")
        .orderBy(F.xxhash64("conv_id"), "conv_id")
        .limit(SAMPLED * shards)
        .collect()
    )
    skeleton = Skeleton([(bytes(r.path), r.conv_id) for r in sample], shards)
    walked = stored(_walked(packed, spark.sparkContext.broadcast(skeleton), shards), "nodes")
    inner = _reduced(spark, walked.where("kind = 'partial'"), walked.where("kind = 'piece'"), skeleton)
    inner = stored(inner, "skeleton")
    # At most CUT rows per shard.
    tops = F.broadcast(inner.select("skeleton", F.col("conv_id").alias("top")))
    nodes = (
        walked.where("kind = 'node'")
        .join(tops, "skeleton", "left")
        .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "top"))
        .select(*MEASURES, F.col("ends").alias("ends_sha256"))
    )
    return nodes.unionByName(inner.drop("skeleton"))


def conversation_trie(turns: DataFrame, **columns: str) -> DataFrame:
    """The trie of the rebuilt conversations of ``turns``; ``columns`` names other input columns."""
    return trie(rebuilt(paths(turns, **columns)))
