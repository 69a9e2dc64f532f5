"""SimHash near-duplicates, linked through a grid of segment bit counts.

A half of a 64-bit fingerprint is cut into eight segments of two bits and 16 of one bit. The vector of
bit counts per segment moves by at most one for every flipped bit, so the Manhattan distance of two
such vectors never exceeds the Hamming distance. Fingerprints within four bits therefore have vectors
within four, and in one half within two. Two half vectors within two share a grid point at most one
step from either. Every fingerprint is entered at all grid points one step around its two half
vectors; those that meet at a point are compared exactly. (Two-bit segments alone make chance
meetings 16 times as frequent, and these grow with the square of the rows.)

A grid point may be crowded by near copies. What is sent on from a point is a forest of links (never
all pairs), and points above ``crowd`` members are worked off as pairs of blocks in separate tasks.

Defined cases: a null or empty text has fingerprint zero and links like any other; a null id keeps
its row, with the component of its fingerprint; repeated rows are kept; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from recurra.llm.common import row_key, stored
from recurra.llm.components import connected_components

SEED = 42
SHINGLE = 4
CHUNK = 1 << 16
FIELDS = 0x5555


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """SimHash of the lower-cased word shingles of a UTF-8 text, as an unsigned number."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined, size = b" ".join(words), min(shingle, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate(([0], np.cumsum(lengths[:-1] + 1)))
    first, last = starts[: len(words) - size + 1].tolist(), (starts + lengths)[size - 1 :].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(first), CHUNK):
        hashes = np.array(
            [digest(joined[a:b], SEED) for a, b in zip(first[at : at + CHUNK], last[at : at + CHUNK], strict=True)],
            dtype="<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(first), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint as a signed number) of every row."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            texts = batch.column(1).cast(pa.binary())
            prints = np.fromiter((fingerprint(x.as_py()) for x in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "fp"]
            )

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(batches, "doc_id long, fp long")


def _cells(prints: DataFrame) -> DataFrame:
    """Each distinct fingerprint at the grid points around its two half vectors."""
    fields = F.lit(FIELDS)

    def counted(half: int):
        bits = F.shiftrightunsigned("fp", 32 * half)
        pairs = bits.bitwiseAND(fields) + F.shiftrightunsigned(bits, 1).bitwiseAND(fields)
        return pairs + bits.bitwiseAND(F.lit(0xFFFF0000))

    def around(half: int):
        v, tag = F.col(f"v{half}"), F.lit(half << 32)
        steps = lambda places: F.array(*(F.lit(1 << k) for k in places))
        up = F.filter(steps(range(0, 16, 2)), lambda s: v.bitwiseAND(s * 2) == 0)
        down = F.filter(steps(range(0, 16, 2)), lambda s: v.bitwiseAND(s * 3) != 0)
        points = F.concat(
            F.array(v),
            F.transform(up, lambda s: v + s),
            F.transform(down, lambda s: v - s),
            F.transform(steps(range(16, 32)), lambda s: v.bitwiseXOR(s)),
        )
        return F.transform(points, lambda p: p + tag)

    placed = prints.withColumns({"v0": counted(0), "v1": counted(1)})
    return placed.select(F.explode(F.concat(around(0), around(1))).alias("cell"), "fp")


def _forest(members: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """Links that join what chains of steps within ``radius`` join, at most one per member."""
    left, right, rest = [], [], members
    while len(rest) > 1:
        wave, rest = [rest[0]], rest[1:]
        while wave and len(rest):
            pivot = wave.pop()
            near = np.bitwise_count(rest ^ pivot) <= radius
            found = rest[near]
            left += [int(pivot)] * len(found)
            right += found.tolist()
            wave += list(found)
            rest = rest[~near]
    return left, right


def links(prints: DataFrame, radius: int = 4, crowd: int = 1024) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints ``fp`` whose components are exact for ``radius``.

    ``radius`` is at most 4, what one step around both halves of the grid covers. ``crowd`` is the
    number of members from which a grid point is split into blocks.
    """
    if not 0 <= radius <= 4:
        raise ValueError("the grid covers distances up to 4")
    cells = _cells(prints)
    met = stored(cells.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1"), "cells")
    blocks = F.ceil(F.col("n") / crowd).cast("long")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    other = F.expr("sequence(0L, blocks - 1)")
    dealt = (
        # Broadcasting ``met`` would pay only while it is small, and it grows with the table.
        cells.join(met.hint("merge"), "cell")
        .withColumn("blocks", blocks)
        .withColumn("own", own)
        .select("cell", "fp", "own", F.explode(other).alias("other"))
        .select("cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
    )

    def runs(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in source:
            keys = np.stack([batch.column(k).to_numpy() for k in range(3)], axis=1)
            prints = batch.column(3).to_numpy().view(np.uint64)
            if held is not None:
                keys, prints = np.concatenate((held[0], keys)), np.concatenate((held[1], prints))
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            if not len(cuts):
                held = keys, prints
                continue
            held = keys[cuts[-1] :], prints[cuts[-1] :]
            yield compared(prints[: cuts[-1]], np.concatenate(([0], cuts)))
        if held is not None:
            yield compared(held[1], np.array([0, len(held[1])]))

    def compared(prints: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
        sizes = np.diff(bounds)
        two = bounds[:-1][sizes == 2]
        close = np.bitwise_count(prints[two] ^ prints[two + 1]) <= radius
        left, right = prints[two][close].tolist(), prints[two + 1][close].tolist()
        for k in np.flatnonzero(sizes > 2):
            a, b = _forest(prints[bounds[k] : bounds[k + 1]], radius)
            left, right = left + a, right + b
        ends = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (left, right)]
        return pa.RecordBatch.from_arrays(ends, names=["a", "b"])

    near = dealt.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")
    return near.mapInArrow(runs, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 4) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` (smallest id reachable over near fingerprints) per row."""
    prints = stored(fingerprints(docs, id_col, text_col), "fingerprints")
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    joined = connected_components(links(first.select("fp"), radius))
    rooted = first.join(joined, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stored(rooted.join(smallest, "root").select(F.col("fp").alias("_fp"), "component_id"), "components")
    return prints.join(named, F.col("fp") == F.col("_fp")).select("doc_id", "fp", "component_id")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 4) -> DataFrame:
    """The rows of ``docs`` with one document of each near-duplicate group: the one with the smallest id.

    Documents without id count as larger than any with one; of rows that repeat an id one stays.
    """
    keyed = docs.select(row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"), F.struct("*").alias("row"))
    found = near_duplicates(keyed, "key", "text", radius)
    chosen = found.where("doc_id = component_id").select(F.col("doc_id").alias("key")).distinct()
    return keyed.select("key", "row").join(chosen, "key", "left_semi").dropDuplicates(["key"]).select("row.*")
