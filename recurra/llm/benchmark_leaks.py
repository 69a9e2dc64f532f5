"""Benchmark items that occur in documents, exactly or nearly.

Every window of a document as long as an item is compared with it: the SimHash of the window's
five-word shingles is looked up in a multi-index over the items' fingerprints (eight blocks of eight
bits; two fingerprints within ``RADIUS`` agree up to ``RADIUS // 8`` bits in one block), all within
the radius are compared exactly, by the weighted Jaccard similarity of shingles with their counts. At
the similarity asked for, fingerprints differ in 10 of 64 bits on average; the radius is five standard
deviations above that.

A window that shares no shingle with any item has similarity zero, so windows are fingerprinted only
where one shingle is shared; nothing is lost by that.

Items go through the documents in blocks of a bounded number of words, so what every task holds does
not grow with the benchmark. Documents are never shuffled.

Words are runs of letters, digits and underscores, without regard to case. Defined cases: a null or
empty text or item matches nothing; items of fewer than five words have their whole word sequence as
one shingle; repeated rows are searched one by one; extra columns are ignored.
"""

from __future__ import annotations

import functools
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 25
BLOCK_WORDS = 1_000_000
WORD = re.compile(r"\w+")
MIX = np.uint64(0x9E3779B97F4A7C15)


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def _bits(shingle: str) -> np.ndarray:
    """64 votes of plus or minus one from the hash of a shingle."""
    digest = np.frombuffer(xxhash.xxh64_digest(shingle.encode("utf-8", "surrogatepass")), np.uint8)
    return np.unpackbits(digest).astype(np.int32) * 2 - 1


def _shingles(tokens: list[str]) -> list[str]:
    size = min(SHINGLE, len(tokens))
    return [" ".join(tokens[i : i + size]) for i in range(len(tokens) - size + 1)] if tokens else []


def _packed(votes: np.ndarray) -> np.ndarray:
    return np.packbits(votes > 0, axis=1)


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity of two bags."""
    both = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return both / max(1, sum(a.values()) + sum(b.values()) - both)


class Items:
    """A block of items: vocabulary, shared-shingle lookup and the multi-index by item length."""

    def __init__(self, rows: list[tuple[int, str]]) -> None:
        self.ids, self.bags, self.vocabulary = [], [], {}
        lengths, votes, hashes, owners = [], [], [], []
        for item, text in rows:
            tokens = words(text)
            if not tokens:
                continue
            shingles = _shingles(tokens)
            number = len(self.ids)
            codes = np.array([self.vocabulary.setdefault(t, len(self.vocabulary)) for t in tokens], np.int64)
            own = self.rolled(codes, min(SHINGLE, len(tokens)))
            hashes.append(own)
            owners.append(np.full(len(own), number))
            self.ids.append(item)
            self.bags.append(Counter(shingles))
            lengths.append(len(tokens))
            votes.append(np.sum([_bits(s) for s in shingles], axis=0))
        self.lengths = np.array(lengths, np.int64)
        found = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(found, kind="stable")
        self.hashes, self.owners = found[order], (np.concatenate(owners)[order] if hashes else found)
        self.short = sorted({n for n in lengths if n < SHINGLE})
        prints = _packed(np.array(votes)) if votes else np.zeros((0, 8), np.uint8)
        self.by_length = {}
        every = np.arange(256, dtype=np.uint8)
        for n in set(lengths):
            members = np.flatnonzero(self.lengths == n)
            # near[b][x]: the items whose block b is within RADIUS // 8 bits of x.
            near = [np.bitwise_count(every[:, None] ^ prints[members, b][None]) <= RADIUS // 8 for b in range(8)]
            self.by_length[n] = members, prints[members], near

    @staticmethod
    def rolled(codes: np.ndarray, size: int) -> np.ndarray:
        """A hash of every run of ``size`` words; runs with an unknown word get zero."""
        if len(codes) < size:
            return np.zeros(0, np.uint64)
        value, known = np.zeros(len(codes) - size + 1, np.uint64), np.ones(len(codes) - size + 1, bool)
        for k in range(size):
            part = codes[k : len(codes) - size + 1 + k]
            value = (value ^ (part.astype(np.uint64) + np.uint64(1))) * MIX
            value ^= value >> np.uint64(29)
            known &= part >= 0
        return np.where(known, value, np.uint64(0))

    def shared(self, codes: np.ndarray) -> list[tuple[int, int, int]]:
        """(position, run length, item length) of the runs that an item of that length has too."""
        out = set()
        for size in (*self.short, SHINGLE):
            hashes = self.rolled(codes, size)
            at = np.flatnonzero(hashes)
            if not len(at) or not len(self.hashes):
                continue
            first = np.searchsorted(self.hashes, hashes[at], "left")
            last = np.searchsorted(self.hashes, hashes[at], "right")
            for p, a, b in zip(at[last > first].tolist(), first[last > first].tolist(), last[last > first].tolist(), strict=True):
                out.update((p, size, int(n)) for n in self.lengths[self.owners[a:b]] if min(n, SHINGLE) == size)
        return sorted(out)

    def search(self, text: str) -> list[tuple[int, float, int, int]]:
        """(item, similarity, first word, words) of the best window for every item found."""
        tokens = words(text)
        codes = np.fromiter((self.vocabulary.get(t, -1) for t in tokens), np.int64, len(tokens))
        hits = self.shared(codes)
        if not hits:
            return []
        votes = functools.lru_cache(maxsize=1 << 14)(_bits)
        best: dict[int, tuple] = {}
        by_length = defaultdict(set)
        for p, size, n in hits:
            by_length[n].update(range(max(0, p + size - n), min(p, max(0, len(tokens) - n)) + 1))
        for n, starts in by_length.items():
            size, members = min(n, SHINGLE), self.by_length[n]
            order = np.array(sorted(starts))
            # Neighbouring windows are fingerprinted together, from running sums of votes.
            for run in np.split(order, np.flatnonzero(np.diff(order) > n) + 1):
                low, high = int(run[0]), min(len(tokens), int(run[-1]) + n)
                shingles = [" ".join(tokens[i : i + size]) for i in range(low, max(low + 1, high - size + 1))]
                sums = np.zeros((len(shingles) + 1, 64), np.int32)
                np.cumsum([votes(s) for s in shingles], axis=0, out=sums[1:])
                ends = np.minimum(run - low + n - size + 1, len(shingles))
                prints = _packed(sums[ends] - sums[run - low])
                near = members[2][0][prints[:, 0]].copy()
                for b in range(1, 8):
                    near |= members[2][b][prints[:, b]]
                at, item = np.nonzero(near)
                apart = np.bitwise_count(prints[at] ^ members[1][item]).sum(axis=1)
                for k in np.flatnonzero(apart <= RADIUS):
                    start, number = int(run[at[k]]), int(members[0][item[k]])
                    window = Counter(shingles[start - low : int(ends[at[k]])])
                    found = similarity(window, self.bags[number])
                    if found >= SIMILARITY and (found, -start) > best.get(number, (0.0, 0))[:2]:
                        best[number] = found, -start, min(n, len(tokens) - start)
        return sorted((self.ids[i], s, -start, n) for i, (s, start, n) in best.items())


def _blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[Items]:
    """The items, a bounded number of words at a time."""
    rows = items.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"))
    total = rows.agg(F.sum(F.size(F.split("t", r"\W+")))).first()[0] or 0
    blocks = -(-total // BLOCK_WORDS)
    for k in range(blocks):
        block = rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k)
        yield Items(sorted((tuple(r) for r in block.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1])))


def leaks(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """A row per document and item found: ids, ``similarity`` and the best window in words and code points."""
    out = None
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, item_id long, similarity double, first_word long, n_words long, start long, end long"
    for block in _blocks(items, item_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def search(source: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in source:
                found = []
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    for item, score, first, n in shared.value.search(text or ""):
                        # Offsets are of the lower-cased text, whose length may differ for a few letters.
                        spans = [m.span() for m in WORD.finditer(text.lower())]
                        found.append((doc, item, score, first, n, spans[first][0], spans[first + n - 1][1]))
                kinds = [pa.int64(), pa.int64(), pa.float64(), *[pa.int64()] * 4]
                columns = [pa.array([r[k] for r in found], kind) for k, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in schema.split(", ")])

        part = rows.mapInArrow(search, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def without_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no item is found; judged in place, without a shuffle."""
    at = docs.columns.index(text_col)
    for block in _blocks(items, item_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def clean(source: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in source:
                yield batch.filter(pa.array([not shared.value.search(t or "") for t in batch.column(at).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
