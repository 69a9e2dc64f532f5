"""Removal of repeated passages with a sparse, hash-compared suffix array.

A byte goes if a string of ``WINDOW`` bytes that covers it also starts in a document with a smaller id.
Suffixes are taken at anchors only: of every window, the run of ``ANCHOR`` bytes with the smallest hash.
Equal windows have equal anchors, so suffixes that start at anchors, and the reversed texts
before them, tell all windows apart.

1. Anchors that occur in a single document are left out (they are compared in packed form, by hash).
2. Of anchors with the same surroundings (everything a window around them can hold), all but those
   in the document with the smallest id are covered whole. The first one there stands for all that it holds.
3. What is left per anchor are different surroundings. Their suffixes are sorted, to the right and
   to the left: prefix polynomial hashes and binary search give the common extension of two suffixes
   in logarithmic time, mergesort uses it to compare, and neighbours are verified byte by byte.
   Two surroundings share the window that starts ``a`` bytes before the anchor if they share a
   stretch of the right order with extensions of ``WINDOW - a`` and one of the left order with ``a``.
   Anchors with more than ``CROWD`` different surroundings are not sorted in one task: their windows
   are grouped by a 128-bit hash instead.
4. What is found for the first of the same surroundings in a document holds for all of them there.

Defined cases: null and short texts lose nothing; rows without id count as having a larger id than
all others (equal texts the same one); rows that repeat an id do not count as each other's copy; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from recurra.llm.common import row_key, stored

WINDOW = 50
ANCHOR = 20
SIDE = WINDOW - ANCHOR
CROWD = 65_536
#: Bytes of text hashed at once (a dozen arrays of 8 bytes each), and anchors packed at once.
CHUNK = 1 << 20
PACK_ROWS = 1 << 18
#: Bytes of packed records that a Python task gets at once.
PACK_BYTES = 1 << 22
KNOWN_ROWS = 1 << 15
MEET_ROWS = 1 << 20
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
TOP = np.uint64((1 << 64) - 1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class Prefixes:
    """Prefix polynomial hashes of a buffer, modulo 2 ** 64."""

    def __init__(self, data: np.ndarray) -> None:
        self.data, n = data, len(data)
        self.unscale = _powers(INVERSE, n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(BASE, n), out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.unscale[start]

    def extension(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many bytes (up to ``most``) the suffixes at ``a`` and ``b`` have in common."""
        low, high = np.zeros(len(a), np.int64), most.copy()
        while (low < high).any():
            middle = (low + high + 1) >> 1
            same = self.hash(a, a + middle) == self.hash(b, b + middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low


def _sliding(x: np.ndarray, width: int, combine: np.ufunc) -> np.ndarray:
    done = 1
    while 2 * done <= width:
        x, done = combine(x[:-done], x[done:]), 2 * done
    rest = width - done
    return combine(x[: len(x) - rest], x[rest:]) if rest else x


def anchors(texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """(hash, hash of the surroundings, text number, position) of the anchors, in chunks of whole texts."""
    at = 0
    while at < len(texts):
        upto, size = at, 0
        while upto < len(texts) and (size < CHUNK or upto == at):
            size += len(texts[upto])
            upto += 1
        if size >= WINDOW:
            yield _anchors(texts[at:upto], at)
        at = upto


def _anchors(texts: list[bytes], first: int) -> tuple[np.ndarray, ...]:
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lengths)
    prefixes = Prefixes(np.frombuffer(b"".join(texts), np.uint8))
    n = len(prefixes.data)
    grams = _mixed((prefixes.sums[ANCHOR:] - prefixes.sums[:-ANCHOR]) * prefixes.unscale[: n - ANCHOR + 1])
    # Windows do not reach into the next text: those that would count as having no smallest hash.
    low = _sliding(grams, SIDE + 1, np.minimum)
    for shift in range(1, WINDOW):
        cut = ends - shift
        low[cut[(cut >= 0) & (cut < len(low))]] = 0
    edge = np.zeros(SIDE, np.uint64)
    highest = _sliding(np.concatenate((edge, low, edge)), SIDE + 1, np.maximum)
    position = np.flatnonzero((highest == grams) & (grams > 0))
    text = np.searchsorted(ends, position, "right")
    start = ends[text] - lengths[text]
    around = prefixes.hash(np.maximum(position - SIDE, start), np.minimum(position + WINDOW, ends[text]))
    shape = np.minimum(position - start, SIDE) * WINDOW + np.minimum(ends[text] - position, WINDOW)
    return grams[position], _mixed(around + _mixed(shape.astype(np.uint64))), text + first, position - start


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


#: Rows of the one shuffle of anchors: hashes known to be shared, whole records of such, records to be decided.
NOTICE, KNOWN, OPEN = 0, 1, 2


def _cut_by_bucket(rows: np.ndarray, h: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
    """The rows of every bucket that has any, packed."""
    bucket = (h % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    rows, bucket = rows[order], bucket[order]
    for a, b in pairwise([0, *(np.flatnonzero(np.diff(bucket)) + 1), len(bucket)] if len(bucket) else []):
        yield int(bucket[a]), rows[a:b].tobytes()


def _groups(records: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of records in order of ``h``: the hashes, which of them two ids have, and the same for every record."""
    h, doc = records[:, 0], records[:, 2].view(np.int64)
    starts = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
    many = np.minimum.reduceat(doc, starts) != np.maximum.reduceat(doc, starts)
    return h[starts], many, np.repeat(many, np.diff(np.append(starts, len(h))))


class Meeting:
    """Records of one bucket that arrive bit by bit; those whose anchor two ids have leave it at once."""

    def __init__(self) -> None:
        self.shared, self.held = np.empty(0, np.uint64), np.empty((0, 4), np.uint64)

    def notice(self, h: np.ndarray) -> None:
        self.shared = np.union1d(self.shared, h)

    def add(self, records: np.ndarray) -> np.ndarray:
        both = np.concatenate((self.held, records))
        both = both[np.argsort(both[:, 0], kind="stable")]
        h, many, leaving = _groups(both)
        told = np.isin(h, self.shared)
        self.shared = np.union1d(self.shared, h[many & ~told])
        leaving |= np.isin(both[:, 0], h[told])
        self.held = both[~leaving]
        return both[leaving]


def _hits(docs: DataFrame) -> DataFrame:
    """``h``, ``c`` (surroundings), ``doc`` and ``at`` (position and check sum of the text) of all anchors that
    more than one id has.

    Records travel packed, by buckets of the anchors' hashes. Those that two ids of one pack have need no
    meeting: they are spread evenly, and only their hashes go to the bucket, so a passage of very many
    documents does not gather there.
    """
    buckets = max(1, 8 * docs.rdd.getNumPartitions())

    def rows_of(records: np.ndarray) -> pa.RecordBatch:
        records = records[np.argsort(records[:, 0], kind="stable")]
        found, many, known = _groups(records)
        rows = [(b, NOTICE, part) for b, part in _cut_by_bucket(found[many], found[many], buckets)]
        rows += [(b, OPEN, part) for b, part in _cut_by_bucket(records[~known], records[~known][:, 0], buckets)]
        decided = records[known]
        for a in range(0, len(decided), KNOWN_ROWS):
            part = decided[a : a + KNOWN_ROWS].tobytes()
            # Not by their hashes: the same ones are shared in pack after pack.
            rows.append((zlib.crc32(part) % buckets, KNOWN, part))
        columns = zip(*rows, strict=True)
        types = (pa.int64(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types, strict=True)], names=["bucket", "kind", "part"])

    def pack(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in source:
            doc, crc = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for h, c, text, position in anchors([x or b"" for x in batch.column(2).to_pylist()]):
                at = (position << 32) | crc[text]
                waiting.append(np.stack((h, c, doc[text].view(np.uint64), at.view(np.uint64)), axis=1))
                size += len(h)
                if size >= PACK_ROWS:
                    yield rows_of(np.concatenate(waiting))
                    waiting, size = [], 0
        if size:
            yield rows_of(np.concatenate(waiting))

    def out(records: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([_signed(records[:, k]) for k in range(4)], names=["h", "c", "doc", "at"])

    def meet(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, meeting, waiting, size = None, Meeting(), [], 0
        for batch in source:
            for bucket, kind, part in zip(*(batch.column(k) for k in range(3)), strict=True):
                data = np.frombuffer(part.as_buffer(), np.uint64)
                if bucket != now or size >= MEET_ROWS:
                    if waiting:
                        yield out(meeting.add(np.concatenate(waiting)))
                    waiting, size = [], 0
                    if bucket != now:
                        now, meeting = bucket, Meeting()
                if kind.as_py() == NOTICE:
                    meeting.notice(data)
                elif kind.as_py() == KNOWN:
                    yield out(data.reshape(-1, 4))
                else:
                    # A copy, since the batch goes before the bucket ends.
                    waiting.append(data.reshape(-1, 4).copy())
                    size += len(waiting[-1])
        if waiting:
            yield out(meeting.add(np.concatenate(waiting)))

    packed = docs.mapInArrow(pack, "bucket long, kind int, part binary")
    met = packed.repartition("bucket").sortWithinPartitions("bucket", "kind").mapInArrow(meet, "h long, c long, doc long, at long")
    return stored(met, "hits", PACK_BYTES)


class Suffixes:
    """Suffixes of a buffer, sorted by mergesort with hash-compared extensions within equal ``group``."""

    def __init__(self, texts: list[bytes], starts: np.ndarray, group: np.ndarray) -> None:
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        offset = np.concatenate(([0], np.cumsum(lengths)))[:-1]
        self.prefixes = Prefixes(np.frombuffer(b"".join(texts), np.uint8))
        self.start, self.size, self.group = offset + starts, lengths - starts, group
        self.order = self._sorted()

    def _less(self, i: np.ndarray, j: np.ndarray, equal: bool) -> np.ndarray:
        """Whether suffix ``i`` comes before suffix ``j``, or before or beside it with ``equal``."""
        out = self.group[i] < self.group[j]
        k = np.flatnonzero(self.group[i] == self.group[j])
        if len(k):
            i, j = i[k], j[k]
            a, b, m, n = self.start[i], self.start[j], self.size[i], self.size[j]
            most = np.minimum(m, n)
            common = self.prefixes.extension(a, b, most)
            inside = common < most
            data, last = self.prefixes.data, len(self.prefixes.data) - 1
            x, y = data[np.minimum(a + common, last)], data[np.minimum(b + common, last)]
            out[k] = np.where(inside, x < y, (m <= n) if equal else (m < n))
        return out

    def _sorted(self) -> np.ndarray:
        n = len(self.start)
        order, place, width = np.argsort(self.group, kind="stable"), np.arange(n), 1
        while width < n:
            run = place // width
            left = run % 2 == 0
            first = np.minimum(np.where(left, (run + 1) * width, (run - 1) * width), n)
            low, high = first.copy(), np.minimum(first + width, n)
            while (open_ := low < high).any():
                k = np.flatnonzero(open_)
                middle = (low[k] + high[k]) >> 1
                mine, other = order[k], order[middle]
                # Of equal suffixes those of the left run come first.
                before = np.where(left[k], self._less(other, mine, False), self._less(other, mine, True))
                low[k], high[k] = np.where(before, middle + 1, low[k]), np.where(before, high[k], middle)
            to = (run - run % 2) * width + place % width + (low - first)
            merged = np.empty_like(order)
            merged[to] = order
            order, width = merged, 2 * width
        return order

    def common(self) -> np.ndarray:
        """Bytes that each suffix of the order has in common with the one before, verified."""
        i, j = self.order[:-1], self.order[1:]
        out = np.zeros(len(self.order), np.int64)
        k = np.flatnonzero(self.group[i] == self.group[j])
        a, b = self.start[i[k]], self.start[j[k]]
        found = self.prefixes.extension(a, b, np.minimum(self.size[i[k]], self.size[j[k]]))
        last = len(self.prefixes.data) - 1
        for step in range(int(found.max(initial=0))):
            same = self.prefixes.data[np.minimum(a + step, last)] == self.prefixes.data[np.minimum(b + step, last)]
            found = np.where((step < found) & ~same, step, found)
        out[k + 1] = found
        return out

    def stretches(self, common: np.ndarray, least: int) -> np.ndarray:
        """For every suffix, the number of its stretch of the order with extensions of ``least`` bytes."""
        number = np.cumsum((common < least) | np.concatenate(([True], self.group[self.order[1:]] != self.group[self.order[:-1]])))
        out = np.empty_like(number)
        out[self.order] = number
        return out


def covered(group: np.ndarray, doc: np.ndarray, around: list[bytes], anchor: np.ndarray) -> np.ndarray:
    """For each surrounding, which windows (by bytes before the anchor) a smaller id of its group has."""
    right = Suffixes(around, anchor, group)
    sizes = np.fromiter(map(len, around), np.int64, len(around))
    left = Suffixes([x[::-1] for x in around], sizes - anchor, group)
    right_common, left_common = right.common(), left.common()
    out = np.zeros((len(around), SIDE + 1), bool)
    for a in range(SIDE + 1):
        whole = (anchor >= a) & (sizes - anchor >= WINDOW - a)
        keys = right.stretches(right_common, WINDOW - a), left.stretches(left_common, a) if a else group
        order = np.lexsort((doc, *keys))
        new = np.concatenate(([True], (keys[0][order][1:] != keys[0][order][:-1]) | (keys[1][order][1:] != keys[1][order][:-1])))
        starts = np.flatnonzero(new)
        least = np.repeat(doc[order][starts], np.diff(np.append(starts, len(order))))
        out[order, a] = doc[order] > least
        out[:, a] &= whole
    return out


def _spans(doc: np.ndarray, at: np.ndarray, hit: np.ndarray) -> pa.RecordBatch:
    """Rows (doc, at, start, end) of the stretches of covered windows around anchors."""
    before = np.pad(hit, ((0, 0), (1, 1)))
    row, first = np.nonzero(before[:, 1:-1] & ~before[:, :-2])
    row2, last = np.nonzero(before[:, 1:-1] & ~before[:, 2:])
    position = (at >> 32)[row]
    # Windows that start ``last`` to ``first`` bytes before the anchor.
    columns = [doc[row], at[row], position - last, position - first + WINDOW]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["doc", "at", "start", "end"])


SPANS = "doc long, at long, start long, end long"


def _surroundings(hits: DataFrame) -> DataFrame:
    """``h``, ``c``, the smallest ``doc`` with its first ``at``, its ``last`` one if that is another, and
    whether the surroundings are ``copied`` in larger ids."""
    last = F.min(F.struct(F.col("doc"), (-F.col("at")).alias("back")))
    found = hits.groupBy("h", "c").agg(F.min(F.struct("doc", "at")).alias("o"), last.alias("l"), F.max("doc").alias("most"))
    other = F.when(F.col("l.back") != -F.col("o.at"), -F.col("l.back"))
    return stored(found.select("h", "c", "o.doc", "o.at", other.alias("last"), (F.col("o.doc") < F.col("most")).alias("copied")), "surroundings")


def _different(docs: DataFrame, first: DataFrame) -> DataFrame:
    """Spans from comparing the different surroundings of an anchor, each from its smallest id."""
    many = stored(first.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"), "anchors")
    wanted = first.join(many, "h").select("h", "n", "doc", "at")
    asked = wanted.groupBy("doc", F.col("at").bitwiseAND(F.lit(0xFFFFFFFF)).alias("crc")).agg(F.collect_list(F.struct("h", "n", "at")).alias("asked"))

    def cut(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            doc, text, asked = (batch.column(k) for k in range(3))
            parts = asked.flatten()
            h, n, at = (parts.field(k).to_numpy() for k in range(3))
            owner = np.repeat(np.arange(len(doc)), np.diff(asked.offsets.to_numpy()))
            position, texts = at >> 32, text.to_pylist()
            low = np.maximum(position - SIDE, 0)
            around = [texts[o][a : p + WINDOW] for o, a, p in zip(owner.tolist(), low.tolist(), position.tolist(), strict=True)]
            columns = [pa.array(h), pa.array(n), pa.array(doc.to_numpy()[owner]), pa.array(at), pa.array(around, pa.binary()), pa.array(position - low)]
            yield pa.RecordBatch.from_arrays(columns, names=["h", "n", "doc", "at", "around", "anchor"])

    joined = docs.join(asked, ["doc", "crc"]).select("doc", "text", "asked")
    around = stored(joined.mapInArrow(cut, "h long, n long, doc long, at long, around binary, anchor long"), "around")

    def sort(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in source:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if held.num_rows > 20_000:
                h = held.column("h").to_numpy()
                whole = int(np.searchsorted(h, h[-1]))  # groups may go on in the next batch
                if whole:
                    yield spans(held.slice(0, whole))
                    held = held.slice(whole)
        if held is not None and held.num_rows:
            yield spans(held)

    def spans(rows: pa.Table) -> pa.RecordBatch:
        h, doc, at, anchor = (rows.column(c).to_numpy() for c in ("h", "doc", "at", "anchor"))
        return _spans(doc, at, covered(h, doc, rows.column("around").to_pylist(), anchor))

    few = around.where(F.col("n") <= CROWD).select("h", "doc", "at", "around", "anchor")
    sorted_spans = few.repartition("h").sortWithinPartitions("h").mapInArrow(sort, SPANS)

    def windows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            doc, at = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            texts, anchor = batch.column(2).to_pylist(), batch.column(3).to_numpy()
            row, before, keys = [], [], []
            for k, (text, a) in enumerate(zip(texts, anchor.tolist(), strict=True)):
                for start in range(max(0, a - SIDE), min(a, len(text) - WINDOW) + 1):
                    row.append(k)
                    before.append(a - start)
                    keys.append(hashlib.blake2b(text[start : start + WINDOW], digest_size=16).digest())
            columns = [pa.array(keys, pa.binary()), pa.array(doc[row]), pa.array(at[row]), pa.array(before, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["window", "doc", "at", "before"])

    crowd = around.where(F.col("n") > CROWD).select("doc", "at", "around", "anchor")
    each = stored(crowd.mapInArrow(windows, "window binary, doc long, at long, before long"), "windows")
    least = stored(each.groupBy("window").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most"), "least")
    begin = F.shiftright("at", 32) - F.col("before")
    crowded = each.join(least.select("window", "least"), "window").where("doc > least")
    return sorted_spans.union(crowded.select("doc", "at", begin.alias("start"), (begin + WINDOW).alias("end")))


def removed_spans(docs: DataFrame) -> DataFrame:
    """Spans of covered bytes of ``docs`` (``doc``, ``crc``, ``text`` as bytes); they may overlap."""
    hits = _hits(docs)
    first, crc, position = _surroundings(hits), F.col("at").bitwiseAND(F.lit(0xFFFFFFFF)).alias("crc"), F.shiftright("at", 32)
    copied = first.where("copied").select("h", "c", F.col("doc").alias("least"))
    again = hits.join(copied, ["h", "c"]).where("doc > least")
    whole = again.select("doc", crc, F.greatest(position - SIDE, F.lit(0)).alias("start"), (position + WINDOW).alias("end"))
    different = stored(_different(docs, first), "different")
    inner = first.where("last IS NOT NULL").select("h", "c", "doc", F.col("at").alias("first"))
    others = stored(hits.join(inner, ["h", "c", "doc"]).where("at <> first").select("doc", "first", "at").distinct(), "others")
    shift = position - F.shiftright("first", 32)
    found = different.withColumnRenamed("at", "first").join(others, ["doc", "first"])
    repeated = found.select("doc", crc, (F.col("start") + shift).alias("start"), (F.col("end") + shift).alias("end"))
    return whole.union(different.select("doc", crc, "start", "end")).union(repeated)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes``, ``removed`` (maximal runs as start and end) and ``kept`` (bytes left) per row."""
    data = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    keyed = docs.select(row_key(id_col, text_col).alias("doc"), F.crc32(data).alias("crc"), data.alias("text"))
    spans = removed_spans(keyed)
    packed = F.shiftleft(F.col("start"), 32).bitwiseOR(F.col("end"))
    found = stored(spans.groupBy("doc", "crc").agg(F.collect_list(packed).alias("spans")), "spans")
    whole = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), row_key(id_col, text_col).alias("doc"), F.crc32(data).alias("crc"), data.alias("text")
    )
    joined = whole.join(found, ["doc", "crc"], "left").select("doc_id", "text", "spans")

    def remove(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            removed, kept, sizes = [], [], []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                runs, rest, at = [], [], 0
                if spans.is_valid:
                    for x in np.sort(spans.values.to_numpy()).tolist():
                        start, end = x >> 32, min(x & 0xFFFFFFFF, len(text))
                        if runs and start <= runs[-1]["end"]:
                            runs[-1]["end"] = max(runs[-1]["end"], end)
                        else:
                            runs.append({"start": start, "end": end})
                for r in runs:
                    rest.append(text[at : r["start"]])
                    at = r["end"]
                removed.append(runs)
                kept.append(b"".join([*rest, text[at:]]))
                sizes.append(len(text))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, kind), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "removed", "kept"])

    return joined.mapInArrow(remove, "doc_id long, n_bytes long, removed array<struct<start:long,end:long>>, kept binary")
