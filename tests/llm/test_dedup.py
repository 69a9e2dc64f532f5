"""Suffix dedup and SimHash near-duplicates against brute force."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from recurra.llm import simhash_dedup, suffix_dedup
from recurra.llm.common import BATCH_BYTES, stored
from recurra.llm.components import connected_components


def removed_by_brute_force(rows, window=50):
    out = {}
    for i, text in rows:
        data = (text or "").encode()
        mark = bytearray(len(data))
        for k in range(len(data) - window + 1):
            if any(j < i and data[k : k + window] in (other or "").encode() for j, other in rows):
                mark[k : k + window] = b"\1" * window
        out[i] = bytes(c for c, m in zip(data, mark, strict=True) if not m)
    return out


def passages(prose):
    """Copies, shared passages at all places, runs of one character, short and empty texts, texts in two-byte letters."""
    shared, line = prose(1, 30), "a line of fifty-four bytes that many documents begin."
    rows = [(k, f"{prose(100 + k, 5 + 7 * k)} {shared[k : 60 + 5 * k]} {prose(200 + k, 9)}") for k in range(12)]
    rows += [(20, shared), (21, shared), (22, None), (23, ""), (24, "short"), (25, "x" * 300), (26, "y" + "x" * 120), (27, "x" * 49)]
    rows += [(30 + k, f"{line}{prose(300 + k, 12)}") for k in range(8)] + [(40, "éü" * 60), (41, "zéü" + "éü" * 40)]
    return rows


@pytest.mark.parametrize("crowd", [65_536, 3])
def test_suffix_dedup_against_brute_force(spark, table, prose, monkeypatch, crowd):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    rows = passages(prose)
    expected = removed_by_brute_force(rows)
    got = suffix_dedup.without_repeats(table(rows).repartition(3)).collect()
    assert {r.doc_id: bytes(r.kept) for r in got} == expected
    for r in got:
        ends = [(s.start, s.end) for s in r.removed]
        assert all(a < b for a, b in ends) and all(b < c for (_, b), (c, _) in zip(ends, ends[1:], strict=False))
        assert r.n_bytes == len(r.kept) + sum(b - a for a, b in ends)


@pytest.mark.parametrize("crowd", [65_536, 3])
def test_suffix_dedup_of_repeats_within_the_smallest_document(spark, table, prose, monkeypatch, crowd):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    rows = []
    for k, size in enumerate((55, 60, 65, 70, 78, 90, 140)):
        line = prose(700 + k, 40)[:size]
        rows += [(10 * k, f"{prose(800 + k, 12)} {line} {prose(850 + k, 12)}")]
        # Larger ids repeat it in the same context; the first of these holds that context first.
        rows += [(10 * k + d, f"{prose(900 + 10 * k + d, 15)} " + "".join(f"\n| {line} |\n" for _ in range(8))) for d in (1, 2)]
    got = suffix_dedup.without_repeats(table(rows).repartition(3)).collect()
    assert {r.doc_id: bytes(r.kept) for r in got} == removed_by_brute_force(rows)


def test_suffix_dedup_of_rows_that_share_an_id(spark, table, prose):
    line = prose(31, 30)[:60]
    rows = [(1, f"{prose(32, 20)} {line} {prose(33, 20)}"), *((2, f"{prose(40 + k, 20)} {prose(34, 20)} {line} {prose(35, 20)}") for k in range(5))]
    got = suffix_dedup.without_repeats(table(rows)).where("doc_id = 2").collect()
    assert len(got) == 5 and not any(line.encode() in bytes(r.kept) for r in got)


def test_suffix_dedup_of_repeated_ids_and_nothing(spark, table, prose):
    text = prose(5, 40)
    got = suffix_dedup.without_repeats(table([(1, text), (1, text), (None, text), (None, text)])).collect()
    assert sorted((r.doc_id or 99, len(r.kept)) for r in got) == [(1, len(text)), (1, len(text)), (99, 0), (99, 0)]
    assert suffix_dedup.without_repeats(table([])).count() == 0


def test_suffix_dedup_packs_across_chunks(spark, table, prose, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 700)
    expected = removed_by_brute_force(rows := passages(prose))
    for pack_rows, known_rows in ((40, 3), (1 << 18, 1 << 15)):
        monkeypatch.setattr(suffix_dedup, "PACK_ROWS", pack_rows)
        monkeypatch.setattr(suffix_dedup, "KNOWN_ROWS", known_rows)
        got = suffix_dedup.without_repeats(table(rows).repartition(2)).collect()
        assert {r.doc_id: bytes(r.kept) for r in got} == expected


def test_anchors_of_many_texts_take_bounded_memory(prose):
    texts = [prose(k, 600).encode() for k in range(2000)]
    tracemalloc.start()
    found = sum(len(h) for h, *_ in suffix_dedup.anchors(texts))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found > sum(map(len, texts)) // 20 and most < 100e6


def test_batches_of_packed_rows_are_bounded_by_bytes(spark):
    def sizes(source):
        for batch in source:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "bytes"])

    packed = spark.range(0, 1000, 1, 1).select("id", F.repeat(F.lit("x"), 35_000).cast("binary").alias("part"))
    before = spark.conf.get(BATCH_BYTES, None)
    got = stored(packed.mapInArrow(sizes, "n long, bytes long"), "sizes", suffix_dedup.PACK_BYTES).collect()
    assert sum(r.n for r in got) == 1000 and max(r.bytes for r in got) < 2 * suffix_dedup.PACK_BYTES
    assert spark.conf.get(BATCH_BYTES, None) == before


def test_suffixes_are_sorted_and_extensions_exact():
    draw = random.Random(3)
    texts = [bytes(draw.choice(b"ab") for _ in range(draw.randint(1, 60))) for _ in range(200)] + [b"aaaa"] * 5
    group = np.array([draw.randrange(3) for _ in texts])
    found = suffix_dedup.Suffixes(texts, np.zeros(len(texts), np.int64), group)
    keys = [(int(group[k]), texts[k]) for k in found.order]
    assert keys == sorted(keys)
    for k, common in enumerate(found.common()[1:], 1):
        (g, x), (h, y) = keys[k - 1], keys[k]
        expected = next((i for i, (a, b) in enumerate(zip(x, y, strict=False)) if a != b), min(len(x), len(y)))
        assert common == (expected if g == h else 0)


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_brute_force(prints, radius=4):
    root = {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in prints:
        for b in prints:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: find(i) for i in prints}


def test_near_duplicates_against_brute_force(spark, table, prose):
    rows = []
    for k in range(12):
        words = prose(k, 200).split()
        for copy in range(6):
            words[copy * 7] = f"new{copy}"
            rows.append((10 * k + copy, " ".join(words)))
    rows += [(200, None), (201, ""), (202, " \t\n"), (203, "One two"), (204, "one\x0btwo"), (205, "ONE TWO three"), (206, "İ two")]
    prints = {i: plain_fingerprint(t) for i, t in rows}
    assert prints[200] == prints[202] == 0 and prints[203] == prints[204]
    expected = components_by_brute_force(prints)
    got = simhash_dedup.near_duplicates(table(rows)).collect()
    assert {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in got} == {i: (prints[i], expected[i]) for i in prints}


@pytest.mark.parametrize("crowd", [1024, 4])
def test_links_join_what_chains_of_small_steps_join(spark, crowd):
    draw = random.Random(9)
    prints = {draw.getrandbits(64) for _ in range(40)}
    for x in list(prints)[:10]:
        for _ in range(30):
            for _ in range(draw.randint(1, 4)):
                x ^= 1 << draw.randrange(64)
            prints.add(x)
    signed = {x - (1 << 64) if x >> 63 else x: x for x in prints}
    links = simhash_dedup.links(spark.createDataFrame([(x,) for x in signed], "fp long"), crowd=crowd)
    roots = {r.node: r.root for r in connected_components(links).collect()}
    groups, expected = {}, {}
    for x, y in components_by_brute_force({s: signed[s] for s in signed}).items():
        expected.setdefault(y, set()).add(x)
    for x in signed:
        groups.setdefault(roots.get(x, x), set()).add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_long_chains_and_stars(spark):
    chain = [(k, k + 1) for k in range(60)] + [(1000, 1000 + k) for k in range(1, 80)] + [(5, 5)]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {**{k: 0 for k in range(1, 61)}, **{1000 + k: 1000 for k in range(1, 80)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_of_each_group_stays(spark, table, prose):
    text = prose(1, 80)
    rows = [(3, text), (3, text), (2, text), (None, text), (7, prose(2, 90)), (None, prose(3, 70)), (None, prose(3, 70)), (8, None)]
    docs = table(rows)
    kept = simhash_dedup.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted([(2, text), (7, prose(2, 90)), (0, prose(3, 70)), (8, "")])
    assert simhash_dedup.representatives(table([])).count() == 0


@pytest.mark.parametrize("step", [1, 7, 500])
def test_records_leave_a_meeting_as_soon_as_two_ids_have_them(step):
    draw = random.Random(step)
    rows = np.array([(draw.randrange(90), k, draw.choice([1, 1, 2, draw.randrange(40)]), k) for k in range(300)], np.uint64)
    meeting, left = suffix_dedup.Meeting(), []
    meeting.notice(np.array([3, 1000], np.uint64))
    for a in range(0, len(rows), step):
        left += meeting.add(rows[a : a + step]).tolist()
    ids = {}
    for h, _, doc, _ in rows.tolist():
        ids.setdefault(h, set()).add(doc)
    assert sorted(left) == sorted(r for r in rows.tolist() if r[0] == 3 or len(ids[r[0]]) > 1)
    assert sorted(meeting.held.tolist()) == sorted(r for r in rows.tolist() if r[0] != 3 and len(ids[r[0]]) == 1)
