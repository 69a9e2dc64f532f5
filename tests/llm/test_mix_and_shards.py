"""Pfair mixing and ring sharding."""

from __future__ import annotations

import zlib
from collections import Counter
from fractions import Fraction

import pytest

import corpus_pipeline
from recurra.llm import pfair_mix, ring_shards

SHARES = [{"a": 1, "b": 1}, {"a": 7, "b": 2, "c": 1}, {"a": 100, "b": 1, "c": 33, "d": 17}, {"a": 5}, dict.fromkeys("abcdefg", 3)]


@pytest.mark.parametrize("shares", SHARES)
def test_every_block_is_in_its_window_and_no_source_is_a_block_off(shares):
    made, length = pfair_mix.pattern(shares), sum(shares.values())
    assert sorted(slot for _, _, slot, _, _ in made) == list(range(length))
    assert all(release <= slot < deadline for _, _, slot, release, deadline in made)
    done = Counter()
    for source, number, slot, _, _ in made:
        assert number == done[source]
        done[source] += 1
        assert all(abs(done[s] - Fraction(p * (slot + 1), length)) < 1 for s, p in shares.items())


def test_weights_become_whole_blocks():
    assert pfair_mix.allotments({"a": 0.5, "b": 0.3, "c": 0.2}, 10) == {"a": 5, "b": 3, "c": 2}
    tiny = pfair_mix.allotments({"a": 1e9, "b": 1, "c": 1}, 16)
    assert tiny == {"a": 14, "b": 1, "c": 1}
    assert sum(pfair_mix.allotments({k: k + 1 / 3 for k in range(1, 40)}, 160).values()) == 160


def test_phases_use_every_block_once():
    blocks = {"a": 5000, "b": 77, "c": 1, "d": 0, "e": 2048}
    plan = pfair_mix.phases(blocks, dict.fromkeys(blocks, 1.0))
    used = Counter()
    for _, source, share, first, frames, _, _ in plan:
        assert first == used[source]
        used[source] += share * frames
    assert used == {s: n for s, n in blocks.items() if n}
    spans = sorted({(slot, slot + frames * length) for _, _, _, _, frames, slot, length in plan})
    assert spans[0][0] == 0 and spans[-1][1] == sum(blocks.values()) and all(b == c for (_, b), (c, _) in zip(spans, spans[1:], strict=False))


def test_mix_places_all_rows_and_keeps_to_the_weights(spark, table):
    rows = [(k, f"t{k}", "en", ("big", "mid", None)[min(2, k % 7 // 3)]) for k in range(900)] + [(None, "x", "en", "mid")] * 2
    docs = table(rows)
    got = pfair_mix.mix(docs, {"big": 3, "mid": 2, None: 1}, block=4).collect()
    assert Counter((r.doc_id, r.source) for r in got) == Counter((r[0], r[3]) for r in rows)
    assert len({(r.slot, r.place) for r in got}) == len(got) and all(r.release <= r.slot < r.deadline for r in got)
    slots = {r.slot: r.source for r in got}
    assert sorted(slots) == list(range(len(slots)))
    # Up to where the first source ends, all are within a block of 3 : 2 : 1 (weights are multiples of 1 / 1024).
    last = min(max(s for s, x in slots.items() if x == source) for source in ("big", "mid", None))
    done = Counter()
    for slot in range(last):
        done[slots[slot]] += 1
        for source, part in (("big", 1 / 2), ("mid", 1 / 3), (None, 1 / 6)):
            assert abs(done[source] - part * (slot + 1)) < 1.25
    ordered = pfair_mix.in_order(docs, weights={"big": 3, "mid": 2, None: 1}, block=4)
    assert ordered.columns == docs.columns
    assert Counter(r.doc_id for r in ordered.collect()) == Counter(r[0] for r in rows)
    assert pfair_mix.mix(table([])).count() == 0
    with pytest.raises(ValueError):
        pfair_mix.mix(docs, {"big": 0})


def test_shards_are_near_equal_whole_and_gapless(spark, table, prose):
    rows = [(k, prose(k, 3 + k % 40)) for k in range(1500)] + [(2000 + k, "same text") for k in range(700)]
    rows += [(None, None), (None, None), (5000, ""), (5001, None), (7, prose(7, 10))]
    got = ring_shards.shard(table(rows), shards=8, slack=0.01).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows
    )
    loads, slots = Counter(), {}
    for r in got:
        loads[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(loads.values()) / 8
    assert len(loads) == 8 and all(0.9 * mean < n < 1.05 * mean for n in loads.values())
    again = ring_shards.shard(table(rows[::-1]), shards=8, slack=0.01).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    assert ring_shards.shard(table([])).count() == 0


def test_slots_of_the_pipeline_follow_the_mix(spark, table, prose):
    rows = [(k, prose(k, 5 + k % 9), "en", ("big", "mid", None)[(k % 13 > 7) + (k % 13 > 11)]) for k in range(3000)]
    rows += [(None, "no id", "en", "mid")] * 2
    mixed = corpus_pipeline.mix(spark, table(rows), "")
    places = {r.doc_id: (r.slot, r.place) for r in pfair_mix.mix(table(rows)).collect()}
    source, shards = {r[0]: r[3] for r in rows}, {}
    got = corpus_pipeline.shards(spark, mixed, "").collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    for r in got:
        shards.setdefault(r.shard, []).append((r.slot, r.doc_id))
    first = Counter()
    for held in shards.values():
        held.sort()
        assert [s for s, _ in held] == list(range(len(held)))
        known = [i for _, i in held if i is not None]
        assert [places[i] for i in known] == sorted(places[i] for i in known)
        first.update(source[i] for i in known[: len(known) // 3])
    weights = {s: n**0.5 for s, n in Counter(source.values()).items()}
    for s, w in weights.items():
        assert abs(first[s] / sum(first.values()) - w / sum(weights.values())) < 0.05
    assert corpus_pipeline.shards(spark, table([]), "").count() == 0


def test_bounded_loads_and_little_movement():
    arcs = {a: 10 + a * 7919 % 50 for a in range(0, 1 << 16, 16)}
    few, more = (ring_shards.place(arcs, n, 64, 0.05) for n in (20, 21))
    for placed, shards in ((few, 20), (more, 21)):
        loads = Counter()
        for a, (_, shard) in placed.items():
            loads[shard] += arcs[a]
        assert max(loads.values()) <= sum(arcs.values()) * 1.05 / shards + 1
    assert sum(few[a][1] == few[a][0] for a in arcs) > 0.7 * len(arcs)
    # A new home is always the new shard; with overflow, most arcs still stay where they were.
    assert {more[a][0] for a in arcs if more[a][0] != few[a][0]} == {20}
    assert sum(more[a][1] != few[a][1] for a in arcs) < 0.35 * len(arcs)
