"""Language profiles, the filter audit and the prefix trie against plain versions of their rules."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from recurra.llm import filter_audit, prefix_trie, rank_profiles

# --- language profiles -------------------------------------------------------------------------------

LANGUAGES = {"xa": "ba do fi gu ha je".split(), "xb": "lo mu na or pe qua".split(), "xc": "ri so ta ul ve wi".split()}


def grams_of(text):
    """N-grams of a text, letter by letter and without a table of words."""
    counts, padded = Counter(), re.sub(r"[^a-zäöüß]+", " ", f" {(text or '').lower()} ")
    for n in (1, 2, 3):
        for i in range(len(padded) - n + 1):
            g = padded[i : i + n]
            if g.strip() and " " not in g[1:-1]:
                counts[g] += 1
    return counts


def plain_language(rows, size):
    learned = defaultdict(Counter)
    for i, text, lang in rows:
        if i is not None and lang is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            learned[lang].update(grams_of(text))
    first = lambda c: sorted(c, key=lambda g: (-c[g], g))[:size]
    ranks = {lang: {g: k for k, g in enumerate(first(c))} for lang, c in learned.items()}
    out = []
    for _, text, _ in rows:
        counts = grams_of(text)
        own = first(counts)
        if not own or not ranks:
            out.append(("und", 0.0))
            continue
        places = defaultdict(list)
        for k, g in enumerate(own):
            places[counts[g]].append(k)
        mean = {n: sum(p) / len(p) for n, p in places.items()}
        apart = {
            lang: sum(abs(mean[counts[g]] - r[g]) if g in r else size for g in own) for lang, r in sorted(ranks.items())
        }
        best = min(sorted(apart), key=apart.get)
        out.append((best, 1 - apart[best] / (size * len(own))))
    return out


def language_rows(prose, n=160):
    draw, rows = random.Random(5), []
    for i in range(n):
        lang = draw.choice(sorted(LANGUAGES))
        parts = LANGUAGES[lang]
        words = [a + b for a in parts for b in parts] + ["der"]
        text = prose(i, draw.choice([1, 2, 5, 40, 200]), words)
        rows.append((i, text.title() + draw.choice(["", " 12!", "\n-- x9y"]), lang if i % 11 else None))
    return rows


@pytest.mark.parametrize("piece", [7, 1 << 20])
def test_language_profiles_against_plain_counting(spark, table, prose, monkeypatch, piece):
    monkeypatch.setattr(rank_profiles, "PIECE", piece)
    rows = language_rows(prose) + [(900, None, "xa"), (901, "", "xa"), (902, " 12 ²Ⅷ \n", "xb"), (903, "zzz", "xc"), (None, "der babado", "xd")]
    rows += [rows[3], (905, prose(9, 20_000, ["bado", "figu"]), "xa")]
    docs = table([(i, t, lang, None) for i, t, lang in rows])
    got = rank_profiles.identify(docs).collect()
    assert len(got) == len(rows)
    want = plain_language(rows, rank_profiles.PROFILE)
    key = lambda i, lang, score: (-1 if i is None else i, lang, round(score, 9))
    assert sorted(key(r.doc_id, r.lang_pred, r.score) for r in got) == sorted(key(i, *w) for (i, _, _), w in zip(rows, want, strict=True))
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)


def test_languages_of_held_out_texts(spark, table, prose):
    rows = language_rows(prose, 300)
    known = {i: lang for i, text, lang in rows if lang and len(text) > 20}
    got = rank_profiles.identify(table([(i, t, lang, None) for i, t, lang in rows])).where("held_out").collect()
    hits = [r.lang_pred == known[r.doc_id] for r in got if r.doc_id in known]
    assert len(hits) > 30 and sum(hits) >= 0.97 * len(hits)


def test_languages_without_training(spark, table):
    assert [tuple(r) for r in rank_profiles.identify(table([(1, "some words", None, None)])).collect()] == [(1, False, "und", 0.0)]
    assert rank_profiles.identify(table([])).count() == 0


def test_too_many_languages_are_refused(spark, table, monkeypatch):
    monkeypatch.setattr(rank_profiles, "MAX_LANGUAGES", 2)
    docs = table([(i, "word", f"l{i}", None) for i in range(20)])
    with pytest.raises(ValueError, match="more than 2 languages"):
        rank_profiles.identify(docs)


@pytest.mark.parametrize("piece,kept", [(1 << 20, 1 << 20), (5, 3)])
def test_partial_counts_add_up(spark, monkeypatch, piece, kept):
    monkeypatch.setattr(rank_profiles, "PIECE", piece)
    monkeypatch.setattr(rank_profiles, "KEPT", kept)
    texts = [None, "", "a", "Ab c-d", "é𝒳 é𝒳1é", " x\nx "] * 7
    docs = spark.createDataFrame([("a", t) for t in texts], "lang string, text string").coalesce(1)
    counted = docs.mapInArrow(rank_profiles._count, "lang string, gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    words = [w for t in texts for w in re.findall(r"[^\W\d_]+", (t or "").lower())]
    want = Counter(f" {w} "[i : i + n] for w in words for n in (1, 2, 3) for i in range(len(w) + 3 - n))
    del want[" "]
    assert {rank_profiles.gram_text(r.gram): r.n for r in counted.collect()} == want


# --- filter audit ------------------------------------------------------------------------------------


def plain_audit(rows, labels):
    good, toxic = defaultdict(bool), defaultdict(bool)
    for i, q, t in labels:
        good[i] |= q == 1
        toxic[i] |= t == 1
    ids = defaultdict(list)
    for i, text, _ in rows:
        if i is not None:
            ids[text or ""].append(i)
    fails = []
    for i, text, part in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        bad = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": any(i is None or j < i for j in ids[text]),
        }
        fails.append((part or "", {f for f in bad if bad[f]}, i is not None and good[i], i is not None and toxic[i]))
    out, shapley = [], Counter()
    for part in {f[0] for f in fails}:
        docs = [f for f in fails if f[0] == part]
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone, stay = [d for d in left if f in d[1]], [d for d in left if f not in d[1]]
                before = sum(f in d[1] for d in docs) - len(gone)
                only = sum(d[1] == {f} for d in docs)
                out.append((part, "".join(order), step, len(stay), len(gone), before, only, sum(d[2] for d in gone), sum(d[3] for d in gone)))
                shapley[part, f] += len(gone)
                left = stay
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


COLUMNS = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()


def test_filter_audit_against_removing_one_by_one(spark, table, prose):
    draw, rows = random.Random(3), []
    pool = [None, "", "\x0b \n", prose(1, 60), prose(1, 60), prose(2, 60).upper(), prose(3, 70) + " #", prose(4, 100, ["a", "b"]), "x|y Z", prose(5, 49)]
    pool += [prose(6, 30_000)]
    for i in range(80):
        rows.append((i if i % 13 else None, draw.choice(pool), draw.choice(["s0", "s0", "s1", "", None])))
    rows += [rows[1], rows[1], (7, prose(77, 55), "s1"), (7, prose(77, 55), "s2")]
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 60, 2)] + [(4, 1, 1), (None, 1, 1)]
    docs = table([(i, t, None, s) for i, t, s in rows])
    known = spark.createDataFrame([(i, q, int(t)) for i, q, t in labels], "doc_id long, quality int, toxic int").withColumn("mask", F.lit("clash"))
    got = filter_audit.audit(filter_audit.masks(docs, known)).select(*COLUMNS).collect()
    assert sorted(map(tuple, got)) == plain_audit(rows, labels)


def test_filter_audit_of_nothing(spark, table):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(filter_audit.masks(table([]), labels)).count() == 0


def test_potentials_give_shapley_values(spark):
    draw = random.Random(8)
    values = [0] + [draw.randint(0, 1000) for _ in range(31)]
    p = spark.range(1).select(filter_audit.potentials(F.array(*map(F.lit, values)).cast("array<bigint>")).alias("p")).first().p
    for i in range(5):
        gains = 0
        for order in permutations(range(5)):
            before = sum(1 << j for j in order[: order.index(i)])
            gains += values[before | 1 << i] - values[before]
        assert p[31] - p[31 ^ (1 << i)] == gains


# --- prefix trie -------------------------------------------------------------------------------------


def plain_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn, role or "", text or ""))
    digest = lambda t: hashlib.sha256(f"{len(t[1])}:{t[1]}{t[2]}".encode()).digest()[:16]
    for turns in own.values():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, digest(t)))
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = own.get(c - c % 100, []) if c >= 0 else own.get(c + (-c) % 100, [])
        built[c] = tuple(t[1:] for t in base[:h] + turns[h:])
    members = defaultdict(list)
    for c, path in built.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children, leaves, saved = Counter(p[:-1] for p in members if p), Counter(), Counter()
    for path, convs in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += children[path] == 0
            saved[path[:d]] += (len(convs) - 1) * len(path[-1][1]) if path else 0
    out = []
    for path, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if built[c] == path)
        parent = min(members[path[:-1]]) if path else None
        row = (min(convs), len(path), parent, len(convs), children[path], leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest())
        out.append(row)
    return sorted(out, key=repr)


def trie_of(spark, rows):
    schema = "conv_id long, turn long, role string, text string, shard string, path string"
    turns = spark.createDataFrame([(*r, "clash", "clash") for r in rows], schema)
    found = prefix_trie.conversation_trie(turns)
    assert found.columns == [*prefix_trie.MEASURES, "ends_sha256"]
    return sorted(map(tuple, found.collect()), key=repr)


@pytest.mark.parametrize("shards,cut,piece", [(1, 64, 4096), (4, 64, 2), (23, 2, 1), (23, 64, 4096)])
def test_trie_against_grouping_prefixes(spark, monkeypatch, shards, cut, piece):
    monkeypatch.setattr(prefix_trie, "CUT", cut)
    monkeypatch.setattr(prefix_trie, "PIECE", piece)
    monkeypatch.setattr(prefix_trie, "ROWS", 5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shards)
    draw, rows = random.Random(shards), []
    for c in [*range(0, 260), *range(100_000, 100_020), -3, -100, -205]:
        if c == 100:
            continue
        same = draw.random()
        for k in range(draw.choice([1, 2, 3, 7, 9])):
            text = f"turn {k}" if same < 0.6 else draw.choice("abc") * draw.randint(0, 2)
            rows.append((c, draw.choice([k, k, k, None]) if same > 0.95 else k, draw.choice(["user", "user", None, ""]) if same > 0.4 else "user", text))
    rows += [(7, k, "user", f"é𝒳{k}") for k in range(150)] + [(207, k, "user", f"é𝒳{k}") for k in range(149)]
    rows += [(9, 1, "a", None)] * 3 + [(None, 0, "user", "lost")]
    draw.shuffle(rows)
    try:
        assert trie_of(spark, rows) == plain_trie(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    assert trie_of(spark, []) == []
    # Conversations without their block's first one lose their first turns, here all of them.
    lost = [c for c in range(301, 330) if zlib.crc32(str(c).encode()) % 6][:3]
    rows = [(c, 0, "user", "gone") for c in lost]
    ends = hashlib.sha256(",".join(map(str, lost)).encode()).hexdigest()
    assert trie_of(spark, rows) == [(lost[0], 0, None, 3, 0, 1, 0, ends)] == plain_trie(rows)


def test_skeleton_separates_shards():
    draw = random.Random(1)
    turn = lambda k: bytes([k]) * prefix_trie.WIDTH
    keys = sorted({(b"".join(turn(draw.randint(0, 2)) for _ in range(draw.randint(0, 6))), c) for c in range(400)})
    trie = prefix_trie.Skeleton(draw.sample(keys, 60), 9)
    shards = [trie.shard(*k) for k in keys]
    assert shards == sorted(shards) and len(set(shards)) == 9
    where = defaultdict(set)
    for (path, _), shard in zip(keys, shards, strict=True):
        for end in range(0, len(path) + 1, prefix_trie.WIDTH):
            where[path[:end]].add(shard)
    assert all(node in trie.ids for node, at in where.items() if len(at) > 1)
