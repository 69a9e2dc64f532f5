"""The pruning library search against measuring every pair."""

from __future__ import annotations

import random

import pytest

from pyspark.sql import functions as F

from recurra.functions.vectors import LETTERS, squared_l2, squared_l2_written, text_vector
from recurra.operators import retrieval


def nearest(vector, entries, k):
    scored = sorted((sum((a - b) ** 2 for a, b in zip(vector, v, strict=True)), i) for i, v in entries if v)
    return [i for _, i in scored[:k]]


def search(spark, asked, entries, **options):
    queries = spark.createDataFrame(asked, "query long, query_vector array<float>")
    library = spark.createDataFrame(entries, "item long, vector array<float>")
    got = {}
    for r in sorted(retrieval.library_search(queries, library, "query", "item", **options).collect(), key=lambda r: r["rank"]):
        got.setdefault(r["query"], []).append(r.item)
    return got


def clustered(draw, n, spread, dims=4):
    centres = [[draw.random() * 10 for _ in range(dims)] for _ in range(12)]
    return [[float(c + draw.gauss(0, spread)) for c in draw.choice(centres)] for _ in range(n)]


@pytest.mark.parametrize(("pivots", "pack"), [(1, 3), (9, 256), (64, 5)])
@pytest.mark.parametrize("kind", ["grid", "clusters", "one point"])
def test_search_equals_all_pairs(spark, monkeypatch, pivots, pack, kind):
    monkeypatch.setattr(retrieval, "PACK", pack)
    draw = random.Random(pivots)
    points = {
        # Small integers, so that equal distances occur.
        "grid": [[float(draw.randrange(4)) for _ in range(3)] for _ in range(150)],
        "clusters": clustered(draw, 150, 0.1),
        "one point": [[1.0, 2.0]] * 40,
    }[kind]
    entries = [*enumerate(points), (900, None)]
    asked = [(i, p) for i, p in enumerate(points[:25])] + [(100, [9.0] * len(points[0])), (101, None)]
    got = search(spark, asked, entries, k=4, pivots=pivots)
    assert got == {i: nearest(p, entries, 4) for i, p in asked if p}


def test_search_of_few_entries_and_none(spark):
    asked = [(1, [0.0, 0.0]), (2, [5.0, 5.0])]
    assert search(spark, asked, [(7, [1.0, 1.0]), (8, [4.0, 4.0])], k=4) == {1: [7, 8], 2: [8, 7]}
    assert search(spark, asked, []) == {}
    assert search(spark, [], [(7, [1.0, 1.0])]) == {}


def test_written_distances_are_those_of_lambdas(spark):
    draw = random.Random(5)
    values = [None, [], [1.5], [0.1, None, 0.3], [0.1, 0.2, 0.3], [float("nan"), 1.0, 2.0], [1e300, -1e300, 0.0], [0.1, 0.2, 0.3, 0.4]]
    values += [[draw.random() for _ in range(3)] for _ in range(20)]
    pairs = spark.createDataFrame([(a, b) for a in values for b in values], "a array<double>, b array<double>")
    for size in (1, 3):
        got = pairs.select(squared_l2("a", "b").alias("lambdas"), squared_l2_written("a", "b", size).alias("written")).collect()
        assert [repr(r.lambdas) for r in got] == [repr(r.written) for r in got]


def test_search_of_small_packs_runs_no_lambda_over_entries(spark):
    entries = [(i, [float(i), 1.0]) for i in range(30)]
    queries = spark.createDataFrame([(1, [3.2, 0.0])], "query long, query_vector array<double>")
    library = spark.createDataFrame(entries, "item long, vector array<double>")
    found = retrieval.library_search(queries, library, "query", "item")
    assert "transform(_entries" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert [r.item for r in found.orderBy("rank").collect()] == [3, 4, 2, 5]


def test_search_leaves_most_pairs_of_clusters_unmeasured(spark):
    draw = random.Random(2)
    points = clustered(draw, 2000, 0.05)
    queries = spark.createDataFrame([(i, p) for i, p in enumerate(points[:200])], "query long, query_vector array<float>")
    library = spark.createDataFrame(list(enumerate(points)), "item long, vector array<float>")
    found = retrieval.library_search(queries, library, "query", "item")
    assert retrieval.measured_pairs(queries, library, "query", "item") < 0.35 * 200 * 2000
    assert found.count() == 800


def test_letter_shares_read_a_text_once(spark):
    texts = ["", None, "Tee", "ete ETE", "Straße İstanbul çe", "\n\t", "xyz", "e" * 500 + "ü", "日本e", "éÉ"]
    shares = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.lower("t").alias("low"), text_vector("t").alias("v"))
    for r in shares.collect():
        assert r.v == ([r.low.count(x) / len(r.low) for x in LETTERS] if r.t else None)
    plan = shares.select("v")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(") == 1
