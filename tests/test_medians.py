"""Exact medians from a sketch and one counting pass."""

from __future__ import annotations

import random
from statistics import median

import pytest

from recurra.operators.profiling import sketched_medians


@pytest.mark.parametrize("sketch", [4, 50, 10_000])
def test_sketched_medians_are_exact(spark, sketch):
    draw = random.Random(sketch)
    groups = {
        "constant": [7] * 101,
        "two": [1, 4],
        "one": [-5],
        "halves": [0] * 50 + [10**15] * 50,
        "skewed": [int(10 ** draw.uniform(0, 15)) for _ in range(801)],
        "negative": [draw.randint(-(10**15), 10**15) for _ in range(400)],
        "ties": [draw.randint(0, 3) for _ in range(1000)],
        None: [1, 2, 3, 3],
    }
    rows = [(g, v) for g, values in groups.items() for v in [*values, None]]
    draw.shuffle(rows)
    got = sketched_medians(spark.createDataFrame(rows, "name string, v long").repartition(7), "name", "v", sketch)
    assert {r.g: r.median for r in got.collect()} == {g: int(median(v)) for g, v in groups.items()}


def test_medians_of_nothing(spark):
    rows = spark.createDataFrame([("a", None)], "name string, v long")
    assert sketched_medians(rows, "name", "v").count() == 0
