"""Mixing of sources to target weights by proportionate-fair scheduling.

Documents of a source are shuffled by a hash of their id and cut into blocks; a slot of the mix holds
one block. Weights are rounded to whole blocks per frame of slots. Within a frame of length L, the
i-th of a source's p blocks is released at floor((i-1)L/p) and due at ceil(iL/p); taking the earliest
deadline among released blocks meets every deadline, so at any slot a source is less than one block
from its target. At the end of a frame all sources are exactly on target, so frames repeat one
pattern and the slot of any block follows from its number by arithmetic.

A source that runs out ends its phase: the last frame is cut where it ends, and the weights of the
others are set anew. Nothing is dropped or repeated.

The driver holds one number per source (sources are those of the mix, each with a weight), and the
patterns are made on the executors, one task per phase.

Defined cases: a null source is a source of its own; rows without id are shuffled by their text;
repeated rows each get a place; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping
from fractions import Fraction

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from recurra.llm.common import ranked, row_key, stored

NO_SOURCE = "null"


def allotments(weights: Mapping[str, float], frame: int) -> dict[str, int]:
    """Whole blocks per frame for every source, at least one each, by largest remainders."""
    total = sum(Fraction(w) for w in weights.values())
    spare = frame - len(weights)
    exact = {s: Fraction(w) / total * frame for s, w in weights.items()}
    over = {s: max(Fraction(0), x - 1) for s, x in exact.items()}
    scale = Fraction(spare) / (sum(over.values()) or 1)
    parts = {s: over[s] * scale for s in weights}
    whole = {s: 1 + int(parts[s]) for s in weights}
    short = frame - sum(whole.values()) if any(over.values()) else 0
    for s in sorted(weights, key=lambda s: (int(parts[s]) - parts[s], s))[:short]:
        whole[s] += 1
    return whole


def phases(blocks: Mapping[str, int], weights: Mapping[str, float], frame: int = 1024) -> list[tuple]:
    """(phase, source, blocks per frame, first block, frames, first slot, slots per frame)."""
    left, done, slot, out = {s: n for s, n in blocks.items() if n}, dict.fromkeys(blocks, 0), 0, []

    def add(share: dict[str, int], frames: int) -> None:
        nonlocal slot
        length, phase = sum(share.values()), len({r[0] for r in out[-1:]}) and out[-1][0] + 1
        if not length or not frames:
            return
        for s, p in share.items():
            if p:
                out.append((phase, s, p, done[s], frames, slot, length))
                done[s] += p * frames
                left[s] -= p * frames
        slot += length * frames

    while left:
        share = allotments({s: weights[s] for s in left}, max(frame, 4 * len(left)))
        add(share, min(left[s] // share[s] for s in left))
        end = min(Fraction(left[s], share[s]) for s in left)
        add({s: int(share[s] * end) for s in left}, 1)
        left = {s: n for s, n in left.items() if n}
    return out


def pattern(shares: Mapping[str, int]) -> list[tuple[str, int, int, int, int]]:
    """(source, number, slot, release, deadline) of every block of one frame, earliest deadline first."""
    length = sum(shares.values())
    jobs = sorted(((i * length // p, -(-(i + 1) * length // p), s, i) for s, p in shares.items() for i in range(p)))
    ready, at, out = [], 0, []
    for slot in range(length):
        while at < len(jobs) and jobs[at][0] <= slot:
            release, deadline, source, i = jobs[at]
            heapq.heappush(ready, (deadline, source, i, release))
            at += 1
        deadline, source, i, release = heapq.heappop(ready)
        out.append((source, i, slot, release, deadline))
    return out


def mix(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    temper: float = 0.5,
    block: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The place of every row in the mix: ``doc_id``, ``source``, ``block``, ``slot``, ``release``,
    ``deadline`` (slots) and ``place`` (position in the block); ``key`` is the id or what stands for it.

    ``weights`` maps sources to positive numbers; sources without one get (their rows) ** ``temper``.
    """
    spark = docs.sparkSession
    named = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit(NO_SOURCE))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).alias("source"),
        named.alias("name"),
        row_key(id_col, text_col).alias("key"),
    )
    rows = stored(rows, "sources")
    given = {NO_SOURCE if s is None else f"={s}": w for s, w in (weights or {}).items()}
    counts = {r["name"]: r["count"] for r in rows.groupBy("name").count().collect()}
    targets = {s: given.get(s, n**temper) for s, n in counts.items()}
    if any(w <= 0 for w in targets.values()):
        raise ValueError("weights must be positive")
    plan = phases({s: -(-n // block) for s, n in counts.items()}, targets)
    kinds = "phase int, name string, share long, first long, frames long, slot0 long, length long"
    table = spark.createDataFrame(plan, kinds)

    def patterns(group: pd.DataFrame) -> pd.DataFrame:
        made = pattern(dict(zip(group["name"], group["share"].tolist(), strict=True)))
        out = pd.DataFrame(made, columns=["name", "nth", "at", "release", "deadline"])
        return out.assign(phase=group["phase"].iloc[0])

    slots = table.groupBy("phase").applyInPandas(
        patterns, "name string, nth long, at long, release long, deadline long, phase int"
    )
    order = [F.xxhash64("key"), F.col("key")]
    dealt = stored(ranked(rows, "name", order, "rank"), "ranks").withColumn("block", F.floor(F.col("rank") / block))
    until = F.col("first") + F.col("share") * F.col("frames")
    behind = F.col("block") - F.col("first")
    heads = (
        dealt.where(F.col("rank") % block == 0)
        .select("name", "block")
        .join(F.broadcast(table), "name")
        .where((F.col("block") >= F.col("first")) & (F.col("block") < until))
        .withColumn("nth", behind % F.col("share"))
        .withColumn("start", F.col("slot0") + F.floor(behind / F.col("share")) * F.col("length"))
        .join(slots, ["phase", "name", "nth"])
        .select("name", "block", *((F.col("start") + F.col(c)).alias(t) for c, t in (("at", "slot"), ("release", "release"), ("deadline", "deadline"))))
    )
    return dealt.join(heads, ["name", "block"]).select(
        "doc_id", "source", "block", "slot", "release", "deadline", (F.col("rank") % block).cast("int").alias("place"), "key"
    )


def with_places(docs: DataFrame, **options) -> DataFrame:
    """``key``, ``row`` (all columns of ``docs``) and ``at`` (slot and place in the mix; that of the first row with the key)."""
    names = {k: options[k] for k in ("id_col", "text_col") if k in options}
    places = mix(docs, **options).groupBy("key").agg(F.min(F.struct("slot", "place")).alias("at"))
    return docs.select(row_key(**names).alias("key"), F.struct("*").alias("row")).join(places, "key")


def in_order(docs: DataFrame, **options) -> DataFrame:
    """``docs`` in the order of the mix: partitions follow the slots, rows within follow the places."""
    ordered = with_places(docs, **options).withColumn("slot", F.col("at.slot")).repartitionByRange("slot", "key")
    return ordered.sortWithinPartitions("slot", "at.place", "key").select("row.*")
