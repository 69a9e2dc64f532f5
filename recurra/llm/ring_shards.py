"""Shards on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``nodes`` points of a ring. A document's key is hashed to one of 65,536 arcs; going
clockwise from there, the first shard with room for the arc takes it, so no shard exceeds its share
by more than ``slack`` (or, where no shard has room, by one arc; large arcs go first, so that is a
small one). A new shard takes over only the
arcs before its points and what overflowed there. Equal texts share a key and stay together, unless
they make up more than 1/64 of a shard: then the group is cut into that many keys by document id.

Only arc totals (65,536 rows at most, however long the table) and the groups to be cut (each holds
over 1/64 of a shard, so there are at most 128 per shard) leave the executors.

Slots of a shard go by arc and id, or by the numbers in ``order`` where these are given: then rows are
counted by shard and range of the first number, and numbered within these.

Defined cases: a null text counts as empty; rows without id and repeated rows are placed like others,
in the arc of their text; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from recurra.llm.common import stored

ARC_BITS = 16
PARTS = 64
OVERHEAD = 16
RANGES = 1024


def ring(shards: int, nodes: int) -> list[tuple[int, int]]:
    """The points of all shards, clockwise, as (position in 64 bits, shard)."""
    point = lambda s, k: int.from_bytes(hashlib.sha256(f"{s}:{k}".encode()).digest()[:8], "big")
    return sorted((point(s, k), s) for s in range(shards) for k in range(nodes))


def place(arcs: dict[int, int], shards: int, nodes: int, slack: float) -> dict[int, tuple[int, int]]:
    """The shard at home and the shard chosen for every arc of the given size."""
    points = ring(shards, nodes)
    positions = [p for p, _ in points]
    clockwise: list[list[int]] = [[]] * len(points)
    order: list[int] = []
    for k in range(2 * len(points) - 1, -1, -1):
        shard = points[k % len(points)][1]
        order = [shard, *(s for s in order if s != shard)]
        if k < len(points):
            clockwise[k] = order
    loads, chosen = [0] * shards, {}
    room = -(-int(sum(arcs.values()) * (1 + slack)) // shards)
    for arc in sorted(arcs, key=lambda a: (-arcs[a], a)):
        walk = clockwise[bisect.bisect_left(positions, arc << (64 - ARC_BITS)) % len(points)]
        size = arcs[arc]
        taken = next((s for s in walk if loads[s] + size <= room), None)
        if taken is None:
            taken = min(walk, key=loads.__getitem__)
        loads[taken] += size
        chosen[arc] = walk[0], taken
    return chosen


def shard(
    docs: DataFrame,
    shards: int = 40,
    nodes: int = 128,
    slack: float = 0.002,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: tuple[str, ...] = (),
) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``home`` (shard before overflow), ``shard`` and ``slot`` per row."""
    spark, text = docs.sparkSession, F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = stored(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(text).alias("group"),
            *(F.col(c).cast("long").alias(f"_o{k}") for k, c in enumerate(order)),
        ),
        "sizes",
    )
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    part_size, part_rows = max(1, total // (shards * PARTS)), max(1, count // (shards * PARTS))
    parts = F.greatest(F.ceil(F.col("s") / part_size), F.ceil(F.col("n") / part_rows)).cast("long")
    cut = (
        rows.groupBy("group")
        .agg(F.sum("size").alias("s"), F.count("*").alias("n"))
        .where((F.col("n") > 1) & ((F.col("s") > part_size) | (F.col("n") > part_rows)))
        .select(F.col("group").alias("cut"), parts.alias("parts"))
    )
    part = F.pmod(F.xxhash64("doc_id"), F.coalesce(F.col("parts"), F.lit(1)))
    arc = F.shiftrightunsigned(F.xxhash64("group", part), 64 - ARC_BITS).cast("int")
    keyed = rows.join(F.broadcast(cut), F.col("group") == F.col("cut"), "left").withColumn("arc", arc)

    arcs = {r.arc: r for r in keyed.groupBy("arc").agg(F.sum("size").alias("s"), F.count("*").alias("n")).collect()}
    chosen, filled, table = place({a: r.s for a, r in arcs.items()}, shards, nodes, slack), [0] * shards, []
    for a in sorted(chosen):
        home, to = chosen[a]
        table.append((a, home, to, filled[to]))
        filled[to] += arcs[a].n
    kinds = (("at", pa.int32()), ("home", pa.int32()), ("shard", pa.int32()), ("first", pa.int64()))
    columns = {n: pa.array([r[k] for r in table], kind) for k, (n, kind) in enumerate(kinds)}
    placed = F.broadcast(spark.createDataFrame(pa.table(columns)))
    if order:
        return _numbered(rows, keyed.join(placed, F.col("arc") == F.col("at")), len(order))
    inside = F.row_number().over(Window.partitionBy("arc").orderBy("doc_id", "group"))
    return (
        keyed.withColumn("inside", inside)
        .join(placed, F.col("arc") == F.col("at"))
        .select("doc_id", "size", "text_crc32", "home", "shard", (F.col("first") + F.col("inside") - 1).cast("long").alias("slot"))
    )


def _numbered(rows: DataFrame, placed: DataFrame, columns: int) -> DataFrame:
    """``placed`` with the slots of every shard in the order of ``_o0``, ``_o1`` and so on, then of the ids."""
    most = rows.agg(F.coalesce(F.max("_o0"), F.lit(0))).first()[0]
    ranged = placed.withColumn("range", F.floor(F.col("_o0") / (most // RANGES + 1)).cast("int"))
    before = Window.partitionBy("of").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy(F.col("shard").alias("of"), F.col("range").alias("nth")).agg(F.count("*").alias("n"))
    starts = counts.select("of", "nth", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("shard", "range").orderBy(*(f"_o{k}" for k in range(columns)), "doc_id", "group"))
    numbered = ranged.withColumn("inside", inside).join(starts, (F.col("shard") == F.col("of")) & (F.col("range") == F.col("nth")))
    return numbered.select("doc_id", "size", "text_crc32", "home", "shard", (F.col("start") + F.col("inside") - 1).cast("long").alias("slot"))
