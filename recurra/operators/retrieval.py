"""Notes, similarity search and evidence per entity."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.codings import first
from ..functions.references import trailing_id
from ..functions.vectors import METRICS, squared_l2, squared_l2_written
from .incremental import latest_per_key, upsert
from .skew import HOT_ROWS, hot_keys

# How many notes and how many library entries a search returns.
NOTES_K, LIBRARY_K = 8, 4

SALTS = 64
LIBRARY_BLOCKS = 16
#: Pivots of a library search, rings of distance around each, and entries in a row.
PIVOTS, RINGS, PACK = 64, 16, 256
#: The distance of two vectors up to this size is written out as one expression, which Spark compiles.
WRITTEN = 64


def notes(document_reference: DataFrame) -> DataFrame:
    """Non-empty notes with their patient, date and decoded text."""
    attachment = first("content")["attachment"]["data"]
    return document_reference.select(
        F.col("id").alias("note_id"),
        trailing_id("subject.reference").alias("patient_id"),
        F.col("date").cast("string").alias("note_date"),
        F.unbase64(attachment).cast("string").alias("note_text"),
    ).filter(F.length("note_text") > 0)


def cohort_notes(document_reference: DataFrame, patients: DataFrame) -> DataFrame:
    """Notes of the given patients."""
    return notes(document_reference).join(patients.select("patient_id"), "patient_id", "left_semi")


def corpus_upsert(corpus: DataFrame, batch: DataFrame, key: str, *order: str) -> DataFrame:
    """The corpus after adding a batch by id; running the same batch again changes nothing."""
    return upsert(corpus, latest_per_key(batch, key, *order), key)


def _best(df: DataFrame, groups: list[str], item: str, k: int, rank: str) -> DataFrame:
    """The k nearest per group. Spark keeps k rows per group and task before the exchange."""
    nearest = Window.partitionBy(*groups).orderBy("distance", item)
    return df.withColumn(rank, F.row_number().over(nearest)).filter(F.col(rank) <= k)


def entity_topk(
    queries: DataFrame,
    items: DataFrame,
    entity: str,
    item: str,
    k: int = NOTES_K,
    metric: str = "l2",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The k items of each entity nearest to the entity's query: entity, item, distance, rank.

    ``queries`` holds one ``query_vector`` per entity, ``items`` the ``vector`` of each item, so
    an item is scored once. Items of hot entities are spread over as many salts as they hold ``hot_rows``
    items, each salt keeps its own k best, and only those meet.
    """
    salts = F.greatest(F.lit(2), F.ceil(F.count(F.lit(1)) / hot_rows)).cast("int")
    hot = F.broadcast(hot_keys(items, entity, hot_rows, salts.alias("_salts")))
    item_salt = F.coalesce(F.pmod(F.xxhash64(item), F.col("_salts")).cast("int"), F.lit(0))
    salted_items = items.join(hot, entity, "left").select(
        entity, item, "vector", item_salt.alias("_salt")
    )
    query_salts = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    salted_queries = queries.join(hot, entity, "left").select(
        entity, "query_vector", F.explode(query_salts).alias("_salt")
    )
    scored = salted_items.join(salted_queries, [entity, "_salt"]).select(
        entity, "_salt", item, METRICS[metric]("query_vector", "vector").alias("distance")
    )
    finalists = _best(scored, [entity, "_salt"], item, k, "_place").select(entity, item, "distance")
    return _best(finalists, [entity], item, k, "rank")


def library_topk(
    queries: DataFrame,
    library: DataFrame,
    query: str,
    item: str,
    k: int = LIBRARY_K,
    metric: str = "l2",
    blocks: int = LIBRARY_BLOCKS,
    salts: int = SALTS,
) -> DataFrame:
    """The k library entries nearest to each query: query, item, distance, rank.

    The library is dealt into ``blocks`` and the queries into ``salts`` groups; a task meets one group
    with one block, as one row each, so a query is copied once per block and an entry once per group.
    It leaves a block with at most k candidates. Which side is small is left to Spark's statistics;
    ``blocks`` and ``salts`` bound what a row holds and should grow with the tables.
    """
    entry = F.struct(F.col(item), F.col("vector"))
    packed = (
        library.groupBy(F.pmod(F.xxhash64(item), F.lit(blocks)).alias("_block"))
        .agg(F.collect_list(entry).alias("_entries"))
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    )
    asked = queries.select(
        query,
        "query_vector",
        F.pmod(F.xxhash64(query), F.lit(salts)).cast("int").alias("_salt"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block"),
    )
    met = asked.join(packed, ["_block", "_salt"])
    found = met.select(
        query, F.inline(_nearest_entries("query_vector", "_entries", item, k, METRICS[metric]))
    )
    return _best(found, [query], item, k, "rank")


def _visits(
    queries: DataFrame, library: DataFrame, query: str, item: str, k: int = LIBRARY_K, pivots: int = PIVOTS
) -> tuple[DataFrame, int, bool]:
    """Queries beside the packs of entries they visit: query, query_vector, _entries; the usual size of vectors;
    and whether packs are so small that their best k are most of them.

    Some entries, fixed in number, are pivots. An entry belongs to the cell of its nearest pivot and of its
    distance to that. By the triangle inequality no entry of a cell is nearer to a query than the query's
    distance to the pivot differs from the cell's distances; and the k-th nearest pivot is an entry, so
    nothing farther than it matters. A query visits the cells that this leaves. It is exact: the bounds
    give way by rounding errors only.

    Cells are packed into rows of about ``PACK`` entries, so no row grows with the library. Pivots and
    the sizes of cells come to the driver, at most ``pivots`` and ``pivots * RINGS`` rows.
    """
    entries = library.filter(F.col("vector").isNotNull()).select(item, F.col("vector").cast("array<double>").alias("vector"))
    chosen = [list(r.vector) for r in entries.orderBy(F.xxhash64(item), item).select("vector").limit(pivots).collect()]
    step = _spacing(chosen) / 4
    centres = F.from_json(F.lit(json.dumps(chosen)), "array<array<double>>")

    def to_pivots(vector: str) -> Column:
        return F.transform(centres, lambda p: F.sqrt(squared_l2(F.col(vector), p)))

    ring = F.least(F.lit(RINGS - 1), F.floor(F.array_min("_apart") / step)).cast("int")
    nearest = (F.array_position("_apart", F.array_min("_apart")) - 1).cast("int")
    placed = entries.withColumn("_apart", to_pivots("vector")).select(
        item, "vector", nearest.alias("_pivot"), (nearest * RINGS + ring).alias("_cell"), F.array_min("_apart").alias("_far")
    )
    sizes = (
        placed.groupBy("_cell", "_pivot")
        .agg(F.count(F.lit(1)).alias("n"), F.min("_far").alias("low"), F.max("_far").alias("high"))
        .collect()
    )
    packs = [0] * (pivots * RINGS)
    for r in sizes:
        packs[r["_cell"]] = -(-r.n // PACK)
    cells = [{"cell": r["_cell"], "pivot": r["_pivot"], "low": r.low, "high": r.high, "packs": packs[r["_cell"]]} for r in sizes]
    known = F.from_json(F.lit(json.dumps(cells)), "array<struct<cell:int,pivot:int,low:double,high:double,packs:int>>")
    pack_of = F.pmod(F.xxhash64(item), F.get(F.from_json(F.lit(json.dumps(packs)), "array<int>"), F.col("_cell")))
    packed = (
        placed.select("_cell", pack_of.cast("int").alias("_pack"), F.struct(F.col(item), F.col("vector")).alias("_entry"))
        .groupBy("_cell", "_pack")
        .agg(F.collect_list("_entry").alias("_entries"))
    )

    slack = 1e-9
    reach = F.coalesce(F.get(F.sort_array("_apart"), F.lit(k - 1)), F.lit(float("inf"))) * (1 + slack) + slack

    def may_hold(cell: Column) -> Column:
        apart = F.get(F.col("_apart"), cell["pivot"])
        return (cell["low"] - apart <= F.col("_reach")) & (apart - cell["high"] <= F.col("_reach"))

    def all_packs(cell: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), cell["packs"] - 1), lambda n: F.struct(cell["cell"].alias("_cell"), n.alias("_pack")))

    visits = (
        queries.filter(F.col("query_vector").isNotNull())
        .select(query, F.col("query_vector").cast("array<double>").alias("query_vector"))
        .withColumn("_apart", to_pivots("query_vector"))
        .withColumn("_reach", reach)
        .select(query, "query_vector", F.inline(F.flatten(F.transform(F.filter(known, may_hold), all_packs))))
    )
    met = visits.join(packed, ["_cell", "_pack"]).select(query, "query_vector", "_entries")
    return met, len(chosen[0]) if chosen else 0, sum(r.n for r in sizes) <= 2 * k * sum(packs)


def library_search(
    queries: DataFrame, library: DataFrame, query: str, item: str, k: int = LIBRARY_K, pivots: int = PIVOTS
) -> DataFrame:
    """What ``library_topk`` finds by squared Euclidean distance, without measuring every pair (see ``_visits``)."""
    met, dims, small = _visits(queries, library, query, item, k, pivots)
    if 0 < dims <= WRITTEN and small:
        pairs = met.select(query, "query_vector", F.inline("_entries"))
        found = pairs.select(query, squared_l2_written("query_vector", "vector", dims).alias("distance"), item)
    else:
        found = met.select(query, F.inline(_nearest_entries("query_vector", "_entries", item, k, squared_l2)))
    return _best(found, [query], item, k, "rank")


def measured_pairs(
    queries: DataFrame, library: DataFrame, query: str, item: str, k: int = LIBRARY_K, pivots: int = PIVOTS
) -> int:
    """How many pairs of a query and an entry such a search measures."""
    met, _, _ = _visits(queries, library, query, item, k, pivots)
    return met.agg(F.sum(F.size("_entries")).alias("n")).first().n or 0


def _spacing(points: list[list[float]]) -> float:
    """The median distance of a point to its nearest other one; 1 where there is none."""
    apart = sorted(min((math.dist(a, b) for b in points if b is not a), default=0.0) for a in points)
    return (apart[len(apart) // 2] if apart else 0.0) or 1.0


def _nearest_entries(vector: str, entries: str, item: str, k: int, distance) -> Column:
    scored = F.transform(
        entries,
        lambda e: F.struct(
            distance(F.col(vector), e["vector"]).alias("distance"), e[item].alias(item)
        ),
    )
    # Sorts in the engine's own order of rows; ``array_sort`` runs an expression per comparison.
    return F.slice(F.sort_array(scored), 1, k)


def evidence_bundle(
    profiles: DataFrame, top_notes: DataFrame, top_library: DataFrame, entity: str, note: str, entry: str
) -> DataFrame:
    """Profile, best notes and best library entries per entity, for the whole cohort.

    The lists are bounded by the k of the searches.
    """

    def ranked(found: DataFrame, item: str, name: str) -> DataFrame:
        pairs = F.struct("rank", F.col(item).alias("id"))
        lists = F.transform(F.array_sort(F.collect_list(pairs)), lambda p: p["id"])
        return found.groupBy(entity).agg(lists.alias(name))

    return (
        profiles.join(ranked(top_notes, note, "notes"), entity, "left")
        .join(ranked(top_library, entry, "guidelines"), entity, "left")
    )
