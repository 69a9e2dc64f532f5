"""From raw documents to shards: each stage applies one operator to all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recurra.llm import benchmark_leaks, pfair_mix, quality_mcd, ring_shards, simhash_dedup
from recurra.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the robust distances reject go."""
    return quality_mcd.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates stays."""
    return simhash_dedup.representatives(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return benchmark_leaks.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are interleaved to their target weights: the rows leave in the order of the schedule."""
    return pfair_mix.in_order(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every document; the slots of a shard follow the schedule of the mix."""
    placed = pfair_mix.with_places(docs).select("row.doc_id", "row.text", "at.slot", "at.place")
    return ring_shards.shard(placed, order=("slot", "place"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shards", shards),
]

#: SQL cannot express the robust estimates, the link components, the schedule and the ring.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage before is written to the shared scratch folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
