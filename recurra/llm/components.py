"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from recurra.llm.common import discard, stored


def _large_star(links: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest of its neighbourhood."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of these."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("low"))
    hung = down.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return hung.union(low.select("a", F.col("low").alias("b")))


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) of every linked node that is not a root.

    ``links`` has columns ``a`` and ``b`` without nulls. Large-star and small-star steps alternate until
    the links no longer change; a step is written to the scratch folder, so none repeats another.
    """

    def digest(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = digest(now)
    while seen[0]:
        after = stored(_small_star(_large_star(now)).where("a <> b").distinct(), "links")
        discard(now)
        now, last = after, seen
        if (seen := digest(now)) == last:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
