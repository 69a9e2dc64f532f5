"""Large tables that change a little at a time: only the parts that change are written.

``merge_buckets`` keeps a table in buckets by a hash of its key and rewrites the buckets that hold a key
of the batch. ``merge_history`` keeps open and closed versions apart; closed ones are only ever added.
Both return the table's new ``TableFiles``, to be published with a commit; until then, and if it never
comes to that, readers go on with the old files.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_dir
from ..sources.commits import Commits, TableFiles
from .incremental import fresh_rows, upsert
from .scd2 import changed_versions, initial_snapshot

BUCKET, PART = "_bucket", "_part"
OPEN, CLOSED = "open", "closed"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _in_parts(commits: Commits, rows: DataFrame, column: str) -> str:
    folder = commits.new_folder()
    rows.write.partitionBy(column).parquet(f"{commits.root}/{folder}")
    return folder


def _widened(held: T.StructType, added: T.StructType) -> T.StructType:
    """``held`` and the columns only ``added`` has."""
    return T.StructType([*held, *(f for f in added if f.name not in held.names)])


def _filled(rows: DataFrame, schema: T.StructType) -> DataFrame:
    present = set(rows.columns)
    return rows.select(*[F.col(f.name) if f.name in present else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def merge_buckets(
    commits: Commits,
    held: TableFiles | None,
    batch: DataFrame,
    key: str,
    time: str,
    buckets: int = 256,
    files: int = 1,
) -> TableFiles:
    """``held`` after loading what it lacks of ``batch`` (see ``incremental.incremental_merge``).

    The batch meets key and time of the buckets its keys fall into; what is fresh in it is written to the
    scratch folder once. Only buckets with fresh rows are then read whole and written anew, ``files`` files
    each. The bucket numbers come to the driver, at most ``buckets`` of them. A batch without fresh rows
    writes nothing. The number of buckets is fixed by the first load.
    """
    spark = batch.sparkSession
    if held is None:
        held = TableFiles(batch.schema, {}, {"key": key, "buckets": buckets})
    buckets = int(held.layout["buckets"])
    schema = _widened(held.schema, batch.schema)
    held = replace(held, schema=schema)
    named = batch.withColumn(BUCKET, bucket_of(key, buckets))

    def numbers(rows: DataFrame) -> list[str]:
        return sorted(str(r[0]) for r in rows.select(BUCKET).distinct().collect())

    candidates = held.read(spark, commits.root, [b for b in numbers(named) if b in held.parts])
    fresh = _filled(fresh_rows(candidates, batch, key, time), schema)
    path = scratch_dir(spark, "fresh")
    fresh.write.parquet(path)
    fresh = spark.read.schema(schema).parquet(path)
    touched = numbers(fresh.select(bucket_of(key, buckets).alias(BUCKET)))
    if not touched:
        return held
    rows = upsert(held.read(spark, commits.root, touched), fresh, key).withColumn(BUCKET, bucket_of(key, buckets))
    spread = F.pmod(F.xxhash64(key, F.lit(1)), F.lit(files))
    folder = _in_parts(commits, rows.repartition(BUCKET, spread), BUCKET)
    parts = {b: (f"{folder}/{BUCKET}={b}",) for b in touched}
    return replace(held, parts={**held.parts, **parts})


def merge_history(
    commits: Commits,
    held: TableFiles | None,
    source: DataFrame,
    key: str,
    checked: Sequence[str],
    run_at: Column,
    close_missing: bool = True,
) -> TableFiles:
    """The history ``held`` after a run at ``run_at`` (see ``scd2.merge_snapshot``).

    Closed versions are neither read nor written: a run joins the source with the open ones and adds the
    versions it closes as one more folder. A run that changes nothing leaves the files as they are.
    """
    spark = source.sparkSession
    if held is None:
        rows, schema = initial_snapshot(source, key, run_at), None
    else:
        schema = _widened(held.schema, source.schema)
        rows = changed_versions(replace(held, schema=schema).read(spark, commits.root, [OPEN]), source, key, checked, run_at, close_missing)
    closed, begun = F.col("dbt_valid_to").isNotNull(), F.col("dbt_valid_from") == run_at
    counted = Observation()
    rows = rows.withColumn(PART, F.when(closed, CLOSED).otherwise(OPEN)).observe(
        counted,
        F.count_if(closed).alias("closed"),
        F.count_if(~closed).alias("open"),
        F.count_if(begun & ~closed).alias("begun"),
    )
    folder = _in_parts(commits, rows, PART)
    found = counted.get
    schema = schema or T.StructType([f for f in rows.schema if f.name != PART])
    parts = dict(held.parts) if held else {}
    if held is None or found["closed"] or found["begun"] or schema != held.schema:
        parts[OPEN] = (f"{folder}/{PART}={OPEN}",) if found["open"] else ()
    if found["closed"]:
        parts[CLOSED] = (*parts.get(CLOSED, ()), f"{folder}/{PART}={CLOSED}")
    return TableFiles(schema, parts, {"key": key})
