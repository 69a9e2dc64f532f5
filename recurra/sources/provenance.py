"""Provenance columns and the bronze load."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import record_hash, row_hash
from .ndjson import BAD_LINE, MISTYPED, RECORD, read_ndjson, read_records
from .tables import PACKED, StageReport, is_path, remove, stored_schema, write_table

PROVENANCE_COLUMNS = ("_load_ts", "_source_file", "_row_hash", "_ingestion_run_id")
# Beside the declared fields where these are read from raw lines: the whole record and a mark.
RAW_COLUMNS = (RECORD, MISTYPED)


def new_run_id() -> str:
    return f"bronze_{datetime.now(UTC):%Y%m%dT%H%M%SZ}"


def add_provenance(df: DataFrame, run_id: str, load_ts: Column | None = None) -> DataFrame:
    """Append load time, source file, content hash and run id.

    The hash covers the record alone, so an unchanged record hashes alike in every run. Where the
    whole record is at hand it is hashed with all its fields, else the columns are. A ``_source_file``
    already noted by the reader is kept, else the scan is asked for it.
    """
    record = [c for c in df.columns if c not in (*PROVENANCE_COLUMNS, *RAW_COLUMNS)]
    raw = [c for c in RAW_COLUMNS if c in df.columns]
    source = F.col("_source_file") if "_source_file" in df.columns else F.input_file_name()
    return df.select(
        *[F.col(f"`{c}`") for c in record],
        *raw,
        (F.current_timestamp() if load_ts is None else load_ts).alias("_load_ts"),
        source.alias("_source_file"),
        (record_hash(RECORD) if RECORD in raw else row_hash(record)).alias("_row_hash"),
        F.lit(run_id).alias("_ingestion_run_id"),
    )


def _shape(schema: T.StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema}


def ingest(
    spark: SparkSession,
    source_path: str,
    target_table: str,
    run_id: str | None = None,
    schema: T.StructType | None = None,
    spread: int | None = None,
    overwrite_schema: bool = False,
) -> StageReport:
    """Load one resource type into its bronze table.

    With a ``schema`` its fields become columns and the whole record stays beside them as text; without
    one, all fields are inferred in an extra pass. The columns stored by the first load must stay the
    same unless ``overwrite_schema``. Rows are counted while they are written. Lines that hold no record
    go to ``bad_lines(target_table)`` with their text. A folder is loaded in one pass; only for a table of
    the catalog is the source read again if it holds bad lines.
    """
    run_id = run_id or new_run_id()
    if schema is not None and is_path(target_table):
        rows = add_provenance(read_records(spark, source_path, schema, spread), run_id)
        _same_columns(spark, source_path, target_table, rows.drop(BAD_LINE).schema, overwrite_schema)
        loading = f"{target_table}_loading-{uuid.uuid4().hex}"
        report, stored = ingest_once(spark, source_path, loading, run_id, schema, spread)
        apart = spark.read.schema(stored).parquet(side(loading, True)) if report.rows["bad_lines"] else spark.createDataFrame([], stored)
        kept = apart.select(F.col(RECORD).alias("line"), "_source_file", "_ingestion_run_id")
        write_table(kept, bad_lines(target_table))
        _replace(spark, side(loading, False), target_table)
        remove(spark, loading)
        return StageReport(target_table, report.rows, run_id)
    counted = Observation()
    if schema is None:
        found = read_ndjson(spark, source_path, None, spread)
        bad, mistyped = F.lit(False), F.lit(False)
    else:
        found = read_records(spark, source_path, schema, spread)
        bad, mistyped = F.col(BAD_LINE), F.col(MISTYPED)
    found = found.observe(
        counted,
        F.count_if(~bad).alias("loaded"),
        F.count_if(bad).alias("bad_lines"),
        F.count_if(mistyped).alias("mistyped"),
    )
    rows = add_provenance(found.filter(~bad).drop(BAD_LINE), run_id)
    _same_columns(spark, source_path, target_table, rows.schema, overwrite_schema)
    write_table(rows, target_table)
    counts = dict(counted.get)
    if schema is not None:
        lines = read_records(spark, source_path, schema).filter(BAD_LINE) if counts["bad_lines"] else found.limit(0)
        kept = lines.select(F.col(RECORD).alias("line"), "_source_file", F.lit(run_id).alias("_ingestion_run_id"))
        write_table(kept, bad_lines(target_table))
    return StageReport(target_table, counts, run_id)


def _same_columns(spark: SparkSession, source: str, target: str, schema: T.StructType, overwrite_schema: bool) -> None:
    stored = stored_schema(spark, target)
    if stored is not None and not overwrite_schema and _shape(stored) != _shape(schema):
        raise ValueError(f"columns of {target} differ from those of {source}")


def _replace(spark: SparkSession, written: str, target: str) -> None:
    """Put a folder in the place of a table; a rename where the store can rename folders."""
    paths = spark._jvm.org.apache.hadoop.fs.Path
    source, place = paths(written), paths(target)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(place, True)
    files.mkdirs(place.getParent())
    if not files.rename(source, place):
        raise OSError(f"{written} could not be moved to {target}")


def ingest_once(
    spark: SparkSession,
    source_path: str,
    folder: str,
    run_id: str,
    schema: T.StructType,
    spread: int | None = None,
) -> tuple[StageReport, T.StructType]:
    """Load one resource type and set its bad lines apart, in a single pass and write.

    ``folder`` gets one folder for records (``side(folder, False)``) and, if there are any, one for lines
    that hold none (``side(folder, True)``). Also returns the schema of both.
    """
    counted = Observation()
    found = read_records(spark, source_path, schema, spread).observe(
        counted,
        F.count_if(~F.col(BAD_LINE)).alias("loaded"),
        F.count_if(BAD_LINE).alias("bad_lines"),
        F.count_if(MISTYPED).alias("mistyped"),
    )
    rows = add_provenance(found, run_id)
    rows.write.options(**PACKED).partitionBy(BAD_LINE).parquet(folder)
    counts, stored = dict(counted.get), T.StructType([f for f in rows.schema if f.name != BAD_LINE])
    if not counts["loaded"]:
        spark.createDataFrame([], stored).write.parquet(side(folder, False))
    return StageReport(side(folder, False), counts, run_id), stored


def side(folder: str, bad: bool) -> str:
    return f"{folder}/{BAD_LINE}={str(bad).lower()}"


def bad_lines(target_table: str) -> str:
    """Where the lines go that could not be loaded into a table."""
    return f"{target_table}_bad_lines"
