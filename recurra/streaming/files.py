"""Bronze loads that read only files that came since the last load.

A load is a stream over the folder's files that ends when it has seen all of them. What it has seen is kept
in its checkpoint, and what it wrote in the log of its target folder, so a load that broke off is continued
by the next one without a record lost or doubled, and readers see whole batches only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.ndjson import BAD_LINE, MISTYPED, RECORD, parse_lines
from ..sources.provenance import add_provenance, new_run_id
from ..sources.tables import StageReport

#: Files stay unseen however old they are when a load first meets them.
OLDEST = "36500d"


def checkpoint_of(target: str) -> str:
    return f"{target.rstrip('/')}_checkpoint"


def load_new_files(
    spark: SparkSession,
    source_dir: str,
    target: str,
    schema: T.StructType,
    run_id: str | None = None,
    glob: str = "*.ndjson*",
    files_per_batch: int = 10_000,
    spread: int | None = None,
) -> StageReport:
    """Append the records of all files in ``source_dir`` that no load into ``target`` has read.

    Other files than ``glob`` names are ignored. Lines that hold no record are kept beside the records (see
    ``read_loaded``). The report counts what this load added; ``batches`` are those it wrote. Files are
    known by path, so one that changes after it was read is not read again.
    """
    run_id = run_id or new_run_id()
    texts = spark.readStream.format("text").options(
        pathGlobFilter=glob, maxFilesPerTrigger=files_per_batch, maxFileAge=OLDEST
    )
    rows = add_provenance(parse_lines(texts.load(source_dir), schema, spread), run_id).observe(
        "load",
        F.count_if(~F.col(BAD_LINE)).alias("loaded"),
        F.count_if(BAD_LINE).alias("bad_lines"),
        F.count_if(MISTYPED).alias("mistyped"),
    )
    before = _batches(spark, target)
    writer = rows.writeStream.format("parquet").partitionBy(BAD_LINE).option("checkpointLocation", checkpoint_of(target))
    stream = writer.trigger(availableNow=True).start(target)
    stream.awaitTermination()
    counts = {"loaded": 0, "bad_lines": 0, "mistyped": 0, "batches": _batches(spark, target) - before}
    for progress in stream.recentProgress:
        found = progress.observedMetrics.get("load")
        for name, n in found.asDict().items() if found else ():
            counts[name] += n
    return StageReport(target, counts, run_id)


def _batches(spark: SparkSession, target: str) -> int:
    """How many batches the target's log holds."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_of(target)}/commits")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return 0
    return sum(s.getPath().getName().isdigit() for s in files.listStatus(path))


def read_loaded(spark: SparkSession, target: str, schema: T.StructType, bad: bool = False) -> DataFrame:
    """Records of all loads so far, or the lines that held none with their file and load."""
    declared = [f for f in schema]
    kept = [
        T.StructField(RECORD, T.StringType()),
        T.StructField(MISTYPED, T.BooleanType()),
        T.StructField("_load_ts", T.TimestampType()),
        T.StructField("_source_file", T.StringType()),
        T.StructField("_row_hash", T.StringType()),
        T.StructField("_ingestion_run_id", T.StringType()),
        T.StructField(BAD_LINE, T.BooleanType()),
    ]
    rows = spark.read.schema(T.StructType([*declared, *kept])).parquet(target).filter(F.col(BAD_LINE) == bad).drop(BAD_LINE)
    return rows.select(F.col(RECORD).alias("line"), "_source_file", "_ingestion_run_id") if bad else rows
