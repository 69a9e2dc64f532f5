"""Tables, addressed by a folder path or a catalog name."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


#: How tables are packed. Whole records and their hashes, kept in several layers, take half the room of snappy
#: with zstd, and a tenth less again with values written as differences and pages long enough to repeat themselves.
PACKED = {
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "9",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.page.size": str(8 << 20),
}


@dataclass(frozen=True)
class StageReport:
    """What a stage did with one table: where it wrote and how many rows went where."""

    target: str
    rows: dict[str, int]
    run_id: str | None = None


def is_path(target: str) -> bool:
    return "/" in target


def read_table(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target) if is_path(target) else spark.table(target)


def stored_schema(spark: SparkSession, target: str) -> T.StructType | None:
    """Schema of a table, or None where there is none yet."""
    try:
        return read_table(spark, target).schema
    except AnalysisException:
        return None


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """How much room a file or a folder takes."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()


def write_table(df: DataFrame, target: str, partition_by: tuple[str, ...] = ()) -> None:
    """Replace the table. The same input twice leaves the same table.

    A table must not be overwritten while the frame still reads it; jobs that build on an
    earlier state (snapshots, incremental loads) take a new target per run.
    """
    writer = df.write.mode("overwrite").options(**PACKED)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if is_path(target):
        writer.parquet(target)
    else:
        writer.format("parquet").saveAsTable(target)
