"""Newline-delimited JSON files, plain or gzipped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD, MISTYPED, BAD_LINE = "_record", "_mistyped", "_bad_line"


def read_ndjson(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    spread: int | None = None,
) -> DataFrame:
    """Records of a file, folder or glob; without a schema Spark infers one in an extra pass.

    A gzip file is one task whatever its size. ``spread`` redistributes the parsed records so
    that what follows runs in that many tasks; leave it out for plain or many small files.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    # Provenance needs the file, and the file is only known before the records are moved.
    records = reader.json(path).withColumn("_source_file", F.col("_metadata.file_path"))
    return records if spread is None else records.repartition(spread)


def read_records(
    spark: SparkSession, path: str, schema: T.StructType, spread: int | None = None
) -> DataFrame:
    """Declared fields of every line beside the whole line, in one pass.

    ``_record`` is the line as it was read. ``_bad_line`` marks lines that hold no JSON object, and
    ``_mistyped`` records in which a declared field has a value of another type (NULL in its column,
    still there in ``_record``). Blank lines are left out.
    """
    return parse_lines(spark.read.text(path), schema, spread)


def parse_lines(texts: DataFrame, schema: T.StructType, spread: int | None = None) -> DataFrame:
    """The same for the lines of text files that were opened for reading, as a batch or as a stream."""
    corrupt = "_corrupt"
    lines = texts.select(
        F.col("value").alias(RECORD), F.col("_metadata.file_path").alias("_source_file")
    )
    lines = lines.filter(F.col(RECORD).rlike(r"\S"))
    lines = lines if spread is None else lines.repartition(spread)
    fields = T.StructType([*schema, T.StructField(corrupt, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    # What parses and begins with a brace is an object; its schema need not be written out for that.
    is_object = F.try_parse_json(RECORD).isNotNull() & F.col(RECORD).rlike(r"^\s*\{")
    parsed = lines.select(
        F.from_json(RECORD, fields, options).alias("_parsed"),
        RECORD,
        (~is_object).alias(BAD_LINE),
        "_source_file",
    )
    broken = F.col(f"_parsed.{corrupt}").isNotNull()
    return parsed.select(
        *[F.col(f"_parsed.`{f.name}`") for f in schema],
        RECORD,
        (broken & ~F.col(BAD_LINE)).alias(MISTYPED),
        BAD_LINE,
        "_source_file",
    )


def read_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Raw lines of every ``*.ndjson`` file in a folder with file name and resource type."""
    return (
        spark.read.option("pathGlobFilter", "*.ndjson")
        .text(folder)
        .select(
            F.col("_metadata.file_name").alias("file_name"),
            resource_type(F.col("_metadata.file_name")).alias("resource_type"),
            F.col("value").alias("line"),
        )
    )


def resource_type(file_name: Column) -> Column:
    """The file name up to its first dot."""
    return F.split_part(file_name, F.lit("."), F.lit(1))
