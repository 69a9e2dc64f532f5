"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from recurra.session import scratch_dir

#: Words are runs of anything but these; the set is that of ``bytes.split``.
SPACE = r"[\x20\x09-\x0D]+"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str, batch_bytes: int | None = None) -> DataFrame:
    """``df`` written once below the shared scratch folder and read back: no lineage, real sizes.

    Nothing reads the shuffles of a written plan again, so Spark is told to delete them at its end. Batches that
    go to Python hold about ``batch_bytes``, if given: Spark holds each one twice beside its heap, Python once more.
    """
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, purpose)
    settings = {CLEANUP: "true"} | ({BATCH_BYTES: str(batch_bytes)} if batch_bytes else {})
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a ``stored`` frame that no later plan reads."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The id of a row; rows without one get a number above all ids, equal for equal texts."""
    stand_in = F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).bitwiseAND(F.lit((1 << 61) - 1))
    return F.coalesce(F.col(id_col).cast("long"), stand_in + F.lit(1 << 62))


def ranked(rows: DataFrame, group: str, order: list[Column], name: str, buckets: int = 1024) -> DataFrame:
    """A rank from 0 within ``group`` for every row, gapless, without one task holding a group.

    Rows of a group are ordered by a hash bucket of the ``order`` columns first and by those columns
    within the bucket; the ranks of a bucket start where the counts of the buckets before it end.
    """
    dealt = rows.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(group, "_bucket")
        .agg(F.count("*").alias("_n"))
        .select(
            F.col(group).alias("_group"),
            F.col("_bucket").alias("_b"),
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
        )
    )
    inside = F.row_number().over(Window.partitionBy(group, "_bucket").orderBy(*order))
    return (
        dealt.withColumn("_inside", inside)
        .join(starts, (F.col(group).eqNullSafe(F.col("_group"))) & (F.col("_bucket") == F.col("_b")))
        .withColumn(name, (F.col("_start") + F.col("_inside") - 1).cast("long"))
        .drop("_bucket", "_b", "_group", "_start", "_inside")
    )
