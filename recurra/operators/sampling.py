"""A linked sample: some patients and every record that refers to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.ndjson import read_lines

# The two spellings of a patient reference inside a record.
PATIENT_TOKEN = r"(?:urn:uuid:|Patient/)([A-Za-z0-9\-.]+)"
#: A sample of so many ids is sent to the lines; of a larger one the ids of the lines meet it in a join.
SENT_IDS = 10_000
ROWS_PER_FILE = 1_000_000


def sample_entities(entities: DataFrame, key: str, n: int = 50, seed: int = 42) -> DataFrame:
    """``n`` ids in a random order fixed by ``seed``; a top-k, not a sort of everything."""
    if n <= 0:
        return entities.select(key).limit(0)
    order = F.md5(F.concat_ws("|", F.col(key), F.lit(str(seed))))
    return entities.select(key).filter(F.col(key).isNotNull()).orderBy(order, key).limit(n)


def patient_ids(lines: DataFrame) -> DataFrame:
    """Ids of the patient records among raw lines."""
    patients = lines.filter(F.col("resource_type") == "Patient")
    return patients.select(F.get_json_object("line", "$.id").alias("id")).filter("id IS NOT NULL")


def with_kept(lines: DataFrame, sample: DataFrame) -> DataFrame:
    """Append ``kept``: the line is a sampled patient, or refers to one.

    Ids are compared whole. A sample of at most ``SENT_IDS`` ids is looked up where the lines are read, and
    no line is moved. The ids that lines hold meet a larger one in a semi-join of ids and addresses, and what
    matched comes back by address: a digest of the line, equal for lines that are kept or not alike.
    """
    sent = [r.id for r in sample.select("id").filter("id IS NOT NULL").distinct().limit(SENT_IDS + 1).collect()]
    own = F.array_compact(F.array(F.get_json_object("line", "$.id")))
    referred = F.regexp_extract_all("line", F.lit(PATIENT_TOKEN), F.lit(1))
    ids = F.array_distinct(F.when(F.col("resource_type") == "Patient", own).otherwise(referred))
    if len(sent) <= SENT_IDS:
        kept = F.exists(ids, lambda x: x.isin(sent)) if sent else F.lit(False)
        return lines.withColumn("kept", F.coalesce(kept, F.lit(False)))
    keyed = lines.withColumn("_ids", ids)
    linked = keyed.filter(F.size("_ids") > 0).withColumn("_digest", F.sha2(F.concat_ws("\n", "resource_type", "line"), 256))
    matched = (
        linked.select("_digest", F.explode("_ids").alias("id"))
        .join(sample.select("id"), "id", "left_semi")
        .select("_digest", F.lit(True).alias("_matched"))
        .distinct()
    )
    told = linked.join(matched, "_digest", "left").select(*lines.columns, F.coalesce("_matched", F.lit(False)).alias("kept"))
    rest = keyed.filter("size(_ids) <= 0 OR _ids IS NULL").select(*lines.columns, F.lit(False).alias("kept"))
    return told.unionByName(rest)


def sample_summary(marked: DataFrame) -> DataFrame:
    """Records in, records kept and percentage per file."""
    return (
        marked.groupBy("file_name")
        .agg(F.count(F.lit(1)).alias("records_in"), F.count_if("kept").alias("records_kept"))
        .withColumn(
            "pct_kept", F.round(F.col("records_kept") * F.lit(100.0) / F.col("records_in"), 1)
        )
    )


def write_named(lines: DataFrame, target_dir: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write ``line`` below ``target_dir`` into files named by ``file_name``.

    Lines of a name above ``rows_per_file`` go to several files, each written by a task of its own; their
    number stands before the name's last part (``Patient.2.ndjson``), which leaves the record type as it is.
    """
    spark = lines.sparkSession
    sizes = lines.groupBy("file_name").agg(F.ceil(F.count(F.lit(1)) / rows_per_file).cast("int").alias("_files"))
    part = F.pmod(F.xxhash64("line"), F.col("_files")).cast("int")
    dealt = lines.join(sizes, "file_name").select("line", "file_name", "_files", part.alias("_part"))
    name, last = F.regexp_replace("file_name", r"\.[^.]*$", ""), F.regexp_extract("file_name", r"\.[^.]*$", 0)
    numbered = F.concat(name, F.lit("."), (F.col("_part") + 1).cast("string"), last)
    named = dealt.withColumn("file_name", F.when(F.col("_files") > 1, numbered).otherwise(F.col("file_name")))
    named.select("line", "file_name").repartition("file_name").write.mode("overwrite").partitionBy("file_name").text(target_dir)
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(target_dir).getFileSystem(spark._jsc.hadoopConfiguration())
    for written in files.globStatus(path(f"{target_dir}/file_name=*/part-*")) or ():
        folder = written.getPath().getParent()
        files.rename(written.getPath(), path(target_dir, folder.getName().removeprefix("file_name=")))
        files.delete(folder, True)


def write_sample(
    spark: SparkSession,
    source_dir: str,
    target_dir: str,
    n: int = 50,
    seed: int = 42,
    rows_per_file: int = ROWS_PER_FILE,
) -> DataFrame:
    """Write the sample below ``target_dir`` under the names of the source files and return the summary.

    Lines are written as they were read.
    """
    lines = read_lines(spark, source_dir)
    marked = with_kept(lines, sample_entities(patient_ids(lines), "id", n, seed))
    write_named(marked.filter("kept"), target_dir, rows_per_file)
    return sample_summary(marked)
