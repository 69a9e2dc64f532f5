from __future__ import annotations

import gzip
import json

import pytest
from pyspark.sql import functions as F

from recurra.session import prepare, scratch_dir
from recurra.sources.catalogue import RESOURCES, resource
from recurra.plans import queries
from recurra.plans.fixtures import Records
from recurra.plans.medallion import Medallion
from recurra.sources.ndjson import BAD_LINE, RECORD, read_ndjson, read_records
from recurra.sources.provenance import PROVENANCE_COLUMNS, add_provenance, bad_lines, ingest
from recurra.sources.schemas import declared_schema
from recurra.sources.tables import read_table


def people(spark):
    return spark.createDataFrame(
        [("1", "male", "1970-01-01"), ("2", "female", "1980-01-01"), ("3", None, "1990-01-01")],
        "id string, gender string, birthDate string",
    )


def test_adds_four_columns_and_keeps_the_record(spark):
    df = people(spark)
    out = add_provenance(df, "run-1")
    assert out.columns == [*df.columns, *PROVENANCE_COLUMNS]
    assert {r._ingestion_run_id for r in out.collect()} == {"run-1"}
    assert out.select("_load_ts").distinct().count() == 1


def test_hash_depends_on_the_record_only(spark):
    def hashes(run):
        return {r.id: r._row_hash for r in add_provenance(people(spark), run).collect()}

    assert hashes("a") == hashes("b") and len(set(hashes("a").values())) == 3


def test_catalogue():
    assert len(RESOURCES) == 14
    assert resource("MedicationRequest").table == "medication_request"
    assert resource("Organization").file_glob == "Organization.*.ndjson.gz"
    assert all(declared_schema(n) for n in ("Patient", "Observation", "DocumentReference"))


def test_ingest_is_idempotent_and_counts_rows(spark, tmp_path):
    source = tmp_path / "Patient.ndjson"
    source.write_text("".join(json.dumps({"id": str(i), "extra": {"x": i}}) + "\n" for i in range(5)))
    target = scratch_dir(spark, "bronze")
    for schema, fields in ((None, {"id", "extra"}), (declared_schema("Patient"), {"id", "birthDate"})):
        for first in (True, False):
            result = ingest(spark, str(source), target, "r", schema, spread=3, overwrite_schema=first)
            table = read_table(spark, target)
            assert result.rows["loaded"] == table.count() == 5
            assert fields <= set(table.columns)
            assert table.filter(F.col("_source_file").endswith("Patient.ndjson")).count() == 5


def test_other_columns_are_refused_unless_asked_for(spark, tmp_path):
    source, target = tmp_path / "x.ndjson", scratch_dir(spark, "bronze")
    source.write_text('{"id": "1"}\n')
    ingest(spark, str(source), target)
    source.write_text('{"id": 1}\n')
    with pytest.raises(ValueError, match="columns of"):
        ingest(spark, str(source), target)
    assert ingest(spark, str(source), target, overwrite_schema=True).rows["loaded"] == 1


def test_ingest_into_a_catalog_table(spark, tmp_path):
    source = tmp_path / "x.ndjson"
    source.write_text('{"id": "1"}\n')
    assert ingest(spark, str(source), "bronze_people").rows["loaded"] == 1
    assert read_table(spark, "bronze_people").first()._ingestion_run_id.startswith("bronze_")


def test_reads_gzip_globs(spark, tmp_path):
    spark.createDataFrame([("1",), ("2",)], "id string").write.option("compression", "gzip").json(
        str(tmp_path / "Organization.17.ndjson.gz")
    )
    df = read_ndjson(spark, str(tmp_path / "Organization.*.ndjson.gz"), declared_schema("Organization"))
    assert df.count() == 2


def test_whole_records_bad_lines_and_mistyped_values(spark, tmp_path):
    source, target = tmp_path / "Observation.ndjson", scratch_dir(spark, "bronze")
    lines = [
        '{"id":"1","issued":"a","valueQuantity":{"value":1.5}}',
        '{"issued":"b","id":"1","valueQuantity":{"value":1.5}}',
        '{"valueQuantity":{"value":1.5},"id":"1","issued":"a","note":null}',
        '{"id":"2","valueQuantity":{"value":"5.4"}}',
        '{"id":"3", broken',
        "[1, 2]",
        "",
    ]
    source.write_text("\n".join(lines) + "\n")
    report = ingest(spark, str(source), target, "r", declared_schema("Observation"))
    assert report.rows == {"loaded": 4, "bad_lines": 2, "mistyped": 1}
    rows = {r._record: r for r in read_table(spark, target).collect()}
    first, other, reordered, mistyped = (rows[x] for x in lines[:4])
    assert first._row_hash == reordered._row_hash != other._row_hash
    assert mistyped._mistyped and mistyped.valueQuantity.value is None and not first._mistyped
    assert {r.line for r in read_table(spark, bad_lines(target)).collect()} == set(lines[4:6])


def test_export_of_one_task_is_read_in_several(spark, tmp_path, monkeypatch):
    """A gzip file is one task, so a large type must not come as one file even if a single task wrote it."""
    monkeypatch.setattr(queries, "FILE_RECORDS", 10, raising=False)
    nations = spark.range(45).selectExpr("CAST(id AS INT) AS n_nationkey", "concat('n', id) AS n_name", "0 AS n_regionkey")
    nations.coalesce(1).write.parquet(str(tmp_path / "nation.parquet"))
    spark.createDataFrame([(0, "r")], "r_regionkey int, r_name string").write.parquet(str(tmp_path / "region.parquet"))
    source = queries._as_files(Records(spark, str(tmp_path)), ("Organization",))
    glob = f"{source}/{RESOURCES['Organization'].file_glob}"
    assert len(spark.read.text(glob).inputFiles()) >= 5
    report = ingest(spark, glob, scratch_dir(spark, "bronze"), "r", declared_schema("Organization"))
    assert report.rows["loaded"] == 45


def test_lines_that_are_no_object_are_bad(spark, tmp_path):
    good = ['{"id":"1"}', ' \t{"id":"2"}  ', "{}", '{"id":"3","a":[{"b":null}]}']
    bad = ["[1]", '"{"', "12", "null", "{", '{"id":"4"', "{'id':'5'}", '{"id":"6","id":"7"}', '\ufeff{"id":"8"}', '\u00a0{"id":"9"}', "x{}", '[{"id":"10"}]']
    source = tmp_path / "lines.ndjson"
    source.write_text("\n".join([*good, *bad, "", "  "]) + "\n")
    lines = read_records(spark, str(source), declared_schema("Patient"))
    schema = F.schema_of_variant(F.try_parse_json(RECORD))
    asked = lines.select(RECORD, BAD_LINE, F.coalesce(~schema.startswith("OBJECT"), F.lit(True)).alias("no_object")).collect()
    assert sorted(r[RECORD] for r in asked if not r[BAD_LINE]) == sorted(good)
    assert all(r[BAD_LINE] == r.no_object for r in asked) and len(asked) == len(good) + len(bad)

def test_tables_are_packed_and_written_unsorted(spark, tmp_path):
    """Whole records and hashes lie in several layers; two-sided writes need no sort of whole rows."""
    pq = pytest.importorskip("pyarrow.parquet")
    source, target = tmp_path / "x.ndjson", str(tmp_path / "bronze")
    source.write_text('{"id": "1"}\nno record\n')
    ingest(prepare(spark), str(source), target, "r", declared_schema("Patient"))
    files = [*(tmp_path / "bronze").glob("*.parquet"), *(tmp_path / "bronze_bad_lines").glob("*.parquet")]
    kinds = {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files if pq.ParquetFile(f).metadata.num_row_groups}
    assert kinds == {"ZSTD"}
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) >= 2


def test_run_may_drop_its_export_once_loaded(spark, tmp_path, monkeypatch):
    for stage in ("validate", "flatten", "snapshot", "gold"):
        monkeypatch.setattr(Medallion, stage, lambda self, *_: [])
    for drop in (False, True):
        source = tmp_path / f"export-{drop}"
        source.mkdir()
        (source / "Patient.ndjson.gz").write_bytes(gzip.compress(b'{"id": "1"}\n'))
        job = Medallion(spark, scratch_dir(spark, "run"))
        job.run(str(source), "2024-01-01", "r", names=("Patient",), drop_source=drop)
        assert source.exists() != drop and job.read("bronze", "patient").count() == 1
