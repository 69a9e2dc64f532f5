"""Loads of new files only."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from recurra.sources.provenance import bad_lines, ingest
from recurra.sources.schemas import declared_schema
from recurra.sources.tables import read_table
from recurra.streaming.files import load_new_files, read_loaded

@pytest.fixture
def schema(spark):
    return declared_schema("Organization")


def line(k):
    return f'{{"id":"{k}","name":"N{k}","extra":{k}}}'


@pytest.mark.parametrize("per_batch", [1, 100])
def test_a_load_reads_only_new_files(spark, tmp_path, schema, per_batch):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "a.ndjson").write_text(f"{line(1)}\n{line(2)}\nno record\n")
    (source / "b.ndjson").write_text(line(3))
    (source / "notes.txt").write_text(line(99))
    first = load_new_files(spark, str(source), target, schema, "one", files_per_batch=per_batch)
    assert first.rows == {"loaded": 3, "bad_lines": 1, "mistyped": 0, "batches": 2 if per_batch == 1 else 1}
    (source / "c.ndjson").write_text('{"id":"4","type":5}\n\n')
    second = load_new_files(spark, str(source), target, schema, "two", files_per_batch=per_batch)
    assert second.rows == {"loaded": 1, "bad_lines": 0, "mistyped": 1, "batches": 1}
    assert load_new_files(spark, str(source), target, schema, "three").rows["loaded"] == 0
    rows = read_loaded(spark, target, schema)
    assert sorted((r.id, r._ingestion_run_id) for r in rows.collect()) == [("1", "one"), ("2", "one"), ("3", "one"), ("4", "two")]
    assert [(r.line, r._ingestion_run_id) for r in read_loaded(spark, target, schema, bad=True).collect()] == [("no record", "one")]

    # The same content as one load of all the files.
    whole = str(tmp_path / "whole")
    ingest(spark, f"{source}/*.ndjson", whole, "all", schema)
    varying = ("_load_ts", "_ingestion_run_id")
    once = read_table(spark, whole).drop(*varying)
    assert rows.columns == read_table(spark, whole).columns
    assert once.exceptAll(rows.drop(*varying)).count() == rows.drop(*varying).exceptAll(once).count() == 0
    assert read_table(spark, bad_lines(whole)).count() == 1


def test_a_load_that_broke_off_is_continued(spark, tmp_path, schema):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for k in range(4):
        (source / f"{k}.ndjson").write_text(line(k))
    load_new_files(spark, str(source), target, schema, "one", files_per_batch=2)
    # A batch that was planned but not finished: its commit is taken away, as if the driver had stopped.
    (tmp_path / "out_checkpoint" / "commits" / "1").unlink()
    (tmp_path / "out_checkpoint" / "commits" / ".1.crc").unlink(missing_ok=True)
    load_new_files(spark, str(source), target, schema, "two", files_per_batch=2)
    ids = read_loaded(spark, target, schema).groupBy("id").agg(F.count("*").alias("n")).collect()
    assert {r.id: r.n for r in ids} == {str(k): 1 for k in range(4)}
