"""Commits, bucketed merges, histories in parts, runs that break off, and profiles of whole records."""

from __future__ import annotations

import glob
import json
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_plans import _export

from recurra.operators.incremental import incremental_merge
from recurra.operators.parts import CLOSED, OPEN, bucket_of, merge_buckets, merge_history
from recurra.operators.profiling import record_presence
from recurra.operators.scd2 import merge_snapshot
from recurra.plans.lake import CommittedRun, Lake
from recurra.sources.catalogue import RESOURCES
from recurra.sources.commits import Commits, TableFiles
from recurra.sources.provenance import ingest_once, side
from recurra.sources.schemas import declared_schema

DAY = datetime(2024, 1, 1)
ITEMS = "id string, at timestamp, v long"


def items(spark, rows, schema=ITEMS):
    return spark.createDataFrame(rows, schema)


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def data_files(root):
    return {p for p in glob.glob(f"{root}/data/**/*.parquet", recursive=True)}


# --- commits -----------------------------------------------------------------------------------------


def test_readers_see_only_what_was_committed(spark, tmp_path):
    commits = Commits(spark, str(tmp_path))
    assert commits.newest() is None and commits.numbers() == []
    rows = items(spark, [("a", DAY, 1)])

    def written(df):
        folder = commits.new_folder()
        df.write.parquet(f"{commits.root}/{folder}")
        return TableFiles(df.schema, {"p": (folder,)}, {"buckets": 3})

    first = commits.publish("one", {"t": written(rows)}, None)
    written(items(spark, [("lost", DAY, 2)]))
    assert content(commits.newest().tables["t"].read(spark, commits.root)) == [("a", DAY, 1)]
    again = commits.newest()
    assert (again.number, again.run_id, again.tables) == (1, "one", first.tables)
    second = commits.publish("two", {"t": written(items(spark, [("b", DAY, 2)]))}, again)
    # Whoever built on the first commit comes too late.
    with pytest.raises(RuntimeError, match="was published while late ran"):
        commits.publish("late", {}, first)
    assert commits.newest().run_id == "two" and len(os.listdir(tmp_path / "_commits")) == len([n for n in os.listdir(tmp_path / "_commits") if not n.startswith("_")])
    assert content(commits.get(1).tables["t"].read(spark, commits.root)) == [("a", DAY, 1)]
    assert commits.vacuum(keep=2, idle_seconds=3600) == []
    gone = commits.vacuum(keep=1, idle_seconds=-5)
    assert len(gone) == 2 and commits.numbers() == [second.number]
    assert content(commits.newest().tables["t"].read(spark, commits.root)) == [("b", DAY, 2)]
    assert TableFiles(rows.schema).read(spark, commits.root).count() == 0


# --- buckets -----------------------------------------------------------------------------------------


@pytest.mark.parametrize("buckets", [1, 7])
def test_bucket_merges_equal_whole_merges(spark, tmp_path, buckets):
    draw, commits = random.Random(buckets), Commits(spark, str(tmp_path))
    held, whole = None, items(spark, [])
    for size in (40, 1, 0, 25):
        batch = [
            (draw.choice([None, *map(str, range(60))]), draw.choice([None, DAY + timedelta(hours=draw.randint(0, 40))]), draw.randint(0, 9))
            for _ in range(size)
        ]
        batch = items(spark, batch + batch[:2])
        expected = content(incremental_merge(whole, batch, "id", "at"))
        before = dict(held.parts) if held else {}
        held = merge_buckets(commits, held, batch, "id", "at", buckets)
        assert content(held.read(spark, commits.root)) == expected
        ids = {str(r[0]) for r in batch.select(bucket_of("id", buckets)).collect()}
        assert {b for b in held.parts if held.parts[b] != before.get(b)} <= ids
        whole = items(spark, expected)


def test_a_load_writes_only_buckets_it_changes(spark, tmp_path):
    commits = Commits(spark, str(tmp_path))
    rows = items(spark, [(str(k), DAY, k) for k in range(500)])
    held = merge_buckets(commits, None, rows, "id", "at", buckets=50, files=1)
    before = data_files(tmp_path)
    assert merge_buckets(commits, held, rows, "id", "at", buckets=3) == held
    assert data_files(tmp_path) == before
    late = merge_buckets(commits, held, items(spark, [("7", DAY + timedelta(1), -1), ("8", DAY - timedelta(1), -1)]), "id", "at")
    new = data_files(tmp_path) - before
    assert len(new) == 1 and len(late.parts) == 50
    assert sum(late.parts[b] != held.parts[b] for b in late.parts) == 1
    assert content(late.read(spark, commits.root).filter("v < 0")) == [("7", DAY + timedelta(1), -1)]
    assert late.read(spark, commits.root).count() == 500
    # A column that is new in a batch is NULL in rows that were there before.
    wide = items(spark, [("9", DAY + timedelta(1), 5, "n")], f"{ITEMS}, note string")
    wider = merge_buckets(commits, late, wide, "id", "at")
    assert content(wider.read(spark, commits.root).filter("note IS NOT NULL OR id = '10'")) == [("10", DAY, 10, None), ("9", DAY + timedelta(1), 5, "n")]


# --- histories ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("close_missing", [True, False])
def test_history_in_parts_equals_one_table(spark, tmp_path, close_missing):
    draw, commits = random.Random(4), Commits(spark, str(tmp_path))
    held = state = None
    for run in range(5):
        names = "id string, a string, b string" + (", c string" if run > 2 else "")
        rows = [(str(k), draw.choice([None, "x", "y"]), draw.choice("pq"), "new") for k in range(20) if draw.random() < 0.8]
        source = items(spark, [r[: 3 + (run > 2)] for r in rows], names)
        at = F.lit(f"2024-01-0{run + 1} 00:00:00").cast("timestamp")
        merged = merge_snapshot(state, source, "id", ["a"], at, close_missing)
        state = spark.createDataFrame(merged.collect(), merged.schema)
        before = held
        held = merge_history(commits, held, source, "id", ["a"], at, close_missing)
        read = held.read(spark, commits.root)
        assert content(read.select(*state.columns)) == content(state)
        if before:
            assert held.parts.get(CLOSED, ())[: len(before.parts.get(CLOSED, ()))] == before.parts.get(CLOSED, ())
    closed = held.read(spark, commits.root, [CLOSED])
    assert closed.count() and closed.filter("dbt_valid_to IS NULL").count() == 0
    assert held.read(spark, commits.root, [OPEN]).filter("dbt_valid_to IS NOT NULL").count() == 0


def test_a_run_without_changes_leaves_the_files(spark, tmp_path):
    commits = Commits(spark, str(tmp_path))
    source = items(spark, [("1", "x"), ("2", None)], "id string, a string")
    at = [F.lit(f"2024-01-0{k} 00:00:00").cast("timestamp") for k in (1, 2, 3, 4)]
    first = merge_history(commits, None, source, "id", ["a"], at[0])
    assert merge_history(commits, first, source, "id", ["a"], at[1]) == first
    second = merge_history(commits, first, source.filter("id = '1'"), "id", ["a"], at[2])
    third = merge_history(commits, second, source.limit(0), "id", ["a"], at[3])
    assert third.parts[CLOSED][0] == second.parts[CLOSED][0] and len(third.parts[CLOSED]) == 2 and third.parts[OPEN] == ()
    assert third.read(spark, commits.root).count() == 2
    with pytest.raises(Exception, match="id is not unique in the source: 1"):
        merge_history(commits, third, source.union(source), "id", ["a"], at[3])


# --- whole runs --------------------------------------------------------------------------------------


def test_a_run_that_breaks_off_changes_nothing(spark, tmp_path, monkeypatch):
    for name, r in list(RESOURCES.items()):
        monkeypatch.setitem(RESOURCES, name, type(r)(r.name, r.file_glob.removesuffix(".gz"), r.table))
    first, second = tmp_path / "first", tmp_path / "second"
    first.mkdir(), second.mkdir()
    noon, stay = "2024-01-01T12:00:00Z", ("e1", "p1", "2024-01-01T00:00:00Z", "2024-01-05T00:00:00Z")
    _export(first, {"p1": "X", "p2": "X"}, [stay, ("bad", "p1", "yesterday", None)], [("o1", noon)])
    with open(glob.glob(str(first / "Patient*"))[0], "a") as patients:
        patients.write("no record\n")
    lake = Lake(spark, str(tmp_path / "lake"), buckets=4)
    with pytest.raises(ValueError, match="no complete run"):
        lake.read("gold", "dim_patient")
    report = lake.run(str(first), "2024-02-01", "run-1")
    assert {load.rows["bad_lines"] for load in report.loads if "bad_lines" in load.rows} == {0, 1}
    assert [r._record for r in lake.read("bronze", "patient_bad_lines").collect()] == ["no record"]
    assert [r.id for r in lake.held_back("encounter").collect()] == ["bad"]

    _export(second, {"p1": "Y"}, [stay, ("e2", "p1", "2024-01-15T00:00:00Z", "2024-01-16T00:00:00Z")], [("o1", noon), ("o2", "2023-01-02T12:00:00Z")])
    tables = [("silver", "observation"), ("silver", "patient_snapshot"), ("gold", "dim_patient"), ("gold", "fact_readmission")]
    old = {t: content(lake.read(*t)) for t in tables}
    write = CommittedRun._write

    def stop(self, df, layer, table):
        if table == "dim_patient":
            raise RuntimeError("executors lost")
        write(self, df, layer, table)

    with monkeypatch.context() as broken:
        broken.setattr(CommittedRun, "_write", stop)
        with pytest.raises(RuntimeError, match="executors lost"):
            lake.run(str(second), "2024-03-01", "run-2")
    assert lake.commits.numbers() == [1]
    assert {t: content(lake.read(*t)) for t in tables} == old

    lake.run(str(second), "2024-03-01", "run-2")
    versions = {(r.patient_id, r.address_city, r.is_current) for r in lake.read("gold", "dim_patient").collect()}
    assert versions == {("p1", "X", False), ("p1", "Y", True), ("p2", "X", False)}
    runs = {r.observation_id: r._bronze_ingestion_run_id for r in lake.read("silver", "observation").collect()}
    assert runs == {"o1": "run-1", "o2": "run-2"}
    assert {t: content(lake.read(*t, number=1)) for t in tables} == old
    assert lake.check().filter("status = 'fail'").count() == 1
    lake.commits.vacuum(keep=1, idle_seconds=-5)
    assert {r.observation_id for r in lake.read("silver", "observation").collect()} == {"o1", "o2"}


def test_bad_lines_are_set_apart_in_one_pass(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = ['{"id":"1","name":"A","x":{"y":1}}', "nothing", "", '{"id":7,"type":5}', "[1]"]
    (tmp_path / "in" / "Organization.ndjson").write_text("\n".join(lines))
    report, schema = ingest_once(spark, str(tmp_path / "in"), str(tmp_path / "out"), "r", declared_schema("Organization"))
    assert report.rows == {"loaded": 2, "bad_lines": 2, "mistyped": 1}
    read = lambda bad: spark.read.schema(schema).parquet(side(str(tmp_path / "out"), bad))
    assert sorted(r._record for r in read(False).collect()) == sorted([lines[0], lines[3]])
    assert sorted(r._record for r in read(True).collect()) == sorted([lines[1], lines[4]])
    (tmp_path / "in" / "Organization.ndjson").write_text("")
    report, schema = ingest_once(spark, str(tmp_path / "in"), str(tmp_path / "none"), "r", declared_schema("Organization"))
    assert report.rows["loaded"] == 0 and spark.read.schema(schema).parquet(side(str(tmp_path / "none"), False)).count() == 0


# --- presence over whole records ---------------------------------------------------------------------


def paths_of(value, prefix=""):
    found = set()
    if isinstance(value, dict):
        for key, inner in value.items():
            if inner is not None:
                name = f"{prefix}.{key}" if prefix else key
                found |= {name} | paths_of(inner, name)
    elif isinstance(value, list):
        for inner in value:
            if inner is not None:
                found |= {f"{prefix}[]"} | paths_of(inner, f"{prefix}[]")
    return found


def nested(draw, depth):
    kind = draw.random()
    if depth == 0 or kind < 0.3:
        return draw.choice([None, 1, "t", True, 1.5, {}, []])
    if kind < 0.7:
        return {draw.choice(["a", "b", "c.d", "", "é", 'q"[0]']): nested(draw, depth - 1) for _ in range(draw.randint(0, 3))}
    return [nested(draw, depth - 1) for _ in range(draw.randint(0, 3))]


@pytest.mark.parametrize("levels", [1, 2, 12])
def test_presence_of_whatever_records_hold(spark, levels):
    draw = random.Random(11)
    records = [{"id": k, "x": nested(draw, draw.randint(0, 6))} for k in range(60)]
    # The same path from a name with a dot and from nesting counts once for a record.
    records += [{"c.d": {"e": 1}, "c": {"d": {"e": 2}}}, {"m": [[[[[[{"n": None}], [1]]]]]]}, {}]
    texts = [json.dumps(r) for r in records] + ["[1]", "5", "nothing", None, ""]
    got = record_presence(spark.createDataFrame([(t,) for t in texts], "r string"), "r", levels)
    counts = {}
    for record in records:
        for path in paths_of(record):
            counts[path] = counts.get(path, 0) + 1
    assert {r.path: r.presence_pct for r in got.collect()} == {p: pytest.approx(100 * n / len(records), abs=0.051) for p, n in counts.items()}


def test_presence_of_nothing(spark):
    assert record_presence(spark.createDataFrame([], "r string"), "r").count() == 0
