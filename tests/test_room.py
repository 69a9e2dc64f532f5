"""How much lies on disk at a time while the whole job runs."""

from __future__ import annotations

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from recurra.plans import queries
from recurra.plans.fixtures import NAMES, Records
from recurra.plans.medallion import Medallion
from recurra.session import prepare, scratch_dir, shuffles_dropped
from recurra.sources.catalogue import RESOURCES
from recurra.sources.tables import read_table, write_table

TABLES = {
    "region": (2, "CAST(id AS INT) AS r_regionkey", "concat('R', id) AS r_name"),
    "nation": (25, "CAST(id AS INT) AS n_nationkey", "concat('N', id) AS n_name", "CAST(id % 2 AS INT) AS n_regionkey"),
    "customer": (
        20, "id AS c_custkey", "concat('C', id) AS c_name", "CAST(id % 25 AS INT) AS c_nationkey",
        "1.5D AS c_acctbal", "'S' AS c_mktsegment",
    ),
    "supplier": (4, "id AS s_suppkey", "concat('S', id) AS s_name", "CAST(id AS INT) AS s_nationkey", "1.5D AS s_acctbal"),
    "part": (6, "id AS p_partkey", "'p' AS p_name", "concat('B', id % 3) AS p_brand", "'T' AS p_type"),
    "orders": (
        60, "id AS o_orderkey", "id % 20 AS o_custkey", "element_at(array('F', 'O', 'P'), CAST(id % 3 + 1 AS INT)) AS o_orderstatus",
        "2.5D AS o_totalprice", "TIMESTAMP_NTZ '2000-01-01 00:00:00' + make_interval(0, 0, 0, CAST(id * 9 AS INT)) AS o_orderdate",
        "if(id % 4 = 0, '5-LOW', '1-URGENT') AS o_orderpriority",
    ),
    "lineitem": (
        150, "id % 60 AS l_orderkey", "id % 6 AS l_partkey", "id % 4 AS l_suppkey", "CAST(id % 2 + 1 AS INT) AS l_linenumber",
        "'N' AS l_returnflag", "TIMESTAMP_NTZ '2000-03-01 00:00:00' + make_interval(0, 0, 0, CAST(id AS INT)) AS l_shipdate",
    ),
    "events": (
        40, "id AS event_id", "TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_interval(0, 0, 0, CAST(id AS INT)) AS ts",
        "id % 20 AS user_id", "element_at(array('view', 'click', 'error', 'purchase'), CAST(id % 4 + 1 AS INT)) AS event_type",
        "0.5D AS value", "'{}' AS props",
    ),
    "documents": (10, "id AS doc_id", "concat('text ', id) AS text"),
}
COUNTS = {
    "Patient": 20, "Encounter": 60, "Condition": 60, "Procedure": 60, "Observation": 40, "MedicationRequest": 60,
    "DocumentReference": 10, "Organization": 25, "Practitioner": 4,
}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    for name, (rows, *columns) in TABLES.items():
        spark.range(rows).selectExpr(*columns).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture
def scratch(spark):
    """What lies in the scratch folder and was not there when the test began."""
    root = Path(scratch_dir(prepare(spark), "here").removeprefix("file:")).parent
    before = set(root.glob("*"))
    return lambda pattern="*": {p for p in root.glob(pattern) if not before & {p, *p.parents}}


def _watched(monkeypatch, scratch, at: str, *patterns: str) -> list[set[str]]:
    """What matches at each call of a function of the queries, filled as these are called."""
    seen, call = [], getattr(queries, at)

    def watch(*args, **named):
        seen.append({p.name for pattern in patterns for p in scratch(pattern)})
        return call(*args, **named)

    monkeypatch.setattr(queries, at, watch)
    return seen


def test_large_types_lie_on_disk_one_at_a_time(spark, tables, scratch, monkeypatch):
    monkeypatch.setattr(queries, "SMALL", 0, raising=False)
    seen = _watched(monkeypatch, scratch, "ingest", "ndjson-*/*.gz", "bronze-*/*")
    counts = {r.resource_type: r.row_count for r in queries.QUERIES["ingest_counts"](spark, tables).collect()}
    assert counts == COUNTS
    assert seen == [{RESOURCES[name].file_glob.replace("*", "1")} for name in NAMES]
    assert not scratch()


def _shuffled(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ")
    return {b for b in blocks.split() if b.startswith("shuffle_")}


def test_shuffles_go_with_their_query(spark, tmp_path):
    numbers = spark.range(1000).groupBy(F.col("id") % 7).count()
    before = _shuffled(spark)
    with shuffles_dropped(spark):
        write_table(numbers, str(tmp_path / "x"))
    until = time.time() + 20
    while _shuffled(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not _shuffled(spark) - before
    assert read_table(spark, str(tmp_path / "x")).count() == 7
    write_table(numbers, str(tmp_path / "y"))
    assert _shuffled(spark) - before


def test_hashes_take_little_more_than_their_digits(spark, tmp_path):
    write_table(spark.range(20000).select(F.sha2(F.col("id").cast("string"), 256).alias("hash")).coalesce(1), str(tmp_path / "x"))
    assert sum(f.stat().st_size for f in (tmp_path / "x").glob("*.parquet")) < 20000 * 35


def test_tables_of_a_tested_run_go_once_read(spark, tables, scratch, monkeypatch):
    monkeypatch.setattr(queries, "SMALL", 0, raising=False)
    seen = _watched(monkeypatch, scratch, "_as_files", "ndjson-*/*", "run-*/*/*")
    tests = queries.QUERIES["dq_report"](spark, tables).collect()
    assert len(seen) == len(NAMES)
    assert seen[-1] <= {"patient", "organization", "practitioner", "dim_condition"}
    left = {f"{p.parent.name}/{p.name}" for p in scratch("run-*/*/*")}
    assert not scratch("ndjson-*") and not any(p.startswith("bronze/") or p.endswith("_checked") for p in left)
    assert {"gold/fact_encounter", "gold/fact_readmission", "silver/patient_snapshot"} <= left

    # The same results as of a run that keeps all its tables.
    whole = Medallion(spark, scratch_dir(spark, "whole"))
    whole.run(queries._as_files(Records(spark, tables), NAMES, True), "2002-01-01", "bronze_test", names=NAMES)
    kept = whole.check()
    assert tests == kept.collect() and len(tests) == 69
    assert any(r.failures for r in tests)
    assert whole.read("bronze", "condition").count() == COUNTS["Condition"]


def test_two_sided_writes_have_a_writer_to_spare(spark):
    """Spark begins to sort what is left of a task's rows once as many writers are open as it may have."""
    assert int(prepare(spark).conf.get("spark.sql.maxConcurrentOutputFileWriters")) > 2
