"""Registered queries against SQL, the whole job over two runs, and the plans behind them."""

from __future__ import annotations

import json
import os

import pytest
from compare import compare, duck
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from recurra.operators import facts
from recurra.operators.quality import GOLD_CHECKS, SILVER_CHECKS
from recurra.plans.medallion import Medallion
from recurra.plans.oracle_sql import ORACLE_SQL
from recurra.plans.queries import QUERIES
from recurra.session import scratch_dir
from recurra.sources.catalogue import RESOURCES
from recurra.sources.schemas import declared_schema

TABLES = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(TABLES), reason="test tables not present")


@pytest.fixture(scope="module")
def engine():
    return duck(TABLES)


@needs_tables
@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, engine, name):
    _, _, problem = compare(spark, engine, name, queries()[name], oracle_sql()[name], TABLES)
    assert problem is None


@needs_tables
def test_flagship(spark):
    assert entry(spark).count() == 1


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert QUERIES.keys() <= queries().keys() and ORACLE_SQL.keys() <= oracle_sql().keys()


def _export(folder, patients, stays, observations):
    """A small export with one file per resource type of the catalogue."""
    code = {"coding": [{"code": "c", "display": "d"}]}
    data = {name: [] for name in RESOURCES}
    data["Patient"] = [
        {"id": p, "gender": "male", "birthDate": "1980-01-01", "address": [{"city": city}], "extension": [],
         "maritalStatus": code}
        for p, city in patients.items()
    ]
    data["Encounter"] = [
        {"id": e, "status": "finished", "class": {"code": "IMP"}, "type": [code],
         "subject": {"reference": f"Patient/{p}"}, "period": {"start": start, "end": end}, "location": [],
         "participant": [], "serviceProvider": {"reference": "Organization?identifier=x|o1"}}
        for e, p, start, end in stays
    ]
    data["Observation"] = [
        {"id": o, "subject": {"reference": "Patient/p1"}, "effectiveDateTime": t} for o, t in observations
    ]
    data["Organization"] = [{"id": "o1", "name": "O", "type": [code], "address": [], "telecom": []}]
    data["Practitioner"] = [{"id": "d1", "name": [{"family": "F"}], "address": [], "telecom": []}]
    data["Claim"] = [{"id": "c1", "total": {"value": 1.5}}]
    for name, rows in data.items():
        path = folder / RESOURCES[name].file_glob.replace("*", "17").removesuffix(".gz")
        path.write_text("".join(json.dumps(r) + "\n" for r in rows or [{"id": "x"}]))
    return folder


def test_whole_job_over_two_runs(spark, tmp_path, monkeypatch):
    # The export is not compressed here.
    for name, r in list(RESOURCES.items()):
        monkeypatch.setitem(RESOURCES, name, type(r)(r.name, r.file_glob.removesuffix(".gz"), r.table))
    first, second = tmp_path / "first", tmp_path / "second"
    first.mkdir(), second.mkdir()
    stays = [
        ("e1", "p1", "2024-01-01T00:00:00Z", "2024-01-05T00:00:00Z"),
        ("e2", "p1", "2024-01-15T00:00:00Z", "2024-01-16T00:00:00Z"),
        ("bad", "p1", "yesterday", None),
    ]
    noon = "2024-01-01T12:00:00Z"
    _export(first, {"p1": "X", "p2": "X"}, stays, [("o1", noon)])
    one = Medallion(spark, scratch_dir(spark, "one"))
    report = one.run(str(first), "2024-02-01", "run-1")
    assert len(report.loads) == 14 and all(r.rows["loaded"] for r in report.loads)
    checked = {v.target.rsplit("/", 1)[1].removesuffix("_checked"): v for v in report.validations}
    assert checked["encounter"].rows == {"valid": 2, "held": 1}
    assert [r.id for r in one.valid("encounter", is_valid=False).collect()] == ["bad"]
    assert one.read("bronze", "claim").first().total.value == 1.5
    # Its only record is a stub without a patient.
    failed = {(r.table_name, r.column_name) for r in one.check().filter("status = 'fail'").collect()}
    assert failed == {("medication_request", "patient_id")}

    later = [*stays, ("e3", "p1", "2024-03-10T00:00:00Z", "2024-03-11T00:00:00Z")]
    _export(second, {"p1": "Y", "p2": "X"}, later, [("o1", noon), ("o2", "2024-01-02T12:00:00Z"), ("late", "2023-01-01T00:00:00Z")])
    two = Medallion(spark, scratch_dir(spark, "two"), previous=one.root)
    two.run(str(second), "2024-03-01", "run-2")
    versions = two.read("gold", "dim_patient")
    assert versions.count() == 3 and versions.filter("is_current").count() == 2
    visits = two.read("gold", "fact_encounter").join(
        versions.select("patient_key", "address_city"), "patient_key"
    )
    assert {r.encounter_id: r.address_city for r in visits.collect()} == {"e1": "X", "e2": "X", "e3": "Y"}
    outcome = {r.index_encounter_id: r.days_to_readmission for r in two.read("gold", "fact_readmission").collect()}
    assert outcome == {"e1": 10, "e2": 54, "e3": None}
    runs = {r.observation_id: r._bronze_ingestion_run_id for r in two.read("silver", "observation").collect()}
    assert runs == {"o1": "run-1", "o2": "run-2", "late": "run-2"}


def test_inferred_load_keeps_every_field(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(RESOURCES, "Patient", type(RESOURCES["Patient"])("Patient", "Patient.ndjson", "patient"))
    (tmp_path / "Patient.ndjson").write_text('{"id": "1", "identifier": [{"value": "v"}]}\n')
    job = Medallion(spark, scratch_dir(spark, "inferred"))
    job.bronze(str(tmp_path), "r", names=("Patient",), infer=True)
    assert "identifier" in job.read("bronze", "patient").columns
    assert "identifier" not in declared_schema("Patient").fieldNames()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "encounter")
    spark.range(10).select(
        F.col("id").cast("string").alias("encounter_id"),
        F.lit("p").alias("patient_id"),
        F.lit("IMP").alias("encounter_class_code"),
        F.current_timestamp().alias("start_time"),
        F.current_timestamp().alias("end_time"),
        F.lit("wide").alias("unused"),
    ).write.parquet(path)
    plan = _plan(facts.index_admissions(spark.read.parquet(path)))
    assert "EqualTo(encounter_class_code,IMP)" in plan
    assert "unused" not in plan
    # One exchange and one sort order the events; no cross join anywhere.
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@needs_tables
@pytest.mark.parametrize("name", ["fact_encounter", "fact_readmission", "entity_profile", "evidence_bundle"])
def test_no_cross_joins_and_no_python(spark, name):
    plan = _plan(queries()[name](spark, TABLES))
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEval", "BatchEvalPython"):
        assert forbidden not in plan


# The declared data tests of every table.
DECLARED = {
    ("silver", "patient"): """
        patient_id not_null
        patient_id unique
        gender accepted_values
        birth_date not_null
    """,
    ("silver", "encounter"): """
        encounter_id not_null
        encounter_id unique
        patient_id not_null
        patient_id relationships
        status accepted_values
        encounter_class_code accepted_values
        start_time not_null
        length_of_stay_hours expression_is_true
    """,
    ("silver", "condition"): """
        condition_id not_null
        condition_id unique
        patient_id not_null
        patient_id relationships
        snomed_code not_null
    """,
    ("silver", "procedure"): """
        procedure_id not_null
        procedure_id unique
        patient_id not_null
        patient_id relationships
        snomed_code not_null
    """,
    ("silver", "organization"): """
        organization_id not_null
        organization_id unique
    """,
    ("silver", "practitioner"): """
        practitioner_id not_null
        practitioner_id unique
    """,
    ("silver", "observation"): """
        observation_id not_null
        observation_id unique
        patient_id not_null
        patient_id relationships
    """,
    ("silver", "medication_request"): """
        medication_request_id not_null
        medication_request_id unique
        patient_id not_null
        patient_id relationships
    """,
    ("gold", "dim_date"): """
        date_key not_null
        date_key unique
        full_date not_null
        full_date unique
    """,
    ("gold", "dim_patient"): """
        patient_key not_null
        patient_key unique
        patient_id not_null
        is_current not_null
    """,
    ("gold", "dim_provider"): """
        provider_key not_null
        provider_key unique
        practitioner_id not_null
    """,
    ("gold", "dim_organization"): """
        organization_key not_null
        organization_key unique
        organization_id not_null
    """,
    ("gold", "dim_condition"): """
        condition_key not_null
        condition_key unique
        snomed_code not_null
        snomed_code unique
        occurrence_count not_null
    """,
    ("gold", "fact_encounter"): """
        encounter_key not_null
        encounter_key unique
        encounter_id not_null
        encounter_id unique
        patient_key not_null
        patient_key relationships
        admission_date_key not_null
        admission_date_key relationships
        organization_key relationships
    """,
    ("gold", "fact_readmission"): """
        readmission_key not_null
        readmission_key unique
        index_encounter_key not_null
        index_encounter_key relationships
        patient_key not_null
        patient_key relationships
        was_readmitted_30d not_null
    """,
}


def test_all_declared_data_tests_are_there():
    found = {}
    for layer, checks in (("silver", SILVER_CHECKS), ("gold", GOLD_CHECKS)):
        for c in checks:
            found.setdefault((layer, c.table), []).append(f"{c.column} {c.test}")
    assert found == {k: [x.strip() for x in v.strip().split("\n")] for k, v in DECLARED.items()}
    assert sum(map(len, found.values())) == 69
