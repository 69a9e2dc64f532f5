"""Roster, profile, retrieval, data tests."""

from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from recurra.operators import retrieval, serving
from recurra.operators.dimensions import dim_date
from recurra.operators.quality import GOLD_CHECKS, SILVER_CHECKS, Check, run_checks

ID_A, ID_B = "0a0a0a0a-0000-0000-0000-00000000000a", "0a0a0a0a-0000-0000-0000-00000000000b"


@pytest.fixture
def star(spark):
    fact = spark.createDataFrame(
        [
            ("k1", "a1", "e1", 20240101, 20240103, 48.0, 10, True, False, True),
            ("k2", "a2", "e2", 20240113, 20240114, 30.0, None, False, False, False),
            ("k3", "b1", "e3", 20240113, None, None, 0, True, True, False),
        ],
        """index_encounter_key string, patient_key string, index_encounter_id string,
           index_admission_date_key int, index_discharge_date_key int, index_length_of_stay_hours double,
           days_to_readmission int, was_readmitted_30d boolean, is_likely_transfer boolean,
           was_readmitted_30d_excl_transfers boolean""",
    )
    visits = spark.createDataFrame(
        [(k, "IMP") for k in ("k1", "k2", "k3")], "encounter_key string, encounter_class_code string"
    )
    people = spark.createDataFrame(
        [
            ("a1", ID_A, "female", "R", "E", "M", "1980-01-14"),
            ("a2", ID_A, "female", "R", "E", "S", "1980-01-14"),
            ("b1", ID_B, "male", "R", "E", None, "1990-01-01"),
            ("c1", "other", "male", "R", "E", None, "1990-01-01"),
        ],
        """patient_key string, patient_id string, gender string, race_display string,
           ethnicity_display string, marital_status_code string, birth_date string""",
    )
    return fact, visits, people, dim_date(spark)


def test_profiles(star):
    profiles = {r.patient_id: r for r in serving.entity_profiles(*star).collect()}
    assert set(profiles) == {ID_A, ID_B}
    a = profiles[ID_A]
    assert a.index_admission_date == "2024-01-13" and a.marital_status_code == "S"
    assert (a.age_at_admission, a.length_of_stay_days, a.ever_readmitted_30d) == (43, 1.3, True)
    b = profiles[ID_B]
    assert b.index_discharge_date is None and b.is_likely_transfer and not b.ever_readmitted_30d


def test_single_profile(star):
    (one,) = serving.entity_profile(ID_A.upper(), *star).collect()
    assert one.patient_id == ID_A and one.ever_readmitted_30d
    unknown = "0a0a0a0a-0000-0000-0000-0000000000ff"
    assert serving.entity_profile(unknown, *star).count() == 0
    for bad in ("not-a-uuid", "x' OR '1'='1", "", None):
        with pytest.raises(ValueError, match="not the UUID"):
            serving.entity_profile(bad, *star)


def test_roster_and_cohort(star):
    fact, _, people, _ = star
    got = serving.cohort_roster(fact, people, F.lit(date(2024, 6, 1)), n_patients=1).collect()
    assert [tuple(r) for r in got] == [(ID_A, "female", 44, 1)]
    cohort = serving.cohort(fact, people)
    assert {r.patient_id for r in cohort.collect()} == {ID_A, ID_B}


def test_notes(spark):
    schema = "id string, subject struct<reference:string>, date string, content array<struct<attachment:struct<data:string>>>"
    data = [
        ("n1", ("Patient/a",), "2024-01-01", [(("aGVsbG8=",),)]),
        ("n2", ("urn:uuid:a",), None, [(("",),)]),
        ("n3", ("urn:uuid:b",), None, []),
        ("n4", ("urn:uuid:b",), None, [(("aGk=",),)]),
    ]
    docs = spark.createDataFrame(data, schema)
    assert {(r.note_id, r.patient_id, r.note_text) for r in retrieval.notes(docs).collect()} == {
        ("n1", "a", "hello"),
        ("n4", "b", "hi"),
    }
    chosen = spark.createDataFrame([("b",)], "patient_id string")
    assert [r.note_id for r in retrieval.cohort_notes(docs, chosen).collect()] == ["n4"]


def _nearest(query, items, k, rounded=True):
    scored = sorted((sum((a - b) ** 2 for a, b in zip(query, v, strict=True)), i) for i, v in items)
    return [i for _, i in scored[:k]]


@pytest.fixture
def vectors():
    draw = random.Random(1)
    # Small integers, so that equal distances occur.
    return [
        ("hot" if i % 3 else f"e{i % 7}", i, [float(draw.randrange(4)) for _ in range(3)]) for i in range(200)
    ]


@pytest.mark.parametrize("hot_rows", [1, 50, 10**6])
def test_entity_topk_against_brute_force(spark, vectors, hot_rows):
    items = spark.createDataFrame(vectors, "entity string, item long, vector array<float>")
    asked = {e: [1.0, 2.0, 0.0] for e, _, _ in vectors} | {"empty": [0.0, 0.0, 0.0]}
    queries = spark.createDataFrame(list(asked.items()), "entity string, query_vector array<float>")
    found = retrieval.entity_topk(queries, items, "entity", "item", k=8, hot_rows=hot_rows)
    got = {}
    for r in sorted(found.collect(), key=lambda r: r["rank"]):
        got.setdefault(r.entity, []).append(r.item)
    expected = {
        e: _nearest(q, [(i, v) for x, i, v in vectors if x == e], 8) for e, q in asked.items() if e != "empty"
    }
    assert got == expected


@pytest.mark.parametrize(("blocks", "salts"), [(1, 1), (7, 3), (16, 64)])
def test_library_topk_against_brute_force(spark, vectors, blocks, salts):
    library = spark.createDataFrame([(i, v) for _, i, v in vectors], "item long, vector array<float>")
    asked = [(i, v) for _, i, v in vectors[:40]]
    queries = spark.createDataFrame(asked, "query long, query_vector array<float>")
    found = retrieval.library_topk(
        queries, library, "query", "item", k=4, blocks=blocks, salts=salts
    )
    got = {}
    for r in sorted(found.collect(), key=lambda r: r["rank"]):
        got.setdefault(r["query"], []).append(r.item)
    assert got == {i: _nearest(v, [(n, x) for _, n, x in vectors], 4) for i, v in asked}


def test_evidence_bundle(spark):
    profiles = spark.createDataFrame([("a",), ("b",)], "p string")
    notes = spark.createDataFrame([("a", 2, "n2"), ("a", 1, "n1")], "p string, rank int, note string")
    library = spark.createDataFrame([("a", 1, "g")], "p string, rank int, entry string")
    got = retrieval.evidence_bundle(profiles, notes, library, "p", "note", "entry")
    assert {r.p: (r.notes, r.guidelines) for r in got.collect()} == {"a": (["n1", "n2"], ["g"]), "b": (None, None)}


def test_corpus_upsert_is_idempotent(spark, rows):
    stored = spark.createDataFrame([("a", "old"), ("b", "old")], "id string, text string")
    batch = spark.createDataFrame([("b", "new"), ("c", "new"), ("c", "new")], "id string, text string")
    once = retrieval.corpus_upsert(stored, batch, "id")
    assert rows(once) == [("a", "old"), ("b", "new"), ("c", "new")]
    assert rows(retrieval.corpus_upsert(once, batch, "id")) == rows(once)


def test_declared_checks():
    assert (len(SILVER_CHECKS), len(GOLD_CHECKS)) == (34, 35)


def test_checks_count_failures(spark):
    tables = {
        "t": spark.createDataFrame(
            [("1", "x", 1.0), ("1", "y", -1.0), (None, "z", None), ("3", "z", -2.0)], "id string, c string, n double"
        ),
        "u": spark.createDataFrame([("1",)], "id string"),
    }
    checks = [
        Check("t", "id", "not_null"),
        Check("t", "id", "unique"),
        Check("t", "c", "accepted_values", "warn", values=("x",)),
        Check("t", "id", "relationships", to="u", field="id"),
        Check("t", "n", "expression_is_true", expression="n >= 0"),
        Check("u", "id", "unique"),
    ]
    got = {(r.table_name, r.test): (r.failures, r.status) for r in run_checks(tables, checks).collect()}
    assert got == {
        ("t", "not_null"): (1, "fail"),
        ("t", "unique"): (1, "fail"),
        ("t", "accepted_values"): (2, "warn"),
        ("t", "relationships"): (1, "fail"),
        ("t", "expression_is_true"): (2, "fail"),
        ("u", "unique"): (0, "pass"),
    }
