from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from recurra.operators.dimensions import dim_condition, dim_date, dim_organization, dim_patient
from recurra.operators.facts import join_current
from recurra.operators.incremental import incremental_merge, latest_per_key, newer_than_mark
from recurra.operators.scd2 import merge_snapshot

SOURCE = "patient_id string, address_city string, note string"


def at(text):
    return F.lit(text).cast("timestamp")


def run_all(spark, *runs):
    state = None
    for when, data in runs:
        state = merge_snapshot(
            state, spark.createDataFrame(data, SOURCE), "patient_id", ("address_city",), at(when)
        )
    return state


def test_versions_over_runs(spark, rows):
    state = run_all(
        spark,
        ("2020-01-01", [("a", "X", "1"), ("b", None, "1"), ("c", "X", "1")]),
        ("2021-01-01", [("a", "Y", "2"), ("b", None, "2"), ("d", "X", "2")]),
        ("2022-01-01", [("a", "Y", "3"), ("b", "X", "3"), ("c", "X", "3"), ("d", None, "3")]),
    )
    got = rows(
        state.select(
            "patient_id",
            "address_city",
            "note",
            F.year("dbt_valid_from").alias("since"),
            F.year("dbt_valid_to").alias("until"),
        )
    )
    assert got == sorted(
        [
            ("a", "X", "1", 2020, 2021),
            ("a", "Y", "2", 2021, None),  # a column that is not checked keeps its old value
            ("b", None, "1", 2020, 2022),
            ("b", "X", "3", 2022, None),
            ("c", "X", "1", 2020, 2021),  # gone
            ("c", "X", "3", 2022, None),  # and back
            ("d", "X", "2", 2021, 2022),
            ("d", None, "3", 2022, None),
        ],
        key=repr,
    )
    assert state.select("dbt_scd_id").distinct().count() == 8
    dim = dim_patient_like(state)
    assert {r.patient_id for r in dim.filter("since = 1900").collect()} == set("abcd")
    assert dim.filter("since = 1900").count() == 4


def dim_patient_like(state):
    others = (
        "gender birth_date race_code race_display ethnicity_code ethnicity_display "
        "marital_status_code address_state address_postal_code"
    )
    wide = state.select("*", *[F.lit(None).cast("string").alias(c) for c in others.split()])
    return dim_patient(wide).withColumn("since", F.year("valid_from"))


def test_missing_rows_may_stay_open(spark):
    first = spark.createDataFrame([("a", "X", "1")], SOURCE)
    state = merge_snapshot(None, first, "patient_id", ("address_city",), at("2020-01-01"))
    kept = merge_snapshot(
        state, first.limit(0), "patient_id", ("address_city",), at("2021-01-01"), close_missing=False
    )
    assert kept.filter("dbt_valid_to IS NULL").count() == 1


def test_a_new_source_column_and_a_repeated_key(spark):
    first = spark.createDataFrame([("a", "X", "1"), ("b", "X", "1")], SOURCE)
    state = merge_snapshot(None, first, "patient_id", ("address_city",), at("2020-01-01"))
    wider = spark.createDataFrame([("a", "Y", "1"), ("b", "X", "1")], SOURCE).withColumn("extra", F.lit("e"))
    merged = merge_snapshot(state, wider, "patient_id", ("address_city",), at("2021-01-01"))
    assert sorted((r.patient_id, r.address_city, r.extra or "") for r in merged.collect()) == [("a", "X", ""), ("a", "Y", "e"), ("b", "X", "")]
    with pytest.raises(Exception, match="not unique in the source: a"):
        merge_snapshot(state, first.union(first.filter("patient_id = 'a'")), "patient_id", ("address_city",), at("2021-01-01")).collect()


def test_calendar(spark):
    days = dim_date(spark)
    bounds = days.agg(F.count("*"), F.min("date_key"), F.max("date_key")).first()
    assert tuple(bounds) == (47482, 19000101, 20291231)
    leap = days.filter("date_key = 20240229").first()
    assert (leap.quarter, leap.month_name, leap.day_name, leap.day_of_week, leap.is_weekend) == (
        1, "February", "Thursday", 5, False,
    )


def test_conditions_without_code_are_left_out(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "z")], "snomed_code string, snomed_display string")
    (only,) = dim_condition(df).collect()
    assert (only.snomed_code, only.snomed_display, only.occurrence_count) == ("a", "y", 2)


def test_current_version_join(spark, rows):
    schema = "organization_id string, name string, valid_from timestamp, is_current boolean"
    versions = spark.createDataFrame([("o", "old", None, False), ("o", "new", None, True)], schema)
    facts = spark.createDataFrame([("1", "o"), ("2", "p"), ("3", None)], "id string, org string")
    got = join_current(facts, versions, "org", "organization_id", "name")
    assert rows(got, "id", "name") == [("1", "new"), ("2", None), ("3", None)]


OBS = "id string, t timestamp, v string"


def ts(df):
    return df.withColumn("t", F.col("t").cast("timestamp"))


def obs(spark, *data):
    return ts(spark.createDataFrame(data, "id string, t string, v string"))


def test_incremental_merge(spark, rows):
    target = obs(spark, ("a", "2024-01-02", "old"), ("b", "2024-01-03", "old"))
    batch = obs(
        spark,
        ("a", "2024-01-04", "first"),
        ("a", "2024-01-05", "last"),
        ("b", "2024-01-03", "at the mark"),
        ("c", "2024-01-01", "late"),
        ("d", None, "no time"),
        ("e", "2024-01-09", "new"),
    )
    loaded = incremental_merge(target, batch, "id", "t")
    everything = [("a", "last"), ("b", "old"), ("c", "late"), ("d", "no time"), ("e", "new")]
    assert rows(loaded, "id", "v") == everything
    assert rows(incremental_merge(loaded, batch, "id", "t"), "id", "v") == everything
    assert rows(incremental_merge(target.limit(0), batch, "id", "t"), "id").__len__() == 5
    merged = incremental_merge(target, batch, "id", "t", only_newer=True)
    assert rows(merged, "id", "v") == [("a", "last"), ("b", "old"), ("e", "new")]
    again = incremental_merge(merged, batch, "id", "t", only_newer=True)
    assert rows(again, "id", "v") == rows(merged, "id", "v")
    back = incremental_merge(target, batch, "id", "t", lookback=F.expr("INTERVAL 5 DAYS"), only_newer=True)
    assert ("c", "late") in rows(back, "id", "v")
    empty = target.limit(0)
    assert newer_than_mark(batch, empty, "t").count() == 0
    assert newer_than_mark(batch, empty, "t", when_empty=at("1900-01-01")).count() == 5


def test_latest_per_key_breaks_ties_by_content(spark, rows):
    df = obs(spark, ("a", "2024-01-01", "x"), ("a", "2024-01-01", "y"))
    assert rows(latest_per_key(df, "id", "t"), "id", "v") == [("a", "y")]


def test_organization_versions_are_not_back_dated(spark):
    columns = "organization_id name type_code type_display address_line address_city address_state address_postal_code phone"
    df = spark.createDataFrame([tuple("o23456789")], ", ".join(f"{c} string" for c in columns.split()))
    state = merge_snapshot(None, df, "organization_id", ("name",), at("2020-01-01"))
    row = dim_organization(state).first()
    assert row.valid_from.year == 2020 and row.is_current and len(row.organization_key) == 32
