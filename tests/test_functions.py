from __future__ import annotations

from pyspark.sql import functions as F

from recurra.functions.codings import extension_value, first_where
from recurra.functions.keys import row_hash, surrogate_key
from recurra.functions.references import reference_id, target_id, trailing_id
from recurra.functions.times import age_years, iso_text, parse_instant, parse_iso
from recurra.functions.vectors import cosine, inner_product, squared_l2


def one(spark, column, **values):
    df = spark.range(1)
    for name, value in values.items():
        df = df.withColumn(name, F.lit(value))
    return df.select(column.alias("v")).first().v


def test_references(spark):
    cases = {
        "Patient/x": ("x", "x", "x"),
        "urn:uuid:x": ("x", "x", "x"),
        "Org?identifier=s|x": ("x", "Org?identifier=s|x", "Org?identifier=s|x"),
        "http://h/Patient/x": ("http://h/Patient/x", "http://h/Patient/x", "x"),
        "x": ("x", "x", "x"),
        None: (None, None, None),
    }
    for ref, expected in cases.items():
        df = spark.createDataFrame([(ref,)], "ref string")
        got = df.select(reference_id("ref"), target_id("ref"), trailing_id("ref")).first()
        assert tuple(got) == expected, ref


def test_instants(spark):
    cases = {
        "2024-01-02T03:04:05Z": ("2024-01-02 03:04:05", "2024-01-02T03:04:05Z"),
        "2024-01-02T03:04:05+10:00": ("2024-01-01 17:04:05", "2024-01-01T17:04:05Z"),
        "2024-01-02T03:04:05.250Z": (None, "2024-01-02T03:04:05.250000Z"),
        "2024-01-02": (None, "2024-01-02T00:00:00Z"),
        "2024-01-02T03:04:05": (None, "2024-01-02T03:04:05Z"),
        "2024-01-02T03": (None, "2024-01-02T03:00:00Z"),
        "2024-02-30T00:00:00Z": (None, None),
        "not-a-date": (None, None),
        None: (None, None),
    }
    for text, (strict, lenient) in cases.items():
        df = spark.createDataFrame([(text,)], "t string")
        got = df.select(parse_instant("t").cast("string"), iso_text(parse_iso("t"))).first()
        assert tuple(got) == (strict, lenient), text


def test_age_counts_whole_years(spark):
    day = F.lit("2024-06-15").cast("date")
    assert one(spark, age_years("b", day), b="1970-06-16") == 53
    assert one(spark, age_years("b", day), b="1970-06-14") == 54
    assert one(spark, age_years("b", day), b="nonsense") is None


def test_row_hash_ignores_null_fields_and_is_hex(spark):
    with_null = spark.createDataFrame([("1", None)], "id string, gender string")
    without = spark.createDataFrame([("1",)], "id string")
    a = with_null.select(row_hash(["id", "gender"]).alias("h")).first().h
    b = without.select(row_hash(["id"]).alias("h")).first().h
    assert a == b and len(a) == 64 and a == a.lower()


def test_surrogate_key_marks_nulls(spark):
    df = spark.createDataFrame([("a", None), ("a", "")], "x string, y string")
    keys = {r[0] for r in df.select(surrogate_key("x", "y")).collect()}
    assert len(keys) == 2


def test_tagged_lists_tolerate_missing_and_empty(spark):
    schema = """e array<struct<url:string,extension:array<struct<valueCoding:struct<code:string>>>>>,
                t array<struct<system:string,value:string>>"""
    data = [
        ([("x/us-core-race", [(("R1",),)])], [("phone", "1"), ("email", "m")]),
        ([("x/us-core-race", [])], [("phone", "1")]),
        ([], []),
        (None, None),
    ]
    df = spark.createDataFrame(data, schema)
    got = df.select(
        extension_value("e", "us-core-race", "code"),
        first_where("t", lambda x: x["system"] == "email")["value"],
    ).collect()
    assert [tuple(r) for r in got] == [("R1", "m"), (None, None), (None, None), (None, None)]


def test_distances(spark):
    df = spark.createDataFrame([([1.0, 2.0], [3.0, 0.0])], "a array<float>, b array<float>")
    l2, ip, cos = df.select(squared_l2("a", "b"), inner_product("a", "b"), cosine("a", "b")).first()
    assert l2 == 8.0 and ip == -2.0 and abs(cos - (1 - 3 / (5**0.5 * 3))) < 1e-12
