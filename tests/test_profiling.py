from __future__ import annotations

import json
import random
import statistics
from collections import Counter
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from recurra.operators import profiling, sampling
from recurra.session import scratch_dir
from recurra.sources.ndjson import read_lines


def records(spark, tmp_path, name, data):
    path = tmp_path / f"{name}.ndjson"
    path.write_text("".join(json.dumps(r) + "\n" for r in data))
    return spark.read.json(str(path))


def test_period_statistics_over_generated_stays(spark):
    """Stays of 1 to 9 hours, one each quarter of an hour; every fifth start and seventh end is unusable."""
    draw = random.Random(11)
    first = datetime(2031, 3, 9, tzinfo=UTC)
    rows, starts, ends = [], [], []
    for i in range(60):
        begin = first + timedelta(minutes=15 * i)
        end = begin + timedelta(hours=draw.randint(1, 9))
        start_text, end_text = begin.strftime("%Y-%m-%dT%H:%M:%SZ"), end.strftime("%Y-%m-%dT%H:%M:%SZ")
        if i % 5 == 0:
            start_text = ("next week", "", None)[i % 3]
        else:
            starts.append(begin)
        if i % 7 == 0:
            end_text = "2031-13-40T99:00:00Z"
        else:
            ends.append(end)
        rows.append((("IMP", "AMB", "VR")[i % 3], "planned" if i % 4 else None, (start_text, end_text)))
    df = spark.createDataFrame(rows, "code string, status string, period struct<start:string,end:string>")
    df = df.select(F.struct("code").alias("class"), "status", "period")
    for r in profiling.period_statistics(df).collect():
        known = sorted(starts if r.period_field == "start" else ends)
        text = [str(x)[:19] for x in (known[0], statistics.median_low(known), statistics.median_high(known), known[-1])]
        assert (str(r.earliest), str(r.latest)) == (text[0], text[3])
        assert text[1] <= str(r["median"])[:19] <= text[2]
    counts = {(r.metric, r.value): r.frequency for r in profiling.encounter_distributions(df).collect()}
    assert counts == {("class", "IMP"): 20, ("class", "AMB"): 20, ("class", "VR"): 20, ("status", "planned"): 45}


@pytest.mark.parametrize("size", [1, 2, 7, 50, 501])
def test_exact_median_against_brute_force(spark, size):
    draw = random.Random(size)
    # A third of the values are equal, some are negative.
    values = [5_000_000 if i % 3 == 0 else draw.randrange(-(10**12), 10**13) for i in range(size)]
    rows = [("a", v) for v in [*values, None]] + [("b", v) for v in values[: size // 2]]
    got = profiling.exact_medians(spark.createDataFrame(rows, "k string, v long"), "k", "v")
    assert got["a"] == statistics.median(values)
    assert got.get("b") == (statistics.median(values[: size // 2]) if size > 1 else None)


def test_median_of_nothing(spark):
    assert profiling.exact_medians(spark.createDataFrame([], "k string, v long"), "k", "v") == {}


def test_patient_distributions_against_counting(spark):
    genders = ["female", "other", None, "male", "female", "female", "x-17"]
    births = ["1899-12-31", "1900-01-01", "2009-12-31", "2010-01-01", "", None, "31.12.1980"]
    rows = [(genders[i % 7], births[i % 5 if i % 2 else i % 7], "2020-05-05" if i % 8 == 3 else None) for i in range(70)]
    df = spark.createDataFrame(rows, "gender string, birthDate string, deceasedDateTime string")
    expected = Counter(("gender", g) for g, _, _ in rows if g)
    expected.update(("birth_decade", b[:3] + "0s") for _, b, _ in rows if b and len(b) == 10 and b[4] == "-")
    assert {(r.metric, r.value): r.frequency for r in profiling.patient_distributions(df).collect()} == expected
    assert profiling.deceased_share(df).first().deceased_pct == round(100 * sum(d is not None for _, _, d in rows) / 70, 1)


def test_most_common_conditions(spark):
    codings = "code struct<coding:array<struct<code:string,display:string>>>"
    lists = [[("k%d" % (i % 6), "name of k%d" % (i % 6))] for i in range(20)] + [[("k1", None), ("k9", "second coding")]] + [[], None]
    df = spark.createDataFrame([((x,),) for x in lists], codings)
    found = [tuple(r) for r in profiling.top_conditions(df).collect()]
    assert found[0] == ("k1", "name of k1", 5) and found[1:3] == [("k0", "name of k0", 4), ("k2", "name of k2", 3)]
    assert [n for _, _, n in found] == sorted((n for _, _, n in found), reverse=True) and len(found) == 6
    assert profiling.top_conditions(df, 2).count() == 2


def test_field_presence(spark, tmp_path):
    df = records(
        spark,
        tmp_path,
        "X",
        [
            {"id": "1", "a": {"b": [{"c": 1}, {"c": None}]}, "l": [["x"]]},
            {"id": "2", "a": {"b": []}, "l": None},
            {"id": "3", "a": None, "never": None, "l": [[]]},
        ],
    )
    got = {r.path: r.presence_pct for r in profiling.field_presence(df).collect()}
    assert got == {
        "id": 100.0, "a": 66.7, "a.b": 66.7, "a.b[]": 33.3, "a.b[].c": 33.3,
        "l": 66.7, "l[]": 66.7, "l[][]": 33.3,
    }


def test_counts_tag_known_resources(spark):
    df = spark.range(3)
    got = {r.resource_type: (r.total_records, r.bronze_plan) for r in profiling.record_counts({"Patient": df, "SupplyDelivery": df}).collect()}
    assert got == {"Patient": (3, "bronzed"), "SupplyDelivery": (3, "available-not-bronzed")}


@pytest.fixture
def export(tmp_path):
    """Nine people; person 4 has three visits, person 8 two equal readings, one reading is nobody's."""

    def lines(name, data):
        (tmp_path / name).write_text("".join(json.dumps(r) + "\n" for r in data) + "\n")

    lines("Patient.ndjson", [{"id": f"person.{i}"} for i in range(9)])
    visits = [i for i in range(9) for _ in range(3 if i == 4 else 1)]
    lines("Encounter.2.ndjson", [{"id": f"v{k}", "subject": {"reference": f"urn:uuid:person.{i}"}} for k, i in enumerate(visits)])
    reading = {"id": "same", "subject": {"reference": "Patient/person.8"}}
    lines("Observation.7.ndjson", [reading, reading, {"id": "person.8", "text": "person.8 and Patient/person.80"}])
    (tmp_path / "notes.txt").write_text("not a record file\n")
    return str(tmp_path)


def test_sample_is_written_under_the_source_names(spark, export):
    target = scratch_dir(spark, "sample")
    summary = {r.file_name: (r.records_in, r.records_kept) for r in sampling.write_sample(spark, export, target, 4).collect()}
    back = read_lines(spark, target).collect()
    chosen = {json.loads(r.line)["id"] for r in back if r.resource_type == "Patient"}
    assert len(chosen) == 4 and {r.file_name for r in back} <= set(summary)
    visits = [json.loads(r.line)["subject"]["reference"][9:] for r in back if r.file_name == "Encounter.2.ndjson"]
    assert sorted(visits) == sorted(i for i in chosen for _ in range(3 if i == "person.4" else 1))
    # The blank line at the end of each file counts as a line and is never kept.
    assert summary["Patient.ndjson"] == (10, 4) and summary["Encounter.2.ndjson"] == (12, len(visits))
    assert summary["Observation.7.ndjson"] == (4, 2 if "person.8" in chosen else 0)


def test_sample_is_stable_and_seeded(spark, export):
    ids = sampling.patient_ids(read_lines(spark, export))

    def draw(seed, n=5):
        return [r.id for r in sampling.sample_entities(ids, "id", n, seed).collect()]

    assert draw(1) == draw(1) and draw(1) != draw(2)
    assert len(draw(1, 99)) == 9 and draw(1, 0) == []


def test_lines_are_matched_by_whole_ids(spark, export):
    sample = spark.createDataFrame([("person.8",), ("person.4",)], "id string")
    marked = sampling.with_kept(read_lines(spark, export), sample)
    counts = {r.file_name: r.records_kept for r in sampling.sample_summary(marked).collect()}
    assert counts == {"Patient.ndjson": 2, "Encounter.2.ndjson": 4, "Observation.7.ndjson": 2}


def test_large_samples_are_met_by_a_join_and_many_lines_by_many_files(spark, export, monkeypatch):
    lines, sample = read_lines(spark, export), spark.createDataFrame([("person.8",), ("person.4",), (None,)], "id string")
    sent = sampling.with_kept(lines, sample)
    monkeypatch.setattr(sampling, "SENT_IDS", 1)
    joined = sampling.with_kept(lines, sample)
    assert joined.columns == sent.columns and joined.exceptAll(sent).count() == sent.exceptAll(joined).count() == 0
    target = scratch_dir(spark, "sample")
    sampling.write_named(sent.filter("kept"), target, rows_per_file=1)
    back = read_lines(spark, target)
    names = {r.file_name for r in back.collect()}
    assert any(n.startswith("Encounter.2.") and n.endswith(".ndjson") and n != "Encounter.2.ndjson" for n in names)
    kept = sent.filter("kept").select("resource_type", "line")
    assert back.select("resource_type", "line").exceptAll(kept).count() == 0 and back.count() == kept.count()
    assert sampling.with_kept(lines, sample.limit(0)).filter("kept").count() == 0


def test_times_that_flat_tables_lose(spark):
    texts = ["2024-01-01T00:00:00Z", "2024-01-01T00:00:00+02:00", "2024-01-01T00:00:00.5Z", "2024-01-01", "2024-01-01T00:00:00", "2024-02-30", "soon", None]
    records = spark.createDataFrame([((t, None),) for t in texts], "period struct<start:string,end:string>")
    got = {r.field: (r["read"], r.lost, r.malformed) for r in profiling.times_read(records, "period.start", "period.end").collect()}
    assert got == {"period.start": (2, 3, 2)}


def test_one_record_of_each_shape_is_walked(spark):
    """Records of one shape count through one of them; where a shape hides fields the record stands for itself."""
    texts = [json.dumps({"id": i, "a": [{"b": None}, {"c": str(i)}] if i % 2 else [], "d": None if i % 3 else {"x.y": i}}) for i in range(600)]
    texts += ['{"m": [{"p": 1}, 2]}', '{"m": [{"q": 1}, 2]}', '{"m": [{"p": 1}, 2]}', '{"a: BIGINT, b": 1}', '{"a": 1, "b": 1}', "[1]", "x", None]
    records = spark.createDataFrame([(t,) for t in texts], "r string")
    shapes = profiling._by_shape(records, "r").collect()
    assert sorted(r["_n"] for r in shapes) == [1, 1, 1, 2, 100, 100, 200, 200]
    share = {r.path: r.presence_pct for r in profiling.record_presence(records, "r").collect()}
    counts = {"id": 600, "a": 601, "b": 1, "a: BIGINT, b": 1, "a[]": 300, "a[].c": 300, "d": 200, "d.x.y": 200, "m": 3, "m[]": 3, "m[].p": 2, "m[].q": 1}
    assert share == {path: round(n * 100 / 605, 1) for path, n in counts.items()}
