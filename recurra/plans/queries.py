"""One runnable query per operator over a folder of test tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import row_hash, surrogate_key
from ..functions.references import reference_id, target_id, trailing_id
from ..functions.times import age_years, iso_text, parse_instant, parse_iso
from ..functions.vectors import text_vector
from ..operators import (
    dimensions,
    facts,
    incremental,
    profiling,
    quality,
    rates,
    retrieval,
    sampling,
    serving,
    silver,
    validation,
)
from ..operators.contracts import CONTRACTS
from ..operators.ordered import asof_in_order
from ..operators.parts import merge_buckets, merge_history
from ..operators.quality import Check
from ..operators.scd2 import CHECKED_COLUMNS, merge_snapshot
from ..session import prepare, scratch_dir, shuffles_dropped
from ..sources.catalogue import RESOURCES
from ..sources.commits import Commit, Commits, TableFiles
from ..sources.ndjson import RECORD, read_lines, read_ndjson
from ..sources.provenance import add_provenance, bad_lines, ingest
from ..sources.schemas import declared_schema
from ..sources.tables import StageReport, read_table, remove
from ..streaming.files import load_new_files, read_loaded
from .fixtures import NAMES, RUNS, Records
from .medallion import Medallion

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The day ages on a roster refer to.
AS_OF = "2002-01-01"


def query(build: Callable[[Records], DataFrame]) -> Callable[[Records], DataFrame]:
    """Register a query under its function's name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain(build(Records(prepare(spark), folder)))

    QUERIES[build.__name__] = run
    return build


def plain(df: DataFrame) -> DataFrame:
    """Times and days as text, lineage columns left out - a form every engine prints alike."""
    columns = []
    for f in df.schema:
        column = F.col(f"`{f.name}`")
        if f.name.startswith("_bronze"):
            continue
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            column = column.cast("string")
        columns.append(column.alias(f.name))
    return df.select(*columns)


class Star:
    """Flat tables and star schema over the records, built lazily on stored histories."""

    def __init__(self, records: Records):
        self.encounter = silver.encounter(records.encounter())
        with ThreadPoolExecutor(3) as pool:
            # Admissions need no history, so they are put in order meanwhile.
            admissions = pool.submit(facts.index_admissions, self.encounter, hot_rows=None)
            patients, organizations = pool.map(records.stored_history, ("patient", "organization"))
        self.dim_patient = dimensions.dim_patient(patients)
        self.dim_organization = dimensions.dim_organization(organizations)
        self.dim_date = dimensions.dim_date(records.spark)
        self.fact_encounter = facts.fact_encounter(
            self.encounter, self.dim_patient, self.dim_organization
        )
        self.fact_readmission = facts.fact_readmission(
            self.encounter, self.fact_encounter, admissions=admissions.result()
        )


# --- repeat events -------------------------------------------------------------------------


def _admissions(r: Records) -> DataFrame:
    return facts.index_admissions(silver.encounter(r.encounter()), hot_rows=None)


@query
def readmission_rate(r):
    return rates.readmission_rate(_admissions(r))


@query
def next_admission(r):
    return _admissions(r).select(
        "encounter_id", "patient_id", "admission_time", "next_admission_time", "next_encounter_id"
    )


@query
def fact_readmission(r):
    return Star(r).fact_readmission


@query
def rate_by_attribute(r):
    star = Star(r)
    return rates.rate_by_attribute(
        star.fact_readmission, star.dim_patient, ("gender", "address_state", "marital_status_code")
    )


# --- flat tables ---------------------------------------------------------------------------


@query
def silver_patient(r):
    return silver.patient(r.patient())


@query
def silver_encounter(r):
    return silver.encounter(r.encounter())


@query
def silver_lineage(r):
    """Where the rows of flat tables come from: load, file and run of their records, and a hash of each."""
    flat = {n: silver.FLATTENERS[n][1](r.records(silver.FLATTENERS[n][0])) for n in ("encounter", "observation", "patient", "practitioner")}
    whole = F.col("_bronze_row_hash").rlike("^[0-9a-f]{64}$")
    counts = [
        df.filter(whole)
        .groupBy(*(F.col(f"_bronze_{c}").alias(c) for c in ("load_ts", "source_file", "ingestion_run_id")))
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("table_name", F.lit(name))
        for name, df in flat.items()
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def silver_condition(r):
    return silver.condition(r.condition())


@query
def silver_procedure(r):
    return silver.procedure(r.procedure())


@query
def silver_observation(r):
    return silver.observation(r.observation())


@query
def silver_medication_request(r):
    return silver.medication_request(r.medication_request())


@query
def silver_organization(r):
    return silver.organization(r.organization())


@query
def silver_practitioner(r):
    return silver.practitioner(r.practitioner())


# --- contracts -----------------------------------------------------------------------------


def _errors(records: DataFrame, name: str) -> DataFrame:
    return validation.with_errors(records, CONTRACTS[name]).select(
        "id", F.col(validation.ERROR).alias("validation_error")
    )


@query
def contract_errors(r):
    return _errors(r.encounter(dirty=True), "Encounter")


@query
def contract_patient(r):
    return _errors(r.patient(dirty=True), "Patient")


@query
def contract_condition(r):
    return _errors(r.condition(dirty=True), "Condition")


@query
def contract_procedure(r):
    return _errors(r.procedure(dirty=True), "Procedure")


@query
def contract_organization(r):
    return _errors(r.organization(dirty=True), "Organization")


@query
def contract_practitioner(r):
    return _errors(r.practitioner(dirty=True), "Practitioner")


@query
def validated_encounters(r):
    return silver.encounter(validation.valid(r.encounter(dirty=True), CONTRACTS["Encounter"]))


@query
def quarantined_encounters(r):
    held = validation.quarantined(r.encounter(dirty=True), CONTRACTS["Encounter"])
    return held.select(
        "id", "status", "period.end", F.col(validation.ERROR).alias("validation_error")
    )


@query
def validation_summary(r):
    parts = [
        validation.summary(r.records(name, dirty=True), contract).withColumn("resource_type", F.lit(name))
        for name, contract in CONTRACTS.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# --- bronze --------------------------------------------------------------------------------


# How many records a file of an export holds at most, and how many record types are worked on at a time.
FILE_RECORDS, JOBS = 100_000, 4

# Bytes of tables up to which types are worked on side by side. Larger ones fill the cluster one by one, and
# then only one of them needs room at a time.
SMALL = 64 << 20


def _jobs(r: Records) -> int:
    return JOBS if r.size() <= SMALL else 1


def _as_files(r: Records, names: tuple[str, ...], dirty: bool = False) -> str:
    """The records as gzipped NDJSON below a scratch folder, named like the catalogue's globs."""
    root = scratch_dir(r.spark, "ndjson")

    def export(name: str) -> None:
        folder = RESOURCES[name].file_glob.replace("*", "1")
        body = r.records(name, dirty).select(*[f.name for f in declared_schema(name)])
        # A gzip file is a single task for whoever reads it.
        body.write.option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).json(f"{root}/{folder}")

    with ThreadPoolExecutor(JOBS) as pool:
        list(pool.map(export, names))
    return root


@query
def bronze_scan(r):
    source = _as_files(r, ("Patient",))
    back = read_ndjson(r.spark, f"{source}/Patient.ndjson.gz", declared_schema("Patient"))
    return silver.patient(back)


@query
def bronze_provenance(r):
    source = _as_files(r, ("Organization",))
    glob = f"{source}/{RESOURCES['Organization'].file_glob}"
    loaded = add_provenance(
        read_ndjson(r.spark, glob, declared_schema("Organization")), "bronze_test"
    )
    return loaded.select(
        "id",
        "name",
        F.col("_load_ts").isNotNull().alias("has_load_ts"),
        F.col("_source_file").contains("Organization.1.ndjson.gz").alias("has_source_file"),
        F.col("_row_hash").rlike("^[0-9a-f]{64}$").alias("has_row_hash"),
        F.col("_ingestion_run_id").alias("run_id"),
    )


@query
def row_hash_of_customers(r):
    customers = r.table("customer")
    return customers.select("c_custkey", row_hash(customers.columns).alias("row_hash"))


QUERIES["row_hash"] = QUERIES.pop("row_hash_of_customers")


def _loaded(r: Records) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Event lines with fields no schema declares, broken lines and a mistyped value, loaded to bronze."""
    event = F.col("event_id")
    number = F.when(event % 40 == 3, F.lit('"many"')).otherwise((event % 100).cast("string"))
    line = F.format_string('{"id":"%d","issued":"%s","valueQuantity":{"value":%s,"unit":"USD"}}', event, F.col("event_type"), number)
    broken = F.when(event % 50 == 7, F.substring(line, F.lit(1), F.length(line) - 3)).otherwise(line)
    source, target = scratch_dir(r.spark, "lines"), scratch_dir(r.spark, "bronze")
    r.table("events").select(broken).write.text(source)
    report = ingest(r.spark, source, target, "bronze_test", declared_schema("Observation"))
    return read_table(r.spark, target), read_table(r.spark, bad_lines(target)), report.rows


@query
def bronze_full_record(r):
    """Every field of a record is kept, declared or not, and changes its hash."""
    loaded, _, _ = _loaded(r)
    return loaded.select(
        "id",
        "valueQuantity.value",
        F.get_json_object("_record", "$.issued").alias("issued"),
        F.col("_mistyped").alias("mistyped"),
        F.col("_row_hash").alias("row_hash"),
    )


@query
def bronze_bad_lines(r):
    """Lines that are no record are kept as text and counted, as are records with mistyped values."""
    _, bad, counts = _loaded(r)
    texts = bad.select(F.lit("line").alias("kind"), F.col("line").alias("text"), F.lit(1).cast("long").alias("n"))
    counted = r.spark.createDataFrame([(k, None, n) for k, n in counts.items()], "kind string, text string, n long")
    return texts.unionByName(counted)


@query
def bronze_new_files(r):
    """Event lines that come in three files, loaded in three loads; the second finds two of them, the third none."""
    source, target = scratch_dir(r.spark, "arriving"), scratch_dir(r.spark, "bronze")
    schema = declared_schema("Observation")
    event = F.col("event_id")
    line = F.format_string('{"id":"%d","issued":"%s","valueQuantity":{"value":%d}}', event, F.col("event_type"), event % 100)
    lines = r.table("events").select(F.when(event % 50 == 7, "no record").otherwise(line).alias("value"), (event % 3).alias("file"))
    for number, files in enumerate(((0,), (1, 2), ())):
        for f in files:
            lines.filter(F.col("file") == f).select("value").coalesce(1).write.text(f"{source}/part-{f}.ndjson")
        # Spark names the files inside; the folders are what arrives.
        load_new_files(r.spark, f"{source}/*", target, schema, f"load-{number}", glob="*")
    rows = read_loaded(r.spark, target, schema).select("id", "valueQuantity.value", F.col("_ingestion_run_id").alias("run_id"))
    bad = read_loaded(r.spark, target, schema, bad=True).select(F.lit(None).cast("string"), F.lit(None).cast("double"), "_ingestion_run_id")
    return rows.union(bad)


@query
def bronze_default_run(r):
    """Run ids that a load makes up itself: one for all its rows, named by the time of the load."""
    source, target = scratch_dir(r.spark, "lines"), scratch_dir(r.spark, "bronze")
    _undeclared(r).write.text(source)
    report = ingest(r.spark, source, target, schema=declared_schema("Observation"))
    run_id = F.col("_ingestion_run_id")
    return read_table(r.spark, target).groupBy((run_id.rlike("^bronze_[0-9]{8}T[0-9]{6}Z$") & (run_id == report.run_id)).alias("named")).agg(
        F.countDistinct(run_id).alias("runs"), F.count(F.lit(1)).alias("rows")
    )


@query
def ingest_counts(r):
    """Every type is exported, loaded whole and counted; its files are scratch and go before the next one comes."""
    names = NAMES

    def load(n: str) -> StageReport:
        source, target = _as_files(r, (n,)), scratch_dir(r.spark, "bronze")
        report = ingest(
            r.spark,
            f"{source}/{RESOURCES[n].file_glob}",
            f"{target}/{RESOURCES[n].table}",
            "bronze_test",
            declared_schema(n),
        )
        for folder in (source, target):
            remove(r.spark, folder)
        return report

    # Types do not depend on each other; small ones run side by side.
    with shuffles_dropped(r.spark), ThreadPoolExecutor(_jobs(r)) as pool:
        loads = list(pool.map(load, names))
    rows = [(n, load.rows["loaded"]) for n, load in zip(names, loads, strict=True)]
    return r.spark.createDataFrame(rows, "resource_type string, row_count bigint")


# --- scalar functions ----------------------------------------------------------------------


def _references(r: Records) -> Column:
    key = F.col("c_custkey")
    text = key.cast("string")
    return (
        F.when(key % 6 == 0, F.concat(F.lit("Patient/"), text))
        .when(key % 6 == 1, F.concat(F.lit("urn:uuid:"), text))
        .when(key % 6 == 2, F.concat(F.lit("Organization?identifier=sys|"), text))
        .when(key % 6 == 3, F.concat(F.lit("http://host/Patient/"), text))
        .when(key % 6 == 4, text)
    )


@query
def scalar_fhir_id(r):
    ref = r.table("customer").select("c_custkey", _references(r).alias("reference"))
    return ref.select(
        "c_custkey",
        reference_id("reference").alias("flat_id"),
        trailing_id("reference").alias("note_id"),
    )


@query
def reference_target_id(r):
    ref = r.table("customer").select("c_custkey", _references(r).alias("reference"))
    return ref.select("c_custkey", target_id("reference").alias("target"))


@query
def scalar_fhir_timestamp(r):
    key, base = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    text = (
        F.when(key % 7 == 0, F.concat(base, F.lit("Z")))
        .when(key % 7 == 1, F.concat(base, F.lit("+10:00")))
        .when(key % 7 == 2, F.concat(base, F.lit(".250Z")))
        .when(key % 7 == 3, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(key % 7 == 4, base)
        .when(key % 7 == 5, F.lit("not-a-date"))
    )
    texts = r.table("orders").select("o_orderkey", text.alias("text"))
    return texts.select(
        "o_orderkey",
        parse_instant("text").alias("strict"),
        parse_iso("text").alias("lenient"),
        iso_text(parse_iso("text")).alias("iso"),
    )


@query
def surrogate_key_of_orders(r):
    at = F.col("o_orderdate").cast("timestamp")
    return r.table("orders").select(
        "o_orderkey",
        surrogate_key("o_custkey", at).alias("version_key"),
        surrogate_key(F.nullif("o_orderstatus", F.lit("P")), "o_orderkey").alias("null_part_key"),
    )


QUERIES["surrogate_key"] = QUERIES.pop("surrogate_key_of_orders")


@query
def dim_date(r):
    """Every day of the calendar with the number of orders placed on it."""
    days = r.table("orders").groupBy(F.col("o_orderdate").cast("date").alias("full_date"))
    placed = days.agg(F.count(F.lit(1)).alias("orders"))
    return dimensions.dim_date(r.spark).join(placed, "full_date", "left").fillna(0, ["orders"])


@query
def age_at_event(r):
    patients = silver.patient(r.patient()).select("patient_id", "birth_date")
    visits = silver.encounter(r.encounter()).select("encounter_id", "patient_id", "start_time")
    return visits.join(patients, "patient_id").select(
        "encounter_id", age_years("birth_date", "start_time").alias("age_years")
    )


# --- history, dimensions, facts ------------------------------------------------------------


@query
def scd2_snapshot(r):
    return r.history("patient").select(
        "patient_id",
        "marital_status_code",
        "last_visit",
        "dbt_valid_from",
        "dbt_valid_to",
        "dbt_scd_id",
    )


@query
def scd2_hard_delete(r):
    """Patients gone for good or for a while: versions that were closed without a successor."""
    versions = r.history("patient").select("patient_id", "dbt_valid_from", "dbt_valid_to")
    begun = versions.select("patient_id", F.col("dbt_valid_from").alias("dbt_valid_to"))
    closed = versions.filter("dbt_valid_to IS NOT NULL")
    return closed.join(begun, ["patient_id", "dbt_valid_to"], "left_anti")


@query
def scd2_new_column(r):
    """The history when the last run's source has a column that the runs before did not know."""
    state = None
    for run_at in RUNS[:-1]:
        state = merge_snapshot(state, r.patient_as_of(run_at), "patient_id", CHECKED_COLUMNS["patient"], F.lit(run_at).cast("timestamp"))
    source = r.patient_as_of(RUNS[-1]).withColumn("visit_note", F.concat(F.lit("seen "), "last_visit"))
    merged = merge_snapshot(state, source, "patient_id", CHECKED_COLUMNS["patient"], F.lit(RUNS[-1]).cast("timestamp"))
    return merged.select("patient_id", "dbt_valid_from", "dbt_valid_to", "visit_note")


def _parts_history(r: Records) -> tuple[Commits, Commit]:
    """The patients' history as parts, one commit per run, and what two more runs make of it.

    A run on the last run's source changes nothing; one without any patient breaks off before its commit.
    """
    commits = Commits(r.spark, scratch_dir(r.spark, "history"))
    commit = None

    def merged(source: DataFrame, run_at: str) -> TableFiles:
        held = commit.tables["patient"] if commit else None
        return merge_history(commits, held, source, "patient_id", CHECKED_COLUMNS["patient"], F.lit(run_at).cast("timestamp"))

    for run_at in (*RUNS, "2002-01-01"):
        files = merged(r.patient_as_of(min(run_at, RUNS[-1])), run_at)
        commit = commits.publish(run_at, {"patient": files}, commit)
    merged(r.patient_as_of(RUNS[-1]).limit(0), "2003-01-01")
    return commits, commits.newest()


@query
def scd2_parts(r):
    """The same history from open and closed parts; files of a run that broke off are not seen."""
    commits, commit = _parts_history(r)
    return commit.tables["patient"].read(r.spark, commits.root).select(
        "patient_id", "marital_status_code", "last_visit", "dbt_valid_from", "dbt_valid_to", "dbt_scd_id"
    )


@query
def scd2_parts_written(r):
    """Rows in the files of each part: a folder of closed versions per run that closed any, and one of open ones."""
    commits, commit = _parts_history(r)
    files = commit.tables["patient"]
    counts = [
        r.spark.read.schema(files.schema)
        .parquet(f"{commits.root}/{folder}")
        .agg(F.lit(part).alias("part"), F.max("dbt_valid_to").alias("closed_at"), F.count(F.lit(1)).alias("rows"))
        for part, folders in files.parts.items()
        for folder in folders
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def dim_patient(r):
    return dimensions.dim_patient(r.history("patient"))


@query
def dim_organization(r):
    return dimensions.dim_organization(r.history("organization"))


@query
def dim_provider(r):
    return dimensions.dim_provider(r.history("practitioner"))


@query
def dim_condition(r):
    return dimensions.dim_condition(silver.condition(r.condition()))


@query
def asof_patient_version(r):
    visits = silver.encounter(r.encounter()).select("encounter_id", "patient_id", "start_time")
    versions = dimensions.dim_patient(r.stored_history("patient")).select(
        "patient_id", "patient_key", "valid_from", "valid_to", "marital_status_code"
    )
    return asof_in_order(visits, versions, "patient_id", "start_time")


@query
def current_org_join(r):
    visits = silver.encounter(r.encounter()).select("encounter_id", "service_provider_id")
    versions = dimensions.dim_organization(r.stored_history("organization"))
    return facts.join_current(
        visits, versions, "service_provider_id", "organization_id", "organization_key", "name"
    )


@query
def fact_encounter(r):
    return Star(r).fact_encounter


@query
def role_playing_dates(r):
    star = Star(r)
    keys = star.fact_encounter.select("encounter_id", "admission_date_key", "discharge_date_key")
    return serving.with_role_dates(
        keys,
        star.dim_date,
        {"admission_date_key": "admission_date", "discharge_date_key": "discharge_date"},
    )


# --- data tests ----------------------------------------------------------------------------


@query
def dq_not_null(r):
    tables = {"encounter": silver.encounter(r.encounter(dirty=True))}
    columns = ("encounter_id", "patient_id", "start_time", "encounter_type_code")
    return quality.run_checks(tables, [Check("encounter", c, "not_null") for c in columns])


@query
def dq_unique(r):
    line = F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_id")
    tables = {
        "lineitem": r.table("lineitem").select(line),
        "encounter": silver.encounter(r.encounter()),
    }
    return quality.run_checks(
        tables, [Check("lineitem", "line_id", "unique"), Check("encounter", "encounter_id", "unique")]
    )


@query
def dq_accepted_values(r):
    tables = {
        "patient": silver.patient(r.patient(dirty=True)),
        "encounter": silver.encounter(r.encounter()),
    }
    checks = [c for c in quality.SILVER_CHECKS if c.test == "accepted_values"]
    return quality.run_checks(tables, checks)


@query
def dq_relationships(r):
    tables = {
        "encounter": silver.encounter(r.encounter()),
        "patient": silver.patient(r.patient()),
        "listed": r.patient_as_of(RUNS[0]),
    }
    return quality.run_checks(
        tables,
        [
            Check("encounter", "patient_id", "relationships", to="patient", field="patient_id"),
            Check("encounter", "patient_id", "relationships", "warn", to="listed", field="patient_id"),
        ],
    )


@query
def dq_expression(r):
    tables = {"observation": silver.observation(r.observation())}
    rule = "value_number >= 10 OR value_number IS NULL"
    return quality.run_checks(
        tables, [Check("observation", "value_number", "expression_is_true", "warn", expression=rule)]
    )


@query
def dq_report(r):
    """Every declared test over a full run from files, with contract violations in them."""
    job = Medallion(r.spark, scratch_dir(r.spark, "run"), jobs=_jobs(r))
    with shuffles_dropped(r.spark):
        _, tests = job.run_and_check(lambda n: _as_files(r, (n,), dirty=True), "2002-01-01", "bronze_test", names=NAMES)
    return tests


# --- incremental ---------------------------------------------------------------------------


@query
def observation_incremental(r):
    """A first load of the events before 20 January, then a load of everything it lacks."""
    source = silver.observation(r.observation()).withColumn(
        "load", F.lit("second")
    )
    early = F.col("effective_time") < F.lit("2024-01-20").cast("timestamp")
    target = source.filter(early).withColumn("load", F.lit("first"))
    merged = incremental.incremental_merge(target, source, "observation_id", "effective_time")
    return merged.select("observation_id", "patient_id", "effective_time", "value_number", "load")


@query
def observation_buckets(r):
    """The same two loads into buckets by key, of which a load writes those it changes; and both again, which change nothing."""
    source = silver.observation(r.observation()).withColumn("load", F.lit("second"))
    early = F.col("effective_time") < F.lit("2024-01-20").cast("timestamp")
    commits, commit = Commits(r.spark, scratch_dir(r.spark, "observations")), None
    first = source.filter(early).withColumn("load", F.lit("first"))
    for batch in (first, source, source, first):
        held = commit.tables["observation"] if commit else None
        files = merge_buckets(commits, held, batch, "observation_id", "effective_time", buckets=16)
        commit = commits.publish("load", {"observation": files}, commit)
    merged = files.read(r.spark, commits.root)
    return merged.select("observation_id", "patient_id", "effective_time", "value_number", "load")


@query
def observation_mark(r):
    """The strict high-water mark: events of every third user come late, and those not after the mark are lost."""
    source = silver.observation(r.observation()).withColumn("load", F.lit("second"))
    seen = F.col("effective_time") < F.lit("2024-01-20").cast("timestamp")
    target = source.filter(seen & (F.col("patient_id").cast("long") % 3 != 0)).withColumn("load", F.lit("first"))
    merged = incremental.incremental_merge(target, source, "observation_id", "effective_time", only_newer=True)
    return merged.select("observation_id", "patient_id", "effective_time", "value_number", "load")


@query
def corpus_upsert(r):
    """English documents are stored already; the others and the longer English ones are added."""
    docs = r.table("documents")
    stored = docs.filter("lang = 'en'").select(
        F.col("doc_id"), F.lit("stored").alias("origin"), F.md5("source").alias("digest")
    )
    batch = docs.filter("lang <> 'en' OR n_chars > 200").select(
        F.col("doc_id"), F.lit("added").alias("origin"), F.md5("text").alias("digest")
    )
    return retrieval.corpus_upsert(stored, batch, "doc_id", "digest")


# --- serving -------------------------------------------------------------------------------


@query
def cohort_roster(r):
    star = Star(r)
    return serving.cohort_roster(
        star.fact_readmission, star.dim_patient, F.lit(AS_OF).cast("date")
    )


@query
def patient_lookup(r):
    """The profile of one patient, asked for by a UUID in another spelling: the last one with an admission."""
    star = Star(r)
    digest = F.md5("patient_id")
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    named = star.dim_patient.withColumn("patient_id", F.concat_ws("-", *(F.substring(digest, a, n) for a, n in cuts)))
    admitted = star.fact_readmission.join(star.dim_patient, "patient_key").agg(F.max(F.col("patient_id").cast("long"))).first()[0]
    wanted = hashlib.md5(str(admitted).encode()).hexdigest().upper()
    return serving.entity_profile(f"{{{wanted}}}", star.fact_readmission, star.fact_encounter, named, star.dim_date)


@query
def cohort_notes(r):
    star = Star(r)
    patients = serving.cohort(star.fact_readmission, star.dim_patient)
    found = retrieval.cohort_notes(r.document_reference(), patients)
    return found.select(
        "note_id", "patient_id", "note_date", F.md5("note_text").alias("text_digest")
    )


@query
def entity_profile(r):
    star = Star(r)
    return serving.entity_profiles(
        star.fact_readmission, star.fact_encounter, star.dim_patient, star.dim_date
    )


# --- retrieval -----------------------------------------------------------------------------


def _kept(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written below the scratch folder and read back."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _first_vector(vectors: DataFrame, entity: str, item: str) -> DataFrame:
    """Per entity the vector of its first item, used as the entity's query."""
    return vectors.groupBy(entity).agg(F.min_by("vector", item).alias("query_vector"))


def _vectors(r: Records) -> DataFrame:
    return r.table("embeddings").select("label", "vec_id", F.col("embedding").alias("vector"))


def _library(r: Records) -> DataFrame:
    """All benchmark texts as library entries."""
    texts = r.table("benchmark").select(F.col("item_id").alias("entry_id"), text_vector("text").alias("vector"))
    return texts.filter("vector IS NOT NULL")


@query
def entity_topk(r):
    vectors = _vectors(r)
    found = retrieval.entity_topk(
        _first_vector(vectors, "label", "vec_id"), vectors, "label", "vec_id"
    )
    return found.withColumn("distance", F.round("distance", 6))


@query
def library_topk(r):
    # Vectors are made once, not again for every filter and bound on them.
    queries = _kept(r.table("documents").select("doc_id", text_vector("text").alias("query_vector")), "query-vectors")
    found = retrieval.library_search(queries, _library(r), "doc_id", "entry_id")
    return found.withColumn("distance", F.round("distance", 6))


def _note_searches(r: Records) -> tuple[DataFrame, DataFrame]:
    """The nearest notes and library entries of every patient's first note."""
    vectors = retrieval.notes(r.document_reference()).select(
        "patient_id", F.col("note_id").cast("long").alias("note_id"), text_vector("note_text").alias("vector")
    )
    # Notes are decoded and turned into vectors once; the searches read vectors.
    vectors = _kept(vectors, "note-vectors")
    queries = _first_vector(vectors, "patient_id", "note_id")
    entries = retrieval.library_search(queries, _library(r), "patient_id", "entry_id")
    return retrieval.entity_topk(queries, vectors, "patient_id", "note_id"), _kept(entries, "library-entries")


@query
def evidence_bundle(r):
    with ThreadPoolExecutor(1) as pool:
        # Searches need no facts: they run beside the histories, whose runs follow each other.
        searches = pool.submit(_note_searches, r)
        star = Star(r)
        profiles = serving.entity_profiles(
            star.fact_readmission, star.fact_encounter, star.dim_patient, star.dim_date
        ).select("patient_id", "gender", "ever_readmitted_30d")
        top_notes, top_library = searches.result()
    bundle = retrieval.evidence_bundle(
        profiles,
        top_notes,
        top_library,
        "patient_id",
        "note_id",
        "entry_id",
    )
    return bundle.withColumns(
        {c: F.array_join(F.col(c).cast("array<string>"), ",") for c in ("notes", "guidelines")}
    )


# --- profiling and sampling ----------------------------------------------------------------


@query
def profile_counts(r):
    return profiling.record_counts(
        {**{name: r.records(name) for name in NAMES}, "SupplyDelivery": r.table("part")}
    )


@query
def profile_presence(r):
    found = [
        profiling.field_presence(r.records(name)).withColumn("resource_type", F.lit(name)) for name in NAMES
    ]
    return reduce(DataFrame.unionByName, found)


def _undeclared(r: Records) -> DataFrame:
    """Observation lines of all orders with fields, arrays and nested values that no schema declares."""
    k = "o_orderkey"
    review = f"""CASE {k} % 5 WHEN 0 THEN NULL ELSE array(
        named_struct('by', o_orderpriority, 'grade', if({k} % 3 = 0, NULL, {k} % 7), 'marks', if({k} % 4 = 0, array({k} % 2, NULL), array())),
        if({k} % 2 = 0, NULL, named_struct('by', NULL, 'grade', NULL, 'marks', NULL))) END"""
    meta = f"""named_struct('source', if({k} % 6 = 0, NULL, named_struct('a.b', o_orderstatus, 'grid', array(array({k} % 9), array()))),
        'priority', nullif(o_orderpriority, '5-LOW'))"""
    line = F.expr(f"to_json(named_struct('id', CAST({k} AS STRING), 'status', 'final', 'meta', {meta}, 'review', {review}), map('ignoreNullFields', 'false'))")
    # A value that is an object in some records and a text in others, and one nested deeper than the rest.
    other = F.expr(f"""CASE {k} % 8 WHEN 1 THEN concat(',"extra":{{"x":', {k}, '}}') WHEN 2 THEN ',"extra":"none"'
        WHEN 3 THEN ',"extra":{{"l1":{{"l2":{{"l3":{{"l4":[[{{"l5":1}}]]}}}}}}}}' ELSE '' END""")
    parts = r.table("orders").select(line.alias("line"), other.alias("other"))
    return parts.select(F.expr("concat(left(line, length(line) - 1), other, '}')").alias("value"))


@query
def profile_presence_undeclared(r):
    """Presence of every field that loaded records hold, found without a schema and in passes of four levels."""
    source, target = scratch_dir(r.spark, "lines"), scratch_dir(r.spark, "bronze")
    _undeclared(r).write.text(source)
    ingest(r.spark, source, target, "bronze_test", declared_schema("Observation"))
    return profiling.record_presence(read_table(r.spark, target), RECORD, levels=4)


# The time fields of each record type that flat tables read.
TIMES = {
    "Encounter": ("period.start", "period.end"),
    "Observation": ("effectiveDateTime",),
    "Condition": ("onsetDateTime", "abatementDateTime", "recordedDate"),
    "Procedure": ("performedPeriod.start", "performedPeriod.end"),
    "MedicationRequest": ("authoredOn",),
}


@query
def profile_times(r):
    """Times that flat tables read, those that pass the contract and are lost there, and malformed ones."""
    found = [profiling.times_read(r.records(n, dirty=True), *fields).withColumn("resource_type", F.lit(n)) for n, fields in TIMES.items()]
    return reduce(DataFrame.unionByName, found)


@query
def profile_encounter(r):
    return profiling.encounter_distributions(r.encounter(dirty=True))


@query
def profile_period_stats(r):
    return profiling.period_statistics(r.encounter(dirty=True))


@query
def profile_patient(r):
    patients = r.patient(dirty=True)
    share = profiling.deceased_share(patients).select(
        F.lit("deceased_pct").alias("metric"),
        F.lit("all").alias("value"),
        F.col("deceased_pct").alias("amount"),
    )
    counts = profiling.patient_distributions(patients).select(
        "metric", "value", F.col("frequency").cast("double").alias("amount")
    )
    return counts.unionByName(share)


@query
def top_conditions(r):
    return profiling.top_conditions(r.condition())


@query
def sample_entities(r):
    return sampling.sample_entities(silver.patient(r.patient()), "patient_id")


def _raw_lines(r: Records) -> DataFrame:
    """Patient, encounter and observation records as lines of a raw export."""
    parts = []
    for name in ("Patient", "Encounter", "Observation"):
        fields = [f.name for f in declared_schema(name)]
        parts.append(
            r.records(name).select(
                F.lit(f"{name}.ndjson").alias("file_name"),
                F.lit(name).alias("resource_type"),
                F.to_json(F.struct(*fields)).alias("line"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _marked(r: Records) -> DataFrame:
    lines = _raw_lines(r)
    return sampling.with_kept(lines, sampling.sample_entities(sampling.patient_ids(lines), "id"))


@query
def sample_linked(r):
    return _marked(r).filter("kept").select(
        "file_name", F.get_json_object("line", "$.id").alias("id")
    )


@query
def sample_summary(r):
    return sampling.sample_summary(_marked(r))


@query
def sample_written(r):
    """The sample as files named like the export's, read back; a file of another kind takes no part."""
    export, target = scratch_dir(r.spark, "export"), scratch_dir(r.spark, "sample")
    other = r.table("region").select(F.lit("notes.txt").alias("file_name"), F.lit("Patient/1").alias("line"))
    sampling.write_named(_raw_lines(r).select("file_name", "line").unionByName(other), export)
    sampling.write_sample(r.spark, export, target)
    return read_lines(r.spark, target).select(
        "file_name", "resource_type", F.get_json_object("line", "$.id").alias("id")
    )
