"""Clinical-shaped nested records derived from the retail test tables.

Every record comes from whole tables by fixed expressions, so each flat result has an
equivalent SQL query on the tables themselves. ``dirty=True`` breaks some records by key, for
the contract checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import silver
from ..operators.scd2 import CHECKED_COLUMNS, merge_snapshot
from ..session import scratch_dir
from ..sources.provenance import add_provenance
from ..sources.schemas import declared_schema
from ..sources.tables import stored_bytes, write_table

# Days of the snapshot runs; orders fall before, between and after them.
RUNS = ("1997-01-01", "1999-01-01", "2001-01-01")

NAMES = (
    "Patient", "Encounter", "Condition", "Procedure", "Observation", "MedicationRequest",
    "DocumentReference", "Organization", "Practitioner",
)

# The tables they are made of.
SOURCES = ("customer", "documents", "events", "lineitem", "nation", "orders", "part", "region", "supplier")

_INSTANT = "yyyy-MM-dd\\'T\\'HH:mm:ss"


def _text(time: str) -> str:
    return f"date_format({time}, '{_INSTANT}')"


def _concept(code: str, display: str) -> str:
    coding = f"named_struct('system', 'http://example.org/codes', 'code', {code}, 'display', {display})"
    return f"named_struct('coding', array({coding}), 'text', {display})"


def _extension(kind: str, code: str) -> str:
    coding = f"named_struct('system', 'urn:oid:1', 'code', {code}, 'display', concat('Group ', {code}))"
    inner = f"array(named_struct('url', 'ombCategory', 'valueCoding', {coding}))"
    return f"named_struct('url', 'http://example.org/us-core-{kind}', 'extension', {inner})"


def _address(line: str, postal_code: str) -> str:
    return f"""array(named_struct('line', array({line}), 'city', n_name, 'state', r_name,
                                  'postalCode', {postal_code}, 'country', 'US'))"""


def _patient_reference(key: str, patient: str) -> str:
    return f"""named_struct('reference',
        concat(if({key} % 2 = 0, 'Patient/', 'urn:uuid:'), CAST({patient} AS STRING)))"""


def _reference(prefix: str, key: str) -> str:
    return f"named_struct('reference', concat('{prefix}', CAST({key} AS STRING)))"


def _without_lineage(flat: DataFrame) -> DataFrame:
    return flat.select(*[c for c in flat.columns if not c.startswith("_bronze")])


class Records:
    """Nested records over one folder of test tables."""

    _schemas: dict[str, T.StructType] = {}

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._histories: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A test table; its schema is read from the file once."""
        path = f"{self.folder}/{name}.parquet"
        if path not in self._schemas:
            self._schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[path]).parquet(path)

    def size(self) -> int:
        """Bytes of the tables that records are made of."""
        return sum(stored_bytes(self.spark, f"{self.folder}/{name}.parquet") for name in SOURCES)

    def records(self, name: str, dirty: bool = False) -> DataFrame:
        """Records of a resource type; types without a contract have no broken variant."""
        build = {
            "Patient": self.patient,
            "Encounter": self.encounter,
            "Condition": self.condition,
            "Procedure": self.procedure,
            "Organization": self.organization,
            "Practitioner": self.practitioner,
        }.get(name)
        if build is not None:
            return build(dirty)
        return {
            "Observation": self.observation,
            "MedicationRequest": self.medication_request,
            "DocumentReference": self.document_reference,
        }[name]()

    def _shaped(self, df: DataFrame, resource: str, broken: dict[str, str] | None, **fields: str) -> DataFrame:
        """Fields in declared order and type plus fixed provenance.

        ``broken`` maps a field to the expression that takes its place in broken records.
        """
        texts = {**fields, **(broken or {})}
        shaped = df.selectExpr(
            *[
                f"CAST({texts[f.name]} AS {f.dataType.simpleString()}) AS `{f.name}`"
                for f in declared_schema(resource)
            ],
            f"'{resource}.ndjson' AS _source_file",
        )
        return add_provenance(shaped, "fixture", F.expr("TIMESTAMP '2024-01-01 00:00:00'"))

    def _sites(self) -> DataFrame:
        return self.table("nation").join(self.table("region"), F.expr("n_regionkey = r_regionkey"))

    def patient(self, dirty: bool = False) -> DataFrame:
        k = "c_custkey"
        gender = f"element_at(array('male', 'female', 'other', 'unknown'), CAST({k} % 4 + 1 AS INT))"
        birth = f"CAST(date_add(DATE '1930-01-01', CAST(({k} * 97) % 29000 AS INT)) AS STRING)"
        tags = f"""array({_extension('race', f"concat('R', {k} % 5)")},
                         {_extension('ethnicity', f"concat('E', {k} % 2)")})"""
        extension = f"slice({tags}, 1, if({k} % 13 = 0, 0, 2))"
        broken = {
            "gender": f"CASE WHEN {k} % 101 = 7 THEN NULL WHEN {k} % 103 = 9 THEN 'M' ELSE {gender} END",
            "birthDate": f"if({k} % 107 = 11, 'not-a-date', {birth})",
            "extension": f"if({k} % 109 = 13, NULL, {extension})",
        }
        return self._shaped(
            self.table("customer").join(self._sites(), F.expr("c_nationkey = n_nationkey")),
            "Patient",
            broken if dirty else None,
            id=k,
            gender=gender,
            birthDate=birth,
            deceasedDateTime=f"if({k} % 11 = 0, '2001-02-03T04:05:06Z', NULL)",
            address=_address(f"concat('Street ', {k})", "lpad(CAST(c_nationkey AS STRING), 5, '0')"),
            maritalStatus=_concept("c_mktsegment", "c_mktsegment"),
            extension=extension,
        )

    def encounter(self, dirty: bool = False) -> DataFrame:
        k = "o_orderkey"
        zone = f"if({k} % 2 = 0, 'Z', '+00:00')"
        start = f"concat({_text('o_orderdate')}, {zone})"
        ended = _text(f"o_orderdate + make_interval(0, 0, 0, CAST(1 + {k} % 5 AS INT))")
        end = f"concat({ended}, {zone})"
        period = f"named_struct('start', {start}, 'end', {end})"
        bad_period = f"named_struct('start', if({k} % 83 = 2, 'yesterday', {start}), 'end', {end})"
        type_ = f"array({_concept('o_orderstatus', 'o_orderpriority')})"
        subject = _patient_reference(k, "o_custkey")
        location = "array(named_struct('location', named_struct('display', 'Ward')))"
        broken = {
            "period": bad_period,
            "subject": f"if({k} % 97 = 5, NULL, {subject})",
            "type": f"if({k} % 89 = 3, NULL, {type_})",
            "location": f"if({k} % 79 = 4, array(NULL), {location})",
        }
        return self._shaped(
            self.table("orders"),
            "Encounter",
            broken if dirty else None,
            id=k,
            status="CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'in-progress' ELSE 'planned' END",
            type=type_,
            subject=subject,
            period=period,
            location=location,
            reasonCode=f"if({k} % 3 = 0, NULL, array({_concept("o_orderpriority", "'reason'")}))",
            hospitalization=f"""if({k} % 10 = 0,
                named_struct('dischargeDisposition', {_concept("'home'", "'Home'")}), NULL)""",
            serviceProvider=_reference("Organization?identifier=sys|", "o_custkey % 25"),
            participant="array(named_struct('individual', named_struct('reference', 'Practitioner/1')))",
            **{
                "class": """named_struct('system', NULL, 'code', CASE o_orderpriority WHEN '5-LOW' THEN 'EMER'
                    WHEN '4-NOT SPECIFIED' THEN 'AMB' ELSE 'IMP' END, 'display', NULL)"""
            },
        )

    def _lines(self) -> DataFrame:
        """One row per order line number, which the raw table repeats, with its customer."""
        lines = (
            self.table("lineitem")
            .groupBy("l_orderkey", "l_linenumber")
            .agg(
                F.expr("max(l_partkey) AS partkey"),
                F.expr("max(l_suppkey) AS suppkey"),
                F.expr("max(l_shipdate) AS shipdate"),
            )
        )
        orders = self.table("orders").select("o_orderkey", "o_custkey")
        return lines.join(self.table("part"), F.expr("partkey = p_partkey")).join(
            orders, F.expr("l_orderkey = o_orderkey")
        )

    _LINE_ID = "concat_ws('-', l_orderkey, l_linenumber)"
    _SHIPPED = f"concat({_text('shipdate')}, '+00:00')"
    _CODED = _concept("p_brand", "p_type")

    def condition(self, dirty: bool = False) -> DataFrame:
        k, line = "(l_orderkey + l_linenumber)", "l_linenumber"
        active = f"if({line} % 2 = 0, 'resolved', 'active')"
        category = f"array({_concept("'encounter-diagnosis'", "'Diagnosis'")})"
        broken = {
            "category": f"if({k} % 71 = 1, NULL, {category})",
            "onsetDateTime": f"if({k} % 73 = 2, '2024-02-30', {self._SHIPPED})",
            "code": f"if({k} % 67 = 3, NULL, {self._CODED})",
        }
        return self._shaped(
            self._lines(),
            "Condition",
            broken if dirty else None,
            id=self._LINE_ID,
            clinicalStatus=_concept(active, active),
            verificationStatus=_concept("'confirmed'", "'Confirmed'"),
            category=category,
            code=self._CODED,
            subject=_reference("urn:uuid:", "o_custkey"),
            encounter=_reference("Encounter/", "l_orderkey"),
            onsetDateTime=self._SHIPPED,
            abatementDateTime=f"if({line} % 2 = 0, concat({_text('shipdate + INTERVAL 10 DAYS')}, 'Z'), NULL)",
            recordedDate="date_format(shipdate, 'yyyy-MM-dd')",
        )

    def procedure(self, dirty: bool = False) -> DataFrame:
        k, line = "(l_orderkey + l_linenumber)", "l_linenumber"
        end = f"concat({_text(f'shipdate + make_interval(0, 0, 0, 0, CAST({line} AS INT))')}, 'Z')"
        bad_end = f"if({k} % 61 = 5, '2024-01-01T25:00:00Z', {end})"
        broken = {
            "performedPeriod": f"named_struct('start', {self._SHIPPED}, 'end', {bad_end})",
            "status": f"if({k} % 59 = 6, NULL, 'completed')",
        }
        return self._shaped(
            self._lines(),
            "Procedure",
            broken if dirty else None,
            id=self._LINE_ID,
            status="'completed'",
            code=self._CODED,
            subject=_reference("urn:uuid:", "o_custkey"),
            encounter=_reference("Encounter/", "l_orderkey"),
            performedDateTime="NULL",
            performedPeriod=f"named_struct('start', {self._SHIPPED}, 'end', {end})",
            reasonCode=f"if({line} % 3 = 0, array({self._CODED}), NULL)",
        )

    def medication_request(self) -> DataFrame:
        return self._shaped(
            self._lines(),
            "MedicationRequest",
            None,
            id=self._LINE_ID,
            status="'active'",
            intent="'order'",
            medicationCodeableConcept=self._CODED,
            subject=_reference("urn:uuid:", "o_custkey"),
            encounter=_reference("Encounter/", "l_orderkey"),
            authoredOn=self._SHIPPED,
            requester=_reference("Practitioner/", "suppkey"),
        )

    def observation(self) -> DataFrame:
        k, kind = "event_id", "event_type"
        quantity = "named_struct('value', value, 'unit', 'USD')"
        concept = _concept(kind, f"upper({kind})")
        pattern = f"if({k} % 50 = 0, '{_INSTANT}.SSSSSS', '{_INSTANT}')"
        return self._shaped(
            self.table("events"),
            "Observation",
            None,
            id=k,
            status="'final'",
            category=f"array({_concept("'survey'", "'Survey'")})",
            code=concept,
            subject=_patient_reference(k, "user_id"),
            encounter=_reference("Encounter/", k),
            effectiveDateTime=f"concat(date_format(ts, {pattern}), 'Z')",
            valueQuantity=f"if({kind} IN ('purchase', 'signup'), {quantity}, NULL)",
            valueCodeableConcept=f"if({kind} = 'view', {concept}, NULL)",
            valueString=f"if({kind} = 'click', props, NULL)",
            component=f"""if({kind} = 'error',
                array(named_struct('code', {concept}, 'valueQuantity', {quantity})), NULL)""",
        )

    def organization(self, dirty: bool = False) -> DataFrame:
        k = "n_nationkey"
        return self._shaped(
            self._sites(),
            "Organization",
            {"name": f"if({k} % 7 = 3, NULL, n_name)"} if dirty else None,
            id=k,
            name="n_name",
            type=f"array({_concept("'prov'", "'Healthcare Provider'")})",
            address=_address(f"concat('Main Street ', {k})", f"lpad(CAST({k} AS STRING), 5, '0')"),
            telecom=f"array(named_struct('system', 'phone', 'value', concat('555-', {k})))",
        )

    def practitioner(self, dirty: bool = False) -> DataFrame:
        k = "s_suppkey"
        telecom = f"""slice(array(
            named_struct('system', 'phone', 'value', '555'),
            named_struct('system', 'email', 'value', concat('p', {k}, '@example.org'))), 1, if({k} % 3 > 0, 2, 1))"""
        name = f"""array(named_struct('family', s_name, 'given', array(concat('Given', {k})),
                                      'prefix', array('Dr.')))"""
        broken = {
            "telecom": f"if({k} % 17 = 4, NULL, {telecom})",
            "name": f"if({k} % 19 = 5, NULL, {name})",
        }
        return self._shaped(
            self.table("supplier").join(self._sites(), F.expr("s_nationkey = n_nationkey")),
            "Practitioner",
            broken if dirty else None,
            id=k,
            name=name,
            gender=f"if({k} % 2 = 0, 'female', 'male')",
            address=_address("'Clinic'", "'00000'"),
            telecom=telecom,
        )

    def document_reference(self) -> DataFrame:
        """Documents as notes, dealt to all patients in turn."""
        patients = self.table("customer").agg(F.expr("greatest(1, count(1))")).scalar()
        documents = self.table("documents").withColumn("patient", F.col("doc_id") % patients)
        k = "doc_id"
        data = "base64(encode(text, 'UTF-8'))"
        return self._shaped(
            documents,
            "DocumentReference",
            None,
            id=k,
            subject=_patient_reference(k, "patient"),
            date=f"CAST(date_add(DATE '2024-01-01', CAST({k} % 365 AS INT)) AS STRING)",
            content=f"""array(named_struct('attachment',
                named_struct('contentType', 'text/plain', 'data', {data})))""",
        )

    def _last_before(self, run_at: str, key: Column) -> DataFrame:
        """Per key the last order of the two years before a day: ``key``, ``last``."""
        order = F.struct(
            F.col("o_orderdate").alias("at"),
            F.col("o_orderkey").alias("id"),
            F.col("o_orderstatus").alias("status"),
        )
        day = F.lit(run_at).cast("timestamp_ntz")
        recent = (F.col("o_orderdate") < day) & (
            F.col("o_orderdate") >= day - F.expr("INTERVAL 2 YEARS")
        )
        orders = self.table("orders").filter(recent)
        return orders.groupBy(key.cast("string").alias("key")).agg(F.max(order).alias("last"))

    def patient_as_of(self, run_at: str) -> DataFrame:
        """Flat patients as a source would have listed them on a day.

        Listed are those with an order in the two years before it. The marital code, which is
        under history, follows the last order's status (none for P); ``last_visit``, which is
        not, follows its day.
        """
        seen = self._last_before(run_at, F.col("o_custkey"))
        listed = _without_lineage(silver.patient(self.patient())).join(
            seen, F.col("patient_id") == F.col("key")
        )
        code = F.concat_ws("/", "marital_status_code", F.nullif("last.status", F.lit("P")))
        code = F.when(F.col("last.status") != "P", code)
        return (
            listed.withColumn("marital_status_code", code)
            .withColumn("last_visit", F.date_format("last.at", "yyyy-MM-dd"))
            .drop("key", "last")
        )

    def organization_as_of(self, run_at: str) -> DataFrame:
        """Flat organizations whose name carries the status of their last order."""
        seen = self._last_before(run_at, F.col("o_custkey") % 25)
        listed = _without_lineage(silver.organization(self.organization())).join(
            seen, F.col("organization_id") == F.col("key")
        )
        return listed.withColumn("name", F.concat_ws(" ", "name", "last.status")).drop("key", "last")

    def practitioner_as_of(self, run_at: str) -> DataFrame:
        """Flat practitioners with the return flag of their last shipped line as given name."""
        line = F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_returnflag")
        seen = (
            self.table("lineitem")
            .filter(F.col("l_shipdate") < F.lit(run_at).cast("timestamp_ntz"))
            .groupBy(F.col("l_suppkey").cast("string").alias("key"))
            .agg(F.max(line).alias("last"))
        )
        listed = _without_lineage(silver.practitioner(self.practitioner())).join(
            seen, F.col("practitioner_id") == F.col("key")
        )
        return listed.withColumn("given_name", F.col("last.l_returnflag")).drop("key", "last")

    def history(self, entity: str) -> DataFrame:
        """Snapshot state of an entity after all runs, each run's state written as a table."""
        listed = getattr(self, f"{entity}_as_of")
        root = scratch_dir(self.spark, f"{entity}-history")
        state = None
        for run_at in RUNS:
            merged = merge_snapshot(
                state,
                listed(run_at),
                f"{entity}_id",
                CHECKED_COLUMNS[entity],
                F.lit(run_at).cast("timestamp"),
            )
            write_table(merged, f"{root}/{run_at}")
            state = self.spark.read.schema(merged.schema).parquet(f"{root}/{run_at}")
        return state

    def stored_history(self, entity: str) -> DataFrame:
        """The same state, built once per query and then read as a stored table.

        Facts and profiles are built on a history that earlier snapshot runs have left behind.
        """
        if entity not in self._histories:
            self._histories[entity] = self.history(entity)
        return self._histories[entity]
