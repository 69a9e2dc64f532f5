"""The registered queries as plain SQL on the raw test tables, for comparison of results.

Written from what each result means on the raw tables, not from the Spark plans.
"""

from __future__ import annotations

from ..operators.quality import GOLD_CHECKS, SILVER_CHECKS, Check
from .fixtures import RUNS

TS = "'%Y-%m-%d %H:%M:%S'"
ISO = "'%Y-%m-%dT%H:%M:%SZ'"

# --- records as flat tables ----------------------------------------------------------------

_TEXT_VECTOR = "[" + ", ".join(
    f"(length(lower(text)) - length(replace(lower(text), '{x}', ''))) / length(lower(text))" for x in "etaoinsrhldcumfp"
) + "]"

PARTS = {
    "patient": """
        SELECT CAST(c_custkey AS VARCHAR) AS patient_id,
               ['male', 'female', 'other', 'unknown'][c_custkey % 4 + 1] AS gender,
               CAST(DATE '1930-01-01' + CAST((c_custkey * 97) % 29000 AS INT) AS VARCHAR) AS birth_date,
               CASE WHEN c_custkey % 11 = 0 THEN '2001-02-03T04:05:06Z' END AS deceased_date,
               c_mktsegment AS marital_status_code,
               CASE WHEN c_custkey % 13 <> 0 THEN 'R' || c_custkey % 5 END AS race_code,
               CASE WHEN c_custkey % 13 <> 0 THEN 'Group R' || c_custkey % 5 END AS race_display,
               CASE WHEN c_custkey % 13 <> 0 THEN 'E' || c_custkey % 2 END AS ethnicity_code,
               CASE WHEN c_custkey % 13 <> 0 THEN 'Group E' || c_custkey % 2 END AS ethnicity_display,
               n_name AS address_city, r_name AS address_state,
               lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS address_postal_code,
               'US' AS address_country, c_custkey
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "encounter": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS encounter_id,
               CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'in-progress' ELSE 'planned' END AS status,
               CASE o_orderpriority WHEN '5-LOW' THEN 'EMER' WHEN '4-NOT SPECIFIED' THEN 'AMB' ELSE 'IMP' END
                   AS encounter_class_code,
               CASE o_orderpriority WHEN '5-LOW' THEN 'emergency' WHEN '4-NOT SPECIFIED' THEN 'ambulatory'
                   ELSE 'inpatient encounter' END AS encounter_class_display,
               o_orderstatus AS encounter_type_code, o_orderpriority AS encounter_type_display,
               CAST(o_custkey AS VARCHAR) AS patient_id,
               CAST(o_orderdate AS TIMESTAMP) AS start_time,
               CAST(o_orderdate AS TIMESTAMP) + to_days(CAST(1 + o_orderkey % 5 AS INT)) AS end_time,
               CAST(o_custkey % 25 AS VARCHAR) AS service_provider_id,
               CASE WHEN o_orderkey % 10 = 0 THEN 'home' END AS discharge_disposition_code,
               CASE WHEN o_orderkey % 10 = 0 THEN 'Home' END AS discharge_disposition_display,
               CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS reason_code,
               CASE WHEN o_orderkey % 3 <> 0 THEN 'reason' END AS reason_display,
               CAST(24 * (1 + o_orderkey % 5) AS DOUBLE) AS length_of_stay_hours, o_orderkey
        FROM orders""",
    "line": """
        SELECT l_orderkey || '-' || l_linenumber AS id, CAST(o_custkey AS VARCHAR) AS patient_id,
               CAST(l_orderkey AS VARCHAR) AS encounter_id, p_brand AS code, p_type AS display,
               CAST(shipdate AS TIMESTAMP) AS shipped, l_orderkey, l_linenumber,
               CAST(suppkey AS VARCHAR) AS requester_id
        FROM (SELECT l_orderkey, l_linenumber, max(l_partkey) AS partkey, max(l_suppkey) AS suppkey,
                     max(l_shipdate) AS shipdate
              FROM lineitem GROUP BY l_orderkey, l_linenumber)
        JOIN part ON partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey""",
    "condition": """
        SELECT id AS condition_id, patient_id, encounter_id, code AS snomed_code, display AS snomed_display,
               CASE WHEN l_linenumber % 2 = 0 THEN 'resolved' ELSE 'active' END AS clinical_status,
               'confirmed' AS verification_status, 'encounter-diagnosis' AS category_code,
               shipped AS onset_time,
               CASE WHEN l_linenumber % 2 = 0 THEN shipped + INTERVAL 10 DAYS END AS abatement_time,
               CAST(NULL AS TIMESTAMP) AS recorded_time, l_orderkey + l_linenumber AS k
        FROM line""",
    "procedure": """
        SELECT id AS procedure_id, patient_id, encounter_id, code AS snomed_code, display AS snomed_display,
               'completed' AS status, shipped AS performed_start,
               shipped + to_hours(l_linenumber) AS performed_end,
               CASE WHEN l_linenumber % 3 = 0 THEN code END AS reason_code, l_orderkey + l_linenumber AS k
        FROM line""",
    "medication_request": """
        SELECT id AS medication_request_id, patient_id, encounter_id, code AS rxnorm_code,
               display AS rxnorm_display, 'active' AS status, 'order' AS intent, shipped AS authored_time,
               requester_id
        FROM line""",
    "observation": """
        SELECT CAST(event_id AS VARCHAR) AS observation_id, CAST(user_id AS VARCHAR) AS patient_id,
               CAST(event_id AS VARCHAR) AS encounter_id, 'final' AS status, 'survey' AS category_code,
               event_type AS loinc_code, upper(event_type) AS loinc_display,
               CASE WHEN event_id % 50 <> 0 THEN date_trunc('second', CAST(ts AS TIMESTAMP)) END AS effective_time,
               CASE WHEN event_type IN ('purchase', 'signup') THEN value END AS value_number,
               CASE WHEN event_type IN ('purchase', 'signup') THEN 'USD' END AS value_unit,
               CASE WHEN event_type = 'view' THEN 'view' END AS value_code,
               CASE WHEN event_type = 'view' THEN 'VIEW' END AS value_display,
               CASE WHEN event_type = 'click' THEN props END AS value_text
        FROM events""",
    "organization": """
        SELECT CAST(n_nationkey AS VARCHAR) AS organization_id, n_name AS name, 'prov' AS type_code,
               'Healthcare Provider' AS type_display, 'Main Street ' || n_nationkey AS address_line,
               n_name AS address_city, r_name AS address_state,
               lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS address_postal_code,
               '555-' || n_nationkey AS phone, n_nationkey
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "practitioner": """
        SELECT CAST(s_suppkey AS VARCHAR) AS practitioner_id, s_name AS family_name,
               'Given' || s_suppkey AS given_name, 'Dr.' AS prefix,
               CASE WHEN s_suppkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender,
               n_name AS address_city, r_name AS address_state,
               CASE WHEN s_suppkey % 3 > 0 THEN 'p' || s_suppkey || '@example.org' END AS email, s_suppkey
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "note": """
        SELECT CAST(doc_id AS VARCHAR) AS note_id, doc_id,
               CAST(doc_id % (SELECT greatest(1, count(*)) FROM customer) AS VARCHAR) AS patient_id,
               CAST(DATE '2024-01-01' + CAST(doc_id % 365 AS INT) AS VARCHAR) AS note_date, text AS note_text
        FROM documents WHERE length(text) > 0""",
}

# --- broken records: the rules each broken key violates, in contract order -----------------

BROKEN = {
    "patient": (
        ("c_custkey % 101 = 7", "gender: is required"),
        (
            "c_custkey % 103 = 9 AND c_custkey % 101 <> 7",
            "gender: must be one of male, female, other, unknown",
        ),
        ("c_custkey % 107 = 11", "birthDate: must be a date"),
        ("c_custkey % 109 = 13", "extension: must not be null"),
    ),
    "encounter": (
        ("o_orderkey % 89 = 3", "type: must not be null"),
        ("o_orderkey % 97 = 5", "subject: is required"),
        ("o_orderkey % 83 = 2", "period.start: must be a dateTime"),
        ("o_orderkey % 79 = 4", "location[]: must not be null"),
    ),
    "condition": (
        ("k % 71 = 1", "category: must not be null"),
        ("k % 67 = 3", "code: is required"),
        ("k % 73 = 2", "onsetDateTime: must be a dateTime"),
    ),
    "procedure": (
        ("k % 59 = 6", "status: is required"),
        ("k % 61 = 5", "performedPeriod.end: must be a dateTime"),
    ),
    "organization": (("n_nationkey % 7 = 3", "name: is required"),),
    "practitioner": (
        ("s_suppkey % 19 = 5", "name: is required"),
        ("s_suppkey % 17 = 4", "telecom: must not be null"),
    ),
}


def _error(table: str) -> str:
    cases = ", ".join(f"CASE WHEN {when} THEN '{text}' END" for when, text in BROKEN[table])
    return f"nullif(concat_ws('; ', {cases}), '')"


def _bad(table: str) -> str:
    return "(" + " OR ".join(f"({when})" for when, _ in BROKEN[table]) + ")"


# --- history: versions from one row per entity and run -------------------------------------


def _versions(entity: str, checked: tuple[str, ...], extra: tuple[str, ...] = ()) -> str:
    """Versions of an entity out of ``<entity>_listed`` (run, id, columns)."""
    key = f"{entity}_id"
    runs = ", ".join(f"(TIMESTAMP '{r}')" for r in RUNS)
    same = " AND ".join(f"{c} IS NOT DISTINCT FROM prev_{c}" for c in checked)
    carried = ", ".join(f"l.{c}" for c in (*checked, *extra))
    previous = ", ".join(f"lag(l.{c}) OVER w AS prev_{c}" for c in checked)
    return f"""
        SELECT * FROM (
            SELECT *, lead(run) OVER (PARTITION BY {key} ORDER BY run) AS dbt_valid_to,
                   run AS dbt_valid_from, md5({key} || '|' || CAST(run AS VARCHAR)) AS dbt_scd_id
            FROM (
                SELECT ids.{key}, runs.run, l.{key} IS NOT NULL AS listed, {carried}, {previous},
                       lag(l.{key} IS NOT NULL) OVER w AS prev_listed
                FROM (SELECT DISTINCT {key} FROM {entity}_listed) ids
                CROSS JOIN (VALUES {runs}) runs(run)
                LEFT JOIN {entity}_listed l ON l.{key} = ids.{key} AND l.run = runs.run
                WINDOW w AS (PARTITION BY ids.{key} ORDER BY runs.run)
            )
            WHERE coalesce(prev_listed, FALSE) <> listed OR (listed AND NOT ({same}))
        ) WHERE listed"""


def _per_run(select: str) -> str:
    return " UNION ALL ".join(select.replace(":run", f"TIMESTAMP '{r}'") for r in RUNS)


_LAST_ORDER = """
    (SELECT {key} AS key, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS status,
            max(o_orderdate) AS last_at
     FROM orders WHERE o_orderdate < :run AND o_orderdate >= :run - INTERVAL 2 YEARS GROUP BY 1)"""

PARTS |= {
    "patient_listed": _per_run(
        f"""
        SELECT :run AS run, p.patient_id, p.address_city, p.address_state, p.address_postal_code,
               CASE WHEN status <> 'P' THEN p.marital_status_code || '/' || status END AS marital_status_code,
               strftime(last_at, '%Y-%m-%d') AS last_visit
        FROM patient p JOIN {_LAST_ORDER.format(key='CAST(o_custkey AS VARCHAR)')} o ON p.patient_id = o.key"""
    ),
    "patient_history": _versions(
        "patient",
        ("address_city", "address_state", "address_postal_code", "marital_status_code"),
        ("last_visit",),
    ),
    "organization_listed": _per_run(
        f"""
        SELECT :run AS run, g.organization_id, g.name || ' ' || status AS name, g.address_city,
               g.address_state, g.address_postal_code
        FROM organization g JOIN {_LAST_ORDER.format(key='CAST(o_custkey % 25 AS VARCHAR)')} o
          ON g.organization_id = o.key"""
    ),
    "organization_history": _versions(
        "organization", ("name", "address_city", "address_state", "address_postal_code")
    ),
    "practitioner_listed": _per_run(
        """
        SELECT :run AS run, p.practitioner_id, p.family_name, p.address_city, p.address_state,
               flag AS given_name
        FROM practitioner p JOIN (
            SELECT CAST(l_suppkey AS VARCHAR) AS key,
                   arg_max(l_returnflag, (l_shipdate, l_orderkey, l_linenumber, l_returnflag)) AS flag
            FROM lineitem WHERE l_shipdate < :run GROUP BY 1) o ON p.practitioner_id = o.key"""
    ),
    "practitioner_history": _versions(
        "practitioner", ("family_name", "given_name", "address_city", "address_state")
    ),
    # --- star schema -----------------------------------------------------------------------
    "dim_patient": """
        SELECT md5(h.patient_id || '-' || CAST(dbt_valid_from AS VARCHAR)) AS patient_key, h.patient_id,
               p.gender, p.birth_date, p.race_code, p.race_display, p.ethnicity_code, p.ethnicity_display,
               h.marital_status_code, h.address_city, h.address_state, h.address_postal_code,
               CASE WHEN dbt_valid_from = min(dbt_valid_from) OVER (PARTITION BY h.patient_id)
                    THEN TIMESTAMP '1900-01-01' ELSE dbt_valid_from END AS valid_from,
               dbt_valid_to AS valid_to, dbt_valid_to IS NULL AS is_current, dbt_scd_id AS _snapshot_scd_id
        FROM patient_history h JOIN patient p ON h.patient_id = p.patient_id""",
    "dim_organization": """
        SELECT md5(h.organization_id || '-' || CAST(dbt_valid_from AS VARCHAR)) AS organization_key,
               h.organization_id, h.name, type_code, type_display, address_line, h.address_city,
               h.address_state, h.address_postal_code, phone, dbt_valid_from AS valid_from,
               dbt_valid_to AS valid_to, dbt_valid_to IS NULL AS is_current, dbt_scd_id AS _snapshot_scd_id
        FROM organization_history h JOIN organization o ON h.organization_id = o.organization_id""",
    "dim_provider": """
        SELECT md5(h.practitioner_id || '-' || CAST(dbt_valid_from AS VARCHAR)) AS provider_key,
               h.practitioner_id, h.family_name, h.given_name, prefix, gender, h.address_city,
               h.address_state, email, dbt_valid_from AS valid_from, dbt_valid_to AS valid_to,
               dbt_valid_to IS NULL AS is_current, dbt_scd_id AS _snapshot_scd_id
        FROM practitioner_history h JOIN practitioner p ON h.practitioner_id = p.practitioner_id""",
    "dim_condition": """
        SELECT md5(snomed_code) AS condition_key, snomed_code, max(snomed_display) AS snomed_display,
               count(*) AS occurrence_count
        FROM condition WHERE snomed_code IS NOT NULL GROUP BY snomed_code""",
    "dim_date": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, CAST(d AS DATE) AS full_date,
               CAST(year(d) AS INT) AS year, CAST(quarter(d) AS INT) AS quarter, CAST(month(d) AS INT) AS month,
               strftime(d, '%B') AS month_name, CAST(day(d) AS INT) AS day_of_month,
               CAST(dayofweek(d) + 1 AS INT) AS day_of_week, strftime(d, '%A') AS day_name,
               dayofweek(d) IN (0, 6) AS is_weekend
        FROM (SELECT unnest(range(TIMESTAMP '1900-01-01', TIMESTAMP '2030-01-01', INTERVAL 1 DAY)) AS d)""",
    "fact_encounter": """
        SELECT md5(encounter_id) AS encounter_key, encounter_id, p.patient_key, o.organization_key,
               CAST(strftime(start_time, '%Y%m%d') AS INT) AS admission_date_key,
               CAST(strftime(end_time, '%Y%m%d') AS INT) AS discharge_date_key, encounter_class_code,
               encounter_class_display, status, encounter_type_code, discharge_disposition_code,
               length_of_stay_hours
        FROM encounter e
        LEFT JOIN dim_patient p ON e.patient_id = p.patient_id AND e.start_time >= p.valid_from
             AND (e.start_time < p.valid_to OR p.valid_to IS NULL)
        LEFT JOIN dim_organization o ON e.service_provider_id = o.organization_id AND o.is_current""",
    "admission": """
        SELECT *, days BETWEEN 0 AND 30 AND days IS NOT NULL AS raw30, coalesce(days = 0, FALSE) AS same_day,
               coalesce(days BETWEEN 1 AND 30, FALSE) AS excl30
        FROM (SELECT *, date_diff('day', CAST(end_time AS DATE), CAST(next_time AS DATE)) AS days
              FROM (SELECT encounter_id, patient_id, start_time, end_time,
                           lead(start_time) OVER w AS next_time, lead(encounter_id) OVER w AS next_id
                    FROM encounter WHERE encounter_class_code = 'IMP'
                    WINDOW w AS (PARTITION BY patient_id ORDER BY start_time, encounter_id)))""",
    "fact_readmission": """
        SELECT encounter_key AS readmission_key, encounter_key AS index_encounter_key, patient_key,
               encounter_id AS index_encounter_id, admission_date_key AS index_admission_date_key,
               discharge_date_key AS index_discharge_date_key,
               length_of_stay_hours AS index_length_of_stay_hours, next_id AS next_encounter_id,
               CAST(days AS INT) AS days_to_readmission, raw30 AS was_readmitted_30d,
               same_day AS is_likely_transfer, excl30 AS was_readmitted_30d_excl_transfers
        FROM admission JOIN fact_encounter USING (encounter_id)""",
    "profile": """
        SELECT patient_id, gender, race_display, ethnicity_display, marital_status_code,
               CAST(floor(date_diff('day', CAST(birth_date AS DATE), admitted) / 365.25) AS INT) AS age_at_admission,
               encounter_class_code, CAST(admitted AS VARCHAR) AS index_admission_date,
               CAST(discharged AS VARCHAR) AS index_discharge_date,
               round(index_length_of_stay_hours / 24.0, 1) AS length_of_stay_days, days_to_readmission,
               was_readmitted_30d, is_likely_transfer, was_readmitted_30d_excl_transfers, ever_readmitted_30d
        FROM (SELECT p.*, r.*, e.encounter_class_code, a.full_date AS admitted, d.full_date AS discharged,
                     max(was_readmitted_30d_excl_transfers) OVER (PARTITION BY p.patient_id) AS ever_readmitted_30d,
                     row_number() OVER (PARTITION BY p.patient_id
                         ORDER BY a.full_date DESC, index_encounter_id DESC) AS place
              FROM fact_readmission r JOIN fact_encounter e ON r.index_encounter_key = e.encounter_key
              JOIN dim_patient p ON r.patient_key = p.patient_key
              LEFT JOIN dim_date a ON r.index_admission_date_key = a.date_key
              LEFT JOIN dim_date d ON r.index_discharge_date_key = d.date_key)
        WHERE place = 1""",
    "vector": "SELECT label, vec_id, CAST(embedding AS DOUBLE[]) AS vector FROM embeddings",
    "library": f"""
        SELECT item_id AS entry_id, {_TEXT_VECTOR} AS entry FROM benchmark WHERE length(text) > 0""",
}

# Which parts a part reads, to put a WITH clause together.
NEEDS = {
    "condition": ("line",),
    "procedure": ("line",),
    "medication_request": ("line",),
    "patient_listed": ("patient",),
    "patient_history": ("patient_listed",),
    "organization_listed": ("organization",),
    "organization_history": ("organization_listed",),
    "practitioner_listed": ("practitioner",),
    "practitioner_history": ("practitioner_listed",),
    "dim_patient": ("patient", "patient_history"),
    "dim_organization": ("organization", "organization_history"),
    "dim_provider": ("practitioner", "practitioner_history"),
    "dim_condition": ("condition",),
    "fact_encounter": ("encounter", "dim_patient", "dim_organization"),
    "admission": ("encounter",),
    "fact_readmission": ("admission", "fact_encounter"),
    "profile": ("fact_readmission", "dim_date"),
}


def _with(select: str, *parts: str, **replaced: str) -> str:
    """``select`` after a WITH clause of the parts and all they read; ``replaced`` overrides parts."""
    order: list[str] = []

    def add(part: str) -> None:
        if part in order:
            return
        for needed in () if part in replaced else NEEDS.get(part, ()):
            add(needed)
        order.append(part)

    for part in parts:
        add(part)
    clauses = ", ".join(
        f"{p} AS MATERIALIZED ({replaced.get(p, PARTS[p] if p in PARTS else '')})" for p in order
    )
    return f"WITH {clauses} {select}" if clauses else select


def _times(columns: str) -> str:
    return ", ".join(f"strftime({c}, {TS}) AS {c}" for c in columns.split())


def _table(part: str, times: str = "", drop: str = "") -> str:
    """All columns of a part, times as text."""
    replaced = f" REPLACE ({_times(times)})" if times else ""
    excluded = f" EXCLUDE ({drop})" if drop else ""
    return _with(f"SELECT *{excluded}{replaced} FROM {part}", part)


def _errors(part: str, key: str) -> str:
    return _with(f"SELECT {key} AS id, {_error(part)} AS validation_error FROM {part}", part)


_COUNTS = """
    count(*) AS index_admissions, count(*) FILTER (raw30) AS readmissions_raw,
    count(*) FILTER (same_day) AS likely_transfers, count(*) FILTER (excl30) AS readmissions,
    count(*) FILTER (raw30) / count(*) AS readmission_rate_raw, count(*) FILTER (excl30) / count(*) AS readmission_rate"""

_L2 = "list_sum(list_transform(range(1, len({a}) + 1), lambda i: ({a}[i] - {b}[i]) * ({a}[i] - {b}[i])))"


def _check(table: str, column: str, test: str, severity: str, failures: str) -> str:
    failed = "warn" if severity == "warn" else "fail"
    return f"""
        SELECT '{table}' AS table_name, '{column}' AS column_name, '{test}' AS test,
               '{severity}' AS severity, f AS failures,
               CASE WHEN f = 0 THEN 'pass' ELSE '{failed}' END AS status
        FROM (SELECT CAST(({failures}) AS BIGINT) AS f)"""


def _check_sql(c: Check) -> str:
    source = f"FROM {c.table} WHERE"
    if c.test == "not_null":
        failures = f"SELECT count(*) {source} {c.column} IS NULL"
    elif c.test == "unique":
        failures = f"""SELECT count(*) FROM (SELECT 1 {source} {c.column} IS NOT NULL
                       GROUP BY {c.column} HAVING count(*) > 1)"""
    elif c.test == "accepted_values":
        listed = ", ".join(f"'{v}'" for v in c.values)
        failures = f"SELECT count(DISTINCT {c.column}) {source} {c.column} NOT IN ({listed})"
    elif c.test == "relationships":
        failures = f"""SELECT count(*) {source} {c.column} IS NOT NULL
                       AND NOT EXISTS (SELECT 1 FROM {c.to} parent WHERE parent.{c.field} = {c.table}.{c.column})"""
    else:
        failures = f"SELECT count(*) {source} NOT ({c.expression})"
    return _check(c.table, c.column, c.test, c.severity, failures)


_ENCOUNTER_DIRTY = f"""
    SELECT * REPLACE (CASE WHEN o_orderkey % 97 <> 5 THEN patient_id END AS patient_id,
                      CASE WHEN o_orderkey % 83 <> 2 THEN start_time END AS start_time,
                      CASE WHEN o_orderkey % 89 <> 3 THEN encounter_type_code END AS encounter_type_code)
    FROM ({PARTS['encounter']})"""


def _only_valid(table: str) -> str:
    return f"SELECT * FROM ({PARTS[table]}) WHERE NOT {_bad(table)}"


def _one_run(entity: str, key: str, columns: str) -> str:
    """A dimension after a single snapshot run: one open version each."""
    run = "TIMESTAMP '2002-01-01'"
    return f"""SELECT md5({entity}_id || '-' || CAST({run} AS VARCHAR)) AS {key}, {columns},
               TIMESTAMP '1900-01-01' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current
               FROM {entity}"""


def _dq_report() -> str:
    checks = [*SILVER_CHECKS, *GOLD_CHECKS]
    replaced = {t: _only_valid(t) for t in BROKEN}
    replaced |= {
        "dim_patient": _one_run("patient", "patient_key", "patient_id"),
        "dim_organization": _one_run("organization", "organization_key", "organization_id"),
        "dim_provider": _one_run("practitioner", "provider_key", "practitioner_id"),
    }
    parts = ["line", *dict.fromkeys(c.table for c in checks)]
    return _with(" UNION ALL ".join(_check_sql(c) for c in checks), *parts, **replaced)


def _presence(resource: str, table: str, paths: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{path}' AS path, round(100.0 * count(*) FILTER ({when}) / count(*), 1) AS presence_pct,
            '{resource}' AS resource_type FROM {table} HAVING count(*) FILTER ({when}) > 0"""
        for path, when in paths.items()
    )


def _concept_paths(path: str, when: str) -> dict[str, str]:
    below = ("", ".coding", ".coding[]", ".coding[].code", ".coding[].display", ".coding[].system", ".text")
    return {f"{path}{b}": when for b in below}


def _plain_paths(*paths: str, when: str = "TRUE") -> dict[str, str]:
    return dict.fromkeys(paths, when)


_OBSERVATION_PATHS = {
    **_plain_paths("id", "status", "subject", "subject.reference", "encounter", "encounter.reference"),
    **_plain_paths("category", "effectiveDateTime"),
    **_concept_paths("category[]", "TRUE"),
    **_concept_paths("code", "TRUE"),
    **_plain_paths(
        "valueQuantity", "valueQuantity.value", "valueQuantity.unit",
        when="event_type IN ('purchase', 'signup')",
    ),
    **_concept_paths("valueCodeableConcept", "event_type = 'view'"),
    **_plain_paths("valueString", when="event_type = 'click'"),
    **_plain_paths(
        "component", "component[]", "component[].valueQuantity", "component[].valueQuantity.value",
        "component[].valueQuantity.unit", when="event_type = 'error'",
    ),
    **_concept_paths("component[].code", "event_type = 'error'"),
}
_ENCOUNTER_PATHS = {
    **_plain_paths("id", "status", "class", "class.code", "subject", "subject.reference"),
    **_plain_paths("type", "period", "period.start", "period.end"),
    **_concept_paths("type[]", "TRUE"),
    **_plain_paths("reasonCode", when="o_orderkey % 3 <> 0"),
    **_concept_paths("reasonCode[]", "o_orderkey % 3 <> 0"),
    **_plain_paths("hospitalization", when="o_orderkey % 10 = 0"),
    **_concept_paths("hospitalization.dischargeDisposition", "o_orderkey % 10 = 0"),
    **_plain_paths(
        "location", "location[]", "location[].location", "location[].location.display",
        "serviceProvider", "serviceProvider.reference", "participant", "participant[]",
        "participant[].individual", "participant[].individual.reference",
    ),
}



def _address_paths() -> dict[str, str]:
    parts = ("", "[]", "[].line", "[].line[]", "[].city", "[].state", "[].postalCode", "[].country")
    return {f"address{p}": "TRUE" for p in parts}


_CODING_PATHS = ("valueCoding", "valueCoding.system", "valueCoding.code", "valueCoding.display")
_LINKS = _plain_paths("id", "subject", "subject.reference", "encounter", "encounter.reference")
_PATHS = {
    "Patient": {
        **_plain_paths("id", "gender", "birthDate", "maritalStatus", "extension"),
        **_plain_paths("deceasedDateTime", when="c_custkey % 11 = 0"),
        **_address_paths(),
        **_concept_paths("maritalStatus", "TRUE"),
        **_plain_paths(
            "extension[]", "extension[].url", "extension[].extension", "extension[].extension[]",
            "extension[].extension[].url", *(f"extension[].extension[].{p}" for p in _CODING_PATHS),
            when="c_custkey % 13 <> 0",
        ),
    },
    "Condition": {
        **_LINKS,
        **_plain_paths("category", "onsetDateTime", "recordedDate"),
        **_plain_paths("abatementDateTime", when="l_linenumber % 2 = 0"),
        **_concept_paths("clinicalStatus", "TRUE"),
        **_concept_paths("verificationStatus", "TRUE"),
        **_concept_paths("category[]", "TRUE"),
        **_concept_paths("code", "TRUE"),
    },
    "Procedure": {
        **_LINKS,
        **_plain_paths("status", "performedPeriod", "performedPeriod.start", "performedPeriod.end"),
        **_concept_paths("code", "TRUE"),
        **_plain_paths("reasonCode", when="l_linenumber % 3 = 0"),
        **_concept_paths("reasonCode[]", "l_linenumber % 3 = 0"),
    },
    "MedicationRequest": {
        **_LINKS,
        **_plain_paths("status", "intent", "authoredOn", "requester", "requester.reference"),
        **_concept_paths("medicationCodeableConcept", "TRUE"),
    },
    "DocumentReference": _plain_paths(
        "id", "subject", "subject.reference", "date", "content", "content[]", "content[].attachment",
        "content[].attachment.contentType", "content[].attachment.data",
    ),
    "Organization": {
        **_plain_paths("id", "name", "type", "telecom", "telecom[]", "telecom[].system", "telecom[].value"),
        **_address_paths(),
        **_concept_paths("type[]", "TRUE"),
    },
    "Practitioner": {
        **_plain_paths(
            "id", "gender", "name", "name[]", "name[].family", "name[].given", "name[].given[]", "name[].prefix",
            "name[].prefix[]", "telecom", "telecom[]", "telecom[].system", "telecom[].value",
        ),
        **_address_paths(),
    },
    "Observation": _OBSERVATION_PATHS,
    "Encounter": _ENCOUNTER_PATHS,
}

_REFERENCE = """
    (SELECT c_custkey, CASE c_custkey % 6
         WHEN 0 THEN 'Patient/' || c_custkey WHEN 1 THEN 'urn:uuid:' || c_custkey
         WHEN 2 THEN 'Organization?identifier=sys|' || c_custkey
         WHEN 3 THEN 'http://host/Patient/' || c_custkey WHEN 4 THEN CAST(c_custkey AS VARCHAR) END AS ref
     FROM customer)"""

_KEPT = """
    SELECT file_name, id, entity IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer
        ORDER BY md5(CAST(c_custkey AS VARCHAR) || '|42'), CAST(c_custkey AS VARCHAR) LIMIT 50) AS kept
    FROM (SELECT 'Patient.ndjson' AS file_name, CAST(c_custkey AS VARCHAR) AS id, CAST(c_custkey AS VARCHAR) AS entity FROM customer
          UNION ALL SELECT 'Encounter.ndjson', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR) FROM orders
          UNION ALL
          SELECT 'Observation.ndjson', CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR) FROM events)"""

_START_OK = "FILTER (o_orderkey % 83 <> 2)"


def _period(name: str, column: str, only: str) -> str:
    return f"""SELECT '{name}' AS period_field, strftime(min({column}) {only}, {TS}) AS earliest,
        strftime(max({column}) {only}, {TS}) AS latest,
        strftime(make_timestamp(CAST(floor(quantile_cont(epoch_us({column}), 0.5) {only}) AS BIGINT)), {TS}) AS median
        FROM encounter"""


_TOPK = f"""
    SELECT {{group}}, {{item}}, round(distance, 6) AS distance,
           CAST(row_number() OVER (PARTITION BY {{group}} ORDER BY distance, {{item}}) AS INT) AS rank
    FROM ({{pairs}}) QUALIFY rank <= {{k}}"""

_NOTE_VECTOR = """
    SELECT patient_id, doc_id AS note_id, {vector} AS vector FROM note""".format(
    vector=_TEXT_VECTOR.replace("text", "note_text")
)


def _ids(name: str, group: str, item: str, pairs: str, k: int) -> str:
    best = f"""SELECT {group}, {item}, row_number() OVER (PARTITION BY {group} ORDER BY distance, {item}) AS rank
               FROM ({pairs}) QUALIFY rank <= {k}"""
    return f"SELECT {group}, string_agg({item}, ',' ORDER BY rank) AS {name} FROM ({best}) GROUP BY {group}"


def _evidence() -> str:
    first = "SELECT patient_id, min_by(vector, note_id) AS qv FROM note_vector GROUP BY patient_id"
    note_pairs = f"""SELECT n.patient_id, note_id, {_L2.format(a='qv', b='vector')} AS distance
                     FROM note_vector n JOIN first_vector USING (patient_id)"""
    library_pairs = f"""SELECT patient_id, entry_id, {_L2.format(a='qv', b='entry')} AS distance
                        FROM first_vector CROSS JOIN library"""
    select = f"""SELECT patient_id, gender, ever_readmitted_30d, notes, guidelines FROM profile
        LEFT JOIN ({_ids('notes', 'patient_id', 'note_id', note_pairs, 8)}) USING (patient_id)
        LEFT JOIN ({_ids('guidelines', 'patient_id', 'entry_id', library_pairs, 4)}) USING (patient_id)"""
    return _with(
        select, "profile", "note", "library", "note_vector", "first_vector",
        note_vector=_NOTE_VECTOR, first_vector=first,
    )


def _rates_by_attribute() -> str:
    names = ("gender", "address_state", "marital_status_code")
    each = " UNION ALL ".join(
        f"""SELECT '{n}' AS attribute, CAST({n} AS VARCHAR) AS value, was_readmitted_30d AS raw30,
            is_likely_transfer AS same_day, was_readmitted_30d_excl_transfers AS excl30
            FROM fact_readmission LEFT JOIN dim_patient USING (patient_key)"""
        for n in names
    )
    return _with(
        f"SELECT attribute, value, {_COUNTS} FROM ({each}) GROUP BY attribute, value",
        "fact_readmission",
        "dim_patient",
    )


_SOURCES = {
    "Patient": "customer", "Encounter": "orders", "Condition": "line", "Procedure": "line", "MedicationRequest": "line",
    "Observation": "events", "DocumentReference": "documents", "Organization": "nation", "Practitioner": "supplier",
}

ORACLE_SQL: dict[str, str] = {
    "readmission_rate": _with(f"SELECT {_COUNTS} FROM admission", "admission"),
    "next_admission": _with(
        f"""SELECT encounter_id, patient_id, strftime(start_time, {TS}) AS admission_time,
            strftime(next_time, {TS}) AS next_admission_time, next_id AS next_encounter_id FROM admission""",
        "admission",
    ),
    "fact_readmission": _table("fact_readmission"),
    "rate_by_attribute": _rates_by_attribute(),
    "silver_patient": _table("patient", drop="c_custkey"),
    "silver_encounter": _table("encounter", "start_time end_time", "o_orderkey"),
    "silver_lineage": f"""
        SELECT table_name, load_ts, source_file, ingestion_run_id, count(*) AS rows
        FROM (SELECT 'encounter' AS table_name, 'Encounter.ndjson' AS source_file FROM orders
              UNION ALL SELECT 'observation', 'Observation.ndjson' FROM events
              UNION ALL SELECT 'patient', 'Patient.ndjson' FROM customer
              UNION ALL SELECT 'practitioner', 'Practitioner.ndjson' FROM supplier),
             (SELECT strftime(TIMESTAMP '2024-01-01', {TS}) AS load_ts, 'fixture' AS ingestion_run_id)
        GROUP BY ALL""",
    "silver_condition": _table("condition", "onset_time abatement_time recorded_time", "k"),
    "silver_procedure": _table("procedure", "performed_start performed_end", "k"),
    "silver_observation": _table("observation", "effective_time"),
    "silver_medication_request": _table("medication_request", "authored_time"),
    "silver_organization": _table("organization", drop="n_nationkey"),
    "silver_practitioner": _table("practitioner", drop="s_suppkey"),
    "contract_errors": _errors("encounter", "encounter_id"),
    "contract_patient": _errors("patient", "patient_id"),
    "contract_condition": _errors("condition", "condition_id"),
    "contract_procedure": _errors("procedure", "procedure_id"),
    "contract_organization": _errors("organization", "organization_id"),
    "contract_practitioner": _errors("practitioner", "practitioner_id"),
    "validated_encounters": _with(
        f"""SELECT * EXCLUDE (o_orderkey) REPLACE ({_times('start_time end_time')})
            FROM encounter WHERE NOT {_bad('encounter')}""",
        "encounter",
    ),
    "quarantined_encounters": _with(
        f"""SELECT encounter_id AS id, status,
                   strftime(end_time, '%Y-%m-%dT%H:%M:%S') ||
                       CASE WHEN o_orderkey % 2 = 0 THEN 'Z' ELSE '+00:00' END AS "end",
                   {_error('encounter')} AS validation_error
            FROM encounter WHERE {_bad('encounter')}""",
        "encounter",
    ),
    "validation_summary": _with(
        " UNION ALL ".join(
            f"""SELECT count(*) AS total_rows, count(*) FILTER (NOT {_bad(t)}) AS valid_rows,
                count(*) FILTER ({_bad(t)}) AS quarantine_rows, '{t.capitalize()}' AS resource_type FROM {t}"""
            for t in BROKEN
        ),
        *BROKEN,
    ),
    "bronze_scan": _table("patient", drop="c_custkey"),
    "bronze_provenance": """
        SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name, TRUE AS has_load_ts,
               TRUE AS has_source_file, TRUE AS has_row_hash, 'bronze_test' AS run_id FROM nation""",
    "row_hash": """
        SELECT c_custkey, sha256(CAST(to_json({'c_custkey': c_custkey, 'c_name': c_name, 'c_nationkey': c_nationkey,
            'c_acctbal': c_acctbal, 'c_mktsegment': c_mktsegment}) AS VARCHAR)) AS row_hash FROM customer""",
    "bronze_full_record": """
        SELECT CAST(event_id AS VARCHAR) AS id, CASE WHEN event_id % 40 <> 3 THEN CAST(event_id % 100 AS DOUBLE) END AS value,
               event_type AS issued, event_id % 40 = 3 AS mistyped,
               sha256('[{"key":"id","value":"' || event_id || '"},{"key":"issued","value":"' || event_type
                   || '"},{"key":"valueQuantity","value":"{\\"value\\":' ||
                   CASE WHEN event_id % 40 = 3 THEN '\\"many\\"' ELSE CAST(event_id % 100 AS VARCHAR) END
                   || ',\\"unit\\":\\"USD\\"}"}]') AS row_hash
        FROM events WHERE event_id % 50 <> 7""",
    "bronze_bad_lines": """
        WITH lines AS (
            SELECT event_id, '{"id":"' || event_id || '","issued":"' || event_type || '","valueQuantity":{"value":'
                || CASE WHEN event_id % 40 = 3 THEN '"many"' ELSE CAST(event_id % 100 AS VARCHAR) END || ',"unit":"USD"}}' AS line
            FROM events)
        SELECT 'line' AS kind, left(line, length(line) - 3) AS text, CAST(1 AS BIGINT) AS n FROM lines WHERE event_id % 50 = 7
        UNION ALL SELECT 'loaded', NULL, count(*) FROM lines WHERE event_id % 50 <> 7
        UNION ALL SELECT 'bad_lines', NULL, count(*) FROM lines WHERE event_id % 50 = 7
        UNION ALL SELECT 'mistyped', NULL, count(*) FROM lines WHERE event_id % 40 = 3 AND event_id % 50 <> 7""",
    "bronze_new_files": """
        SELECT CASE WHEN event_id % 50 <> 7 THEN CAST(event_id AS VARCHAR) END AS id,
               CASE WHEN event_id % 50 <> 7 THEN CAST(event_id % 100 AS DOUBLE) END AS value,
               CASE WHEN event_id % 3 = 0 THEN 'load-0' ELSE 'load-1' END AS run_id
        FROM events""",
    "bronze_default_run": "SELECT true AS named, CAST(1 AS BIGINT) AS runs, count(*) AS rows FROM orders",
    "ingest_counts": _with(
        " UNION ALL ".join(
            f"SELECT '{name}' AS resource_type, count(*) AS row_count FROM {table}" for name, table in _SOURCES.items()
        ),
        "line",
    ),
    "scalar_fhir_id": f"""
        SELECT c_custkey,
               CASE c_custkey % 6 WHEN 3 THEN ref WHEN 5 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS flat_id,
               CASE c_custkey % 6 WHEN 5 THEN NULL WHEN 2 THEN ref ELSE CAST(c_custkey AS VARCHAR) END AS note_id
        FROM {_REFERENCE}""",
    "reference_target_id": f"""
        SELECT c_custkey, CASE WHEN c_custkey % 6 IN (0, 1) THEN CAST(c_custkey AS VARCHAR) ELSE ref END AS target
        FROM {_REFERENCE}""",
    "scalar_fhir_timestamp": f"""
        SELECT o_orderkey,
               strftime(CASE o_orderkey % 7 WHEN 0 THEN t WHEN 1 THEN t - INTERVAL 10 HOURS END, {TS}) AS strict,
               strftime(lenient, {TS}) AS lenient,
               CASE WHEN o_orderkey % 7 = 2 THEN strftime(lenient, '%Y-%m-%dT%H:%M:%S.%fZ')
                    ELSE strftime(lenient, {ISO}) END AS iso
        FROM (SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS t,
                     CASE o_orderkey % 7 WHEN 1 THEN t - INTERVAL 10 HOURS WHEN 2 THEN t + INTERVAL 250 MILLISECONDS
                          WHEN 3 THEN date_trunc('day', t) WHEN 5 THEN NULL WHEN 6 THEN NULL ELSE t END AS lenient
              FROM orders)""",
    "surrogate_key": """
        SELECT o_orderkey, md5(o_custkey || '-' || CAST(CAST(o_orderdate AS TIMESTAMP) AS VARCHAR)) AS version_key,
               md5(CASE WHEN o_orderstatus = 'P' THEN '_dbt_utils_surrogate_key_null_' ELSE o_orderstatus END
                   || '-' || o_orderkey) AS null_part_key
        FROM orders""",
    "dim_date": _with(
        """SELECT d.* REPLACE (CAST(full_date AS VARCHAR) AS full_date), count(o_orderkey) AS orders
           FROM dim_date d LEFT JOIN orders ON CAST(o_orderdate AS DATE) = full_date GROUP BY ALL""",
        "dim_date",
    ),
    "age_at_event": _with(
        """SELECT encounter_id, CAST(floor(date_diff('day', CAST(birth_date AS DATE), CAST(start_time AS DATE))
                  / 365.25) AS INT) AS age_years
           FROM encounter JOIN patient USING (patient_id)""",
        "encounter",
        "patient",
    ),
    "scd2_snapshot": _with(
        f"""SELECT patient_id, marital_status_code, last_visit, {_times('dbt_valid_from dbt_valid_to')}, dbt_scd_id
            FROM patient_history""",
        "patient_history",
    ),
    "scd2_parts": _with(
        f"""SELECT patient_id, marital_status_code, last_visit, {_times('dbt_valid_from dbt_valid_to')}, dbt_scd_id
            FROM patient_history""",
        "patient_history",
    ),
    "scd2_parts_written": _with(
        f"""SELECT CASE WHEN dbt_valid_to IS NULL THEN 'open' ELSE 'closed' END AS part,
                   strftime(dbt_valid_to, {TS}) AS closed_at, count(*) AS rows
            FROM patient_history GROUP BY ALL""",
        "patient_history",
    ),
    "scd2_hard_delete": _with(
        f"""SELECT patient_id, strftime(gone, {TS}) AS dbt_valid_to, strftime(since, {TS}) AS dbt_valid_from
            FROM (SELECT h.patient_id, h.dbt_valid_from AS since, h.dbt_valid_to AS gone FROM patient_history h
                  WHERE h.dbt_valid_to IS NOT NULL AND NOT EXISTS (
                      SELECT 1 FROM patient_listed l WHERE l.patient_id = h.patient_id AND l.run = h.dbt_valid_to))""",
        "patient_history",
    ),
    "scd2_new_column": _with(
        f"""SELECT patient_id, strftime(dbt_valid_from, {TS}) AS dbt_valid_from, strftime(dbt_valid_to, {TS}) AS dbt_valid_to,
                   CASE WHEN dbt_valid_from = TIMESTAMP '{RUNS[-1]}' THEN 'seen ' || last_visit END AS visit_note
            FROM patient_history""",
        "patient_history",
    ),
    "dim_patient": _table("dim_patient", "valid_from valid_to"),
    "dim_organization": _table("dim_organization", "valid_from valid_to"),
    "dim_provider": _table("dim_provider", "valid_from valid_to"),
    "dim_condition": _table("dim_condition"),
    "asof_patient_version": _with(
        f"""SELECT encounter_id, e.patient_id, patient_key, marital_status_code,
                   {_times('start_time valid_from valid_to')}
            FROM encounter e LEFT JOIN dim_patient p ON e.patient_id = p.patient_id
                 AND start_time >= valid_from AND (start_time < valid_to OR valid_to IS NULL)""",
        "encounter",
        "dim_patient",
    ),
    "current_org_join": _with(
        """SELECT service_provider_id, encounter_id, organization_key, name FROM encounter
           LEFT JOIN dim_organization ON service_provider_id = organization_id AND is_current""",
        "encounter",
        "dim_organization",
    ),
    "fact_encounter": _table("fact_encounter"),
    "role_playing_dates": _with(
        """SELECT encounter_id, admission_date_key, discharge_date_key,
                  CAST(CAST(start_time AS DATE) AS VARCHAR) AS admission_date,
                  CAST(CAST(end_time AS DATE) AS VARCHAR) AS discharge_date
           FROM fact_encounter JOIN encounter USING (encounter_id)""",
        "fact_encounter",
    ),
    "dq_not_null": _with(
        " UNION ALL ".join(
            _check_sql(Check("encounter", c, "not_null"))
            for c in ("encounter_id", "patient_id", "start_time", "encounter_type_code")
        ),
        "encounter",
        encounter=_ENCOUNTER_DIRTY,
    ),
    "dq_unique": _with(
        _check(
            "lineitem", "line_id", "unique", "error",
            """SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""",
        )
        + " UNION ALL "
        + _check_sql(Check("encounter", "encounter_id", "unique")),
        "encounter",
    ),
    "dq_accepted_values": _with(
        " UNION ALL ".join(_check_sql(c) for c in SILVER_CHECKS if c.test == "accepted_values"),
        "patient",
        "encounter",
        patient=f"""
            SELECT * REPLACE (CASE WHEN c_custkey % 101 = 7 THEN NULL WHEN c_custkey % 103 = 9 THEN 'M'
                              ELSE gender END AS gender) FROM ({PARTS['patient']})""",
    ),
    "dq_relationships": _with(
        _check_sql(Check("encounter", "patient_id", "relationships", to="patient", field="patient_id"))
        + " UNION ALL "
        + _check(
            "encounter", "patient_id", "relationships", "warn",
            f"""SELECT count(*) FROM encounter WHERE patient_id NOT IN (
                SELECT patient_id FROM patient_listed WHERE run = TIMESTAMP '{RUNS[0]}')""",
        ),
        "encounter",
        "patient_listed",
    ),
    "dq_expression": _check(
        "observation", "value_number", "expression_is_true", "warn",
        "SELECT count(*) FROM events WHERE event_type IN ('purchase', 'signup') AND value < 10",
    ),
    "dq_report": _dq_report(),
    "observation_incremental": _with(
        f"""SELECT observation_id, patient_id, strftime(effective_time, {TS}) AS effective_time, value_number,
                   CASE WHEN effective_time < TIMESTAMP '2024-01-20' THEN 'first' ELSE 'second' END AS load
            FROM observation""",
        "observation",
    ),
    "observation_buckets": _with(
        f"""SELECT observation_id, patient_id, strftime(effective_time, {TS}) AS effective_time, value_number,
                   CASE WHEN effective_time < TIMESTAMP '2024-01-20' THEN 'first' ELSE 'second' END AS load
            FROM observation""",
        "observation",
    ),
    "observation_mark": _with(
        f"""SELECT observation_id, patient_id, strftime(effective_time, {TS}) AS effective_time, value_number, load
            FROM (SELECT *, CASE WHEN effective_time < TIMESTAMP '2024-01-20' AND patient_id::BIGINT % 3 <> 0 THEN 'first'
                      WHEN effective_time > (SELECT max(effective_time) FROM observation
                          WHERE effective_time < TIMESTAMP '2024-01-20' AND patient_id::BIGINT % 3 <> 0) THEN 'second' END AS load
                  FROM observation)
            WHERE load IS NOT NULL""",
        "observation",
    ),
    "corpus_upsert": """
        SELECT doc_id, CASE WHEN lang = 'en' AND n_chars <= 200 THEN 'stored' ELSE 'added' END AS origin,
               CASE WHEN lang = 'en' AND n_chars <= 200 THEN md5(source) ELSE md5(text) END AS digest
        FROM documents""",
    "cohort_roster": _with(
        """SELECT patient_id, max(gender) AS gender,
                  CAST(max(floor(date_diff('day', CAST(birth_date AS DATE), DATE '2002-01-01') / 365.25)) AS INT) AS age,
                  max(CASE WHEN was_readmitted_30d_excl_transfers THEN 1 ELSE 0 END) AS ever_readmitted
           FROM fact_readmission JOIN dim_patient USING (patient_key)
           GROUP BY patient_id""",
        "fact_readmission",
        "dim_patient",
    ),
    "cohort_notes": _with(
        """SELECT note_id, patient_id, note_date, md5(note_text) AS text_digest FROM note
           WHERE patient_id IN (SELECT DISTINCT patient_id FROM fact_readmission JOIN dim_patient USING (patient_key))""",
        "note",
        "fact_readmission",
    ),
    "entity_profile": _table("profile"),
    "entity_topk": _with(
        _TOPK.format(
            group="label", item="vec_id", k=8,
            pairs=f"""SELECT label, vec_id, {_L2.format(a='qv', b='vector')} AS distance FROM vector
                      JOIN (SELECT label, min_by(vector, vec_id) AS qv FROM vector GROUP BY label) USING (label)""",
        ),
        "vector",
    ),
    "library_topk": _with(
        _TOPK.format(
            group="doc_id", item="entry_id", k=4,
            pairs=f"""SELECT doc_id, entry_id, {_L2.format(a='vector', b='entry')} AS distance
                      FROM (SELECT doc_id, {_TEXT_VECTOR} AS vector FROM documents WHERE length(text) > 0)
                      CROSS JOIN library""",
        ),
        "library",
    ),
    "evidence_bundle": _evidence(),
    "profile_counts": _with(
        " UNION ALL ".join(
            f"SELECT '{name}' AS resource_type, count(*) AS total_records, '{plan}' AS bronze_plan FROM {table}"
            for name, table, plan in (
                ("Patient", "customer", "bronzed"),
                ("Encounter", "orders", "bronzed"),
                ("Condition", "line", "bronzed"),
                ("Procedure", "line", "bronzed"),
                ("MedicationRequest", "line", "bronzed"),
                ("Observation", "events", "bronzed"),
                ("DocumentReference", "documents", "bronzed"),
                ("Organization", "nation", "bronzed"),
                ("Practitioner", "supplier", "bronzed"),
                ("SupplyDelivery", "part", "available-not-bronzed"),
            )
        ),
        "line",
    ),
    "profile_presence": _with(
        " UNION ALL ".join(_presence(name, _SOURCES[name], paths) for name, paths in _PATHS.items()), "line"
    ),
    "profile_presence_undeclared": r"""
        WITH parts AS (
            SELECT o_orderkey AS k, json_object('id', o_orderkey::VARCHAR, 'status', 'final',
                'meta', json_object('source', CASE WHEN o_orderkey % 6 <> 0
                    THEN json_object('a.b', o_orderstatus, 'grid', json_array(json_array(o_orderkey % 9), json_array())) END,
                    'priority', nullif(o_orderpriority, '5-LOW')),
                'review', CASE WHEN o_orderkey % 5 <> 0 THEN json_array(
                    json_object('by', o_orderpriority, 'grade', CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 7 END,
                        'marks', CASE WHEN o_orderkey % 4 = 0 THEN json_array(o_orderkey % 2, NULL) ELSE json_array() END),
                    CASE WHEN o_orderkey % 2 <> 0 THEN json_object('by', NULL, 'grade', NULL, 'marks', NULL) END) END)::VARCHAR AS line,
                CASE o_orderkey % 8 WHEN 1 THEN ',"extra":{"x":' || o_orderkey || '}' WHEN 2 THEN ',"extra":"none"'
                    WHEN 3 THEN ',"extra":{"l1":{"l2":{"l3":{"l4":[[{"l5":1}]]}}}}' ELSE '' END AS other
            FROM orders),
        found AS (
            SELECT DISTINCT k, substr(replace(regexp_replace(fullkey, '\[[0-9]+\]', '[]', 'g'), '"', ''), 3) AS path
            FROM parts, json_tree((left(line, length(line) - 1) || other || '}')::JSON) t WHERE t.type <> 'NULL' AND fullkey <> '$')
        SELECT path, round(count(*) * 100.0 / (SELECT count(*) FROM orders), 1) AS presence_pct FROM found GROUP BY path""",
    "profile_times": _with(
        """SELECT resource_type, field, count(*) FILTER (form = 'read') AS read, count(*) FILTER (form = 'lost') AS lost,
                  count(*) FILTER (form = 'malformed') AS malformed
           FROM (SELECT 'Encounter' AS resource_type, 'period.start' AS field,
                        CASE WHEN o_orderkey % 83 = 2 THEN 'malformed' ELSE 'read' END AS form FROM orders
                 UNION ALL SELECT 'Encounter', 'period.end', 'read' FROM orders
                 UNION ALL SELECT 'Observation', 'effectiveDateTime', CASE WHEN event_id % 50 = 0 THEN 'lost' ELSE 'read' END FROM events
                 UNION ALL SELECT 'Condition', 'onsetDateTime', CASE WHEN (l_orderkey + l_linenumber) % 73 = 2 THEN 'malformed' ELSE 'read' END FROM line
                 UNION ALL SELECT 'Condition', 'abatementDateTime', 'read' FROM line WHERE l_linenumber % 2 = 0
                 UNION ALL SELECT 'Condition', 'recordedDate', 'lost' FROM line
                 UNION ALL SELECT 'Procedure', 'performedPeriod.start', 'read' FROM line
                 UNION ALL SELECT 'Procedure', 'performedPeriod.end',
                     CASE WHEN (l_orderkey + l_linenumber) % 61 = 5 THEN 'malformed' ELSE 'read' END FROM line
                 UNION ALL SELECT 'MedicationRequest', 'authoredOn', 'read' FROM line)
           GROUP BY ALL""",
        "line",
    ),
    "profile_encounter": _with(
        """SELECT 'class' AS metric, encounter_class_code AS value, count(*) AS frequency FROM encounter GROUP BY 2
           UNION ALL SELECT 'status', status, count(*) FROM encounter GROUP BY 2""",
        "encounter",
    ),
    "profile_period_stats": _with(
        _period("start", "start_time", _START_OK) + " UNION ALL " + _period("end", "end_time", ""),
        "encounter",
    ),
    "profile_patient": _with(
        """SELECT 'gender' AS metric, CASE WHEN c_custkey % 103 = 9 THEN 'M' ELSE gender END AS value,
                  CAST(count(*) AS DOUBLE) AS amount FROM patient WHERE c_custkey % 101 <> 7 GROUP BY 2
           UNION ALL SELECT 'birth_decade', year(CAST(birth_date AS DATE)) // 10 * 10 || 's', count(*)
                     FROM patient WHERE c_custkey % 107 <> 11 GROUP BY 2
           UNION ALL SELECT 'deceased_pct', 'all', round(100.0 * count(deceased_date) / count(*), 1) FROM patient""",
        "patient",
    ),
    "top_conditions": _with(
        """SELECT snomed_code AS code, max(snomed_display) AS display, count(*) AS frequency
           FROM condition GROUP BY 1 ORDER BY frequency DESC, code LIMIT 10""",
        "condition",
    ),
    "sample_entities": """
        SELECT CAST(c_custkey AS VARCHAR) AS patient_id FROM customer
        ORDER BY md5(CAST(c_custkey AS VARCHAR) || '|42'), CAST(c_custkey AS VARCHAR) LIMIT 50""",
    "sample_linked": f"SELECT file_name, id FROM ({_KEPT}) WHERE kept",
    "sample_written": f"SELECT file_name, split_part(file_name, '.', 1) AS resource_type, id FROM ({_KEPT}) WHERE kept",
    "sample_summary": f"""
        SELECT file_name, count(*) AS records_in, count(*) FILTER (kept) AS records_kept,
               round(100.0 * count(*) FILTER (kept) / count(*), 1) AS pct_kept
        FROM ({_KEPT}) GROUP BY file_name""",
}
_HEX = "md5(patient_id)"
ORACLE_SQL["patient_lookup"] = f"""
    WITH profiles AS ({ORACLE_SQL["entity_profile"]})
    SELECT * REPLACE (concat_ws('-', {_HEX}[1:8], {_HEX}[9:12], {_HEX}[13:16], {_HEX}[17:20], {_HEX}[21:32]) AS patient_id)
    FROM profiles WHERE CAST(patient_id AS BIGINT) = (SELECT max(CAST(patient_id AS BIGINT)) FROM profiles)"""
