"""Declared record schemas, so that reading needs no inference pass over the input.

Each schema holds the fields the flat tables, the contracts and the note corpus read. Fields
outside it are skipped by the parser; read without a schema to keep every field.
"""

from __future__ import annotations

from pyspark.sql import types as T

_REFERENCE = "STRUCT<reference: STRING>"
_CODING = "STRUCT<system: STRING, code: STRING, display: STRING>"
_CONCEPT = f"STRUCT<coding: ARRAY<{_CODING}>, text: STRING>"
_PERIOD = "STRUCT<start: STRING, `end`: STRING>"
_ADDRESS = (
    "ARRAY<STRUCT<line: ARRAY<STRING>, city: STRING, state: STRING, postalCode: STRING, country: STRING>>"
)
_TELECOM = "ARRAY<STRUCT<system: STRING, value: STRING>>"
_QUANTITY = "STRUCT<value: DOUBLE, unit: STRING>"

_DDL = {
    "Patient": f"""
        id STRING, gender STRING, birthDate STRING, deceasedDateTime STRING,
        address {_ADDRESS}, maritalStatus {_CONCEPT},
        extension ARRAY<STRUCT<url: STRING, extension: ARRAY<STRUCT<url: STRING, valueCoding: {_CODING}>>>>""",
    "Encounter": f"""
        id STRING, status STRING, class {_CODING}, type ARRAY<{_CONCEPT}>, subject {_REFERENCE},
        period {_PERIOD}, reasonCode ARRAY<{_CONCEPT}>,
        hospitalization STRUCT<dischargeDisposition: {_CONCEPT}>,
        location ARRAY<STRUCT<location: STRUCT<display: STRING>>>, serviceProvider {_REFERENCE},
        participant ARRAY<STRUCT<individual: {_REFERENCE}>>""",
    "Condition": f"""
        id STRING, clinicalStatus {_CONCEPT}, verificationStatus {_CONCEPT}, category ARRAY<{_CONCEPT}>,
        code {_CONCEPT}, subject {_REFERENCE}, encounter {_REFERENCE},
        onsetDateTime STRING, abatementDateTime STRING, recordedDate STRING""",
    "Procedure": f"""
        id STRING, status STRING, code {_CONCEPT}, subject {_REFERENCE}, encounter {_REFERENCE},
        performedDateTime STRING, performedPeriod {_PERIOD}, reasonCode ARRAY<{_CONCEPT}>""",
    "Observation": f"""
        id STRING, status STRING, category ARRAY<{_CONCEPT}>, code {_CONCEPT}, subject {_REFERENCE},
        encounter {_REFERENCE}, effectiveDateTime STRING, valueQuantity {_QUANTITY},
        valueCodeableConcept {_CONCEPT}, valueString STRING,
        component ARRAY<STRUCT<code: {_CONCEPT}, valueQuantity: {_QUANTITY}>>""",
    "MedicationRequest": f"""
        id STRING, status STRING, intent STRING, medicationCodeableConcept {_CONCEPT},
        subject {_REFERENCE}, encounter {_REFERENCE}, authoredOn STRING, requester {_REFERENCE}""",
    "Organization": f"""
        id STRING, name STRING, type ARRAY<{_CONCEPT}>, address {_ADDRESS}, telecom {_TELECOM}""",
    "Practitioner": f"""
        id STRING, name ARRAY<STRUCT<family: STRING, given: ARRAY<STRING>, prefix: ARRAY<STRING>>>,
        gender STRING, address {_ADDRESS}, telecom {_TELECOM}""",
    "DocumentReference": f"""
        id STRING, subject {_REFERENCE}, date STRING,
        content ARRAY<STRUCT<attachment: STRUCT<contentType: STRING, data: STRING>>>""",
}


def declared_schema(resource_name: str) -> T.StructType | None:
    """Schema of a resource type, or None where only inference can tell."""
    ddl = _DDL.get(resource_name)
    return T.StructType.fromDDL(ddl) if ddl else None
