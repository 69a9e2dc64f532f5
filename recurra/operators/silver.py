"""Flat, typed tables from nested records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codings import coding, extension_value, first, first_where
from ..functions.references import reference_id
from ..functions.times import hours_between, parse_instant
from ..sources.provenance import PROVENANCE_COLUMNS

# Wording of the encounter class codes.
CLASS_DISPLAYS = {
    "IMP": "inpatient encounter",
    "AMB": "ambulatory",
    "EMER": "emergency",
    "HH": "home health",
    "VR": "virtual",
}


def _flat(records: DataFrame, **columns: Column) -> DataFrame:
    """The given columns plus the record's provenance under ``_bronze_*`` names."""
    lineage = [F.col(c).alias(f"_bronze{c}") for c in PROVENANCE_COLUMNS if c in records.columns]
    return records.select(*[c.alias(name) for name, c in columns.items()], *lineage)


def _class_display(code: Column) -> Column:
    display = code
    for known, wording in CLASS_DISPLAYS.items():
        display = F.when(code == known, wording).otherwise(display)
    return display


def patient(records: DataFrame) -> DataFrame:
    home = first("address")
    return _flat(
        records,
        patient_id=F.col("id"),
        gender=F.col("gender"),
        birth_date=F.col("birthDate"),
        deceased_date=F.col("deceasedDateTime"),
        marital_status_code=coding("maritalStatus", "code"),
        race_code=extension_value("extension", "us-core-race", "code"),
        race_display=extension_value("extension", "us-core-race", "display"),
        ethnicity_code=extension_value("extension", "us-core-ethnicity", "code"),
        ethnicity_display=extension_value("extension", "us-core-ethnicity", "display"),
        address_city=home["city"],
        address_state=home["state"],
        address_postal_code=home["postalCode"],
        address_country=home["country"],
    )


def encounter(records: DataFrame) -> DataFrame:
    start, end = parse_instant("period.start"), parse_instant("period.end")
    return _flat(
        records,
        encounter_id=F.col("id"),
        status=F.col("status"),
        encounter_class_code=F.col("class.code"),
        encounter_class_display=_class_display(F.col("class.code")),
        encounter_type_code=coding(first("type"), "code"),
        encounter_type_display=coding(first("type"), "display"),
        patient_id=reference_id("subject.reference"),
        start_time=start,
        end_time=end,
        service_provider_id=reference_id("serviceProvider.reference"),
        discharge_disposition_code=coding("hospitalization.dischargeDisposition", "code"),
        discharge_disposition_display=coding("hospitalization.dischargeDisposition", "display"),
        reason_code=coding(first("reasonCode"), "code"),
        reason_display=coding(first("reasonCode"), "display"),
        length_of_stay_hours=hours_between(start, end),
    )


def condition(records: DataFrame) -> DataFrame:
    return _flat(
        records,
        condition_id=F.col("id"),
        patient_id=reference_id("subject.reference"),
        encounter_id=reference_id("encounter.reference"),
        snomed_code=coding("code", "code"),
        snomed_display=coding("code", "display"),
        clinical_status=coding("clinicalStatus", "code"),
        verification_status=coding("verificationStatus", "code"),
        category_code=coding(first("category"), "code"),
        onset_time=parse_instant("onsetDateTime"),
        abatement_time=parse_instant("abatementDateTime"),
        recorded_time=parse_instant("recordedDate"),
    )


def procedure(records: DataFrame) -> DataFrame:
    return _flat(
        records,
        procedure_id=F.col("id"),
        patient_id=reference_id("subject.reference"),
        encounter_id=reference_id("encounter.reference"),
        snomed_code=coding("code", "code"),
        snomed_display=coding("code", "display"),
        status=F.col("status"),
        performed_start=parse_instant("performedPeriod.start"),
        performed_end=parse_instant("performedPeriod.end"),
        reason_code=coding(first("reasonCode"), "code"),
    )


def observation(records: DataFrame) -> DataFrame:
    """A value comes in one of several shapes, each with its own nullable column."""
    return _flat(
        records,
        observation_id=F.col("id"),
        patient_id=reference_id("subject.reference"),
        encounter_id=reference_id("encounter.reference"),
        status=F.col("status"),
        category_code=coding(first("category"), "code"),
        loinc_code=coding("code", "code"),
        loinc_display=coding("code", "display"),
        effective_time=parse_instant("effectiveDateTime"),
        value_number=F.col("valueQuantity.value"),
        value_unit=F.col("valueQuantity.unit"),
        value_code=coding("valueCodeableConcept", "code"),
        value_display=coding("valueCodeableConcept", "display"),
        value_text=F.col("valueString"),
    )


def medication_request(records: DataFrame) -> DataFrame:
    return _flat(
        records,
        medication_request_id=F.col("id"),
        patient_id=reference_id("subject.reference"),
        encounter_id=reference_id("encounter.reference"),
        rxnorm_code=coding("medicationCodeableConcept", "code"),
        rxnorm_display=coding("medicationCodeableConcept", "display"),
        status=F.col("status"),
        intent=F.col("intent"),
        authored_time=parse_instant("authoredOn"),
        requester_id=reference_id("requester.reference"),
    )


def organization(records: DataFrame) -> DataFrame:
    site = first("address")
    return _flat(
        records,
        organization_id=F.col("id"),
        name=F.col("name"),
        type_code=coding(first("type"), "code"),
        type_display=coding(first("type"), "display"),
        address_line=first(site["line"]),
        address_city=site["city"],
        address_state=site["state"],
        address_postal_code=site["postalCode"],
        phone=first("telecom")["value"],
    )


def practitioner(records: DataFrame) -> DataFrame:
    name, site = first("name"), first("address")
    return _flat(
        records,
        practitioner_id=F.col("id"),
        family_name=name["family"],
        given_name=first(name["given"]),
        prefix=first(name["prefix"]),
        gender=F.col("gender"),
        address_city=site["city"],
        address_state=site["state"],
        email=first_where("telecom", lambda x: x["system"] == "email")["value"],
    )


# Table name: record type and flattener.
FLATTENERS = {
    "patient": ("Patient", patient),
    "encounter": ("Encounter", encounter),
    "condition": ("Condition", condition),
    "procedure": ("Procedure", procedure),
    "observation": ("Observation", observation),
    "medication_request": ("MedicationRequest", medication_request),
    "organization": ("Organization", organization),
    "practitioner": ("Practitioner", practitioner),
}
