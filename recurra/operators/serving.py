"""Per-patient profile and cohort roster."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import age_years

PROFILE_PATIENT = ("gender", "race_display", "ethnicity_display", "marital_status_code", "birth_date")


def with_role_dates(
    facts: DataFrame, dim_date: DataFrame, roles: dict[str, str]
) -> DataFrame:
    """Join the calendar once per role: {date key column: name of the day column to add}.

    The calendar is a fixed number of days, hence broadcast.
    """
    for key, name in roles.items():
        days = dim_date.select(F.col("date_key").alias(key), F.col("full_date").alias(name))
        facts = facts.join(F.broadcast(days), key, "left")
    return facts


def entity_profiles(
    fact_readmission: DataFrame,
    fact_encounter: DataFrame,
    dim_patient: DataFrame,
    dim_date: DataFrame,
) -> DataFrame:
    """One row per patient: demographics, latest index admission and readmission history.

    The latest admission and the ever-readmitted flag are running maxima per patient version,
    taken before patients are joined, so a long history never gathers in one task.
    """
    classes = fact_encounter.select(
        F.col("encounter_key").alias("index_encounter_key"), "encounter_class_code"
    )
    admissions = with_role_dates(
        fact_readmission.join(classes, "index_encounter_key"),
        dim_date,
        {
            "index_admission_date_key": "index_admission_date",
            "index_discharge_date_key": "index_discharge_date",
        },
    )
    latest = F.struct(
        "index_admission_date",
        "index_encounter_id",
        "encounter_class_code",
        "index_discharge_date",
        F.round(F.col("index_length_of_stay_hours") / 24.0, 1).alias("length_of_stay_days"),
        "days_to_readmission",
        "was_readmitted_30d",
        "is_likely_transfer",
        "was_readmitted_30d_excl_transfers",
    )
    per_version = admissions.groupBy("patient_key").agg(
        F.max(latest).alias("latest"),
        F.max("was_readmitted_30d_excl_transfers").alias("ever"),
    )
    described = per_version.join(
        dim_patient.select("patient_key", "patient_id", *PROFILE_PATIENT), "patient_key"
    )
    person = F.struct("latest", *PROFILE_PATIENT)
    per_patient = described.groupBy("patient_id").agg(
        F.max(person).alias("p"), F.max("ever").alias("ever_readmitted_30d")
    )
    admitted, left = F.col("p.latest.index_admission_date"), F.col("p.latest.index_discharge_date")
    return per_patient.select(
        "patient_id",
        "p.gender",
        "p.race_display",
        "p.ethnicity_display",
        "p.marital_status_code",
        age_years("p.birth_date", admitted).alias("age_at_admission"),
        "p.latest.encounter_class_code",
        admitted.cast("string").alias("index_admission_date"),
        left.cast("string").alias("index_discharge_date"),
        "p.latest.length_of_stay_days",
        "p.latest.days_to_readmission",
        "p.latest.was_readmitted_30d",
        "p.latest.is_likely_transfer",
        "p.latest.was_readmitted_30d_excl_transfers",
        "ever_readmitted_30d",
    )


def canonical_id(patient_id: str) -> str:
    """The id in its one spelling; what is no UUID never gets into a query."""
    try:
        return str(uuid.UUID(patient_id))
    except (ValueError, AttributeError, TypeError):
        raise ValueError(f"{patient_id!r} is not the UUID of a patient") from None


def entity_profile(
    patient_id: str,
    fact_readmission: DataFrame,
    fact_encounter: DataFrame,
    dim_patient: DataFrame,
    dim_date: DataFrame,
) -> DataFrame:
    """The profile of one patient; the id is applied where patients are scanned."""
    wanted = F.lit(canonical_id(patient_id))
    versions = dim_patient.filter(F.col("patient_id") == wanted)
    mine = fact_readmission.join(versions.select("patient_key"), "patient_key", "left_semi")
    return entity_profiles(mine, fact_encounter, versions, dim_date)


def cohort(fact_readmission: DataFrame, dim_patient: DataFrame) -> DataFrame:
    """Distinct patients with an index admission."""
    keys = fact_readmission.select("patient_key").distinct()
    return dim_patient.join(keys, "patient_key", "left_semi").select("patient_id").distinct()


def first_patients(patients: DataFrame, n_patients: int) -> DataFrame:
    """The first ``n_patients`` by id, for callers that want a bounded roster or note corpus."""
    return patients.orderBy("patient_id").limit(n_patients)


def cohort_roster(
    fact_readmission: DataFrame, dim_patient: DataFrame, as_of: Column, n_patients: int | None = None
) -> DataFrame:
    """Roster with gender, age on ``as_of`` and whether ever readmitted, of all or the first patients."""
    per_version = fact_readmission.groupBy("patient_key").agg(
        F.max(F.col("was_readmitted_30d_excl_transfers").cast("int")).alias("ever")
    )
    people = per_version.join(
        dim_patient.select("patient_key", "patient_id", "gender", "birth_date"), "patient_key"
    )
    roster = people.groupBy("patient_id").agg(
        F.max("gender").alias("gender"),
        F.max(age_years("birth_date", as_of)).alias("age"),
        F.max("ever").alias("ever_readmitted"),
    )
    return roster if n_patients is None else first_patients(roster, n_patients)
