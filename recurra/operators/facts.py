"""Facts of the star schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key
from ..functions.times import date_key
from .asof import asof_join
from .ordered import asof_in_order
from .repeat import repeat_events, repeat_events_in_order
from .skew import HOT_ROWS


def join_current(
    facts: DataFrame, versions: DataFrame, fact_key: str, version_key: str, *columns: str
) -> DataFrame:
    """Left join of the current version's columns.

    Spark broadcasts the current versions while they are below its size threshold and
    otherwise joins by shuffle, splitting a key that is hot on the fact side. Facts without a key
    match nothing; a hash of the row keeps them from gathering in one task.
    """
    anywhere = F.when(F.col(fact_key).isNull(), F.pmod(F.xxhash64(*facts.columns), F.lit(4096))).otherwise(-1)
    current = versions.filter("is_current").select(
        F.col(version_key).alias("_key"), F.lit(-1).cast("long").alias("_spread"), *columns
    )
    spread = facts.withColumn("_at", anywhere.cast("long"))
    joined = spread.join(current, (F.col(fact_key) == F.col("_key")) & (F.col("_at") == F.col("_spread")), "left")
    return joined.drop("_key", "_spread", "_at")


def fact_encounter(
    encounter: DataFrame,
    dim_patient: DataFrame,
    dim_organization: DataFrame,
    hot_rows: int | None = None,
) -> DataFrame:
    """One row per encounter with the patient version valid at admission.

    Encounters and versions are merged in order of time; with ``hot_rows`` they are joined on the patient,
    patients with more encounters cut into slices.
    """
    versions = dim_patient.select("patient_key", "patient_id", "valid_from", "valid_to")
    visits = encounter.select(
        "encounter_id",
        "patient_id",
        "start_time",
        "end_time",
        "service_provider_id",
        "encounter_class_code",
        "encounter_class_display",
        "status",
        "encounter_type_code",
        "discharge_disposition_code",
        "length_of_stay_hours",
    )
    if hot_rows is None:
        visits = asof_in_order(visits, versions, "patient_id", "start_time")
    else:
        visits = asof_join(visits, versions, "patient_id", "start_time", hot_rows=hot_rows)
    visits = join_current(
        visits, dim_organization, "service_provider_id", "organization_id", "organization_key"
    )
    return visits.select(
        surrogate_key("encounter_id").alias("encounter_key"),
        "encounter_id",
        "patient_key",
        "organization_key",
        date_key("start_time").alias("admission_date_key"),
        date_key("end_time").alias("discharge_date_key"),
        "encounter_class_code",
        "encounter_class_display",
        "status",
        "encounter_type_code",
        "discharge_disposition_code",
        "length_of_stay_hours",
    )


def index_admissions(
    encounter: DataFrame,
    classes: Sequence[str] = ("IMP",),
    horizon_days: int = 30,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Inpatient admissions with their next admission and the readmission flags.

    Lazy, with patients above ``hot_rows`` cut into slices. With None admissions are written in ranges of
    patient and time first (``ordered.in_ranges``), which spreads any patient, day or missing time.
    """
    stays = encounter.filter(F.col("encounter_class_code").isin(*classes)).select(
        "encounter_id",
        "patient_id",
        F.col("start_time").alias("admission_time"),
        F.col("end_time").alias("discharge_time"),
    )
    names = ("patient_id", "admission_time", "discharge_time", "encounter_id", horizon_days)
    repeats = repeat_events_in_order(stays, *names) if hot_rows is None else repeat_events(stays, *names, hot_rows)
    return repeats.select(
        *stays.columns,
        F.col("next_start").alias("next_admission_time"),
        F.col("next_id").alias("next_encounter_id"),
        F.col("days_to_next").alias("days_to_readmission"),
        F.col("is_repeat").alias("was_readmitted_30d"),
        F.col("is_same_day").alias("is_likely_transfer"),
        F.col("is_repeat_excl_same_day").alias("was_readmitted_30d_excl_transfers"),
    )


def fact_readmission(
    encounter: DataFrame,
    fact_encounter: DataFrame,
    hot_rows: int | None = None,
    admissions: DataFrame | None = None,
) -> DataFrame:
    """One row per index admission, with the keys of its encounter fact.

    ``admissions`` are the ``index_admissions`` of the encounters, if they are there already.
    """
    if admissions is None:
        admissions = index_admissions(encounter, hot_rows=hot_rows)
    keys = fact_encounter.select(
        "encounter_id",
        "encounter_key",
        "patient_key",
        "admission_date_key",
        "discharge_date_key",
        "length_of_stay_hours",
    )
    return (
        admissions.join(keys, "encounter_id")
        .select(
            F.col("encounter_key").alias("readmission_key"),
            F.col("encounter_key").alias("index_encounter_key"),
            "patient_key",
            F.col("encounter_id").alias("index_encounter_id"),
            F.col("admission_date_key").alias("index_admission_date_key"),
            F.col("discharge_date_key").alias("index_discharge_date_key"),
            F.col("length_of_stay_hours").alias("index_length_of_stay_hours"),
            "next_encounter_id",
            "days_to_readmission",
            "was_readmitted_30d",
            "is_likely_transfer",
            "was_readmitted_30d_excl_transfers",
        )
    )
