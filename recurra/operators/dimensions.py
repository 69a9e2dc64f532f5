"""Dimensions of the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key
from ..functions.times import date_key

# First day, day after the last one, and the start given to first versions.
CALENDAR_START, CALENDAR_END = "1900-01-01", "2030-01-01"
BEGINNING = "1900-01-01"


def dim_date(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """One row per day, the end excluded."""
    days = spark.range(1).select(
        F.explode(
            F.sequence(F.lit(start).cast("date"), F.date_sub(F.lit(end).cast("date"), 1))
        ).alias("full_date")
    )
    return days.select(
        date_key("full_date").alias("date_key"),
        "full_date",
        F.year("full_date").alias("year"),
        F.quarter("full_date").alias("quarter"),
        F.month("full_date").alias("month"),
        F.date_format("full_date", "MMMM").alias("month_name"),
        F.dayofmonth("full_date").alias("day_of_month"),
        F.dayofweek("full_date").alias("day_of_week"),
        F.date_format("full_date", "EEEE").alias("day_name"),
        F.dayofweek("full_date").isin(1, 7).alias("is_weekend"),
    )


def _versioned(
    snapshot: DataFrame, key_name: str, key: str, columns: tuple[str, ...], valid_from: Column
) -> DataFrame:
    return snapshot.select(
        surrogate_key(key, "dbt_valid_from").alias(key_name),
        key,
        *columns,
        valid_from.alias("valid_from"),
        F.col("dbt_valid_to").alias("valid_to"),
        F.col("dbt_valid_to").isNull().alias("is_current"),
        F.col("dbt_scd_id").alias("_snapshot_scd_id"),
    )


def dim_patient(snapshot: DataFrame) -> DataFrame:
    """Patient versions; each patient's first one is taken to be valid from the beginning.

    The window holds one patient's versions: a run adds at most one per patient, so their
    number is bounded by the number of runs.
    """
    first = F.min("dbt_valid_from").over(Window.partitionBy("patient_id"))
    back_dated = F.when(
        F.col("dbt_valid_from") == first, F.lit(BEGINNING).cast("timestamp")
    ).otherwise(F.col("dbt_valid_from"))
    return _versioned(
        snapshot,
        "patient_key",
        "patient_id",
        (
            "gender",
            "birth_date",
            "race_code",
            "race_display",
            "ethnicity_code",
            "ethnicity_display",
            "marital_status_code",
            "address_city",
            "address_state",
            "address_postal_code",
        ),
        back_dated,
    )


def dim_organization(snapshot: DataFrame) -> DataFrame:
    return _versioned(
        snapshot,
        "organization_key",
        "organization_id",
        (
            "name",
            "type_code",
            "type_display",
            "address_line",
            "address_city",
            "address_state",
            "address_postal_code",
            "phone",
        ),
        F.col("dbt_valid_from"),
    )


def dim_provider(snapshot: DataFrame) -> DataFrame:
    return _versioned(
        snapshot,
        "provider_key",
        "practitioner_id",
        (
            "family_name",
            "given_name",
            "prefix",
            "gender",
            "address_city",
            "address_state",
            "email",
        ),
        F.col("dbt_valid_from"),
    )


def dim_condition(condition: DataFrame) -> DataFrame:
    """One row per code with how often it occurs."""
    return (
        condition.filter(F.col("snomed_code").isNotNull())
        .groupBy("snomed_code")
        .agg(
            F.max("snomed_display").alias("snomed_display"),
            F.count(F.lit(1)).alias("occurrence_count"),
        )
        .select(
            surrogate_key("snomed_code").alias("condition_key"),
            "snomed_code",
            "snomed_display",
            "occurrence_count",
        )
    )
