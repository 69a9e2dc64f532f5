"""Readmission rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FLAGS = {
    "readmissions_raw": "was_readmitted_30d",
    "likely_transfers": "is_likely_transfer",
    "readmissions": "was_readmitted_30d_excl_transfers",
}


def _counted(admissions: DataFrame, *by: str) -> DataFrame:
    return admissions.groupBy(*by).agg(
        F.count(F.lit(1)).alias("index_admissions"),
        *[F.count_if(flag).alias(name) for name, flag in FLAGS.items()],
    )


def _with_rates(counts: DataFrame) -> DataFrame:
    """Transfers leave the numerator only."""
    total = F.nullif("index_admissions", F.lit(0))
    return counts.withColumns(
        {
            "readmission_rate_raw": F.col("readmissions_raw") / total,
            "readmission_rate": F.col("readmissions") / total,
        }
    )


def readmission_rate(admissions: DataFrame) -> DataFrame:
    """One row over all index admissions."""
    return _with_rates(_counted(admissions))


def rate_by_attribute(
    fact_readmission: DataFrame, dim_patient: DataFrame, attributes: Sequence[str]
) -> DataFrame:
    """The rate broken down by each patient attribute, one row per attribute and value.

    Admissions are counted per patient version before anything is joined, so the join is one
    row per version on both sides and a patient with many admissions weighs no more than others.
    Admissions without a version (the patient was not listed then) are counted under a NULL value, so
    every attribute adds up to the overall rate.
    """
    per_version = _counted(fact_readmission, "patient_key")
    described = per_version.join(dim_patient.select("patient_key", *attributes), "patient_key", "left")
    pairs = F.inline(
        F.array(
            *[
                F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("value"))
                for a in attributes
            ]
        )
    )
    names = ("index_admissions", *FLAGS)
    totals = (
        described.select(*names, pairs)
        .groupBy("attribute", "value")
        .agg(*[F.sum(n).alias(n) for n in names])
    )
    return _with_rates(totals)
