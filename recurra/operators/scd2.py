"""Type-2 history: one row per version of an entity with the time it was valid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import version_id

# The columns whose change makes a new version.
CHECKED_COLUMNS = {
    "patient": ("address_city", "address_state", "address_postal_code", "marital_status_code"),
    "organization": ("name", "address_city", "address_state", "address_postal_code"),
    "practitioner": ("family_name", "given_name", "address_city", "address_state"),
}
VERSION_COLUMNS = ("dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to")


def _opened(key: str, run_at: Column) -> list[Column]:
    return [
        version_id(key, run_at).alias("dbt_scd_id"),
        run_at.alias("dbt_updated_at"),
        run_at.alias("dbt_valid_from"),
        F.lit(None).cast("timestamp").alias("dbt_valid_to"),
    ]


def initial_snapshot(source: DataFrame, key: str, run_at: Column, unique: bool = False) -> DataFrame:
    """Every source row as an open version; ``unique`` if the keys are known to be."""
    source = source if unique else _once_per_key(source, key)
    return source.select("*", *_opened(key, run_at))


def _once_per_key(source: DataFrame, key: str) -> DataFrame:
    """``source``, or an error if it holds a key twice. Copies of a key combine on the map side."""
    rest = [c for c in source.columns if c != key]
    name = F.coalesce(F.col(key).cast("string"), F.lit("NULL"))
    message = F.concat(F.lit(f"{key} is not unique in the source: "), name)
    counted = source.groupBy(key).agg(F.count(F.lit(1)).alias("_copies"), F.any_value(F.struct(F.lit(0), *rest)).alias("_row"))
    once = counted.filter(F.when(F.col("_copies") == 1, True).otherwise(F.raise_error(message).cast("boolean")))
    # The key stays the grouping column, so a join on it needs no second shuffle.
    return once.select(*[F.col(key) if c == key else F.col("_row")[c].alias(c) for c in source.columns])


def changed_versions(
    open_rows: DataFrame,
    source: DataFrame,
    key: str,
    checked: Sequence[str],
    run_at: Column,
    close_missing: bool = True,
) -> DataFrame:
    """The open versions after a run and those it closes, from the open versions before it."""
    columns = [*source.columns, *VERSION_COLUMNS]
    source = _once_per_key(source, key)
    held = open_rows.select(F.col(key).alias("_key"), F.struct(*columns).alias("_old"))
    new_rows = initial_snapshot(source, key, run_at, unique=True).select(F.col(key).alias("_key"), F.struct(*columns).alias("_new"))
    pairs = held.join(new_rows, "_key", "full_outer")

    old, new = F.col("_old"), F.col("_new")
    changed = F.lit(False)
    for column in checked:
        changed = changed | ~old[column].eqNullSafe(new[column])
    ended = F.struct(
        *[run_at.alias(c) if c == "dbt_valid_to" else old[c].alias(c) for c in columns]
    )
    outcome = (
        F.when(old.isNull(), F.array(new))
        .when(new.isNull(), F.array(ended if close_missing else old))
        .when(changed, F.array(ended, new))
        .otherwise(F.array(old))
    )
    return pairs.select(F.inline(outcome))


def merge_snapshot(
    state: DataFrame | None,
    source: DataFrame,
    key: str,
    checked: Sequence[str],
    run_at: Column,
    close_missing: bool = True,
) -> DataFrame:
    """State after a run at ``run_at``.

    A change in a checked column, told apart NULL-safely, closes the open version and opens a
    new one. Other columns keep the value they had when the version was opened. An entity gone
    from the source is closed if ``close_missing``, and opened afresh when it comes back. Closed
    versions are passed on without a shuffle; open ones meet the source in one join per run.

    A column that the source gained is NULL in the versions before it. A key that the source holds
    twice stops the run, since it would open two versions.
    """
    if state is None:
        return initial_snapshot(source, key, run_at)
    for f in source.schema:
        if f.name not in state.columns:
            state = state.withColumn(f.name, F.lit(None).cast(f.dataType))
    columns = [*source.columns, *VERSION_COLUMNS]
    closed = state.filter(F.col("dbt_valid_to").isNotNull()).select(*columns)

    open_rows = state.filter(F.col("dbt_valid_to").isNull())
    return closed.unionByName(changed_versions(open_rows, source, key, checked, run_at, close_missing))
