"""Date and time parsing, ages and calendar keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._columns import as_column

# The one dateTime layout the flat tables accept, and the mean year length.
STRICT_INSTANT = "yyyy-MM-dd'T'HH:mm:ssXXX"
DAYS_PER_YEAR = 365.25


def parse_instant(text: Column | str) -> Column:
    """Strict parse with whole seconds and an offset; anything else is NULL."""
    return F.try_to_timestamp(as_column(text), F.lit(STRICT_INSTANT))


def parse_iso(text: Column | str) -> Column:
    """Lenient ISO-8601 parse: ``Z``, offset or none (taken as UTC); NULL when malformed."""
    value = as_column(text)
    looks_iso = value.rlike(
        r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}(\.\d{1,6})?)?)?(Z|[+-]\d{2}:?\d{2})?)?$"
    )
    # An hour without minutes is valid ISO text but not a Spark literal.
    whole = F.regexp_replace(value, r"^(.{10}[T ]\d{2})(?=(Z|[+-]\d{2}:?\d{2})?$)", "$1:00")
    return F.when(looks_iso, whole.try_cast("timestamp"))


def parse_iso_day(text: Column | str) -> Column:
    """``yyyy-MM-dd`` to a date; NULL when malformed."""
    value = as_column(text)
    return F.when(value.rlike(r"^\d{4}-\d{2}-\d{2}$"), value.try_cast("date"))


def iso_text(instant: Column | str) -> Column:
    """UTC ISO text ending in ``Z``; the fraction appears only where there is one."""
    value = as_column(instant)
    has_fraction = F.unix_micros(value) % 1_000_000 != 0
    return F.when(has_fraction, F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).otherwise(
        F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )


def date_key(instant: Column | str) -> Column:
    """Calendar day as the integer ``yyyyMMdd``."""
    return F.date_format(as_column(instant), "yyyyMMdd").cast("int")


def age_years(birth_date: Column | str, on: Column | str) -> Column:
    """Whole years between a birth date (text or date) and a day."""
    born = as_column(birth_date).try_cast("date")
    return F.floor(F.datediff(as_column(on), born) / F.lit(DAYS_PER_YEAR)).cast("int")


def hours_between(start: Column | str, end: Column | str) -> Column:
    seconds = F.unix_timestamp(as_column(end)) - F.unix_timestamp(as_column(start))
    return seconds / F.lit(3600.0)
