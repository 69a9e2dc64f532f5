"""Access to coded concepts and tagged lists. Missing or empty lists give NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._columns import as_column


def first(array: Column | str) -> Column:
    return F.get(as_column(array), F.lit(0))


def coding(concept: Column | str, field: str) -> Column:
    """``field`` of the first coding of a concept."""
    return first(as_column(concept).getField("coding")).getField(field)


def first_where(array: Column | str, predicate) -> Column:
    return first(F.filter(as_column(array), predicate))


def extension_value(extensions: Column | str, url_suffix: str, field: str) -> Column:
    """``field`` of the first nested coding of the extension whose url ends in ``url_suffix``."""
    tagged = first_where(extensions, lambda x: x["url"].endswith(url_suffix))
    return first(tagged.getField("extension")).getField("valueCoding").getField(field)
