"""Hash keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._columns import as_column

# Fixed value: stands for NULL inside a surrogate key.
NULL_MARK = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*parts: Column | str) -> Column:
    """md5 over the parts as text, joined by ``-``."""
    texts = [F.coalesce(as_column(p).cast("string"), F.lit(NULL_MARK)) for p in parts]
    return F.md5(F.concat_ws("-", *texts))


def version_id(key: Column | str, updated_at: Column | str) -> Column:
    """md5 identifying one version of one entity."""
    texts = [F.coalesce(as_column(p).cast("string"), F.lit("")) for p in (key, updated_at)]
    return F.md5(F.concat_ws("|", *texts))


def row_hash(columns: Sequence[str]) -> Column:
    """SHA-256 over the record as JSON; NULL fields leave no trace in it."""
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns])), 256)


def record_hash(text: Column | str) -> Column:
    """SHA-256 over all fields of a JSON object, whatever their order; NULL ones leave no trace in it."""
    fields = F.from_json(as_column(text), "map<string,string>")
    known = F.map_filter(fields, lambda _, value: value.isNotNull())
    return F.sha2(F.to_json(F.array_sort(F.map_entries(known))), 256)
