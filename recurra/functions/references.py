"""The three ways a resource reference is reduced to a bare id.

They differ on purpose: the flat tables, the contract objects and the note corpus each
follow their own rule, and results only agree if each keeps it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._columns import as_column


def reference_id(reference: Column | str) -> Column:
    """Id for the flat tables: the part after ``|``, else without ``Type/`` or ``urn:uuid:``."""
    ref = as_column(reference)
    return F.when(ref.contains("|"), F.get(F.split(ref, r"\|"), F.lit(1))).otherwise(
        F.regexp_replace(ref, "^([A-Za-z]+/|urn:uuid:)", "")
    )


def target_id(reference: Column | str) -> Column:
    """Id of a contract reference: no ``urn:uuid:``, last path segment, web addresses kept whole."""
    bare = F.regexp_replace(as_column(reference), "^urn:uuid:", "")
    is_path = bare.contains("/") & ~bare.startswith("http")
    return F.when(is_path, F.substring_index(bare, "/", -1)).otherwise(bare)


def trailing_id(reference: Column | str) -> Column:
    """Id for notes: whatever follows the last ``/`` or ``:``."""
    return F.regexp_extract(as_column(reference), "([^/:]+)$", 1)
