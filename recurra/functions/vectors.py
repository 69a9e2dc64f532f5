"""Distances between two ``array<float>`` columns, computed in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._columns import as_column


def _sum_of(a: Column, b: Column, term) -> Column:
    products = F.zip_with(a, b, lambda x, y: term(x.cast("double"), y.cast("double")))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def squared_l2(a: Column | str, b: Column | str) -> Column:
    # Differences are taken once and squared while they are summed.
    apart = F.zip_with(as_column(a), as_column(b), lambda x, y: x.cast("double") - y.cast("double"))
    return F.aggregate(apart, F.lit(0.0), lambda total, x: total + x * x)


def squared_l2_written(a: str, b: str, size: int) -> Column:
    """``squared_l2`` of two columns, written out for vectors of ``size``.

    Spark compiles it, while it interprets lambdas; other sizes still take those. Sums run in the same order.
    """
    steps = [f"(CAST(get({a}, {i}) AS DOUBLE) - CAST(get({b}, {i}) AS DOUBLE))" for i in range(size)]
    total = F.expr(" + ".join(["0D", *(f"{d} * {d}" for d in steps)]))
    return F.when((F.size(a) == size) & (F.size(b) == size), total).otherwise(squared_l2(a, b))


def inner_product(a: Column | str, b: Column | str) -> Column:
    """One minus the dot product, so that smaller is closer."""
    return F.lit(1.0) - _sum_of(as_column(a), as_column(b), lambda x, y: x * y)


def cosine(a: Column | str, b: Column | str) -> Column:
    a, b = as_column(a), as_column(b)
    dot = _sum_of(a, b, lambda x, y: x * y)
    norms = F.sqrt(_sum_of(a, a, lambda x, y: x * y)) * F.sqrt(_sum_of(b, b, lambda x, y: x * y))
    return F.lit(1.0) - dot / F.nullif(norms, F.lit(0.0))


METRICS = {"l2": squared_l2, "ip": inner_product, "cosine": cosine}


#: Letters whose shares in a text make its vector.
LETTERS = "etaoinsrhldcumfp"


def text_vector(text: Column | str) -> Column:
    """Share of each of 16 letters in a text, without regard to case; NULL for an empty one.

    Letters are taken out one after the other, so the text is lowered once and gets shorter from step to step;
    what a step takes out, one byte a letter, is the letter's count.
    """

    def removed(rests: Column, letter: Column) -> Column:
        return F.array_append(rests, F.replace(F.element_at(rests, -1), letter, F.lit("")))

    def shares(sizes: Column, length: Column) -> Column:
        counts = [F.get(sizes, F.lit(i)) - F.get(sizes, F.lit(i + 1)) for i in range(len(LETTERS))]
        return F.when(length.isNotNull(), F.array(*[n / length for n in counts]))

    def vector(rests: Column) -> Column:
        sizes = F.transform(rests, F.octet_length)
        length = F.nullif(F.length(F.get(rests, F.lit(0))), F.lit(0))
        return F.get(F.transform(F.array(F.struct(sizes.alias("sizes"), length.alias("length"))), lambda x: shares(x["sizes"], x["length"])), F.lit(0))

    rests = F.aggregate(F.array(*map(F.lit, LETTERS)), F.array(F.lower(as_column(text))), removed)
    return F.get(F.transform(F.array(rests), vector), F.lit(0))
