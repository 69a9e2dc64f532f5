"""What each of five filters removes, alone and behind the others, by the Hart-Mas-Colell potential.

A document fails a set of filters: a mask of five bits. Per part of the table (a source), counts per mask
hold all that the audit needs, at most 32 of them however many documents there are. The removal game of
a part values a coalition S at v(S), the documents that fail any filter of S. Its potential obeys
``P(S) = (v(S) + sum of P(S without i) over i in S) / |S|`` and is worked out coalition by coalition, in
the order of their sizes. The Shapley value of a filter is ``P(all) - P(all without it)``. What the step
of an order removes is a difference of two coalitions: those after and before it.

Potentials are held as multiples of 1/120, in which every one of them is a whole number; 120 Shapley
values are then the filter's removals summed over all orders.

Duplicates: of the rows of a text all but those with the smallest id fail. Digests of texts are shuffled
with their ids, so no group of equal texts meets in one task; the smallest id of each digest is combined
on the map side and joined back on digest and id together.

Defined cases: a null text is the empty text; null and empty sources are one part; a null id counts as
larger than any other id, so such a row fails as a duplicate wherever the text has an id, and two such
rows do not make each other fail; rows that repeat an id and a text are judged alike; of several labels
of an id the larger ones hold; a document without labels is neither good nor toxic; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from recurra.llm.common import stored

FILTERS = "ABCDE"
MIN_WORDS = 50
MIN_DISTINCT = 65  # per cent of the words
MAX_CAPITALS = 5  # per cent of the code points
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
SYMBOLS = [bytes([c]) for c in b"#$%&*|"]
COALITIONS = range(1 << len(FILTERS))
#: All potentials are multiples of one by this.
UNIT = 120


def rules(text: bytes) -> int:
    """The bits of filters A to D that a UTF-8 text fails."""
    words = text.split()
    fails = (
        len(words) < MIN_WORDS,
        100 * len(set(words)) < MIN_DISTINCT * len(words),
        100 * (len(text) - len(text.translate(None, CAPITALS))) > MAX_CAPITALS * len(text.decode()),
        any(c in text for c in SYMBOLS),
    )
    return sum(1 << i for i, failed in enumerate(fails) if failed)


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [x.as_py() or b"" for x in batch.column("text").cast(pa.binary())]
        found = [pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()), pa.array(map(rules, texts), pa.int32())]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("part"), *found], names=["id", "part", "digest", "rules"])


def masks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``part``, ``mask`` (failed filters), ``good`` and ``toxic`` with the number ``n`` of such documents."""
    narrow = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.col(text_col).cast("string").alias("text"),
    ).mapInArrow(_judged, "id long, part string, digest binary, rules int")

    flag = lambda c: F.coalesce(F.max(F.when(F.col(c) == 1, True)), F.lit(False))
    known = labels.groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(flag("quality").alias("good"), flag("toxic").alias("toxic"))
    # Rows without an id are dealt by their digest; the second key keeps them from meeting a label.
    key, no_id = F.coalesce(F.col("id"), F.xxhash64("digest")), F.col("id").isNull()
    marked = stored(
        narrow.join(known, (key == F.col("label_id")) & (no_id == F.lit(False)), "left")
        .groupBy("digest", "id", "part", "rules", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
        .agg(F.count("*").alias("n")),
        "masks",
    )
    least = marked.groupBy(F.col("digest").alias("d")).agg(F.min("id").alias("least"))
    first = (F.col("digest") == F.col("d")) & F.col("id").eqNullSafe(F.col("least"))
    again = F.when(F.col("d").isNull(), 1 << 4).otherwise(0)
    return (
        marked.join(least, first, "left")
        .groupBy("part", (F.col("rules") + again).alias("mask"), "good", "toxic")
        .agg(F.sum("n").alias("n"))
    )


def _values(counts: Column) -> Column:
    """v(S) of every coalition: the documents of all masks that meet it."""
    met = lambda s: F.filter(counts, lambda n, m: m.bitwiseAND(s) != 0)
    return F.transform(F.array(*map(F.lit, COALITIONS)), lambda s: F.aggregate(met(s), F.lit(0).cast("long"), lambda a, n: a + n))


def potentials(values: Column) -> Column:
    """The potential of every coalition in units of 1/120; a coalition comes after all its parts."""

    def add(known: Column, s: Column) -> Column:
        bits = [F.lit(1 << i) for i in range(len(FILTERS))]
        smaller = lambda b: F.when(s.bitwiseAND(b) != 0, F.get(known, s.bitwiseXOR(b))).otherwise(0)
        total = sum(map(smaller, bits), F.get(values, s) * UNIT)
        # Exact: the total is a multiple of the size.
        return F.concat(known, F.array(F.call_function("div", total, F.bit_count(s))))

    return F.aggregate(F.array(*map(F.lit, COALITIONS[1:])), F.array(F.lit(0).cast("long")), add)


def audit(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from the counts of ``masks``."""
    of = lambda m, also: F.coalesce(F.sum(F.when((F.col("mask") == m) & also, F.col("n"))), F.lit(0))
    kinds = {"n": F.lit(True), "good": F.col("good"), "toxic": F.col("toxic")}
    sums = {f"{k}{m}": of(m, also) for k, also in kinds.items() for m in COALITIONS}
    wide = counts.groupBy("part").agg(*(x.alias(c) for c, x in sums.items()))
    array = lambda k: F.array(*(f"{k}{m}" for m in COALITIONS))
    games = wide.select(
        "part",
        F.aggregate(array("n"), F.lit(0).cast("long"), lambda a, n: a + n).alias("total"),
        array("n").alias("n"),
        _values(array("n")).alias("v"),
        _values(array("good")).alias("v_good"),
        _values(array("toxic")).alias("v_toxic"),
    )
    orders = F.split(F.lit(",".join(map("".join, permutations(FILTERS)))), ",")
    bit_of = lambda letter: F.get(F.array(*(F.lit(1 << i) for i in range(len(FILTERS)))), F.ascii(letter) - ord(FILTERS[0]))
    letters = F.split("filter_order", "")
    # The bits before a step are the sum of those of its letters.
    before = F.aggregate(F.slice(letters, 1, F.col("step") - 1), F.lit(0), lambda a, x: a + bit_of(x))
    bit, after = F.col("bit"), F.col("before") + F.col("bit")
    gain = lambda v: F.get(v, after) - F.get(v, "before")
    full = F.lit(COALITIONS[-1])
    return (
        games.withColumn("p", potentials(F.col("v")))
        .withColumn("filter_order", F.explode(orders))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
        .withColumns({"before": before, "bit": bit_of(F.get(letters, F.col("step") - 1))})
        .select(
            "part",
            "filter_order",
            "step",
            (F.col("total") - F.get("v", after)).alias("kept"),
            gain("v").alias("removed"),
            (F.get("v", bit) - gain("v")).alias("redundant"),
            F.get("n", bit).alias("unique_fails"),
            gain("v_good").alias("good_lost"),
            gain("v_toxic").alias("toxic_lost"),
            (F.get("p", full) - F.get("p", full - bit)).alias("shapley"),
        )
    )
