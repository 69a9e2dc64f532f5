"""Fixity audit of WARC replicas with Merkle trees.

Every record is hashed; records in order of their offsets are leaves, and every ``FANOUT`` neighbours
(an ordered range of offsets) are hashed into a node, level by level, up to the root of the file.
Two replicas are compared from the roots down: only the children of ranges that differ are looked
at on the level below, so what is compared follows the damage and not the archive.

Leaves are written once per replica (a digest per record). Groups never exceed ``FANOUT`` children.

Defined cases: a file or record that one replica lacks is reported as missing or extra; null payloads
are empty records; rows without id come first in their file, ordered by url and payload; repeated rows
are records of their own, after all ids; an empty replica makes every file of the other one missing; extra columns
are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

FANOUT = 16
RECORDS_PER_FILE = 1024
SEPARATOR = "WARC/1.0\r\n"


def record(url: Column, payload: Column) -> Column:
    """The bytes of a WARC response record."""
    body = F.coalesce(payload.cast("binary"), F.lit(b""))
    head = F.concat(
        F.lit(SEPARATOR + "WARC-Type: response\r\nWARC-Target-URI: "),
        F.coalesce(url.cast("string"), F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(head.cast("binary"), body, F.lit(b"\r\n\r\n"))


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", per_file: int = RECORDS_PER_FILE) -> DataFrame:
    """``file``, ``id`` and ``record`` (bytes) of every page; ids are dealt to files in ranges."""
    ident = F.col(id_col).cast("long")
    file = F.coalesce(F.floor(ident / per_file), F.pmod(F.xxhash64(url_col, payload_col), F.lit(1 << 20)) - (1 << 20))
    return pages.select(file.cast("long").alias("file"), ident.alias("id"), record(F.col(url_col), F.col(payload_col)).alias("record"))


def write_warc(rows: DataFrame, folder: str) -> None:
    """Write the records of every ``file`` as one WARC file below ``folder``."""
    end = "\r\n\r\n"
    # A cast keeps the bytes as they are; the writer adds the end of each record.
    value = F.substring("record", F.lit(1), F.octet_length("record") - len(end)).cast("string").alias("value")
    ordered = rows.repartition("file").sortWithinPartitions("file", "id", "record").select("file", value)
    ordered.write.partitionBy("file").option("lineSep", end).text(folder)


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """``path``, ``offset`` and ``record`` of the records below a folder, cut by their stated lengths."""

    def cut(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = re.compile(rb"WARC/1\.\d\r\n(?:[^\r\n]+\r\n)*?content-length:[ \t]*(\d+)\r\n(?:[^\r\n]+\r\n)*\r\n", re.I)
        for batch in source:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                paths, offsets, found, at = [], [], [], 0
                while m := head.search(content, at):
                    end = m.end() + int(m[1]) + 4
                    paths.append(path)
                    offsets.append(m.start())
                    found.append(content[m.start() : end])
                    at = end
                columns = [pa.array(paths, pa.string()), pa.array(offsets, pa.int64()), pa.array(found, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["path", "offset", "record"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", "content").mapInArrow(cut, "path string, offset long, record binary")


def leaves(rows: DataFrame, per_file: int = RECORDS_PER_FILE) -> DataFrame:
    """``file``, ``position``, ``id``, ``offset``, ``length`` and ``digest`` of every record.

    Positions follow ids, so a record that is lost does not move its neighbours to other leaves; further
    records of an id come after all ids of the file. Offsets are those of the file itself.
    """
    hashed = rows.select("file", "id", F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("digest"))
    order = Window.partitionBy("file").orderBy(F.col("id").asc_nulls_first(), "digest")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    first = F.lag("id").over(order).isNull() | (F.lag("id").over(order) != F.col("id"))
    slot = F.when(F.col("id").isNotNull() & F.col("first"), F.pmod("id", F.lit(per_file)))
    further = per_file + F.sum((~(F.col("id").isNotNull() & F.col("first"))).cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - 1
    return (
        hashed.withColumns({"offset": F.coalesce(F.sum("length").over(before), F.lit(0)), "first": first})
        .withColumn("position", F.coalesce(slot, further).cast("long"))
        .drop("first")
    )


def _parents(level: DataFrame, fanout: int) -> DataFrame:
    """The level above: the hash of up to ``fanout`` neighbours in order, with the range they span."""
    children = F.array_sort(F.collect_list(F.struct("position", "digest")))
    return level.groupBy("file", F.floor(F.col("position") / fanout).cast("long").alias("position")).agg(
        F.sha2(F.array_join(F.transform(children, lambda c: c["digest"]), ""), 256).alias("digest"),
        F.min("offset").alias("offset"),
        F.sum("length").alias("length"),
    )


def tree(leaf_rows: DataFrame, most: int, fanout: int = FANOUT) -> list[DataFrame]:
    """The levels of the trees of all files, leaves first; ``most`` is the length of the longest file."""
    levels = [leaf_rows]
    width = most
    while width > 1:
        levels.append(_parents(levels[-1], fanout))
        width = -(-width // fanout)
    return levels


def audit(primary: DataFrame, replica: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Where two sets of leaves differ: ``file``, ``position``, ``id``, offsets, lengths, digests, ``status``.

    ``status`` is ``changed``, ``missing`` (in the replica) or ``extra``.
    """
    most = max((df.agg(F.coalesce(F.max("position"), F.lit(-1))).first()[0] + 1 for df in (primary, replica)), default=0)
    pairs = list(zip(tree(primary, most, fanout), tree(replica, most, fanout), strict=True))
    suspects = None
    for below, (left, right) in reversed(list(enumerate(pairs))):
        if suspects is not None:
            up = [F.col("file"), F.floor(F.col("position") / fanout).cast("long").alias("up")]
            left, right = (
                df.withColumn("up", up[1]).join(suspects.withColumnRenamed("position", "up"), ["file", "up"], "left_semi").drop("up")
                for df in (left, right)
            )
        both = left.alias("l").join(
            right.alias("r"), (F.col("l.file") == F.col("r.file")) & (F.col("l.position") == F.col("r.position")), "full_outer"
        )
        differ = both.where(~F.col("l.digest").eqNullSafe(F.col("r.digest")))
        if below:
            either = lambda c: F.coalesce(f"l.{c}", f"r.{c}").alias(c)
            suspects = differ.select(either("file"), either("position"))
    status = F.when(F.col("r.digest").isNull(), "missing").when(F.col("l.digest").isNull(), "extra").otherwise("changed")
    return differ.select(
        F.coalesce("l.file", "r.file").alias("file"),
        F.coalesce("l.position", "r.position").alias("position"),
        F.coalesce("l.id", "r.id").alias("id"),
        *(F.col(f"{s}.{c}").alias(f"{n}_{c}") for s, n in (("l", "primary"), ("r", "replica")) for c in ("offset", "length", "digest")),
        status.alias("status"),
    )
