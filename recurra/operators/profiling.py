"""Data profiles: counts, field presence, distributions, exact medians."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.codings import coding
from ..functions.times import parse_instant, parse_iso, parse_iso_day
from ..session import scratch_dir
from ..sources.catalogue import RESOURCES
from ..sources.provenance import PROVENANCE_COLUMNS


def record_counts(resources: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per resource type and whether the type is ingested."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("total_records")).select(
            F.lit(name).alias("resource_type"),
            "total_records",
            F.lit("bronzed" if name in RESOURCES else "available-not-bronzed").alias("bronze_plan"),
        )
        for name, df in resources.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _presence(value: Column, dtype: T.DataType, path: str) -> list[tuple[str, Callable | Column]]:
    """(path, condition) for a value and everything below it. NULL counts as absent."""
    found = [(path, value.isNotNull())]
    if isinstance(dtype, T.StructType):
        for f in dtype.fields:
            found += _presence(value.getField(f.name), f.dataType, f"{path}.{f.name}")
    elif isinstance(dtype, T.ArrayType):
        for inner_path, inner in _element_presence(dtype.elementType, f"{path}[]"):
            found.append((inner_path, F.exists(value, inner)))
    return found


def _element_presence(dtype: T.DataType, path: str) -> list[tuple[str, Callable]]:
    """The same below an array element, as functions of the element."""
    found: list[tuple[str, Callable]] = [(path, lambda x: x.isNotNull())]
    if isinstance(dtype, T.StructType):
        for f in dtype.fields:
            for inner_path, inner in _element_presence(f.dataType, f"{path}.{f.name}"):
                found.append((inner_path, _of_field(f.name, inner)))
    elif isinstance(dtype, T.ArrayType):
        for inner_path, inner in _element_presence(dtype.elementType, f"{path}[]"):
            found.append((inner_path, _of_elements(inner)))
    return found


def _of_field(name: str, condition: Callable) -> Callable:
    return lambda x: condition(x.getField(name))


def _of_elements(condition: Callable) -> Callable:
    return lambda x: F.exists(x, condition)


def field_presence(records: DataFrame) -> DataFrame:
    """Share of records in which each path is filled, in percent, for paths filled at all.

    Paths come from the schema, and all of them are counted in one pass without exploding rows.
    """
    paths = []
    for f in records.schema:
        if f.name not in PROVENANCE_COLUMNS:
            paths += _presence(F.col(f"`{f.name}`"), f.dataType, f.name)
    counts = records.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(condition).alias(f"_{i}") for i, (_, condition) in enumerate(paths)],
    )
    rows = [
        F.struct(F.lit(path).alias("path"), F.col(f"_{i}").alias("present"))
        for i, (path, _) in enumerate(paths)
    ]
    listed = counts.select("_total", F.inline(F.array(*rows))).filter("present > 0")
    return listed.select(
        "path", F.round(F.col("present") * F.lit(100.0) / F.col("_total"), 1).alias("presence_pct")
    ).orderBy("path")


_NODE = "struct<path:string,value:variant>"


def _below(node: Column) -> Column:
    """What an object or array holds, each with its path; nothing below a scalar, and NULLs left out."""
    path = node["path"]

    def member(entry: Column) -> Column:
        named = F.when(path == "", entry["key"]).otherwise(F.concat(path, F.lit("."), entry["key"]))
        return F.struct(named.alias("path"), entry["value"].alias("value"))

    members = F.transform(F.map_entries(node["value"].try_cast("map<string,variant>")), member)
    elements = F.transform(
        node["value"].try_cast("array<variant>"),
        lambda x: F.struct(F.concat(path, F.lit("[]")).alias("path"), x.alias("value")),
    )
    held = F.coalesce(members, elements, F.array().cast(f"array<{_NODE}>"))
    return F.filter(held, lambda n: n["value"].isNotNull() & ~F.is_variant_null(n["value"]))


def _by_shape(records: DataFrame, record: str) -> DataFrame:
    """One record of each shape with the number of records that have it: the record and ``_n``.

    The shape is the schema of the record's value, which tells all paths with a value. Where it does not (an array
    whose elements differ in kind is a VARIANT there), the record is its own shape. Texts that are no JSON
    object have none. Shapes are counted before anything is shuffled; a second scan fetches the chosen records
    by a hash and looks at the shapes of those alone.
    """
    spark = records.sparkSession
    schema = F.schema_of_variant(F.try_parse_json(F.col(record)))
    shape = F.when(schema.startswith("OBJECT"), F.when(schema.contains("VARIANT"), F.col(record)).otherwise(schema))
    pick = F.xxhash64(record).alias("_pick")
    shapes = records.select(shape.alias("_shape"), pick).groupBy("_shape").agg(F.count(F.lit(1)).alias("_n"), F.min("_pick").alias("_pick"))
    folder = scratch_dir(spark, "shapes")
    shapes.write.parquet(folder)
    shapes = spark.read.schema(shapes.schema).parquet(folder).filter("_shape IS NOT NULL")
    near = records.select(record, pick).join(shapes.select("_pick"), "_pick", "left_semi").select(record, shape.alias("_found"))
    # A plain equality would have every record parsed again, to leave out those without a shape before the first join.
    chosen = near.join(shapes, F.col("_found").eqNullSafe(F.col("_shape"))).groupBy("_shape").agg(F.min(record).alias(record), F.min("_n").alias("_n")).drop("_shape")
    folder = scratch_dir(spark, "of-each-shape")
    chosen.write.parquet(folder)
    return spark.read.schema(chosen.schema).parquet(folder)


def record_presence(records: DataFrame, record: str, levels: int = 12) -> DataFrame:
    """Share of records in which each path is filled, in percent, for whatever fields the records hold.

    ``record`` is a column of JSON texts; no schema is declared or inferred. A record is walked level by
    level within its row: a level is the list of its values with their paths, the next one what these
    hold. A record counts once for a path. Records of one shape have the same paths, so one of each shape is
    walked and counts for all. ``levels`` are walked in one pass over these. Only if some record is deeper (told by a count taken on
    the way) is another pass made, over what such records hold below. Paths are written ``a.b``, ``a[]`` and
    ``a[].b``; a NULL value is an absent one; texts that are no JSON object are not records.
    """
    spark = records.sparkSession
    value = F.try_parse_json(F.col(record))
    root = F.array(F.struct(F.lit("").alias("path"), value.alias("value"))).cast(f"array<{_NODE}>")
    walked = _by_shape(records, record).select("_n", root.alias("_0"), F.array().cast("array<string>").alias("_seen"))
    found, total = [], None
    while True:
        for level in range(levels):
            walked = walked.withColumn(f"_{level + 1}", F.flatten(F.transform(f"_{level}", _below)))
        paths = F.flatten(F.array(*[F.transform(f"_{level + 1}", lambda n: n["path"]) for level in range(levels)]))
        walked = walked.withColumn("_new", F.array_except(paths, F.col("_seen")))
        deeper = F.exists(F.col(f"_{levels}"), lambda n: F.schema_of_variant(n["value"]).rlike("^(OBJECT|ARRAY)<"))
        # Beside its paths each record adds to the count of records and, if need be, to that of deeper ones.
        entry = "array<struct<kind:int,path:string>>"
        marks = F.array(F.struct(F.lit(1), F.lit(None)), F.struct(F.when(deeper, 2), F.lit(None))).cast(entry)
        entries = F.concat(F.transform("_new", lambda p: F.struct(F.lit(0), p)).cast(entry), marks)
        counts = (
            walked.select("_n", F.inline(entries)).filter("kind IS NOT NULL").groupBy("kind", "path").agg(F.sum("_n").alias("present"))
        )
        folder = scratch_dir(spark, "presence")
        counts.write.parquet(folder)
        counts = spark.read.schema(counts.schema).parquet(folder)
        found.append(counts.filter("kind = 0"))
        sizes = {r.kind: r.present for r in counts.filter("kind > 0").collect()}
        total = sizes.get(1, 0) if total is None else total
        if 2 not in sizes:
            break
        rest = walked.filter(deeper).select("_n", F.col(f"_{levels}").alias("_0"), F.array_union("_seen", "_new").alias("_seen"))
        folder = scratch_dir(spark, "deeper")
        rest.write.parquet(folder)
        walked = spark.read.schema(rest.schema).parquet(folder)
    share = F.round(F.sum("present") * F.lit(100.0) / F.lit(total), 1)
    return reduce(DataFrame.unionByName, found).groupBy("path").agg(share.alias("presence_pct")).orderBy("path")


def distribution(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Rows per non-null value: metric, value, frequency."""
    return (
        df.select(value.cast("string").alias("value"))
        .filter("value IS NOT NULL")
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("frequency"))
        .select(F.lit(name).alias("metric"), "value", "frequency")
    )


def encounter_distributions(encounters: DataFrame) -> DataFrame:
    return distribution(encounters, "class", F.col("class.code")).unionByName(
        distribution(encounters, "status", F.col("status"))
    )


def patient_distributions(patients: DataFrame) -> DataFrame:
    """Genders and birth decades; malformed birth dates are skipped."""
    decade = (F.floor(F.year(parse_iso_day("birthDate")) / 10) * 10).cast("string")
    return distribution(patients, "gender", F.col("gender")).unionByName(
        distribution(patients, "birth_decade", F.concat(decade, F.lit("s")))
    )


def deceased_share(patients: DataFrame) -> DataFrame:
    """Percentage of patients with a time of death."""
    share = F.avg(F.col("deceasedDateTime").isNotNull().cast("double")) * 100
    return patients.agg(F.round(share, 1).alias("deceased_pct"))


def top_conditions(conditions: DataFrame, n: int = 10) -> DataFrame:
    """The n most frequent condition codes with a display text."""
    coded = conditions.select(
        coding("code", "code").alias("code"), coding("code", "display").alias("display")
    ).filter(F.length("code") > 0)
    return (
        coded.groupBy("code")
        .agg(F.max("display").alias("display"), F.count(F.lit(1)).alias("frequency"))
        .orderBy(F.desc("frequency"), "code")
        .limit(n)
    )


def times_read(records: DataFrame, *fields: str) -> DataFrame:
    """Per time field: texts that flat tables read, those they lose, and malformed ones.

    Flat tables read whole seconds with an offset only; other forms of ISO-8601 pass the contract (a day, a
    fraction of a second, no offset) and are NULL there. All fields are counted in one pass.
    """
    entries = [
        F.struct(F.lit(f).alias("field"), F.col(f).alias("text"), parse_instant(f).isNotNull().alias("read"), parse_iso(f).isNotNull().alias("iso"))
        for f in fields
    ]
    return (
        records.select(F.inline(F.array(*entries)))
        .filter("text IS NOT NULL")
        .groupBy("field")
        .agg(
            F.count_if("read").alias("read"),
            F.count_if(~F.col("read") & F.col("iso")).alias("lost"),
            F.count_if(~F.col("read") & ~F.col("iso")).alias("malformed"),
        )
    )


# Widths in microseconds the median narrows down by: day, second, microsecond.
_WIDTHS = (86_400_000_000, 1_000_000, 1)


def exact_medians(values: DataFrame, group: str, micros: str) -> dict[str, float]:
    """The true median of a microsecond column per group, for a handful of groups.

    Exact without a global sort or a group in one task: a histogram by day tells which day holds
    the middle ranks, one by second within that day and one by microsecond within that second
    give the values. Each histogram is bounded by its step whatever the number of rows, and only
    the two middle cells per group come back to steer the next pass.
    """
    values = values.select(F.col(group).alias("g"), F.col(micros).alias("v")).filter("v IS NOT NULL")
    sizes = values.groupBy("g").agg(F.count(F.lit(1)).alias("n")).collect()
    # Middle ranks counted from zero, as (group, cell, rank in cell); one cell holds everything.
    wanted = {(r.g, None, rank) for r in sizes for rank in ((r.n - 1) // 2, r.n // 2)}
    outer = None
    for width in _WIDTHS:
        inside = F.lit(False)
        for g, cell in {(g, cell) for g, cell, _ in wanted}:
            here = F.lit(True) if outer is None else F.floor(F.col("v") / outer) == cell
            inside = inside | ((F.col("g") == g) & here)
        cell = F.lit(0) if outer is None else F.floor(F.col("v") / outer)
        histogram = (
            values.filter(inside)
            .groupBy("g", cell.alias("cell"), F.floor(F.col("v") / width).alias("finer"))
            .agg(F.count(F.lit(1)).alias("rows"))
        )
        upto = F.sum("rows").over(Window.partitionBy("g", "cell").orderBy("finer"))
        ranked = histogram.withColumn("after", upto).withColumn("before", F.expr("after - rows"))
        hit = F.lit(False)
        for g, outer_cell, rank in wanted:
            same = F.col("cell") == (0 if outer_cell is None else outer_cell)
            reached = (F.col("before") <= rank) & (F.col("after") > rank)
            hit = hit | ((F.col("g") == g) & same & reached)
        found = ranked.filter(hit).collect()
        wanted = {
            (g, r.finer, rank - r.before)
            for g, outer_cell, rank in wanted
            for r in found
            if r.g == g
            and r.cell == (0 if outer_cell is None else outer_cell)
            and r.before <= rank < r.after
        }
        outer = width
    middles: dict[str, list[int]] = {}
    for g, value, _ in wanted:
        middles.setdefault(g, []).append(value)
    return {g: sum(v) / len(v) for g, v in middles.items()}


# A quantile sketch of this accuracy is off by at most one in so many ranks.
_SKETCH, _CELLS = 10_000, 4096


def sketched_medians(values: DataFrame, group: str, micros: str, sketch: int = _SKETCH) -> DataFrame:
    """``g`` and ``median``: the true median of a whole-number column per group, in two passes and lazily.

    The first pass builds a mergeable quantile sketch per group, which brackets the middle ranks. The second
    counts all rows: those below and above the bracket as one number each, those inside by value and by cell
    of the bracket. The cells (``_CELLS`` per group) tell where the middle ranks are, and only the
    values of these cells are ordered. A constant column is a bracket of one value. Should a sketch break
    its bound, the query fails rather than give another value.
    """
    values = values.select(F.col(group).alias("g"), F.col(micros).cast("long").alias("v")).filter("v IS NOT NULL")
    around = F.array(*(F.lit(0.5 + side * 2 / sketch) for side in (-1, 1)))
    brackets = values.groupBy("g").agg(F.percentile_approx("v", around, sketch).alias("ends")).select(
        F.col("g").alias("_g"), F.col("ends")[0].alias("low"), F.col("ends")[1].alias("high")
    )
    place = F.floor((F.col("v") - F.col("low")) / (F.col("high") - F.col("low") + F.lit(1.0)) * _CELLS)
    cell = F.when(F.col("v") < F.col("low"), -1).when(F.col("v") > F.col("high"), _CELLS).otherwise(F.least(place, F.lit(_CELLS - 1)))
    placed = values.join(brackets, F.col("g").eqNullSafe(F.col("_g"))).withColumn("cell", cell.cast("int"))
    inside = F.when(F.col("cell").between(0, _CELLS - 1), F.col("v"))
    counted = placed.groupBy("g", "cell", inside.alias("v")).agg(F.count(F.lit(1)).alias("n"))

    of_group = Window.partitionBy("g")
    upto = F.sum("n").over(of_group.orderBy("cell"))
    cells = counted.groupBy("g", "cell").agg(F.sum("n").alias("n")).withColumns(
        {"before": upto - F.col("n"), "all": F.sum("n").over(of_group)}
    )
    middle = F.array_distinct(F.array(F.floor((F.col("all") - 1) / 2), F.floor(F.col("all") / 2)))
    here = F.filter(middle, lambda rank: (rank >= F.col("before")) & (rank < F.col("before") + F.col("n")))
    sought = cells.withColumn("ranks", here).filter(F.size("ranks") > 0).select(
        F.col("g").alias("_g"), F.col("cell").alias("_cell"), "before", "ranks"
    )
    near = counted.join(sought, F.col("g").eqNullSafe(F.col("_g")) & (F.col("cell") == F.col("_cell")))
    after = F.sum("n").over(Window.partitionBy("g", "cell").orderBy("v")) + F.col("before")
    hit = F.exists("ranks", lambda rank: (rank >= F.col("after") - F.col("n")) & (rank < F.col("after")))
    known = F.when(F.col("v").isNotNull(), F.col("v")).otherwise(F.raise_error(F.lit("the median lies outside its bracket")).cast("long"))
    found = near.withColumn("after", after).filter(hit).groupBy("g")
    return found.agg(((F.min(known) + F.max(known)) / 2).cast("long").alias("median"))


def period_statistics(encounters: DataFrame) -> DataFrame:
    """Earliest, latest and median start and end; malformed times are skipped."""
    fields = ("start", "end")
    pairs = [
        F.struct(F.lit(f).alias("g"), F.unix_micros(parse_iso(f"period.{f}")).alias("v"))
        for f in fields
    ]
    times = encounters.select(F.inline(F.array(*pairs)))
    medians = sketched_medians(times, "g", "v").withColumnRenamed("g", "_g")
    bounds = times.groupBy("g").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    return bounds.join(medians, F.col("g") == F.col("_g"), "left").select(
        F.col("g").alias("period_field"),
        F.timestamp_micros("lo").alias("earliest"),
        F.timestamp_micros("hi").alias("latest"),
        F.timestamp_micros("median").alias("median"),
    )
