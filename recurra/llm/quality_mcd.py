"""Quality rules and robust multivariate outliers, in DataFrame expressions only.

Every text gets word statistics. Texts with few words or mostly repeated words fail outright. For
the rest, transformed statistics are compared with their language and source: a minimum-covariance-
determinant estimate (concentration steps from medians and absolute deviations; each step keeps the
nearer half and estimates mean and covariance from it) gives squared Mahalanobis distances, and texts
beyond a fixed cutoff are rejected.

Statistics are held as whole numbers, so sums and the estimates are the same in any order of rows.
The half that is kept is found from counts of distance bins; no group is sorted or gathered.

Defined cases: a null text has no words and fails; null languages and sources are groups of their
own; groups below ``least`` rows use the estimate of their language, and languages below it that of
the whole table; an empty table gives no rows; repeated rows and ids are judged one by one; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from recurra.llm.common import SPACE, stored

MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of words in repeated three-word windows
SCALE = 1024
#: The transformed statistics and the spread (in their own units) below which none is estimated.
STATISTICS = {"word_length": 0.12, "symbols": 0.06, "marks": 0.08, "capitals": 0.12, "dup_lines": 0.15, "repeats": 0.2}
#: Mean of the squared distance over the nearer half, against that over all, for six statistics.
HALF_FACTOR = 1.79
#: Squared distance that one in a million normal vectors of six statistics exceeds.
CUTOFF = 38.3


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _repeated_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more."""

    def windows(w: Column) -> Column:
        # Null at the last two words.
        text = lambda x, i: F.concat(x, F.lit(" "), F.get(w, i + 1), F.lit(" "), F.get(w, i + 2))
        return F.transform(w, text)

    def covered(t: Column) -> Column:
        order = F.sort_array(F.transform(t, lambda x, i: F.struct(x.alias("t"), i.alias("i"))))

        def twice(s: Column) -> Column:
            same = lambda x, i: F.coalesce(F.get(s, i)["t"] == x["t"], F.lit(False))
            again = F.filter(s, lambda x, i: same(x, i - 1) | same(x, i + 1))
            return F.sort_array(F.transform(again, lambda x: x["i"]))

        none = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        step = lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last"))
        return F.aggregate(_let(order, twice), none, step, lambda a: a["n"])

    some = lambda t: F.when(F.size(F.array_distinct(t)) == F.size(t) - 1, 0).otherwise(covered(t))
    return F.when(F.size(words) < 4, 0).otherwise(_let(windows(words), some))


def statistics(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Word statistics of every row beside the columns named in ``keep``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    count = lambda c, pattern: F.length(F.regexp_replace(c, pattern, "")).cast("long")
    return (
        docs.select(*keep, text.alias("text"))
        .withColumn("words", F.array_remove(F.split("text", SPACE), ""))
        .withColumn("marks", F.regexp_replace("text", r"[\p{L}\p{N}\x20\x09-\x0D]+", ""))
        .select(
            *keep,
            F.size("words").cast("long").alias("n_words"),
            F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
            count("marks", r"[^#*$%&|<>]+").alias("n_symbols"),
            F.length("marks").cast("long").alias("n_marks"),
            count("text", r"[^\p{Lu}]+").alias("n_capitals"),
            F.size(lines).cast("long").alias("n_lines"),
            _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            _repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
        )
        .withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")))
    )


def _vector() -> dict[str, Column]:
    """The transformed statistics as whole numbers of 1/1024."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    share = lambda c, of: F.asin(F.sqrt(F.least(F.lit(1.0), F.col(c) / of)))
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    parts = {
        "word_length": F.log(chars / words),
        "symbols": share("n_symbols", chars),
        "marks": share("n_marks", chars),
        "capitals": share("n_capitals", chars),
        "dup_lines": share("n_dup_lines", F.greatest(F.col("n_lines"), F.lit(1))),
        "repeats": share("n_repeat_words", words),
    }
    return {c: F.round(x * SCALE).cast("long") for c, x in parts.items()}


def _inverse(rows: list[list[Column]]) -> tuple[list[str], dict[str, Column]]:
    """Columns of the inverse Cholesky factor, each an expression of those before it."""
    names, out, n = [], {}, len(rows)
    for i in range(n):
        for j in range(i + 1):
            rest = rows[i][j]
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            out[f"l{i}{j}"] = F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}{j}")
            names.append(f"l{i}{j}")
    return names, out


def _moments(rows: DataFrame, factor: float) -> DataFrame:
    """Mean and Cholesky factor of the covariance of every group; spreads have a floor."""
    names = list(STATISTICS)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[: i + 1]]
    # Exact: whole numbers below 2^13 leave room for 10^11 rows in a long sum of products.
    sums = rows.groupBy("group").agg(
        F.count("*").alias("n"),
        *(F.sum(a).alias(f"s_{a}") for a in names),
        *(F.sum(F.col(a) * F.col(b)).alias(f"p_{a}_{b}") for a, b in pairs),
    )
    mean = {a: F.col(f"s_{a}") / F.col("n") / SCALE for a in names}
    cover = lambda a, b: (F.col(f"p_{a}_{b}") / F.col("n") / SCALE**2 - mean[a] * mean[b]) * factor
    matrix = [
        [cover(a, b) + (F.lit(STATISTICS[a] ** 2) if a == b else 0) for b in names[: i + 1]] for i, a in enumerate(names)
    ]
    order, factors = _inverse(matrix)
    out = sums
    for name in order:
        out = out.withColumn(name, factors[name])
    return out.select(F.col("group").alias("_group"), *(mean[a].alias(f"m_{a}") for a in names), *order)


def _distances(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """``rows`` with the squared Mahalanobis distance ``d2``, by forward substitution."""
    out, names = rows.join(estimate, F.col("group") == F.col("_group")), list(STATISTICS)
    for i, a in enumerate(names):
        rest = F.col(a) / SCALE - F.col(f"m_{a}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"z{k}")
        out = out.withColumn(f"z{i}", rest / F.col(f"l{i}{i}"))
    total = sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(1, len(names))), F.col("z0") * F.col("z0"))
    return out.withColumn("d2", total).select(*rows.columns, "d2")


def _nearer_half(scored: DataFrame) -> DataFrame:
    """The rows up to the distance bin in which the half of their group is reached."""
    binned = scored.withColumn("bin", F.floor(F.log1p("d2") * 512).cast("int"))
    counts = binned.groupBy("group", "bin").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("group").orderBy("bin")
    all_rows = F.sum("n").over(Window.partitionBy("group"))
    half = (
        counts.withColumns({"upto": F.sum("n").over(upto), "all": all_rows})
        .where(2 * F.col("upto") >= F.col("all"))
        .groupBy("group")
        .agg(F.min("bin").alias("edge"))
        .select(F.col("group").alias("_group"), "edge")
    )
    return binned.join(stored(half, "halves"), F.col("group") == F.col("_group")).where("bin <= edge")


def _start(rows: DataFrame) -> DataFrame:
    """Medians and absolute deviations per group as a first estimate, from counts of values."""
    names = list(STATISTICS)
    long = rows.select("group", F.explode(F.array(*(F.struct(F.lit(a).alias("name"), F.col(a).alias("x")) for a in names))).alias("v"))
    counts = long.groupBy("group", "v.name", "v.x").agg(F.count("*").alias("n"))

    def median(of: DataFrame) -> DataFrame:
        keys = Window.partitionBy("group", "name")
        ranked = of.withColumns({"upto": F.sum("n").over(keys.orderBy("x")), "all": F.sum("n").over(keys)})
        return ranked.where(2 * F.col("upto") >= F.col("all")).groupBy("group", "name").agg(F.min("x").alias("mid"))

    middle = median(counts)
    apart = counts.join(middle, ["group", "name"]).select("group", "name", F.abs(F.col("x") - F.col("mid")).alias("x"), "n")
    spread = median(apart.groupBy("group", "name", "x").agg(F.sum("n").alias("n"))).withColumnRenamed("mid", "mad")
    wide = middle.join(spread, ["group", "name"]).groupBy(F.col("group").alias("_group"))
    pick = lambda c, a: F.max(F.when(F.col("name") == a, F.col(c))) / SCALE
    means = {f"m_{a}": pick("mid", a) for a in names}
    sigma = {f"l{i}{i}": F.sqrt(F.pow(1.4826 * pick("mad", a), F.lit(2)) + STATISTICS[a] ** 2) for i, a in enumerate(names)}
    zero = {f"l{i}{j}": F.lit(0.0) for i in range(len(names)) for j in range(i)}
    return wide.agg(*(x.alias(c) for c, x in {**means, **sigma}.items())).withColumns(zero)


def judge(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    keep: tuple[str, ...] = ("doc_id",),
    steps: int = 3,
    least: int = 200,
    cutoff: float = CUTOFF,
) -> DataFrame:
    """``keep`` columns, the statistics, ``base_failed``, ``d2`` and ``kept`` of every row."""
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))
    groups = {"_lang": name(lang_col), "_source": name(source_col)}
    named = docs.withColumns(groups)
    counted = stored(statistics(named, text_col, (*keep, *groups)).withColumns(_vector()), "statistics")

    good = counted.where(~F.col("base_failed"))
    sizes = good.groupBy("_lang", "_source").agg(F.count("*").alias("n"))
    of_lang = F.sum("n").over(Window.partitionBy("_lang"))
    group = (
        F.when(F.col("n") >= least, F.concat(F.lit("2"), F.to_json(F.array("_lang", "_source"))))
        .when(F.col("of_lang") >= least, F.concat(F.lit("1"), F.col("_lang")))
        .otherwise("0")
    )
    known = stored(sizes.withColumn("of_lang", of_lang).select("_lang", "_source", group.alias("group")), "groups")
    rows = good.join(known, ["_lang", "_source"]).select("group", *STATISTICS)
    # A pooled estimate uses all rows of its language or table, so these count in each group they serve.
    wider = known.select("group").distinct()
    pooled = good.select(F.explode(F.array(F.lit("0"), F.concat(F.lit("1"), F.col("_lang")))).alias("group"), *STATISTICS).join(wider, "group", "left_semi")
    own = rows.where(F.col("group").startswith("2"))
    fitted = stored(own.unionByName(pooled), "fitted")

    estimate = stored(_start(fitted), "estimate")
    for _ in range(steps):
        estimate = stored(_moments(_nearer_half(_distances(fitted, estimate)), HALF_FACTOR), "estimate")

    columns = [*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    judged = _distances(good.join(known, ["_lang", "_source"]).select(*columns, *STATISTICS, "group"), estimate)
    passed = judged.select(*columns, "d2", (F.col("d2") <= cutoff).alias("kept"))
    failed = counted.where("base_failed").select(*columns, F.lit(None).cast("double").alias("d2"), F.lit(False).alias("kept"))
    return passed.unionByName(failed)


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that are kept; whole rows are stored beside their statistics, not shuffled."""
    whole = docs.select(
        F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.struct("*").alias("row")
    )
    return judge(whole, keep=("row",)).where("kept").select("row.*")
