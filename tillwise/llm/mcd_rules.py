"""Quality rules: robust multivariate outliers by the minimum covariance determinant.

All of it is DataFrame functions. Each document has a vector of transformed statistics; for
each language and source the mean and covariance of the half with the least determinant are
found by concentration steps: distances under the last estimate, the h documents nearest to
it, their mean and covariance, and so on. A document far from its group by Mahalanobis distance
is rejected. The covariances are small and written out (Cholesky) as column expressions; the
h-th distance comes from counts per bin of the distance, so no group meets in one task.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.staging import stage

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Base rules: fewer words, or a larger share (percent) of words in repeated windows, fail.
LEAST_WORDS, MOST_REPEATED = 50, 50
#: The transformed statistics.
DIMENSIONS = ("word_length", "symbols", "lines", "repeats")
#: Centres of the starts (quantiles of each dimension), concentration steps of every start and
#: of the best one, and bins of the distance for each doubling.
STARTS, FIRST_STEPS, STEPS, BINS = (0.5, 0.25, 0.75), 2, 6, 32
#: Tasks that the documents of a group are spread over.
SALTS = 64
#: Groups with fewer documents that pass the base rules take their language's estimate.
LEAST_GROUP = 40
#: Rejected beyond the chi-square quantile of 4 degrees of freedom at 1 - 1e-5.
CUTOFF = 28.473
#: Median of the chi-square distribution with 4 degrees of freedom.
MEDIAN = 3.3567
#: Least standard deviation of each dimension: a statistic that hardly varies in a group
#: (no symbols anywhere, say) does not make the group's covariance singular.
FLOOR = (0.05, 0.05, 0.05, 0.12)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _twice(hashes: Column, places: Column) -> Column:
    """Places, in order, of sorted hashes that equal a neighbour."""
    behind = F.concat(F.slice(hashes, 2, F.size(hashes)), F.array(F.lit(None).cast("long")))
    same = F.zip_with(hashes, behind, lambda a, b: F.coalesce(a == b, F.lit(False)))
    either = lambda s: F.zip_with(s, F.concat(F.array(F.lit(False)), F.slice(s, 1, F.size(s) - 1)), lambda a, b: a | b)
    found = F.zip_with(places, let(same, either), lambda i, d: F.when(d, i))
    return F.sort_array(F.filter(found, lambda i: i.isNotNull()))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the five counts of every whole text (null: no words)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(
        F.col("doc_id"), F.col("lang"), F.col("source"),
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"),
        F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, SPACES, "")) > 0).alias("lines"),
    )
    windows = F.transform(
        F.slice("words", 1, F.greatest(F.size("words") - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)),
    )
    base = base.withColumn("n_words", F.size("words").cast("long")).withColumn("windows", windows)
    base = base.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")).drop("words", "lines")
    # Positions of windows found twice or more, by hash and place; each covers three words.
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeated = F.size(F.array_distinct("windows")) < F.size("windows")
    base = base.withColumn("twice", F.when(repeated, let(placed, lambda s: let(s["h"], lambda h: _twice(h, s["i"])))))
    covered = F.aggregate(
        "twice",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).cast("int").alias("last")),
        lambda s, i: F.struct((s["n"] + F.least(F.lit(3), i - s["last"])).cast("long").alias("n"), i.cast("int").alias("last")),
        lambda s: s["n"],
    )
    return base.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def transformed(counts: DataFrame) -> DataFrame:
    """The statistic vectors: log mean word length, and square roots of shares."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return counts.withColumns({
        "word_length": F.log(F.greatest(F.col("word_chars") / words, F.lit(1.0))),
        "symbols": F.sqrt(F.col("n_symbols") / words),
        "lines": F.sqrt(F.col("n_dup_lines") / words),
        "repeats": F.sqrt(F.col("n_repeat_words") / words),
    })


def _moments(weight: Column) -> list[Column]:
    out = [F.sum(F.when(weight, 1).otherwise(0)).alias("m")]
    for i, a in enumerate(DIMENSIONS):
        out.append(F.sum(F.when(weight, F.col(a))).alias(f"s{i}"))
        out += [F.sum(F.when(weight, F.col(a) * F.col(b))).alias(f"q{i}{j}") for j, b in enumerate(DIMENSIONS) if j <= i]
    return out


def _cholesky(moments: DataFrame) -> DataFrame:
    """Means and the Cholesky factor of the covariance, floor included, and the log determinant."""
    n = len(DIMENSIONS)
    means = {f"mean{i}": F.col(f"s{i}") / F.col("m") for i in range(n)}
    out = moments.withColumns(means)
    covariance = {
        f"c{i}{j}": F.col(f"q{i}{j}") / F.col("m") - F.col(f"mean{i}") * F.col(f"mean{j}") + (FLOOR[i] ** 2 if i == j else 0.0)
        for i in range(n) for j in range(i + 1)
    }
    out = out.withColumns(covariance)
    for i in range(n):
        for j in range(i + 1):
            rest = reduce(lambda a, b: a - b, [F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)], F.col(f"c{i}{j}"))
            value = F.sqrt(F.greatest(rest, F.lit(FLOOR[i] ** 2 / 4))) if i == j else rest / F.col(f"l{j}{j}")
            out = out.withColumn(f"l{i}{j}", value)
    det = reduce(lambda a, b: a + b, [2 * F.log(F.col(f"l{i}{i}")) for i in range(n)])
    return out.withColumn("log_det", det)


def _factor_columns() -> list[str]:
    n = len(DIMENSIONS)
    return [f"mean{i}" for i in range(n)] + [f"l{i}{j}" for i in range(n) for j in range(i + 1)]


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution, written out."""
    solved: list[Column] = []
    for i, a in enumerate(DIMENSIONS):
        rest = reduce(lambda x, k: x - F.col(f"l{i}{k}") * solved[k], range(i), F.col(a) - F.col(f"mean{i}"))
        solved.append(rest / F.col(f"l{i}{i}"))
    return reduce(lambda a, b: a + b, [z * z for z in solved])


def _bin(distance: Column) -> Column:
    return F.floor(F.log2(F.greatest(distance, F.lit(1e-9))) * BINS).cast("int")


def _half(rows: Column) -> Column:
    """Rows of a group in the subset: the least number that keeps the breakdown point highest."""
    return F.least(rows, F.floor((rows + len(DIMENSIONS) + 1) / 2))


def _cut(binned: DataFrame, need: Callable[[Column], Column]) -> DataFrame:
    """Per group the bin up to which at least the needed number of its rows lie."""
    counts = binned.groupBy("group", "bin").agg(F.count("*").alias("n"))
    up_to = Window.partitionBy("group").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumn("below", F.sum("n").over(up_to)).withColumn("all", F.sum("n").over(Window.partitionBy("group")))
    return counts.filter(F.col("below") >= need(F.col("all"))).groupBy("group").agg(F.min("bin").alias("cut"), F.max("all").alias("rows"))


def _centres(vectors: DataFrame) -> DataFrame:
    """Per group and start the quantile of each dimension, from counts of binned values."""
    bins = F.array(*[F.struct(F.lit(i).alias("d"), F.floor(F.col(a) * 200).cast("int").alias("bin")) for i, a in enumerate(DIMENSIONS)])
    counts = stage(vectors.select("group", F.explode(bins).alias("v")).groupBy("group", "v.d", "v.bin").agg(F.count("*").alias("n")), "mcd-values")
    each = Window.partitionBy("group", "d")
    counts = counts.withColumn("below", F.sum("n").over(each.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)))
    counts = counts.withColumn("all", F.sum("n").over(each)).withColumn("share", F.explode(F.array(*[F.lit(s) for s in STARTS])))
    found = counts.filter(F.col("below") >= F.ceil(F.col("all") * F.col("share"))).groupBy("group", "share", "d").agg(F.min("bin").alias("cut"))
    middle = [F.max(F.when(F.col("d") == i, (F.col("cut") + 0.5) / 200)).alias(f"med_{a}") for i, a in enumerate(DIMENSIONS)]
    return found.groupBy("group", "share").agg(*middle)


def _concentrate(vectors: DataFrame, binned: DataFrame, steps: int) -> tuple[DataFrame, DataFrame]:
    """The estimate after so many steps, and the vectors with the bin of their distance by it."""
    for _ in range(steps):
        cut = _cut(binned, _half)
        near = _spread(binned, cut).filter(F.col("bin") <= F.col("cut"))
        factor = _cholesky(near.groupBy("group").agg(*_moments(F.lit(True)))).select("group", "m", "log_det", *_factor_columns())
        factor = stage(factor, "mcd-factor")
        binned = _spread(vectors, factor).select("group", *DIMENSIONS, _bin(_distance()).alias("bin"))
    return factor, binned


def _spread(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Join on the group; each group's one row is repeated so that its documents meet in many tasks."""
    many = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(*DIMENSIONS), F.lit(SALTS)).cast("int"))
    return salted.join(many, ["group", "salt"]).drop("salt")


def estimates(vectors: DataFrame) -> DataFrame:
    """Per ``group`` the minimum-covariance-determinant estimate of its vectors.

    The first distances come from quantiles of binned values, one dimension at a time: the
    medians, and the lower and upper quartiles. After a few steps the start of least determinant
    goes on. ``scale`` makes the median squared distance that of the chi-square distribution.
    """
    several = F.concat_ws("\x01", "group", F.col("share").cast("string")).alias("group")
    first = _spread(vectors, stage(_centres(vectors), "mcd-centres"))
    spread = reduce(lambda x, y: x + y, [((F.col(a) - F.col(f"med_{a}")) / (4 * f)) ** 2 for a, f in zip(DIMENSIONS, FLOOR, strict=True)])
    binned = stage(first.select(several, *DIMENSIONS, _bin(spread).alias("bin")), "mcd-start")
    factor, _ = _concentrate(binned.drop("bin"), binned, FIRST_STEPS)
    place = {str(s): i for i, s in enumerate(STARTS)}
    start = F.element_at(F.split("group", "\x01"), -1)
    order = F.struct("log_det", reduce(lambda c, s: c.when(start == s, place[s]), place, F).alias("place"))
    whole = F.regexp_replace("group", "\x01[^\x01]*$", "").alias("group")
    best = factor.select(whole, order.alias("order"), F.struct(*_factor_columns()).alias("e")).groupBy("group").agg(F.min_by("e", "order").alias("e"))
    best = stage(best.select("group", "e.*"), "mcd-best")
    binned = _spread(vectors, best).select("group", *DIMENSIONS, _bin(_distance()).alias("bin"))
    factor, binned = _concentrate(vectors, binned, STEPS)
    middle = _cut(binned, lambda n: F.ceil(n * 0.5)).select("group", "rows", (F.greatest(F.pow(F.lit(2.0), (F.col("cut") + 1) / BINS) / MEDIAN, F.lit(1.0))).alias("scale"))
    return factor.join(middle, "group")


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the five counts, base_failed, distance (squared, scaled) and kept.

    Groups are language and source; those with few documents past the base rules take the
    estimate of their language, and that of all documents where this is small as well. Null
    languages and sources are groups of their own. Null or empty text fails the base rules;
    repeated rows count as often as they stand; an empty table gives no rows.
    """
    counts = stage(statistics(docs), "mcd-statistics")
    rows = transformed(counts.withColumn("base_failed", base_failed()))
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-"))
    levels = [F.concat_ws("\x00", name("lang"), name("source")), name("lang"), F.lit("*")]
    good = rows.filter(~F.col("base_failed"))
    vectors = good.select(F.explode(F.array(*[F.concat(F.lit(f"{i}:"), g) for i, g in enumerate(levels)])).alias("group"), *DIMENSIONS)
    found = stage(estimates(stage(vectors, "mcd-vectors")), "mcd-estimates")
    out = rows.withColumns({f"group{i}": F.concat(F.lit(f"{i}:"), g) for i, g in enumerate(levels)})
    usable = found.filter(F.col("rows") >= LEAST_GROUP)
    fields = _factor_columns() + ["scale"]
    for i in range(3):
        level = (usable if i < 2 else found).select(F.col("group").alias(f"group{i}"), F.struct(*fields).alias(f"estimate{i}"))
        out = out.join(level, f"group{i}", "left")
    out = out.withColumn("estimate", F.coalesce("estimate0", "estimate1", "estimate2")).select("*", *[F.col(f"estimate.{f}").alias(f) for f in fields])
    out = out.withColumn("distance", _distance() / F.col("scale"))
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= CUTOFF)
    return out.select("doc_id", *COUNTS, "base_failed", kept.alias("kept"), F.round("distance", 6).alias("distance"))
