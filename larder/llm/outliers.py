"""Quality rules: text statistics, two fixed rules, and robust multivariate outliers.

For each language and source the minimum covariance determinant gives a centre and a scatter that
outliers cannot move: C-steps keep the 75 % of documents nearest to the centre and estimate
again, starting from medians; a last step reweighs. A document is rejected if its Mahalanobis distance
exceeds the chi-square quantile.

Everything is built-in expressions. Statistics are rounded to a grid and summed as integers, and order statistics
are read from histograms, so the result does not depend on how rows are partitioned; what is shuffled is one row per
group and bin. No group is ever gathered in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import WORD, filled, stored, total, words

GRID = 1000  # statistics are kept as whole thousandths
SUPPORT = 0.75
STEPS = 4
TAIL = 0.01  # share of a normal group beyond the distance; the floors below make it far less for clean text
LEAST_GROUP = 50  # documents; a smaller group is judged with others (see grouped)
# Least standard deviation of each statistic: what any clean group may vary by.
FLOORS = {"x1": 0.15, "x2": 0.08, "x3": 0.12, "x4": 0.12}
X = list(FLOORS)
P = len(X)
WHITE, SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"


def _chi_square(x: float, half: int) -> float:
    """Distribution function for 2 * half degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(half))


def chi_square_quantile(share: float, half: int = P // 2) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if _chi_square(middle, half) < share else (low, middle)
    return low


def consistency(share: float) -> float:
    """What the covariance of the nearest ``share`` of normal data is multiplied by."""
    return share / _chi_square(chi_square_quantile(share), P // 2 + 1)


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of the input as ``_row`` and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed.

    Null or empty text: zeros, base_failed. The whole text is read.
    """
    content = filled(F.col("_row")[text])
    rows = docs.select(F.struct("*").alias("_row"))
    hashed = rows.select("_row", F.transform(words(content), lambda w: F.xxhash64(w)).alias("_words"), F.filter(F.split(content, "\n"), lambda x: x.rlike(WORD)).alias("_lines"))
    windows = F.transform(F.sequence(F.lit(0), F.size("_words") - 5), lambda i: F.xxhash64(*[F.col("_words")[i + k] for k in range(5)]))
    windowed = hashed.select("_row", F.size("_words").cast("long").alias("n_words"), "_lines", F.when(F.size("_words") >= 5, windows).otherwise(F.array().cast("array<bigint>")).alias("_windows"))
    some_repeat = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.when(some_repeat, F.array_sort(F.transform("_windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))).otherwise(F.array().cast("array<struct<w:bigint,i:int>>"))
    sorted_ = windowed.select("_row", "n_words", "_lines", placed.alias("_placed"))
    twice = F.filter(
        "_placed",
        lambda x, i: ((i > 0) & (F.col("_placed")[F.greatest(i - 1, F.lit(0))]["w"] == x["w"])) | ((i < F.size("_placed") - 1) & (F.col("_placed")[F.least(i + 1, F.size("_placed") - 1)]["w"] == x["w"])),
    )
    covered = F.aggregate(
        F.array_sort(F.transform(twice, lambda x: x["i"])),
        F.named_struct(F.lit("n"), F.lit(0), F.lit("reach"), F.lit(0)),
        lambda a, i: F.named_struct(F.lit("n"), a["n"] + i + 5 - F.greatest(i, a["reach"]), F.lit("reach"), i + 5),
        lambda a: a["n"],
    )
    counted = sorted_.select(
        "_row", "n_words",
        F.length(F.translate(content, WHITE, "")).cast("long").alias("word_chars"),
        (F.length(content) - F.length(F.translate(content, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"), F.size("_lines").cast("long").alias("n_lines"),
    )
    return counted.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def _transformed() -> list[Column]:
    """Log of the mean word length and three rates, on the grid; the constants damp short texts."""
    n = F.col("n_words")
    values = {
        "x1": F.log((F.col("word_chars") + 50.0) / (n + 10.0)),
        "x2": F.log1p(F.col("n_symbols") / (n + 20.0)),
        "x3": F.col("n_dup_lines") / (F.col("n_lines") + 5.0),
        "x4": F.col("n_repeat_words") / (n + 20.0),
    }
    return [F.round(values[x] * GRID).cast("long").alias(x) for x in X]


def vectors(stats: DataFrame) -> DataFrame:
    """(lang, source, x1..x4, n): the distinct vectors of documents that passed the base rules, with counts. Null is a language and a source of its own."""
    return stats.where(~F.col("base_failed")).groupBy("lang", "source", *_transformed()).agg(F.count(F.lit(1)).alias("n"))


def grouped(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The vectors by the group that judges them, and the table (lang, source) -> group.

    A source under LEAST_GROUP documents is judged with the other small ones of its language; if these are too few together, by
    its whole language, and a language under LEAST_GROUP by all documents. So every vector has a group, and a whole
    language or all documents also hold the vectors of the sources that are judged by themselves.
    """
    sizes = stored(counts.groupBy("lang", "source").agg(F.sum("n").alias("_size")), "mcd-sizes")
    small = F.col("_size") < LEAST_GROUP
    languages = stored(sizes.groupBy(F.col("lang").alias("_l")).agg(F.coalesce(F.sum(F.when(small, F.col("_size"))), F.lit(0)).alias("_pool"), F.sum("_size").alias("_all")), "mcd-languages")
    few_pooled, few = (F.col("_pool") > 0) & (F.col("_pool") < LEAST_GROUP), F.col("_all") < LEAST_GROUP
    any_few = bool(languages.where(few).limit(1).count())

    def key(level: int, *of: str) -> Column:
        return F.xxhash64(F.lit(level), *[x for c in of for x in (F.isnull(c), c)])

    whole, everything = key(2, "lang"), key(3)
    own = F.when(few, everything).when(~small, key(0, "lang", "source")).when(few_pooled, whole).otherwise(key(1, "lang"))
    also = F.array_compact(F.array(own, F.when(few_pooled & ~few, whole), F.when(F.lit(any_few), everything)))
    placed = sizes.join(languages, F.col("lang").eqNullSafe(F.col("_l"))).select("lang", "source", own.alias("g"), F.array_distinct(also).alias("_in"))
    placed = stored(placed, "mcd-named")
    member = placed.select(F.col("lang").alias("_l"), F.col("source").alias("_s"), "_in")
    joined = counts.join(member, F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")))
    merged = joined.select(F.explode("_in").alias("g"), *X, "n").groupBy("g", *X).agg(F.sum("n").alias("n"))
    return merged, placed.select("lang", "source", "g")


def _quantile_bin(binned: DataFrame, share: float, bin_: str) -> DataFrame:
    """(g, bin): the first bin up to which ``share`` of a group's documents lie."""
    counts = binned.groupBy("g", bin_).agg(F.sum("n").alias("n"))
    by = Window.partitionBy("g")
    upto = F.sum("n").over(by.orderBy(bin_).rowsBetween(Window.unboundedPreceding, 0))
    return counts.withColumn("_upto", upto).withColumn("_all", F.sum("n").over(by)).where(F.col("_upto") >= F.ceil(F.col("_all") * share)).groupBy("g").agg(F.min(bin_).alias(bin_))


def _estimate(chosen: DataFrame, factor: float) -> DataFrame:
    """(g, m1..m4, l11..l44): means and the Cholesky factor of the scatter, from integer sums; the floors are added to its diagonal."""
    n = F.col("n")
    sums = [F.sum(F.col(x) * n).alias(f"s_{x}") for x in X] + [F.sum((F.col(a) * F.col(b) * n).cast("decimal(38,0)")).alias(f"s_{a}{b}") for i, a in enumerate(X) for b in X[: i + 1]]
    summed = chosen.groupBy("g").agg(F.sum("n").alias("_n"), *sums)
    mean = {x: F.col(f"s_{x}") / F.col("_n") for x in X}
    out = summed.select("g", *[mean[x].alias(f"m{i + 1}") for i, x in enumerate(X)], *[((F.col(f"s_{a}{b}").cast("double") / F.col("_n") - mean[a] * mean[b]) * factor + (float((FLOORS[a] * GRID) ** 2) if a == b else 0.0)).alias(f"c{i + 1}{j + 1}") for i, a in enumerate(X) for j, b in enumerate(X[: i + 1])])
    for i in range(1, P + 1):  # a column of the factor after the other
        for j in range(1, i + 1):
            rest = F.col(f"c{i}{j}") - (total([F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(1, j)]) if j > 1 else F.lit(0.0))
            out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1.0))) if i == j else rest / F.col(f"l{j}{j}"))
    return out.select("g", *[f"m{i}" for i in range(1, P + 1)], *[f"l{i}{j}" for i in range(1, P + 1) for j in range(1, i + 1)])


def _with_distance(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Adds d2, the squared Mahalanobis distance, by forward substitution."""
    joined = rows.join(estimates, "g")
    for i in range(1, P + 1):
        before = total([F.col(f"l{i}{k}") * F.col(f"_y{k}") for k in range(1, i)]) if i > 1 else F.lit(0.0)
        joined = joined.withColumn(f"_y{i}", (F.col(f"x{i}") - F.col(f"m{i}") - before) / F.col(f"l{i}{i}"))
    return joined.withColumn("d2", total([F.col(f"_y{i}") * F.col(f"_y{i}") for i in range(1, P + 1)])).select(*rows.columns, "d2")


def _d2_bin() -> Column:
    return F.floor(F.log1p(F.col("d2")) * 200)


def fit(counts: DataFrame) -> DataFrame:
    """The minimum covariance determinant of each group of vectors, as a stored table of one row per group."""
    start = None
    for i, x in enumerate(X):  # medians and floors: the first centre and scatter
        middle = _quantile_bin(counts, 0.5, x).select("g", F.col(x).cast("double").alias(f"m{i + 1}"))
        start = middle if start is None else start.join(middle, "g")
    flat = {f"l{i}{j}": F.lit(FLOORS[f"x{i}"] * GRID if i == j else 0.0) for i in range(1, P + 1) for j in range(1, i + 1)}
    estimates = stored(start.select("*", *[v.alias(k) for k, v in flat.items()]), "mcd-start")
    for _ in range(STEPS):
        far = _with_distance(counts, estimates).withColumn("_bin", _d2_bin())
        edge = _quantile_bin(far, SUPPORT, "_bin").withColumnRenamed("_bin", "_edge")
        estimates = stored(_estimate(far.join(edge, "g").where(F.col("_bin") <= F.col("_edge")), consistency(SUPPORT)), "mcd-step")
    near = _with_distance(counts, estimates).where(F.col("d2") <= chi_square_quantile(0.975))
    return stored(_estimate(near, consistency(0.975)), "mcd-last")


def judged(stats: DataFrame) -> DataFrame:
    """The rows of a stored statistics table with ``d2`` (null only where the base rules failed) and ``kept``."""
    counts, named = grouped(stored(vectors(stats), "mcd-vectors"))
    counts = stored(counts, "mcd-counts")
    estimates = fit(counts)
    other = named.select(F.col("lang").alias("_l"), F.col("source").alias("_s"), "g").join(estimates, "g")
    rows = stats.select("*", *_transformed())
    joined = rows.join(other, F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")), "left")
    for i in range(1, P + 1):
        before = total([F.col(f"l{i}{k}") * F.col(f"_y{k}") for k in range(1, i)]) if i > 1 else F.lit(0.0)
        joined = joined.withColumn(f"_y{i}", (F.col(f"x{i}") - F.col(f"m{i}") - before) / F.col(f"l{i}{i}"))
    distance = joined.withColumn("d2", total([F.col(f"_y{i}") * F.col(f"_y{i}") for i in range(1, P + 1)]))
    return distance.withColumn("kept", ~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= chi_square_quantile(1 - TAIL))).select(*stats.columns, "d2", "kept")


STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "base_failed"]


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, row_hash, the statistics, d2 and kept of every row; row_hash covers doc_id, lang, source and text.

    Columns ``doc_id``, ``text``, ``lang`` and ``source`` are read, others ignored. Repeated rows are judged
    alike. An empty table gives no rows.
    """
    read = docs.select("doc_id", "lang", "source", "text")
    key = F.xxhash64(*[F.col("_row")[c] for c in ("doc_id", "lang", "source", "text")])
    stats = with_statistics(read).select(F.col("_row")["doc_id"].alias("doc_id"), F.col("_row")["lang"].alias("lang"), F.col("_row")["source"].alias("source"), key.alias("row_hash"), *STATS)
    return judged(stored(stats, "quality-statistics"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows that ``judge`` keeps, with all their columns."""
    bad = judge(docs).where(~F.col("kept")).select(F.col("doc_id").alias("id"), F.col("row_hash").alias("hash")).distinct()
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))  # so that no column of the input has a name of ours
    key = F.xxhash64(*[F.col("row")[c] for c in ("doc_id", "lang", "source", "text")])
    return whole.join(bad, F.col("row.doc_id").eqNullSafe(F.col("id")) & (key == F.col("hash")), "left_anti").select("row.*")
