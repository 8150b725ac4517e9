"""Frequency and summary operators.

Every one is a partial aggregate before its only shuffle, so a value that holds a
third of all rows leaves each task as one row.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from larder import fixed
from larder.functions import text as tx
from larder.session import fresh_path


def value_counts(df: DataFrame, column: str, n: int | None = None, value: str = "value", count: str = "n") -> DataFrame:
    """Rows per non-null value, most frequent first, ties by value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias(value)).agg(F.count("*").alias(count))
    return counts if n is None else counts.orderBy(F.desc(count), F.asc(value)).limit(n)


def share_of_top(df: DataFrame, column: str, n: int) -> DataFrame:
    """Percent of each of the top ``n`` values among those ``n``."""
    top = value_counts(df, column, n)
    total = top.agg(F.sum("n")).scalar()
    return top.withColumn("percent", 100.0 * F.col("n") / total)


def bucket_other(df: DataFrame, column: str, n: int, target: str, other: str = fixed.OTHER_LABEL) -> DataFrame:
    """Values outside the top ``n`` become one label. The broadcast side has ``n`` rows."""
    top = value_counts(df, column, n).select(F.col("value").alias("_top"))
    joined = df.join(F.broadcast(top), F.col(column) == F.col("_top"), "left")
    return joined.withColumn(target, F.coalesce("_top", F.lit(other))).drop("_top")


def ingredient_terms(df: DataFrame, column: str = "ingredients", variant: str = "index") -> DataFrame:
    """One row per ingredient mention: lower case, measure stripped, longer than two characters."""
    parts = F.explode(F.split(F.lower(tx.text_or_blank(column)), fixed.LIST_SEPARATOR, -1))
    names = df.select(parts.alias("part")).select(
        tx.trim_ws(tx.strip_measure(tx.trim_ws("part"), variant)).alias("ingredient")
    )
    return names.where(F.length("ingredient") >= fixed.MIN_TERM_CHARS)


def ingredient_index(df: DataFrame, column: str = "ingredients", variant: str = "index", n: int | None = None) -> DataFrame:
    return value_counts(ingredient_terms(df, column, variant), "ingredient", n, "ingredient")


def word_frequencies(df: DataFrame, column: str, n: int = 80) -> DataFrame:
    """Most frequent whitespace tokens, weighted relative to the most frequent one."""
    words = df.select(F.explode(tx.whitespace_tokens(column)).alias("word")).where(F.length("word") >= fixed.MIN_TERM_CHARS)
    top = value_counts(words, "word", n, "word")
    return top.withColumn("weight", F.col("n") / top.agg(F.max("n")).scalar())


def summary(df: DataFrame, distinct: list[str], nullable: list[str]) -> DataFrame:
    """Row count, distinct values and nulls per column, in one row."""
    return df.agg(
        F.count("*").alias("rows"),
        *[F.count_distinct(c).alias(f"distinct_{c}") for c in distinct],
        *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in nullable],
    )


def means(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(*[F.avg(c).alias(c) for c in columns])


def histogram(df: DataFrame, column: str, bins: int | list[float]) -> DataFrame:
    """Counts per bin: ``bin, low, high, n``; empty bins are kept.

    ``bins`` is a number of equal-width bins over the value range, or explicit
    edges. The last bin includes its upper edge; values outside the edges and
    nulls are not counted.
    """
    x = F.col("_x")
    values = df.select(F.col(column).cast("double").alias("_x")).where(x.isNotNull())
    if isinstance(bins, int):
        count = bins
        # One row: the value range, read as a scalar subquery.
        low = values.agg(F.min("_x")).scalar()
        high = values.agg(F.max("_x")).scalar()
        flat = low == high
        low, high = F.when(flat, low - 0.5).otherwise(low), F.when(flat, high + 0.5).otherwise(high)
        width = (high - low) / count
        place = F.least(F.floor((x - low) / width), F.lit(count - 1))
        edge = lambda i: low + i * width
        inside = F.lit(True)
    else:
        count = len(bins) - 1
        # Bin number = edges at or below the value, minus one; the last edge belongs to the last bin.
        place = F.lit(-1)
        for e in bins[:-1]:
            place = place + (x >= F.lit(float(e))).cast("int")
        edges = F.array(*[F.lit(float(e)) for e in bins])
        edge = lambda i: F.element_at(edges, (i + 1).cast("int"))
        inside = (x >= float(bins[0])) & (x <= float(bins[-1]))
    counted = values.where(inside).groupBy(place.cast("long").alias("bin")).agg(F.count("*").alias("n"))
    spine = df.sparkSession.range(count).withColumnRenamed("id", "bin")
    i = F.col("bin")
    return spine.join(F.broadcast(counted), "bin", "left").select(
        "bin", edge(i).alias("low"), edge(i + 1).alias("high"), F.coalesce("n", F.lit(0)).alias("n")
    )


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair, lower triangle: ``a, b, r``."""
    pairs = [(b, a) for a, b in combinations(columns, 2)]
    row = df.agg(*[_correlation(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cells = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}|{b}`").alias("r")) for a, b in pairs])
    return row.select(F.inline(cells))


def _correlation(a: str, b: str) -> Column:
    """Over the rows that have both values; null where one of them is constant, where corr() would raise."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x, y = (F.when(both, F.col(c).cast("double")) for c in (a, b))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def describe(df: DataFrame, columns: list[str], accuracy: int | None = None) -> DataFrame:
    """mean, median, max, min per numeric column: ``column, mean, median, max, min``.

    The exact median is found by rank over (value, frequency) rows dealt out by range, so no task holds more than a
    range. ``accuracy`` switches to the approximate percentile.
    """
    stacked = df.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns]))
    ).where("x is not null")
    counts = stacked.groupBy("column", "x").agg(F.count("*").alias("n"))
    if accuracy:
        middle = stacked.groupBy("column").agg(F.percentile_approx("x", 0.5, accuracy).alias("median"))
        rest = counts.groupBy("column").agg(*_weighted())
        return rest.join(middle, "column")
    path = fresh_path(df.sparkSession, "value-counts")
    counts.repartitionByRange("column", "x").withColumn("_range", F.spark_partition_id()).write.parquet(path)
    counts = df.sparkSession.read.parquet(path)
    return counts.groupBy("column").agg(*_weighted()).join(_medians(counts), "column")


def _medians(counts: DataFrame) -> DataFrame:
    """``column, median`` of rows ``column, x, n, _range`` that are dealt out by range: only the range of the middle ranks is ordered."""
    sizes = counts.groupBy("column", "_range").agg(F.sum("n").alias("_n"))  # one row per column and range
    by = Window.partitionBy("column")
    before = F.coalesce(F.sum("_n").over(by.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = sizes.withColumns({"_before": before, "_all": F.sum("_n").over(by)})
    spans = spans.withColumns({"_low": F.floor((F.col("_all") - 1) / 2), "_high": F.floor(F.col("_all") / 2)})
    middle = spans.where((F.col("_before") <= F.col("_high")) & (F.col("_before") + F.col("_n") > F.col("_low"))).drop("_n", "_all")
    rows = counts.join(F.broadcast(middle), ["column", "_range"])  # two ranges of a column at most
    upto = F.col("_before") + F.sum("n").over(Window.partitionBy("column", "_range").orderBy("x").rowsBetween(Window.unboundedPreceding, 0))
    placed = rows.withColumn("_upto", upto).withColumn("_from", F.col("_upto") - F.col("n"))

    def at(rank: str) -> Column:
        return F.max(F.when((F.col("_from") <= F.col(rank)) & (F.col(rank) < F.col("_upto")), F.col("x")))

    return placed.groupBy("column").agg(((at("_low") + at("_high")) / 2).alias("median"))


def _weighted() -> list[Column]:
    return [
        (F.sum(F.col("x") * F.col("n")) / F.sum("n")).alias("mean"),
        F.max("x").alias("max"),
        F.min("x").alias("min"),
    ]


def mode_per_group(df: DataFrame, group: str, column: str) -> DataFrame:
    """Most frequent value per group (ties: smallest) and the group size."""
    counts = df.groupBy(group, F.col(column).alias("_value")).agg(F.count("*").alias("n"))
    # Nulls count for the size, never for the mode.
    ordered = F.when(F.col("_value").isNotNull(), F.struct((-F.col("n")).alias("fewer"), "_value"))
    return counts.groupBy(group).agg(F.min(ordered)["_value"].alias("mode"), F.sum("n").alias("size"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def best_by(df: DataFrame, key: str, value: str) -> DataFrame:
    """The key with the largest value; ties go to the smallest key."""
    return df.agg(F.max_by(key, F.struct(F.col(value), -F.col(key))).alias(key), F.max(value).alias(value))
