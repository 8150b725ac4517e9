"""Aggregates on literal rows and against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.operators import cache, profile


def test_value_counts_ties_and_nulls(spark):
    rows = spark.createDataFrame([(x,) for x in ["b", "a", "b", "a", "c", None, None, None]], "v string")
    assert [(r.value, r.n) for r in profile.value_counts(rows, "v", 2).collect()] == [("a", 2), ("b", 2)]


def test_ingredient_index(spark):
    rows = spark.createDataFrame([("60ml Vodka\n1/2 oz lime, ab",), ("2 oz vodka",), (None,)], "ingredients string")
    got = {r.ingredient: r.n for r in profile.ingredient_index(rows).collect()}
    assert got == {"vodka": 2, "1/lime": 1}


@pytest.mark.parametrize("bins", [15, 1, [0.0, 1.0, 2.5, 4.0]])
def test_histogram_against_numpy(spark, bins):
    values = np.round(np.random.default_rng(3).exponential(1.0, 300), 3)
    values[0], values[1] = 4.0, 2.5
    df = spark.createDataFrame([(float(x),) for x in values] + [(None,)], "x double")
    got = profile.histogram(df, "x", bins).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins)
    assert [r.n for r in got] == counts.tolist()
    assert [r.low for r in got] == pytest.approx(edges[:-1]) and [r.high for r in got] == pytest.approx(edges[1:])


def test_histogram_of_one_value_and_of_none(spark):
    one = profile.histogram(spark.createDataFrame([(5.0,)] * 4, "x double"), "x", 2).orderBy("bin").collect()
    assert [(r.low, r.high, r.n) for r in one] == [(4.5, 5.0, 0), (5.0, 5.5, 4)]
    none = profile.histogram(spark.createDataFrame([], "x double"), "x", 2).collect()
    assert [r.n for r in none] == [0, 0]


def test_describe_exact_and_approximate(spark):
    values = [1, 5, 2, 2, 9, 9, 9, 100]
    df = spark.createDataFrame([(v, float(v) / 3) for v in values], "a int, b double")
    got = {r["column"]: r for r in profile.describe(df, ["a", "b"]).collect()}
    assert (got["a"]["mean"], got["a"]["median"], got["a"]["max"], got["a"]["min"]) == (np.mean(values), np.median(values), 100, 1)
    assert got["b"]["median"] == pytest.approx(np.median(values) / 3)
    rough = {r["column"]: r for r in profile.describe(df, ["a"], accuracy=1000).collect()}
    assert rough["a"]["median"] in values


def test_mode_ties_and_nulls(spark):
    rows = [(1, "b"), (1, "a"), (1, "a"), (1, "b"), (1, None), (1, None), (1, None), (2, None)]
    got = {r.g: r for r in profile.mode_per_group(spark.createDataFrame(rows, "g int, v string"), "g", "v").collect()}
    assert (got[1].mode, got[1].size, got[2].mode, got[2].size) == ("a", 7, None, 1)


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 7.0), (2.0, 4.0, 7.0), (3.0, 6.1, 7.0)], "a double, b double, c double")
    got = {(r.a, r.b): r.r for r in profile.correlations(df, ["a", "b", "c"]).collect()}
    assert got["b", "a"] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4, 6.1])[0, 1])
    assert got["c", "a"] is None and set(got) == {("b", "a"), ("c", "a"), ("c", "b")}


def test_best_by_prefers_the_smaller_key(spark):
    df = spark.createDataFrame([(3, 0.5), (2, 0.7), (5, 0.7)], "k long, s double")
    assert profile.best_by(df, "k", "s").first().k == 2


def test_bucket_and_share(spark):
    rows = spark.createDataFrame([(x,) for x in "aaabbcd"] + [(None,)], "v string")
    got = [r.b for r in profile.bucket_other(rows, "v", 2, "b").select("b").collect()]
    assert sorted(got) == ["Autre"] * 3 + ["a"] * 3 + ["b"] * 2
    assert {r.value: r.percent for r in profile.share_of_top(rows, "v", 2).collect()} == {"a": 60.0, "b": 40.0}


def test_summary(spark):
    df = spark.createDataFrame([("a", None), ("a", "x"), (None, "y")], "p string, q string")
    row = profile.summary(df, ["p", "q"], ["p", "q"]).first()
    assert (row.rows, row.distinct_p, row.distinct_q, row.nulls_p, row.nulls_q) == (3, 1, 2, 1, 1)


def test_misses_are_distinct_before_the_shuffle(spark):
    asked = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5)).alias("key"))
    asked = asked.withColumn("payload", F.upper("key"))
    known = spark.createDataFrame([("k1", "v")], "key string, value string")
    wanted = cache.misses(asked, known, "key", "payload")
    assert sorted(r.key for r in wanted.collect()) == ["hot", "k0", "k2", "k3", "k4"]
    looked = cache.lookup(asked, known, "key")
    assert looked.where("cached").count() == asked.where("key = 'k1'").count()
