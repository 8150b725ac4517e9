"""Joins over Voronoi cells against brute force, and how little of the pairs they meet."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from larder.operators import cells as cj
from larder.operators import similarity
from larder.operators.similarity import Scoring

SELF = Scoring(exclude_self=True)


def clustered(n, centres, dim, noise, seed=1, lengths=False):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(centres, dim))[rng.integers(0, centres, size=n)] + noise * rng.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return (x * rng.uniform(0.2, 3.0, size=(n, 1)) if lengths else x).astype(np.float32)


def table(spark, x, name="item_id"):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], f"{name} long, embedding array<float>")


def scores_of(a, b):
    return np.floor(a.astype(np.float64) @ b.astype(np.float64).T * 1e8 + 0.5) / 1e8


@pytest.mark.parametrize("lengths", [False, True])
def test_pairs_of_clustered_rows_meet_few_others(spark, lengths):
    x = clustered(1200, 40, 16, 0.05, lengths=lengths)
    got = cj.pairs_in_cells(table(spark, x), None, 0.9, "item_id", "embedding", 30).collect()
    scores = scores_of(x, x)
    a, b = np.nonzero(np.triu(scores >= 0.9, 1))
    assert sorted((r.query_id, r.item_id) for r in got) == sorted(zip(a.tolist(), b.tolist()))
    assert len(got) > 5000
    if not lengths:
        cells = cj.build_cells(table(spark, x), cell_rows=30)
        sent = cj.sent_rows(cj.threshold_targets(cells.items, cells, 0.9, "embedding", True), cells).first()
        assert sent.pairs < 0.1 * 1200**2 / 2


def test_a_third_of_all_rows_in_one_place(spark, monkeypatch):
    monkeypatch.setattr(cj, "BLOCK_BYTES", 4_000)  # the hot cell is cut into many blocks
    x = clustered(300, 10, 8, 0.3, seed=4)
    x[::3] = x[0]
    got = cj.pairs_in_cells(table(spark, x), None, 0.8, "item_id", "embedding", 20).collect()
    a, b = np.nonzero(np.triu(scores_of(x, x) >= 0.8, 1))
    assert sorted((r.query_id, r.item_id) for r in got) == sorted(zip(a.tolist(), b.tolist()))


def test_missing_vectors_are_in_no_pair_and_no_match(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, [nan, 0.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "item_id long, embedding array<float>")
    assert [(r.id_a, r.id_b) for r in similarity.similar_pairs(df, min_similarity=0.5).collect()] == [(0, 1)]
    assert similarity.similar_pairs(df, df.where("item_id = 99")).count() == 0 and similarity.similar_pairs(df.where("item_id = 2")).count() == 0
    asked = df.withColumnRenamed("item_id", "query_id")
    forms = [{(r.query_id, r.item_id, r.score) for r in similarity.top_k(asked, df, 3, **f).collect()} for f in ({}, {"max_rows": 0})]
    assert {q for q, _, _ in forms[1]} == {0, 1, 6} and forms[1] == {r for r in forms[0] if r[0] in (0, 1, 6)}


@pytest.mark.parametrize("lengths", [False, True])
def test_nearest_equals_the_broadcast_form(spark, lengths):
    x = clustered(2000, 50, 24, 0.08, seed=6, lengths=lengths)
    items, asked = table(spark, x), table(spark, x, "query_id")
    want = similarity.top_k(asked, items, 5, SELF).select("query_id", "item_id", "score", "rank")
    got, again, cells = cj.nearest_in_cells(asked, items, 5, SELF, cell_rows=40)
    got = similarity.rank_matches(got, 5).select("query_id", "item_id", "score", "rank")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    if not lengths:
        sent = cj.sent_rows(again, cells).first()
        print(sent, len(cells.rows))
        assert sent.pairs < 0.2 * 2000**2  # of the second pass; the first has about k rows for each request


def test_nearest_with_category_share_and_required(spark):
    x, q = clustered(200, 6, 6, 0.3, seed=8), clustered(30, 6, 6, 0.3, seed=9)
    items = table(spark, x).withColumn("category", F.when(F.col("item_id") % 5 == 0, "rare").otherwise("common"))
    items = items.withColumn("ingredients", F.concat(F.lit("thing "), (F.col("item_id") % 4).cast("string")))
    asked = table(spark, q, "query_id").withColumn("want", F.when(F.col("query_id") % 2 == 0, "rare"))
    asked = asked.withColumn("have", F.array(F.lit("thing 1"), F.lit("thing 2"))).withColumn("must", F.when(F.col("query_id") % 3 == 0, F.array(F.lit("3"))))
    for scoring in (Scoring(category="want"), Scoring(available="have", weights=(0.6, 0.4)), Scoring(available="have", required="must", weights=(0.6, 0.4), category="want")):
        want = similarity.top_k(asked, items, 7, scoring)
        got, _, _ = cj.nearest_in_cells(similarity._side(asked, scoring.query_side()), similarity._side(items, scoring.item_side()), 7, scoring, cell_rows=9)
        assert sorted(map(tuple, similarity.rank_matches(got, 7).collect())) == sorted(map(tuple, want.select("query_id", "item_id", "score", "rank").collect()))


def test_bounds_hold(spark):
    x = clustered(400, 5, 5, 0.5, seed=3, lengths=True)
    cells = cj.build_cells(table(spark, x), cell_rows=20)
    least, most = cells.bounds(x.astype(np.float64))
    home = np.array([r._cell for r in cells.items.orderBy("item_id").select("_cell").collect()])
    scores = x.astype(np.float64) @ x.astype(np.float64).T
    assert (scores >= least[:, home] - 1e-9).all() and (scores <= most[:, home] + 1e-9).all() and len(cells.rows) > 10


def test_no_cross_join(spark):
    x = clustered(60, 3, 4, 0.2)
    plan = plan_of(cj.pairs_in_cells(table(spark, x), None, 0.9, "item_id", "embedding", 10))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_a_request_is_sent_to_blocks_and_not_to_cells(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(900, 12))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)  # all directions alike: nearly every bound holds
    items, asked = table(spark, x), table(spark, x, "query_id")
    sizes = []
    for cell_rows in (100, 10):
        found, again, cells = cj.nearest_in_cells(asked, items, 5, SELF, cell_rows=cell_rows)
        sent = cj.sent_rows(again, cells).first()
        copies = again.agg(F.sum(F.size("_targets"))).first()[0]
        assert copies <= 900 * len(cells.members) and copies < sent.sent / 3
        sizes.append(copies)
        got = similarity.rank_matches(found, 5).select("query_id", "item_id", "score", "rank")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, similarity.top_k(asked, items, 5, SELF).collect()))
    assert sizes[1] <= 900 * len(cells.members) and len(cells.rows) > 80


def test_single_precision_loses_no_match(spark, monkeypatch):
    monkeypatch.setattr(similarity, "TILE_ENTRIES", 6_000)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 8)).round(1).astype(np.float32)  # many ties and near ties
    x[::50] = 0.0
    x[3], x[7] = x[3] * 1e18, np.nan
    q = np.concatenate([x[:40], x[:1] * 1e16])
    for scoring in (Scoring(), SELF):
        requests = similarity.Requests(pa.table({"query_id": np.arange(len(q)), "embedding": list(q)}), scoring)
        best = similarity.Best(requests, 5)
        order = rng.permutation(len(x))
        for part in np.array_split(order, 4):
            best.offer(pa.table({"item_id": part, "embedding": list(x[part])}))
        got = {}
        for r in best.result().to_pylist():
            got.setdefault(r["query_id"], []).append((r["item_id"], r["score"]))
        scores = scores_of(q, x)
        for i, row in enumerate(scores):
            usable = [(-s, j) for j, s in enumerate(row.tolist()) if np.isfinite(s) and not (scoring.exclude_self and i == j)]
            assert got.get(i, []) == [(j, -s) for s, j in sorted(usable)[:5]]


def test_where_bounds_save_little_blocks_meet_without_copies(spark):
    x = np.random.default_rng(4).normal(size=(600, 24)).astype(np.float32)  # all directions alike
    items, asked = table(spark, x), table(spark, x, "query_id")
    found, again, _ = cj.nearest_in_cells(asked, items, 5, SELF, cell_rows=20)
    assert again.agg(F.sum(F.size("_targets"))).first()[0] > 600
    plan = plan_of(found)
    assert "CartesianProduct" in plan and "CoGroup" not in plan and "BroadcastNestedLoop" not in plan
    expected = [(i, j, s) for i, row in enumerate(scores_of(x, x)) for s, j in [(-a, b) for a, b in sorted((-v, j) for j, v in enumerate(row.tolist()) if j != i)[:5]]]
    assert sorted(tuple(r)[:3] for r in similarity.rank_matches(found, 5).select("query_id", "item_id", "score").collect()) == sorted(expected)


def test_what_makes_the_vectors_runs_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.arrow_udf("array<float>")
    def vector(ids: pa.Array) -> pa.Array:
        made.add(len(ids))
        return pa.array([[float(i), 1.0] for i in ids.to_pylist()], pa.list_(pa.float32()))

    cells = cj.build_cells(spark.range(50).select(F.col("id").alias("item_id"), vector("id").alias("embedding")))
    assert made.value == cells.items.count() == 50
    made.value = 0
    asked = spark.range(40).select(F.col("id").alias("query_id"), vector("id").alias("embedding"))
    assert similarity.top_k(asked, table(spark, np.eye(2, dtype=np.float32)), 1, max_rows=0).count() == 40 and made.value == 40


def test_a_poor_floor_does_not_cost_whole_tiles(monkeypatch):
    rng = np.random.default_rng(6)
    x, q = rng.normal(size=(20_000, 16)).astype(np.float32), rng.normal(size=(64, 16)).astype(np.float32)
    whole, scored = similarity.Requests.whole, []
    monkeypatch.setattr(similarity.Requests, "whole", lambda self, rows, block, low, high, marks=None: scored.append(len(rows) * (high - low)) or whole(self, rows, block, low, high, marks))
    best = similarity.Best(similarity.Requests(pa.table({"query_id": np.arange(64), "embedding": list(q)}), Scoring()), 3, np.full(64, -5.0))
    best.offer(pa.table({"item_id": np.arange(20_000), "embedding": list(x)}))
    assert sum(scored) < 64 * 20_000 / 10
    top = np.argsort(-scores_of(q, x), axis=1, kind="stable")[:, :3]
    assert sorted(zip(best.result()["query_id"].to_pylist(), best.result()["item_id"].to_pylist())) == sorted((i, j) for i in range(64) for j in top[i].tolist())
