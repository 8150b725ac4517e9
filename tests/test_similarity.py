"""Similarity joins against brute force, in both physical forms."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from larder.functions import vector as vx
from larder.operators import approximate, recommend, similarity
from larder.operators.similarity import Scoring

FORMS = [{}, {"max_rows": 0}]


def vectors(spark, matrix, name, start=0):
    rows = [(start + i, [float(x) for x in row]) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{name} long, embedding array<float>")


def unit(n, dim, seed):
    values = np.random.default_rng(seed).normal(size=(n, dim)).astype(np.float32)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def brute(queries, items, k, keep=lambda q, i: True):
    scores = np.floor(queries.astype(np.float64) @ items.astype(np.float64).T * 1e8 + 0.5) / 1e8
    out = []
    for q in range(len(queries)):
        order = sorted((i for i in range(len(items)) if keep(q, i)), key=lambda i: (-scores[q, i], i))[:k]
        out += [(q, i, pytest.approx(scores[q, i], abs=1e-8), r + 1) for r, i in enumerate(order)]
    return out


def rows_of(df):
    return [(r.query_id, r.item_id, r.score, r.rank) for r in df.orderBy("query_id", "rank").collect()]


@pytest.mark.parametrize("form", FORMS)
def test_top_k_equals_brute_force(spark, form):
    q, x = unit(7, 16, 1), unit(300, 16, 2)
    got = similarity.top_k(vectors(spark, q, "query_id"), vectors(spark, x, "item_id").repartition(5), 4, **form)
    assert rows_of(got) == brute(q, x, 4)


@pytest.mark.parametrize("form", FORMS)
def test_pilot_pass_changes_nothing_but_the_rows_sent(spark, form):
    q, x = unit(9, 8, 21), unit(400, 8, 22)
    x[::3] = x[0]
    items = vectors(spark, x, "item_id").repartition(16)
    got = similarity.top_k(vectors(spark, q, "query_id"), items, 5, pilot=4, **form)
    assert rows_of(got) == brute(q, x, 5)
    masked = Scoring(category="want", mask=True)
    asked = vectors(spark, q, "query_id").withColumn("want", F.lit("rare"))
    rare = items.withColumn("category", F.when(F.col("item_id") < 3, "rare").otherwise("common"))
    both = [rows_of(similarity.top_k(asked, rare, 5, masked, pilot=n, **form)) for n in (None, 4)]
    assert both[0] == both[1]


@pytest.mark.parametrize("form", FORMS)
def test_blocks_of_bounded_size(spark, form, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK_REQUESTS", 5)
    monkeypatch.setattr(similarity, "BLOCK_ITEMS", 40)
    monkeypatch.setattr(similarity, "TILE_ENTRIES", 64)
    q, x = unit(23, 8, 3), unit(200, 8, 4)
    got = similarity.top_k(vectors(spark, q, "query_id"), vectors(spark, x, "item_id"), 6, **form)
    assert rows_of(got) == brute(q, x, 6)


@pytest.mark.parametrize("form", FORMS)
def test_ties_go_to_the_smaller_id_even_when_a_third_is_equal(spark, form):
    x = unit(90, 8, 5)
    x[::3] = x[0]
    q = np.array([x[0]])
    got = rows_of(similarity.top_k(vectors(spark, q, "query_id"), vectors(spark, x, "item_id").repartition(7), 5, **form))
    assert [r[1] for r in got] == [0, 3, 6, 9, 12]


@pytest.mark.parametrize("form", FORMS)
def test_fewer_items_than_k(spark, form):
    q, x = unit(2, 4, 6), unit(3, 4, 7)
    assert rows_of(similarity.top_k(vectors(spark, q, "query_id"), vectors(spark, x, "item_id"), 5, **form)) == brute(q, x, 5)


@pytest.mark.parametrize("form", FORMS)
def test_category_strict_and_mask(spark, form):
    q, x = unit(2, 8, 8), unit(30, 8, 9)
    items = vectors(spark, x, "item_id").withColumn("category", F.when(F.col("item_id") < 3, "Rare").when(F.col("item_id") > 3, "Common"))
    asked = vectors(spark, q, "query_id").withColumn("want", F.when(F.col("query_id") == 0, "RARE"))
    strict = rows_of(similarity.top_k(asked, items, 5, Scoring(category="want"), **form))
    assert [r[1] for r in strict if r[0] == 0] == [r[1] for r in brute(q, x, 3, lambda a, i: i < 3) if r[0] == 0]
    assert [r[1] for r in strict if r[0] == 1] == [r[1] for r in brute(q, x, 5) if r[0] == 1]
    masked = [r for r in rows_of(similarity.top_k(asked, items, 5, Scoring(category="want", mask=True), **form)) if r[0] == 0]
    assert [r[2] for r in masked][3:] == [-1.0, -1.0] and [r[1] for r in masked][3:] == [3, 4]


@pytest.mark.parametrize("form", FORMS)
def test_coverage_and_required(spark, form):
    items = spark.createDataFrame(
        [(0, [1.0, 0.0], "Vodka, Lime"), (1, [0.0, 1.0], "GINGER beer"), (2, [0.0, 1.0], None)],
        "item_id long, embedding array<float>, ingredients string",
    )
    asked = spark.createDataFrame(
        [(0, [0.0, 1.0], ["vodka", "Gin"], ["gin"]), (1, [1.0, 0.0], [], None)],
        "query_id long, embedding array<float>, available array<string>, must array<string>",
    )
    hybrid = Scoring(available="available", weights=(0.5, 0.5))
    got = rows_of(similarity.top_k(asked, items, 3, hybrid, **form))
    assert got[:3] == [(0, 1, 0.75, 1), (0, 2, 0.5, 2), (0, 0, 0.25, 3)]
    assert got[3:] == [(1, 0, 0.5, 1), (1, 1, 0.0, 2), (1, 2, 0.0, 3)]
    strict = rows_of(similarity.top_k(asked, items, 3, Scoring(available="available", required="must", weights=(0.5, 0.5)), **form))
    assert [(r[0], r[1]) for r in strict] == [(0, 1), (1, 0), (1, 1), (1, 2)]
    masked = rows_of(
        similarity.top_k(asked, items, 3, Scoring(available="available", required="must", weights=(0.5, 0.5), mask=True), **form)
    )
    assert masked[:3] == [(0, 1, 0.75, 1), (0, 0, -1.0, 2), (0, 2, -1.0, 3)]


@pytest.mark.parametrize("cell_rows", [None, 7])
def test_pairs_equal_brute_force(spark, cell_rows):
    x = unit(50, 4, 10)
    got = similarity.similar_pairs(vectors(spark, x, "item_id"), min_similarity=0.5, cell_rows=cell_rows).collect()
    scores = x.astype(np.float64) @ x.astype(np.float64).T
    assert {(r.id_a, r.id_b) for r in got} == {(a, b) for a in range(50) for b in range(a + 1, 50) if scores[a, b] >= 0.5}
    assert len(got) == len({(r.id_a, r.id_b) for r in got})


@pytest.mark.parametrize("cell_rows", [None, 4])
def test_pairs_of_two_sets(spark, cell_rows):
    a, b = unit(10, 4, 31), unit(15, 4, 32)
    got = similarity.similar_pairs(vectors(spark, a, "item_id"), vectors(spark, b, "item_id"), -1.0, cell_rows=cell_rows)
    assert got.count() == 150  # a threshold at the lower end gives the whole matrix
    scores = a.astype(np.float64) @ b.astype(np.float64).T
    assert all(r.score == pytest.approx(scores[r.id_a, r.id_b], abs=1e-7) for r in got.collect())


def test_wide_matches_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(similarity, "MAX_BROADCAST_MATCHES", 3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        items = vectors(spark, unit(9, 4, 33), "item_id")
        asked = vectors(spark, unit(2, 4, 34), "query_id")
        assert "BroadcastHashJoin" in plan_of(similarity.top_k(asked, items, 1, attach=items.select("item_id")))
        assert "BroadcastHashJoin" not in plan_of(similarity.top_k(asked, items, 2, attach=items.select("item_id")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_expression_and_block_scores_agree(spark):
    x = unit(40, 16, 11)
    df = vectors(spark, x, "item_id")
    top = similarity.top_k(df.withColumnRenamed("item_id", "query_id"), df, 3)
    joined = top.join(df, "item_id").join(
        df.select(F.col("item_id").alias("query_id"), F.col("embedding").alias("asked")), "query_id"
    )
    assert joined.where(F.abs(vx.dot("asked", "embedding") - F.col("score")) > 1e-7).count() == 0


def test_vector_expressions(spark):
    rows = spark.createDataFrame([([0.6, 0.8, 0.0], [0.6, 0.8, 0.0]), ([1.0, 0.0, 0.0], [0.0, 1.0, 0.0])], "a array<double>, b array<double>")
    assert [r[0] for r in rows.select(vx.dot("a", "b")).collect()] == pytest.approx([1.0, 0.0])
    zero = spark.createDataFrame([([0.0, 0.0],), ([3.0, 4.0],)], "v array<double>")
    assert [r[0] for r in zero.select(vx.normalised("v")).collect()] == [[0.0, 0.0], pytest.approx([0.6, 0.8])]


def test_dimensions_must_agree(spark):
    items = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0])], "item_id long, embedding array<float>").coalesce(1)
    with pytest.raises(Exception, match="dimension"):
        similarity.top_k(vectors(spark, unit(1, 2, 0), "query_id"), items, 1).collect()


def test_plan_scores_in_place_and_limits_before_the_exchange(spark, folder):
    vectors(spark, unit(20, 4, 12), "item_id").withColumn("category", F.lit("a")).write.parquet(f"{folder}/index")
    index = spark.read.parquet(f"{folder}/index")
    asked = spark.createDataFrame([(0, "text")], "query_id long, text string")
    plan = plan_of(recommend.by_text(asked, index, 2, category="A", embedder=lambda c: F.array(*[F.lit(0.5)] * 4)))
    assert "MapInArrow" in plan and "WindowGroupLimit" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "lower(category" in plan.split("FileScan")[-1]  # the category predicate is at the scan


def test_embedder_is_stable_and_unit_length(spark):
    rows = spark.createDataFrame([(0, "Mojito mint"), (1, "mint MOJITO"), (2, "negroni"), (3, None), (4, "")], "item_id long, text string")
    got = {r.item_id: np.array(r.embedding) for r in recommend.embed(rows, "text").collect()}
    assert all(len(v) == 384 for v in got.values())
    assert np.allclose(got[0], got[1]) and not np.allclose(got[0], got[2])
    assert np.linalg.norm(got[0]) == pytest.approx(1.0, abs=1e-6) and not got[3].any() and not got[4].any()


def test_index_needs_its_text_column(spark):
    with pytest.raises(ValueError, match="missing"):
        recommend.build_index(spark.range(1).withColumnRenamed("id", "item_id"), "text_full")


def test_plug_in_embedder_sees_each_text_once(spark, folder):
    def encode(frames):
        for frame in frames:
            assert frame.payload.is_unique
            yield frame.assign(value=[[float(len(p)), 1.0] for p in frame.payload])[["key", "value"]]

    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"t{i}") for i in range(30)], "item_id long, text string")
    first = recommend.embed_cached(rows, "text", "m", encode, f"{folder}/cache")
    assert {r.text: r.embedding for r in first.collect()}["hot"] == [3.0, 1.0]
    assert spark.read.parquet(f"{folder}/cache").count() == 11

    def fail(frames):
        for frame in frames:
            assert frame.empty
            yield frame.assign(value=[])[["key", "value"]]

    assert recommend.embed_cached(rows, "text", "m", fail, f"{folder}/cache").count() == 30


@pytest.mark.parametrize("block_items", [7, 65_536])
def test_probing_every_cell_is_exact(spark, block_items):
    q, x = unit(5, 8, 13), unit(120, 8, 14)
    x[::3] = x[0]  # one hot cell, cut into blocks
    items = vectors(spark, x, "item_id")
    centres = approximate.fit_cells(items, 4)
    index = approximate.build_cell_index(items, centres)
    got = approximate.probe_top_k(vectors(spark, q, "query_id"), index, centres, 5, probes=4, block_items=block_items, block_requests=2)
    assert rows_of(got) == brute(q, x, 5)


def test_probing_some_cells_has_bounded_recall(spark):
    x = unit(400, 8, 15)
    items, asked = vectors(spark, x, "item_id"), vectors(spark, x[:40], "query_id")
    centres = approximate.fit_cells(items, 8)
    found = approximate.probe_top_k(asked, approximate.build_cell_index(items, centres), centres, 5, probes=4)
    recall = approximate.recall_against(similarity.top_k(asked, items, 5), found).first().recall
    assert 0.7 < recall <= 1.0


@pytest.mark.parametrize("block_items", [9, 65_536])
def test_codes_find_all_that_can_be_best(spark, block_items):
    q, x = unit(12, 10, 16), unit(300, 10, 17)
    x[::3] = x[0]  # one hot cell, cut into blocks; equal items tie
    items = vectors(spark, x, "item_id").union(spark.createDataFrame([(900, None)], "item_id long, embedding array<float>"))
    asked = vectors(spark, q, "query_id").union(spark.createDataFrame([(900, None)], "query_id long, embedding array<float>"))
    books = approximate.fit_codebooks(items, approximate.fit_cells(items.where("embedding IS NOT NULL"), 4), parts=3, words=16)
    codes = approximate.build_code_index(items, books)
    got = approximate.quantised_top_k(asked, codes, items, books, 5, probes=4, block_items=block_items, block_requests=5)
    assert rows_of(got) == brute(q, x, 5)


def test_recall_of_the_quantised_index(spark):
    rng = np.random.default_rng(19)
    x = (unit(20, 16, 18)[rng.integers(0, 20, 1500)] + 0.1 * rng.normal(size=(1500, 16))).astype(np.float32)
    items, asked = vectors(spark, x, "item_id"), vectors(spark, x[:100], "query_id")
    books = approximate.fit_codebooks(items, approximate.fit_cells(items, 20), parts=8, words=64)
    codes = approximate.build_code_index(items, books)
    candidates = approximate.quantised_candidates(asked, codes, books, 5, 4).count()
    found = approximate.quantised_top_k(asked, codes, items, books, 5, 4)
    assert approximate.recall_against(similarity.top_k(asked, items, 5), found).first().recall >= 0.9
    assert candidates < 0.3 * 1500 * 100


@pytest.mark.parametrize("form", [{}, {"max_rows": 0}])
@pytest.mark.parametrize("bad", [1, 2, 5])
def test_nan_and_null_vectors_lose_no_match(spark, form, bad):
    good = [(i, [1.0, i / 10.0]) for i in range(8)]
    broken = [(100 + i, [float("nan"), 1.0]) for i in range(bad)] + [(200 + i, None) for i in range(bad)]
    schema = "item_id long, embedding array<float>"
    asked = spark.createDataFrame([(0, [0.0, 1.0]), (1, None), (2, [float("nan"), 0.0])], "query_id long, embedding array<float>")
    want = similarity.top_k(asked.where("query_id = 0"), spark.createDataFrame(good, schema), 2, **form).collect()
    got = similarity.top_k(asked, spark.createDataFrame(good + broken, schema).repartition(1), 2, **form).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(want) == 2


def test_quantised_search_makes_no_row_of_a_candidate(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 8)).astype(np.float32)
    items, asked = vectors(spark, x, "item_id"), vectors(spark, x, "query_id")
    books = approximate.fit_codebooks(items, approximate.fit_cells(items, 2), parts=2, words=4)  # coarse codes: many candidates
    codes = approximate.build_code_index(items, books)
    assert approximate.quantised_candidates(asked, codes, books, 3, 2, Scoring(exclude_self=True)).count() > 400 * 3 * 2 * 5
    monkeypatch.setattr(approximate, "written", None)  # no candidates are written
    found = approximate.quantised_top_k(asked, codes, items, books, 3, 2, Scoring(exclude_self=True))
    want = similarity.top_k(asked, items, 3, Scoring(exclude_self=True))  # both cells are probed
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    assert "BroadcastExchange" in plan_of(found) and plan_of(found).count("FlatMapCoGroupsInArrow") >= 1


def sparse_table(rows, name):
    lists = pa.StructArray.from_arrays([pa.array([list(r) for r in rows], pa.list_(pa.int32())), pa.array([list(r.values()) for r in rows], pa.list_(pa.float64()))], ["slots", "weights"])
    return pa.table({name: np.arange(len(rows)), "embedding": lists})


@pytest.mark.parametrize("own", [False, True])
def test_sparse_vectors_are_scored_by_shared_slots(monkeypatch, own):
    monkeypatch.setattr(similarity, "HEAD_SLOTS", 6)
    rng = np.random.default_rng(8)
    dense = np.where(rng.random((3_000, 60)) < np.linspace(0.6, 0.02, 60), rng.integers(1, 4, (3_000, 60)), 0).astype(float)
    dense[5], dense[700:760] = 0.0, dense[7]  # one without slots, and ties
    dense /= np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-9)
    rows = [{j: row[j] for j in np.flatnonzero(row)} for row in dense]
    block, made = similarity.Vectors.block, []
    monkeypatch.setattr(similarity.Vectors, "block", lambda self, low, high: made.append(high - low) or block(self, low, high))
    best = similarity.Best(similarity.Requests(sparse_table(rows[:40], "query_id"), similarity.Scoring(exclude_self=own)), 4)
    order = rng.permutation(3_000)
    best.offer(sparse_table(rows, "item_id").take(pa.array(order)))
    got = {}
    for r in best.result().to_pylist():
        got.setdefault(r["query_id"], []).append((r["item_id"], r["score"]))
    scores = np.floor(dense[:40] @ dense.T * 1e8 + 0.5) / 1e8
    for i, row in enumerate(scores):
        assert got[i] == [(j, -v) for v, j in sorted((-v, j) for j, v in enumerate(row.tolist()) if not (own and i == j))[:4]]
    # Only the first items, and those for the request that shares no slot, become whole rows of all slots.
    requests = similarity.Requests(sparse_table(rows[7:40], "query_id"), similarity.Scoring())
    made.clear()
    similarity.Best(requests, 4).offer(sparse_table(rows, "item_id"))
    assert sum(made) < 600


def test_the_sparse_embedder_gives_the_vectors_of_the_dense_one(spark):
    from larder.functions.vector import hashed_embedder, sparse_hashed_embedder

    texts = [None, "", "a b", "gin gin rum", "Été İß ΣΑΣ 中文 gin", "x\x1cyy zz\n" * 700, " ".join(f"w{i}" for i in range(3000))]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 200)], "id long, text string")
    both = rows.select(hashed_embedder()("text").alias("dense"), sparse_hashed_embedder()("text").alias("sparse")).collect()
    for r in both:
        assert r.sparse.slots == [i for i, x in enumerate(r.dense) if x] and r.sparse.weights == [x for x in r.dense if x]


def test_words_of_ascii_texts_are_those_of_the_pattern():
    import random
    import re

    import numpy as np
    import pyarrow as pa
    from larder.functions import vector

    draw = random.Random(1)
    plain = [None, "", "a", "AB_1"] + ["".join(draw.choice("aB1_ .,\n\x1c\x00-") for _ in range(draw.randint(0, 30))) for _ in range(1500)] + ["", None]
    for texts in (plain, [None], [""], [], [t for t in plain if t] + ["Été gin"]):
        given = pa.array(["x y", *texts, "zz"], pa.string()).slice(1, len(texts))
        base, got = 0, []
        for rows, spot in vector._word_slots(given, 384):
            got += (spot + base * 384).tolist()
            base += rows
        words = [(i, w) for i, t in enumerate(texts) for w in re.findall(r"\w\w+", (t or "").lower())]
        assert base == len(texts) and got == [i * 384 + vector._slots(384)[w] for i, w in words]


def test_single_precision_tiles_fit_a_cache(monkeypatch):
    """Tiles of any size find the same pairs, by request and then by item, and none is larger than stated."""
    rng = np.random.default_rng(5)

    def table(n, name):
        return pa.table({name: pa.array(range(n)), "embedding": pa.array(rng.normal(size=(n, 8)).tolist(), pa.list_(pa.float64()))})

    asked, items = table(40, "query_id"), table(900, "item_id")
    requests = similarity.Requests(asked, similarity.Scoring())
    block, rows = similarity.Block(items, requests), np.arange(40)
    scores = similarity.round_scores(requests.vectors.raw @ block.x.T)
    bar = np.partition(scores, -12, axis=1)[:, -12]
    want = np.nonzero(scores >= bar[:, None])
    made = []

    class Single(np.ndarray):
        def __matmul__(self, other):
            made.append(len(self) * other.shape[1])
            return np.asarray(self) @ np.asarray(other)

    requests.single = requests.single.view(Single)
    for most in (1, 64, 1000, 1 << 20):
        monkeypatch.setattr(similarity, "CACHED_ENTRIES", most)
        made.clear()
        r, i, score = requests.reaching(rows, block, 0, 900, bar)
        assert r.tolist() == want[0].tolist() and i.tolist() == want[1].tolist() and np.allclose(score, scores[want])
        assert max(made) <= max(most, len(rows)) and sum(made) == scores.size
    nothing = requests.reaching(rows, block, 0, 900, bar + 100)
    assert [len(x) for x in nothing] == [0, 0, 0] and requests.reaching(rows, block, 0, 900, bar - 100) is None
