import pytest
from pyspark.sql import functions as F

from larder.llm import mixing


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, size long, target string")


def _brute_targets(sizes, ratio=1.5, most=2):
    """Water filling by hand: sizes in order take 5, 2, 1; what is above a cap is shared again."""
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda x: (x is None, x or "")))}
    caps = {s: most * n for s, n in sizes.items()}
    asked, done = min(ratio * sum(sizes.values()), sum(caps.values())), {}
    while True:
        open_ = [s for s in sizes if s not in done and sizes[s]]
        left = asked - sum(done.values())
        share = {s: left * weights[s] / sum(weights[o] for o in open_) for s in open_}
        above = [s for s in open_ if share[s] > caps[s]]
        if not above:
            return {s: done.get(s, share.get(s, 0.0)) for s in sizes}
        done.update({s: caps[s] for s in above})


def _highest_quotients(weights, seats):
    got = dict.fromkeys(weights, 0)
    for _ in range(seats):
        best = min(weights, key=lambda k: (-weights[k] / (2 * got[k] + 1), k))
        got[best] += 1
    return got


def test_seats_are_those_of_the_highest_quotients(spark):
    for weights, seats in (({"a": 53.0, "b": 24.0, "c": 23.0}, 7), ({"a": 1.0, "b": 1.0, "c": 1.0}, 2), ({"a": 1000.0, "b": 1.0, "c": 1.0, "d": 1.0}, 999), ({f"p{i}": 0.5 + i % 3 for i in range(40)}, 57), ({"a": 5.0}, 0)):
        table = spark.createDataFrame([(k, w, seats) for k, w in weights.items()], "part string, w double, seats long")
        got = {r["part"]: r["n"] for r in mixing.apportioned(table, [], "w", "seats", ["part"], "n").collect()}
        assert got == _highest_quotients(weights, seats)


def test_mix_meets_targets_and_repeats(spark):
    rows = [(i, ("hot" if i % 3 else f"s{i % 4}") if i % 7 else None, (i * 37) % 900 if i % 11 else None, "x") for i in range(600)]
    docs = _docs(spark, rows)
    got = mixing.mix(docs, (5.0, 2.0, 1.0)).select("doc_id", "source", "size", "source_size", mixing.F.col("target").alias("t"), "taken").collect()
    sizes = {}
    for _, source, size, _ in rows:
        sizes[source] = sizes.get(source, 0) + (size or 0)
    targets, taken = _brute_targets(sizes), {}
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r["taken"] <= 2 * (r["size"] or 0)
        assert r["source_size"] == sizes[r["source"]] and r["t"] == pytest.approx(targets[r["source"]])
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for source, target in targets.items():
        assert abs(taken[source] - target) <= max(2 * mixing.BLOCK, 0.01 * target)
    again = mixing.mix(docs.repartition(7, F.rand()), (5.0, 2.0, 1.0))
    assert sorted((r["doc_id"], r["taken"]) for r in again.collect()) == sorted((r["doc_id"], r["taken"]) for r in got)


def test_mix_of_edge_tables(spark):
    assert mixing.mix(_docs(spark, []), (5.0,)).count() == 0
    only_empty = mixing.mix(_docs(spark, [(1, "a", 0, "x"), (1, "a", 0, "x"), (None, None, None, "x")]), (5.0, 2.0)).collect()
    assert [(r["taken"], r["target"]) for r in only_empty] == [(0, 0.0)] * 3


def test_stated_weights(spark):
    docs = _docs(spark, [(i, "ab"[i % 2], 100, "x") for i in range(200)])
    weights = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "source string, weight double")
    got = {r["source"]: r["n"] for r in mixing.mix(docs, weights, ratio=0.5).groupBy("source").agg(F.sum("taken").alias("n")).collect()}
    assert abs(got["a"] - 2500) <= 32 and abs(got["b"] - 7500) <= 32


def test_mixed_texts_are_the_picked_blocks(spark):
    text = " ".join(f"w{i}" for i in range(100))
    rows = [(i, "a" if i % 2 else "b", 100, text) for i in range(20)] + [(99, "a", 0, "")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long, text string")
    mixed = mixing.mix(docs, (3.0, 1.0))
    want = {(r["doc_id"]): r["taken"] for r in mixed.collect()}
    got = {}
    for r in mixing.mixed_texts(mixed).collect():
        tokens = r["text"].split()
        assert set(tokens) <= set(text.split()) and tokens == sorted(tokens, key=lambda w: int(w[1:]))
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(tokens)
    assert got == {k: v for k, v in want.items() if v}
