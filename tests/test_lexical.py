"""TF-IDF against a plain computation of the formula."""

import math
import re
from collections import Counter

import pytest

from larder.operators import lexical

DOCS = {
    0: "Blue gin, blue lime", 1: "Gin and tonic and gin", 2: "été rhum été", 3: "", 4: "x y z", 5: "Blue lime gin tonic",
    6: "blue gin blue lime",
}


def terms(text):
    words = re.findall(r"\w\w+", text.lower())
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def model(docs, features):
    totals, seen = Counter(), Counter()
    for text in docs.values():
        totals.update(terms(text))
        seen.update(set(terms(text)))
    kept = sorted(totals, key=lambda t: (-totals[t], t))[:features]
    return {t: math.log((1 + len(docs)) / (1 + seen[t])) + 1 for t in kept}


def vector(text, idf):
    raw = {t: n * idf[t] for t, n in Counter(terms(text)).items() if t in idf}
    length = math.sqrt(sum(w * w for w in raw.values()))
    return {t: w / length for t, w in raw.items()} if length else {}


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(list(DOCS.items()), "item_id long, text_full string")


@pytest.mark.parametrize("features", [6, 5000])
def test_vocabulary_and_vectors(items, features):
    index = lexical.fit(items, max_features=features)
    idf = model(DOCS, features)
    slots = {r.slot: r.term for r in index.vocabulary.collect()}
    assert {r.term: r.idf for r in index.vocabulary.collect()} == pytest.approx(idf)
    got = {r.item_id: dict(zip((slots[s] for s in r.embedding.slots), r.embedding.weights)) for r in index.item_vectors().collect()}
    assert set(got) == set(DOCS)  # texts without known terms keep an empty vector
    for key, text in DOCS.items():
        assert got[key] == pytest.approx(vector(text, idf))


@pytest.mark.parametrize("form", [{}, {"max_rows": 0}])
def test_top_k(spark, items, form):
    asked = {0: "gin tonic", 1: "nothing known", 2: "", 3: "Été"}
    requests = spark.createDataFrame(list(asked.items()), "query_id long, text string")
    index = lexical.fit(items)
    idf = model(DOCS, 5000)
    got = lexical.by_text(requests, index, 3, **form).orderBy("query_id", "rank").collect()
    for key, text in asked.items():
        q = vector(text, idf)
        scores = {i: round(sum(w * vector(d, idf).get(t, 0) for t, w in q.items()), 8) for i, d in DOCS.items()}
        best = sorted(scores, key=lambda i: (-scores[i], i))[:3]
        mine = [r for r in got if r.query_id == key]
        assert [r.item_id for r in mine] == best
        assert [r.score for r in mine] == pytest.approx([scores[i] for i in best], abs=1e-7)


def test_pieces_and_empty_tables(spark, items, monkeypatch):
    monkeypatch.setattr(lexical, "PIECE_WORDS", 3)  # texts are cut into several pieces
    import pyarrow as pa

    batch = pa.record_batch({"i": [0, 1, 2, 3], "w": pa.array([["a", "b", "c", "d", "e"], [], None, ["f", "g"]], pa.list_(pa.string()))})
    assert [p.column(0).to_pylist() for p in lexical._pieces(batch)] == [[0], [1, 2, 3]]
    empty = spark.createDataFrame([], "item_id long, text_full string")
    index = lexical.fit(empty)
    assert index.item_vectors().count() == 0 and index.vocabulary.count() == 0
    assert lexical.by_text(spark.createDataFrame([(1, "gin")], "query_id long, text string"), index, 3).count() == 0


def test_texts_are_not_shuffled(spark, items):
    index = lexical.fit(items)
    plan = index.vectors(items, "text_full", "item_id")._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "MapInArrow" in plan
