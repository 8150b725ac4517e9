from pyspark.sql import functions as F

from larder.llm import language_id
from larder.llm.common import id_bucket

ROOT = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    model = language_id.fit(docs.where(id_bucket("doc_id", 4) != 2))
    held = docs.where(id_bucket("doc_id", 4) == 2)
    labels = {r["doc_id"]: r["lang"] for r in held.collect()}
    got = language_id.predict(held, model).collect()
    assert len(got) == len(labels)
    assert sum(r["lang_pred"] == labels[r["doc_id"]] for r in got) >= 0.97 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_edges(spark):
    rows = [(1, "the house and the garden", "en"), (2, "das Haus und der Garten", "de"), (3, None, "en"), (4, "", "de"), (5, "123 ...", "en"), (6, "unlabelled", None), (7, "the " * 60000, "en"), (1, "the house and the garden", "en")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, score string")
    model = language_id.fit(docs)
    got = {r["doc_id"]: r for r in language_id.predict(docs, model).collect()}
    assert [got[i]["lang_pred"] for i in range(1, 8)][:5] == ["en", "de", "und", "und", "und"] and got[7]["lang_pred"] == "en"
    assert got[6]["lang_pred"] in ("en", "de")
    assert language_id.predict(docs, model).count() == len(rows)
    nothing = language_id.fit(docs.where(F.lit(False)))
    assert {r["lang_pred"] for r in language_id.predict(docs, nothing).collect()} == {"und"}
    assert language_id.predict(docs.where(F.lit(False)), model).count() == 0


def test_pieces_of_a_long_text_count_alike(monkeypatch):
    text = "Ein längerer Text, der in Stücken gezählt wird. " * 50
    whole = language_id.slot_counts(text)
    monkeypatch.setattr(language_id, "_PIECE", 37)
    assert (whole == language_id.slot_counts(text)).all()
