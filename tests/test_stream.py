"""Streams of requests give the rows of the batch form."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA
from larder.operators import answers
from larder.operators.answers import AnswerSettings
from larder.plans.catalog import QUERIES, SQL
from larder.streaming import requests as rq
from test_answers import corpus, index, toy  # noqa: F401
from test_queries import canonical

SCHEMA = "query_id long, ts timestamp, text string"
SETTINGS = AnswerSettings(translate=False)


def drop(spark, folder, name, rows):
    start = dt.datetime(2024, 1, 1)
    timed = [(i, start + dt.timedelta(minutes=m), text) for i, m, text in rows]
    spark.createDataFrame(timed, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def drain(spark, folder, index, corpus, pattern="*.parquet"):
    stream = rq.request_stream(spark, f"{folder}/in*", SCHEMA, pattern, max_files=1)
    query = rq.answer_stream(
        rq.distinct_requests(stream), index, corpus, f"{folder}/out", f"{folder}/state", SETTINGS, available_now=True, embedder=toy
    )
    query.awaitTermination()
    return rq.read_answers(spark, f"{folder}/out")


def test_stream_equals_batch(spark, folder, index, corpus):  # noqa: F811
    rows = [(0, 0, "gin"), (1, 1, "bike"), (2, 2, "rum"), (3, 3, " ")]
    drop(spark, folder, "in1", rows)
    streamed = drain(spark, folder, index, corpus).drop("batch_id")
    requests = spark.createDataFrame([(i, t) for i, _, t in rows], "query_id long, text string")
    batch = answers.answer(requests, index, corpus, SETTINGS, embedder=toy).select(streamed.columns)
    assert sorted(map(str, streamed.collect())) == sorted(map(str, batch.collect()))


def test_repeats_inside_the_watermark_are_answered_once(spark, folder, index, corpus):  # noqa: F811
    drop(spark, folder, "in1", [(0, 0, "gin"), (1, 1, "gin"), (2, 2, "rum")])
    assert drain(spark, folder, index, corpus).count() == 2
    drop(spark, folder, "in2", [(3, 3, "gin"), (4, 4, "gin martini")])
    second = drain(spark, folder, index, corpus)
    assert sorted(r.original_query for r in second.collect()) == ["gin", "gin martini", "rum"]


def test_a_replayed_batch_leaves_the_same_rows(spark, folder, index, corpus):  # noqa: F811
    drop(spark, folder, "in1", [(0, 0, "gin")])
    first = drain(spark, folder, index, corpus).collect()
    stream = rq.request_stream(spark, f"{folder}/in*", SCHEMA, "*.parquet")
    query = rq.answer_stream(stream, index, corpus, f"{folder}/out", f"{folder}/other-state", SETTINGS, available_now=True, embedder=toy)
    query.awaitTermination()  # a lost checkpoint replays batch 0
    again = rq.read_answers(spark, f"{folder}/out")
    assert sorted(map(str, again.collect())) == sorted(map(str, first))
    assert again.where(F.col("batch_id") == 0).count() == 1


def test_one_batch_and_many_give_equal_rows(spark, folder, index, corpus):  # noqa: F811
    rows = [(0, 0, "gin"), (1, 30, "gin"), (2, 540, "gin"), (3, 1500, "gin"), (4, 1501, "rum")]  # the next day begins at 1440
    drop(spark, f"{folder}/one", "in1", rows)
    for i, row in enumerate(rows):
        drop(spark, f"{folder}/many", f"in{i}", [row])
    found = [sorted((r.original_query, r.status) for r in drain(spark, f"{folder}/{way}", index, corpus).collect()) for way in ("one", "many")]
    assert found[0] == found[1] == [("gin", "success"), ("gin", "success"), ("rum", "success")]


@pytest.mark.parametrize("available", [True])
def test_stream_reads_only_matching_files(spark, folder, index, corpus, available):  # noqa: F811
    drop(spark, folder, "in1", [(0, 0, "gin")])
    assert drain(spark, folder, index, corpus, "part-*.parquet").count() == 1


def test_requests_up_to_the_delay_late_are_answered(spark, folder, index, corpus):  # noqa: F811
    rows = [(0, 1441, "gin"), (1, 1439, "rum"), (2, 10, "gin"), (3, 1445, "gin"), (4, 1438, "rum"), (5, 1499, "gin martini")]  # the next day begins at 1440
    for i, row in enumerate(rows):
        drop(spark, folder, f"in{i}", [row])
    found = sorted(r.original_query for r in drain(spark, folder, index, corpus).collect())
    assert found == ["gin", "gin", "gin martini", "rum"]


def test_registered_stream_takes_many_shuffled_files(spark, folder):
    import duckdb

    given = TESTDATA / "sf0.001"
    for file in given.glob("*.parquet"):
        if file.stem != "events":
            Path(folder, file.name).symlink_to(file)
    spark.read.parquet(f"{given}/events.parquet").repartition(12, "event_id").write.parquet(f"{folder}/events.parquet")
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # a split for each file
    try:
        got = QUERIES["stm01_answer_stream"](spark, folder).toPandas()
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    connection = duckdb.connect()
    for file in given.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    assert canonical(got) == canonical(connection.execute(SQL["stm01_answer_stream"]).df())


def replies(spark, folder, index, corpus):
    stream = rq.request_stream(spark, f"{folder}/in*", SCHEMA, "*.parquet", max_files=1)
    query = rq.reply_stream(rq.marked_requests(stream), index, corpus, f"{folder}/out", f"{folder}/state", SETTINGS, available_now=True, embedder=toy)
    query.awaitTermination()
    return {r.query_id: r for r in rq.read_replies(spark, f"{folder}/out").collect()}


def test_repeats_are_answered_from_the_first(spark, folder, index, corpus):  # noqa: F811
    rows = [(0, 0, "gin"), (1, 30, "gin"), (2, 540, "gin"), (3, 1500, "gin"), (4, 1501, "rum"), (5, 1502, None)]  # the next day begins at 1440
    drop(spark, f"{folder}/one", "in1", rows)
    for i, part in enumerate((rows[:1], rows[1:3], rows[3:])):
        drop(spark, f"{folder}/many", f"in{i}", part)
    one, many = (replies(spark, f"{folder}/{way}", index, corpus) for way in ("one", "many"))
    for got in (one, many):
        assert {i: r.cached for i, r in got.items()} == {0: False, 1: True, 2: True, 3: False, 4: False, 5: False}
        assert got[0].retrieved == got[1].retrieved == got[2].retrieved and got[1].original_query == "gin"
        assert got[5].status == "empty"
    assert {i: (r.status, r.max_similarity) for i, r in one.items()} == {i: (r.status, r.max_similarity) for i, r in many.items()}
    assert many[2].batch_id == many[1].batch_id > many[0].batch_id


def test_a_text_of_many_windows_is_searched_once(spark, folder, index, corpus, monkeypatch):  # noqa: F811
    asked = []

    def counted(requests, *given, **options):
        asked.append(sorted(r.text for r in requests.collect()))
        return answers.answer(requests, *given, **options)

    monkeypatch.setattr(rq, "answer", counted)
    days = [(i, 1440 * (i // 2) + i % 2, ("gin", "rum")[i // 2 % 2]) for i in range(8)]  # one of the two on each of four days, twice
    drop(spark, folder, "in1", [*days, (8, 5, "rum")])
    got = replies(spark, folder, index, corpus)
    assert asked == [["gin", "rum"]]
    assert [got[i].cached for i in range(9)] == [False, True] * 4 + [False]
    assert [[r.name for r in got[i].retrieved] for i in range(4)] == [["Gimlet", "Martini", "Daiquiri"]] * 2 + [["Daiquiri", "Gimlet", "Martini"]] * 2


def test_the_stream_index_holds_only_slots_in_use(spark):
    from larder.functions.vector import sparse_hashed_embedder
    from larder.plans.registry import Tables
    from larder.plans.streams import _item_index
    from larder.operators import recommend

    stored, items = _item_index(Tables(spark, str(TESTDATA / "sf0.001")), sparse_hashed_embedder())
    dense = recommend.build_index(items, keep=[])
    assert stored.where(F.size("embedding.slots") > 100).isEmpty()
    pairs = [(0, "cocktail avec large ring"), (1, "zzzz"), (2, "x"), (3, "5-LOW und 7ml blue gear"), (4, "ÉTÉ gear İ")]
    requests = spark.createDataFrame(pairs, "query_id long, text string")
    sparse = recommend.by_text(requests, stored, 7, embedder=sparse_hashed_embedder()).orderBy("query_id", "rank")
    assert sparse.collect() == recommend.by_text(requests, dense, 7).select(sparse.columns).orderBy("query_id", "rank").collect()
