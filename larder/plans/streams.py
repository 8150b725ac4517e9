"""Streaming queries, drained and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder import fixed
from larder.functions import text as tx
from larder.functions.vector import sparse_hashed_embedder
from larder.operators import recommend
from larder.plans import views as v
from larder.plans.registry import Tables, query
from larder.plans.retrieval import translated_sql
from larder.session import fresh_path
from larder.sources.writers import save_table
from larder.streaming import requests as rq

EVENT_SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"

# A text is answered once on each day it is asked.
STREAM_SQL = f"""WITH daily AS (SELECT DISTINCT '{fixed.INGREDIENT_REQUEST_PREFIX}' || p_name AS text, CAST(ts AS DATE) AS day
        FROM events JOIN part ON p_partkey = CAST(json_extract_string(props, '$.k') AS BIGINT)),
    asked AS (SELECT text, row_number() OVER (ORDER BY text) AS id FROM (SELECT DISTINCT text FROM daily)),
    {translated_sql('SELECT id, text FROM asked')}, {v.ITEMS}, {v.bow('words', 'SELECT id, english AS text FROM english')},
    {v.bow('indexed', 'SELECT item_id AS id, text_full AS text FROM items')},
    {v.scored('scores', 'words', 'indexed', 'SELECT id FROM english', 'SELECT item_id AS id FROM items')}, {v.ranked('top', 'scores', 3)},
    answered AS (SELECT query_id, max(score) AS best, string_agg(item_id, ',' ORDER BY rank) AS found FROM top GROUP BY query_id)
    SELECT text AS original_query, CASE WHEN best >= 0.4 THEN 'success' ELSE 'rejected' END AS status, best AS max_similarity,
           CASE WHEN best >= 0.4 THEN found END AS retrieved, CASE WHEN was_translated THEN english END AS translated_query
    FROM english JOIN answered ON query_id = id JOIN daily USING (text)"""


REPLIES_SQL = STREAM_SQL.replace("SELECT DISTINCT", "SELECT event_id, ts,", 1).replace(
    "SELECT text AS original_query,", """SELECT event_id AS query_id, text AS original_query,
           row_number() OVER (PARTITION BY text, day ORDER BY ts, event_id) > 1 AS cached,"""
)


def _by_slices(t: Tables, run) -> None:
    """Events, as four slices in order of time, as a request stream for the part they name: ``run(requests)`` takes each slice."""
    folder = fresh_path(t.spark, "event-files")
    low, high = t.events.agg(F.min(F.unix_timestamp("ts")), F.max(F.unix_timestamp("ts"))).first()
    part_of = F.floor((F.unix_timestamp("ts") - (low or 0)) * 4 / ((high or 0) - (low or 0) + 1))
    named = t.part.select(F.col("p_partkey").alias("k"), F.array("p_name").alias("names"))
    for n in range(4):  # a slice is one batch, however many files it has, and the next one goes on from its state
        t.events.where(part_of == n).write.mode("append").parquet(folder)
        stream = rq.request_stream(t.spark, folder, EVENT_SCHEMA)
        asked = stream.withColumn("k", F.from_json("props", "k long")["k"]).join(named, "k")
        run(asked.select(F.col("event_id").alias("query_id"), "ts", tx.ingredient_request("names").alias("text"))).awaitTermination()


def _item_index(t: Tables, embedder):
    items = save_table(v.items(t), fresh_path(t.spark, "items"))
    return save_table(recommend.build_index(items, embedder=embedder, keep=[]), fresh_path(t.spark, "index")), items


def _result(replies, *more: str):
    ids = F.array_join(F.transform("retrieved", lambda i: i["item_id"].cast("string")), ",")
    return replies.select(*more, "original_query", "status", "max_similarity", ids.alias("retrieved"), "translated_query")


@query("stm01_answer_stream", STREAM_SQL)
def _(t: Tables):
    """A request is answered once a day."""
    embedder = sparse_hashed_embedder()  # every batch reads the whole index: it holds the slots in use
    index, items = _item_index(t, embedder)
    out, state = fresh_path(t.spark, "answers"), fresh_path(t.spark, "stream-state")
    _by_slices(t, lambda asked: rq.answer_stream(rq.distinct_requests(asked), index, items, out, state, available_now=True, embedder=embedder))
    return _result(rq.read_answers(t.spark, out))


@query("stm01_reply_stream", REPLIES_SQL)
def _(t: Tables):
    """Every request gets a reply; a text's repeats within a day get the answer of the first, marked as cached."""
    embedder = sparse_hashed_embedder()  # every batch reads the whole index: it holds the slots in use
    index, items = _item_index(t, embedder)
    out, state = fresh_path(t.spark, "replies"), fresh_path(t.spark, "stream-state")
    _by_slices(t, lambda asked: rq.reply_stream(rq.marked_requests(asked), index, items, out, state, available_now=True, embedder=embedder))
    return _result(rq.read_replies(t.spark, out), "query_id", "cached")
