import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from larder.llm import token_files


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def encoder():
    return token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=200, deadline=None)
@given(ids=st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=1500))
def test_segment_round_trip_and_random_access(ids):
    segment = token_files.Segment(token_files.pack(np.array(ids, dtype="<u4"), np.array([0, len(ids)])))
    assert segment.ids().tolist() == ids
    for i in range(0, len(ids), 1 + len(ids) // 40):
        assert segment.id_at(i) == ids[i]
    with pytest.raises(IndexError):
        segment.id_at(len(ids))


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=200) | st.text(alphabet=" \t\n\r\x0b\x1c\x85\xa0ab,.'s12é中\0", max_size=80))
def test_pieces_give_the_ids_of_the_whole_text(encoder, tokenizer, text):
    assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_files_against_brute_force(spark, tokenizer):
    rows = [(5, "five and five"), (1, "  one\n\ntwo  "), (None, "no id"), (3, None), (2, ""), (5, "five and five"), (5, "another"), (9, "a word " * 3000), (4, "<|endoftext|> is text")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, start string").repartition(5)
    path = token_files.write_segments(docs, segment_ids=50)
    got = sorted(map(tuple, token_files.read_documents(spark, path).select("start", "doc_id", "n_tokens", "ids_crc32").collect()))
    want = {}
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        want.setdefault(doc_id, []).append((len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
    start = 0
    assert [r[1] for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    for at, doc_id, n, crc in got:
        assert at == start and (n, crc) in want[doc_id]
        want[doc_id].remove((n, crc))
        start += n


def test_empty_table(spark):
    path = token_files.write_segments(spark.createDataFrame([], "doc_id long, text string"))
    assert token_files.read_documents(spark, path).count() == 0


def test_segments_stay_where_they_lie_when_read(spark):
    docs = spark.range(300).selectExpr("id AS doc_id", "concat('text ', id) AS text").repartition(4)
    path = token_files.write_segments(docs, segment_ids=50)
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        read = token_files.open_segments(spark, path)
        assert "SortMergeJoin" not in read._jdf.queryExecution().executedPlan().toString()
        assert sorted(r["first_start"] for r in read.collect())[0] == 0 and token_files.read_documents(spark, path).count() == 300
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
