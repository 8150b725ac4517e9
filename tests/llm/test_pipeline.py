import random

import corpus_pipeline
from pyspark.sql import functions as F

from larder.llm import decontamination


def _docs(spark):
    r = random.Random(3)
    vocabulary = [f"word{i}" for i in range(5000)]
    make = lambda n: " ".join(r.choices(vocabulary, k=n))
    rows = [(i, make(r.randrange(30, 200)), "en", f"s{i % 3}") for i in range(120)]
    near = rows[5][1].split(" ")
    near[7] = "changed"
    leak = "Which of these many words is the answer to this question of all"
    rows += [(200, rows[3][1], "en", "s0"), (201, " ".join(near) + " more", "en", "s1"), (202, f"{make(40)} {leak} {make(40)}", "en", "s2"), (203, "too short", "en", "s0"), (204, "again and again and again and " * 30, None, None), (205, None, "en", None), (206, make(60), None, None)]
    return spark.createDataFrame([(*x, len(x[1] or ""), "extra") for x in rows], "doc_id long, text string, lang string, source string, n_chars long, size string"), leak


def test_each_stage_takes_effect(spark, folder):
    docs, leak = _docs(spark)
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs.write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids, seen = lambda d: sorted(r["doc_id"] for r in d.select("doc_id").collect()), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "token_files":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
            out.write.parquet(f"{folder}/{name}")
            out = spark.read.parquet(f"{folder}/{name}")
        seen[name], docs = out, out
    everyone = set(range(120)) | {206}
    assert set(ids(seen["quality"])) == everyone | {200, 201, 202}
    assert set(ids(seen["near_duplicates"])) == everyone | {202}
    assert set(ids(seen["decontamination"])) == everyone
    mixed = seen["mixing"].collect()
    whole = {r["doc_id"]: r["text"] for r in seen["decontamination"].collect()}
    assert all(r["n_chars"] == len(r["text"]) and set(r["text"].split()) <= set(whole[r["doc_id"]].split()) for r in mixed)
    assert 0.9 < sum(len(r["text"].split()) for r in mixed) / (1.5 * sum(len(t.split()) for t in whole.values())) < 1.1
    assert ids(seen["token_files"]) == sorted(r["doc_id"] for r in mixed)
    again = sorted(map(tuple, corpus_pipeline.run(spark, folder).collect()))
    assert again == sorted(map(tuple, seen["token_files"].collect()))


def test_empty_documents(spark, folder):
    docs, _ = _docs(spark)
    docs.limit(0).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_without_hits_keeps_rows(spark):
    docs, leak = _docs(spark)
    items = spark.createDataFrame([(1, leak)], "item_id long, text string")
    assert decontamination.without_hits(docs, items).count() == docs.count() - 1


CLASHING = ["_id", "_hash", "id", "hash", "row", "target", "taken", "passes", "picked", "source_size", "_pass", "band", "node"]


def test_columns_with_the_names_of_the_operators_keep_their_values(spark, folder):
    docs, leak = _docs(spark)
    for c in CLASHING:
        docs = docs.withColumn(c, F.concat(F.lit(f"mine-{c}-"), F.col("doc_id").cast("string")))
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs.write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, folder).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        rows = docs.collect()
        assert len(rows) > 100 and all(r[c] == f"mine-{c}-{r['doc_id']}" for r in rows for c in CLASHING)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == docs.count()
