"""Batch answering: translate, screen, look up, retrieve, assemble, generate.

One DAG over a table of requests. A single similarity pass gives both the
screening value (score of rank 1) and the retrieved items.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from larder import fixed
from larder.functions import text as tx
from larder.operators import cache as ch
from larder.operators import language
from larder.operators.recommend import Embedder, by_text
from larder.session import fresh_path


@dataclass(frozen=True)
class AnswerSettings:
    k: int = fixed.ANSWER_TOP_K
    threshold: float = fixed.GUARDRAIL_THRESHOLD
    temperature: float = fixed.ANSWER_TEMPERATURE
    generate: bool = True
    translate: bool = True
    model: str = "template"
    corpus_version: str = ""  # stated where a cache is given: answers do not outlive their corpus
    language: str | None = None  # generated (not template) answers are translated into it


def passes(max_similarity, threshold: float = fixed.GUARDRAIL_THRESHOLD) -> Column:
    """Does the best match reach the threshold? No index at all lets everything pass."""
    value = F.col(max_similarity) if isinstance(max_similarity, str) else max_similarity
    return F.coalesce(value, F.lit(1.0)) >= threshold


def screened(matches: DataFrame, threshold: float = fixed.GUARDRAIL_THRESHOLD) -> DataFrame:
    """Matches of the requests that pass. The top-k is already partitioned by request: no second pass, no shuffle."""
    best = F.max("score").over(Window.partitionBy("query_id"))
    return matches.withColumn("_best", best).where(passes("_best", threshold)).drop("_best")


def guardrail(
    requests: DataFrame, index: DataFrame | None, threshold: float = fixed.GUARDRAIL_THRESHOLD, **options
) -> DataFrame:
    """``query_id, max_similarity, passed`` for every request."""
    if index is None:
        best = requests.select("query_id", F.lit(1.0).alias("max_similarity"))
    else:
        top = by_text(requests, index, 1, **options).select("query_id", F.col("score").alias("max_similarity"))
        best = requests.select("query_id").join(top, "query_id", "left")
        best = best.withColumn("max_similarity", F.coalesce("max_similarity", F.lit(1.0)))
    return best.withColumn("passed", passes("max_similarity", threshold))


def contexts(matches: DataFrame, columns: dict[str, str] = fixed.CONTEXT_LABELS) -> DataFrame:
    """Context text and retrieved list per request, in rank order: at most ``k`` rows each."""
    item = F.struct("rank", "item_id", "name", "score", tx.context_block(columns).alias("block"))
    grouped = matches.groupBy("query_id").agg(F.array_sort(F.collect_list(item)).alias("_items"))
    return grouped.select(
        "query_id",
        F.array_join(F.col("_items.block"), fixed.CONTEXT_SEPARATOR).alias("context"),
        F.transform(
            "_items", lambda i: F.struct(i["rank"].alias("rank"), i["item_id"].alias("item_id"), i["name"].alias("name"),
                                         i["score"].alias("score"))
        ).alias("retrieved"),
        F.col("_items")[0]["score"].alias("max_similarity"),
    )


def answer_key(text, settings: AnswerSettings) -> Column:
    """Every setting that changes the answer is part of the key."""
    return tx.content_key(
        text, F.lit(settings.k), F.lit(settings.temperature), F.lit(settings.model), F.lit(settings.corpus_version), F.lit(settings.language or "")
    )


def answer(
    requests: DataFrame,
    index: DataFrame | None,
    corpus: DataFrame,
    settings: AnswerSettings = AnswerSettings(),
    *,
    cache: DataFrame | None = None,
    generator: Callable | None = None,
    translator: Callable | None = None,
    embedder: Embedder | None = None,
) -> DataFrame:
    """Answer requests ``(query_id, text)``.

    Result: ``query_id, status, reason, max_similarity, retrieved, generated_recipe,
    cached, original_query, translated_query``. Status is ``empty`` for a blank
    request, ``rejected`` below the threshold, else ``success``. ``generator``
    maps pandas frames ``(key, payload)`` to ``(key, value)`` and sees each distinct
    uncached prompt once; without it, or where it gives null, the template answers.
    """
    if settings.translate:
        asked = language.to_english(requests, "query_id", "text", translator=translator)
    else:
        asked = requests.select("query_id", "text", F.col("text").alias("english"), F.lit(False).alias("was_translated"))
    if cache is not None and not settings.corpus_version:
        raise ValueError("a cache needs settings.corpus_version")
    asked = asked.withColumn("key", answer_key("text", settings))
    live = asked.where(~tx.is_blank("text"))

    if index is None:
        found = live.select("query_id", F.lit("").alias("context"), F.lit(None).cast(_RETRIEVED).alias("retrieved"),
                            F.lit(1.0).alias("max_similarity"))
    else:
        matches = by_text(live, index, settings.k, text="english", embedder=embedder, attach=_answer_columns(corpus))
        found = contexts(matches)
    joined = asked.join(found, "query_id", "left")
    blank = tx.is_blank("text")
    accepted = ~blank & passes("max_similarity", settings.threshold)
    if cache is not None:
        joined = ch.lookup(joined, cache, "key")
    else:
        joined = joined.withColumns({"value": F.lit(None).cast("string"), "cached": F.lit(False)})
    joined = joined.withColumns({"_accepted": accepted, "cached": F.col("cached") & accepted})

    template = tx.template_answer("english", "context")
    if not settings.generate:
        fresh = F.lit(None).cast("string")
    elif generator is None:
        fresh = template
    else:
        joined = _generated(joined, generator)
        if settings.language and translator is not None:
            joined = language.to_language(joined, "_generated", settings.language, translator)
            joined = joined.drop("_generated").withColumnRenamed(f"_generated_{settings.language}", "_generated")
        fresh = F.coalesce(F.col("_generated"), template)
    return joined.select(
        "query_id",
        F.when(blank, "empty").when(F.col("_accepted"), "success").otherwise("rejected").alias("status"),
        F.when(~blank & ~F.col("_accepted"), F.lit(fixed.REJECTION_REASON)).alias("reason"),
        F.when(~blank, F.coalesce("max_similarity", F.lit(1.0))).alias("max_similarity"),
        F.when(F.col("_accepted"), F.col("retrieved")).alias("retrieved"),
        F.when(F.col("cached"), F.col("value")).when(F.col("_accepted"), fresh).alias("generated_recipe"),
        "cached",
        F.col("text").alias("original_query"),
        F.when(F.col("was_translated"), F.col("english")).alias("translated_query"),
        "key",
    )


_RETRIEVED = "array<struct<rank:bigint,item_id:bigint,name:string,score:double>>"


def _answer_columns(corpus: DataFrame) -> DataFrame:
    return corpus.select("item_id", *dict.fromkeys(fixed.CONTEXT_LABELS.values()))


def _generated(joined: DataFrame, generator: Callable) -> DataFrame:
    """Call the generator once per distinct prompt among accepted cache misses."""
    # Written once: the retrieval below is read twice, and a lost executor must not repeat it.
    path = fresh_path(joined.sparkSession, "prompts")
    joined.write.parquet(path)
    joined = joined.sparkSession.read.parquet(path)
    prompt = tx.answer_prompt("context", "english")
    wanted = joined.where(F.col("_accepted") & ~F.col("cached"))
    distinct = wanted.groupBy(F.col("key").alias("_gkey")).agg(F.min(prompt).alias("payload"))
    made = distinct.withColumnRenamed("_gkey", "key").mapInPandas(generator, "key string, value string")
    return joined.join(made.select("key", F.col("value").alias("_generated")), "key", "left")


def new_cache_rows(answers: DataFrame) -> DataFrame:
    """Answers to append to the cache: generated now, one row per key."""
    made = answers.where((F.col("status") == "success") & ~F.col("cached") & F.col("generated_recipe").isNotNull())
    return made.groupBy("key").agg(F.min("generated_recipe").alias("value"))


def answer_through_cache(requests, index, corpus, cache_path: str, settings=AnswerSettings(), **plugins) -> DataFrame:
    """Answer, append new answers to the cache table, and return the answers from a written table."""
    spark = requests.sparkSession
    wanted = requests.select(answer_key("text", settings).alias("key")).distinct()
    cache = ch.stored(spark, cache_path, "string", wanted)
    written = fresh_path(spark, "answers")
    answer(requests, index, corpus, settings, cache=cache, **plugins).write.parquet(written)
    answers = spark.read.parquet(written)
    new_cache_rows(answers).write.mode("append").parquet(cache_path)
    return answers
