"""Evaluation of retrieval, screening and generated text."""

from __future__ import annotations

from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from larder import fixed
from larder.functions import text as tx
from larder.functions.stem import stem_words


@dataclass(frozen=True)
class EvalConfig:
    k_values: list[int] = field(default_factory=lambda: list(fixed.K_VALUES))
    n_queries: int | None = None  # all
    out_of_domain_queries: list[str] = field(default_factory=lambda: list(fixed.OUT_OF_DOMAIN_REQUESTS))


def discount(rank) -> Column:
    """Gain of a hit at a 1-based rank."""
    return 1.0 / F.log2((F.col(rank) if isinstance(rank, str) else rank) + F.lit(1.0))


def ideal_gain(hits: Column, k: int) -> Column:
    """Gain of ``hits`` relevant items in the first places, at most ``k``."""
    places = F.sequence(F.lit(1), F.lit(k))
    inside = F.filter(places, lambda i: i <= hits)
    return F.aggregate(inside, F.lit(0.0), lambda total, i: total + 1.0 / F.log2(i + F.lit(1.0)))


def query_metrics(relevant: DataFrame, retrieved: DataFrame, k_values: list[int]) -> DataFrame:
    """``query_id, k, precision, recall, ndcg`` for every query with relevant items.

    ``relevant`` is ``(query_id, name)``, ``retrieved`` is ``(query_id, rank, name)``.
    """
    wanted = relevant.distinct()
    hits = retrieved.join(wanted, ["query_id", "name"], "left_semi")
    return hit_metrics(hits, wanted.groupBy("query_id").agg(F.count("*").alias("size")), k_values)


def hit_metrics(hits: DataFrame, sizes: DataFrame, k_values: list[int]) -> DataFrame:
    """Metrics from the retrieved rows that are relevant and the number of relevant items.

    For relevance given by a rule, such as an equal label, where listing the
    relevant items of every query would list all pairs within a label. A name
    retrieved twice counts once for precision and recall, each time for the gain.
    """
    per_name = hits.groupBy("query_id", "name").agg(
        F.min("rank").alias("first"),
        *[F.sum(F.when(F.col("rank") <= k, discount("rank"))).alias(f"gain_{k}") for k in k_values],
    )
    per_query = per_name.groupBy("query_id").agg(
        *[F.count_if(F.col("first") <= k).alias(f"hits_{k}") for k in k_values],
        *[F.sum(f"gain_{k}").alias(f"gain_{k}") for k in k_values],
    )
    joined = sizes.where("size > 0").join(per_query, "query_id", "left")
    rows = []
    for k in k_values:
        found = F.coalesce(f"hits_{k}", F.lit(0))
        gain = F.coalesce(f"gain_{k}", F.lit(0.0))
        rows.append(
            F.struct(
                F.lit(k).cast("long").alias("k"),
                (found / F.lit(k)).alias("precision"),
                (found / F.greatest("size", F.lit(1))).alias("recall"),
                (gain / ideal_gain(F.col("size"), k)).alias("ndcg"),
            )
        )
    return joined.select("query_id", F.inline(F.array(*rows)))


def macro_mean(metrics: DataFrame) -> DataFrame:
    """Mean of each metric per k: ``k, precision, recall, ndcg, n_queries``."""
    return metrics.groupBy("k").agg(
        *[F.avg(m).alias(m) for m in ("precision", "recall", "ndcg")], F.count("*").alias("n_queries")
    )


def long_metrics(means: DataFrame) -> DataFrame:
    """``metric, k, value`` rows."""
    return means.unpivot(["k"], ["precision", "recall", "ndcg"], "metric", "value").select("metric", "k", "value")


def full_report(means: DataFrame, generation: DataFrame, counts: DataFrame) -> DataFrame:
    """``metric, k, value`` of retrieval means per k, mean text scores and counts; k is null where it has no meaning."""
    text = generation.select(F.col("mean_bleu4").alias("bleu4"), F.col("mean_rouge_l").alias("rouge_l"), F.col("pairs").cast("double").alias("n_pairs"))
    sizes = counts.select(*[F.col(c).cast("double").alias(c) for c in ("n_queries", "n_evaluated")])
    rows = [F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.lit(None).cast("long").alias("k"), F.col(c).alias("value")) for c in part.columns])).alias("r") for part in (text, sizes)]
    return long_metrics(means).unionByName(text.select(rows[0]).select("r.*")).unionByName(sizes.select(rows[1]).select("r.*"))


def first_queries(queries: DataFrame, relevant: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` queries by id that have relevant items."""
    usable = (queries if n is None else queries.orderBy("query_id").limit(n))
    return usable.join(relevant.select("query_id").distinct(), "query_id", "left_semi")


def evaluate_recommender(queries: DataFrame, relevant: DataFrame, recommend, config: EvalConfig = EvalConfig()) -> DataFrame:
    """Retrieve once at the largest k, then score every k. ``recommend(queries, k)`` gives ``query_id, rank, name``."""
    used = first_queries(queries, relevant, config.n_queries)
    retrieved = recommend(used, max(config.k_values)).select("query_id", "rank", "name")
    judged = relevant.join(used.select("query_id"), "query_id", "left_semi")
    return long_metrics(macro_mean(query_metrics(judged, retrieved, config.k_values)))


def query_counts(queries: DataFrame, relevant: DataFrame, n: int | None = None) -> DataFrame:
    """How many queries were asked for, and how many of them could be judged."""
    used = queries if n is None else queries.orderBy("query_id").limit(n)
    known = relevant.select("query_id", F.lit(1).alias("_judged")).distinct()
    return used.join(known, "query_id", "left").agg(F.count("*").alias("n_queries"), F.count("_judged").alias("n_evaluated"))


def labelled_requests(spark, config: EvalConfig = EvalConfig(), in_domain: list[str] = fixed.IN_DOMAIN_REQUESTS) -> DataFrame:
    """The fixed screening requests with their label."""
    rows = [(text, False) for text in config.out_of_domain_queries] + [(text, True) for text in in_domain]
    return spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "query_id long, text string, in_domain boolean")


def evaluate_guardrail(labelled: DataFrame, screen) -> DataFrame:
    """Screening report; ``screen(requests)`` gives ``query_id, passed``."""
    verdict = screen(labelled.select("query_id", "text")).select("query_id", "passed")
    return screening_report(confusion(labelled.join(verdict, "query_id")))


def confusion(labelled: DataFrame, expected: str = "in_domain", passed: str = "passed", by: list[str] | None = None) -> DataFrame:
    """tp, fp, tn, fn of a screening; positive means an in-domain request was accepted."""
    e, p = F.col(expected), F.col(passed)
    counts = [
        F.count_if(e & p).alias("tp"), F.count_if(~e & p).alias("fp"),
        F.count_if(~e & ~p).alias("tn"), F.count_if(e & ~p).alias("fn"),
    ]
    return (labelled.groupBy(*by) if by else labelled.groupBy()).agg(*counts)


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / F.when(b > 0, b)).otherwise(F.lit(0.0))


def screening_report(counts: DataFrame, digits: int = 3) -> DataFrame:
    """Precision, recall, F1 and off-domain rejection rate of confusion counts."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    values = {
        "precision": precision,
        "recall": recall,
        "f1": _ratio(2 * precision * recall, precision + recall),
        "rejection_rate_ood": _ratio(tn, tn + fp),
    }
    return counts.withColumns({name: F.round(value, digits) for name, value in values.items()})


def threshold_sweep(labelled: DataFrame, thresholds: list[float], score: str = "max_similarity", expected="in_domain") -> DataFrame:
    """Screening report per threshold, from one table of best scores."""
    listed = F.explode(F.array(*[F.lit(float(t)) for t in thresholds])).alias("threshold")
    cells = labelled.select(expected, score, listed).withColumn("passed", F.col(score) >= F.col("threshold"))
    return screening_report(confusion(cells, expected, "passed", ["threshold"]), 6)


def best_threshold(sweep: DataFrame) -> DataFrame:
    """Largest F1; ties go to the smallest threshold."""
    order = F.struct(F.col("f1"), -F.col("threshold"))
    return sweep.agg(F.max_by("threshold", order).alias("threshold"), F.max("f1").alias("f1"))


def relative_gain(metrics: DataFrame, baseline: str) -> DataFrame:
    """Gain in percent of every other config over a baseline: ``config, metric, k, value, base, gain``."""
    base = metrics.where(F.col("config") == baseline).select("metric", "k", F.col("value").alias("base"))
    others = metrics.where(F.col("config") != baseline).join(base, ["metric", "k"])
    gain = (F.col("value") - F.col("base")) / F.greatest("base", F.lit(fixed.GAIN_FLOOR)) * 100
    return others.withColumn("gain", gain).select("config", "metric", "k", "value", "base", "gain")


def summary_report(metrics: DataFrame, k_values: list[int]) -> DataFrame:
    """One row per metric, one column per k."""
    wide = metrics.groupBy("metric").pivot("k", k_values).agg(F.first("value"))
    return wide.select("metric", *[F.col(str(k)).alias(f"at_{k}") for k in k_values])


# --- generated text ----------------------------------------------------------

def _ngrams(tokens: Column, n: int, generated: int, reference: int) -> Column:
    """The n-grams of a token list as structs that count for one of the two sides."""
    starts = F.when(F.size(tokens) >= n, F.sequence(F.lit(1), F.greatest(F.size(tokens) - n + 1, F.lit(1))))

    def gram(start: Column) -> Column:
        return F.struct(
            F.lit(n).alias("n"), F.xxhash64(F.array_join(F.slice(tokens, start, n), " ")).alias("gram"),
            F.lit(generated).alias("g"), F.lit(reference).alias("r"),
        )

    return F.transform(F.coalesce(starts, F.array().cast("array<int>")), gram)


def bleu(pairs: DataFrame, key: str = "pair_id", generated: str = "generated", reference: str = "reference",
         order: int = fixed.BLEU_ORDER) -> DataFrame:
    """Smoothed sentence BLEU per pair: ``key, bleu4``.

    n-grams of both sides are counted per (pair, n, hash of the gram) with map-side partial
    sums, so one very long pair spreads over all tasks.
    """
    sized = pairs.select(
        key, tx.whitespace_tokens(generated).alias("_g"), tx.whitespace_tokens(reference).alias("_r")
    )
    sides = [_ngrams(F.col("_g"), n, 1, 0) for n in range(1, order + 1)]
    sides += [_ngrams(F.col("_r"), n, 0, 1) for n in range(1, order + 1)]
    # A pair without a single word keeps one null row, and so its score of 0.
    counted = sized.select(key, F.explode_outer(F.concat(*sides)).alias("e")).select(key, "e.*")
    per_gram = counted.groupBy(key, "n", "gram").agg(F.sum("g").alias("g"), F.sum("r").alias("r"))
    clipped = per_gram.groupBy(key).agg(
        *[F.sum(F.when(F.col("n") == n, F.least("g", "r")).otherwise(0)).alias(f"m{n}") for n in range(1, order + 1)],
        *[F.sum(F.when(F.col("n") == n, F.col("g")).otherwise(0)).alias(f"t{n}") for n in range(1, order + 1)],
        F.sum(F.when(F.col("n") == 1, F.col("r")).otherwise(0)).alias("ref_words"),
    )
    logs = F.lit(0.0)
    for n in range(1, order + 1):
        # A higher order without a match counts a small fixed amount instead of 0.
        matched = F.greatest(F.col(f"m{n}").cast("double"), F.lit(fixed.BLEU_EPSILON))
        logs = logs + F.log(matched / F.greatest(F.col(f"t{n}"), F.lit(1))) / order
    length, ref = F.col("t1"), F.col("ref_words")
    penalty = F.when(length > ref, F.lit(1.0)).otherwise(F.exp(1 - ref / F.greatest(length, F.lit(1))))
    score = F.when((F.col("m1") > 0) & (length > 0), penalty * F.exp(logs)).otherwise(F.lit(0.0))
    return clipped.select(key, score.alias("bleu4"))


def _common_subsequence(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, one bit per word of ``a``."""
    where: dict[str, int] = {}
    for i, word in enumerate(a):
        where[word] = where.get(word, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for word in b:
        match = row & where.get(word, 0)
        row = ((row + match) | (row - match)) & full
    return len(a) - row.bit_count()


@F.arrow_udf(T.LongType())
def common_subsequence(a: pa.Array, b: pa.Array) -> pa.Array:
    """Whole token lists in, length out. The recurrence runs over both lists and has no built-in; only one pair's words are strings at a time."""
    return pa.array([_common_subsequence(x.as_py(), y.as_py()) for x, y in zip(a, b)], pa.int64())


def rouge_tokens(c) -> Column:
    """Lower-case runs of a-z and 0-9."""
    return F.regexp_extract_all(F.lower(tx.text_or_blank(c)), F.lit("([a-z0-9]+)"), F.lit(1))


def rouge_l(pairs: DataFrame, key: str = "pair_id", generated: str = "generated", reference: str = "reference",
            stem: bool = True) -> DataFrame:
    """ROUGE-L F-measure per pair: ``key, rouge_l``. No shuffle."""
    words = stem_words if stem else (lambda c: c)
    lists = pairs.select(key, words(rouge_tokens(generated)).alias("_g"), words(rouge_tokens(reference)).alias("_r"))
    scored = lists.select(
        key, F.size("_g").alias("gen"), F.size("_r").alias("ref"), common_subsequence("_g", "_r").alias("common")
    )
    precision, recall = F.col("common") / F.greatest("gen", F.lit(1)), F.col("common") / F.greatest("ref", F.lit(1))
    total = F.when(F.col("common") > 0, precision + recall)
    return scored.select(key, F.coalesce(2 * precision * recall / total, F.lit(0.0)).alias("rouge_l"))


def evaluate_generation(pairs: DataFrame, key: str = "pair_id", generated="generated", reference="reference",
                        stem: bool = True, digits: int = 4) -> DataFrame:
    """``key, bleu4, rouge_l`` per pair, rounded."""
    scored = bleu(pairs, key, generated, reference).join(rouge_l(pairs, key, generated, reference, stem), key)
    return scored.select(key, F.round("bleu4", digits).alias("bleu4"), F.round("rouge_l", digits).alias("rouge_l"))


def mean_generation(scores: DataFrame) -> DataFrame:
    return scores.agg(F.avg("bleu4").alias("mean_bleu4"), F.avg("rouge_l").alias("mean_rouge_l"), F.count("*").alias("pairs"))
