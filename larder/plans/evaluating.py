"""Evaluation of retrieval, screening and text, and clustering."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder import fixed
from larder.operators import answers, clusters, evaluation, language, lexical, recommend, similarity
from larder.plans import views as v
from larder.plans.registry import Tables, query
from larder.plans.retrieval import SELF, VECTOR_SCORES, detected_sql, profile_sql
from larder.plans.texts import TOKENS
from larder.session import fresh_path
from larder.sources.writers import save_report, save_table

METRICS = ("precision", "recall", "ndcg")


def metrics_sql(hits: str, sizes: str, name: str = "metrics", ks: str = "[1, 3, 5, 10]") -> str:
    """``<name> (query_id, k, ...)`` from ``hits (query_id, rank)`` and ``sizes (query_id, size)``."""
    return f"""
{name} AS (SELECT s.query_id, k::BIGINT AS k, count(h.rank) / k AS precision, count(h.rank) / any_value(size) AS recall,
                  coalesce(sum(1 / log2(h.rank + 1)), 0)
                  / list_sum(list_transform(range(1, least(any_value(size), k) + 1), lambda i: 1 / log2(i + 1))) AS ndcg
           FROM {sizes} s CROSS JOIN (SELECT unnest({ks}) AS k) LEFT JOIN {hits} h ON h.query_id = s.query_id AND h.rank <= k
           GROUP BY s.query_id, k)"""


JUDGED = f"""WITH {VECTOR_SCORES}, {v.ranked('top', 'scores', 10)},
hits AS (SELECT t.query_id, t.rank FROM top t JOIN vectors a ON a.id = t.query_id JOIN vectors b ON b.id = t.item_id WHERE a.label = b.label),
sizes AS (SELECT id AS query_id, count(*) OVER (PARTITION BY label) - 1 AS size FROM vectors QUALIFY size > 0),
{metrics_sql('hits', 'sizes')}"""


def _label_metrics(t: Tables):
    """Every vector as a query; the other vectors of its label are relevant. No pairs are listed."""
    labels = v.vector_items(t).select("item_id", "label")
    asked = labels.select(F.col("item_id").alias("query_id"), F.col("label").alias("wanted"))
    top = similarity.top_k(v.vector_requests(t), v.vector_items(t), 10, SELF, attach=labels)
    hits = top.join(asked, "query_id").where(F.col("label") == F.col("wanted")).withColumn("name", F.col("item_id").cast("string"))
    per_label = labels.groupBy(F.col("label").alias("wanted")).agg((F.count("*") - 1).alias("size"))
    sizes = asked.join(per_label, "wanted").select("query_id", "size")
    return evaluation.hit_metrics(hits, sizes, fixed.K_VALUES)


def _rounded(df, names=METRICS, digits=6):
    return df.withColumns({m: F.round(m, digits) for m in names})


@query("evl01_precision_at_k", JUDGED + " SELECT query_id, k, round(precision, 6) AS precision FROM metrics")
def _(t: Tables):
    return _rounded(_label_metrics(t)).select("query_id", "k", "precision")


@query("evl02_recall_at_k", JUDGED + " SELECT query_id, k, round(recall, 6) AS recall FROM metrics")
def _(t: Tables):
    return _rounded(_label_metrics(t)).select("query_id", "k", "recall")


@query("evl03_ndcg_at_k", JUDGED + " SELECT query_id, k, round(ndcg, 6) AS ndcg FROM metrics")
def _(t: Tables):
    return _rounded(_label_metrics(t)).select("query_id", "k", "ndcg")


# Every document is a request made of its text; relevant is the document itself, by name.
REQUESTS = v.DOCUMENT_ITEMS + """,
requests AS (SELECT item_id AS query_id, text_full AS text, name AS wanted FROM items),
sizes AS (SELECT query_id, 1 AS size FROM requests)"""

REQUEST_VECTORS = (
    v.bow("asked", "SELECT query_id AS id, text FROM requests") + ","
    + v.bow("indexed", "SELECT item_id AS id, text_full AS text FROM items") + ","
    + v.scored("scores", "asked", "indexed", "SELECT query_id AS id FROM requests", "SELECT item_id AS id FROM items") + ","
    + v.ranked("top", "scores", 10)
    + ", hits AS (SELECT query_id, rank FROM top JOIN items USING (item_id) JOIN requests USING (query_id) WHERE name = wanted)"
)

LONG = """long AS (SELECT 'precision' AS metric, k, avg(precision) AS value FROM {0} GROUP BY k
       UNION ALL SELECT 'recall', k, avg(recall) FROM {0} GROUP BY k UNION ALL SELECT 'ndcg', k, avg(ndcg) FROM {0} GROUP BY k)"""


def _judged(t: Tables):
    """Items, a request from each of them, and what is relevant to it."""
    items = v.document_items(t)
    return items, items.select(F.col("item_id").alias("query_id"), F.col("text_full").alias("text")), items.select(F.col("item_id").alias("query_id"), "name")


def _stored_index(t: Tables, items):
    return save_table(recommend.build_index(items, keep=[]), fresh_path(t.spark, "index"))


def _by_vector(items, index, threshold: float | None = None):
    """Retrieval by vector; with a threshold, requests whose best score is below it get nothing."""

    def run(queries, k):
        top = recommend.by_text(queries, index, k)
        if threshold is not None:
            top = answers.screened(top, threshold)
        return top.join(items.select("item_id", "name"), "item_id")

    return run


def _by_terms(items):
    index = lexical.fit(items)

    def run(queries, k):
        return lexical.by_text(queries, index, k, attach=items.select("item_id", "name"))

    return run


EVERY_QUERY = evaluation.EvalConfig()


@query(
    "evl04_evaluate_recommender",
    f"WITH {REQUESTS}, {REQUEST_VECTORS}, {metrics_sql('hits', 'sizes')}, {LONG.format('metrics')} SELECT metric, k, round(value, 6) AS value FROM long",
)
def _(t: Tables):
    """Retrieve once at the largest k, mean of each metric per k."""
    items, queries, relevant = _judged(t)
    run = _by_vector(items, _stored_index(t, items))
    scores = evaluation.evaluate_recommender(queries, relevant, run, EVERY_QUERY)
    return _rounded(scores, ["value"])


SCREENED = f"""WITH {profile_sql()}, {detected_sql('spoken', 'SELECT item_id AS id, text FROM benchmark')},
{v.BENCHMARK_REQUESTS}, english AS (SELECT doc_id AS id, text FROM documents WHERE lang = 'en'),
{v.bow('asked', 'SELECT query_id AS id, text FROM requests')}, {v.bow('indexed', 'SELECT id, text FROM english')},
{v.scored('scores', 'asked', 'indexed', 'SELECT query_id AS id FROM requests', 'SELECT id FROM english')},
best AS (SELECT query_id, max(score) AS best, any_value(lang) = 'en' AS inside FROM scores JOIN spoken ON id = query_id GROUP BY query_id)"""

REPORT = """round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, {0}) AS precision,
    round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, {0}) AS recall,
    round(CASE WHEN tp > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, {0}) AS f1,
    round(CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0 END, {0}) AS rejection_rate_ood"""


def _screened(t: Tables):
    """Benchmark texts against the English documents; English texts are in the domain."""
    asked = language.detect(v.benchmark_requests(t), "text", "spoken")
    index = recommend.build_index(v.document_items(t).where("category = 'en'"), keep=[])
    verdict = answers.guardrail(asked.select("query_id", "text"), index)
    return verdict.join(asked.select("query_id", (F.col("spoken") == "en").alias("in_domain")), "query_id")


@query(
    "evl05_evaluate_guardrail",
    SCREENED + f""", c AS (SELECT count(*) FILTER (inside AND best >= 0.4) AS tp, count(*) FILTER (NOT inside AND best >= 0.4) AS fp,
        count(*) FILTER (NOT inside AND best < 0.4) AS tn, count(*) FILTER (inside AND best < 0.4) AS fn FROM best)
        SELECT tp, fp, tn, fn, {REPORT.format(3)} FROM c""",
)
def _(t: Tables):
    asked = language.detect(v.benchmark_requests(t), "text", "spoken")
    labelled = asked.select("query_id", "text", (F.col("spoken") == "en").alias("in_domain"))
    index = recommend.build_index(v.document_items(t).where("category = 'en'"), keep=[])
    return evaluation.evaluate_guardrail(labelled, lambda requests: answers.guardrail(requests, index))


THRESHOLDS = [0.20, 0.25, 0.30, 0.35, 0.40, 0.45, 0.50, 0.55, 0.60]
SWEPT = SCREENED + f""", swept AS (SELECT threshold, count(*) FILTER (inside AND best >= threshold) AS tp,
    count(*) FILTER (NOT inside AND best >= threshold) AS fp, count(*) FILTER (NOT inside AND best < threshold) AS tn,
    count(*) FILTER (inside AND best < threshold) AS fn
    FROM best CROSS JOIN (SELECT unnest([{', '.join(f'{x}::DOUBLE' for x in THRESHOLDS)}]) AS threshold) GROUP BY threshold),
    report AS (SELECT threshold, tp, fp, tn, fn, {REPORT.format(6)} FROM swept)"""


@query("evl06_threshold_sweep", SWEPT + " SELECT * FROM report")
def _(t: Tables):
    return evaluation.threshold_sweep(_screened(t), THRESHOLDS)


@query("evl06_best_threshold", SWEPT + " SELECT min(threshold) AS threshold, max(f1) AS f1 FROM report WHERE f1 = (SELECT max(f1) FROM report)")
def _(t: Tables):
    return evaluation.best_threshold(evaluation.threshold_sweep(_screened(t), THRESHOLDS))


BLEU = v.TURN_PAIRS + f""",
words AS (SELECT pair_id, {TOKENS.format('generated')} AS g, {TOKENS.format('reference')} AS r FROM pairs),
orders_ AS (SELECT unnest([1, 2, 3, 4]) AS n),
g AS (SELECT pair_id, n, gram, count(*) AS c FROM (SELECT pair_id, n, unnest(list_transform(range(1, len(g) - n + 2),
      lambda i: array_to_string(list_slice(g, i, i + n - 1), ' '))) AS gram FROM words CROSS JOIN orders_) GROUP BY ALL),
r AS (SELECT pair_id, n, gram, count(*) AS c FROM (SELECT pair_id, n, unnest(list_transform(range(1, len(r) - n + 2),
      lambda i: array_to_string(list_slice(r, i, i + n - 1), ' '))) AS gram FROM words CROSS JOIN orders_) GROUP BY ALL),
m AS (SELECT w.pair_id, o.n, coalesce(sum(least(g.c, coalesce(r.c, 0))), 0) AS hit, coalesce(sum(g.c), 0) AS total
      FROM words w CROSS JOIN orders_ o LEFT JOIN g ON g.pair_id = w.pair_id AND g.n = o.n
      LEFT JOIN r ON r.pair_id = g.pair_id AND r.n = g.n AND r.gram = g.gram GROUP BY ALL),
bleu AS (SELECT m.pair_id, CASE WHEN max(hit) FILTER (n = 1) = 0 OR any_value(len(g)) = 0 THEN 0.0
                ELSE exp(avg(ln(greatest(hit, 0.1::DOUBLE) / greatest(total, 1))))
                     * CASE WHEN any_value(len(g)) > any_value(len(r)) THEN 1.0 ELSE exp(1 - any_value(len(r)) / any_value(len(g))) END
                END AS bleu4 FROM m JOIN words USING (pair_id) GROUP BY m.pair_id)"""

ROUGE = """
tokens AS (SELECT pair_id, regexp_extract_all(lower(generated), '[a-z0-9]+') AS gt, regexp_extract_all(lower(reference), '[a-z0-9]+') AS rt FROM pairs),
flags AS (SELECT pair_id, len(gt) AS gen, len(rt) AS ref,
          list_prepend(list_transform(rt, lambda u: 0::BIGINT), list_transform(gt, lambda w: list_transform(rt, lambda u: (u = w)::BIGINT))) AS rows FROM tokens),
lcs AS (SELECT pair_id, gen, ref, CASE WHEN gen = 0 OR ref = 0 THEN 0 ELSE
        list_reduce(rows, lambda p, m: list_transform(range(1, len(m) + 1), lambda i: list_max(list_transform(range(1, i + 1),
            lambda j: greatest(p[j], CASE WHEN j > 1 THEN p[j - 1] ELSE 0 END + m[j])))))[-1] END AS common FROM flags),
rouge AS (SELECT pair_id, CASE WHEN common = 0 THEN 0.0 ELSE 2 * (common / gen) * (common / ref) / (common / gen + common / ref) END AS rouge_l FROM lcs)"""


@query("evl07_bleu", f"WITH {BLEU} SELECT pair_id, round(bleu4, 6) AS bleu4 FROM bleu")
def _(t: Tables):
    """Whole assistant turns against the user turn before."""
    return _rounded(evaluation.bleu(v.turn_pairs(t)), ["bleu4"])


@query("evl08_rouge_l", f"WITH {v.TURN_PAIRS}, {ROUGE} SELECT pair_id, round(rouge_l, 6) AS rouge_l FROM rouge")
def _(t: Tables):
    return _rounded(evaluation.rouge_l(v.turn_pairs(t), stem=False), ["rouge_l"])


@query("evl08_rouge_l_stemmed")
def _(t: Tables):
    """With stemming, as text scoring does by default; checked against brute force in the tests."""
    return _rounded(evaluation.rouge_l(v.turn_pairs(t)), ["rouge_l"])


@query(
    "evl09_mean_generation",
    f"WITH {BLEU}, {ROUGE} SELECT round(avg(bleu4), 6) AS mean_bleu4, round(avg(rouge_l), 6) AS mean_rouge_l, count(*) AS pairs FROM bleu JOIN rouge USING (pair_id)",
)
def _(t: Tables):
    scores = evaluation.evaluate_generation(v.turn_pairs(t), stem=False, digits=12)
    return _rounded(evaluation.mean_generation(scores), ["mean_bleu4", "mean_rouge_l"])


ABLATION = (
    f"WITH {REQUESTS}, {REQUEST_VECTORS}, {metrics_sql('hits', 'sizes', 'vector_metrics', '[5]')},"
    + "strong AS (SELECT query_id FROM top GROUP BY query_id HAVING max(score) >= 0.4),"
    + "screened_hits AS (SELECT hits.* FROM hits SEMI JOIN strong USING (query_id)),"
    + metrics_sql("screened_hits", "sizes", "screened_metrics", "[5]") + ","
    + v.tfidf("fit", "SELECT item_id AS id, text_full AS text FROM items") + ","
    + v.tfidf_vectors("lex_asked", "fit_vocab", "SELECT query_id AS id, text FROM requests") + ","
    + v.tfidf_vectors("lex_indexed", "fit_vocab", "SELECT item_id AS id, text_full AS text FROM items") + ","
    + v.scored("lex_scores", "lex_asked", "lex_indexed", "SELECT query_id AS id FROM requests", "SELECT item_id AS id FROM items") + ","
    + v.ranked("lex_top", "lex_scores", 5)
    + ", lex_hits AS (SELECT query_id, rank FROM lex_top JOIN items USING (item_id) JOIN requests USING (query_id) WHERE name = wanted),"
    + metrics_sql("lex_hits", "sizes", "lex_metrics", "[5]") + ","
    + "every AS (SELECT 'tfidf' AS config, * FROM lex_metrics UNION ALL SELECT 'vector', * FROM vector_metrics"
    + " UNION ALL SELECT 'vector+guardrail', * FROM screened_metrics),"
    + "means AS (SELECT config, k, avg(precision) AS precision, avg(recall) AS recall, avg(ndcg) AS ndcg FROM every GROUP BY config, k),"
    + "long AS (SELECT config, k, 'precision' AS metric, precision AS value FROM means UNION ALL SELECT config, k, 'recall', recall FROM means"
    + " UNION ALL SELECT config, k, 'ndcg', ndcg FROM means)"
)


def _ablation(t: Tables):
    """Every configuration is run; none is extrapolated from another."""
    items, queries, relevant = _judged(t)
    config = evaluation.EvalConfig(k_values=[5], n_queries=None)
    index = _stored_index(t, items)
    runs = {
        "tfidf": _by_terms(items),
        "vector": _by_vector(items, index),
        "vector+guardrail": _by_vector(items, index, fixed.GUARDRAIL_THRESHOLD),
    }
    tables = [
        evaluation.evaluate_recommender(queries, relevant, run, config).withColumn("config", F.lit(name))
        for name, run in runs.items()
    ]
    return tables[0].unionByName(tables[1]).unionByName(tables[2])


@query("evl10_ablation", ABLATION + " SELECT config, k, metric, round(value, 6) AS value FROM long")
def _(t: Tables):
    return _rounded(_ablation(t), ["value"]).select("config", "k", "metric", "value")


@query(
    "evl10_gain_over_baseline",
    ABLATION + """ SELECT a.config, a.metric, a.k, round((a.value - b.value) / greatest(b.value, 1e-9) * 100, 4) AS gain
        FROM long a JOIN long b ON b.config = 'tfidf' AND a.metric = b.metric AND a.k = b.k WHERE a.config <> 'tfidf'""",
)
def _(t: Tables):
    gains = evaluation.relative_gain(_ablation(t), "tfidf")
    return gains.select("config", "metric", "k", F.round("gain", 4).alias("gain"))


@query(
    "evl11_summary",
    JUDGED + """, m AS (SELECT k, avg(precision) AS precision, avg(recall) AS recall, avg(ndcg) AS ndcg FROM metrics GROUP BY k),
        l AS (SELECT k, 'precision' AS metric, precision AS x FROM m UNION ALL SELECT k, 'recall', recall FROM m UNION ALL SELECT k, 'ndcg', ndcg FROM m)
        SELECT metric, round(max(x) FILTER (k = 1), 6) AS at_1, round(max(x) FILTER (k = 3), 6) AS at_3,
               round(max(x) FILTER (k = 5), 6) AS at_5, round(max(x) FILTER (k = 10), 6) AS at_10 FROM l GROUP BY metric""",
)
def _(t: Tables):
    long = evaluation.long_metrics(evaluation.macro_mean(_label_metrics(t)))
    return _rounded(evaluation.summary_report(long, fixed.K_VALUES), ["at_1", "at_3", "at_5", "at_10"])


REPORT_SQL = JUDGED + f""", {BLEU}, {ROUGE}, means AS (SELECT k, avg(precision) AS precision, avg(recall) AS recall, avg(ndcg) AS ndcg FROM metrics GROUP BY k),
    l AS (SELECT k, 'precision' AS metric, precision AS x FROM means UNION ALL SELECT k, 'recall', recall FROM means UNION ALL SELECT k, 'ndcg', ndcg FROM means)
    SELECT metric, k, round(x, 6) AS value FROM l
    UNION ALL SELECT 'bleu4', NULL, round(avg(bleu4), 6) FROM bleu UNION ALL SELECT 'rouge_l', NULL, round(avg(rouge_l), 6) FROM rouge
    UNION ALL SELECT 'n_pairs', NULL, count(*) FROM pairs
    UNION ALL SELECT 'n_queries', NULL, count(*) FROM embeddings UNION ALL SELECT 'n_evaluated', NULL, count(*) FROM sizes"""


def _report(t: Tables):
    """The whole evaluation as one table: retrieval per k, generated text, and how many requests and pairs were judged."""
    means = evaluation.macro_mean(_label_metrics(t))
    asked = v.vector_items(t).select(F.col("item_id").alias("query_id"), "label")
    judged = asked.join(asked.groupBy("label").count().where("count > 1"), "label", "left_semi").select("query_id")
    scores = evaluation.evaluate_generation(v.turn_pairs(t), stem=False, digits=12)
    report = evaluation.full_report(means, evaluation.mean_generation(scores), evaluation.query_counts(asked, judged))
    return _rounded(report, ["value"])


@query("evl11_report", REPORT_SQL)
def _(t: Tables):
    return _report(t)


@query(
    "src08_evaluation_report",
    f"SELECT 'label neighbours' AS config, '{','.join(map(str, fixed.K_VALUES))}' AS k_values, metric, k::BIGINT AS k, value FROM ({REPORT_SQL})",
)
def _(t: Tables):
    """The evaluation with its configuration as JSON lines, absent values written as null, read back."""
    config = {"config": F.lit("label neighbours"), "k_values": F.lit(",".join(map(str, fixed.K_VALUES)))}
    path = fresh_path(t.spark, "report")
    save_report(_report(t).withColumns(config), path)
    return t.spark.read.schema("config string, k_values string, metric string, k long, value double").json(path)


# --- clustering ---------------------------------------------------------------

@query("ml01_kmeans")
def _(t: Tables):
    """Eight clusters, best of ten starts: assignment of every vector."""
    features = clusters.as_features(v.vector_items(t))
    model = clusters.fit_kmeans(features, 8)
    return clusters.assign(features, model).select("item_id", F.col("cluster").cast("long").alias("cluster"))


@query("ml02_sweep")
def _(t: Tables):
    """Inertia and silhouette over all vectors for 3 to 15 clusters; best of ten starts each, 130 fits."""
    return clusters.sweep(v.vector_items(t))


SILHOUETTE = """WITH v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS e, label FROM embeddings),
    d AS (SELECT a.id, a.label, b.label AS other, sum(list_distance(a.e, b.e)) AS total, count(*) AS n FROM v a JOIN v b ON a.id <> b.id GROUP BY ALL),
    s AS (SELECT id, label, max(total / n) FILTER (label = other) AS a, min(total / n) FILTER (label <> other) AS b FROM d GROUP BY id, label),
    r AS (SELECT id AS item_id, label::BIGINT AS label,
          CASE WHEN a IS NULL OR b IS NULL OR greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END AS silhouette FROM s)"""


@query("ml03_silhouette", SILHOUETTE + " SELECT item_id, label, round(silhouette, 6) AS silhouette FROM r")
def _(t: Tables):
    """Silhouette of every vector under the given labels, without sampling."""
    return _rounded(clusters.silhouette(v.vector_items(t), "label"), ["silhouette"])


@query("ml03_mean_silhouette", SILHOUETTE + " SELECT round(avg(silhouette), 6) AS silhouette FROM r")
def _(t: Tables):
    return _rounded(clusters.mean_silhouette(v.vector_items(t), "label", sample=None), ["silhouette"])


@query("ml04_projection")
def _(t: Tables):
    """Two principal components of every vector."""
    points = clusters.project(v.vector_items(t))
    return points.select("item_id", F.round("x1", 6).alias("x1"), F.round("x2", 6).alias("x2"))


@query(
    "ml05_cluster_profile",
    """WITH c AS (SELECT label AS cluster, lang AS category, count(*) AS n FROM embeddings JOIN documents ON doc_id = vec_id GROUP BY ALL)
       SELECT cluster::BIGINT AS cluster, category AS mode, size::BIGINT AS size, 'C' || cluster || ': ' || category AS label
       FROM (SELECT *, sum(n) OVER (PARTITION BY cluster) AS size, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, category) AS r FROM c)
       WHERE r = 1""",
)
def _(t: Tables):
    """Given labels as clusters, document language as category."""
    languages = t.documents.select(F.col("doc_id").alias("item_id"), F.col("lang").alias("category"))
    labelled = v.vector_items(t).select("item_id", F.col("label").alias("cluster")).join(languages, "item_id")
    return clusters.cluster_profile(labelled)
