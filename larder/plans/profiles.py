"""Aggregates, sorts and equi-joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder import fixed
from larder.functions import text as tx
from larder.operators import cache, corpus, evaluation, profile
from larder.plans import views as v
from larder.plans.ingest import index_sql
from larder.plans.registry import Tables, query
from larder.plans.texts import TOKENS, lexicon_sql

PROFILE_SQL = v.RECIPES + f", p AS (SELECT item_id, {lexicon_sql('ingredients', v.LEXICON)} FROM recipes)"


def _profiles(t: Tables):
    return corpus.add_profile(v.recipes(t).select("item_id", "ingredients"), v.LEXICON).drop("ingredients")


@query("agg01_value_counts", "SELECT source AS value, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, value LIMIT 10")
def _(t: Tables):
    return profile.value_counts(t.documents, "source", 10)


@query("agg02_ingredient_index", index_sql(fixed.MEASURE_PATTERNS["index"]))
def _(t: Tables):
    return profile.ingredient_index(v.recipes(t))


@query("agg02_ingredient_index_explore", index_sql(fixed.MEASURE_PATTERNS["explore"]))
def _(t: Tables):
    return profile.ingredient_index(v.recipes(t), variant="explore")


@query("agg02_top_ingredients", index_sql(fixed.MEASURE_PATTERNS["browse"], "ORDER BY n DESC, ingredient LIMIT 15"))
def _(t: Tables):
    return profile.ingredient_index(v.recipes(t), variant="browse", n=15)


@query(
    "agg03_summary",
    f"""WITH {v.RECIPES} SELECT count(*) AS rows, count(DISTINCT category) AS distinct_category, count(DISTINCT glass) AS distinct_glass,
        count(*) FILTER (name IS NULL) AS nulls_name, count(*) FILTER (ingredients IS NULL) AS nulls_ingredients,
        count(*) FILTER (instructions IS NULL) AS nulls_instructions FROM recipes""",
)
def _(t: Tables):
    return profile.summary(v.recipes(t), ["category", "glass"], ["name", "ingredients", "instructions"])


@query(
    "agg03_sources",
    """SELECT count(*) AS rows, count(DISTINCT source) AS distinct_source, count(DISTINCT lang) AS distinct_lang,
              count(*) FILTER (text IS NULL) AS nulls_text FROM documents""",
)
def _(t: Tables):
    """Size of a corpus, its distinct sources and languages, and missing texts."""
    return profile.summary(t.documents, ["source", "lang"], ["text"])


@query("agg04_mean_profile", f"WITH {PROFILE_SQL} SELECT {', '.join(f'round(avg({c}), 6) AS {c}' for c in v.LEXICON)} FROM p")
def _(t: Tables):
    means = profile.means(_profiles(t), list(v.LEXICON))
    return means.select(*[F.round(c, 6).alias(c) for c in v.LEXICON])


def histogram_sql(table: str, column: str, bins: int) -> str:
    return f"""x AS (SELECT CAST({column} AS DOUBLE) AS x FROM {table}),
        b AS (SELECT min(x) AS lo, (max(x) - min(x)) / {bins} AS w FROM x),
        c AS (SELECT least(floor((x - lo) / w), {bins - 1})::BIGINT AS bin, count(*) AS n FROM x, b GROUP BY 1)
        SELECT r.range AS bin, round(lo + r.range * w, 4) AS low, round(lo + (r.range + 1) * w, 4) AS high, coalesce(n, 0) AS n
        FROM range({bins}) r CROSS JOIN b LEFT JOIN c ON c.bin = r.range"""


def _rounded(bins):
    return bins.select("bin", F.round("low", 4).alias("low"), F.round("high", 4).alias("high"), "n")


@query("agg05_histogram", "WITH " + histogram_sql("documents", "n_chars", 30))
def _(t: Tables):
    return _rounded(profile.histogram(t.documents, "n_chars", 30))


@query("agg05_histogram_prices", "WITH " + histogram_sql("lineitem", "l_extendedprice", 15))
def _(t: Tables):
    return _rounded(profile.histogram(t.lineitem, "l_extendedprice", 15))


@query(
    "agg05_histogram_edges",
    f"""WITH {v.RECIPES}, x AS (SELECT length(ingredients) - length(replace(ingredients, ',', '')) + 1 AS x FROM recipes),
        c AS (SELECT least(x, 18) - 1 AS bin, count(*) AS n FROM x WHERE x BETWEEN 1 AND 19 GROUP BY 1)
        SELECT r.range AS bin, (r.range + 1)::DOUBLE AS low, (r.range + 2)::DOUBLE AS high, coalesce(n, 0) AS n
        FROM range(18) r LEFT JOIN c ON c.bin = r.range""",
)
def _(t: Tables):
    """Explicit integer edges 1..19; the last bin is closed."""
    counts = v.recipes(t).select(tx.ingredients_count("ingredients").alias("count"))
    return profile.histogram(counts, "count", list(range(1, 20)))


def correlation_sql() -> str:
    names = list(v.LEXICON)
    pairs = [(names[j], names[i]) for i in range(len(names)) for j in range(i + 1, len(names))]
    return " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM p" for a, b in pairs)


@query("agg06_correlations", f"WITH {PROFILE_SQL} {correlation_sql()}")
def _(t: Tables):
    return profile.correlations(_profiles(t), list(v.LEXICON)).withColumn("r", F.round("r", 6))


@query(
    "agg07_describe",
    f"""WITH d AS (SELECT 'n_chars' AS "column", CAST(n_chars AS DOUBLE) AS x FROM documents
        UNION ALL SELECT 'words', CAST(len({TOKENS.format('text')}) AS DOUBLE) FROM documents)
        SELECT "column", round(avg(x), 4) AS mean, median(x) AS median, max(x) AS max, min(x) AS min FROM d GROUP BY 1""",
)
def _(t: Tables):
    lengths = t.spread("documents").select("n_chars", tx.word_count("text").alias("words"))
    return profile.describe(lengths, ["n_chars", "words"]).withColumn("mean", F.round("mean", 4))


@query(
    "agg08_mode_per_group",
    """SELECT lang, source AS mode, size FROM (
         SELECT lang, source, sum(count(*)) OVER (PARTITION BY lang)::BIGINT AS size,
                row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, source) AS r
         FROM documents GROUP BY lang, source) WHERE r = 1""",
)
def _(t: Tables):
    return profile.mode_per_group(t.documents, "lang", "source")


@query(
    "agg09_share_of_top",
    """WITH top AS (SELECT source AS value, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, value LIMIT 8)
       SELECT value, n, round(100.0 * n / sum(n) OVER (), 6) AS percent FROM top""",
)
def _(t: Tables):
    return profile.share_of_top(t.documents, "source", 8).withColumn("percent", F.round("percent", 6))


@query(
    "agg10_word_frequencies",
    f"""WITH w AS (SELECT unnest({TOKENS.format('text')}) AS word FROM documents),
        top AS (SELECT word, count(*) AS n FROM w WHERE length(word) > 2 GROUP BY word ORDER BY n DESC, word LIMIT 80)
        SELECT word, n, round(n / max(n) OVER (), 6) AS weight FROM top""",
)
def _(t: Tables):
    return profile.word_frequencies(t.spread("documents"), "text", 80).withColumn("weight", F.round("weight", 6))


@query("srt01_distinct_sorted", "SELECT DISTINCT source FROM documents WHERE source IS NOT NULL ORDER BY source")
def _(t: Tables):
    return profile.distinct_values(t.documents, "source")


@query("srt02_global_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def _(t: Tables):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query(
    "srt03_best_by",
    """WITH p AS (SELECT CAST(p_size AS BIGINT) AS k, round(avg(p_retailprice), 0) AS score FROM part GROUP BY 1)
       SELECT min(k) AS k, max(score) AS score FROM p WHERE score = (SELECT max(score) FROM p)""",
)
def _(t: Tables):
    """The size with the largest mean price; rounding makes ties, the smallest size wins."""
    means = t.part.groupBy(F.col("p_size").cast("long").alias("k")).agg(F.round(F.avg("p_retailprice"), 0).alias("score"))
    return profile.best_by(means, "k", "score")


@query(
    "jon03_relevance_membership",
    """SELECT e.user_id, e.event_id FROM events e
       WHERE EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = e.user_id AND c.c_acctbal > 0)""",
)
def _(t: Tables):
    """Retrieved rows whose key is in the relevant set."""
    relevant = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("user_id"))
    return t.events.join(relevant, "user_id", "left_semi").select("user_id", "event_id")


@query(
    "jon04_cache_lookup",
    """WITH asked AS (SELECT conv_id, turn, md5('m' || chr(1) || text) AS key, text FROM conversations),
       known AS (SELECT DISTINCT md5('m' || chr(1) || text) AS key, 'old ' || text AS value FROM benchmark
                 UNION SELECT md5('m' || chr(1) || text), 'old ' || text FROM conversations WHERE turn = 0)
       SELECT conv_id, turn, coalesce(value, 'new ' || text) AS value, value IS NOT NULL AS cached FROM asked LEFT JOIN known USING (key)""",
)
def _(t: Tables):
    """Requests against a stored cache; each distinct miss is computed once and appended."""
    from larder.session import fresh_path

    path = fresh_path(t.spark, "cache")
    seen = t.benchmark.select("text").union(t.conversations.where("turn = 0").select("text")).distinct()
    seen.select(tx.content_key(F.lit("m"), "text").alias("key"), F.concat(F.lit("old "), "text").alias("value")).write.parquet(path)
    asked = t.conversations.select("conv_id", "turn", "text").withColumn("key", tx.content_key(F.lit("m"), "text"))

    def compute(frames):
        for frame in frames:
            yield frame.assign(value="new " + frame.payload)[["key", "value"]]

    return cache.through_cache(asked, "key", "text", compute, "string", path).select("conv_id", "turn", "value", "cached")


@query(
    "agg12_macro_mean",
    """WITH m AS (SELECT CAST(l_linenumber AS BIGINT) AS k, l_discount AS precision, l_tax AS recall, l_discount * l_tax AS ndcg FROM lineitem)
       SELECT k, round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall, round(avg(ndcg), 6) AS ndcg, count(*) AS n_queries
       FROM m GROUP BY k""",
)
def _(t: Tables):
    metrics = t.lineitem.select(
        F.col("l_linenumber").cast("long").alias("k"), F.col("l_discount").alias("precision"), F.col("l_tax").alias("recall"),
        (F.col("l_discount") * F.col("l_tax")).alias("ndcg"),
    )
    means = evaluation.macro_mean(metrics)
    return means.select("k", *[F.round(m, 6).alias(m) for m in ("precision", "recall", "ndcg")], "n_queries")


@query(
    "agg13_confusion",
    """SELECT count(*) FILTER (quality = 1 AND toxic = 0) AS tp, count(*) FILTER (quality = 0 AND toxic = 0) AS fp,
              count(*) FILTER (quality = 0 AND toxic = 1) AS tn, count(*) FILTER (quality = 1 AND toxic = 1) AS fn FROM labels""",
)
def _(t: Tables):
    labelled = t.labels.select((F.col("quality") == 1).alias("in_domain"), (F.col("toxic") == 0).alias("passed"))
    return evaluation.confusion(labelled)


@query(
    "agg14_relative_gain",
    """WITH m AS (SELECT l_returnflag AS config, l_linestatus AS metric, CAST(l_linenumber AS BIGINT) AS k, avg(l_extendedprice) AS value
                  FROM lineitem GROUP BY ALL)
       SELECT a.config, a.metric, a.k, round((a.value - b.value) / greatest(b.value, 1e-9) * 100, 4) AS gain
       FROM m a JOIN m b ON a.metric = b.metric AND a.k = b.k WHERE a.config <> 'A' AND b.config = 'A'""",
)
def _(t: Tables):
    """Mean price per return flag relative to flag A in percent, by line status and number."""
    keys = [F.col("l_returnflag").alias("config"), F.col("l_linestatus").alias("metric"), F.col("l_linenumber").cast("long").alias("k")]
    means = t.lineitem.groupBy(*keys).agg(F.avg("l_extendedprice").alias("value"))
    return evaluation.relative_gain(means, "A").select("config", "metric", "k", F.round("gain", 4).alias("gain"))
