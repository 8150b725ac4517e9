"""Registered queries of the training-data operators, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from larder.llm import alignment, decontamination, extraction, hard_negatives, interpolation, language_id, licenses, mixing, near_duplicates, outliers, packing, token_files, url_filter
from larder.llm.common import LETTERS_AND_DIGITS, LOWER, UPPER, WORD, id_bucket, stored, words
from larder.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query (spark, folder) -> DataFrame."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship_package(spark)
            return build(spark, folder)

        run.__name__, run.__doc__ = name, build.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql.strip()
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_mix_sources")
def mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Sources in order weigh 5, 2, 1 and share 150 % of all words; none is above twice its size."""
    docs = table(spark, folder, "documents").select("doc_id", "source", F.size(words("text")).cast("long").alias("size"))
    return mixing.mix(stored(docs, "mix-documents"), (5.0, 2.0, 1.0)).select("doc_id", "size", "source_size", "target", "taken")


@query("op2_main_text")
def main_text(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    return extraction.extract(table(spark, folder, "pages"))


@query("op3_quality_rules")
def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Text statistics, the two base rules, and outliers of each language and source."""
    judged = outliers.judge(table(spark, folder, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "d2")


@query("op4_token_files")
def write_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as token files, and what is read back from them."""
    path = token_files.write_segments(table(spark, folder, "documents"))
    return token_files.read_documents(spark, path)


_LOWER = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"

DECONTAMINATE_SQL = f"""WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{LETTERS_AND_DIGITS}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '{LETTERS_AND_DIGITS}') AS w FROM benchmark),
pattern AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(list_slice(w, i, i + 9), ' '))) AS p,
            least(len(w), 10) AS n FROM b WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM pattern),
runs AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(list_slice(w, i, i + n - 1), ' '))) AS p
         FROM d CROSS JOIN sizes WHERE len(w) >= n),
found AS (SELECT doc_id, i, n, item_id FROM runs JOIN pattern USING (n, p)),
hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM found) GROUP BY doc_id),
listed AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id)"""


@query("op5_decontaminate", DECONTAMINATE_SQL)
def decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document inside a benchmark window."""
    found = decontamination.scan(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", decontamination.n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


@query("op6_language_model")
def language_model(spark: SparkSession, folder: str) -> DataFrame:
    """Every document under a model learned from four fifths of the ids."""
    docs = table(spark, folder, "documents").select("doc_id", "text", (id_bucket("doc_id", 5) == 1).alias("held"))
    return interpolation.score(docs)


NEAR_SQL = f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{WORD}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 2, 1) + 1), lambda i: array_to_string(list_slice(w, i, i + 2), ' '))) AS g FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
least_ AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM least_ LEFT JOIN n USING (doc_id)"""


@query("op7_near_duplicates", NEAR_SQL)
def link_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose sets of three-word shingles are similar by 0.85 or more."""
    return near_duplicates.link(table(spark, folder, "documents"), 3, 85).select("doc_id", "n_shingles", "component_id", "kept")


# The rules of the query contract.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


@query("op8_url_filter")
def filter_urls(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's url judged by the rules, else by trees learned from the urls that the rules decide."""
    return url_filter.filter_urls(table(spark, folder, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict", "score")


@query("op9_licenses")
def scan_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and signature labels of every document."""
    found = licenses.detect(table(spark, folder, "documents"))
    labels = F.array_join(F.array_sort(F.array_union("base_labels", "method_labels")), ",")
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"), labels.alias("labels"),
        licenses.score().alias("score"), "n_detections",
    )


@query("op10_language")
def language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document; three quarters of the ids may teach."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs.where(id_bucket("doc_id", 4) != 2))
    return language_id.predict(docs, model).select("doc_id", (id_bucket("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


@query("op11_pack_sequences")
def pack_sequences(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens, and what is read back from the sequences."""
    return packing.read_pieces(packing.pack(table(spark, folder, "documents")))


@query("op12_align_tokenizers")
def align_tokenizers(spark: SparkSession, folder: str) -> DataFrame:
    """Links between the tokens of two tokenizers in every document, with their counts over the corpus."""
    return alignment.align_documents(table(spark, folder, "documents"))


NEGATIVES_SQL = """WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS s FROM v a JOIN v b ON a.vec_id % 100 = 0),
positive AS (SELECT anchor_id, vec_id AS positive_id, s AS ps FROM scored WHERE same AND vec_id <> anchor_id QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s DESC, vec_id) AS INTEGER) AS rank, vec_id AS negative_id, ps AS positive_score, s AS negative_score
FROM positive JOIN scored USING (anchor_id) WHERE NOT same AND 80 * ps <= 100 * s AND s <= ps QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s DESC, vec_id) <= 5"""


@query("op13_hard_negatives", NEGATIVES_SQL)
def mine_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """The first rows of other labels in the score window of each anchor and positive."""
    return hard_negatives.mine(table(spark, folder, "embeddings"))


@query("pipeline")
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """The corpus pipeline over all documents."""
    return corpus_pipeline.run(spark, folder)
