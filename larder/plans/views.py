"""Corpus-shaped views over the test tables, in Spark and as SQL common table expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from larder import fixed
from larder.functions import text as tx
from larder.operators import corpus
from larder.plans.registry import Tables

# Word groups of part names; "old" is also inside "cold".
LEXICON = {
    "thermal": ["cold", "hot"],
    "size": ["small", "large"],
    "age": ["new", "old"],
    "colour": ["red", "blue"],
    "fastener": ["bolt", "ring", "rod", "gear"],
    "body": ["widget", "gizmo", "plate", "anvil"],
}


def recipe_lines(t: Tables) -> DataFrame:
    """``item_id, lines``: the ordered lines of an order that has any.

    One output row is one order, so its list is as long as the order itself.
    """
    lines = t.spread("lineitem", "l_orderkey").select("l_orderkey", "l_partkey", "l_linenumber", F.col("l_quantity").cast("long").alias("q"))
    named = lines.join(t.part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    line = F.struct("l_linenumber", "p_name", "q")
    return named.groupBy(F.col("l_orderkey").alias("item_id")).agg(F.array_sort(F.collect_list(line)).alias("lines"))


def recipes(t: Tables) -> DataFrame:
    """One item per order with lines: ``item_id`` and the five required columns."""
    joined = _orders(t).join(recipe_lines(t), "item_id")
    names = F.transform("lines", lambda x: x["p_name"])
    measured = F.transform("lines", lambda x: F.concat(x["q"].cast("string"), F.lit("ml "), x["p_name"]))
    return joined.select(
        "item_id",
        F.concat(names[0], F.lit(" "), F.col("customer").cast("string")).alias("name"),
        "category", "glass",
        F.array_join(measured, ", ").alias("ingredients"),
        F.concat(F.lit("Combine "), F.array_join(names, ", "), F.lit(" and serve.")).alias("instructions"),
    )


def _orders(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("item_id"), F.col("o_custkey").alias("customer"),
        F.col("o_orderpriority").alias("category"), F.col("o_orderstatus").alias("glass"),
    )


def wide_recipes(t: Tables) -> DataFrame:
    """The raw wide layout: as many ingredient and measure slots as the longest order has lines, unused ones null."""
    lines = recipe_lines(t)
    longest = t.lineitem.groupBy("l_orderkey").count().agg(F.max("count")).first()[0] or 0
    joined = _orders(t).join(lines, "item_id")
    names = F.transform("lines", lambda x: x["p_name"])

    def slot(n: int) -> Column:
        return F.get("lines", F.lit(n - 1))

    slots = range(1, max(longest, fixed.WIDE_SLOTS) + 1)
    return joined.select(
        "item_id",
        F.concat(names[0], F.lit(" "), F.col("customer").cast("string")).alias("strDrink"),
        F.col("category").alias("strCategory"),
        F.col("glass").alias("strGlass"),
        F.concat(F.lit("Combine "), F.array_join(names, ", "), F.lit(" and serve.")).alias("strInstructions"),
        *[slot(n)["p_name"].alias(f"{fixed.WIDE_INGREDIENT}{n}") for n in slots],
        *[F.concat(slot(n)["q"].cast("string"), F.lit("ml")).alias(f"{fixed.WIDE_MEASURE}{n}") for n in slots],
    )


def items(t: Tables) -> DataFrame:
    """Deduplicated recipes with search text: the item corpus."""
    return corpus.add_search_text(corpus.dedup_by_name(recipes(t), ["item_id"]))


def document_items(t: Tables) -> DataFrame:
    """Documents as items: the text is both the instructions and the search text."""
    return t.spread("documents").select(
        F.col("doc_id").alias("item_id"),
        F.concat("lang", F.lit(" "), F.col("doc_id").cast("string")).alias("name"),
        F.col("lang").alias("category"),
        F.col("source").alias("ingredients"),
        F.col("text").alias("instructions"),
        F.col("text").alias("text_full"),
    )


def vector_items(t: Tables) -> DataFrame:
    return t.embeddings.select(F.col("vec_id").alias("item_id"), "embedding", F.col("label").cast("long").alias("label"))


def vector_requests(t: Tables) -> DataFrame:
    return t.embeddings.select(F.col("vec_id").alias("query_id"), "embedding")


def benchmark_requests(t: Tables) -> DataFrame:
    return t.benchmark.select(F.col("item_id").alias("query_id"), "text")


def user_requests(t: Tables) -> DataFrame:
    """User turns; the key holds conversation and turn."""
    asked = t.conversations.where(F.col("role") == "user")
    return asked.select((F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"), "text", "turn")


def turn_pairs(t: Tables) -> DataFrame:
    """Each assistant turn as generated text, the user turn before it as reference."""
    c = t.spread("conversations")
    asked = t.conversations.where("role = 'user'").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("reference"))
    given = c.where("role = 'assistant'").select("conv_id", "turn", F.col("text").alias("generated"))
    return given.join(asked, ["conv_id", "turn"]).select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("pair_id"), "generated", "reference"
    )


def ingredient_requests(t: Tables) -> DataFrame:
    """One request per part size: the names on hand, and the first of them as required."""
    listed = t.part.select(F.col("p_size").cast("long").alias("query_id"), "p_name").distinct()
    return listed.groupBy("query_id").agg(F.array_sort(F.collect_list("p_name")).alias("available")).select(
        "query_id", "available", F.slice("available", 1, 1).alias("required")
    )


# --- the same views in SQL ----------------------------------------------------

LINES = """
lines AS (SELECT l_orderkey AS item_id, l_linenumber AS l, p_name AS p, CAST(l_quantity AS BIGINT) AS q
          FROM lineitem JOIN part ON l_partkey = p_partkey)"""

RECIPES = LINES + """,
line_lists AS (SELECT item_id, string_agg(q || 'ml ' || p, ', ' ORDER BY l, p, q) AS ingredients,
                      string_agg(p, ', ' ORDER BY l, p, q) AS names, min({'l': l, 'p': p, 'q': q}).p AS head
               FROM lines GROUP BY item_id),
recipes AS (SELECT o_orderkey AS item_id, head || ' ' || o_custkey AS name, o_orderpriority AS category,
                   o_orderstatus AS glass, ingredients, 'Combine ' || names || ' and serve.' AS instructions
            FROM orders JOIN line_lists ON o_orderkey = line_lists.item_id)"""

KEY = "regexp_replace(trim(lower(coalesce(name, ''))), '\\s+', ' ', 'g')"

ITEMS = RECIPES + f""",
items AS (SELECT *, name || '. Category: ' || category || '. Ingredients: ' || ingredients || '. ' || instructions AS text_full
          FROM recipes QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY item_id) = 1)"""

DOCUMENT_ITEMS = """
items AS (SELECT doc_id AS item_id, lang || ' ' || doc_id AS name, lang AS category, source AS ingredients,
                 text AS instructions, text AS text_full FROM documents)"""

USER_REQUESTS = """
requests AS (SELECT conv_id * 1000 + turn AS query_id, text, turn FROM conversations WHERE role = 'user')"""

BENCHMARK_REQUESTS = """
requests AS (SELECT item_id AS query_id, text FROM benchmark)"""

TURN_PAIRS = """
pairs AS (SELECT g.conv_id * 1000 + g.turn AS pair_id, g.text AS generated, r.text AS reference
          FROM conversations g JOIN conversations r ON g.conv_id = r.conv_id AND g.turn = r.turn + 1
          WHERE g.role = 'assistant' AND r.role = 'user')"""

INGREDIENT_REQUESTS = """
requests AS (SELECT CAST(p_size AS BIGINT) AS query_id, list_sort(list(DISTINCT p_name)) AS available FROM part GROUP BY 1)"""

WORDS = "[\\p{L}\\p{N}_]{2,}"


def bow(name: str, source: str, dim: int = fixed.EMBEDDING_DIM) -> str:
    """Hashed word-count vectors of ``source (id, text)`` as rows ``<name> (id, slot, w)``."""
    return f"""
{name}_words AS (SELECT id, unnest(regexp_extract_all(lower(text), '{WORDS}')) AS word FROM ({source})),
{name}_slots AS (SELECT id, ('0x' || substr(md5(word), 1, 8))::UBIGINT % {dim} AS slot, count(*) AS n
                 FROM {name}_words GROUP BY ALL),
{name} AS (SELECT id, slot, CAST(CAST(n / sqrt(sum(n * n) OVER (PARTITION BY id)) AS FLOAT) AS DOUBLE) AS w
           FROM {name}_slots)"""


def scored(name: str, queries: str, corpus_: str, query_ids: str, item_ids: str) -> str:
    """Every request-item score of two sparse vector tables as ``<name> (query_id, item_id, score)``."""
    return f"""
{name}_dots AS (SELECT a.id AS query_id, b.id AS item_id, sum(a.w * b.w) AS s
                FROM {queries} a JOIN {corpus_} b ON a.slot = b.slot GROUP BY ALL),
{name} AS (SELECT q.id AS query_id, i.id AS item_id, round(coalesce(d.s, 0), 8) AS score
           FROM ({query_ids}) q CROSS JOIN ({item_ids}) i
           LEFT JOIN {name}_dots d ON d.query_id = q.id AND d.item_id = i.id)"""


def ranked(name: str, source: str, k: int) -> str:
    return f"""
{name} AS (SELECT query_id, item_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank
           FROM {source} QUALIFY rank <= {k})"""


def tfidf(name: str, corpus_: str, features: int = fixed.TFIDF_FEATURES) -> str:
    """Vocabulary ``<name>_vocab (term, slot, idf)`` of ``corpus_ (id, text)``."""
    return f"""
{name}_docs AS (SELECT id, regexp_extract_all(lower(text), '{WORDS}') AS t FROM ({corpus_})),
{name}_terms AS (SELECT id, unnest(t || list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS term FROM {name}_docs),
{name}_vocab AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS slot,
                        ln((1 + (SELECT count(*) FROM {name}_docs)) / (1 + df)) + 1 AS idf, tf, df
                 FROM (SELECT term, count(*) AS tf, count(DISTINCT id) AS df FROM {name}_terms GROUP BY term
                       ORDER BY tf DESC, term LIMIT {features}))"""


def tfidf_vectors(name: str, vocab: str, source: str) -> str:
    """Unit TF-IDF rows ``<name> (id, slot, w)`` of ``source (id, text)``."""
    return f"""
{name}_docs AS (SELECT id, regexp_extract_all(lower(text), '{WORDS}') AS t FROM ({source})),
{name}_terms AS (SELECT id, unnest(t || list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS term FROM {name}_docs),
{name}_raw AS (SELECT id, slot, count(*) * any_value(idf) AS w FROM {name}_terms JOIN {vocab} USING (term) GROUP BY id, slot),
{name} AS (SELECT id, slot, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM {name}_raw)"""
