"""Scalar text, vector and map functions, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder import fixed
from larder.functions import text as tx, vector as vx
from larder.operators import corpus, evaluation
from larder.plans import views as v
from larder.plans.ingest import CLEAN_INGREDIENTS_SQL, CLEAN_TEXT_SQL
from larder.plans.registry import Tables, query

SQUEEZE = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"
TOKENS = "list_filter(regexp_split_to_array(lower({0}), '\\s+'), lambda x: x <> '')"


@query("flt01_category_equality", f"WITH {v.RECIPES} SELECT item_id, category FROM recipes WHERE lower(category) = lower('2-high')")
def _(t: Tables):
    return v.recipes(t).select("item_id", "category").where(F.lower("category") == "2-high")


@query(
    "flt02_must_include",
    f"WITH {v.RECIPES} SELECT item_id FROM recipes WHERE contains(lower(ingredients), 'old') AND contains(lower(ingredients), 'gear')",
)
def _(t: Tables):
    required = F.array(F.lit("OLD"), F.lit("gear"))
    return v.recipes(t).where(tx.includes_all(required, "ingredients")).select("item_id")


@query(
    "flt03_corpus_search",
    f"WITH {v.RECIPES} SELECT item_id FROM recipes WHERE contains(lower(name), 'blue ring') OR contains(lower(ingredients), 'blue ring')",
)
def _(t: Tables):
    return v.recipes(t).where(tx.matches_search("Blue Ring", ["name", "ingredients"])).select("item_id")


@query(
    "flt03_corpus_search_regex",
    f"""WITH {v.RECIPES} SELECT item_id FROM recipes
        WHERE regexp_matches(lower(name), '^(cold|hot) .*7$') OR regexp_matches(lower(ingredients), '^(cold|hot) .*7$')""",
)
def _(t: Tables):
    return v.recipes(t).where(tx.matches_search("^(cold|hot) .*7$", ["name", "ingredients"], regex=True)).select("item_id")


@query(
    "flt04_long_tokens",
    f"SELECT doc_id, unnest(list_filter({TOKENS.format('text')}, lambda x: length(x) > 2)) AS token FROM documents",
)
def _(t: Tables):
    tokens = t.spread("documents").select("doc_id", F.explode(tx.whitespace_tokens("text")).alias("token"))
    return tokens.where(F.length("token") >= fixed.MIN_TERM_CHARS)


@query(
    "flt05_usable_queries",
    """SELECT vec_id AS query_id FROM embeddings a WHERE EXISTS (SELECT 1 FROM embeddings b WHERE b.label = a.label AND b.vec_id <> a.vec_id)""",
)
def _(t: Tables):
    """Queries that have a relevant item at all."""
    counts = t.embeddings.groupBy("label").agg(F.count("*").alias("n")).where("n > 1").select("label")
    relevant = t.embeddings.join(counts, "label", "left_semi").select(F.col("vec_id").alias("query_id"))
    return evaluation.first_queries(v.vector_requests(t).select("query_id"), relevant, None)


@query(
    "flt06_blank_requests",
    """SELECT conv_id, turn, CASE WHEN regexp_replace(t, '\\s+', '', 'g') = '' THEN 'empty' ELSE 'asked' END AS status
       FROM (SELECT conv_id, turn, CASE WHEN role = 'system' THEN chr(9) || ' ' || chr(10) ELSE text END AS t FROM conversations)""",
)
def _(t: Tables):
    """System turns are blanked to whitespace; they must be told apart from requests."""
    blanked = F.when(F.col("role") == "system", F.lit("\t \n")).otherwise(F.col("text"))
    status = F.when(tx.is_blank(blanked), "empty").otherwise("asked")
    return t.conversations.select("conv_id", "turn", status.alias("status"))


@query(
    "str01_name_key",
    f"SELECT doc_id, regexp_replace({SQUEEZE.format('lower(text)')}, '\\s+', ' ', 'g') AS key FROM documents",
)
def _(t: Tables):
    return t.spread("documents").select("doc_id", tx.name_key("text").alias("key"))


@query("str02_clean_text", f"SELECT doc_id, {CLEAN_TEXT_SQL.format('text')} AS cleaned FROM documents")
def _(t: Tables):
    return t.spread("documents").select("doc_id", tx.clean_text("text").alias("cleaned"))


@query("str03_clean_ingredients", f"WITH {v.RECIPES} SELECT item_id, {CLEAN_INGREDIENTS_SQL.format('ingredients')} AS cleaned FROM recipes")
def _(t: Tables):
    return v.recipes(t).select("item_id", tx.clean_ingredients("ingredients").alias("cleaned"))


@query(
    "str04_strip_measure",
    f"""WITH {v.RECIPES} SELECT item_id,
        regexp_replace(ingredients, '{fixed.MEASURE_PATTERNS["index"]}', '', 'g') AS by_index,
        regexp_replace(ingredients, '{fixed.MEASURE_PATTERNS["explore"]}', '', 'g') AS by_explore,
        regexp_replace(ingredients, '{fixed.MEASURE_PATTERNS["browse"]}', '', 'g') AS by_browse FROM recipes""",
)
def _(t: Tables):
    return v.recipes(t).select(
        "item_id", *[tx.strip_measure("ingredients", x).alias(f"by_{x}") for x in ("index", "explore", "browse")]
    )


def lexicon_sql(text: str, lexicon: dict[str, list[str]], prefix: str = "") -> str:
    def one(name, words):
        hits = " + ".join(f"contains(lower({text}), '{w}')::INT" for w in words)
        return f"least(({hits}) / 3.0, 1.0)::DOUBLE AS {prefix}{name}"

    return ", ".join(one(name, words) for name, words in lexicon.items())


@query("str05_lexicon_score", f"WITH {v.RECIPES} SELECT item_id, {lexicon_sql('ingredients', v.LEXICON)} FROM recipes")
def _(t: Tables):
    return corpus.add_profile(v.recipes(t).select("item_id", "ingredients"), v.LEXICON).drop("ingredients")


@query("str05_default_lexicon", f"SELECT doc_id, {lexicon_sql('text', fixed.FLAVOR_LEXICON)} FROM documents")
def _(t: Tables):
    return corpus.add_profile(t.spread("documents").select("doc_id", "text"), text="text").drop("text")


@query(
    "str06_coverage",
    f"""WITH {v.RECIPES} SELECT item_id, (contains(lower(ingredients), 'old')::INT + contains(lower(ingredients), 'red rod')::INT
        + contains(lower(ingredients), 'plate')::INT) / 3 AS coverage, 0.0::DOUBLE AS nothing FROM recipes""",
)
def _(t: Tables):
    available = F.array(F.lit("Old"), F.lit("red rod"), F.lit("plate"))
    nothing = tx.coverage(F.array().cast("array<string>"), "ingredients")
    return v.recipes(t).select("item_id", tx.coverage(available, "ingredients").alias("coverage"), nothing.alias("nothing"))


@query("str07_content_key", "SELECT doc_id, md5('hashed' || chr(1) || text || chr(1) || '3') AS key FROM documents")
def _(t: Tables):
    return t.documents.select("doc_id", tx.content_key(F.lit("hashed"), "text", F.lit(3)).alias("key"))


@query(
    "str08_split_list",
    f"""WITH {v.RECIPES} SELECT item_id, unnest(list_filter(list_transform(string_split(ingredients, ','), lambda x: trim(x)),
        lambda x: x <> '')) AS part FROM recipes""",
)
def _(t: Tables):
    return v.recipes(t).select("item_id", F.explode(tx.split_list("ingredients")).alias("part"))


@query(
    "set03_common_elements",
    f"""WITH {v.TURN_PAIRS} SELECT pair_id, CAST(len(list_intersect(list_distinct({TOKENS.format('generated')}),
        list_distinct({TOKENS.format('reference')}))) AS BIGINT) AS common FROM pairs""",
)
def _(t: Tables):
    """Words that an assistant turn shares with the user turn before it, duplicates collapsed."""
    common = F.array_intersect(tx.whitespace_tokens("generated"), tx.whitespace_tokens("reference"))
    return v.turn_pairs(t).select("pair_id", F.size(common).cast("long").alias("common"))


@query("str09_word_count", f"SELECT doc_id, CAST(len({TOKENS.format('text')}) AS BIGINT) AS words FROM documents")
def _(t: Tables):
    return t.documents.select("doc_id", tx.word_count("text").alias("words"))


def html_sql(text: str) -> str:
    escaped = text
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("''", "&#x27;")):
        escaped = f"replace({escaped}, '{char}', '{entity}')"
    bold = f"regexp_replace({escaped}, '\\*\\*(.+?)\\*\\*', '<strong>\\1</strong>', 'g')"
    return f"replace(regexp_replace({bold}, '(?m)^[-*]\\s+', '&bull; ', 'g'), chr(10), '<br>')"


@query(
    "str10_html",
    f"""SELECT page_id AS id, {html_sql('html')} AS html FROM pages
        UNION ALL SELECT conv_id * 1000 + turn, {html_sql("'- **' || role || '**' || chr(10) || text")} FROM conversations""",
)
def _(t: Tables):
    turns = F.concat(F.lit("- **"), F.col("role"), F.lit("**\n"), F.col("text"))
    said = t.conversations.select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), tx.html_of(turns).alias("html"))
    return t.pages.select(F.col("page_id").alias("id"), tx.html_of("html").alias("html")).union(said)


@query(
    "str12_answer_prompt",
    f"""WITH {v.RECIPES} SELECT item_id, '{fixed.PROMPT_HEAD}' || ingredients || '{fixed.PROMPT_REQUEST}' || name || '{fixed.PROMPT_TAIL}'
        AS prompt FROM recipes""",
)
def _(t: Tables):
    return v.recipes(t).select("item_id", tx.answer_prompt("ingredients", "name").alias("prompt"))


TEMPLATE_SQL = (
    "'Recette generee pour ''' || {0} || ''' (mode template)' || chr(10) || chr(10) || "
    "array_to_string(list_slice(string_split({1}, chr(10)), 1, 6), chr(10)) || '" + fixed.TEMPLATE_TAIL + "'"
)


@query("str13_template_answer", f"SELECT doc_id, {TEMPLATE_SQL.format('lang', 'text')} AS answer FROM documents")
def _(t: Tables):
    return t.documents.select("doc_id", tx.template_answer("lang", "text").alias("answer"))


@query(
    "str14_ingredient_request",
    f"""WITH {v.INGREDIENT_REQUESTS} SELECT query_id, 'cocktail avec ' || array_to_string(available, ', ') AS request,
        'Recette avec ' || array_to_string(available, ', ') || ' :' || chr(10) || 'Nom : ' AS prompt FROM requests""",
)
def _(t: Tables):
    return v.ingredient_requests(t).select(
        "query_id", tx.ingredient_request("available").alias("request"), tx.generation_prompt("available").alias("prompt")
    )


@query(
    "srt04_first_lines",
    "SELECT doc_id, array_to_string(list_slice(string_split(text, chr(10)), 1, 6), chr(10)) AS head FROM documents",
)
def _(t: Tables):
    return t.documents.select("doc_id", tx.first_lines("text").alias("head"))


@query(
    "mth01_clip_and_round",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(least(l_quantity / 30.0, 1.0), 4) AS clipped,
              round(l_extendedprice / greatest(l_quantity, 1), 8) AS unit, round(log2(l_quantity + 1), 4) AS log FROM lineitem""",
)
def _(t: Tables):
    q = F.col("l_quantity")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.round(F.least(q / 30.0, F.lit(1.0)), 4).alias("clipped"),
        F.round(F.col("l_extendedprice") / F.greatest(q, F.lit(1.0)), 8).alias("unit"),
        F.round(F.log2(q + 1), 4).alias("log"),
    )


@query(
    "vec01_dot",
    """SELECT a.vec_id, round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS dot
       FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
)
def _(t: Tables):
    """Each vector with its successor."""
    other = t.embeddings.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    return t.embeddings.join(other, "vec_id").select("vec_id", F.round(vx.dot("embedding", "next"), 6).alias("dot"))


@query(
    "vec02_normalise",
    """WITH scaled AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE * label) AS e FROM embeddings),
       sized AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM scaled)
       SELECT vec_id, pos, round(CASE WHEN n = 0 THEN e[pos] ELSE e[pos] / n END, 6) + 0.0 AS value
       FROM (SELECT vec_id, e, n, unnest(range(1, len(e) + 1)) AS pos FROM sized)""",
)
def _(t: Tables):
    """Vectors scaled by their label and back to unit length; label 0 leaves a zero vector."""
    scaled = t.embeddings.select("vec_id", F.transform("embedding", lambda x: x.cast("double") * F.col("label")).alias("e"))
    entries = scaled.select("vec_id", F.posexplode(vx.normalised("e")).alias("pos", "value"))
    return entries.select("vec_id", (F.col("pos") + 1).cast("long").alias("pos"), (F.round("value", 6) + 0.0).alias("value"))


@query(
    "vec03_dimension_check",
    """SELECT count(*) AS vectors, CAST(min(len(embedding)) AS BIGINT) AS min_dim, CAST(max(len(embedding)) AS BIGINT) AS max_dim,
              round(max(abs(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) - 1)), 4) AS norm_error FROM embeddings""",
)
def _(t: Tables):
    return t.embeddings.agg(
        F.count("*").alias("vectors"), F.min(F.size("embedding")).cast("long").alias("min_dim"),
        F.max(F.size("embedding")).cast("long").alias("max_dim"),
        F.round(F.max(F.abs(vx.l2_norm("embedding") - 1)), 4).alias("norm_error"),
    )


@query(
    "map01_profile_map",
    f"""WITH {v.RECIPES}, p AS (SELECT item_id, {lexicon_sql('ingredients', v.LEXICON)} FROM recipes)
        SELECT item_id, k AS key, value FROM (UNPIVOT p ON {", ".join(v.LEXICON)} INTO NAME k VALUE value)""",
)
def _(t: Tables):
    """Profile columns as one map, shown entry by entry."""
    scored = corpus.add_profile(v.recipes(t).select("item_id", "ingredients"), v.LEXICON)
    return scored.select("item_id", F.explode(corpus.profile_map(v.LEXICON)))
