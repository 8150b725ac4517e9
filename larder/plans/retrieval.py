"""Similarity joins, top-k retrieval, screening, batch answering, languages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from larder import fixed
from larder.functions import text as tx
from larder.operators import answers, approximate, corpus, language, lexical, recommend, similarity
from larder.operators.similarity import Scoring
from larder.plans import views as v
from larder.plans.registry import Tables, query
from larder.session import fresh_path
from larder.sources.writers import save_table
from larder.plans.texts import TEMPLATE_SQL, lexicon_sql

SELF = Scoring(exclude_self=True)

VECTOR_SCORES = """
vectors AS (SELECT vec_id AS id, embedding::DOUBLE[] AS e, label FROM embeddings),
scores AS (SELECT a.id AS query_id, b.id AS item_id, round(list_dot_product(a.e, b.e), 8) AS score
           FROM vectors a JOIN vectors b ON a.id <> b.id)"""


@query("jon01_similarity_join", f"WITH {VECTOR_SCORES}, {v.ranked('top', 'scores', 5)} SELECT query_id, item_id, score, rank FROM top")
def _(t: Tables):
    """Every vector against every other one: the five best by cosine."""
    return similarity.top_k(v.vector_requests(t), v.vector_items(t), 5, SELF)


@query("jon01_similarity_join_blocks", f"WITH {VECTOR_SCORES}, {v.ranked('top', 'scores', 5)} SELECT query_id, item_id, score, rank FROM top")
def _(t: Tables):
    """The same join in the form used when requests are too many to broadcast."""
    return similarity.top_k(v.vector_requests(t), v.vector_items(t), 5, SELF, max_rows=0)


@query("jon01_similarity_join_pilot", f"WITH {VECTOR_SCORES}, {v.ranked('top', 'scores', 5)} SELECT query_id, item_id, score, rank FROM top")
def _(t: Tables):
    """The same join with a pilot pass that bounds every request's scores first."""
    return similarity.top_k(v.vector_requests(t), v.vector_items(t).repartition(8), 5, SELF, pilot=4)


@query(
    "jon02_similar_pairs",
    f"WITH {VECTOR_SCORES} SELECT query_id AS id_a, item_id AS id_b, score FROM scores WHERE query_id < item_id AND score >= 0.4",
)
def _(t: Tables):
    """All pairs at or above 0.40, each once."""
    return similarity.similar_pairs(v.vector_items(t), min_similarity=0.4)


@query(
    "jon05_attach_items",
    f"""WITH {VECTOR_SCORES}, {v.ranked('top', 'scores', 3)}
        SELECT query_id, item_id, score, rank, CAST(label AS BIGINT) AS label FROM top JOIN vectors ON id = item_id""",
)
def _(t: Tables):
    """Top-k joined back to its item columns by key."""
    labels = v.vector_items(t).select("item_id", "label")
    return similarity.top_k(v.vector_requests(t), v.vector_items(t), 3, SELF, attach=labels)


@query(
    "agg11_max_similarity",
    f"WITH {VECTOR_SCORES} SELECT query_id, max(score) AS max_similarity FROM scores GROUP BY query_id",
)
def _(t: Tables):
    return similarity.max_similarity(v.vector_requests(t), v.vector_items(t), SELF)


@query(
    "win01_ranked_top_k",
    """SELECT user_id AS query_id, event_id AS item_id, value AS score,
              row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rank FROM events QUALIFY rank <= 3""",
)
def _(t: Tables):
    """Plain top-k per key: a WindowGroupLimit runs below the exchange."""
    matches = t.events.select(F.col("user_id").alias("query_id"), F.col("event_id").alias("item_id"), F.col("value").alias("score"))
    return similarity.rank_matches(matches, 3)


@query(
    "win03_position_discount",
    """SELECT user_id, event_id, round(1 / log2(row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) + 1), 6) AS gain
       FROM events""",
)
def _(t: Tables):
    from larder.operators.evaluation import discount

    order = Window.partitionBy("user_id").orderBy(F.desc("value"), "event_id")
    ranked = t.events.select("user_id", "event_id", F.row_number().over(order).alias("rank"))
    return ranked.select("user_id", "event_id", F.round(discount("rank"), 6).alias("gain"))


@query(
    "ret02_vector_top_k_screened",
    f"""WITH {VECTOR_SCORES}, {v.ranked('top', 'scores', 5)}
        SELECT query_id, item_id, score, rank, CAST(label AS BIGINT) AS label,
               max(score) OVER (PARTITION BY query_id) >= 0.4 AS passed FROM top JOIN vectors ON id = item_id""",
)
def _(t: Tables):
    """Flagship: nearest items of every request with the screening verdict, from one pass."""
    labels = v.vector_items(t).select("item_id", "label")
    top = similarity.top_k(v.vector_requests(t), v.vector_items(t), 5, SELF, attach=labels)
    best = F.max("score").over(Window.partitionBy("query_id"))
    return top.withColumn("passed", answers.passes(best)).select("query_id", "item_id", "score", "rank", "label", "passed")


TEXT_SCORES = (
    v.BENCHMARK_REQUESTS + "," + v.DOCUMENT_ITEMS + ","
    + v.bow("asked", "SELECT query_id AS id, text FROM requests") + ","
    + v.bow("indexed", "SELECT item_id AS id, text_full AS text FROM items") + ","
    + v.scored("scores", "asked", "indexed", "SELECT query_id AS id FROM requests", "SELECT item_id AS id FROM items")
)


@query("ret02_text_top_k", f"WITH {TEXT_SCORES}, {v.ranked('top', 'scores', 5)} SELECT query_id, item_id, score, rank, category FROM top JOIN items USING (item_id)")
def _(t: Tables):
    """Free-text requests against the document index."""
    items = v.document_items(t)
    return recommend.by_text(v.benchmark_requests(t), recommend.build_index(items), attach=items.select("item_id", "category"))


@query(
    "ret02_recommendations",
    f"""WITH {TEXT_SCORES}, {v.ranked('top', 'scores', 5)},
        p AS (SELECT item_id, {lexicon_sql('ingredients || instructions', fixed.FLAVOR_LEXICON)} FROM items),
        long AS (SELECT item_id, k AS key, value FROM (UNPIVOT p ON {", ".join(fixed.FLAVOR_LEXICON)} INTO NAME k VALUE value))
        SELECT query_id, rank, item_id, name, category, score AS similarity_score, key, value
        FROM top JOIN items USING (item_id) JOIN long USING (item_id)""",
)
def _(t: Tables):
    """Published recommendations: item columns, score, and the profile as a map, shown entry by entry."""
    items = v.document_items(t)
    profiled = corpus.add_profile(items.withColumn("_all", F.concat("ingredients", "instructions")), text="_all")
    top = recommend.by_text(v.benchmark_requests(t), recommend.build_index(items), attach=profiled)
    published = top.select(*recommend.recommendation())
    return published.select(
        "query_id", "rank", "item_id", "name", "category", "similarity_score", F.explode("flavor_profile")
    )


@query(
    "ret02_category_strict",
    f"""WITH {TEXT_SCORES}, kept AS (SELECT s.* FROM scores s JOIN items USING (item_id) WHERE lower(category) = 'fr'),
        {v.ranked('top', 'kept', 5)} SELECT query_id, item_id, score, rank FROM top""",
)
def _(t: Tables):
    """Only items of one category: the predicate reaches the scan."""
    return recommend.by_text(v.benchmark_requests(t), recommend.build_index(v.document_items(t)), category="FR")


@query(
    "ret02_category_mask",
    f"""WITH {TEXT_SCORES}, kept AS (SELECT query_id, item_id, CASE WHEN lower(category) = 'es' THEN score ELSE -1.0 END AS score
        FROM scores JOIN items USING (item_id)), {v.ranked('top', 'kept', 200)} SELECT query_id, item_id, score, rank FROM top""",
)
def _(t: Tables):
    """Other categories score -1 and fill up the list: 200 results where fewer items may match."""
    index = recommend.build_index(v.document_items(t))
    return recommend.by_text(v.benchmark_requests(t), index, 200, category="es", mode="mask")


INGREDIENT_SCORES = (
    v.ITEMS + "," + v.INGREDIENT_REQUESTS + ","
    + v.bow("asked", "SELECT query_id AS id, 'cocktail avec ' || array_to_string(available, ', ') AS text FROM requests") + ","
    + v.bow("indexed", "SELECT item_id AS id, text_full AS text FROM items") + ","
    + v.scored("semantic", "asked", "indexed", "SELECT query_id AS id FROM requests", "SELECT item_id AS id FROM items") + """,
available AS (SELECT query_id, unnest(available) AS a, len(available) AS listed FROM requests),
found AS (SELECT query_id, item_id, count(*) / any_value(listed) AS share
          FROM available JOIN items ON contains(lower(ingredients), lower(a)) GROUP BY ALL),
raw AS (SELECT d.query_id, d.item_id, d.s FROM semantic_dots d),
scores AS (SELECT s.query_id, s.item_id, round(0.5 * coalesce(raw.s, 0) + 0.5 * coalesce(share, 0), 8) AS score
           FROM semantic s LEFT JOIN raw USING (query_id, item_id) LEFT JOIN found USING (query_id, item_id))"""
)


@query("ret03_by_ingredients", f"WITH {INGREDIENT_SCORES}, {v.ranked('top', 'scores', 5)} SELECT query_id, item_id, score, rank FROM top")
def _(t: Tables):
    """Half similarity, half coverage of the names on hand."""
    return recommend.by_ingredients(v.ingredient_requests(t), recommend.build_index(v.items(t)))


@query(
    "ret03_must_include",
    f"""WITH {INGREDIENT_SCORES}, kept AS (SELECT s.* FROM scores s JOIN items USING (item_id) JOIN requests USING (query_id)
        WHERE contains(lower(ingredients), lower(available[1]))), {v.ranked('top', 'kept', 5)}
        SELECT query_id, item_id, score, rank FROM top""",
)
def _(t: Tables):
    """As above, but every result must hold the required name."""
    return recommend.by_ingredients(v.ingredient_requests(t), recommend.build_index(v.items(t)), required="required")


@query("ret04_approximate_top_k")
def _(t: Tables):
    """Approximate top-k over a quantised index, and its recall against the exact result."""
    exact = similarity.top_k(v.vector_requests(t), v.vector_items(t), 5, SELF)
    return approximate.recall_against(exact, _quantised(t, approximate.fit_cells(v.vector_items(t), 32), 22))


def _quantised(t: Tables, centres, probes: int) -> DataFrame:
    """The five best by codes stored by cell, scored from the vectors of the candidates."""
    items, path = v.vector_items(t), fresh_path(t.spark, "code-index")
    books = approximate.fit_codebooks(items, centres, parts=32)
    approximate.build_code_index(items, books).write.partitionBy("cell").parquet(path)
    return approximate.quantised_top_k(v.vector_requests(t), t.spark.read.parquet(path), items, books, 5, probes, SELF)


@query("ret04_approximate_matches")
def _(t: Tables):
    """The matches of the approximate top-k."""
    return _quantised(t, approximate.fit_cells(v.vector_items(t), 32), 22).select("query_id", "item_id", "score", "rank")


PROBED_SQL = f"""WITH {VECTOR_SCORES},
    dims AS (SELECT label, unnest(range(1, len(e) + 1)) AS i, unnest(e) AS x FROM vectors),
    means AS (SELECT label, i, avg(x) AS x FROM dims GROUP BY ALL),
    centres AS (SELECT label, list(x ORDER BY i) AS m, sqrt(sum(x * x)) AS len FROM means GROUP BY label),
    near AS (SELECT id, c.label AS cell, row_number() OVER (PARTITION BY id ORDER BY list_dot_product(e, m) / len DESC, c.label) AS r FROM vectors CROSS JOIN centres c),
    probed AS (SELECT s.query_id, s.item_id, s.score FROM scores s JOIN near q ON q.id = s.query_id AND q.r <= 2
               JOIN near i ON i.id = s.item_id AND i.r = 1 AND i.cell = q.cell), {v.ranked('top', 'probed', 5)}
    SELECT query_id, item_id, score, rank FROM top"""


def _label_centres(t: Tables):
    """The mean vectors of the labels as unit centres, one for each label."""
    dims = v.vector_items(t).select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    means = dims.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("m")).orderBy("label")
    return approximate.unit_centres([[x["x"] for x in r["m"]] for r in means.collect()])


@query("ret04_probed_matches", PROBED_SQL)
def _(t: Tables):
    """The matches within the two nearest cells of each request; cells are the mean vectors of the labels, the index is stored by cell."""
    items, centres = v.vector_items(t), _label_centres(t)
    path = fresh_path(t.spark, "cell-index")
    approximate.build_cell_index(items, centres).write.partitionBy("cell").parquet(path)
    return approximate.probe_top_k(v.vector_requests(t), t.spark.read.parquet(path), centres, 5, 2, SELF)


@query("ret04_quantised_matches", PROBED_SQL)
def _(t: Tables):
    """The same matches from codes: candidates by their bounds, scored from the vectors."""
    return _quantised(t, _label_centres(t), 2).select("query_id", "item_id", "score", "rank")


LEXICAL_SCORES = (
    v.BENCHMARK_REQUESTS + "," + v.tfidf("fit", "SELECT doc_id AS id, text FROM documents") + ","
    + v.tfidf_vectors("asked", "fit_vocab", "SELECT query_id AS id, text FROM requests") + ","
    + v.tfidf_vectors("indexed", "fit_vocab", "SELECT doc_id AS id, text FROM documents") + ","
    + v.scored("scores", "asked", "indexed", "SELECT query_id AS id FROM requests", "SELECT doc_id AS id FROM documents")
)


@query("ret05_tfidf_vocabulary", f"WITH {v.tfidf('fit', 'SELECT doc_id AS id, text FROM documents')} SELECT term, slot::BIGINT AS slot, tf, df, round(idf, 6) AS idf FROM fit_vocab")
def _(t: Tables):
    """The 5000 most frequent words and word pairs with their weights."""
    vocab = lexical.fit(v.document_items(t)).vocabulary
    return vocab.select("term", F.col("slot").cast("long").alias("slot"), "tf", "df", F.round("idf", 6).alias("idf"))


@query(
    "ret05_tfidf_vectors",
    f"""WITH {v.tfidf('fit', 'SELECT doc_id AS id, text FROM documents')},
        {v.tfidf_vectors('vec', 'fit_vocab', 'SELECT doc_id AS id, text FROM documents')}
        SELECT id AS item_id, slot::BIGINT AS slot, round(w, 6) AS weight FROM vec""",
)
def _(t: Tables):
    vectors = lexical.fit(v.document_items(t)).item_vectors()
    return lexical.postings(vectors).select("item_id", F.col("slot").cast("long").alias("slot"), F.round("weight", 6).alias("weight"))


@query("ret05_tfidf_top_k", f"WITH {LEXICAL_SCORES}, {v.ranked('top', 'scores', 5)} SELECT query_id, item_id, score, rank FROM top")
def _(t: Tables):
    return lexical.by_text(v.benchmark_requests(t), lexical.fit(v.document_items(t)))


USER_SCORES = (
    v.USER_REQUESTS + "," + v.DOCUMENT_ITEMS + ","
    + v.bow("asked", "SELECT query_id AS id, text FROM requests") + ","
    + v.bow("indexed", "SELECT item_id AS id, text_full AS text FROM items") + ","
    + v.scored("scores", "asked", "indexed", "SELECT query_id AS id FROM requests", "SELECT item_id AS id FROM items")
)


@query(
    "ret06_guardrail",
    f"WITH {USER_SCORES} SELECT query_id, max(score) AS max_similarity, max(score) >= 0.4 AS passed FROM scores GROUP BY query_id",
)
def _(t: Tables):
    """Every user turn against the document index."""
    return answers.guardrail(v.user_requests(t).select("query_id", "text"), recommend.build_index(v.document_items(t)))


CONTEXT_SQL = """string_agg('Cocktail : ' || name || chr(10) || 'Categorie : ' || category || chr(10) || 'Ingredients : ' || ingredients
        || chr(10) || 'Instructions : ' || instructions || chr(10), chr(10) || '---' || chr(10) ORDER BY rank)"""


@query(
    "str11_context",
    f"""WITH {TEXT_SCORES}, {v.ranked('top', 'scores', 3)}
        SELECT query_id, {CONTEXT_SQL} AS context, max(score) AS max_similarity FROM top JOIN items USING (item_id) GROUP BY query_id""",
)
def _(t: Tables):
    """The retrieved items of each request as one context text."""
    items = v.document_items(t)
    matches = recommend.by_text(v.benchmark_requests(t), recommend.build_index(items), 3, attach=items.drop("text_full"))
    return answers.contexts(matches).select("query_id", "context", "max_similarity")


def profile_sql() -> str:
    rows = ", ".join(f"('{lang}', [{', '.join(repr(w) for w in words)}])" for lang, words in language.PROFILES.items())
    return f"profiles AS (SELECT * FROM (VALUES {rows}) p(lang, words))"


def detected_sql(name: str, source: str) -> str:
    """``<name> (id, lang)`` for ``source (id, text)``."""
    return f"""
{name}_tokens AS (SELECT id, regexp_extract_all(lower(text), '\\p{{L}}+') AS tokens FROM ({source})),
{name}_hits AS (SELECT id, lang, len(list_filter(tokens, lambda x: list_contains(words, x))) AS hits FROM {name}_tokens CROSS JOIN profiles),
{name} AS (SELECT id, CASE WHEN hits > 0 THEN lang ELSE 'unknown' END AS lang FROM {name}_hits
           QUALIFY row_number() OVER (PARTITION BY id ORDER BY hits DESC, lang) = 1)"""


@query(
    "ret02_category_per_request",
    f"""WITH {profile_sql()}, {detected_sql('spoken', 'SELECT item_id AS id, text FROM benchmark')}, {TEXT_SCORES},
        kept AS (SELECT s.* FROM scores s JOIN items USING (item_id) JOIN spoken ON spoken.id = query_id WHERE category = spoken.lang),
        {v.ranked('top', 'kept', 5)} SELECT query_id, item_id, score, rank FROM top""",
)
def _(t: Tables):
    """Each request is answered from the items of its own detected language."""
    asked = language.detect(v.benchmark_requests(t), "text", "spoken")
    return recommend.by_text(asked, recommend.build_index(v.document_items(t)), category_column="spoken")


@query("ret09_detect_language", f"WITH {profile_sql()}, {detected_sql('found', 'SELECT doc_id AS id, text FROM documents')} SELECT id AS doc_id, lang AS detected FROM found")
def _(t: Tables):
    return language.detect(t.spread("documents").select("doc_id", "text"), "text").select("doc_id", "detected")


@query(
    "ret09_detection_accuracy",
    f"""WITH {profile_sql()}, {detected_sql('found', 'SELECT doc_id AS id, text FROM documents')}
        SELECT d.lang AS lang, found.lang AS detected, count(*) AS n FROM documents d JOIN found ON id = doc_id GROUP BY ALL""",
)
def _(t: Tables):
    """Detected against given language, as a confusion table."""
    found = language.detect(t.spread("documents").select("doc_id", "text", "lang"), "text")
    return found.groupBy("lang", "detected").agg(F.count("*").alias("n"))


RANKS_SQL = f"""WITH lines AS (SELECT doc_id AS id, lang, CASE WHEN len(tokens) > 0 THEN string_split(' ' || array_to_string(tokens, ' ') || ' ', '') ELSE [] END AS chars
        FROM (SELECT doc_id, lang, regexp_extract_all(lower(text), '\\p{{L}}+') AS tokens FROM documents)),
    grams AS (SELECT id, lang, unnest(list_transform(range(1, greatest(len(chars) - 1, 1)), lambda i: chars[i] || chars[i + 1] || chars[i + 2])) AS gram FROM lines),
    own AS (SELECT id, gram, row_number() OVER (PARTITION BY id ORDER BY count(*) DESC, gram) - 1 AS rank FROM grams GROUP BY id, gram
            QUALIFY rank < {language.PROFILE_SIZE}),
    learned AS (SELECT lang, gram, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, gram) - 1 AS rank FROM grams WHERE lang IS NOT NULL
                GROUP BY lang, gram QUALIFY rank < {language.PROFILE_SIZE}),
    away AS (SELECT id, l.lang, sum(coalesce(abs(o.rank - p.rank), {language.PROFILE_SIZE})) AS distance
             FROM own o CROSS JOIN (SELECT DISTINCT lang FROM learned) l LEFT JOIN learned p ON p.lang = l.lang AND p.gram = o.gram GROUP BY id, l.lang),
    best AS (SELECT id, lang, distance FROM away QUALIFY row_number() OVER (PARTITION BY id ORDER BY distance, lang) = 1)
    SELECT doc_id, coalesce(best.lang, 'unknown') AS detected, CAST(distance AS BIGINT) AS distance FROM documents LEFT JOIN best ON id = doc_id"""


@query("ret09_rank_profiles", RANKS_SQL)
def _(t: Tables):
    """The language of every document by the three-character runs that the labelled documents teach."""
    docs = t.spread("documents").select("doc_id", "text", "lang")
    profiles = language.RankProfiles.of(language.learn_profiles(docs))
    return language.detect_by_ranks(docs.select("doc_id", "text"), "text", profiles).drop("text")


def dictionary_sql() -> str:
    rows = ", ".join(f"('{g}', '{w}', '{e}')" for g, words in language.DICTIONARY.items() for w, e in words.items())
    return f"dictionary AS (SELECT * FROM (VALUES {rows}) d(lang, word, english))"


def translated_sql(source: str) -> str:
    """``english (id, english, was_translated)`` for ``source (id, text)``."""
    return f"""{profile_sql()}, {dictionary_sql()}, {detected_sql('found', source)},
given AS (SELECT s.id, s.text, f.lang FROM ({source}) s JOIN found f USING (id)),
runs AS (SELECT id, lang, regexp_extract_all(text, '\\p{{L}}+|[^\\p{{L}}]+') AS run FROM given),
tokens AS (SELECT id, lang, unnest(run) AS token, unnest(range(len(run))) AS place FROM runs),
made AS (SELECT id, string_agg(coalesce(english, token), '' ORDER BY place) AS line
         FROM tokens t LEFT JOIN dictionary d ON d.lang = t.lang AND d.word = lower(t.token) GROUP BY id),
english AS (SELECT id, text, CASE WHEN changed THEN line ELSE text END AS english, changed AS was_translated
            FROM (SELECT g.id, text, line, lang NOT IN ('en', 'unknown') AND lower(trim(line)) <> lower(trim(text)) AS changed
                  FROM given g LEFT JOIN made USING (id)))"""


@query(
    "ret10_to_english",
    f"WITH {translated_sql('SELECT conv_id * 1000 + turn AS id, text FROM conversations')} SELECT id AS query_id, english, was_translated FROM english",
)
def _(t: Tables):
    """Every conversation turn in the index language, translated word by word where it is foreign."""
    turns = t.conversations.select((F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"), "text")
    return language.to_english(turns).select("query_id", "english", "was_translated")


ANSWER_SQL = f"""WITH {translated_sql("SELECT conv_id * 1000 + turn AS id, text FROM conversations WHERE role = 'user'")},
    {v.DOCUMENT_ITEMS}, {v.bow('asked', 'SELECT id, english AS text FROM english')},
    {v.bow('indexed', 'SELECT item_id AS id, text_full AS text FROM items')},
    {v.scored('scores', 'asked', 'indexed', 'SELECT id FROM english', 'SELECT item_id AS id FROM items')},
    {v.ranked('top', 'scores', 3)},
    contexts AS (SELECT query_id, {CONTEXT_SQL} AS context, max(score) AS best,
                        string_agg(item_id, ',' ORDER BY rank) AS found FROM top JOIN items USING (item_id) GROUP BY query_id),
    known AS (SELECT text, 'stored: ' || any_value(text) AS value FROM conversations WHERE role = 'user' AND turn = 0 GROUP BY text)
    SELECT query_id, CASE WHEN best >= {{threshold}} THEN 'success' ELSE 'rejected' END AS status,
           CASE WHEN best >= {{threshold}} THEN NULL ELSE 'Requete hors-domaine cocktails.' END AS reason, best AS max_similarity,
           CASE WHEN best >= {{threshold}} THEN found END AS retrieved,
           CASE WHEN best < {{threshold}} THEN NULL WHEN value IS NOT NULL THEN value
                ELSE {TEMPLATE_SQL.format('english', 'context')} END AS generated_recipe,
           value IS NOT NULL AND best >= {{threshold}} AS cached, e.text AS original_query,
           CASE WHEN was_translated THEN english END AS translated_query
    FROM english e JOIN contexts c ON c.query_id = e.id LEFT JOIN known k ON k.text = e.text"""


def _stored_answers(t: Tables, settings: answers.AnswerSettings):
    """First turns were answered before."""
    first = v.user_requests(t).where("turn = 0").select("text").distinct()
    return first.select(answers.answer_key("text", settings).alias("key"), F.concat(F.lit("stored: "), "text").alias("value"))


def _flat(answered):
    ids = F.array_join(F.transform("retrieved", lambda i: i["item_id"].cast("string")), ",")
    return answered.withColumn("retrieved", ids).drop("key")


@query("ret07_batch_answers", ANSWER_SQL.replace("{threshold}", "0.4"))
def _(t: Tables):
    """Translate, screen, look up, retrieve, assemble and answer every user turn in one plan."""
    settings = answers.AnswerSettings(corpus_version="documents")
    items = v.document_items(t)
    asked = v.user_requests(t).select("query_id", "text")
    return _flat(answers.answer(asked, recommend.build_index(items), items, settings, cache=_stored_answers(t, settings)))


@query("ret07_batch_answers_strict", ANSWER_SQL.replace("{threshold}", "0.7"))
def _(t: Tables):
    """The same with a higher threshold, so that requests are rejected."""
    settings = answers.AnswerSettings(threshold=0.7, corpus_version="documents")
    items = v.document_items(t)
    asked = v.user_requests(t).select("query_id", "text")
    return _flat(answers.answer(asked, recommend.build_index(items), items, settings, cache=_stored_answers(t, settings)))


THROUGH_SQL = f"""WITH {translated_sql("SELECT conv_id * 1000 + turn AS id, CASE WHEN conv_id % 10 = 3 THEN ' ' ELSE text END AS text FROM conversations WHERE role = 'user'")},
    {v.DOCUMENT_ITEMS}, {v.bow('asked', 'SELECT id, english AS text FROM english')},
    {v.bow('indexed', 'SELECT item_id AS id, text_full AS text FROM items')},
    {v.scored('scores', 'asked', 'indexed', 'SELECT id FROM english', 'SELECT item_id AS id FROM items')},
    {v.ranked('top', 'scores', 3)},
    contexts AS (SELECT query_id, {CONTEXT_SQL} AS context, max(score) AS best FROM top JOIN items USING (item_id) GROUP BY query_id)
    SELECT run, query_id, CASE WHEN trim(text) = '' THEN 'empty' WHEN best >= 0.4 THEN 'success' ELSE 'rejected' END AS status,
           run = 'warm' AND trim(text) <> '' AND best >= 0.4 AS cached,
           CASE WHEN trim(text) <> '' AND best >= 0.4 THEN {TEMPLATE_SQL.format('english', 'context')} END AS generated_recipe
    FROM english e JOIN contexts c ON c.query_id = e.id CROSS JOIN (VALUES ('cold'), ('warm')) r(run)"""


@query("ret07_through_cache", THROUGH_SQL)
def _(t: Tables):
    """Every user turn twice through one cache: the first run fills it, the second is served from it; blank turns are ``empty``."""
    settings = answers.AnswerSettings(corpus_version="documents")
    items = v.document_items(t)
    index = save_table(recommend.build_index(items, keep=[]), fresh_path(t.spark, "index"))
    blank = F.when(F.floor(F.col("query_id") / 1000) % 10 == 3, " ").otherwise(F.col("text"))
    asked = v.user_requests(t).select("query_id", blank.alias("text"))
    path = fresh_path(t.spark, "answer-cache")
    runs = [answers.answer_through_cache(asked, index, items, path, settings).withColumn("run", F.lit(run)) for run in ("cold", "warm")]
    return runs[0].unionByName(runs[1]).select("run", "query_id", "status", "cached", "generated_recipe")


@query(
    "ret01_embed_cached",
    """SELECT doc_id AS item_id, CAST(length(text) AS DOUBLE) AS chars, CAST(length(text) - length(replace(text, ' ', '')) AS DOUBLE) AS blanks,
              CASE WHEN text IN (SELECT text FROM documents WHERE doc_id % 2 = 0) THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS run FROM documents""",
)
def _(t: Tables):
    """A plug-in model behind the content cache: texts of a first run over the even ids are not computed again in the second."""

    def model(run: float):
        def encode(frames):
            for frame in frames:
                yield frame.assign(value=[[float(len(p)), float(p.count(" ")), run] for p in frame.payload])[["key", "value"]]

        return encode

    path = fresh_path(t.spark, "vector-cache")
    docs = t.documents.select(F.col("doc_id").alias("item_id"), "text")
    recommend.embed_cached(docs.where("item_id % 2 = 0"), "text", "lengths", model(1.0), path)
    made = recommend.embed_cached(docs, "text", "lengths", model(2.0), path)
    return made.select("item_id", *[F.col("embedding")[i].cast("double").alias(name) for i, name in enumerate(("chars", "blanks", "run"))])


@query(
    "ret08_generator_with_fallback",
    f"""WITH {TEXT_SCORES}, {v.ranked('top', 'scores', 3)},
        contexts AS (SELECT query_id, {CONTEXT_SQL} AS context, max(score) AS best FROM top JOIN items USING (item_id) GROUP BY query_id)
        SELECT query_id, CASE WHEN best < 0.4 THEN NULL
            WHEN length('{fixed.PROMPT_HEAD}' || context || '{fixed.PROMPT_REQUEST}' || text || '{fixed.PROMPT_TAIL}') % 2 = 0
            THEN 'words: ' || length('{fixed.PROMPT_HEAD}' || context || '{fixed.PROMPT_REQUEST}' || text || '{fixed.PROMPT_TAIL}')
            ELSE {TEMPLATE_SQL.format('text', 'context')} END AS generated_recipe
        FROM contexts JOIN requests USING (query_id)""",
)
def _(t: Tables):
    """A plug-in generator that fails on some prompts; the template answers those."""

    def generator(frames):
        for frame in frames:
            size = frame.payload.str.len()
            value = ("words: " + size.astype(str)).where(size % 2 == 0, None)
            yield frame.assign(value=value)[["key", "value"]]

    items = v.document_items(t)
    settings = answers.AnswerSettings(translate=False, model="plugin")
    answered = answers.answer(v.benchmark_requests(t), recommend.build_index(items), items, settings, generator=generator)
    return answered.select("query_id", "generated_recipe")


_PROMPT_SQL = f"length('{fixed.PROMPT_HEAD}' || context || '{fixed.PROMPT_REQUEST}' || text || '{fixed.PROMPT_TAIL}')"


@query(
    "ret08_translated_answer",
    f"""WITH {TEXT_SCORES}, {v.ranked('top', 'scores', 3)},
        contexts AS (SELECT query_id, {CONTEXT_SQL} AS context, max(score) AS best FROM top JOIN items USING (item_id) GROUP BY query_id)
        SELECT query_id, CASE WHEN best < {fixed.GUARDRAIL_THRESHOLD} THEN NULL WHEN {_PROMPT_SQL} % 2 = 0 THEN 'le verre avec la menthe ' || {_PROMPT_SQL}
            ELSE 'fr: the glass with the mint ' || {_PROMPT_SQL} END AS generated_recipe
        FROM contexts JOIN requests USING (query_id)""",
)
def _(t: Tables):
    """Generated answers in the user's language: those already in it stay, the others go through the translator once each."""

    def generator(frames):
        for frame in frames:
            size = frame.payload.str.len()
            english = "the glass with the mint " + size.astype(str)
            yield frame.assign(value=english.where(size % 2 == 1, "le verre avec la menthe " + size.astype(str)))[["key", "value"]]

    def translator(frames):
        for frame in frames:
            yield frame.assign(value="fr: " + frame.payload)[["key", "value"]]

    items = v.document_items(t)
    settings = answers.AnswerSettings(translate=False, model="plugin", language="fr")
    answered = answers.answer(v.benchmark_requests(t), recommend.build_index(items), items, settings, generator=generator, translator=translator)
    return answered.select("query_id", "generated_recipe")
