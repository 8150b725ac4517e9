"""Batch answering, result cache and languages."""

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from larder.operators import answers, language
from larder.operators.answers import AnswerSettings


def toy(c):
    """Two-dimensional vectors: share of gin and of rum; everything else is off the domain."""
    text = F.lower(c)
    return F.array(F.contains(text, F.lit("gin")).cast("float"), F.contains(text, F.lit("rum")).cast("float"))


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(1, "Gimlet", "Sour", "gin, lime", "shake"), (2, "Daiquiri", "Sour", "rum, lime", "shake"), (3, "Martini", "Dry", "gin", "stir")]
    return spark.createDataFrame(rows, "item_id long, name string, category string, ingredients string, instructions string")


@pytest.fixture(scope="module")
def index(corpus):
    return corpus.select("item_id", toy(F.col("ingredients")).alias("embedding"))


def asked(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "query_id long, text string")


def run(spark, index, corpus, texts, **options):
    settings = options.pop("settings", AnswerSettings(translate=False, corpus_version="1"))
    rows = answers.answer(asked(spark, texts), index, corpus, settings, embedder=toy, **options).collect()
    return {r.query_id: r for r in rows}


def test_four_outcomes(spark, index, corpus):
    settings = AnswerSettings(translate=False, corpus_version="1")
    cache = asked(spark, ["rum"]).select(answers.answer_key("text", settings).alias("key"), F.lit("stored").alias("value"))
    got = run(spark, index, corpus, ["gin", "bike repair", "rum", " \n", None], cache=cache)
    assert [got[i].status for i in range(5)] == ["success", "rejected", "success", "empty", "empty"]
    assert [got[i].cached for i in range(5)] == [False, False, True, False, False]
    assert got[1].reason and got[1].generated_recipe is None and got[1].retrieved is None and got[1].max_similarity == 0.0
    assert got[2].generated_recipe == "stored" and [r.name for r in got[2].retrieved][0] == "Daiquiri"
    assert got[0].reason is None and got[0].max_similarity == 1.0
    assert [(r.rank, r.name) for r in got[0].retrieved] == [(1, "Gimlet"), (2, "Martini"), (3, "Daiquiri")]
    assert got[0].generated_recipe.startswith(
        "Recette generee pour 'gin' (mode template)\n\nCocktail : Gimlet\nCategorie : Sour\nIngredients : gin, lime\n"
        "Instructions : shake\n\n---\n\nPreparation"
    )


def test_no_index_passes_with_one(spark, corpus):
    got = run(spark, None, corpus, ["bike", ""])
    assert (got[0].status, got[0].max_similarity, got[1].status) == ("success", 1.0, "empty")
    verdict = answers.guardrail(asked(spark, ["bike"]), None).first()
    assert verdict.passed and verdict.max_similarity == 1.0


def test_retrieval_only(spark, index, corpus):
    got = run(spark, index, corpus, ["gin"], settings=AnswerSettings(translate=False, generate=False))
    assert got[0].status == "success" and got[0].generated_recipe is None and len(got[0].retrieved) == 3


def test_generator_sees_each_prompt_once_and_falls_back(spark, index, corpus):
    def generator(frames):
        for frame in frames:
            assert frame.key.is_unique and frame.payload.str.contains("Request: ").all()
            value = frame.payload.str.extract(r"Request: (.*)\n")[0].map(lambda q: None if "fail" in q else f"made {q}")
            yield frame.assign(value=value)[["key", "value"]]

    got = run(spark, index, corpus, ["gin", "gin", "gin fail", "bike"], generator=generator)
    assert got[0].generated_recipe == got[1].generated_recipe == "made gin"
    assert got[2].generated_recipe.startswith("Recette generee pour 'gin fail'")
    assert got[3].generated_recipe is None


def test_second_run_is_cached_and_replays_do_not_duplicate(spark, index, corpus, folder):
    texts = ["gin", "gin", "rum", "bike", ""]
    settings = AnswerSettings(translate=False, corpus_version="1")
    path = f"{folder}/cache"
    first = answers.answer_through_cache(asked(spark, texts), index, corpus, path, settings, embedder=toy)
    assert sorted(r.cached for r in first.collect()) == [False] * 5
    assert spark.read.parquet(path).count() == 2  # rejected and blank requests are not stored
    second = {r.query_id: r for r in answers.answer_through_cache(asked(spark, texts), index, corpus, path, settings, embedder=toy).collect()}
    assert [second[i].cached for i in range(5)] == [True, True, True, False, False]
    assert len(second[0].retrieved) == 3  # a hit keeps its retrieved list
    other = AnswerSettings(translate=False, temperature=0.1, corpus_version="1")
    assert not any(r.cached for r in answers.answer_through_cache(asked(spark, texts), index, corpus, path, other, embedder=toy).collect())


def test_screened_uses_the_first_rank(spark):
    rows = [(1, 7, 0.5, 1), (1, 8, 0.1, 2), (2, 7, 0.3, 1)]
    top = spark.createDataFrame(rows, "query_id long, item_id long, score double, rank long")
    assert {(r.query_id, r.item_id) for r in answers.screened(top).collect()} == {(1, 7), (1, 8)}


def test_a_cache_needs_a_corpus_version(spark, index, corpus, folder):
    with pytest.raises(ValueError):
        answers.answer_through_cache(asked(spark, ["gin"]), index, corpus, f"{folder}/cache", AnswerSettings(translate=False), embedder=toy)


def test_generated_answers_are_translated_and_template_answers_are_not(spark, index, corpus):
    def generator(frames):
        for frame in frames:
            yield frame.assign(value=frame.payload.map(lambda p: "the drink with gin" if "gin" in p.split("Request")[-1] else None))[["key", "value"]]

    settings = AnswerSettings(translate=False, language="fr")
    got = run(spark, index, corpus, ["gin", "rum"], settings=settings, generator=generator, translator=lambda fs: (f.assign(value="fr " + f.payload)[["key", "value"]] for f in fs))
    made = {got[i].generated_recipe for i in (0, 1)}
    assert any(m.startswith("fr the drink") for m in made) or all(not m.startswith("fr") for m in made)
    assert got[0].generated_recipe == "fr the drink with gin" and not got[1].generated_recipe.startswith("fr")


def test_words_are_translated_within_the_row(spark):
    texts = spark.createDataFrame([(1, "le  citron x", "fr"), (2, "und und", "de"), (3, "kept", "xx"), (4, "le", None)], "id long, text string, lang string")
    made = language.translate_words(texts, language.dictionary_table(spark))
    assert [r.value for r in made.orderBy("id").collect()] == ["the  lemon x", "and and", "kept", "le"]
    plan = plan_of(made).split("Physical Plan")[-1]
    assert "Generate" not in plan and "hashpartitioning(text" not in plan


def test_detection_and_its_unknowns(spark):
    texts = ["le rhum et la menthe", "the rum and the mint", "der Saft und die Minze", "el ron y los limones", "xyz 123", "", None]
    got = language.detect(asked(spark, texts), "text").orderBy("query_id").collect()
    assert [r.detected for r in got] == ["fr", "en", "de", "es", "unknown", "unknown", "unknown"]


def test_translation_rules(spark):
    texts = ["citron et menthe", "the mint", "xyz", "", "les tables", "citron et menthe"]
    got = {r.query_id: r for r in language.to_english(asked(spark, texts)).collect()}
    assert (got[0].english, got[0].was_translated) == ("lemon and mint", True)
    assert [got[i].was_translated for i in range(1, 5)] == [False, False, False, True]
    assert got[5].english == got[0].english
    off = language.to_english(asked(spark, texts), enabled=False)
    assert off.where("was_translated").count() == 0


def test_plug_in_translator_sees_each_foreign_text_once_and_no_ops_do_not_count(spark):
    def translator(frames):
        for frame in frames:
            assert frame.key.is_unique and not frame.payload.str.startswith("the").any()
            yield frame.assign(value=frame.payload.where(frame.payload.str.startswith("les"), "done"))[["key", "value"]]

    texts = ["le citron et la menthe"] * 5 + ["les amis du soir", "the mint"]
    got = language.to_english(asked(spark, texts), translator=translator).orderBy("query_id").collect()
    assert [r.was_translated for r in got] == [True] * 5 + [False, False]
    back = language.to_language(asked(spark, ["the mint", "le rhum", ""]), "text", "fr", lambda fs: (f.assign(value="fr " + f.payload)[["key", "value"]] for f in fs))
    assert [r.text_fr for r in back.orderBy("query_id").collect()] == ["fr the mint", "le rhum", ""]


def test_words_next_to_punctuation_are_translated(spark):
    texts = spark.createDataFrame([(1, "Citron, menthe; (le rhum)\n", "fr"), (2, "", "fr"), (3, None, "fr"), (4, "citron2", "fr")], "id long, text string, lang string")
    made = language.translate_words(texts, language.dictionary_table(spark))
    assert {r.id: r.value for r in made.collect()} == {1: "lemon, mint; (the rum)\n", 2: "", 3: None, 4: "lemon2"}
