"""Text expressions on literal rows that carry the known traps."""

import pytest
from pyspark.sql import functions as F

from larder import fixed
from larder.functions import text as tx


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {t}" for k, t in _types(values)))
    return row.select(column.alias("out")).first().out


def _types(values):
    for key, value in values.items():
        yield key, "array<string>" if isinstance(value, list) else "string"


@pytest.mark.parametrize(
    "given, key",
    [("Mojito", "mojito"), (" mojito ", "mojito"), ("MOJITO  ", "mojito"), (" Old\t\tFashioned ", "old fashioned"),
     (None, ""), ("", ""), (" \t\n", "")],
)
def test_name_key(spark, given, key):
    assert one(spark, tx.name_key("t"), t=given) == key


def test_clean_text_drops_accents_after_collapsing(spark):
    assert one(spark, tx.clean_text("t"), t="  Crème\n brûlée! (1/2) A-B ") == "crme brle! 12 a-b"
    assert one(spark, tx.clean_text("t"), t=None) == ""


def test_clean_ingredients(spark):
    assert one(spark, tx.clean_ingredients("t"), t="60ml vodka\n1.5 oz Gin, , 2 CUP Lime") == "vodka, gin, lime"
    assert one(spark, tx.clean_ingredients("t"), t=None) == ""


def test_measure_patterns_keep_their_residue(spark):
    assert one(spark, tx.strip_measure("t", "index"), t="1/2 oz lime") == "1/lime"
    assert one(spark, tx.strip_measure("t", "browse"), t="60ml vodka") == "vodka"
    assert one(spark, tx.strip_measure("t", "browse"), t="2 oz gin") == "2 oz gin"
    assert one(spark, tx.strip_measure("t", "explore"), t="2 oz gin") == "oz gin"


def test_lexicon_matches_substrings_and_saturates(spark):
    lexicon = fixed.FLAVOR_LEXICON
    assert one(spark, tx.lexicon_score("t", lexicon["strong"]), t="Ginger beer") == pytest.approx(1 / 3)
    assert one(spark, tx.lexicon_score("t", lexicon["sour"]), t="lemon lime juice sour citrus") == 1.0
    assert one(spark, tx.lexicon_score("t", lexicon["sour"]), t=None) == 0.0


def test_ingredients_count_of_nothing_is_one(spark):
    assert one(spark, tx.ingredients_count("t"), t="") == 1
    assert one(spark, tx.ingredients_count("t"), t=None) == 1
    assert one(spark, tx.ingredients_count("t"), t="a, b,c") == 3


def test_search_text_keeps_separators_of_nulls(spark):
    row = spark.createDataFrame([(None, "c", None, "i")], "name string, category string, ingredients string, instructions string")
    assert row.select(tx.search_text()).first()[0] == ". Category: c. Ingredients: . i"


def test_coverage_and_required(spark):
    assert one(spark, tx.coverage("a", "t"), a=["Gin", "lime", "rum", "Lime"], t="GINGER beer, lime") == 0.75
    assert one(spark, tx.coverage("a", "t"), a=[], t="x") == 0.0
    assert one(spark, tx.includes_all("a", "t"), a=["old", "rod"], t="cold ROD") is True
    assert one(spark, tx.includes_all("a", "t"), a=["old"], t=None) is False


def test_content_key_separates_its_parts(spark):
    ambiguous = spark.createDataFrame([("x1", "1"), ("x", "11")], "a string, b string")
    assert ambiguous.select(tx.content_key("a", "b").alias("k")).distinct().count() == 2


def test_html_is_escaped_first(spark):
    text = "**Bold** & <b>\n- one\n* two's\n**not\nbold**"
    expected = "<strong>Bold</strong> &amp; &lt;b&gt;<br>&bull; one<br>&bull; two&#x27;s<br>**not<br>bold**"
    assert one(spark, tx.html_of("t"), t=text) == expected


def test_labels_and_lines(spark):
    assert one(spark, tx.short_label("t"), t="x" * 20) == "x" * 20
    assert one(spark, tx.short_label("t"), t="x" * 21) == "x" * 20 + "..."
    assert one(spark, tx.preview("t"), t="abc") == "abc..."
    assert one(spark, tx.first_lines("t"), t="\n".join("123456789")) == "1\n2\n3\n4\n5\n6"


def test_formats(spark):
    assert one(spark, tx.ingredient_request("a"), a=["gin", "lime"]) == "cocktail avec gin, lime"
    assert one(spark, tx.generation_prompt("a"), a=["gin", "lime"]) == "Recette avec gin, lime :\nNom : "
    answer = one(spark, tx.template_answer("q", "c"), q="fresh", c="l1\nl2")
    assert answer.startswith("Recette generee pour 'fresh' (mode template)\n\nl1\nl2\n\nPreparation : ")
    training = spark.createDataFrame([(None, "c", "i", "s")], "name string, category string, ingredients string, instructions string")
    assert training.select(tx.training_text()).first()[0] == (
        "Recipe: Unknown Cocktail\nCategory: c\nIngredients: i\nInstructions: s\n<|endoftext|>"
    )


def test_tokens(spark):
    assert one(spark, tx.whitespace_tokens("t"), t=" A\tb C ") == ["a", "b", "c"]
    assert one(spark, tx.search_tokens("t"), t="L'été, a 1er x_y") == ["été", "1er", "x_y"]
    assert one(spark, tx.word_count("t"), t="  ") == 0
    assert one(spark, tx.split_list("t"), t="a, ,b ,") == ["a", "b"]


def test_search_is_literal_or_regex(spark):
    rows = spark.createDataFrame([(1, "Gin (dry)", None), (2, None, "lime, gin"), (3, None, None)], "i int, name string, ingredients string")
    literal = rows.where(tx.matches_search("gin (", ["name", "ingredients"]))
    assert [r.i for r in literal.collect()] == [1]
    pattern = rows.where(tx.matches_search("^gin|GIN$", ["name", "ingredients"], regex=True))
    assert sorted(r.i for r in pattern.collect()) == [1, 2]


def test_blank(spark):
    rows = spark.createDataFrame([(None,), ("",), ("  \n",), ("x",)], "t string")
    assert [r[0] for r in rows.select(tx.is_blank("t")).collect()] == [True, True, True, False]
    assert rows.where(F.col("t").isNull()).count() == 1
