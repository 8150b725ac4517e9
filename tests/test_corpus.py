"""Sources, normalisation and deduplication."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from larder.operators import corpus
from larder.sources import readers, writers

FLAT = "name string, category string, glass string, ingredients string, instructions string"


def test_csv_drops_long_lines_pads_short_ones(spark, folder):
    Path(folder, "x.csv").write_text('a,b,c\n1,2,3\n4,5\n6,7,8,9\n"q ""w"",\nz",NA,\n' + "\n" * 100, encoding="utf-8")
    rows = readers.read_dataset(spark, folder, "x").select("a", "b", "c")
    got = [tuple(r) for r in rows.where("a is not null").collect()]
    assert got == [("1", "2", "3"), ("4", "5", None), ('q "w",\nz', None, None)]


def test_csv_files_are_read_by_their_own_headers(spark, folder):
    base = Path(folder, "drops")
    base.mkdir()
    (base / "a.csv").write_text("name,category\nKamikaze,Shot\nMojito,Long\n")
    (base / "b.csv").write_text("category,name\nShot,Tequila\n")
    (base / "c.csv").write_text('name,category,glass\n"Two\nlines",Beer,Mug\nx,y,z,too many\n')
    rows = {(r.name, r.category, r.glass) for r in readers.read_csv(spark, str(base)).collect()}
    assert rows == {("Kamikaze", "Shot", None), ("Mojito", "Long", None), ("Tequila", "Shot", None), ("Two\nlines", "Beer", "Mug")}
    assert readers.read_csv(spark, str(base), malformed=True).count() == 1
    assert sorted(broken for broken, _ in readers.csv_layouts(spark, str(base))) == [False, False, True]


def test_payload_keeps_any_number_of_slots(spark):
    record = {"idDrink": 7, "strDrink": " A ", "strIngredient10": "ten", "strMeasure10": " 1 cl ", "strIngredient2": "two", "strMeasure2": None, "strIngredient20": "twenty", "strIngredient3": " "}
    got = readers.parse_payload(spark.createDataFrame([(json.dumps({"drinks": [record]}),), ('{"drinks": null}',)], "body string"), "body").collect()
    assert [(r.id, r.name, r.ingredients) for r in got] == [("7", "A", "two, 1 cl ten, twenty")]


def test_parquet_first_then_csv_then_nothing(spark, folder):
    Path(folder, "x.csv").write_text("a\n" + "1\n" * 100)
    assert readers.read_dataset(spark, folder, "x").count() == 100
    Path(folder, "x.parquet").write_bytes(b"PAR1" + b"\0" * 200 + b"PAR1")  # unreadable: falls through
    assert readers.read_dataset(spark, folder, "x").count() == 100
    spark.range(7).write.parquet(f"{folder}/y.parquet")
    assert readers.read_dataset(spark, folder, "y").count() == 7
    Path(folder, "tiny.csv").write_text("a\n1\n")
    assert [r.a for r in readers.read_dataset(spark, folder, "tiny").collect()] == ["1"]
    Path(folder, "empty.csv").write_text("")
    assert readers.read_dataset(spark, folder, "empty") is None
    assert readers.read_dataset(spark, folder, "absent") is None


def test_wide_slots_are_paired_by_number(spark):
    rows = spark.createDataFrame(
        [("A", " Gin ", "2 oz", "", "1 cl", "Lime", None)],
        "strDrink string, strIngredient1 string, strMeasure1 string, strIngredient2 string, strMeasure2 string, "
        "strIngredient10 string, strMeasure10 string",
    )
    assert corpus.flatten_wide(rows).first().ingredients == "2 oz Gin, Lime"
    assert corpus.flatten_wide(rows.drop("strMeasure1", "strMeasure2", "strMeasure10")).first().ingredients == "Gin, Lime"


def test_harmonise_takes_first_candidate_and_fills_blanks(spark):
    rows = spark.createDataFrame([("t", "d", "r", "old")], "title string, drink_name string, recipe string, source string")
    assert corpus.harmonise(rows, "tag").first().asDict() == {
        "name": "d", "category": "", "glass": "", "ingredients": "r", "instructions": "", "source": "tag",
    }


def test_extra_in_wide_layout_keeps_its_ingredients(spark, folder):
    rows = spark.createDataFrame([("A", "Gin", "2 oz")], "strDrink string, strIngredient1 string, strMeasure1 string")
    rows.write.parquet(f"{folder}/kaggle_w.parquet")
    Path(folder, "kaggle_bad.parquet").write_bytes(b"no parquet at all" * 20)
    extras = readers.discover_extras(spark, folder)
    assert [(r.name, r.ingredients, r.source) for e in extras for r in e.collect()] == [("A", "2 oz Gin", "kaggle_w")]


def test_cascade_first_source_wins(spark, folder):
    main = [("Mojito", "main", "g", "rum, mint, lime juice", "x"), ("Unique", "main", "g", "gin", "x")]
    spark.createDataFrame(main, FLAT).coalesce(1).write.parquet(f"{folder}/cocktaildb_main.parquet")
    second = [(" mojito ", "second", "g", "", "x"), ("MOJITO  ", "second", "g", "", "x"), ("Other", "second", "g", "", "x")]
    spark.createDataFrame(second, FLAT).coalesce(1).write.parquet(f"{folder}/cocktaildb_nonalcoholic.parquet")
    extra = [("Extra", "extra", "g", None, "x"), (None, "extra", "g", None, "x"), ("  ", "extra", "g", None, "x")]
    spark.createDataFrame(extra, FLAT).coalesce(1).write.parquet(f"{folder}/kaggle_e.parquet")
    got = readers.load_corpus(spark, folder)
    rows = {r.name: r for r in got.collect()}
    assert {(n, r.category) for n, r in rows.items()} == {
        ("Mojito", "main"), ("Unique", "main"), ("Other", "second"), ("Extra", "extra"), (None, "extra"),
    }
    assert rows["Other"].source == "nonalcoholic"  # tagged by where it came from
    assert rows["Mojito"].text_full == "Mojito. Category: main. Ingredients: rum, mint, lime juice. x"
    assert (rows["Mojito"].strong, rows["Mojito"].sour, rows["Mojito"].fresh) == pytest.approx((1 / 3, 2 / 3, 1 / 3))


def test_merged_source_replaces_main(spark, folder):
    spark.createDataFrame([("M", "c", "g", "i", "x", "yes")], FLAT + ", iba string").write.parquet(f"{folder}/cocktails_merged.parquet")
    spark.createDataFrame([("Main", "c", "g", "i", "x")], FLAT).write.parquet(f"{folder}/cocktaildb_main.parquet")
    rows = readers.load_corpus(spark, folder).collect()
    assert [(r.name, r.source, r.iba) for r in rows] == [("M", "cocktaildb_merged", "yes")]


def test_no_source_raises(spark, folder):
    with pytest.raises(ValueError):
        readers.load_corpus(spark, folder)


def test_dedup_survives_a_hot_key(spark):
    rows = spark.range(30_000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit("Hot")).otherwise(F.concat(F.lit("n"), "id")).alias("name")
    )
    unique = corpus.dedup_by_name(rows, ["id"])
    assert unique.count() == 20_001
    assert unique.where("name = 'Hot'").first().id == 0
    plan = plan_of(unique)
    assert plan.count("WindowGroupLimit") >= 2  # one of them below the exchange


def test_unnamed_rows_can_be_kept(spark):
    rows = spark.createDataFrame([(1, None), (2, " "), (3, "a"), (4, "A")], "id int, name string")
    assert corpus.dedup_by_name(rows, ["id"]).count() == 2
    assert corpus.dedup_by_name(rows, ["id"], keep_unnamed=True).count() == 3


def test_payload(spark, folder):
    drink = {"idDrink": "7", "strDrink": " Mojito ", "strIngredient1": "Rum", "strMeasure1": " 2 oz ", "strIngredient2": " ", "strTags": None}
    Path(folder, "a.json").write_text(json.dumps({"drinks": [drink, {"idDrink": "8"}]}))
    Path(folder, "b.json").write_text('{"drinks": null}')
    rows = {r.id: r for r in readers.read_payload(spark, folder).collect()}
    assert set(rows) == {"7", "8"}
    assert (rows["7"].name, rows["7"].ingredients, rows["7"].tags, rows["7"].source) == ("Mojito", "2 oz Rum", "", "cocktaildb")
    assert (rows["8"].name, rows["8"].ingredients) == ("", "")


def test_report_and_store_round_trip(spark, folder):
    metrics = spark.createDataFrame([("p", 1, 0.5), ("p", 3, None)], "metric string, k long, value double")
    writers.save_report(metrics, f"{folder}/report")
    lines = sorted(json.loads(r.value)["k"] for r in spark.read.text(f"{folder}/report").collect())
    assert lines == [1, 3]
    vectors = spark.createDataFrame([(1, [0.6, 0.8])], "item_id long, embedding array<double>")
    writers.save_embeddings(vectors, f"{folder}/vectors")
    assert writers.load_embeddings(spark, f"{folder}/vectors").schema["embedding"].dataType.simpleString() == "array<float>"


def test_sample_is_reproducible_and_without_replacement(spark):
    rows = spark.range(500).withColumnRenamed("id", "item_id")
    first = [r.item_id for r in corpus.seeded_sample(rows, 30, "item_id").collect()]
    again = [r.item_id for r in corpus.seeded_sample(rows.repartition(5), 30, "item_id").collect()]
    assert first == again and len(set(first)) == 30
