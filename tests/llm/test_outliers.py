import random
import re

from pyspark.sql import functions as F

from conftest import plan_of
from larder.llm import outliers

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _brute(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice, covered = {w for w in windows if windows.count(w) > 1}, set()
    for i, w in enumerate(windows):
        if w in twice:
            covered.update(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), n < 10 or 100 * len(covered) > 20 * n)


def _text(r, n=80, junk=""):
    return " ".join(r.choice("the and of a house garden river walks slowly under green trees".split()) + str(r.randrange(400)) + junk for _ in range(n))


def test_statistics_against_brute_force(spark):
    r = random.Random(5)
    texts = [None, "", " \n ", "a", "a b c d e " * 6, "one two three four five six seven eight nine ten " * 3, "x\n\nx\ny\nx", "Ünï cöde ## 漢字 a|b", _text(r, 3000) + " " + _text(r, 4) * 3]
    texts += [" ".join(r.choices("abcd", k=r.randrange(40))) for _ in range(40)]
    rows = [(i, t, "en", "s", 5) for i, t in enumerate(texts)]
    got = {x["doc_id"]: x for x in outliers.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words int")).collect()}
    for i, t in enumerate(texts):
        x = got[i]
        assert (x["n_words"], x["word_chars"], x["n_symbols"], x["n_dup_lines"], x["n_repeat_words"], x["base_failed"]) == _brute(t), t
        assert not (x["base_failed"] and x["kept"])


def test_outliers_go_and_clean_documents_stay(spark):
    r = random.Random(9)
    rows = []
    for i in range(600):
        bad = i % 10 == 0
        rows.append((i, _text(r, r.choice([12, 40, 300]), "###$$$%%%" if bad else ""), ("en", None)[i % 2], f"s{i % 2}" if i > 30 else f"rare{i}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {x["doc_id"]: x["kept"] for x in outliers.judge(docs.repartition(5)).collect()}
    assert all(got[i] for i in range(600) if i % 10)
    assert not any(got[i] for i in range(40, 600, 10))
    assert {x["doc_id"]: x["kept"] for x in outliers.judge(docs.repartition(3, F.rand())).collect()} == got
    kept = outliers.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == sum(got.values())


def test_edges(spark):
    schema = "doc_id long, text string, lang string, source string"
    assert outliers.judge(spark.createDataFrame([], schema)).count() == 0
    same = spark.createDataFrame([(1, "a b c d e f g h i j k", "en", "s")] * 3 + [(None, None, None, None)] * 2, schema)
    assert sorted(x["kept"] for x in outliers.judge(same).collect()) == [False, False, True, True, True]
    assert "Python" not in plan_of(outliers.judge(same)) and "Arrow" not in plan_of(outliers.with_statistics(same))


def test_chi_square():
    assert abs(outliers.chi_square_quantile(0.975) - 11.1433) < 1e-3
    assert abs(outliers.chi_square_quantile(0.5) - 3.3567) < 1e-3


def test_small_groups_are_judged_by_wider_ones(spark):
    r = random.Random(3)

    def row(i, lang, source, junk=""):
        return (i, _text(r, r.choice([40, 300]), junk), lang, source)

    rows = [row(i, "en", f"s{i % 2}") for i in range(200)]
    rows += [row(200 + i, "en", "lone", "###$$$%%%" if i % 2 else "") for i in range(40)]  # one small source of its language
    rows += [row(300 + i, None, "few", "###$$$%%%" if i % 2 else "") for i in range(6)]  # a small language
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {x["doc_id"]: x for x in outliers.judge(docs).collect()}
    assert all(x["base_failed"] or x["d2"] is not None for x in got.values())
    assert [i for i in got if not got[i]["kept"]] and {i for i in got if not got[i]["kept"]} == {i for i in got if i >= 200 and i % 2}
    table = spark.createDataFrame(rows[:20] + [x for x in rows if x[0] == 301], docs.schema)  # a table under LEAST_GROUP is judged too
    assert [x["doc_id"] for x in outliers.judge(table).collect() if not x["kept"]] == [301]
