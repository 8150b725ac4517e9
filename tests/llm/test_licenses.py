import re

from pyspark.sql import functions as F

from conftest import plan_of
from larder.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _brute(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split(" ")
        at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), sorted(labels)


TEXTS = [
    None, "", "no such thing", "Released under the MIT License", "mit license mit license MIT-LICENSE", "x GNU General Public License, version 3 and the Apache License, Version 2.0.",
    "MITlicense", "general\npublic\tlicense", "mit licenses", "Apache license", "license mit", "Licensed under CC BY-NC 4.0", "word " * 3000 + "mit license" + " word" * 10, "ÉMIT license mit Élicense",
    "general public license general public license x mit license", "mit license", "Copyright (c) 2019 Someone. All rights reserved. This is free software: public domain"]


def _found(spark, texts):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, labels string")
    return {x["doc_id"]: x for x in licenses.detect(docs).withColumn("score", licenses.score()).collect()}


def test_base_phrases_against_brute_force(spark):
    got = _found(spark, TEXTS)
    for i, t in enumerate(TEXTS):
        x = got[i]
        assert (x["n_words"], x["n_base"], x["first_word"], x["last_word"], x["base_labels"]) == _brute(t), t
        assert 0 <= x["score"] <= 1


def test_method_labels(spark):
    got = _found(spark, TEXTS)
    assert got[11]["method_labels"] == ["cc-by-nc-4.0"]
    assert got[3]["method_labels"] == ["mit"] and got[3]["score"] > got[2]["score"] == 0
    assert got[5]["method_labels"] == ["apache-2.0", "gpl-3"]
    assert set(got[16]["method_labels"]) >= {"copyright", "all-rights-reserved"}


def _brute_labels(text):
    """All matches of all rules; one inside another (earlier start or longer) of the same or a better priority goes."""
    normal = " " + " ".join(WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))) + " "
    found = sorted((m.start(), -m.end(), priority, label) for label, _, priority, pattern in licenses.signatures() for m in re.finditer(f" {pattern}(?= )", normal))
    kept = []
    for start, back, priority, label in found:
        if not any(b <= back and p <= priority for _, b, p, _ in kept):
            kept.append((start, back, priority, label))
    return sorted({k[3] for k in kept}), len(kept)


def test_suppression_against_brute_force(spark):
    texts = [
        "Licensed under the Apache License, Version 2.0 or the MIT license; spdx license identifier mit", "the gnu lesser general public license version 2.1 and the gnu general public license v3",
        "SPDX-License-Identifier: GPL-3.0-or-later. Creative Commons BY-SA 4.0, licensed under CC BY 2.0", "Permission is hereby granted, free of charge, to any person obtaining a copy", "mpl mozilla public license 2 0 " * 30]
    got = _found(spark, texts)
    for i, t in enumerate(texts):
        assert (got[i]["method_labels"], got[i]["n_detections"]) == _brute_labels(t), t


def test_rules_and_plan(spark):
    rules = licenses.signatures()
    assert len(rules) > 200 and all(k in re.sub(r"\(\?:|[()?|\[\]]", " ", p) or k in p for _, k, _, p in rules)
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = plan_of(licenses.detect(docs))
    assert "Python" not in plan and "Arrow" not in plan
    assert licenses.detect(docs.where(F.lit(False))).count() == 0


def _statement(pattern):
    """The shortest text that a rule's pattern matches."""
    while "(?:" in pattern:
        pattern = re.sub(r"\(\?:([^()|]*)(?:\|[^()]*)?\)", r"\1", re.sub(r"\(\?:[^()]*\)\?", "", pattern, count=1), count=1)
    return re.sub(r"\[(.)[^\]]*\]", r"\1", pattern)


def test_every_rule_is_reached_by_its_statement_alone(spark):
    rules = licenses.signatures()
    texts = ["about\n" + _statement(pattern).upper().replace(" ", between) + "\nhere" for _, _, _, pattern in rules for between in ("\n", "-")]
    got = _found(spark, texts)
    for i, t in enumerate(texts):
        assert (got[i]["method_labels"], got[i]["n_detections"]) == _brute_labels(t), t
        assert got[i]["n_detections"] > 0, t
    assert got[2 * [r[0] for r in rules].index("all-rights-reserved")]["method_labels"] == ["all-rights-reserved"]
