"""Metrics against plain loops."""

import math
import random
from collections import Counter

import pytest

from larder.functions.stem import stem
from larder.operators import evaluation as ev


def metrics(spark, relevant, retrieved, k_values):
    rel = spark.createDataFrame([(q, n) for q, names in relevant.items() for n in names], "query_id long, name string")
    got = spark.createDataFrame(
        [(q, r + 1, n) for q, names in retrieved.items() for r, n in enumerate(names)], "query_id long, rank long, name string"
    )
    return {(r.query_id, r.k): r for r in ev.query_metrics(rel, got, k_values).collect()}


def plain(relevant, names, k):
    relevant = set(relevant)
    gain = sum(1 / math.log2(i + 2) for i, n in enumerate(names[:k]) if n in relevant)
    ideal = sum(1 / math.log2(i + 2) for i in range(min(len(relevant), k)))
    hits = len(set(names[:k]) & relevant)
    return hits / k, hits / max(len(relevant), 1), gain / ideal if ideal else 0.0


def test_known_values(spark):
    got = metrics(spark, {1: "ABC", 2: "A"}, {1: "ADBEC", 2: "ABC"}, [3, 5])
    assert got[1, 5].precision == pytest.approx(0.6)
    assert got[2, 3].ndcg == pytest.approx(1.0)


def test_against_loops(spark):
    rng = random.Random(1)
    relevant = {q: rng.sample("ABCDEFGH", rng.randint(1, 5)) for q in range(20)}
    retrieved = {q: [rng.choice("ABCDEFGHIJKL") for _ in range(rng.randint(0, 10))] for q in range(18)}  # with repeats
    got = metrics(spark, relevant, retrieved, [1, 3, 5, 10])
    assert len(got) == 80
    for (q, k), row in got.items():
        expected = plain(relevant[q], retrieved.get(q, []), k)
        assert (row.precision, row.recall, row.ndcg) == pytest.approx(expected)
        assert 0 <= row.precision <= min(1, len(set(relevant[q])) / k) and row.recall <= 1


def test_evaluate_skips_queries_without_relevant_items(spark):
    queries = spark.createDataFrame([(i, f"q{i}") for i in range(5)], "query_id long, text string")
    relevant = spark.createDataFrame([(0, "a"), (1, "b"), (4, "z")], "query_id long, name string")
    hits = spark.createDataFrame([(0, 1, "a"), (1, 1, "x"), (2, 1, "a")], "query_id long, rank long, name string")
    config = ev.EvalConfig(k_values=[1], n_queries=4)
    got = ev.evaluate_recommender(queries, relevant, lambda q, k: hits.join(q, "query_id", "left_semi"), config)
    assert {r.metric: r.value for r in got.collect()} == {"precision": 0.5, "recall": 0.5, "ndcg": 0.5}


def test_defaults():
    config = ev.EvalConfig()
    assert (config.k_values, config.n_queries, len(config.out_of_domain_queries)) == ([1, 3, 5, 10], None, 5)


def test_screening_report_and_sweep(spark):
    rows = [(True, 0.5), (True, 0.45), (True, 0.3), (False, 0.42), (False, 0.1)]
    table = spark.createDataFrame(rows, "in_domain boolean, max_similarity double")
    sweep = {r.threshold: r for r in ev.threshold_sweep(table, [0.2, 0.4, 0.6]).collect()}
    assert (sweep[0.4].tp, sweep[0.4].fp, sweep[0.4].tn, sweep[0.4].fn) == (2, 1, 1, 1)
    assert (sweep[0.6].precision, sweep[0.6].recall, sweep[0.6].f1, sweep[0.6].rejection_rate_ood) == (0, 0, 0, 1)
    best = ev.best_threshold(ev.threshold_sweep(table, [0.2, 0.25, 0.6])).first()
    assert best.threshold == 0.2  # tie goes to the smaller threshold
    counts = spark.createDataFrame([(2, 1, 2, 1)], "tp long, fp long, tn long, fn long")
    report = ev.screening_report(counts).first()
    assert (report.precision, report.recall, report.f1, report.rejection_rate_ood) == (0.667, 0.667, 0.667, 0.667)


def test_fixed_requests_through_a_screen(spark):
    labelled = ev.labelled_requests(spark)
    assert labelled.count() == 10 and labelled.where("in_domain").count() == 5
    from pyspark.sql import functions as F

    report = ev.evaluate_guardrail(labelled, lambda r: r.withColumn("passed", F.col("text").rlike("avec|film"))).first()
    assert (report.tp, report.fp, report.tn, report.fn) == (2, 1, 4, 3)
    assert (report.precision, report.recall, report.f1, report.rejection_rate_ood) == (0.667, 0.4, 0.5, 0.8)


def test_both_query_counts_are_reported(spark):
    queries = spark.createDataFrame([(i,) for i in range(6)], "query_id long")
    relevant = spark.createDataFrame([(0, "a"), (0, "b"), (3, "a"), (5, "a")], "query_id long, name string")
    row = ev.query_counts(queries, relevant, 5).first()
    assert (row.n_queries, row.n_evaluated) == (5, 2)


def test_relative_gain_is_guarded(spark):
    rows = [("base", "p", 1, 0.0), ("new", "p", 1, 0.5), ("base", "r", 1, 0.4), ("new", "r", 1, 0.5)]
    gains = ev.relative_gain(spark.createDataFrame(rows, "config string, metric string, k long, value double"), "base")
    got = {r.metric: r.gain for r in gains.collect()}
    assert got["r"] == pytest.approx(25.0) and got["p"] == pytest.approx(0.5 / 1e-9 * 100)


def plain_bleu(generated, reference):
    g, r = generated.lower().split(), reference.lower().split()
    logs = []
    for n in range(1, 5):
        a = Counter(tuple(g[i:i + n]) for i in range(len(g) - n + 1))
        b = Counter(tuple(r[i:i + n]) for i in range(len(r) - n + 1))
        hit = sum(min(c, b[x]) for x, c in a.items())
        if n == 1 and hit == 0:
            return 0.0
        logs.append(math.log((hit or 0.1) / max(1, sum(a.values()))))
    penalty = 1.0 if len(g) > len(r) else math.exp(1 - len(r) / len(g))
    return penalty * math.exp(sum(logs) / 4)


def plain_rouge(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    common = table[-1][-1]
    return 0.0 if not common else 2 * (common / len(a)) * (common / len(b)) / (common / len(a) + common / len(b))


@pytest.fixture(scope="module")
def pairs():
    rng = random.Random(2)
    words = ["gin", "limes", "shake", "shaking", "the", "ice", "glasses", "pour", "garnish"]
    out = {i: (" ".join(rng.choices(words, k=rng.randint(1, 90))), " ".join(rng.choices(words, k=rng.randint(1, 70)))) for i in range(60)}
    out[100] = ("Mix gin. Shake with ice.", "Mix gin. Shake with ice.")
    out[101] = ("gin lime", "gin rum lime")  # under four tokens
    out[102] = ("vodka", "rum")
    out[103] = ("", "rum")
    out[104] = ("vodka", "")
    out[105] = ("", "")
    return out


def test_bleu_and_rouge_against_loops(spark, pairs):
    table = spark.createDataFrame([(k, *v) for k, v in pairs.items()], "pair_id long, generated string, reference string")
    bleu = {r.pair_id: r.bleu4 for r in ev.bleu(table).collect()}
    rouge = {r.pair_id: r.rouge_l for r in ev.rouge_l(table).collect()}
    exact = {r.pair_id: r.rouge_l for r in ev.rouge_l(table, stem=False).collect()}
    assert set(bleu) == set(rouge) == set(pairs)

    def tokens(text, stemmed):
        words = [w for w in "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()]
        return [stem(w) if stemmed and len(w) > 3 else w for w in words]

    for key, (g, r) in pairs.items():
        assert bleu[key] == pytest.approx(plain_bleu(g, r) if g else 0.0), key
        assert rouge[key] == pytest.approx(plain_rouge(tokens(g, True), tokens(r, True))), key
        assert exact[key] == pytest.approx(plain_rouge(tokens(g, False), tokens(r, False))), key
        assert 0 <= bleu[key] <= 1 and 0 <= rouge[key] <= 1
    assert bleu[100] == pytest.approx(1.0) and rouge[100] == 1.0


def test_generation_scores_are_rounded(spark, pairs):
    table = spark.createDataFrame([(k, *v) for k, v in pairs.items()], "pair_id long, generated string, reference string")
    rows = ev.evaluate_generation(table).collect()
    assert len(rows) == len(pairs) and all(r.bleu4 == round(r.bleu4, 4) for r in rows)


@pytest.mark.parametrize(
    "word, expected",
    [("caresses", "caress"), ("ponies", "poni"), ("ties", "tie"), ("cats", "cat"), ("agreed", "agre"), ("plastered", "plaster"),
     ("motoring", "motor"), ("conflated", "conflat"), ("hopping", "hop"), ("falling", "fall"), ("filing", "file"), ("happy", "happi"),
     ("relational", "relat"), ("rational", "ration"), ("digitizer", "digit"), ("vietnamization", "vietnam"), ("operator", "oper"),
     ("hopefulness", "hope"), ("sensibiliti", "sensibl"), ("triplicate", "triplic"), ("electrical", "electr"), ("goodness", "good"),
     ("allowance", "allow"), ("adjustable", "adjust"), ("replacement", "replac"), ("adoption", "adopt"), ("effective", "effect"),
     ("probate", "probat"), ("rate", "rate"), ("cease", "ceas"), ("controlling", "control"), ("rolling", "roll"), ("dying", "die"),
     ("enjoy", "enjoy"), ("spied", "spi"), ("died", "die"), ("geologi", "geolog")],
)
def test_stems(word, expected):
    assert stem(word) == expected


def test_batches_of_words_become_strings_a_distinct_word_or_pair_at_a_time():
    import pyarrow as pa
    from larder.functions import stem, vector
    from larder.operators import evaluation

    lists = pa.array([["running", "runs", "cat"], [], ["running"] * 50])
    assert stem.stem_words.func(lists).to_pylist() == [["run", "run", "cat"], [], ["run"] * 50]
    assert stem.stem_words.func(lists.slice(1, 2)).to_pylist() == [[], ["run"] * 50]
    assert evaluation.common_subsequence.func(lists, pa.array([["cat"], ["a"], ["running", "x"]])).to_pylist() == [1, 0, 1]
    texts = pa.array([None, "", "a b", "one two two"] * 400 + ["long word " * 300_000])
    parts = list(vector._text_pieces(texts))
    assert len(parts) > 4 and pa.concat_arrays(parts).equals(texts) and all(len(p) <= vector.PIECE_TEXTS for p in parts)
