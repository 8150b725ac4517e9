import math
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from larder.llm import interpolation as lm


def _tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")), None]


def _rows(seed=1, n=120):
    r = random.Random(seed)
    words = [f"W{i}" for i in range(60)]
    rows = []
    for i in range(n):
        at, text = r.randrange(60), []
        for _ in range(r.randrange(0, 60)):
            text.append(words[at])
            at = (at * 7 + r.randrange(3)) % 60
        rows.append((i, " ".join(text), i % 5 == 1))
    return rows + [(900, None, False), (901, "", True), (902, "never seen words", True), (3, "w1 w2 \t W1\nw2", False), (3, "w1 w2 \t W1\nw2", False), (None, "w1", True)]


def _brute(rows):
    unigrams, pairs, contexts = Counter(), Counter(), Counter()
    for _, text, held in rows:
        if not held:
            t = _tokens(text)
            unigrams.update(t)
            before = ["<s>", *t[:-1]]
            pairs.update(zip(before, t))
            contexts.update(before)
    n, v = sum(unigrams.values()), len(unigrams)
    histogram = Counter()
    for _, text, held in rows:
        if not held:
            t = _tokens(text)
            for h, w in zip(["<s>", *t[:-1]], t):
                c, two, one = contexts[h] - 1, pairs[h, w] - 1, unigrams[w] - 1
                cell = lambda p: 1 + round(-math.log2(p) * lm.GRID) if p else 0
                histogram[(int(math.log2(c)) + 1 if c else 0) << 40 | cell(two / c if c else 0) << 20 | cell(one / (n - 1))] += 1
    weights = lm.learned_weights(pd.DataFrame({"cell": list(histogram), "n": list(histogram.values())}), v)
    out = []
    for doc_id, text, held in rows:
        t, base, total = _tokens(text), 0.0, 0.0
        for h, w in zip(["<s>", *t[:-1]], t):
            c = contexts[h]
            a = weights[int(math.log2(c)) + 1 if c else 0]
            base += math.log10((unigrams[w] + 0.5) / (n + 0.5 * (v + 1)))
            total += math.log10(a[0] / (v + 1) + a[1] * unigrams[w] / n + a[2] * (pairs[h, w] / c if c else 0))
        out.append((doc_id, held, len(t), sum(unigrams[w] > 0 for w in t), n, base, total))
    return out


@pytest.mark.parametrize("block_tokens", [4_000_000, 150])
def test_scores_against_brute_force(spark, block_tokens):
    rows = _rows()
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, held boolean, score string").repartition(3)
    key = lambda r: (str(r[0]), r[5])
    got = sorted(map(tuple, lm.score(docs, block_tokens).collect()), key=key)
    want = sorted(_brute(rows), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want])
    held = [(g[5], g[6]) for g in got if g[1] and g[2] > 5]
    assert sum(s for _, s in held) > sum(b for b, _ in held)  # the mixture predicts held-out texts better than the unigram


def test_probabilities_of_a_context_sum_to_one():
    weights = lm.learned_weights(pd.DataFrame({"cell": [3 << 40 | 5 << 20 | 9, 3 << 40 | 0 << 20 | 20, 0 << 40 | 0 << 20 | 9], "n": [10, 5, 4]}), 100)
    assert np.allclose(weights.sum(axis=1), 1) and weights[0, 2] == 0 and (weights[:, 0] > 0).all()


def test_edges(spark):
    schema = "doc_id long, text string, held boolean"
    assert lm.score(spark.createDataFrame([], schema)).count() == 0
    only = lm.score(spark.createDataFrame([(1, "a b", True), (2, None, True)], schema)).collect()
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in only) == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]


def test_packed_numbers():
    r = np.random.default_rng(1)
    for values in (np.zeros(0, np.uint64), np.array([2**64 - 1, 0], np.uint64), np.sort(r.integers(0, 2**63, 5000).astype(np.uint64)), r.integers(0, 5, 900).astype(np.uint64)):
        assert (lm.unpacked(lm.packed(values)) == values).all()
