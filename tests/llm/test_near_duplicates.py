import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.llm import near_duplicates as nd


def _set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def _brute(rows, size, percent):
    sets, parent = [_set(t, size) for _, t in rows], list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), doc_id), doc_id)
    return sorted((doc_id, len(sets[i]), least[top(i)], doc_id == least[top(i)]) for i, (doc_id, _) in enumerate(rows))


def _families(seed, n=25, members=9):
    """Bases with copies that differ in a few words, chains of copies of copies, and texts that share passages."""
    r, rows, vocabulary = random.Random(seed), [], [f"w{i}" for i in range(3000)]
    shared = " ".join(r.choices(vocabulary, k=60))
    for _ in range(n):
        words = r.choices(vocabulary, k=r.choice([3, 12, 40, 120, 400]))
        for _ in range(r.randrange(1, members)):
            rows.append(" ".join(words))
            if r.random() < 0.7:
                words = list(words) if r.random() < 0.5 else words[:]
                for _ in range(r.randrange(0, 1 + max(1, len(words) // 25))):
                    words[r.randrange(len(words))] = r.choice(vocabulary)
        rows.append(shared + " " + " ".join(r.choices(vocabulary, k=20)))
    return rows


@pytest.mark.parametrize("size, percent, rows", [(3, 85, 6), (5, 80, 5)])
def test_components_against_all_pairs(spark, size, percent, rows):
    texts = [*_families(3), None, "", "  \n", "one two", "ONE two", "one", "three one two", "x " * 3000, "x " * 4000]
    table = [(i * 3 % 100_003, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in table], "doc_id long, text string, node string").repartition(6)
    got = nd.link(docs, size, percent, rows).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got)) == _brute(table, size, percent)


def test_star_that_misses_a_link_is_settled(spark):
    """In one bucket, texts linked only through each other and not through the centre."""
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(base[:i] + [f"n{i}_{j}" for j in range(8)] + base[i + 8 :]) for i in range(0, 160, 8)]  # 8 words changed: about 0.90 to the base, 0.82 to each other
    chain = [" ".join(f"c{k}" for k in range(s, s + 150)) for s in range(0, 120, 10)]  # a chain of overlaps
    table = list(enumerate(texts + chain + [" ".join(base)]))
    docs = spark.createDataFrame(table, "doc_id long, text string")
    got = nd.link(docs).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got)) == _brute(table, 3, 85)


def test_repeated_rows_and_ids(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "quite another text here now"), (None, "a b c d e f"), (7, "a b c d e f"), (8, None), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in nd.link(docs).collect()), key=str)
    assert got == sorted([(1, 1, True), (1, 1, True), (1, 1, True), (None, 1, False), (7, 1, False), (8, 8, True), (8, 8, True)], key=str)
    kept = sorted(((r["doc_id"], r["text"]) for r in nd.keep_one(docs).collect()), key=str)
    assert len(kept) == 3 and kept.count((8, None)) == 2
    assert nd.link(docs.where(F.lit(False))).count() == 0


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 200)], "u long, v long")
    got = {r["node"]: r["root"] for r in nd.components(edges).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 200: 100}


def test_sketch_estimates_similarity():
    r = np.random.default_rng(1)
    a = r.integers(0, 2**63, 600, dtype=np.int64).view(np.uint64)
    b = np.concatenate([a[:500], r.integers(0, 2**63, 100, dtype=np.int64).view(np.uint64)])
    found = nd.sketch(np.concatenate([a, b]), np.repeat([0, 1], 600), 2, 2000)
    assert abs((found[0] == found[1]).mean() - 500 / 700) < 0.06
    tiny = nd.sketch(a[:2], np.array([0, 0]), 1, 500)
    assert set(tiny[0].tolist()) <= set(nd._mixed(a[:2]).tolist())


def _just_below(n, changed=12):
    """A text of 400 words and copies with some words of their own, so that each is 0.83 similar to the text."""
    base = [f"b{i}" for i in range(400)]
    out = [" ".join(base)]
    for c in range(n - 1):
        words = list(base)
        for i in range(changed):
            words[(i * 23 + c * 7) % 400] = f"own{c}x{i}"
        out.append(" ".join(words))
    return out


def test_pairs_of_copies_just_below_the_threshold_grow_with_their_number(spark):
    counts = []
    for n in (50, 400):
        texts = spark.createDataFrame(list(enumerate(_just_below(n))), "node long, text string")
        keyed = nd.stored(nd.prefix_keys(texts, 3, 85), "test-keys")
        roots, none = spark.createDataFrame([], "node long, root long"), spark.createDataFrame([], "a long, b long")
        counts.append(nd._key_pairs(keyed, roots, none, 85, 0, 10**6).count())
    sets = [_set(t, 3) for t in _just_below(50)]
    similar = [len(sets[0] & b) / len(sets[0] | b) for b in sets[1:]]
    assert 0.82 < min(similar) <= max(similar) < 0.85
    assert counts[0] <= 50 and counts[1] <= 400


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_linked_sets_share_a_key(spark, size, percent):
    texts = [t for t in _families(11, 80, 14) if _set(t, size)]
    distinct = list({frozenset(_set(t, size)): t for t in texts}.values())
    sets = [_set(t, size) for t in distinct]
    keyed = nd.prefix_keys(spark.createDataFrame(list(enumerate(distinct)), "node long, text string"), size, percent).collect()
    by_key = {}
    for r in keyed:
        by_key.setdefault(r.key, set()).add(r.node)
    met = {(a, b) for nodes in by_key.values() for a in nodes for b in nodes if a < b}
    linked = {(a, b) for b in range(len(sets)) for a in range(b) if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])}
    assert len(linked) > 10 and linked <= met
