import re

from larder.llm import decontamination

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _tokens(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORDS.findall(lowered)


def _brute(docs, items, size=10):
    out = []
    for doc_id, text in docs:
        words, hit, found = _tokens(text), set(), set()
        for item, item_text in items:
            w = _tokens(item_text)
            for i in range(max(len(w) - size + 1, 1) if w else 0):
                part = w[i : i + size]
                for j in range(len(words) - len(part) + 1):
                    if words[j : j + len(part)] == part:
                        hit.update(range(j, j + len(part)))
                        if item is not None:
                            found.add(str(item))
        out.append((doc_id, len(words), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


LONG = "Where did the Quick-brown fox of 1999 jump over Ünïcode dogs and then rest"
DOCS = [
    (1, f"before!! {LONG.upper()}; after"), (2, None), (3, ""), (4, "short item here, SHORT item"), (5, "quick brown fox"), (6, f"{LONG} {LONG}"), (6, f"{LONG} {LONG}"),
    (7, "x " * 5000 + LONG.replace(" ", "\n\t") + " y" * 5000), (None, LONG), (8, "no short itemx"), (9, "short_item"), (10, "...")]
ITEMS = [(10, LONG), (2, "Short item"), (33, ""), (34, None), (None, "no"), (11, LONG)]


def _got(spark, docs, items, **more):
    docs = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, items string")
    items = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    rows = decontamination.scan(docs, items, **more).withColumn("n_hit", decontamination.n_hit()).collect()
    return rows, sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in rows), key=str)


def test_hits_against_brute_force(spark):
    rows, got = _got(spark, DOCS, ITEMS)
    want = _brute(DOCS, ITEMS)
    assert got == want
    texts = {i: t for i, t in DOCS}
    for r in rows:
        for span in r["spans"]:
            cut = texts[r["doc_id"]][span["from"] : span["to"]]
            assert len(_tokens(cut)) == span["last"] - span["first"] + 1


def test_several_blocks_give_the_same(spark):
    assert _got(spark, DOCS, ITEMS, block_bytes=100)[1] == _brute(DOCS, ITEMS)


def test_empty_tables(spark):
    assert _got(spark, [], ITEMS)[1] == []
    assert all(n == 0 for _, _, n, _ in _got(spark, DOCS, [])[1])
