import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import public_tokenizers
from pyspark.sql import functions as F

from larder.llm import alignment

DOCS = "doc_id long, text string, block string, n_a string"


@pytest.fixture(scope="module")
def tokenizers():
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def spans_of(text, tokenizers):
    """(id, first byte, last byte) of both tokenizers over whole texts, None if one changes the bytes."""
    a, b = tokenizers
    letters = alignment.byte_level()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    whole = (" " + text).encode()
    if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return None
    out = []
    for ids, parts in ((ids_a, bytes_a), (ids_b, bytes_b)):
        ends = np.cumsum([len(p) for p in parts]).tolist()
        out.append([(i, e - len(p), e) for i, p, e in zip(ids, parts, ends)])
    return out


def brute_force(rows, tokenizers):
    per_doc, count = [], Counter()
    for doc_id, text, *_ in rows:
        spans = spans_of(text or "", tokenizers)
        links, groups, in_groups = [], [], 0
        if spans:
            links = [(x, y) for x, s, e in spans[0] for y, t, f in spans[1] if s < f and t < e]
            cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
            low = 0
            for cut in cuts:
                a, b = ([str(i) for i, s, e in side if low <= s and e <= cut] for side in spans)
                groups.append(f"{','.join(a)}|{','.join(b)}")
                in_groups += len(a) * len(b)
                low = cut
        count.update(set(links))
        per_doc.append((doc_id, spans, links, groups, in_groups))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = []
    for doc_id, spans, links, groups, in_groups in per_doc:
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if spans else ""
        sizes = [len(s) for s in spans] if spans else [0, 0]
        out.append((doc_id, *sizes, len(groups), len(links), sum(count[x] == most[x[0]] for x in links), sum(count[x] for x in links), digest, in_groups))
    return out


ODD = [
    "", None, "a", " ", "  ", "a  b", " lead", "trail ", "a\nb\n c", "tab\t x", "naïve Übergröße façade", "日本語 テキスト 混ぜる", "<|endoftext|> and <s> here", "▁x", "x▁y", "a\x00b",
    "　z", "é ﬁ ½", "🙂🙃 emoji👩‍👩‍👧", "aaaa" * 40, "don't can't won't", "x = 12345; y=[1,2]", "\r\n \n", "a   b", "one two  three   four",
]


def by_row(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple("" if x is None else str(x) for x in r))


def test_equals_whole_texts_brute_force(spark, tokenizers):
    rows = [(i, t, "mine", "mine") for i, t in enumerate(ODD)] + [(None, "a b c", None, None), (2, "a", None, None), (2, "a", None, None)]
    rows += [(100 + i, f"some words {i} with the same words again", None, None) for i in range(20)]
    got = alignment.align_documents(spark.createDataFrame(rows, DOCS).repartition(3)).collect()
    assert by_row(got) == by_row(brute_force(rows, tokenizers))
    assert sum(r.n_a == 0 for r in got) >= 3


def test_given_texts(spark, tokenizers):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("n_chars < 2000")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = alignment.align_documents(docs).collect()
    assert len(rows) > 50 and by_row(got) == by_row(brute_force(rows, tokenizers))


def test_several_blocks_and_a_cache_that_starts_again(spark, tokenizers, monkeypatch):
    rows = [(i, f"block {i % 7} of words {i}") for i in range(60)]
    known = alignment._words("byte_bpe_50k.json", "piece_bpe_32k.model")
    monkeypatch.setattr(alignment, "CACHED_WORDS", 5)
    for i in range(0, 60, 10):
        found = alignment._block(known, [t for _, t in rows[i : i + 10]])
        assert found["n_a"] == [len(spans_of(t, tokenizers)[0]) for _, t in rows[i : i + 10]]


def test_empty_table(spark):
    assert alignment.align_documents(spark.createDataFrame([], DOCS)).count() == 0


def test_row_products_equal_dense_ones():
    rng = np.random.default_rng(2)

    def random(height, width):
        dense = rng.integers(0, 3, size=(height, width)) * (rng.random((height, width)) < 0.3)
        rows, columns = np.nonzero(dense)
        return dense, alignment.Csr.of(np.searchsorted(rows, np.arange(height + 1)), columns, width, dense[rows, columns])

    for most in (1, 7, 10_000):
        (dense_a, a), (dense_b, b) = random(13, 9), random(9, 11)
        rows = []
        for part in alignment.row_products(a, b, most):
            dense = np.zeros((part.height, 11), np.int64)
            dense[part.rows(), part.columns] = part.values
            rows.append(dense)
        assert (np.concatenate(rows) == dense_a @ dense_b).all()
    assert alignment.expanded_sizes(a, b).tolist() == [int(((dense_b[np.flatnonzero(r)] != 0).sum())) for r in dense_a]


def test_overlaps_and_groups_of_one_sequence():
    found = alignment.align(np.array([2, 3, 1]), np.array([1, 1, 2, 2]))
    dense = np.zeros((3, 4), np.int64)
    dense[found.overlap.rows(), found.overlap.columns] = found.overlap.values
    assert dense.tolist() == [[1, 1, 0, 0], [0, 0, 2, 1], [0, 0, 0, 1]]
    pairs = [(r, c) for part in found.shared_groups() for r, c in zip(part.rows().tolist(), part.columns.tolist())]
    assert pairs == [(0, 0), (0, 1), (1, 2), (1, 3), (2, 2), (2, 3)] and found.n_groups == 2


def test_a_full_cache_keeps_the_words_of_several_blocks(monkeypatch):
    known, fresh = (alignment.Words(*[public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model")]) for _ in range(2))
    blocks = [[f"the common word{i} of text {i} " + " ".join(f"w{i}x{j}" for j in range(40))] for i in range(4)]
    monkeypatch.setattr(alignment, "CACHED_WORDS", 60)
    learned = []
    learn = alignment.Words.learn
    monkeypatch.setattr(alignment.Words, "learn", lambda self, new: (learned.append((self, new)), learn(self, new))[1])
    for texts in blocks:
        fresh.clear()
        got, want = alignment._block(known, texts), alignment._block(fresh, texts)
        assert all(list(got[n]) == list(want[n]) for n in want)
    assert sum("common" in new for self, new in learned if self is known) == 1
    known.shrink()
    assert {"the", "common", "of", "text"} == set(known.place) and len(known.place) == len(known.counts) == known.pairs.height == len(known.text)
    monkeypatch.setattr(alignment, "CACHED_CHARS", 0)
    known.uses += 1
    known.shrink()
    assert not known.place and alignment._block(known, blocks[0])["shas"] == alignment._block(fresh, blocks[0])["shas"]


def test_new_words_are_learned_in_bounded_runs(monkeypatch):
    known = alignment.Words(*[public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model")])
    whole = alignment._block(known, ["a bb ccc " + "d" * 60 + " ee f"])
    known.clear()
    sizes, learn = [], alignment.Words.learn
    monkeypatch.setattr(alignment.Words, "learn", lambda self, new: (sizes.append(sum(map(len, new))), learn(self, new))[1])
    monkeypatch.setattr(alignment, "LEARNED_CHARS", 5)
    parts = alignment._block(known, ["a bb ccc " + "d" * 60 + " ee f"])
    assert sizes == [3, 3, 60, 3] and all(list(parts[n]) == list(whole[n]) for n in whole)


def test_a_file_has_few_blocks(spark, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_CHARS", 10)
    docs = spark.createDataFrame([(i, f"some words {i} of a text") for i in range(60)], "doc_id long, text string").coalesce(1)
    names = []
    stored = alignment.stored
    monkeypatch.setattr(alignment, "stored", lambda df, label, *rows: (names.append((label, made := stored(df, label, *rows))), made)[1])
    assert alignment.align_documents(docs).count() == 60
    blocks = dict(names)["alignment-blocks"]
    assert blocks.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] <= alignment.FILE_BLOCKS
