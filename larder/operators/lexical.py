"""TF-IDF index and lexical top-k.

The vocabulary has at most ``max_features`` rows, so every task may hold it. Words are found by a built-in expression;
each Arrow batch of them is counted as codes, so a term becomes a string once for a batch and texts are not shuffled. A
vector is sparse, ``struct(slots array<int>, weights array<double>)``, and goes through the same block join as dense
vectors: requests and items are never equi-joined by term, so a term that is in every document costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from larder import fixed
from larder.functions import text as tx
from larder.operators.similarity import Scoring, top_k, written

# Texts of a batch are counted in pieces of about so many words; a longer text is a piece by itself.
PIECE_WORDS = 1 << 18


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Cut a batch ``(id, words)`` between texts."""
    ends = np.cumsum(pc.list_value_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + PIECE_WORDS, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def _coded(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Owner row and code of each word, the words by code, and the places whose next word is in the same text."""
    owner = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False))
    words = lists.flatten().dictionary_encode()
    codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return owner, codes, words.dictionary, np.flatnonzero(owner[1:] == owner[:-1])


def term_tallies(docs: DataFrame, text: str, id_column: str = "item_id") -> DataFrame:
    """Words and pairs of neighbouring words with their count in a piece of a task, ``term, n``: partial sums."""

    def tally(batches):
        for batch in batches:
            for piece in _pieces(batch):
                _, codes, words, first = _coded(piece.column(1))
                if not len(codes):
                    continue
                yield pa.record_batch({"term": words, "n": np.bincount(codes, minlength=len(words)).astype(np.int64)})
                pairs, n = np.unique(codes[first] * len(words) + codes[first + 1], return_counts=True)
                terms = pc.binary_join_element_wise(words.take(pa.array(pairs // len(words))), words.take(pa.array(pairs % len(words))), " ")
                yield pa.record_batch({"term": terms, "n": n.astype(np.int64)})

    return docs.select(id_column, tx.search_tokens(text).alias("_w")).mapInArrow(tally, "term string, n long")


def top_terms(docs: DataFrame, text: str, max_features: int = fixed.TFIDF_FEATURES, id_column: str = "item_id") -> DataFrame:
    """The most frequent terms with a slot each: ``term, slot, tf``."""
    counts = term_tallies(docs, text, id_column).groupBy("term").agg(F.sum("n").alias("tf"))
    kept = counts.orderBy(F.desc("tf"), F.asc("term")).limit(max_features)
    # At most max_features rows reach this ordering.
    slot = F.row_number().over(Window.orderBy("term")) - 1
    return kept.select("term", slot.alias("slot"), "tf")


class Terms:
    """The vocabulary as a task looks it up: slots of words by code, slots of pairs by the codes of their two words."""

    def __init__(self, terms: list[str], slots: list[int]):
        parts = [term.split(" ") for term in terms]
        self.size = max(slots, default=-1) + 1
        self.names = pa.array(sorted({w for p in parts for w in p}), pa.string())
        code = {w: i for i, w in enumerate(self.names.to_pylist())}
        self.word_slot = np.full(len(code) + 1, -1)  # the last place is for words that are in no term
        pairs = []
        for p, slot in zip(parts, slots):
            if len(p) == 1:
                self.word_slot[code[p[0]]] = slot
            else:
                pairs.append((code[p[0]] * len(code) + code[p[1]], slot))
        self.pair_key, self.pair_slot = np.array(sorted(pairs), np.int64).reshape(-1, 2).T

    def entries(self, lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Owner row, slot and count of the known terms of each text, by row and slot."""
        owner, codes, words, first = _coded(lists)
        known = pc.index_in(words, value_set=self.names).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        name = known[codes] if len(codes) else codes
        single = self.word_slot[name]
        a, b = name[first], name[first + 1]
        both = (a >= 0) & (b >= 0)
        key, rows = (a * len(self.names) + b)[both], owner[first][both]
        spot = np.searchsorted(self.pair_key, key)
        found = spot < len(self.pair_key)
        found[found] = self.pair_key[spot[found]] == key[found]
        owners = np.concatenate([owner[single >= 0], rows[found]])
        slots = np.concatenate([single[single >= 0], self.pair_slot[spot[found]]])
        cells, n = np.unique(owners * max(self.size, 1) + slots, return_counts=True)
        return cells // max(self.size, 1), cells % max(self.size, 1), n


def _lists(rows: int, owner: np.ndarray, **fields: np.ndarray) -> dict[str, pa.ListArray]:
    offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=rows))]).astype(np.int32))
    return {name: pa.ListArray.from_arrays(offsets, pa.array(values)) for name, values in fields.items()}


def _unit(rows: int, owner: np.ndarray, slots: np.ndarray, n: np.ndarray, idf: np.ndarray) -> pa.StructArray:
    """Unit TF-IDF vectors; a text without known terms has an empty one."""
    raw = n * idf[slots]
    length = np.sqrt(np.bincount(owner, raw * raw, minlength=rows))
    parts = _lists(rows, owner, slots=slots.astype(np.int32), weights=raw / length[owner])
    return pa.StructArray.from_arrays(list(parts.values()), list(parts))


_VECTOR = "struct<slots:array<int>,weights:array<double>>"


def _id_type(df: DataFrame, id_column: str) -> str:
    return f"`{id_column}` {df.schema[id_column].dataType.simpleString()}"


def term_counts(docs: DataFrame, text: str, terms: Terms, id_column: str = "item_id") -> DataFrame:
    """``(id, slots, counts)``: the known terms of each text by slot, one row for each given row, made where the text lies."""

    def count(batches):
        for batch in batches:
            for piece in _pieces(batch):
                owner, slots, n = terms.entries(piece.column(1))
                yield pa.record_batch({id_column: piece.column(0), **_lists(piece.num_rows, owner, slots=slots.astype(np.int32), counts=n.astype(np.int64))})

    rows = docs.select(id_column, tx.search_tokens(text).alias("_w"))
    return rows.mapInArrow(count, f"{_id_type(docs, id_column)}, slots array<int>, counts array<long>")


def weighted(counts: DataFrame, idf: np.ndarray, id_column: str = "item_id") -> DataFrame:
    """Unit TF-IDF vectors ``(id, embedding)`` from ``(id, slots, counts)``."""

    def weigh(batches):
        for batch in batches:
            slots, n = batch.column("slots"), batch.column("counts")
            owner = np.repeat(np.arange(batch.num_rows), pc.list_value_length(slots).to_numpy(zero_copy_only=False))
            flat = [c.flatten().to_numpy(zero_copy_only=False) for c in (slots, n)]
            yield pa.record_batch({id_column: batch.column(id_column), "embedding": _unit(batch.num_rows, owner, *flat, idf)})

    return counts.mapInArrow(weigh, f"{_id_type(counts, id_column)}, embedding {_VECTOR}")


@dataclass(frozen=True)
class TfidfIndex:
    """A fitted index: both tables are written, so no use of it repeats the fit."""

    vocabulary: DataFrame  # term, slot, tf, df, idf
    item_vectors_: DataFrame  # item_id, embedding
    terms: Terms
    idf: np.ndarray  # by slot, at most max_features numbers

    def item_vectors(self) -> DataFrame:
        return self.item_vectors_

    def vectors(self, docs: DataFrame, text: str, id_column: str) -> DataFrame:
        """Vectors of other texts, in one pass over them."""
        terms, idf = self.terms, self.idf

        def make(batches):
            for batch in batches:
                for piece in _pieces(batch):
                    yield pa.record_batch({id_column: piece.column(0), "embedding": _unit(piece.num_rows, *terms.entries(piece.column(1)), idf)})

        rows = docs.select(id_column, tx.search_tokens(text).alias("_w"))
        return rows.mapInArrow(make, f"{_id_type(docs, id_column)}, embedding {_VECTOR}")


def fit(items: DataFrame, text: str = "text_full", max_features: int = fixed.TFIDF_FEATURES) -> TfidfIndex:
    """Choose the terms, count them per item, and weigh them by the items they occur in."""
    found = written(top_terms(items, text, max_features), "tfidf-terms")
    named = found.orderBy("slot").select("term", "slot").toArrow()  # at most max_features rows
    terms = Terms(named["term"].to_pylist(), named["slot"].to_pylist())
    counts = written(term_counts(items, text, terms), "tfidf-counts")
    per_slot = counts.select(F.explode("slots").alias("slot")).groupBy("slot").agg(F.count("*").alias("df"))
    total = counts.count()
    idf = F.log((1 + total) / (1 + F.col("df"))) + 1
    vocabulary = written(found.join(F.broadcast(per_slot), "slot").select("term", "slot", "tf", "df", idf.alias("idf")), "tfidf-vocabulary")
    by_slot = vocabulary.select("slot", "idf").orderBy("slot").toArrow()["idf"].to_numpy()
    return TfidfIndex(vocabulary, written(weighted(counts, by_slot), "tfidf-vectors"), terms, by_slot)


def postings(vectors: DataFrame, id_column: str = "item_id") -> DataFrame:
    """Sparse vectors as rows ``(id, slot, weight)``."""
    return vectors.select(id_column, F.inline(F.arrays_zip("embedding.slots", "embedding.weights"))).toDF(
        id_column, "slot", "weight"
    )


def by_text(
    requests: DataFrame, index: TfidfIndex, k: int = fixed.TOP_K, *, text: str = "text", attach: DataFrame | None = None, **bounds
) -> DataFrame:
    """The ``k`` most similar items per request."""
    asked = index.vectors(requests, text, "query_id")
    return top_k(asked, index.item_vectors(), k, Scoring(), attach=attach, **bounds)
