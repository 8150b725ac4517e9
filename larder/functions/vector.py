"""Vector expressions over ``array<float>`` columns, and the default embedder."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F, types as T

from larder import fixed


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a, b) -> Column:
    """Dot product in double precision; the cosine when both sides are unit vectors."""
    products = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def l2_norm(v) -> Column:
    squares = F.transform(_col(v), lambda x: x.cast("double") * x.cast("double"))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, s: total + s))


def normalised(v) -> Column:
    """Unit vector; a zero vector stays as it is."""
    length = F.nullif(l2_norm(v), F.lit(0.0))
    return F.transform(_col(v), lambda x: x.cast("double") / F.coalesce(length, F.lit(1.0)))


class _Slots(dict):
    """Slot per word, computed at first sight; emptied when the vocabulary seen grows too large."""

    LIMIT = 1 << 18

    def __init__(self, dim: int):
        super().__init__()
        self.dim = dim

    def __missing__(self, word: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        slot = self[word] = int(hashlib.md5(word.encode("utf-8")).hexdigest()[:8], 16) % self.dim
        return slot


@lru_cache(maxsize=None)
def _slots(dim: int) -> _Slots:
    return _Slots(dim)


PIECE_CHARS, PIECE_TEXTS = 1 << 20, 512  # texts of a batch are counted in pieces of about so many; a longer text is a piece by itself


def _text_pieces(texts: pa.Array) -> Iterator[pa.Array]:
    """Cut a batch between texts, so that what a task holds does not grow with the batch."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = min(max(start + 1, int(np.searchsorted(ends, before + PIECE_CHARS, "right"))), start + PIECE_TEXTS)
        yield texts.slice(start, stop - start)
        start = stop


# An ASCII byte of a word in lower case; 0 between words.
ASCII_WORD = np.array([ord(chr(c).lower()) if c < 128 and re.match(r"\w", chr(c)) else 0 for c in range(256)], np.uint8)


def _ascii_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array] | None:
    """Row and bytes of each word of a character or more, in order; None if a text has characters beyond ASCII."""
    texts = pc.cast(texts, pa.string()).fill_null("")
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    given = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    if given.max(initial=0) > 127:
        return None
    starts, code = ends[:-1] - ends[0], ASCII_WORD[given]
    inside = code > 0
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    own = starts[starts < len(code)]
    begin[own] = inside[own]  # no word goes on in the next text
    letters = code[inside]
    bounds = np.append(np.flatnonzero(begin[inside]), len(letters)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(letters)])
    return np.searchsorted(starts, np.flatnonzero(begin), "right") - 1, words


def _word_slots(texts: pa.Array, dim: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each piece of a batch its number of texts, and ``text * dim + slot`` of each word.

    Words of ASCII texts are cut and coded by Arrow, so that only a piece's distinct words become strings.
    """
    word, slots = re.compile(r"\w\w+"), _slots(dim)
    for piece in _text_pieces(texts):
        plain = _ascii_words(piece)
        if plain is not None:
            row, words = plain
            coded = words.dictionary_encode()
            slot = np.array([slots[w.decode()] if len(w) > 1 else -1 for w in coded.dictionary.to_pylist()], np.int64)
            slot = slot[coded.indices.to_numpy()]
            row, flat = row[slot >= 0], slot[slot >= 0]
        else:
            found = [[slots[w] for w in word.findall((text or "").lower())] for text in piece.to_pylist()]
            row = np.repeat(np.arange(len(found)), [len(f) for f in found])
            flat = np.fromiter(chain.from_iterable(found), np.int64, len(row))
        yield len(piece), row * dim + flat


def hashed_embedder(dim: int = fixed.EMBEDDING_DIM):
    """Default embedder: text column -> unit vector of hashed word counts.

    A word goes to slot ``int(first 8 hex digits of its md5) % dim``. One Arrow
    batch in, one out, no shuffle: a built-in expression would have to rebuild a
    ``dim``-long array per word, or explode every word into a shuffle.
    """

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def embed(texts: pa.Array) -> pa.Array:
        parts = [np.zeros(0, np.float32)]
        for rows, spot in _word_slots(texts, dim):
            counts = np.bincount(spot, minlength=rows * dim).reshape(rows, dim).astype(np.float64)
            length = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
            parts.append(np.divide(counts, length, out=counts, where=length > 0).astype(np.float32).ravel())
        unit = np.concatenate(parts)
        return pa.ListArray.from_arrays(np.arange(0, unit.size + 1, dim, dtype=np.int32), unit)

    return embed


SPARSE = T.StructType([T.StructField("slots", T.ArrayType(T.IntegerType())), T.StructField("weights", T.ArrayType(T.FloatType()))])


def sparse_hashed_embedder(dim: int = fixed.EMBEDDING_DIM):
    """The vectors of ``hashed_embedder`` as ``struct(slots, weights)``: only slots in use, ascending.

    A short text takes some 8 bytes a word instead of ``4 * dim``, where vectors are stored and wherever they are read.
    """

    @F.arrow_udf(SPARSE)
    def embed(texts: pa.Array) -> pa.Array:
        ends, slots, weights, last = [np.zeros(1, np.int32)], [np.zeros(0, np.int32)], [np.zeros(0, np.float32)], 0
        for rows, spot in _word_slots(texts, dim):
            used, n = np.unique(spot, return_counts=True)
            row, n = used // dim, n.astype(np.float64)
            length = np.sqrt(np.bincount(row, n * n, minlength=rows))
            slots.append((used % dim).astype(np.int32))
            weights.append((n / length[row]).astype(np.float32))
            ends.append((last + np.cumsum(np.bincount(row, minlength=rows))).astype(np.int32))
            last += len(used)
        starts = pa.array(np.concatenate(ends))
        lists = [pa.ListArray.from_arrays(starts, np.concatenate(flat)) for flat in (slots, weights)]
        return pa.StructArray.from_arrays(lists, fields=[pa.field("slots", lists[0].type), pa.field("weights", lists[1].type)])

    return embed
