"""Links between the tokens of two tokenizers, by products of sparse token-byte matrices.

Both tokenizers cut the same bytes. Incidence matrices in compressed sparse rows (CSR) say which token holds which byte: A has a row for each
token of the first tokenizer, Bt (the second one's, transposed) a row for each byte. Gustavson's row products give A Bt: row i gathers the rows of Bt that row i
of A names, so an entry (i, j) is a pair of tokens that overlap and its value the bytes they share. Offsets where tokens of both end cut the bytes
into groups; the product of the two token-group matrices has an entry for each pair of tokens in one group. Of that product only the symbolic phase is run
for counts (how many entries a row has), so a long group is never expanded to all its pairs; ``shared_groups`` gives the pairs themselves in bounded runs.

No token of either vocabulary holds a blank between two things that are not white space, so both tokenizers cut a text at every single blank between
words, a group ends there, and the product for a text is block-diagonal over its words. The blocks are computed once for each distinct word; a text's links
are a further Gustavson product, (texts x words) times (words x id pairs).

Counts over the corpus: a block of documents has its distinct id pairs once. Pairs are added up by partial aggregates, each block gets the counts of
its own pairs back, and the sums for its documents are that matrix times the vector of counts. Nothing is broadcast and no hot pair has more rows than there are blocks.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import filled, stored

BLOCK_CHARS = 4_000_000  # of text; a longer document is a block of its own
CACHED_WORDS, CACHED_CHARS = 240_000, 8_000_000  # of distinct words a worker keeps; beyond it only those that several blocks held stay
LEARNED_WORDS, LEARNED_CHARS = 8_000, 1_000_000  # of new words at a time; a longer word is learned by itself
EXPANDED = 500_000  # entries of one run of a product before equal ones are added up
FILE_BLOCKS = 8  # a file's blocks are read at once
_BLANK, _PAIR = "▁", 32


# --- sparse matrices ------------------------------------------------------------------------------


@dataclass
class Csr:
    """Row i has ``columns[starts[i]:starts[i + 1]]`` with ``values`` there."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @classmethod
    def of(cls, starts, columns, width: int, values=None) -> Csr:
        columns = np.asarray(columns, np.int64)
        return cls(np.asarray(starts, np.int64), columns, np.ones(len(columns), np.int64) if values is None else np.asarray(values, np.int64), width)

    @property
    def height(self) -> int:
        return len(self.starts) - 1

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(self.height), np.diff(self.starts))

    def times(self, vector: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows(), weights=self.values * vector[self.columns], minlength=self.height).astype(np.int64)


def expanded_sizes(a: Csr, b: Csr) -> np.ndarray:
    """The symbolic phase: how many entries each row of A B has before equal columns are added up."""
    filled_to = np.concatenate([[0], np.cumsum(np.diff(b.starts)[a.columns])])
    return filled_to[a.starts[1:]] - filled_to[a.starts[:-1]]


def row_products(a: Csr, b: Csr, most: int = EXPANDED) -> Iterator[Csr]:
    """The numeric phase of A B by Gustavson, in runs of rows that expand to about ``most`` entries."""
    before = np.concatenate([[0], np.cumsum(expanded_sizes(a, b))])
    first = 0
    while first < a.height:
        last = max(first + 1, int(np.searchsorted(before, before[first] + most, "right")) - 1)
        low, high = a.starts[first], a.starts[last]
        picked = a.columns[low:high]
        sizes = b.starts[picked + 1] - b.starts[picked]
        total = int(sizes.sum())
        at = np.repeat(b.starts[picked] - (np.cumsum(sizes) - sizes), sizes) + np.arange(total)
        owner = np.repeat(np.repeat(np.arange(last - first), np.diff(a.starts[first : last + 1])), sizes)
        key = owner * b.width + b.columns[at]
        value = np.repeat(a.values[low:high], sizes) * b.values[at]
        if np.any(key[1:] < key[:-1]):
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if total else np.zeros(0, np.int64)
        key, value = key[new], np.add.reduceat(value, new) if total else value
        yield Csr.of(np.searchsorted(key, np.arange(last - first + 1) * b.width), key % b.width, b.width, value)
        first = last


def product(a: Csr, b: Csr) -> Csr:
    """A B as one matrix."""
    parts = list(row_products(a, b))
    starts, at = [np.zeros(1, np.int64)], 0
    for p in parts:
        starts.append(p.starts[1:] + at)
        at += len(p.columns)
    none = [np.zeros(0, np.int64)]
    return Csr(np.concatenate(starts), np.concatenate([p.columns for p in parts] or none), np.concatenate([p.values for p in parts] or none), b.width)


@dataclass
class Aligned:
    """Two token sequences over the same bytes."""

    overlap: Csr  # A tokens x B tokens: bytes shared
    groups_a: Csr  # A tokens x groups
    groups_b: Csr  # groups x B tokens
    n_groups: int

    def shared_groups(self, most: int = EXPANDED) -> Iterator[Csr]:
        """Pairs of tokens in one group, in runs of A tokens."""
        return row_products(self.groups_a, self.groups_b, most)


def align(lengths_a: np.ndarray, lengths_b: np.ndarray) -> Aligned:
    """The products for two sequences of token lengths in bytes, none 0, with one sum."""
    ends_a, ends_b = np.cumsum(lengths_a), np.cumsum(lengths_b)
    n = int(ends_a[-1]) if len(ends_a) else 0
    bytes_of_a = Csr.of(np.concatenate([[0], ends_a]), np.arange(n), n)
    token_of_byte = Csr.of(np.arange(n + 1), np.repeat(np.arange(len(lengths_b)), lengths_b), len(lengths_b))
    common = np.intersect1d(ends_a, ends_b, assume_unique=True)
    group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
    groups_a = Csr.of(np.arange(len(ends_a) + 1), group_a, len(common))
    groups_b = Csr.of(np.searchsorted(group_b, np.arange(len(common) + 1)), np.arange(len(ends_b)), len(ends_b))
    return Aligned(product(bytes_of_a, token_of_byte), groups_a, groups_b, len(common))


# --- words ----------------------------------------------------------------------------------------


def byte_level() -> dict[str, int]:
    """The byte of each letter of byte-level vocabularies: printable Latin-1 stands for itself, other bytes for the letters from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {**{chr(b): b for b in printable}, **{chr(256 + i): b for i, b in enumerate(others)}}


def words_of(text: str) -> list[str]:
    """The text cut at each single blank between words; the blank is left out. Blanks next to white space or an end stay inside."""
    parts = text.split(" ")
    if "" not in parts and not any(p[0].isspace() for p in parts):
        return parts
    joined, open_ = [parts[0]], parts[0] == ""
    for p in parts[1:]:
        if p == "" or p[0].isspace() or open_:
            joined[-1] += " " + p
        else:
            joined.append(p)
        open_ = p == ""
    return joined


class Words:
    """What a worker knows of distinct words: counts, the groups as text, and a CSR row of id pairs for each."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        letters = byte_level()
        special = self.a.get_added_tokens_decoder()
        pieces_a = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.bytes_a = [s.encode() if i in special else bytes(letters[c] for c in s) for i, s in enumerate(pieces_a)]
        pieces_b = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(s[3:-1], 16)]) if self.b.is_byte(i) else s.replace(_BLANK, " ").encode() for i, s in enumerate(pieces_b)]
        inner = re.compile(f"[^{_BLANK}]{_BLANK}")
        if any(inner.search(s) for s in pieces_b) or any(" " in x.decode(errors="replace").strip() for i, x in enumerate(self.bytes_a) if i not in special):
            raise ValueError("a vocabulary with tokens across words")
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.text: list[str] = []
        self.counts = np.zeros((0, 6), np.int64)  # n_a, n_b, n_groups, n_links, n_group_links, whether the bytes are equal
        self.pairs = Csr.of([0], [], 0)  # columns are id pairs: a << 32 | b
        self.uses = np.zeros(0, np.int64)  # blocks that held the word
        self.chars = 0

    def shrink(self) -> None:
        """Forget the words of one block alone, and the rarer of the others beyond half of the bounds."""
        often = np.flatnonzero(self.uses > 1)
        often = often[np.argsort(-self.uses[often], kind="stable")]
        words = list(self.place)  # by place
        chars = np.cumsum([len(words[i]) + len(self.text[i]) for i in often.tolist()])
        kept = np.sort(often[: min(CACHED_WORDS // 2, int(np.searchsorted(chars, CACHED_CHARS // 2, "right")))])
        sizes = np.diff(self.pairs.starts)[kept]
        spots = np.repeat(self.pairs.starts[kept] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        self.pairs = Csr.of(np.concatenate([[0], np.cumsum(sizes)]), self.pairs.columns[spots], 0, self.pairs.values[spots])
        self.place = {words[i]: at for at, i in enumerate(kept.tolist())}
        self.text = [self.text[i] for i in kept.tolist()]
        self.counts, self.uses = self.counts[kept], np.ones(len(kept), np.int64)
        self.chars = sum(map(len, self.place)) + sum(map(len, self.text))

    def learn_all(self, new: list[str]) -> None:
        """Learn words in bounded runs, and join what is known once."""
        counts, starts, columns, values = [self.counts], [self.pairs.starts], [self.pairs.columns], [self.pairs.values]
        first = size = 0
        for i, word in enumerate(new):
            if i > first and (i - first >= LEARNED_WORDS or size + len(word) > LEARNED_CHARS):
                self._learned(new[first:i], counts, starts, columns, values)
                first, size = i, 0
            size += len(word)
        if first < len(new):
            self._learned(new[first:], counts, starts, columns, values)
        self.counts = np.concatenate(counts)
        self.pairs = Csr.of(np.concatenate(starts), np.concatenate(columns), 0, np.concatenate(values))
        self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int64)])

    def _learned(self, new: list[str], counts: list, starts: list, columns: list, values: list) -> None:
        found, pairs = self.learn(new)
        counts.append(found)
        starts.append(starts[-1][-1] + pairs.starts[1:])
        columns.append(pairs.columns)
        values.append(pairs.values)

    def learn(self, new: list[str]) -> tuple[np.ndarray, Csr]:
        """Counts and id pairs of some new words; their places and groups are kept."""
        spaced = [" " + w for w in new]
        ids_a = [e.ids for e in self.a.encode_batch_fast(spaced, add_special_tokens=False)]
        ids_b = self.b.encode(new, num_threads=1)
        whole = [bool(w) and b"".join([self.bytes_a[i] for i in x]) == (raw := s.encode()) and b"".join([self.bytes_b[i] for i in y]) == raw for w, s, x, y in zip(new, spaced, ids_a, ids_b)]
        ids_a, ids_b = [x if ok else [] for x, ok in zip(ids_a, whole)], [y if ok else [] for y, ok in zip(ids_b, whole)]
        flat_a, flat_b = np.array([i for x in ids_a for i in x], np.int64), np.array([i for y in ids_b for i in y], np.int64)
        found = align(np.array([len(self.bytes_a[i]) for i in flat_a.tolist()], np.int64), np.array([len(self.bytes_b[i]) for i in flat_b.tolist()], np.int64))
        cut_a, cut_b = np.concatenate([[0], np.cumsum([len(x) for x in ids_a])]), np.concatenate([[0], np.cumsum([len(y) for y in ids_b])])
        links = found.overlap
        group_of_a = found.groups_a.columns
        cut_groups = np.concatenate([group_of_a, [found.n_groups]])[cut_a]
        per_token = expanded_sizes(found.groups_a, found.groups_b)
        in_groups = np.concatenate([[0], np.cumsum(per_token)])
        cut_links = links.starts[cut_a]
        columns = [np.diff(cut_a), np.diff(cut_b), np.diff(cut_groups), np.diff(cut_links), np.diff(in_groups[cut_a]), np.array(whole, np.int64)]
        texts = self._groups(found, flat_a, flat_b, cut_groups)
        self.text.extend(texts)
        self.chars += sum(map(len, new)) + sum(map(len, texts))
        pair = (flat_a[links.rows()] << _PAIR) | flat_b[links.columns]
        owner = np.repeat(np.arange(len(new)), np.diff(cut_links))
        order = np.lexsort((pair, owner))
        pair, owner = pair[order], owner[order]
        first = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (owner[1:] != owner[:-1])])) if len(pair) else np.zeros(0, np.int64)
        times = np.diff(np.concatenate([first, [len(pair)]]))
        starts = np.searchsorted(owner[first], np.arange(len(new) + 1))
        at = len(self.place)
        self.place.update({w: at + i for i, w in enumerate(new)})
        return np.stack(columns, axis=1), Csr.of(starts, pair[first], 0, times)

    @staticmethod
    def _groups(found: Aligned, flat_a: np.ndarray, flat_b: np.ndarray, cut_groups: np.ndarray) -> list[str]:
        """The groups of each word as text, ``a1,a2|b1`` joined by semicolons."""
        ends_a = np.searchsorted(found.groups_a.columns, np.arange(found.n_groups + 1)).tolist()
        ends_b = found.groups_b.starts.tolist()
        a, b = list(map(str, flat_a.tolist())), list(map(str, flat_b.tolist()))
        groups = [f"{','.join(a[ends_a[g] : ends_a[g + 1]])}|{','.join(b[ends_b[g] : ends_b[g + 1]])}" for g in range(found.n_groups)]
        cuts = cut_groups.tolist()
        return [";".join(groups[x:y]) for x, y in zip(cuts[:-1], cuts[1:])]


_WORDS: dict[tuple[str, str], Words] = {}


def _words(a: str, b: str) -> Words:
    if (a, b) not in _WORDS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers

        _WORDS[a, b] = Words(*[x if "/" in x else public_tokenizers.path(x) for x in (a, b)])
    return _WORDS[a, b]


# --- documents ------------------------------------------------------------------------------------

NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_group_links"]
BLOCKS = "block long, doc_ids array<long>, " + ", ".join(f"{n} array<long>" for n in NUMBERS) + ", shas array<string>, pairs array<long>, docs_with array<long>, starts array<long>, columns array<long>, times array<long>"
_LONGS = pa.list_(pa.int64())
_BLOCKS = pa.schema([("block", pa.int64()), ("doc_ids", _LONGS), *[(n, _LONGS) for n in NUMBERS], ("shas", pa.list_(pa.string())), *[(n, _LONGS) for n in ("pairs", "docs_with", "starts", "columns", "times")]])


def _block(known: Words, texts: list[str]) -> dict:
    """The numbers of some texts and their matrix (texts x distinct id pairs), by the words they hold."""
    if len(known.place) > CACHED_WORDS or known.chars > CACHED_CHARS:
        known.shrink()
    lists = [words_of(t) if t else [] for t in texts]
    place = known.place
    new = list(dict.fromkeys(w for some in lists for w in some if w not in place))
    known.learn_all(new)
    at = [[place[w] for w in some] for some in lists]
    del lists, new
    bad = set(np.flatnonzero(known.counts[:, 5] == 0).tolist())
    if bad:
        at = [[] if not bad.isdisjoint(some) else some for some in at]
    text = known.text
    shas = [hashlib.sha256(";".join([text[i] for i in some]).encode()).hexdigest() if some else "" for some in at]
    sizes = [len(some) for some in at]
    held = Csr.of(np.concatenate([[0], np.cumsum(sizes)]), np.fromiter((i for some in at for i in some), np.int64, sum(sizes)), len(known.place))
    numbers = {n: held.times(known.counts[:, k]).tolist() for k, n in enumerate(NUMBERS)}
    del at
    used, local = np.unique(held.columns, return_inverse=True)  # the words of this block
    known.uses[used] += 1
    sizes = np.diff(known.pairs.starts)[used]
    spots = np.repeat(known.pairs.starts[used] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    pairs, column = np.unique(known.pairs.columns[spots], return_inverse=True)
    of_words = Csr.of(np.concatenate([[0], np.cumsum(sizes)]), column, len(pairs), known.pairs.values[spots])
    links = product(Csr.of(held.starts, local, len(used)), of_words)
    docs_with = np.bincount(links.columns, minlength=len(pairs))
    return {**numbers, "shas": shas, "pairs": pairs, "docs_with": docs_with, "starts": links.starts, "columns": links.columns, "times": links.values}


def _blocks(a: str, b: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, known = TaskContext.get().partitionId() << 32, _words(a, b)
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            first = size = 0
            for i, chars in enumerate(pc.utf8_length(texts).to_pylist()):
                size += chars
                if size >= BLOCK_CHARS or i + 1 == len(texts):
                    found = _block(known, texts.slice(first, i + 1 - first).to_pylist())
                    row = {"block": block, "doc_ids": ids.slice(first, i + 1 - first).to_pylist(), **found}
                    yield pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in _BLOCKS], schema=_BLOCKS)
                    block, first, size = block + 1, i + 1, 0

    return work


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, n, best): how many documents hold an id pair linked, and whether its A id has none with more."""
    held = blocks.select(F.explode(F.arrays_zip("pairs", "docs_with")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.docs_with").alias("n"))
    counted = stored(held.withColumn("a", F.shiftright("pair", _PAIR)), "alignment-pairs")
    highest = counted.groupBy("a").agg(F.max("n").alias("most"))
    return counted.join(highest, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, n_group_links long"
_ALIGNED = pa.schema([("doc_id", pa.int64()), *[(n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")], ("groups_sha256", pa.string()), ("n_group_links", pa.int64())])


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(n).slice(i, 1) for n in batch.schema.names}
            flat = lambda n: row[n].flatten()
            answers = row["answers"].flatten() if row["answers"][0].is_valid else None
            n = answers.field("n").to_numpy() if answers is not None else np.zeros(0, np.int64)
            best = answers.field("best").to_numpy(zero_copy_only=False).astype(np.int64) if answers is not None else n
            links = Csr.of(flat("starts").to_numpy(), flat("columns").to_numpy(), len(n), flat("times").to_numpy())
            numbers = {**{k: flat(k) for k in NUMBERS}, "doc_id": flat("doc_ids"), "groups_sha256": flat("shas"), "n_best": pa.array(links.times(best)), "count_sum": pa.array(links.times(n))}
            yield pa.RecordBatch.from_arrays([numbers[f.name].cast(f.type) for f in _ALIGNED], schema=_ALIGNED)


def align_documents(docs: DataFrame, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_group_links.

    Tokens are those of blank + text. ``n_links`` counts overlapping token pairs, ``n_group_links`` pairs in one group; the count of an id pair is the number
    of rows that hold it linked, ``count_sum`` adds it up over the links and ``n_best`` counts links whose count is the highest of their A id, ties included. Null
    or empty text and text whose bytes a tokenizer changes: zeros and an empty digest. Repeated rows count each; a null doc_id is kept. Other columns are not
    read. No rows: no rows.
    """
    blocks = stored(docs.select("doc_id", filled("text").alias("text")).mapInArrow(_blocks(a, b), BLOCKS), "alignment-blocks", FILE_BLOCKS)
    asked = blocks.select("block", F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(pair_counts(blocks), "pair").groupBy("block").agg(F.array_sort(F.collect_list(F.struct("place", "n", "best"))).alias("answers"))  # the block's own pairs
    needed = blocks.select("block", "doc_ids", *NUMBERS, "shas", "starts", "columns", "times")
    return needed.join(answers, "block", "left").mapInArrow(_sums, ALIGNED)
