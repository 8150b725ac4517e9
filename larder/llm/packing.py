"""Best-fit packing of documents into sequences, certified by dual feasible functions.

Documents become ids; only what is longer than a sequence is cut, into whole sequences and a rest. Pieces are dealt out
to groups, and each group is packed by best-fit decreasing. A dual feasible function maps lengths to [0, 1] so that what fits
one bin never sums to more than 1; the largest rounded sum over two families of them is a bound that no packing of the
group goes below. A group that meets its bound is certified. Groups with a gap give up all their pieces, certified ones those of their
emptiest sequences; these pieces are dealt out anew, to other and larger groups, and packed again. A round that saves nothing is not
taken over. It ends when the bound of the whole table is met, or after ``ROUNDS``.

Only (key, length) takes part in the rounds; ids are moved when the sequences are put together.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import filled, stored

CAPACITY = 4096
GROUP_PIECES = 100_000  # pieces packed by one task in the first round
LARGEST_GROUP = 8  # times that number in later rounds
ROUNDS = 6
FUNCTIONS = 64  # members of the second family that are tried
CACHED_WORDS = 400_000  # distinct runs, and other words, that a worker keeps; beyond it the cache starts again
ENCODED_TEXTS = 500  # texts whose words are coded together


# --- ids ------------------------------------------------------------------------------------------


class WordEncoder:
    """Ids of texts by the tokenizers library for a vocabulary whose words end at white space.

    White space is dropped and no token spans it, so a text's ids are those of its words. A batch's words are coded by Arrow and only distinct
    ones looked at; most are letters, with or without other signs behind them. These are two runs for the library's own splitter too, each distinct one
    encoded once, and letters that are lower-cased and composed already skip its normaliser. All other words go through the library as they are, and so does a
    whole text that holds a special token's string, as such a token may hold blanks.
    """

    # Letters up to U+024F have no combining marks and lower-case one by one; an apostrophe may begin a run of its own.
    LETTERS = "".join(c for c in map(chr, range(0x250)) if len(c.lower()) == 1 and re.fullmatch("[a-z\u00df-\u00f6\u00f8-\u024f]", c.lower()))
    SIGNS = "".join(c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum() and c != "'")

    def __init__(self, path: str, width: int):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.kind, self.width = f"<u{width}", width
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.last = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(self.tokenizer.get_vocab_size())])
        self._forget()

    def _forget(self) -> None:
        """Places of words and runs in the held ids; the empty one is the first and has none."""
        self.known: dict[str, int] = {"": 0}
        self.runs: dict[str, int] = {"": 0}
        self.ids, self.starts, self.sizes = np.zeros(0, dtype=self.kind), np.zeros(1, np.int64), np.zeros(1, np.int64)

    def _encoded(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids of each text, each of ``width`` bytes."""
        if len(self.known) > CACHED_WORDS or len(self.runs) > CACHED_WORDS:
            self._forget()
        marked = [any(s in t for s in self.special) for t in texts]
        lists = pc.split_pattern(pc.replace_substring(pa.array(["" if m else t for m, t in zip(marked, texts)], pa.string()), "\n", " "), " ")
        coded = lists.flatten().dictionary_encode()
        ids, starts, sizes = self._words(coded.dictionary)
        codes = coded.indices.to_numpy()
        ends = np.concatenate([[0], np.cumsum(sizes[codes])])[lists.offsets.to_numpy()] * self.width
        raw = _gathered(ids, starts[codes], sizes[codes]).tobytes()
        out = [raw[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        for i in np.flatnonzero(marked).tolist():
            out[i] = np.array(self._encoded([texts[i]])[0], dtype=self.kind).tobytes()
        return out

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct words, and where those of each begin and how many they are."""
        letters = pc.utf8_rtrim(words, characters=self.SIGNS)
        cut = pc.and_(pc.equal(pc.utf8_ltrim(letters, characters=self.LETTERS), ""), pc.not_equal(letters, ""))
        runs = [pc.utf8_lower(letters.filter(cut)).dictionary_encode(), pc.utf8_ltrim(words.filter(cut), characters=self.LETTERS).dictionary_encode()]
        *distinct, rest = [a.to_numpy(zero_copy_only=False).tolist() for a in (runs[0].dictionary, runs[1].dictionary, words.filter(pc.invert(cut)))]  # to_pylist is slower
        self._learn_runs(list(set().union(*distinct).difference(self.runs)))
        new = [w for w in rest if w not in self.known]
        for i in range(0, len(new), 5000):
            self._hold(self.known, new[i : i + 5000], self._encoded(new[i : i + 5000]))
        first, second = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)  # places of the word's letters and of its signs
        cut = cut.to_numpy(zero_copy_only=False)
        for places, run, some in zip((first, second), runs, distinct):
            places[cut] = np.fromiter(map(self.runs.__getitem__, some), np.int64, len(some))[run.indices.to_numpy()]
        first[~cut] = np.fromiter(map(self.known.__getitem__, rest), np.int64, len(rest))
        both = np.stack([first, second], axis=1).ravel()
        sizes = self.sizes[both].reshape(-1, 2).sum(axis=1)
        return _gathered(self.ids, self.starts[both], self.sizes[both]), np.cumsum(sizes) - sizes, sizes

    def _hold(self, places: dict[str, int], names: list[str], ids: list[list[int]]) -> None:
        sizes = np.array([len(i) for i in ids], dtype=np.int64)
        self._hold_flat(places, names, np.array([x for i in ids for x in i], dtype=self.kind), sizes)

    def _hold_flat(self, places: dict[str, int], names: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        places.update(zip(names, range(len(self.sizes), len(self.sizes) + len(names))))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes, self.ids = np.concatenate([self.sizes, sizes]), np.concatenate([self.ids, ids])

    def _learn_runs(self, new: list[str]) -> None:
        """Many runs in one call, dealt back to them by the tokens that end a word; if these are not one for each run, by a call for each."""
        for i in range(0, len(new), 20_000):
            some = new[i : i + 20_000]
            joined = [" ".join(some[k : k + 200]) for k in range(0, len(some), 200)]
            ids = np.array([x for e in self.plain.encode_batch_fast(joined, add_special_tokens=False) for x in e.ids], dtype=self.kind)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(some):
                self._hold(self.runs, some, self._encoded(some))
            else:
                self._hold_flat(self.runs, some, ids, np.diff(ends, prepend=0))


def _gathered(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``ids`` that begin at ``starts``, one after another; places are held for some of them at a time."""
    parts = [ids[:0]]
    for i in range(0, len(starts), 200_000):
        at, n = starts[i : i + 200_000], sizes[i : i + 200_000]
        ends = np.cumsum(n)
        parts.append(ids[np.repeat(at - ends + n, n) + np.arange(ends[-1])])
    return np.concatenate(parts)


_ENCODERS: dict[tuple[str, int], WordEncoder] = {}


def _path(tokenizer: str) -> str:
    import public_tokenizers

    return tokenizer if "/" in tokenizer else public_tokenizers.path(tokenizer)


def _encoder(tokenizer: str, width: int) -> WordEncoder:
    if (tokenizer, width) not in _ENCODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[tokenizer, width] = WordEncoder(_path(tokenizer), width)
    return _ENCODERS[tokenizer, width]


def id_width(tokenizer: str, end_id: int) -> int:
    """Bytes of an id: two where the vocabulary allows it, else four."""
    from tokenizers import Tokenizer

    return 2 if max(Tokenizer.from_file(_path(tokenizer)).get_vocab_size() - 1, end_id) < 1 << 16 else 4


PIECES = "key long, doc_id long, piece int, start long, length int, ids binary"
_PIECES = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()), ("ids", pa.binary())])


def pieces_of(docs: DataFrame, tokenizer: str, end_id: int, width: int, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: key (any number of its own), doc_id, piece, start, length, ids; written to the shared folder."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = _encoder(tokenizer, width), int(end_id).to_bytes(width, "little")
        key = TaskContext.get().partitionId() << 36
        step = capacity * width
        for batch in batches:
            for i in range(0, batch.num_rows, ENCODED_TEXTS):
                some = batch.slice(i, ENCODED_TEXTS)
                rows: list[tuple] = []
                for doc_id, raw in zip(some.column("doc_id").to_pylist(), encoder.encode(some.column("text").to_pylist())):
                    raw += end
                    for at in range(0, len(raw), step):
                        part = raw[at : at + step]
                        rows.append((key, doc_id, at // step, at // width, len(part) // width, part))
                        key += 1
                yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows), _PIECES.types)], schema=_PIECES)

    return stored(docs.select("doc_id", filled("text").alias("text")).mapInArrow(work, PIECES), "packing-pieces")


# --- one group ------------------------------------------------------------------------------------


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: bin and offset of each length, and how full each bin is. Equal lengths go in their given order.

    Bins lie in lists by their free room; one big integer has a bit for each room that has a bin, so the tightest
    bin that fits is the lowest bit from the length on.
    """
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, n = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, chosen, n = capacity, n, n + 1
        bins[i], offsets[i] = chosen, capacity - room
        room -= length
        if room:
            by_room[room].append(chosen)
            rooms |= 1 << room
    return bins, offsets, np.bincount(bins, weights=lengths, minlength=n).astype(np.int64)


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """No packing of ``counts[x]`` pieces of each length x needs fewer bins; exact in integers.

    Two families of dual feasible functions. By a threshold e: 1 above capacity - e, 0 below e, else the
    length's share; e = 0 is the plain sum. By k: the share x rounded down to multiples of 1/k where (k + 1) x is no integer.
    """
    x = np.arange(capacity + 1, dtype=np.int64)
    number, amount = np.cumsum(counts), np.cumsum(counts * x)
    e = np.arange(capacity // 2 + 1)
    large = number[capacity] - number[capacity - e]
    middle = amount[capacity - e] - np.where(e > 0, amount[np.maximum(e - 1, 0)], 0)
    best = int((large + -(-middle // capacity)).max())
    for k in range(1, FUNCTIONS + 1):
        scaled = (k + 1) * x
        value = np.where(scaled % capacity == 0, x * k, scaled // capacity * capacity)  # over k x capacity
        best = max(best, -(-int((counts * value).sum()) // (k * capacity)))
    return best


PACKED = "part long, key long, length int, sequence_id long, offset long, fill int, place int, bins long, bound long"


def _packer(capacity: int, turn: int):
    def pack(table: pa.Table) -> pa.Table:
        key = table.column("key").to_numpy()
        order = np.argsort(key)
        key, lengths = key[order], table.column("length").to_numpy()[order].astype(np.int64)
        part = int(table.column("part")[0].as_py())
        bins, offsets, fills = best_fit(lengths, capacity)
        place = np.empty(len(fills), np.int64)
        place[np.argsort(fills, kind="stable")] = np.arange(len(fills))
        bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        n = len(key)
        columns = [np.full(n, part), key, lengths, (turn << 56) | (part << 24) | bins, offsets, fills[bins], place[bins], np.full(n, len(fills)), np.full(n, bound)]
        return pa.table([pa.array(c, kind) for c, kind in zip(columns, _PACKED.types)], schema=_PACKED)

    return pack


_PACKED = pa.schema([("part", pa.int64()), ("key", pa.int64()), ("length", pa.int32()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("fill", pa.int32()), ("place", pa.int32()), ("bins", pa.int64()), ("bound", pa.int64())])


# --- the whole table ------------------------------------------------------------------------------


def plan(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES, rounds: int = ROUNDS) -> DataFrame:
    """(key, sequence_id, offset) of every row (key, length) of ``pieces``; keys are distinct, lengths 1 to ``capacity``.

    The driver holds counts of the lengths, ``capacity`` numbers at most.
    """
    sized = pieces.select("key", F.col("length").cast("int").alias("length"))
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in sized.groupBy("length").count().collect():  # as many rows as lengths: bounded by the capacity
        counts[length] = n
    full = sized.where(F.col("length") == capacity).select("key", (-1 - F.col("key")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    counts[capacity] = 0
    bound, left = lower_bound(counts, capacity), int(counts.sum())
    loose, settled, total = sized.where(F.col("length") < capacity), [], 0
    packed = None
    for turn in range(1, rounds + 1):
        groups = max(1, math.ceil(left / (group_pieces * min(2 ** (turn - 1), LARGEST_GROUP))))
        dealt = loose.withColumn("part", F.pmod(F.xxhash64("key", F.lit(turn)), F.lit(groups)).cast("long"))
        again = stored(dealt.groupBy("part").applyInArrow(_packer(capacity, turn), PACKED), "packing-round")
        before, now = (_bins(loose) if packed is not None else math.inf), _bins(again)
        if now < before:
            packed, total = (settled + [again]), total - (before if before < math.inf else 0) + now
        if total <= bound or turn == rounds:
            break
        given = _given_up(capacity, turn)
        settled = [p.where(~given) for p in packed]
        loose = _union([p.where(given) for p in packed])
        left = loose.count()
        if not left:
            break
    return _union([p.select("key", "sequence_id", "offset") for p in packed]).unionByName(full)


def _given_up(capacity: int, turn: int) -> Column:
    """All pieces of a group with a gap, and of a certified one those in its emptiest sequences: twice as many in each round."""
    return (F.col("bins") > F.col("bound")) | ((F.col("place") < 2 ** (turn - 1)) & (F.col("fill") < capacity))


def _bins(packed: DataFrame) -> int:
    return packed.where(F.col("offset") == 0).count()


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


SEQUENCES = "sequence_id long, n_tokens long, ids binary, spans array<struct<doc_id:long,piece:int,start:long,length:int,offset:long>>"
_SPAN = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()), ("offset", pa.int64())])
_SEQUENCES = pa.schema([("sequence_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("spans", pa.list_(_SPAN))])


def pack(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 1, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """One row per sequence: sequence_id, n_tokens, ids (little-endian u32) and the spans of the documents in it.

    Every row of ``docs`` is a document, repeated ones too; its ids are the tokenizer's and then ``end_id``. Null or empty text: the end id
    alone. Null doc_id: packed like others. Other columns are not read. No rows: no sequences. Ties of equal length go by the piece's place in the table.
    """
    width = id_width(tokenizer, end_id)
    pieces = pieces_of(docs, tokenizer, end_id, width, capacity)
    entry = F.struct(F.col("offset").cast("long").alias("offset"), "doc_id", "piece", "start", "length", "ids")
    loose = pieces.where(F.col("length") < capacity)
    gathered = loose.join(plan(loose, capacity, group_pieces), "key").groupBy("sequence_id").agg(F.array_sort(F.collect_list(entry)).alias("entries"))  # capacity entries at most
    whole = pieces.where(F.col("length") == capacity).withColumn("offset", F.lit(0)).select((-1 - F.col("key")).alias("sequence_id"), F.array(entry).alias("entries"))
    gathered = gathered.unionByName(whole)  # a piece that fills a sequence is one where it lies

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _ENCODERS.clear()  # a worker that has encoded before needs its words no longer
        for batch in (b.slice(i, 200) for b in batches for i in range(0, b.num_rows, 200)):
            lists = batch.column("entries")
            entries, cuts = lists.flatten(), lists.offsets.to_numpy()  # both of this slice alone
            cuts = cuts - cuts[0]
            raw = entries.field("ids").to_pylist()
            ids = [np.frombuffer(b"".join(raw[a:b]), f"<u{width}").astype("<u4").tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
            spans = pa.StructArray.from_arrays([entries.field(f.name) for f in _SPAN], fields=list(_SPAN))
            columns = [batch.column("sequence_id"), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary()), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), spans)]
            yield pa.RecordBatch.from_arrays(columns, schema=_SEQUENCES)

    return gathered.mapInArrow(work, SEQUENCES)


DIGESTS = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
_DIGESTS = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def read_pieces(sequences: DataFrame) -> DataFrame:
    """One row per piece, read from the sequences: where it lies, and the crc32 of its ids there."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column("spans")
            flat, sizes = spans.flatten(), np.diff(spans.offsets.to_numpy())
            owner = np.repeat(np.arange(batch.num_rows), sizes)
            lengths, offsets = flat.field("length").to_numpy(), flat.field("offset").to_numpy()
            ids = [memoryview(i) for i in batch.column("ids").to_pylist()]
            crcs = [zlib.crc32(ids[o][4 * at : 4 * (at + n)]) for o, at, n in zip(owner.tolist(), offsets.tolist(), lengths.tolist())]
            columns = [flat.field("doc_id"), flat.field("piece"), flat.field("start"), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64()), batch.column("sequence_id").take(pa.array(owner)), flat.field("offset")]
            yield pa.RecordBatch.from_arrays(columns, schema=_DIGESTS)

    return sequences.mapInArrow(work, DIGESTS)
