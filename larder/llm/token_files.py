"""Token files with directly addressable codes.

A segment holds the ids of some documents. Each id is split into chunks of eight bits, low
chunk first. Level 0 has the first chunk of every id and a bitmap that says which ids go on;
level 1 the second chunk of those, and so on. A rank directory counts the bitmap's ones before
every 512 bits, so any id is read with one lookup and one small popcount for each level, and
no block is decoded.

Bytes of a segment, little-endian: ``DAC1``, u32 documents, u64 ids, u32 levels; u64 start of each
document and of the end; for each level u64 entries, chunks (u8), bitmap (bit i of byte i / 8, padded to 64
bytes) and directory (u64 for each 512 bits). Segments lie uncompressed in a Parquet table below the shared folder,
with the partition and place they were written in, so Spark's commit protocol covers lost executors.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.session import fresh_path

MAGIC = b"DAC1"
SEGMENT_IDS = 1_000_000  # a segment is closed at the end of the document that reaches it
CACHED_PIECES = 1_500_000  # distinct pieces a worker keeps; beyond it the cache starts again
_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


# --- format ---------------------------------------------------------------------------------------


def pack(ids: np.ndarray, starts: np.ndarray) -> bytes:
    """A segment of ``ids`` (u32), documents beginning at ``starts`` (one more than documents)."""
    levels, left = [], ids
    while True:
        rest = left >> 8
        more = rest != 0
        bits = np.packbits(more, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % 64, dtype=np.uint8)])
        ones = _POPCOUNT[bits].reshape(-1, 64).sum(axis=1, dtype=np.uint64)
        ranks = np.cumsum(ones, dtype=np.uint64) - ones
        levels.append(b"".join([struct.pack("<Q", len(left)), left.astype(np.uint8).tobytes(), bits.tobytes(), ranks.astype("<u8").tobytes()]))
        left = rest[more]
        if not len(left):
            break
    head = MAGIC + struct.pack("<IQI", len(starts) - 1, len(ids), len(levels))
    return b"".join([head, np.asarray(starts, dtype="<u8").tobytes(), *levels])


class Segment:
    """Random access to a segment's bytes; nothing is decoded when it is opened."""

    def __init__(self, raw: bytes):
        if raw[:4] != MAGIC:
            raise ValueError("not a token segment")
        self.n_docs, self.n_ids, n_levels = struct.unpack_from("<IQI", raw, 4)
        at = 20
        self.starts = np.frombuffer(raw, "<u8", self.n_docs + 1, at)
        at += 8 * (self.n_docs + 1)
        self.levels = []
        for _ in range(n_levels):
            (n,) = struct.unpack_from("<Q", raw, at)
            n_blocks = -(-n // 512)
            chunks = np.frombuffer(raw, np.uint8, n, at + 8)
            bits = np.frombuffer(raw, np.uint8, 64 * n_blocks, at + 8 + n)
            ranks = np.frombuffer(raw, "<u8", n_blocks, at + 8 + n + 64 * n_blocks)
            self.levels.append((chunks, bits, ranks))
            at += 8 + n + 72 * n_blocks

    def id_at(self, i: int) -> int:
        """The i-th id: one chunk, bit and rank for each level."""
        if not 0 <= i < self.n_ids:
            raise IndexError(i)
        value = 0
        for depth, (chunks, bits, ranks) in enumerate(self.levels):
            value |= int(chunks[i]) << (8 * depth)
            if not (bits[i >> 3] >> (i & 7)) & 1:
                break
            block = i >> 9
            i = int(ranks[block]) + int(_POPCOUNT[bits[block << 6 : i >> 3]].sum()) + int(_POPCOUNT[bits[i >> 3] & ((1 << (i & 7)) - 1)])
        return value

    def ids(self) -> np.ndarray:
        """All ids, level by level."""
        if not self.n_ids:
            return np.zeros(0, dtype="<u4")
        values, where = self.levels[0][0].astype("<u4"), None
        for depth in range(1, len(self.levels)):
            below_chunks, below_bits, _ = self.levels[depth - 1]
            goes_on = np.flatnonzero(np.unpackbits(below_bits, count=len(below_chunks), bitorder="little"))
            where = goes_on if where is None else where[goes_on]
            values[where] |= self.levels[depth][0].astype("<u4") << (8 * depth)
        return values


# --- encoding -------------------------------------------------------------------------------------


class Encoder:
    """Ids of texts by the tokenizers library, each distinct piece of text encoded once.

    Byte-level BPE of this family begins a new pre-token at every blank that is followed by something other than
    white space, so a text's ids are those of its pieces cut there, one after another. Pieces
    not met before are encoded in one call; ids are dealt back to them by the length of their bytes. A text with the string of a special token
    is encoded whole, as the library has a single id for it there.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole, self.tokenizer = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # it gets only texts without their strings, and need not look for them
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        size = self.tokenizer.get_vocab_size()
        self.lengths = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)], dtype=np.int64)
        self.known: dict[str, bytes] = {}  # ids of " " + piece

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian u32 ids of each text; its first piece has no blank before it and is encoded as it is."""
        marked = [any(s in t for s in self.special) for t in texts]
        pieces = [[""] if m else self.pieces(t) for m, t in zip(marked, texts)]
        if len(self.known) > CACHED_PIECES:
            self.known.clear()
        known = self.known
        self.learn(list(dict.fromkeys(p for some in pieces for p in some[1:] if p not in known)))
        firsts = self.tokenizer.encode_batch_fast([some[0] for some in pieces], add_special_tokens=False)
        out = [b"".join([np.array(first.ids, dtype="<u4").tobytes(), *[known[p] for p in some[1:]]]) for first, some in zip(firsts, pieces)]
        for i in np.flatnonzero(marked).tolist():
            out[i] = np.array(self.whole.encode(texts[i], add_special_tokens=False).ids, dtype="<u4").tobytes()
        return out

    @staticmethod
    def pieces(text: str) -> list[str]:
        """The text cut at each blank before something other than white space; the blank is left out."""
        parts = text.split(" ")
        if "" in parts or any(p[0].isspace() for p in parts):  # a blank before white space or at an end stays in its run
            joined = [parts[0]]
            for p in parts[1:]:
                if p and not p[0].isspace():
                    joined.append(p)
                else:
                    joined[-1] += " " + p
            parts = joined
        return parts

    def learn(self, new: list[str]) -> None:
        for i in range(0, len(new), 2000):
            some = new[i : i + 2000]
            whole = [p for p in some if not p[-1].isspace()]
            for p in some:
                if p[-1].isspace():
                    self.known[p] = np.array(self._ids(" " + p), dtype="<u4").tobytes()
            if whole:
                ids = np.array(self._ids(" " + " ".join(whole)), dtype="<u4")
                ends = np.cumsum(self.lengths[ids])
                cuts = np.cumsum([len(p.encode("utf-8")) + 1 for p in whole])
                at = np.searchsorted(ends, cuts) + 1
                raw, begin = ids.tobytes(), 0
                for p, end in zip(whole, at.tolist()):
                    self.known[p] = raw[4 * begin : 4 * end]
                    begin = end

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids


_ENCODERS: dict[str, Encoder] = {}


def _encoder(name: str) -> Encoder:
    """The worker's encoder of a public tokenizer, by name or path."""
    if name not in _ENCODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers

        _ENCODERS[name] = Encoder(name if "/" in name else public_tokenizers.path(name))
    return _ENCODERS[name]


SEGMENTS = "part int, place int, local_start long, n_ids long, doc_ids array<long>, payload binary"


def write_segments(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", end_id: int = 0, path: str | None = None, segment_ids: int = SEGMENT_IDS) -> str:
    """Write all documents, in ascending doc_id order, as segments; returns the table's path.

    Rows are dealt out by range of (doc_id, hash of the text) and sorted there, so partition, place and row are the global
    order. Null id: first. Null or empty text: only the end id. Repeated rows are written each. No rows: an empty table.
    """
    target = path or fresh_path(docs.sparkSession, "token-segments")
    order = [F.col("doc_id"), F.xxhash64("text")]
    dealt = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order).select(F.spark_partition_id().alias("part"), "doc_id", "text")
    segments = dealt.mapInArrow(_segment_writer(tokenizer, end_id, segment_ids), SEGMENTS)
    segments.write.option("compression", "uncompressed").parquet(target)
    return target


def _segment_writer(tokenizer: str, end_id: int, segment_ids: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = _encoder(tokenizer), np.array([end_id], dtype="<u4").tobytes()
        part = place = begun = held = 0
        doc_ids, parts = [], []

        def closed() -> pa.RecordBatch:
            starts = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts])])
            payload = pack(np.frombuffer(b"".join(parts), dtype="<u4"), starts)
            row = {"part": part, "place": place, "local_start": begun, "n_ids": int(starts[-1]), "doc_ids": doc_ids, "payload": payload}
            return pa.RecordBatch.from_pylist([row], schema=_SCHEMA)

        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                some = batch.slice(i, 200)
                part = some.column("part")[0].as_py()
                encoded = encoder.encode([t or "" for t in some.column("text").to_pylist()])
                for doc_id, raw in zip(some.column("doc_id").to_pylist(), encoded):
                    doc_ids.append(doc_id)
                    parts.append(raw + end)
                    held += len(raw) // 4 + 1
                    if held >= segment_ids:
                        yield closed()
                        place, begun, held, doc_ids, parts = place + 1, begun + held, 0, [], []
        if doc_ids:
            yield closed()

    return write


_SCHEMA = pa.schema([("part", pa.int32()), ("place", pa.int32()), ("local_start", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("payload", pa.binary())])


# --- reading --------------------------------------------------------------------------------------


def open_segments(spark, path: str) -> DataFrame:
    """Segments with ``first_start``, the number of ids in all segments before; one count per partition meets in one task and goes to all, segments stay where they lie."""
    segments = spark.read.schema(SEGMENTS).parquet(path)
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    parts = segments.groupBy(F.col("part").alias("_p")).agg(F.sum("n_ids").alias("_n")).select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return segments.join(F.broadcast(parts), F.col("part") == F.col("_p")).select("part", "place", (F.col("_before") + F.col("local_start")).alias("first_start"), "doc_ids", "payload")


def read_documents(spark, path: str) -> DataFrame:
    """One row per document in the files: doc_id, start, n_tokens, ids_crc32 (of its ids as little-endian u32)."""
    return open_segments(spark, path).select("first_start", "doc_ids", "payload").mapInArrow(_digests, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, doc_ids, raw in zip(*(batch.column(c) for c in ("first_start", "doc_ids", "payload"))):
            segment = Segment(raw.as_buffer().to_pybytes())
            data, starts = memoryview(segment.ids().tobytes()), segment.starts.astype(np.int64)
            crcs = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
            yield pa.RecordBatch.from_pydict({"doc_id": doc_ids.values, "start": starts[:-1] + first.as_py(), "n_tokens": np.diff(starts), "ids_crc32": crcs}, schema=pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "n_tokens", "ids_crc32")]))
