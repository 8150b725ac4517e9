"""Language-model scoring by deleted interpolation.

p(w | h) mixes the maximum-likelihood bigram, unigram and uniform estimates. The weights depend on how often the
context h was seen (powers of two) and are learned by expectation-maximisation on held-out counts: each training token
is deleted from the counts it is predicted with.

Texts become blocks of a million tokens or two: the hashes of a block's words and the tokens as places among
them. A block sends each distinct word and word pair once, with its count, to the key range it belongs to; ranges add up the
counts of all blocks and answer each block with the totals of its keys, in order. So what is shuffled is pre-aggregated, no key
is in a range more often than there are blocks, and hot words make no hot task. Blocks lie in a bucketed table, so the answers come to
them and they are not shuffled. The statistics for the weights are a histogram over a fixed grid.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import WORD, filled, lower_ascii, stored, words
from larder.session import fresh_path

BLOCK_TOKENS = 1_500_000
RANGE_TOKENS = 1_000_000  # tokens of the corpus for each key range
LEAST_RANGES = 200
GRID = 4  # cells for each doubling of a probability in the held-out histogram
ROUNDS = 60
START, END = np.uint64(0x0123456789ABCDEF), np.uint64(0xFEDCBA9876543211)  # the context of a first word; the last token


# --- packed numbers -------------------------------------------------------------------------------


def packed(values: np.ndarray) -> bytes:
    """Unsigned 64-bit numbers as byte planes, each deflated if that helps; leading planes of zeros cost nothing."""
    raw = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)
    out = [len(values).to_bytes(8, "little")]
    for k in range(8):
        plane = raw[:, k].tobytes()
        small = zlib.compress(plane, 1) if len(plane) > 64 else plane
        keep = small if len(small) < len(plane) else plane
        out.append((len(keep) * 2 + (keep is small and small is not plane)).to_bytes(8, "little") + keep)
    return b"".join(out)


def unpacked(data: bytes) -> np.ndarray:
    n, at = int.from_bytes(data[:8], "little"), 8
    raw = np.empty((n, 8), dtype=np.uint8)
    for k in range(8):
        head = int.from_bytes(data[at : at + 8], "little")
        part = data[at + 8 : at + 8 + head // 2]
        at += 8 + head // 2
        raw[:, k] = np.frombuffer(zlib.decompress(part) if head % 2 else part, dtype=np.uint8)
    return raw.reshape(-1).view("<u8").copy()


def _pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Block:
    """Tokens of some documents: ``words`` (hashes, the most frequent first), ``tokens`` (places in them), ``lengths`` and ``held`` of documents."""

    def __init__(self, vocabulary: np.ndarray, tokens: np.ndarray, lengths: np.ndarray, held: np.ndarray):
        self.words, self.tokens, self.lengths, self.held = vocabulary, tokens, lengths, held
        self.taught = ~np.repeat(held, lengths)  # tokens of documents that teach
        self.order = np.argsort(vocabulary, kind="stable")

    @classmethod
    def of(cls, hashes: np.ndarray, lengths: np.ndarray, held: np.ndarray) -> Block:
        found, places, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        by_count = np.argsort(-counts, kind="stable")
        rank = np.empty_like(by_count)
        rank[by_count] = np.arange(len(by_count))
        return cls(found[by_count], rank[places], lengths, held)

    def word_keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted word hashes and how often they teach."""
        counts = np.bincount(self.tokens[self.taught], minlength=len(self.words))
        return self.words[self.order], counts[self.order]

    def contexts(self) -> np.ndarray:
        """Place of the word before each token; len(words) at the start of a document."""
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[np.cumsum(self.lengths) - self.lengths] = len(self.words)
        return before

    def pair_keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted pair keys, how often they teach, and the place of each token's pair among them."""
        hashes = np.append(self.words, START)
        keys, places = np.unique(_pair_keys(hashes[self.contexts()], hashes[self.tokens]), return_inverse=True)
        return keys, np.bincount(places[self.taught], minlength=len(keys)), places


# --- blocks ---------------------------------------------------------------------------------------

BLOCKS = "block long, n_tokens long, n_taught_docs long, doc_ids array<long>, held array<boolean>, lengths array<int>, words binary, tokens binary"
_BLOCKS = pa.schema([("block", pa.int64()), ("n_tokens", pa.int64()), ("n_taught_docs", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int32())), ("words", pa.binary()), ("tokens", pa.binary())])


def _blocker(block_tokens: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made, held_tokens = TaskContext.get().partitionId() << 24, 0, 0
        ids, held, hashes, lengths = [], [], [], []

        def closed() -> pa.RecordBatch:
            flags = np.concatenate(held)
            block = Block.of(np.concatenate(hashes), np.concatenate(lengths), flags)
            row = {
                "block": first + made, "n_tokens": len(block.tokens), "n_taught_docs": int((~flags).sum()), "doc_ids": [i for part in ids for i in part], "held": flags.tolist(),
                "lengths": block.lengths.tolist(), "words": packed(block.words), "tokens": packed(block.tokens),
            }
            return pa.RecordBatch.from_pylist([row], schema=_BLOCKS)

        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                some = batch.slice(i, 256)
                lists = some.column("hashes")
                n = np.diff(lists.offsets.to_numpy()).astype(np.int64)
                values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                hashes.append(np.insert(values, np.cumsum(n), END))
                lengths.append(n + 1)
                ids.append(some.column("doc_id").to_pylist())
                held.append(some.column("held").to_numpy(zero_copy_only=False).astype(bool))
                held_tokens += len(hashes[-1])
                if held_tokens >= block_tokens:
                    yield closed()
                    made, held_tokens = made + 1, 0
                    ids, held, hashes, lengths = [], [], [], []
        if ids:
            yield closed()

    return work


def write_blocks(docs: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The corpus (doc_id, text, held) as a table of blocks, bucketed by block; whole texts, each in one block."""
    spark = docs.sparkSession
    hashed = docs.select("doc_id", "held", F.transform(words(lower_ascii(filled("text")), WORD), lambda w: F.xxhash64(w)).alias("hashes"))
    made = hashed.mapInArrow(_blocker(block_tokens), BLOCKS)
    name = f"lm_blocks_{uuid.uuid4().hex}"
    buckets = max(1, 2 * docs.rdd.getNumPartitions())
    made.write.bucketBy(buckets, "block").option("path", fresh_path(spark, "lm-blocks")).saveAsTable(name)
    return spark.table(name)


def _opened(row: dict) -> Block:
    return Block(unpacked(row["words"]), unpacked(row["tokens"]).astype(np.int64), np.array(row["lengths"], dtype=np.int64), np.array(row["held"], dtype=bool))


# --- counts ---------------------------------------------------------------------------------------

_QUESTIONS = pa.schema([("range", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])


def _edges(keys: np.ndarray, n_ranges: int) -> np.ndarray:
    """Where each range of the hash space begins among sorted keys, and the end."""
    step = (1 << 64) // n_ranges
    return np.append(np.searchsorted(keys, np.arange(n_ranges, dtype=np.uint64) * np.uint64(step)), len(keys))


def _asker(n_ranges: int):
    """A block's distinct words (ranges 0 on) and pairs (ranges n_ranges on) with their counts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = _opened(row)
                for first, (keys, counts) in ((0, block.word_keys()), (n_ranges, block.pair_keys()[:2])):
                    edges = _edges(keys, n_ranges)
                    out = [(first + i, row["block"], packed(keys[a:b]), packed(counts[a:b])) for i, (a, b) in enumerate(zip(edges[:-1], edges[1:])) if b > a]
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _QUESTIONS.types)], schema=_QUESTIONS)

    return work


def _answer(pdf: pd.DataFrame) -> pd.DataFrame:
    """Totals of one range for each block that asked, in the order of its keys; the range's sums stand on its first row."""
    keys = [unpacked(k) for k in pdf["keys"]]
    counts = np.concatenate([unpacked(c) for c in pdf["counts"]])
    _, places = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.bincount(places, weights=counts).astype(np.uint64)
    answers = np.split(totals[places], np.cumsum([len(k) for k in keys])[:-1])
    rest = [0] * (len(pdf) - 1)
    return pd.DataFrame({"block": pdf["block"], "range": pdf["range"], "totals": [packed(a) for a in answers], "n_distinct": [int((totals > 0).sum()), *rest], "n_total": [int(totals.sum()), *rest]})


def counted(blocks: DataFrame) -> tuple[DataFrame, int, dict]:
    """(block, answers) for each block, the number of ranges, and N, V and the number of teaching documents."""
    tokens, taught_docs = blocks.agg(F.sum("n_tokens"), F.sum("n_taught_docs")).first()
    n_ranges = max(LEAST_RANGES, (tokens or 0) // RANGE_TOKENS)
    asked = blocks.select("block", "held", "lengths", "words", "tokens").mapInArrow(_asker(n_ranges), "range int, block long, keys binary, counts binary")
    answers = stored(asked.groupBy("range").applyInPandas(_answer, "block long, range int, totals binary, n_distinct long, n_total long"), "lm-answers")
    n, v = answers.where(F.col("range") < n_ranges).agg(F.sum("n_total"), F.sum("n_distinct")).first()
    by_block = answers.groupBy("block").agg(F.collect_list(F.struct("range", "totals")).alias("answers"))
    return by_block, n_ranges, {"n": n or 0, "v": v or 0, "docs": taught_docs or 0}


def _totals(block: Block, answers: list, n_ranges: int, sizes: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each token: count of its pair, of its context and of itself in the training texts."""
    parts = {a["range"]: a["totals"] for a in answers}

    def joined(first: int, n: int) -> np.ndarray:
        found = [unpacked(parts[r]) for r in range(first, first + n_ranges) if r in parts]
        return np.concatenate(found).astype(np.int64) if found else np.zeros(n, dtype=np.int64)

    of_word = np.empty(len(block.words) + 1, dtype=np.int64)
    of_word[block.order] = joined(0, len(block.words))
    of_word[-1] = sizes["docs"]
    keys, _, places = block.pair_keys()
    return joined(n_ranges, len(keys))[places], of_word[block.contexts()], of_word[block.tokens]


# --- weights --------------------------------------------------------------------------------------


def _context_class(counts: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + floor(log2(count))."""
    return np.where(counts > 0, 1 + np.floor(np.log2(np.maximum(counts, 1))), 0).astype(np.int64)


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.where(b > 0, a / np.maximum(b, 1), 0.0)


def _cells(p: np.ndarray) -> np.ndarray:
    """0 for probability 0, else 1 + the number of steps below 1 on the grid."""
    return np.where(p > 0, 1 + np.rint(-np.log2(np.maximum(p, 1e-300)) * GRID), 0).astype(np.int64)


def _held_out(n_ranges: int, sizes: dict):
    """Histogram of (context class, bigram cell, unigram cell) over training tokens, each deleted from its counts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = _opened(row)
                pair, context, word = (x[block.taught] - 1 for x in _totals(block, row["answers"], n_ranges, sizes))
                two, one = _cells(_ratio(pair, context)), _cells(word / max(sizes["n"] - 1, 1))
                cells, counts = np.unique((_context_class(context) << 40) | (two << 20) | one, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(counts, pa.int64())], names=["cell", "n"])

    return work


def learned_weights(histogram: pd.DataFrame, v: int) -> np.ndarray:
    """(classes, 3) weights of the uniform, unigram and bigram estimate, by expectation-maximisation."""
    cells, n = histogram["cell"].to_numpy(np.int64), histogram["n"].to_numpy(float)
    classes, two, one = cells >> 40, (cells >> 20) & 0xFFFFF, cells & 0xFFFFF
    parts = np.stack([np.full(len(cells), 1 / (v + 1)), np.where(one > 0, 2.0 ** (-(one - 1) / GRID), 0), np.where(two > 0, 2.0 ** (-(two - 1) / GRID), 0)], axis=1)
    everyone = np.full(3, 1 / 3)
    weights = np.full((64, 3), 1 / 3)
    for _ in range(ROUNDS):
        joint = weights[classes] * parts
        share = joint / np.maximum(joint.sum(axis=1, keepdims=True), 1e-300) * n[:, None]
        sums = np.stack([np.bincount(classes, weights=share[:, k], minlength=64) for k in range(3)], axis=1)
        seen = sums.sum(axis=1) > 0
        if not seen.any():
            break
        everyone = sums.sum(axis=0) / sums.sum()
        weights = np.where(seen[:, None], sums / np.maximum(sums.sum(axis=1, keepdims=True), 1e-300), everyone)
    weights[0, 2] = 0.0  # an unseen context predicts nothing
    weights = np.maximum(weights, [1e-9, 0.0, 0.0])
    return weights / weights.sum(axis=1, keepdims=True)


# --- scores ---------------------------------------------------------------------------------------

SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _scorer(n_ranges: int, sizes: dict, weights: np.ndarray):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, v = sizes["n"], sizes["v"]
        for batch in batches:
            for row in batch.to_pylist():
                block = _opened(row)
                pair, context, word = _totals(block, row["answers"], n_ranges, sizes)
                base = np.log10((word + 0.5) / (n + 0.5 * (v + 1)))
                mixed = weights[_context_class(context)]
                p = mixed[:, 0] / (v + 1) + mixed[:, 1] * (word / max(n, 1)) + mixed[:, 2] * _ratio(pair, context)
                starts = np.cumsum(block.lengths) - block.lengths
                columns = [
                    pa.array(row["doc_ids"], pa.int64()), pa.array(block.held), pa.array(block.lengths), pa.array(np.add.reduceat((word > 0).astype(np.int64), starts)),
                    pa.array(np.full(len(starts), n, dtype=np.int64)), pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(np.log10(p), starts)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return work


def score(docs: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of (doc_id, text, held).

    Rows with ``held`` false teach, all are scored. A text's tokens are its words and one end. ``base_score`` is the unigram with half a
    count added, ``score`` the interpolated model, both sums of log10. Null or empty text: the end alone. Repeated rows count and are scored
    each. If nothing teaches, all tokens are unknown and score as uniform. An empty table gives no rows.
    """
    blocks = write_blocks(docs.select("doc_id", "text", "held"), block_tokens)
    answers, n_ranges, sizes = counted(blocks)
    answers = stored(answers, "lm-totals")
    together = blocks.join(answers, "block")
    cells = together.select("held", "lengths", "words", "tokens", "answers").mapInArrow(_held_out(n_ranges, sizes), "cell long, n long")
    histogram = cells.groupBy("cell").agg(F.sum("n").alias("n")).orderBy("cell").toPandas()  # at most classes x grid x grid rows
    weights = learned_weights(histogram, sizes["v"])
    return together.select("doc_ids", "held", "lengths", "words", "tokens", "answers").mapInArrow(_scorer(n_ranges, sizes, weights), SCORES)
