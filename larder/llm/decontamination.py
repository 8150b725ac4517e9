"""Benchmark decontamination: one Aho-Corasick automaton over normalised windows.

Texts are normalised byte by byte (A-Z lower-cased, separators to blanks), so every byte of
the normal form has its place in the original. Runs of blanks become one; the start of each
word in the original is kept beside it. The automaton holds " w1 ... wn " for each window and
scans a text once.

The benchmark is cut into blocks of bounded size by a hash of the window. A block's patterns are
broadcast, its automaton is built once in each Python worker; a larger benchmark is more
blocks, each scanned over the documents, and their hits are united by document.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import LETTERS_AND_DIGITS, filled, lower_ascii, stored, words

WINDOW = 10
BLOCK_BYTES = 4_000_000  # of patterns: some 300 MB of automaton at most
_NORMAL = bytes((c + 32 if 65 <= c <= 90 else c) if 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
SCANNED = "doc_id long, text_hash long, copies long, n_words long, spans array<struct<first:int,last:int,from:int,to:int>>, items array<string>"


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(pattern, items): every run of ``size`` words of an item; an item of fewer words, but some, is one window."""
    tokens = benchmark.select(F.col("item_id").cast("string").alias("item"), words(lower_ascii(filled("text")), LETTERS_AND_DIGITS).alias("w")).where(F.size("w") > 0)
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1))), lambda i: F.array_join(F.slice("w", i, size), " "))
    return tokens.select("item", F.explode(F.array_distinct(runs)).alias("pattern")).groupBy("pattern").agg(F.collect_set("item").alias("items"))


def scan(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document row: doc_id, text_hash, n_words, spans, items.

    ``spans`` are the disjoint runs of hit words: first and last word, and from/to, the characters
    of the original text that they cover. ``items`` are the ids (as text) of the items with a window in it.

    Null or empty text: no words. Null id of a document: kept. Null id of an item: its windows
    count, it is not listed. Repeated rows give repeated rows. An empty benchmark hits nothing.
    """
    spark = docs.sparkSession
    patterns = stored(windows(benchmark, size), "benchmark-windows")
    n_bytes = patterns.agg(F.sum(F.octet_length("pattern") + 2)).first()[0] or 0
    n_blocks = 1 + n_bytes // block_bytes
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    found = []
    for block in range(n_blocks):
        mine = patterns.where(F.pmod(F.xxhash64("pattern"), F.lit(n_blocks)) == block)
        listed = [(r["pattern"], r["items"]) for r in mine.collect()]  # about block_bytes
        found.append(rows.mapInArrow(_scanner(spark.sparkContext.broadcast(listed), size, block == 0), SCANNED))
    together = found[0]
    for more in found[1:]:
        together = together.unionByName(more)
    united = together.groupBy("doc_id", "text_hash").agg(
        F.sum("copies").alias("copies"), F.max("n_words").alias("n_words"), F.flatten(F.collect_set("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )
    merged = F.aggregate(F.array_sort("spans"), F.array().cast("array<struct<first:int,last:int,from:int,to:int>>"), _joined)
    once = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return united.select("doc_id", "text_hash", "n_words", merged.alias("spans"), F.array_sort("items").alias("items"), once.alias("_copy")).drop("_copy")


def without_hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no window of the benchmark."""
    hit = scan(docs, benchmark).where(F.size("spans") > 0).select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).distinct()
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))  # so that no column of the input has a name of ours
    return whole.join(hit, F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("row.text") == F.col("hash")), "left_anti").select("row.*")


def _joined(done, span):
    last = F.element_at(done, -1)
    apart = (F.size(done) == 0) | (F.try_element_at(done, F.lit(-1))["last"] < span["first"])
    wider = F.named_struct(F.lit("first"), last["first"], F.lit("last"), F.greatest(last["last"], span["last"]), F.lit("from"), last["from"], F.lit("to"), F.greatest(last["to"], span["to"]))
    return F.when(apart, F.concat(done, F.array(span))).otherwise(F.concat(F.slice(done, 1, F.size(done) - 1), F.array(wider)))


def n_hit(spans: str = "spans"):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + s["last"] - s["first"] + 1)


_AUTOMATA: dict = {}


def _automaton(key: str, listed):
    """The worker's automaton of a block; only the latest is kept."""
    if key not in _AUTOMATA:
        import ahocorasick

        machine = ahocorasick.Automaton()
        for pattern, items in listed.value:
            raw = pattern.encode("utf-8").decode("latin-1")  # one character per byte, as the scanned text
            machine.add_word(f" {raw} ", (raw.count(" ") + 1, tuple(items)))
        machine.make_automaton()
        _AUTOMATA.clear()
        _AUTOMATA[key] = machine
    return _AUTOMATA[key]


def _scanner(listed, size: int, every_row: bool):
    key = uuid.uuid4().hex

    def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _automaton(key, listed)
        for batch in batches:
            out = []
            for i in range(0, batch.num_rows, 256):
                some = batch.slice(i, 256)
                for doc_id, mark, text in zip(*(some.column(c).to_pylist() for c in ("doc_id", "text_hash", "text"))):
                    n, spans, items = _hits(machine, (text or "").encode("utf-8"))
                    if every_row or spans:
                        out.append({"doc_id": doc_id, "text_hash": mark, "copies": int(every_row), "n_words": n, "spans": spans, "items": items})
            yield pa.RecordBatch.from_pylist(out, schema=_SCHEMA)

    return scan_batches


_SPAN = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("from", pa.int32()), ("to", pa.int32())])
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("copies", pa.int64()), ("n_words", pa.int64()), ("spans", pa.list_(_SPAN)), ("items", pa.list_(pa.string()))])


def _hits(machine, raw: bytes) -> tuple[int, list[dict], list[str]]:
    """Word count, merged spans and items of one text."""
    import re

    import numpy as np

    tokens = raw.translate(_NORMAL).split()
    if not tokens or not len(machine):
        return len(tokens), [], []
    normal = b" " + b" ".join(tokens) + b" "
    ends, lengths, items = [], [], set()
    for end, (length, ids) in machine.iter(normal.decode("latin-1")):
        ends.append(end)
        lengths.append(length)
        items.update(i for i in ids if i is not None)
    if not ends:
        return len(tokens), [], []
    blanks = np.flatnonzero(np.frombuffer(normal, dtype=np.uint8) == 32)
    last = np.searchsorted(blanks, np.array(ends)) - 1  # a pattern ends at the blank after its last word
    first = last - np.array(lengths) + 1
    runs: list[list[int]] = []
    for a, b in sorted(zip(first.tolist(), last.tolist())):
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b])
    places = [m.span() for m in re.finditer(rb"[^ ]+", raw.translate(_NORMAL))]
    at = [(len(raw[: places[a][0]].decode("utf-8")), len(raw[: places[b][1]].decode("utf-8"))) for a, b in runs]
    return len(tokens), [{"first": a, "last": b, "from": x, "to": y} for (a, b), (x, y) in zip(runs, at)], sorted(items)
