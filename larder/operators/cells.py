"""Exact similarity joins over Voronoi cells.

Vectors lie in the cell of their nearest pivot. A cell is summed up by its pivot, the largest distance from it, the largest length and the number of
rows. For a vector q, a pivot c and a row y of the cell within distance r and of length m at most, the triangle inequality bounds the inner product:

    q.c - |q| r  <=  q.y  <=  min(q.c + |q| r, (|q|^2 + m^2 - max(0, |q - c| - r)^2) / 2)

so it holds for vectors of any length. A threshold join sends a row only to the cells whose upper bound reaches the threshold. A
k-nearest join first meets the cells of best pivot that hold k rows, and then only those whose bound reaches the k-th score found there. Cells
are few and their summary is bounded. Neighbouring cells share a block of measured bytes, and a hot cell is cut into many: a request is sent once to a
block, with a bit for each of its cells that it may meet, so what is shuffled does not grow with the number of cells. Where the second pass would send
requests to more than a few of the blocks, bounds save little: all blocks of rows meet instead, and nothing is copied.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from larder.operators.similarity import MATCH_SCHEMA, TILE_ENTRIES, Best, Block, Requests, Scoring, Vectors, _matches, _side, meet_blocks, rank_matches
from larder.session import fresh_path

CELL_ROWS, MOST_CELLS, SAMPLED = 512, 2_048, 8
BLOCK_BYTES, LEAST_BLOCK_BYTES = 64 << 20, 1 << 16
TASKS_A_CORE = 4  # groups of blocks that a pass makes at least
FEW = 0.125  # share of all (request, block) pairs up to which copies of requests are sent
DENSE = 0.25  # share of a block's cells that requests may meet from which all of them are scored at once
ENTRIES = 1 << 20  # bounds of rows x cells that a task holds at once
# Scores are compared after rounding to eight digits; a bound may fall short of one by half of the last, and by what sums in doubles lose.
SLACK, RELATIVE_SLACK = 2e-8, 1e-12


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _measured(column: str) -> Column:
    """Whether a vector can have a finite score: it is there, and so are all its components, as numbers."""
    return F.col(column).isNotNull() & F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def _bytes(df: DataFrame, vector: str) -> Column:
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    lists = [F.coalesce(F.octet_length(F.array_join(f.name, "")), F.lit(0)) for f in df.schema.fields if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType)]
    width = 4 if df.schema[vector].dataType.simpleString() == "array<float>" else 8
    total = width * F.size(vector) + 16
    for part in texts + lists:
        total = total + part
    return total.cast("long")


@dataclass(frozen=True)
class Cells:
    """Items with their cell in a stored table, and the summary of every cell."""

    items: DataFrame  # the item columns, _cell, _bytes
    centres: np.ndarray
    radius: np.ndarray
    length: np.ndarray
    rows: np.ndarray
    first: np.ndarray  # the first block of each cell
    pieces: np.ndarray  # and how many blocks it is cut into
    members: list[np.ndarray]  # the cells of each block

    def bounds(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest inner product of each vector with any row of each cell; an empty cell has none."""
        dot = vectors @ self.centres.T
        square = (vectors**2).sum(axis=1)[:, None]
        own = np.sqrt(square)
        apart = np.sqrt(np.maximum(square + (self.centres**2).sum(axis=1)[None] - 2 * dot, 0.0))
        reach = own * self.radius[None]
        far = (square + self.length[None] ** 2 - np.maximum(0.0, apart - self.radius[None]) ** 2) / 2
        slack = SLACK + RELATIVE_SLACK * (own * self.length[None] + square + self.length[None] ** 2)
        empty = self.rows[None] == 0
        return np.where(empty, np.inf, dot - reach - slack), np.where(empty, -np.inf, np.minimum(dot + reach, far) + slack)


def farthest_first(sample: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` distinct rows, each the farthest from those before it."""
    square = (sample**2).sum(axis=1)
    chosen, nearest = [0], np.full(len(sample), np.inf)
    while True:
        nearest = np.minimum(nearest, square + square[chosen[-1]] - 2 * (sample @ sample[chosen[-1]]))
        nearest[chosen[-1]] = 0.0
        far = int(np.argmax(nearest))
        # What is left of a difference of equal rows is no distance.
        if len(chosen) >= min(n, len(sample)) or nearest[far] <= 1e-12 * square[far]:
            return sample[chosen]
        chosen.append(far)


def blocks_of(centres: np.ndarray, size: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """First block and number of blocks of each cell, and the cells of each block: cells near each other share one of at most ``most`` bytes."""
    first, pieces, members = np.zeros(len(centres), int), np.ones(len(centres), int), []
    left, at, filled = np.ones(len(centres), bool), 0, most
    square = (centres**2).sum(axis=1)
    for _ in range(len(centres)):
        left[at] = False
        pieces[at] = max(1, -(-int(size[at]) // most))
        if pieces[at] > 1:
            first[at] = len(members)
            members += [[at]] * pieces[at]
            filled = most
        else:
            if filled + size[at] > most:
                members.append([])
                filled = 0
            members[-1].append(at)
            first[at], filled = len(members) - 1, filled + int(size[at])
        at = int(np.argmin(np.where(left, square - 2 * (centres @ centres[at]), np.inf)))
    return first, pieces, [np.array(m) for m in members]


def build_cells(items: DataFrame, vector: str = "embedding", item_id: str = "item_id", cell_rows: int = CELL_ROWS) -> Cells:
    """Cells of about ``cell_rows`` rows, at most ``MOST_CELLS``.

    Pivots are rows far from each other among those with the smallest hashes of their ids, ``SAMPLED`` for each cell; every row is in a cell, and the
    summaries are of all rows. Rows whose vector is null or not finite are in no cell. The driver holds that sample and one row for each cell.
    """
    # Read three times, and what made the vectors runs once: a filter before the write would run it again for itself.
    known = _stored(items, "cell-items").where(_measured(vector))
    n_cells = min(MOST_CELLS, max(1, -(-known.count() // cell_rows)))
    picked = known.select(vector, F.xxhash64(item_id).alias("_h"), item_id).orderBy("_h", item_id).limit(SAMPLED * n_cells).toArrow()
    centres = farthest_first(Vectors(picked.column(vector)).values, n_cells) if picked.num_rows else np.zeros((0, 0))
    shared = items.sparkSession.sparkContext.broadcast(centres)

    @F.arrow_udf("struct<cell:int,apart:double,length:double>")
    def place(vectors: pa.Array) -> pa.Array:
        rows, c = Vectors(vectors), shared.value
        nearest, apart, length = np.zeros(rows.rows, np.int32), np.zeros(rows.rows), np.zeros(rows.rows)
        step = max(1, ENTRIES // max(len(c), rows.width, 1))
        for low in range(0, rows.rows, step):
            x, some = rows.block(low, low + step), slice(low, low + step)
            nearest[some] = np.argmin((c**2).sum(axis=1)[None] - 2 * x @ c.T, axis=1)
            apart[some] = np.sqrt(((x - c[nearest[some]]) ** 2).sum(axis=1))
            length[some] = np.sqrt((x**2).sum(axis=1))
        return pa.StructArray.from_arrays([pa.array(nearest), pa.array(apart), pa.array(length)], names=["cell", "apart", "length"])

    placed = _stored(known.withColumn("_bytes", _bytes(items, vector)).withColumn("_place", place(vector)), "cells")
    summary = placed.groupBy("_place.cell").agg(F.max("_place.apart").alias("radius"), F.max("_place.length").alias("length"), F.count("*").alias("rows"), F.sum("_bytes").alias("bytes")).collect()
    radius, length, rows, size = np.zeros(len(centres)), np.zeros(len(centres)), np.zeros(len(centres), np.int64), np.zeros(len(centres), np.int64)
    for s in summary:
        radius[s.cell], length[s.cell], rows[s.cell], size[s.cell] = s.radius, s.length, s.rows, s.bytes
    # Few rows are cut too, so that all cores get some.
    cut = max(LEAST_BLOCK_BYTES, int(size.sum() / (TASKS_A_CORE * items.sparkSession.sparkContext.defaultParallelism) ** 0.5))
    return Cells(placed.withColumn("_cell", F.col("_place.cell")).drop("_place"), centres, radius, length, rows, *blocks_of(centres, size, min(BLOCK_BYTES, cut)))


def _with_targets(df: DataFrame, vector: str, cells: Cells, choose: Callable, *extra: str) -> DataFrame:
    """``_targets``: the blocks with a cell that ``choose(cells, vectors, *extra columns)`` marks in its (rows x cells) matrix, and a bit for each of their cells."""
    shared = df.sparkSession.sparkContext.broadcast((cells.centres, cells.radius, cells.length, cells.rows, cells.first, cells.pieces, cells.members))

    @F.arrow_udf("array<struct<_block:int,_cells:binary>>")
    def targets(vectors: pa.Array, *columns: pa.Array) -> pa.Array:
        summary, rows = Cells(None, *shared.value), Vectors(vectors)
        counts, blocks, bits = np.zeros(rows.rows + 1, np.int32), [], []
        own = [c.to_numpy(zero_copy_only=False) for c in columns]
        step = max(1, ENTRIES // max(len(summary.rows), 1))
        for low in range(0, rows.rows if len(summary.rows) else 0, step):
            marked = choose(summary, rows.block(low, low + step), *[c[low : low + step] for c in own])
            packed = [np.packbits(marked[:, m], axis=1) for m in summary.members]
            sent = np.stack([p.any(axis=1) for p in packed], axis=1)
            counts[low + 1 : low + 1 + len(marked)] = sent.sum(axis=1)
            row, block = np.nonzero(sent)
            blocks.append(block.astype(np.int32))
            bits += [packed[b][r].tobytes() for r, b in zip(row.tolist(), block.tolist())]
        each = pa.StructArray.from_arrays([pa.array(np.concatenate(blocks) if blocks else np.zeros(0, np.int32)), pa.array(bits, pa.binary())], names=["_block", "_cells"])
        return pa.ListArray.from_arrays(pa.array(np.cumsum(counts).astype(np.int32)), each)

    return _stored(df.withColumn("_targets", targets(vector, *extra)), "cell-targets")


def _numbers(values, kind: str) -> Column:
    return F.array(*[F.lit(int(v)) for v in values]).cast(f"array<{kind}>") if len(values) else F.array().cast(f"array<{kind}>")


def _meet(requests: DataFrame, cells: Cells, kernel: Callable[[pa.Table, pa.Table, np.ndarray, np.ndarray], pa.Table], query_id: str, item_id: str, vector: str, schema: str = MATCH_SCHEMA) -> DataFrame:
    """``kernel(request block, item block, cell of each item, marks)`` in every block that a request (column ``_targets``) is sent to.

    Marks (requests x cells of the block) say which cells a request may meet; items come by cell.
    """
    sent = requests.withColumn("_qbytes", _bytes(requests, vector)).select("*", F.inline("_targets")).drop("_targets")
    asked = {r["_block"]: r.n for r in sent.groupBy("_block").agg(F.sum("_qbytes").alias("n")).collect()}  # one row for each block
    least = -(-TASKS_A_CORE * requests.sparkSession.sparkContext.defaultParallelism // max(len(asked), 1))
    n_requests = [max(-(-asked[b] // BLOCK_BYTES), min(least, -(-asked[b] // LEAST_BLOCK_BYTES))) if b in asked else 0 for b in range(len(cells.members))]
    share = F.element_at(_numbers(n_requests, "int"), F.col("_block") + 1)
    at = F.col("_cell") + 1
    block = F.element_at(_numbers(cells.first, "int"), at) + F.pmod(F.xxhash64(item_id), F.element_at(_numbers(cells.pieces, "int"), at)).cast("int")
    left = sent.withColumn("_q", F.pmod(F.xxhash64(query_id), share).cast("int")).drop("_qbytes")
    right = cells.items.drop("_bytes").withColumn("_block", block).where(share > 0).withColumn("_q", F.explode(F.sequence(F.lit(0), share - 1)))
    keys, empty = ["_block", "_q"], pa.schema([(f.name, _KINDS[f.dataType.typeName()]) for f in T.StructType.fromDDL(schema)]).empty_table()
    # A number of partitions of its own: little is shuffled for much work, so sizes must not put groups together.
    tasks = max(1, min(2 * sum(n_requests), MOST_TASKS))
    left, right = (df.select(*[F.col(c).alias(c) for c in df.columns]).repartition(tasks, *keys) for df in (left, right))  # fresh names, so that a table may meet itself
    members = requests.sparkSession.sparkContext.broadcast(cells.members)

    def meet(request_block: pa.Table, item_block: pa.Table) -> pa.Table:
        if not request_block.num_rows or not item_block.num_rows:
            return empty
        own = members.value[request_block.column("_block")[0].as_py()]
        packed = np.frombuffer(b"".join(request_block.column("_cells").to_pylist()), np.uint8).reshape(request_block.num_rows, -1)
        marks = np.unpackbits(packed, axis=1, count=len(own)).astype(bool)
        by_cell, places = np.argsort(own), item_block.column("_cell").to_numpy()
        return kernel(request_block, item_block, by_cell[np.searchsorted(own, places, sorter=by_cell)], marks)

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, schema)


MOST_TASKS = 2_048


def _parts(items: pa.Table, cell: np.ndarray, marks: np.ndarray):
    """(request rows, items, their cells, marks) to be scored: all at once, or by cell where requests may meet few of the cells."""
    if marks.mean() >= DENSE:
        yield np.arange(len(marks)), items, cell, None if marks.all() else marks
        return
    order = np.argsort(cell, kind="stable")
    items, cell = items.take(pa.array(order)), cell[order]
    for c in np.unique(cell).tolist():
        low, high = np.searchsorted(cell, [c, c + 1])
        rows = np.flatnonzero(marks[:, c])
        if len(rows):
            yield rows, items.slice(low, high - low), cell[low:high], None


_KINDS = {"long": pa.int64(), "double": pa.float64()}


def sent_rows(requests: DataFrame, cells: Cells) -> DataFrame:
    """(requests, sent, pairs): how many cells requests with ``_targets`` may meet, and how many pairs meet there."""
    rows = cells.items.groupBy("_cell").agg(F.count("*").alias("n"))
    members, first = cells.members, cells.first

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def marked(block: pa.Array, bits: pa.Array) -> pa.Array:
        each = [members[b][np.unpackbits(np.frombuffer(x, np.uint8), count=len(members[b])).astype(bool)] for b, x in zip(block.to_pylist(), bits.to_pylist())]
        return pa.array([[c for c in cells_.tolist() if first[c] == b] for b, cells_ in zip(block.to_pylist(), each)], pa.list_(pa.int32()))  # a cell cut into blocks is one

    sent = requests.select(F.inline("_targets")).select(F.explode(marked("_block", "_cells")).alias("_cell")).groupBy("_cell").agg(F.count("*").alias("m"))
    total = sent.join(rows, "_cell").agg(F.coalesce(F.sum("m"), F.lit(0)).alias("sent"), F.coalesce(F.sum(F.col("m") * F.col("n")), F.lit(0)).alias("pairs"))
    return requests.agg(F.count("*").alias("requests")).join(F.broadcast(total))


# --- pairs above a threshold ----------------------------------------------------------------------


def threshold_targets(left: DataFrame, cells: Cells, min_similarity: float, vector: str, once: bool) -> DataFrame:
    """``left`` with the cells that may hold a row of at least ``min_similarity``.

    Within one set, of two cells only one is sent to the other, by turns, so that each pair of cells meets once.
    """

    def choose(summary: Cells, x: np.ndarray, *own: np.ndarray) -> np.ndarray:
        marked = summary.bounds(x)[1] >= min_similarity
        if once:
            mine, other = own[0][:, None], np.arange(len(summary.centres))[None]
            marked &= (mine == other) | (((mine + other) % 2 == 0) == (mine < other))
        return marked

    return _with_targets(left, vector, cells, choose, *(["_cell"] if once else []))


def pairs_in_cells(left: DataFrame, right: DataFrame | None, min_similarity: float, id_column: str, vector: str, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Exact pairs ``query_id, item_id, score`` at or above a similarity; within one set (``right`` omitted) the smaller id comes first."""
    once = right is None
    cells = build_cells(_side(left if once else right, [id_column, vector]), vector, id_column, cell_rows)
    rows = cells.items.drop("_bytes") if once else _side(left, [id_column, vector]).where(_measured(vector))
    asked = threshold_targets(rows, cells, min_similarity, vector, once)
    if once:
        asked = asked.withColumnRenamed("_cell", "_home")
    scoring = Scoring(query_id=id_column, item_id=id_column, query_vector=vector, item_vector=vector)

    def kernel(request_block: pa.Table, item_block: pa.Table, cell: np.ndarray, marks: np.ndarray) -> pa.Table:
        requests, found = Requests(request_block, scoring), []
        home = request_block.column("_home").to_numpy() if once else None
        number = np.zeros(marks.shape[1], int)  # of each cell of the block
        number[cell] = item_block.column("_cell").to_numpy()
        bar = np.full(len(requests.ids), min_similarity)

        def take(r, i, score, block):
            a, b = requests.ids[r], block.ids[i]
            if once:  # two rows of one cell meet twice, those of two cells once
                keep = np.where(home[r] == number[block.cell[i]], a < b, a != b)
                a, b, score = a[keep], b[keep], score[keep]
                a, b = np.minimum(a, b), np.maximum(a, b)
            found.append(_matches(a, b, score))

        for rows, items, own, part in _parts(item_block, cell, marks):
            block = Block(items, requests, own)
            wide = max(1, min(len(block.ids), TILE_ENTRIES // max(requests.vectors.width, 1)))
            for low in range(0, len(block.ids), wide):
                high = min(low + wide, len(block.ids))
                step = max(1, TILE_ENTRIES // (high - low))
                for start in range(0, len(rows), step):
                    some = rows[start : start + step]
                    pairs = requests.reaching(some, block, low, high, bar[some], part) if requests.simple(some).all() else None
                    if pairs is None:
                        scores = requests.whole(some, block, low, high, part)
                        r, i = np.nonzero(scores >= min_similarity)
                        pairs = r, i + low, scores[r, i]
                    take(some[pairs[0]], pairs[1], pairs[2], block)
        return pa.concat_tables(found) if found else _matches([], [], [])

    return _meet(asked, cells, kernel, id_column, id_column, vector)


# --- nearest items --------------------------------------------------------------------------------


def nearest_in_cells(requests: DataFrame, items: DataFrame, k: int, scoring: Scoring, cell_rows: int = CELL_ROWS) -> tuple[DataFrame, DataFrame, Cells]:
    """Matches that contain the exact best ``k`` of each request, the requests with the cells of the second pass, and the cells.

    ``requests`` and ``items`` are the sides of ``top_k``. With a share of listed substrings in the score, its largest weight is added to the bound.
    """
    cells = build_cells(items, scoring.item_vector, scoring.item_id, cell_rows)
    asked = requests.where(_measured(scoring.query_vector))
    scale, shift = (scoring.weights[0], max(scoring.weights[1], 0.0)) if scoring.available else (1.0, 0.0)

    def ceiling(summary: Cells, x: np.ndarray) -> np.ndarray:
        least, most = summary.bounds(x)
        return np.where(summary.rows[None] == 0, -np.inf, (scale * most if scale >= 0 else scale * least) + shift)

    def first(summary: Cells, x: np.ndarray) -> np.ndarray:
        # By their pivots' scores: a cell may have a high bound for being wide alone.
        order = np.argsort(-scale * (x @ summary.centres.T), axis=1, kind="stable")
        held = summary.rows[order]
        needed = np.cumsum(held, axis=1) - held < k + scoring.exclude_self
        marked = np.zeros(order.shape, bool)
        np.put_along_axis(marked, order, needed & (held > 0), axis=1)
        return marked

    def rest(summary: Cells, x: np.ndarray, floor: np.ndarray) -> np.ndarray:
        return (ceiling(summary, x) >= floor[:, None]) & ~first(summary, x)

    def kernel(request_block: pa.Table, item_block: pa.Table, cell: np.ndarray, marks: np.ndarray) -> pa.Table:
        floor = request_block.column("_floor").to_numpy() if "_floor" in request_block.column_names else None
        requests = Requests(request_block, scoring)
        best = Best(requests, k, floor)
        parts = _parts(item_block, cell, marks) if requests.plain else [(None, item_block, cell, marks)]
        for rows, items, own, part in parts:
            best.offer(items, rows, own, part)
        return best.result()

    def meet(rows: DataFrame) -> DataFrame:
        return _meet(rows, cells, kernel, scoring.query_id, scoring.item_id, scoring.query_vector)

    near = _with_targets(asked, scoring.query_vector, cells, first)
    found = _stored(meet(near), "cells-first")
    # The k-th best of the first pass; a request with fewer matches may have any others.
    last = rank_matches(found, k).where(F.col("rank") == k).select(F.col("query_id").alias("_id"), F.col("score").alias("_floor"))
    floors = near.drop("_targets").join(last, F.col(scoring.query_id) == F.col("_id"), "left").drop("_id").withColumn("_floor", F.coalesce("_floor", F.lit(float("-inf"))))
    again = _with_targets(floors, scoring.query_vector, cells, rest, "_floor")
    copies, asked_for = again.agg(F.coalesce(F.sum(F.size("_targets")), F.lit(0)), F.count("*")).first()
    if copies <= FEW * asked_for * len(cells.members):
        return found.unionByName(meet(again)), again, cells

    def every(block: pa.Table, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        # A product in another order may round to one place less than the floor.
        best = Best(Requests(block, scoring), k, block.column("_floor").to_numpy() - SLACK)
        for batch in batches:
            best.offer(batch)
        yield best.result()

    return meet_blocks(again.drop("_targets"), cells.items.drop("_cell", "_bytes"), every, MATCH_SCHEMA), again, cells
