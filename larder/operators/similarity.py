"""Similarity joins of a request table with an item table.

Scores are matrix products of Arrow blocks inside ``mapInArrow`` tasks; a task
keeps only the best ``k`` items per request (or the pairs above a threshold), so
no request-item pair is ever materialised as a row.

Exact physical forms, chosen by a measured bound on the request side:

* at most ``MAX_BROADCAST_ROWS`` rows and ``MAX_BROADCAST_BYTES`` bytes: requests
  are broadcast and the items are scored where they lie, without a shuffle;
* otherwise dense vectors meet in the Voronoi cells that their bounds allow
  (``operators/cells.py``). Where bounds allow nearly all, and for sparse vectors,
  every block of one side meets every block of the other: a block is a row, so what
  is shuffled grows with the rows. No task, broadcast or driver holds more than a few
  blocks of either side.

Scores are compared and returned at ``SCORE_DIGITS`` digits. Equal items then tie
exactly, whatever the summation order of the matrix product, and ties go to the
smaller item id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from larder import fixed
from larder.session import fresh_path

SCORE_DIGITS = 8
MAX_BROADCAST_ROWS = 20_000
MAX_BROADCAST_BYTES = 64 << 20
MAX_BROADCAST_MATCHES = 1_000_000
BLOCK_REQUESTS = 8_192
BLOCK_ITEMS = 65_536
# Rows that travel as one value, those of a partition of them, and the least that is worth a task.
PACK_BYTES, PART_BYTES, LEAST_PART_BYTES = 32 << 20, 64 << 20, 1 << 16
TASKS_A_CORE = 4
# Entries of one score or matrix tile: 4M doubles, 32 MB.
TILE_ENTRIES = 4 << 20
# Of a tile of scores in single precision, those that a core's cache holds are made and compared at once: 2 MB.
CACHED_ENTRIES, TILE_ROWS = 1 << 19, 256
# Single precision is used where lengths stay below this; pairs scored one by one at a time; share of a tile above which the whole tile is scored.
PLAIN_LENGTH, PAIRS, MANY = 1e15, 1 << 15, 32
# Of sparse vectors, the slots in most pairs are multiplied as a matrix, the others slot by slot.
HEAD_SLOTS = 1024

MATCH_SCHEMA = "query_id long, item_id long, score double"


@dataclass(frozen=True)
class Scoring:
    """What a task needs to score a block of items against a block of requests.

    Vectors are ``array<float|double>`` columns, or ``struct(slots, weights)`` for
    sparse ones. Optional parts: ``category`` restricts a request to the items of
    its category; ``available`` mixes in the share of listed substrings found in
    the item text; ``required`` lists substrings an item must contain.
    """

    query_id: str = "query_id"
    item_id: str = "item_id"
    query_vector: str = "embedding"
    item_vector: str = "embedding"
    category: str | None = None
    item_category: str = "category"
    available: str | None = None
    required: str | None = None
    item_text: str = "ingredients"
    weights: tuple[float, float] = (1.0, 0.0)
    mask: bool = False
    exclude_self: bool = False

    def query_side(self) -> list[str]:
        optional = [self.category, self.available, self.required]
        return [self.query_id, self.query_vector, *[c for c in optional if c]]

    def item_side(self) -> list[str]:
        columns = [self.item_id, self.item_vector]
        if self.category:
            columns.append(self.item_category)
        if self.available or self.required:
            columns.append(self.item_text)
        return columns


def round_scores(scores: np.ndarray) -> np.ndarray:
    """Half-up rounding, in place; the SQL ``round`` of a score gives the same."""
    scores *= 10.0**SCORE_DIGITS
    scores += 0.5
    np.floor(scores, out=scores)
    scores /= 10.0**SCORE_DIGITS
    return scores


def _int64(column) -> np.ndarray:
    return _flat(column).cast(pa.int64()).to_numpy(zero_copy_only=False)


def _flat(column):
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def with_vector(rows, column: str):
    """The rows whose vector is not null: a missing vector matches nothing."""
    return rows.filter(pc.is_valid(rows.column(column))) if rows.column(column).null_count else rows


class Vectors:
    """Matrix view of a vector column; sparse vectors are cut to the slots in use."""

    def __init__(self, column, slots: np.ndarray | None = None):
        column = _flat(column)
        self.rows = len(column)
        self.sparse = pa.types.is_struct(column.type)
        if self.sparse:
            index, weight = column.field("slots"), column.field("weights")
            lengths = pc.list_value_length(index).fill_null(0).to_numpy(zero_copy_only=False)
            self.owner = np.repeat(np.arange(self.rows), lengths)
            self.index = index.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            self.weight = weight.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            self.slots = np.unique(self.index) if slots is None else slots
            spot = np.searchsorted(self.slots, self.index)
            spot[spot == len(self.slots)] = 0
            known = self.slots[spot] == self.index if len(self.slots) else np.zeros(len(spot), bool)
            self.owner, self.spot, self.weight = self.owner[known], spot[known], self.weight[known]
            self.width = len(self.slots)
        else:
            values = column.flatten().to_numpy(zero_copy_only=False)
            values = values if values.dtype == np.float32 else values.astype(np.float64, copy=False)
            self.width = len(values) // self.rows if self.rows else 0
            if self.width * self.rows != len(values):
                raise ValueError("vectors of one column must share one dimension")
            self.raw = values.reshape(self.rows, self.width)  # as stored: doubles are made a tile at a time
            self.slots = None

    @property
    def values(self) -> np.ndarray:
        return self.raw.astype(np.float64, copy=False)

    def block(self, start: int, stop: int) -> np.ndarray:
        if not self.sparse:
            return self.raw[start:stop].astype(np.float64, copy=False)
        low, high = np.searchsorted(self.owner, [start, stop])
        dense = np.zeros((stop - start, self.width))
        dense[self.owner[low:high] - start, self.spot[low:high]] = self.weight[low:high]
        return dense


    # --- sparse vectors by row ---

    def by_row(self) -> bool:
        """Find the entries of each row. False where a row's slots do not ascend, or a weight or length is not one that single precision bounds."""
        self.starts = np.searchsorted(self.owner, np.arange(self.rows + 1))
        self.length = np.sqrt(np.bincount(self.owner, self.weight**2, minlength=self.rows))
        ascending = (np.diff(self.owner) > 0) | (np.diff(self.spot) > 0)
        return bool(ascending.all() and (self.length < PLAIN_LENGTH).all())

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place among ``rows``, spot and weight of each of their entries."""
        n = self.starts[rows + 1] - self.starts[rows]
        at = np.repeat(self.starts[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.repeat(np.arange(len(rows)), n), self.spot[at], self.weight[at]

    def dense(self, rows: np.ndarray) -> np.ndarray:
        place, spot, weight = self.entries(rows)
        out = np.zeros((len(rows), self.width))
        out[place, spot] = weight
        return out


def _by_spot(place: np.ndarray, spot: np.ndarray, weight: np.ndarray, head: np.ndarray, rows: int):
    """The head's entries as a matrix; of the others, places and weights by spot, the spots, and where each begins."""
    column = head[spot]
    inside = column >= 0
    matrix = np.zeros((rows, int(head.max(initial=-1)) + 1), np.float32)
    matrix[place[inside], column[inside]] = weight[inside]
    place, spot, weight = place[~inside], spot[~inside], weight[~inside].astype(np.float32)
    order = np.argsort(spot, kind="stable")
    spots, starts = np.unique(spot[order], return_index=True)
    return matrix, place[order], weight[order], spots, np.append(starts, len(order))


def lengths(x: np.ndarray) -> np.ndarray:
    """Length of each row, made a tile at a time."""
    step = max(1, TILE_ENTRIES // 4 // max(x.shape[1], 1))
    parts = [np.sqrt((x[i : i + step].astype(np.float64) ** 2).sum(axis=1)) for i in range(0, len(x), step)]
    return np.concatenate(parts) if parts else np.zeros(0)


class Block:
    """Dense items prepared for scoring, by ascending id; one with a component that is no finite number has no score and is left out."""

    def __init__(self, items, requests: Requests, cell: np.ndarray | None = None):
        s = requests.scoring
        ids, x = _int64(items.column(s.item_id)), Vectors(items.column(s.item_vector)).raw
        length = lengths(x)
        order = np.argsort(ids, kind="stable")
        order = order[np.isfinite(length[order])]
        if len(order) < len(ids) or (order[1:] < order[:-1]).any():
            ids, x, length = ids[order], x[order], length[order]
        self.ids, self.x, self.length = ids, x, length
        self.single = x.astype(np.float32, copy=False)
        self.category = np.array([requests.codes.get(c, -2) for c in items.column(s.item_category).take(pa.array(order)).to_pylist()]) if s.category else None
        self.cell = None if cell is None else cell[order]


class Requests:
    """A block of requests prepared for scoring."""

    def __init__(self, table: pa.Table, scoring: Scoring):
        self.scoring = scoring
        self.ids = _int64(table.column(scoring.query_id))
        self.vectors = Vectors(table.column(scoring.query_vector))
        # Scored in single precision first: dense vectors whose score is their product alone.
        self.plain = not (self.vectors.sparse or scoring.mask or scoring.available or scoring.required)
        if self.plain:
            self.single, self.length = self.vectors.raw.astype(np.float32, copy=False), lengths(self.vectors.raw)
        # So are sparse ones without a condition.
        self.lean = self.vectors.sparse and not (scoring.category or scoring.mask or scoring.available or scoring.required) and self.vectors.by_row()
        self.terms: list[str] = []
        if scoring.category:
            wanted = table.column(scoring.category).to_pylist()
            self.codes = {c: n for n, c in enumerate(sorted({c for c in wanted if c is not None}))}
            self.categories = np.array([self.codes.get(c, -1) for c in wanted])
        if scoring.available:
            self.available = self._term_counts(table.column(scoring.available))
            self.listed = np.maximum(self.available.sum(axis=1), 1.0)
        if scoring.required:
            self.required = self._term_counts(table.column(scoring.required)) > 0
        for name in ("available", "required"):  # both matrices end up as wide as the shared term list
            matrix = getattr(self, name, None)
            if matrix is not None and matrix.shape[1] < len(self.terms):
                setattr(self, name, np.pad(matrix, ((0, 0), (0, len(self.terms) - matrix.shape[1]))))

    def _term_counts(self, lists) -> np.ndarray:
        lists = [[t.lower() for t in row or []] for row in lists.to_pylist()]
        known = {t: i for i, t in enumerate(self.terms)}
        for row in lists:
            for term in row:
                known.setdefault(term, len(known))
        self.terms = list(known)
        counts = np.zeros((len(lists), len(known)))
        for i, row in enumerate(lists):
            for term in row:
                counts[i, known[term]] += 1
        return counts

    def simple(self, rows: np.ndarray) -> np.ndarray:
        """Whether single precision bounds the scores of these rows; a vector of zeros ties with everything."""
        return (self.length[rows] > 0) & (self.length[rows] < PLAIN_LENGTH)

    def reaching(self, rows: np.ndarray, block: Block, low: int, high: int, bar: np.ndarray, marks: np.ndarray | None = None):
        """(place among ``rows``, place in the block, score) of the pairs whose score is at least the row's ``bar``; none if they may be too many.

        Products in single precision, with a bound of their error, tell which pairs can reach it; these are scored in doubles.
        """
        reach = block.length[low:high].max()
        if reach >= PLAIN_LENGTH:
            return None
        error = (self.vectors.width + 4) * 2.0**-24 * 1.01 * self.length[rows] * reach
        least = np.nextafter((bar - error - 10.0**-SCORE_DIGITS - 1e-30).astype(np.float32), np.float32(-np.inf))
        asked, wide, parts, n = self.single[rows], max(1, CACHED_ENTRIES // len(rows)), [], 0
        for start in range(low, high, wide):
            scores = asked @ block.single[start : min(start + wide, high)].T
            # Not below: an overflow to no number stays a candidate. Nearly all rows have none.
            some = np.flatnonzero(~(scores.max(axis=1) < least))
            if len(some):
                r, i = np.divmod(np.flatnonzero(~(scores[some] < least[some, None]).ravel()), scores.shape[1])
                parts.append((some[r], i + start))
                n += len(r)
                if n > len(rows) * (high - low) // MANY + 16 * len(rows):
                    return None
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        r, i = (np.concatenate(part) for part in zip(*parts))
        order = np.argsort(r, kind="stable")
        r, i = r[order], i[order]
        keep = self._allowed(rows[r], block, i, marks)
        if keep is not None:
            r, i = r[keep], i[keep]
        score = self.products(rows[r], block.x, i)
        keep = score >= bar[r]
        return r[keep], i[keep], score[keep]

    def products(self, row: np.ndarray, x: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The rounded score of each pair (request row, row of ``x``)."""
        score = np.zeros(len(row))
        for a in range(0, len(row), PAIRS):
            b = slice(a, a + PAIRS)
            score[b] = np.einsum("ij,ij->i", self.vectors.raw[row[b]].astype(np.float64), x[place[b]].astype(np.float64))
        return round_scores(score)

    def _allowed(self, row: np.ndarray, block: Block, i: np.ndarray, marks: np.ndarray | None) -> np.ndarray | None:
        """Of pairs (row, place in the block), which may match; broadcast as the arguments are."""
        keep = None
        if self.scoring.category:
            keep = (self.categories[row] == block.category[i]) | (self.categories[row] < 0)
        if self.scoring.exclude_self:
            other = self.ids[row] != block.ids[i]
            keep = other if keep is None else keep & other
        if marks is not None:
            marked = marks[row, block.cell[i]]
            keep = marked if keep is None else keep & marked
        return keep

    def sparse_products(self, row: np.ndarray, given: Vectors, place: np.ndarray) -> np.ndarray:
        """The rounded score of each pair (request row, row of ``given``), pairs by row."""
        score, step = np.zeros(len(row)), max(1, PAIRS // 16)
        for a in range(0, len(row), step):
            own, local = np.unique(row[a : a + step], return_inverse=True)
            pair, spot, weight = given.entries(place[a : a + step])
            dense = self.vectors.dense(own)
            score[a : a + step] = np.bincount(pair, dense[local[pair], spot] * weight, minlength=len(local))
        return round_scores(score)

    def sparse_reaching(self, rows: np.ndarray, ids: np.ndarray, given: Vectors, low: int, high: int, head: np.ndarray, met: tuple, bar: np.ndarray, k: int):
        """As ``reaching``, for sparse vectors and bars above 0, without those that ``k`` others of their row surely exceed."""
        asked = _by_spot(*self.vectors.entries(rows), head, len(rows))
        scores = asked[0] @ met[0].T
        _, mine, theirs = np.intersect1d(asked[3], met[3], assume_unique=True, return_indices=True)
        for a, b in zip(mine.tolist(), theirs.tolist()):
            q, i = slice(asked[4][a], asked[4][a + 1]), slice(met[4][b], met[4][b + 1])
            scores[asked[1][q][:, None], met[1][i]] += asked[2][q][:, None] * met[2][i]
        error = (self.vectors.width + 4) * 2.0**-24 * 1.01 * self.vectors.length[rows] * given.length[low:high].max()
        least = np.nextafter((bar - error - 10.0**-SCORE_DIGITS - 1e-30).astype(np.float32), np.float32(-np.inf))
        r, i = np.divmod(np.flatnonzero(~(scores < least[:, None]).ravel()), high - low)
        i += low
        if self.scoring.exclude_self:
            other = self.ids[rows[r]] != ids[i]
            r, i = r[other], i[other]
        about = scores[r, i - low]
        order = np.lexsort((-about, r))
        r, i, about = r[order], i[order], about[order]
        first = np.searchsorted(r, np.arange(len(rows) + 1))
        full = np.flatnonzero(np.diff(first) > k)
        kth = np.full(len(rows), -np.inf)
        kth[full] = about[first[full] + k - 1]
        near = ~(about < (kth - 2 * error - 2 * 10.0**-SCORE_DIGITS)[r])
        r, i = r[near], i[near]
        score = self.sparse_products(rows[r], given, i)
        keep = score >= bar[r]
        return r[keep], i[keep], score[keep]

    def sparse_whole(self, rows: np.ndarray, ids: np.ndarray, given: Vectors, low: int, high: int) -> np.ndarray:
        scores = round_scores(self.vectors.dense(rows) @ given.block(low, high).T)
        if self.scoring.exclude_self:
            scores[self.ids[rows][:, None] == ids[None, low:high]] = -np.inf
        return scores

    def whole(self, rows: np.ndarray, block: Block, low: int, high: int, marks: np.ndarray | None = None) -> np.ndarray:
        """The scores of a tile; excluded pairs score -inf."""
        scores = round_scores(self.vectors.raw[rows].astype(np.float64) @ block.x[low:high].astype(np.float64).T)
        keep = self._allowed(rows[:, None], block, np.arange(low, high)[None], marks)
        if keep is not None:
            scores[~keep] = -np.inf
        return scores

    def tiles(self, items: pa.RecordBatch | pa.Table, cell: np.ndarray | None = None, marks: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(request rows, item ids, scores) tiles; excluded pairs score -inf, as do those whose cell is not among the ``marks`` of the request."""
        s = self.scoring
        order = np.argsort(_int64(items.column(s.item_id)), kind="stable")
        items = items.take(pa.array(order))
        ids = _int64(items.column(s.item_id))
        vectors = Vectors(items.column(s.item_vector), self.vectors.slots)
        texts = items.column(s.item_text) if (s.available or s.required) else None
        if s.category:
            categories = np.array([self.codes.get(c, -2) for c in items.column(s.item_category).to_pylist()])
        item_step = max(1, min(len(ids), TILE_ENTRIES // max(vectors.width, len(self.terms), 1)))
        for low in range(0, len(ids), item_step):
            high = min(low + item_step, len(ids))
            block = vectors.block(low, high)
            found = self._found(texts, low, high)
            step = max(1, TILE_ENTRIES // (high - low))
            for first in range(0, len(self.ids), step):
                rows = np.arange(first, min(first + step, len(self.ids)))
                scores = self.vectors.block(first, first + len(rows)) @ block.T
                if s.available:
                    share = (self.available[rows] @ found) / self.listed[rows, None]
                    scores = s.weights[0] * scores + s.weights[1] * share
                scores = round_scores(scores)
                out = fixed.MASKED_SCORE if s.mask else -np.inf
                if s.category:
                    wanted = self.categories[rows, None]
                    scores[(wanted != categories[None, low:high]) & (wanted >= 0)] = out
                if s.required:
                    need = self.required[rows]
                    scores[(need @ found) < need.sum(axis=1)[:, None]] = out
                if s.exclude_self:
                    scores[self.ids[rows, None] == ids[None, low:high]] = -np.inf
                if marks is not None:
                    scores[~marks[rows[:, None], cell[order][None, low:high]]] = -np.inf
                yield rows, ids[low:high], scores

    def _found(self, texts, low: int, high: int) -> np.ndarray | None:
        if texts is None:
            return None
        part = texts.slice(low, high - low)
        hits = [pc.match_substring(part, t).fill_null(False).to_numpy(zero_copy_only=False) for t in self.terms]
        return np.array(hits, dtype=np.float64).reshape(len(self.terms), high - low)


class Best:
    """Running best ``k`` items of every request in a block."""

    def __init__(self, requests: Requests, k: int, floor: dict[int, float] | np.ndarray | None = None):
        self.requests, self.k, self.seen = requests, k, 0
        # Places without an item score -inf.
        self.score = np.full((len(requests.ids), k), -np.inf)
        self.item = np.zeros((len(requests.ids), k), np.int64)
        # Scores below the floor of a request cannot be among its best.
        if isinstance(floor, np.ndarray):
            self.floor = floor.astype(np.float64)
        else:
            floor = floor or {}
            self.floor = np.array([floor.get(i, -np.inf) for i in requests.ids.tolist()])

    def offer(self, items, rows: np.ndarray | None = None, cell: np.ndarray | None = None, marks: np.ndarray | None = None) -> None:
        """Items for all requests or for some ``rows``; with ``marks`` (rows x cells), only those whose ``cell`` is marked."""
        if self.requests.lean and marks is None and rows is None and self._sparse(items):
            return
        if not self.requests.plain:
            for own, ids, scores in self.requests.tiles(items, cell, marks):
                self._tile(own, ids, scores)
            return
        block = Block(items, self.requests, cell)
        rows = np.arange(len(self.floor)) if rows is None else rows
        most = max(1, min(len(block.ids), TILE_ENTRIES // max(self.requests.vectors.width, TILE_ROWS)))
        low = 0
        while low < len(block.ids) and len(rows):
            # The first few items give a floor, and a few more a better one; then nearly all of the others are below it.
            few = min(most, max(256, 4 * self.k, 3 * self.seen))
            high = min(low + few, len(block.ids))
            self.seen += high - low
            step = max(1, TILE_ENTRIES // (high - low))
            for first in range(0, len(rows), step):
                self._part(rows[first : first + step], block, low, high, marks)
            low = high

    def _sparse(self, items) -> bool:
        """Offer sparse items; False, and nothing done, where single precision does not bound their scores."""
        requests = self.requests
        items = items.take(pa.array(np.argsort(_int64(items.column(requests.scoring.item_id)), kind="stable")))
        ids, given = _int64(items.column(requests.scoring.item_id)), Vectors(items.column(requests.scoring.item_vector), requests.vectors.slots)
        if not given.by_row():
            return False
        common = np.bincount(requests.vectors.spot, minlength=given.width) * np.bincount(given.spot, minlength=given.width)
        head = np.full(given.width, -1)
        chosen = np.argsort(-common, kind="stable")[:HEAD_SLOTS]
        head[chosen] = np.arange(len(chosen))
        wide, low = max(1, TILE_ENTRIES // max(given.width, HEAD_SLOTS)), 0
        while low < len(ids):
            high = min(low + min(8 * wide, max(256, 4 * self.k, 3 * self.seen)), len(ids))
            self.seen += high - low
            quick = np.flatnonzero(self.floor > 0)  # others may match items that share no slot
            slow = np.flatnonzero(~(self.floor > 0))
            step = max(1, TILE_ENTRIES // (high - low))
            met = _by_spot(*given.entries(np.arange(low, high)), head, high - low) if len(quick) else ()
            for first in range(0, len(quick), step):
                own = quick[first : first + step]
                r, i, score = requests.sparse_reaching(own, ids, given, low, high, head, met, self.floor[own], self.k)
                self._merge(own[r], ids[i], score)
            for first in range(0, len(slow), wide):
                own = slow[first : first + wide]
                for a in range(low, high, wide):
                    b = min(a + wide, high)
                    self._tile(own, ids[a:b], requests.sparse_whole(own, ids, given, a, b))
            low = high
        return True

    def _part(self, rows: np.ndarray, block: Block, low: int, high: int, marks: np.ndarray | None) -> None:
        quick = self.requests.simple(rows) & (self.floor[rows] > -np.inf)
        slow = rows[~quick]
        rows = rows[quick]
        if len(rows):
            found = self.requests.reaching(rows, block, low, high, self.floor[rows], marks)
            if found is None:
                slow = np.concatenate([slow, rows])
            else:
                r, i, score = found
                self._merge(rows[r], block.ids[i], score)
        if len(slow):
            self._tile(slow, block.ids[low:high], self.requests.whole(slow, block, low, high, marks))

    def _tile(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        floor = self.floor[rows]
        scores = np.where(np.isfinite(scores), scores, -np.inf)  # a score that is no number is no match, and sets no floor
        if scores.shape[1] > self.k:
            floor = np.maximum(floor, np.partition(scores, -self.k, axis=1)[:, -self.k])
        floor = floor[:, None]
        # Of the items tied at the floor only the first k can matter: ids ascend within a tile.
        tied = (scores == floor) & (scores > -np.inf)
        tied &= np.cumsum(tied, axis=1, dtype=np.int32) <= self.k
        r, i = np.nonzero((scores > floor) | tied)
        self._merge(rows[r], ids[i], scores[r, i])

    def scored(self, rows: np.ndarray, candidate: np.ndarray, ids: np.ndarray, x: np.ndarray) -> None:
        """Offer the pairs marked in ``candidate`` (rows x items)."""
        r, i = np.divmod(np.flatnonzero(candidate.ravel()), len(ids))
        score = self.requests.products(rows[r], x, i)
        keep = np.isfinite(score) & (score >= self.floor[rows[r]])
        self._merge(rows[r[keep]], ids[i[keep]], score[keep])

    def _merge(self, row, item, score) -> None:
        """Only the requests that got an item are sorted again."""
        if not len(row):
            return
        changed, row = np.unique(row, return_inverse=True)
        old, place = np.nonzero(self.score[changed] > -np.inf)
        row = np.concatenate([old, row])
        item = np.concatenate([self.item[changed[old], place], item])
        score = np.concatenate([self.score[changed[old], place], score])
        order = np.lexsort((item, -score, row))
        row, item, score = row[order], item[order], score[order]
        place = np.arange(len(row)) - np.searchsorted(row, np.arange(len(changed)))[row]
        kept = place < self.k
        row, item, score, place = changed[row[kept]], item[kept], score[kept], place[kept]
        self.score[row, place], self.item[row, place] = score, item
        last = place == self.k - 1
        self.floor[row[last]] = np.maximum(self.floor[row[last]], score[last])

    def result(self) -> pa.Table:
        row, place = np.nonzero(self.score > -np.inf)
        return _matches(self.requests.ids[row], self.item[row, place], self.score[row, place])


def _matches(query_ids, item_ids, scores) -> pa.Table:
    return pa.table(
        {
            "query_id": pa.array(query_ids, pa.int64()),
            "item_id": pa.array(item_ids, pa.int64()),
            "score": pa.array(scores, pa.float64()),
        }
    )


BlockKernel = Callable[[pa.Table, Iterator], Iterator[pa.Table]]


def broadcast_table(requests: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> pa.Table | None:
    """The request table if it is within the bounds of a broadcast."""
    max_rows = MAX_BROADCAST_ROWS if max_rows is None else max_rows
    max_bytes = MAX_BROADCAST_BYTES if max_bytes is None else max_bytes
    max_rows = min(max_rows, _rows_within(requests, max_bytes))
    head = requests.limit(max_rows + 1).toArrow()
    return head if not head.num_rows or (head.num_rows <= max_rows and head.nbytes <= max_bytes) else None


def scan_items(head: pa.Table, items: DataFrame, kernel: BlockKernel, schema: str) -> DataFrame:
    """``kernel(requests, item batches)`` where the items lie."""
    if not head.num_rows:  # nothing asked: the items need not be read
        return items.sparkSession.createDataFrame([], schema)
    shared = items.sparkSession.sparkContext.broadcast(head)

    def scan(batches):
        for table in kernel(shared.value, batches):
            yield from table.to_batches()

    return items.mapInArrow(scan, schema)


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows written once to the shared folder: what made them does not run again where they are counted and joined."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def block_join(
    requests: DataFrame,
    items: DataFrame,
    kernel: BlockKernel,
    schema: str,
    *,
    max_rows: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Run ``kernel(request block, item batches)`` over every pair of blocks: requests are broadcast, or both sides packed."""
    requests = written(requests, "requests")
    head = broadcast_table(requests, max_rows, max_bytes)
    if head is not None:
        return scan_items(head, items, kernel, schema)
    return meet_blocks(requests, written(items, "items"), kernel, schema)


def _row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes."""

    def width(kind, column: Column) -> Column:
        if isinstance(kind, StructType):
            return sum((width(f.dataType, column[f.name]) for f in kind.fields), F.lit(0))
        if isinstance(kind, ArrayType):
            return F.coalesce(F.octet_length(F.array_join(column, "")) if isinstance(kind.elementType, StringType) else 8 * F.size(column), F.lit(0))
        return F.coalesce(F.octet_length(column), F.lit(0)) if isinstance(kind, StringType) else F.lit(8)

    return width(df.schema, F.struct(*df.columns)).cast("long")


def packed(df: DataFrame) -> DataFrame:
    """The rows of a stored table in blocks, ``_at, _block``: a block is one row of measured bytes in Arrow's stream format, and a partition a few of them."""
    total = df.agg(F.coalesce(F.sum(_row_bytes(df)), F.lit(0))).first()[0]
    # Few rows are cut too, so that all cores get some.
    part = min(PART_BYTES, max(LEAST_PART_BYTES, int(total / (TASKS_A_CORE * df.sparkSession.sparkContext.defaultParallelism) ** 0.5)))
    most = min(PACK_BYTES, part)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows, size = TaskContext.get().partitionId() << 32, [], 0

        def block() -> pa.RecordBatch:
            table, sink = pa.Table.from_batches(rows).combine_chunks(), pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as stream:
                stream.write_table(table)
            return pa.record_batch({"_at": pa.array([at], pa.int64()), "_block": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

        for batch in batches:
            step = max(1, batch.num_rows * most // max(batch.nbytes, 1))
            for low in range(0, batch.num_rows, step):
                some = batch.slice(low, step)
                if rows and size + some.nbytes > most:
                    yield block()
                    at, rows, size = at + 1, [], 0
                rows.append(some)
                size += some.nbytes
        if rows:
            yield block()

    return df.mapInArrow(pack, "_at long, _block binary").repartitionByRange(max(1, -(-total // part)), "_at")


def meet_blocks(requests: DataFrame, items: DataFrame, kernel: BlockKernel, schema: str) -> DataFrame:
    """``kernel(request block, item blocks)`` for every pair of blocks of two stored tables.

    The product is one of blocks and is not shuffled: each task reads the partition of either side that it needs, a block after another.
    """
    left = packed(requests).withColumnsRenamed({"_at": "_q", "_block": "_asked"})
    right = packed(items).select(F.col("_block").alias("_given"))

    def table(block: pa.Scalar) -> pa.Table:
        return pa.ipc.open_stream(block.as_buffer()).read_all()

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Scalar, pa.Scalar]]:
        for batch in batches:
            yield from zip(batch.column("_q").to_pylist(), batch.column("_asked"), batch.column("_given"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, met in groupby(pairs(batches), key=lambda pair: pair[0]):
            _, asked, given = next(met)
            blocks = (batch for block in chain([given], (g for _, _, g in met)) for batch in table(block).to_batches())
            for found in kernel(table(asked), blocks):
                yield from found.to_batches()

    # Not a broadcast: neither side goes through the driver.
    return left.hint("shuffle_replicate_nl").crossJoin(right).mapInArrow(meet, schema)


PROBE_ROWS = 256


def _rows_within(df: DataFrame, max_bytes: int) -> int:
    """How many rows of a request table fit a number of bytes, by the width of its first rows.

    Dense vectors all have one width; sparse vectors and term lists do not, so
    these are measured before more of the table is fetched.
    """
    if not any(f.dataType.typeName() == "struct" or "string" in f.dataType.simpleString() for f in df.schema.fields):
        return MAX_BROADCAST_ROWS
    probe = df.limit(PROBE_ROWS).toArrow()
    return max_bytes * max(probe.num_rows, 1) // max(probe.nbytes, 1)


def _side(df: DataFrame, columns: list[str], lowered: str | None = None) -> DataFrame:
    picked = list(dict.fromkeys(columns))
    return df.select(*[F.lower(F.coalesce(F.col(c), F.lit(""))).alias(c) if c == lowered else F.col(c) for c in picked])


def top_k(
    requests: DataFrame,
    items: DataFrame,
    k: int = fixed.TOP_K,
    scoring: Scoring = Scoring(),
    *,
    attach: DataFrame | None = None,
    pilot: int | None = None,
    max_rows: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """The ``k`` best items of every request: ``query_id, item_id, score, rank``.

    ``attach`` adds its columns to the result by ``item_id``. Ranks start at 1. A null vector, or one whose
    scores are not finite, matches nothing on either side.

    A task sends up to ``k`` rows per request, so a stored index of very many
    partitions makes the exchange large. ``pilot=n`` first scores every n-th
    partition: the k-th best score found there is a lower bound of the final one,
    and the full pass then sends only items that reach it. The result is the same.
    """
    left = _side(requests, scoring.query_side())
    right = _side(items, scoring.item_side(), scoring.item_text if (scoring.available or scoring.required) else None)
    if scoring.category:
        left = left.withColumn(scoring.category, F.lower(scoring.category))
        right = right.withColumn(scoring.item_category, F.lower(scoring.item_category))

    def kernel(floor: dict[int, float], every: int):
        def run(block: pa.Table, batches) -> Iterator[pa.Table]:
            context = TaskContext.get()
            if every > 1 and context.partitionId() % every:
                return
            block = with_vector(block, scoring.query_vector)
            if not block.num_rows:
                return
            best = Best(Requests(block, scoring), k, floor)
            for batch in batches:
                batch = with_vector(batch, scoring.item_vector)
                if batch.num_rows:
                    best.offer(batch)
            yield best.result()

        return run

    left = written(left, "requests")  # what made them runs once, and not for the probe as well
    head = broadcast_table(left, max_rows, max_bytes)
    if head is not None:
        floor: dict[int, float] = {}
        if pilot:  # one number per broadcast request
            last = rank_matches(scan_items(head, right, kernel(floor, pilot), MATCH_SCHEMA), k).where(F.col("rank") == k).select("query_id", "score")
            floor = {r.query_id: r.score for r in last.collect()}
        partial = scan_items(head, right, kernel(floor, 1), MATCH_SCHEMA)
    elif scoring.mask or any(isinstance(df.schema[c].dataType, StructType) for df, c in ((left, scoring.query_vector), (right, scoring.item_vector))):
        # Masked items match with a score of their own, and sparse vectors have no pivots: all blocks meet.
        partial = meet_blocks(left, written(right, "items"), kernel({}, 1), MATCH_SCHEMA)
    else:
        from larder.operators.cells import nearest_in_cells  # it is built on this module

        partial, _, _ = nearest_in_cells(left, right, k, scoring)
    ranked = rank_matches(partial, k)
    if attach is None:
        return ranked
    # At most k rows per counted request; beyond the bound the planner decides.
    small = head is not None and head.num_rows * k <= MAX_BROADCAST_MATCHES
    return (F.broadcast(ranked) if small else ranked).join(attach, "item_id")


def rank_matches(matches: DataFrame, k: int) -> DataFrame:
    """Final top-k. Catalyst puts a WindowGroupLimit below the exchange."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("item_id"))
    return matches.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= k)


def max_similarity(requests: DataFrame, items: DataFrame, scoring: Scoring = Scoring(), **bounds) -> DataFrame:
    """Best score per request: the rank-1 row of the top-k pass."""
    return top_k(requests, items, 1, scoring, **bounds).select("query_id", F.col("score").alias("max_similarity"))


def similar_pairs(
    left: DataFrame,
    right: DataFrame | None = None,
    min_similarity: float = fixed.GUARDRAIL_THRESHOLD,
    *,
    id_column: str = "item_id",
    vector: str = "embedding",
    cell_rows: int | None = None,
) -> DataFrame:
    """Pairs of vectors at or above a similarity: ``id_a, id_b, score``.

    Within one set (``right`` omitted) each unordered pair comes once, ``id_a < id_b``. A null vector, or one with a component that is
    null or not finite, is in no pair. Rows meet only in cells whose bound allows the similarity.
    """
    from larder.operators.cells import CELL_ROWS, pairs_in_cells  # it is built on this module

    pairs = pairs_in_cells(left, right, min_similarity, id_column, vector, cell_rows or CELL_ROWS)
    return pairs.select(F.col("query_id").alias("id_a"), F.col("item_id").alias("id_b"), "score")
