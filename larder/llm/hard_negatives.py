"""Hard negatives by zone maps over Hilbert-ordered blocks.

Vectors become integers, rows are put in the order of a Hilbert curve through the dimensions that vary most, and consecutive rows form
blocks, one row of a Parquet table each, with the least and largest value of every dimension and the labels present: the zone map.
For an anchor, interval arithmetic over a block's box gives bounds of the inner product with any row in it. Positives are sought in the
blocks with the anchor's label whose upper bound reaches the fifth best score of the anchor's own block; negatives in the blocks
with another label whose bounds meet one of the anchor's score windows. Other blocks are not read for it.

Anchors are a stated query set. They meet the zone map and then the chosen blocks in groups of ``GROUP_ANCHORS`` and pages of ``PAGE_BLOCKS``,
so no task holds more than one of each, and only the best few rows of each page leave a task. Bounds prune as far as the data are
clustered: rows that fill all dimensions evenly have boxes that nearly every window meets, and every block is then read, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import ranked, stored

BLOCK_ROWS, PAGE_BLOCKS, GROUP_ANCHORS = 128, 512, 4096
KEY_DIMENSIONS, KEY_BITS = 16, 4  # of the curve
EXACT = 1 << 53  # doubles hold integers exactly below it
NEVER = -(1 << 62)
_LONGS = pa.list_(pa.int64())


def usable(vectors: DataFrame, scale: int, relabel: tuple[int, int] | None) -> DataFrame:
    """vec_id, label, v: the rows that take part, in integers."""
    label = F.col("label").cast("long")
    if relabel:
        every, labels = relabel
        label = F.when(F.col("vec_id") % every == 0, (label + 1) % labels).otherwise(label)
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    taking_part = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    return taking_part.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), F.transform("embedding", lambda x: F.floor(scale * x.cast("double"))).alias("v"))


# --- the curve ------------------------------------------------------------------------------------


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each cell (rows x dimensions, 0 to 2^bits - 1) on the Hilbert curve, as big-endian bytes.

    Gray-code form: from the high bit down, a set bit mirrors the lower bits of the first dimension and a clear one swaps
    them with its own; then neighbouring dimensions are added without carry.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for i in range(n):
            on = (x[i] >> bit) & 1 == 1
            swapped = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swapped)
            x[i] ^= swapped
    x = np.bitwise_xor.accumulate(x, axis=0)
    turned = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, 0, -1):
        turned ^= np.where((x[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    x ^= turned
    planes = [(x[i] >> bit) & 1 for bit in range(bits - 1, -1, -1) for i in range(n)]
    return np.packbits(np.stack(planes, axis=1).astype(np.uint8), axis=1)


def _matrix(column, width: int) -> np.ndarray:
    """Rows of a list column; short ones end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    out[owner, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            lists = batch.column("v")
            x = _matrix(lists, int(np.diff(lists.offsets.to_numpy()).max())).astype(float)
            yield pa.RecordBatch.from_pydict({"place": np.arange(x.shape[1]), "n": np.full(x.shape[1], len(x)), "s": x.sum(axis=0), "q": (x * x).sum(axis=0)})


def _keyed(used: np.ndarray, middle: np.ndarray, spread: np.ndarray, width: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v"), width)
            levels = 1 << KEY_BITS
            cells = np.clip(np.floor(((x[:, used] - middle) / spread + 2) / 4 * levels), 0, levels - 1)  # four deviations wide
            keys = [k.tobytes() for k in hilbert_keys(cells, KEY_BITS)] if len(used) else [b""] * len(x)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), batch.column("vec_id"), batch.column("label"), batch.column("v")], names=["curve", "vec_id", "label", "v"])

    return work


# --- blocks ---------------------------------------------------------------------------------------

BLOCKS = "block long, vec_ids array<long>, labels array<long>, flat array<long>, low array<long>, high array<long>, present array<long>"
_BLOCKS = pa.schema([("block", pa.int64()), *[(n, _LONGS) for n in ("vec_ids", "labels", "flat", "low", "high", "present")]])


def _packed(width: int, rows: int):
    def block(number: int, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
        by_id = np.argsort(ids, kind="stable")  # ties of scores go to the smaller id
        columns = [number, ids[by_id], labels[by_id], x[by_id].ravel(), x.min(axis=0), x.max(axis=0), np.unique(labels)]
        return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(columns, _BLOCKS)], schema=_BLOCKS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, labels, x = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, width), np.int64)
        for batch in batches:
            ids = np.concatenate([ids, batch.column("vec_id").to_numpy()])
            labels = np.concatenate([labels, batch.column("label").to_numpy()])
            x = np.concatenate([x, _matrix(batch.column("v"), width)])
            whole = len(ids) // rows * rows
            for at in range(0, whole, rows):
                yield block(number, ids[at : at + rows], labels[at : at + rows], x[at : at + rows])
                number += 1
            ids, labels, x = ids[whole:], labels[whole:], x[whole:]
        if len(ids):
            yield block(number, ids, labels, x)

    return work


def build_blocks(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, int]:
    """The block table of ``rows`` (vec_id, label, v) and the number of dimensions.

    The driver gets the moments of each dimension. Rows of one place on the curve are spread by their ids.
    """
    moments = rows.mapInArrow(_moments, "place long, n long, s double, q double").groupBy("place").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).orderBy("place").collect()
    width = len(moments)
    middle = np.array([m.s / m.n for m in moments])
    spread = np.sqrt(np.maximum(np.array([m.q / m.n for m in moments]) - middle**2, 0.0))
    used = np.sort(np.argsort(-spread, kind="stable")[:KEY_DIMENSIONS])
    used = used[spread[used] > 0]
    keyed = rows.mapInArrow(_keyed(used, middle[used], spread[used], width), "curve binary, vec_id long, label long, v array<long>")
    order = [F.col("curve"), F.xxhash64("vec_id")]
    dealt = stored(keyed, "negatives-keyed").repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(dealt.mapInArrow(_packed(width, block_rows), BLOCKS), "negatives-blocks"), width


def zone_pages(blocks: DataFrame, page_blocks: int = PAGE_BLOCKS) -> DataFrame:
    """(block, page): pages of consecutive blocks."""
    return stored(ranked(blocks.select("block"), [F.col("block")], "negatives-ranked").select("block", F.floor(F.col("rank") / page_blocks).cast("long").alias("page")), "negatives-pages")


# --- bounds ---------------------------------------------------------------------------------------


def interval(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of each anchor with any vector of each box."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return _inner(up, low) + _inner(down, high), _inner(up, high) + _inner(down, low)


def _inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a b', exactly: in doubles where all sums are small enough, else in 64-bit integers."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    return np.rint(a.astype(float) @ b.astype(float).T).astype(np.int64) if most < EXACT else a @ b.T


class Anchors:
    """A group of anchors, from its rows; a slot is an anchor, or an anchor and one of its positives."""

    def __init__(self, table: pa.Table, width: int, k: int, same: bool):
        order = np.argsort(table.column("place").to_numpy())
        table = table.take(pa.array(order))
        self.place, self.ids, self.labels = (table.column(c).to_numpy() for c in ("place", "anchor_id", "label"))
        self.v, self.k, self.same = _matrix(table.column("v"), width), k, same
        floors, ceilings = table.column("floors").combine_chunks(), table.column("ceilings").combine_chunks()
        self.slots = np.diff(floors.offsets.to_numpy())
        self.first = np.concatenate([[0], np.cumsum(self.slots)])
        self.anchor_of = np.repeat(np.arange(len(self.ids)), self.slots)
        self.floor, self.ceiling = floors.flatten().to_numpy().copy(), ceilings.flatten().to_numpy()
        self.row = self.item = self.score = np.zeros(0, np.int64)

    def reach(self) -> tuple[np.ndarray, np.ndarray]:
        """Least floor and largest ceiling of each anchor; an anchor without slots asks for nothing."""
        least, most = np.full(len(self.ids), 1 << 62), np.full(len(self.ids), NEVER)
        np.minimum.at(least, self.anchor_of, self.floor)
        np.maximum.at(most, self.anchor_of, self.ceiling)
        return least, most

    def wants(self, low: np.ndarray, high: np.ndarray, present: list[np.ndarray]) -> np.ndarray:
        """(anchors x blocks): whether the block may hold a row that an anchor is looking for."""
        least, most = interval(self.v, low, high)
        floor, ceiling = self.reach()
        held = np.stack([np.isin(self.labels, p) if self.same else (len(p) > 1) | (self.labels != p[0]) for p in present], axis=1)
        return held & (most >= floor[:, None]) & (least <= ceiling[:, None])

    def read(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, wanted: np.ndarray) -> None:
        """Take over the rows of a block that may be among the best of a slot of the ``wanted`` anchors."""
        scores = _inner(self.v[wanted], x)
        equal = self.labels[wanted][:, None] == labels[None]
        fit = equal & (self.ids[wanted][:, None] != ids[None]) if self.same else ~equal
        for turn in range(int(self.slots[wanted].max())):
            with_slot = np.flatnonzero(self.slots[wanted] > turn)
            slot = self.first[wanted[with_slot]] + turn
            s = scores[with_slot]
            r, c = np.nonzero(fit[with_slot] & (s >= self.floor[slot][:, None]) & (s <= self.ceiling[slot][:, None]))
            if len(r):
                self._merge(slot[r], ids[c], s[r, c])

    def _merge(self, row: np.ndarray, item: np.ndarray, score: np.ndarray) -> None:
        """The best k of each slot; a slot that has k looks for nothing below the last of them."""
        row, item, score = np.concatenate([self.row, row]), np.concatenate([self.item, item]), np.concatenate([self.score, score])
        order = np.lexsort((item, -score, row))
        row, item, score = row[order], item[order], score[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        kept = place < self.k
        last = place == self.k - 1
        self.floor[row[last]] = np.maximum(self.floor[row[last]], score[last])
        self.row, self.item, self.score = row[kept], item[kept], score[kept]

    def found(self) -> pa.Table:
        anchor = self.anchor_of[self.row]
        columns = [self.place[anchor], self.row - self.first[anchor], self.item, self.score]
        return pa.table([pa.array(c, pa.int64()) for c in columns], schema=_FOUND)


FOUND = "place long, slot long, vec_id long, score long"
_FOUND = pa.schema([(n, pa.int64()) for n in ("place", "slot", "vec_id", "score")])


def _choosing(width: int, k: int, same: bool):
    """(group, page) with anchors and zone map: the blocks that some anchor of the group must read."""

    def work(anchors: pa.Table, zones: pa.Table) -> pa.Table:
        if not anchors.num_rows or not zones.num_rows:
            return _CHOSEN.empty_table()
        group, page = anchors.column("group")[0].as_py(), zones.column("page")[0].as_py()
        asked = Anchors(anchors, width, k, same)
        present = [np.array(p.as_py()) for p in zones.column("present")]
        wanted = asked.wants(_matrix(zones.column("low"), width), _matrix(zones.column("high"), width), present).any(axis=0)
        blocks = zones.column("block").to_numpy()[wanted]
        return pa.table([np.full(len(blocks), group), np.full(len(blocks), page), blocks], schema=_CHOSEN)

    return work


CHOSEN = "group long, page long, block long"
_CHOSEN = pa.schema([(n, pa.int64()) for n in ("group", "page", "block")])


def _reading(width: int, k: int, same: bool):
    """(group, page) with anchors and chosen blocks: the best rows of each slot in this page."""

    def work(anchors: pa.Table, blocks: pa.Table) -> pa.Table:
        if not anchors.num_rows or not blocks.num_rows:
            return _FOUND.empty_table()
        asked = Anchors(anchors, width, k, same)
        for i in np.argsort(blocks.column("block").to_numpy()):
            row = {n: np.array(blocks.column(n)[int(i)].values) for n in ("vec_ids", "labels", "flat", "low", "high", "present")}
            wanted = np.flatnonzero(asked.wants(row["low"][None], row["high"][None], [row["present"]])[:, 0])
            if len(wanted):
                asked.read(row["vec_ids"], row["labels"], row["flat"].reshape(len(row["vec_ids"]), width), wanted)
        return asked.found()

    return work


def chosen_blocks(anchors: DataFrame, blocks: DataFrame, pages: DataFrame, width: int, k: int, same: bool) -> DataFrame:
    """(group, page, block): what each group of anchors must read, by the zone map alone."""
    def every(rows: DataFrame, column: str):
        last = rows.agg(F.coalesce(F.max(column), F.lit(0))).first()[0]
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long")))

    asked = anchors.withColumn("page", every(pages, "page"))
    zones = blocks.select("block", "low", "high", "present").join(pages, "block").withColumn("group", every(anchors, "group"))
    return asked.groupBy("group", "page").cogroup(zones.groupBy("group", "page")).applyInArrow(_choosing(width, k, same), CHOSEN)


def search(anchors: DataFrame, blocks: DataFrame, pages: DataFrame, width: int, k: int, same: bool) -> DataFrame:
    """(place, slot, vec_id, score, rank): the best ``k`` rows of each slot.

    ``anchors``: place (unique), group, anchor_id, label, v, floors and ceilings (scores of each slot). ``same`` seeks other rows of the anchor's label,
    else rows of other labels.
    """
    chosen = stored(chosen_blocks(anchors, blocks, pages, width, k, same), "negatives-chosen")
    asked = anchors.join(chosen.select("group", "page").distinct(), "group")
    read = chosen.select(F.col("group").alias("of_group"), F.col("page").alias("of_page"), "block").join(blocks, "block")
    found = asked.groupBy("group", "page").cogroup(read.groupBy("of_group", "of_page")).applyInArrow(_reading(width, k, same), FOUND)
    best = Window.partitionBy("place", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _anchors(every: int, width: int, k: int):
    """Anchors of each block, with the k-th best score of their label in it as the least that a positive has to reach."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, labels = (np.array(batch.column(n)[i].values) for n in ("vec_ids", "labels"))
                chosen = np.flatnonzero(ids % every == 0)
                if not len(chosen):
                    continue
                x = np.array(batch.column("flat")[i].values).reshape(len(ids), width)
                scores = np.where((labels[chosen][:, None] == labels[None]) & (ids[chosen][:, None] != ids[None]), _inner(x[chosen], x), NEVER)
                floor = np.sort(scores, axis=1)[:, -k] if len(ids) >= k else np.full(len(chosen), NEVER)
                n = len(chosen)
                columns = [np.full(n, batch.column("block")[i].as_py()), chosen, ids[chosen], labels[chosen]]
                yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns], pa.array(list(x[chosen]), _LONGS), pa.array(floor, pa.int64())], names=["block", "spot", "anchor_id", "label", "v", "floor"])

    return work


def mine(vectors: DataFrame, anchor_every: int = 100, k_positive: int = 5, k_negative: int = 5, least_percent: int = 80, scale: int = 256, relabel: tuple[int, int] | None = (7, 10), block_rows: int = BLOCK_ROWS, page_blocks: int = PAGE_BLOCKS, group_anchors: int = GROUP_ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of ``vectors`` (vec_id, embedding, label).

    Anchors are the rows whose id is divisible by ``anchor_every``; positives the first ``k_positive`` rows of another id with the same label by (score
    descending, id); negatives the first ``k_negative`` of the rows of other labels with least_percent x positive score <= 100 x score <= 100 x positive score. Null id,
    label or vector, or a component that is null or not finite: no part. Short vectors end in zeros; components are exact below 2^53 / scale. A repeated
    row is a row of its own: its anchors give their rows again, and it is neither positive nor twin of its own id. A
    positive without rows in its window gives none; a negative score has an empty window. No rows, or no anchors: no rows. Other columns are not read.
    """
    blocks, width = build_blocks(usable(vectors, scale, relabel), block_rows)
    pages = zone_pages(blocks, page_blocks)
    picked = blocks.select("block", "vec_ids", "labels", "flat").mapInArrow(_anchors(anchor_every, width, k_positive), "block long, spot long, anchor_id long, label long, v array<long>, floor long")
    placed = ranked(picked, [F.col("block"), F.col("spot")], "negatives-anchors").withColumnRenamed("rank", "place")
    anchors = stored(placed.select("place", F.floor(F.col("place") / group_anchors).cast("long").alias("group"), "anchor_id", "label", "v", "floor"), "negatives-grouped")
    highest = F.lit(1 << 62).cast("long")
    seeking = anchors.withColumns({"floors": F.array("floor"), "ceilings": F.array(highest)}).drop("floor")
    positives = stored(search(seeking, blocks, pages, width, k_positive, True), "negatives-positives")
    listed = positives.groupBy("place").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("positives"))  # k_positive at most
    floors = F.transform("positives", lambda p: _share(p["score"], least_percent))
    windows = stored(anchors.drop("floor").join(listed, "place").withColumns({"floors": floors, "ceilings": F.transform("positives", lambda p: p["score"])}), "negatives-windows")
    negatives = search(windows.drop("positives"), blocks, pages, width, k_negative, False)
    named = windows.select("place", "anchor_id", "positives")
    positive = F.col("positives")[F.col("slot").cast("int")]
    return negatives.join(named, "place").select("anchor_id", positive["vec_id"].alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), positive["score"].alias("positive_score"), F.col("score").alias("negative_score"))


def _share(score, percent: int):
    """The least whole number s with 100 s >= percent x score, in integers."""
    wanted = score * percent
    down = (wanted - F.pmod(wanted, F.lit(100).cast("long"))) / 100  # divisible: exact below 2^53
    return F.when(F.pmod(wanted, F.lit(100).cast("long")) == 0, down).otherwise(down + 1).cast("long")
