"""Near-duplicate documents: one-permutation MinHash, banded buckets, star-shaped candidates.

A document's set is its distinct word shingles, as 64-bit hashes. One hash of each shingle gives
both a bin and a value; the smallest value of each bin is the sketch, and empty bins borrow from full ones by
a fixed random probe sequence (optimal densification). Bands of bins are the buckets.

Documents with equal sets are one class. Every class in a bucket is paired with one centre, the class that shares buckets with most others,
only, so pairs grow with the bucket's size and not with its square. Pairs are confirmed on the full sets. Jaccard distance is a metric, so with threshold t

* classes linked with the centre are one component, and pairs among them need no test;
* a class whose similarity to the centre is under 2 t - 1 is linked with none of those linked to the centre.

Buckets whose other members are still of several components are open. Their classes meet once more by an exact prefix filter: two sets of n and m shingles are linked
only if they share at least a = ceil(t (n + m) / (1 + t)), so in any common order of shingles the first n - a + 1 of one and the first m - a + 1 of the other share one.
Rare shingles come first. Copies of one text that lie just below the threshold differ in more shingles of their own than that and meet nowhere. Classes
that share such a shingle and are of several components form stars again, of ever more centres, until no pair is left.

Components are found by alternating large and small stars on the edges; every round is written to the shared folder.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import filled, lower_ascii, stored, words
from larder.session import fresh_path

MISS = 1e-6  # chance that two sets at the threshold meet in no band
SIZE_STEP = 1.01  # sets whose sizes differ by less count as of one size when prefixes are chosen
HOT_PAIRS = 200  # pairs of one centre that a task confirms
BROADCAST_ROWS = 500_000  # of two numbers: some ten MB
PROBES = 64  # probes of an empty bin; after them the next full bin on its right


def _sets(rows: DataFrame, size: int, name: str) -> DataFrame:
    """``rows`` with column ``text`` replaced by the set ``name``."""
    kept = [c for c in rows.columns if c != "text"]
    hashed = rows.select(*kept, F.transform(words(lower_ascii(filled("text"))), lambda w: F.xxhash64(w)).alias("_w"))
    runs = F.transform(F.sequence(F.lit(0), F.size("_w") - size), lambda i: F.xxhash64(*[F.col("_w")[i + k] for k in range(size)]))
    few = F.array(F.aggregate("_w", F.lit(size).cast("long"), lambda a, w: F.xxhash64(a, w)))
    chosen = F.when(F.size("_w") >= size, F.array_distinct(runs)).when(F.size("_w") > 0, few).otherwise(F.array().cast("array<bigint>"))
    return hashed.select(*kept, chosen.alias(name))


def bands_for(threshold: float, rows: int) -> int:
    return math.ceil(math.log(MISS) / math.log(1 - threshold**rows))


# --- sketches -------------------------------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that bins do not depend on the hash's own low bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def sketch(values: np.ndarray, owners: np.ndarray, n: int, bins: int) -> np.ndarray:
    """(n, bins) smallest values of each bin and set; sets without values keep the largest number."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    mixed = _mixed(values)
    slot = owners * bins + (mixed >> np.uint64(40)).astype(np.int64) % bins
    order = np.lexsort((mixed, slot))
    slots, first = np.unique(slot[order], return_index=True)
    flat = np.full(n * bins, empty, dtype=np.uint64)
    flat[slots] = mixed[order][first]
    full = flat.reshape(n, bins)
    out, open_ = full.copy(), full == empty
    probes = np.random.default_rng(7).integers(0, bins, size=(PROBES, bins))
    for probe in probes:
        if not open_.any():
            return out
        borrowed = full[:, probe]
        take = open_ & (borrowed != empty)
        out[take] = borrowed[take]
        open_ &= ~take
    for shift in range(1, bins):
        if not open_.any():
            break
        borrowed = np.roll(full, -shift, axis=1)
        take = open_ & (borrowed != empty)
        out[take] = borrowed[take]
        open_ &= ~take
    return out


_SKETCHED = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64()), ("bands", pa.list_(pa.int64()))])


def _sketcher(bands: int, rows: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                some = batch.slice(i, 256)
                sets = some.column("set")
                values = sets.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                sizes = np.diff(sets.offsets.to_numpy())
                owners = np.repeat(np.arange(len(sizes)), sizes)
                found = sketch(values, owners, len(sizes), bands * rows)
                keys = np.zeros((len(sizes), bands), dtype=np.uint64)
                for r in range(rows):
                    keys = _mixed(keys * np.uint64(31) + found[:, r::rows])
                keys = _mixed(keys + np.arange(1, bands + 1, dtype=np.uint64))
                total = np.zeros(len(sizes), dtype=np.uint64)  # a sum over the set is its number
                np.add.at(total, owners, _mixed(values ^ np.uint64(0x9E3779B97F4A7C15)))
                number = _mixed(total + sizes.astype(np.uint64)).view(np.int64)
                full = sizes > 0
                lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(full * bands)]).astype(np.int32), keys[full].reshape(-1).view(np.int64))
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), some.column("text_hash"), pa.array(sizes.astype(np.int64)), pa.array(number), lists], schema=_SKETCHED)

    return work


# --- components -----------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (u, v): root is the smallest node of its component.

    Large stars hang every larger neighbour on a node's smallest one, small stars every smaller one; both
    are a minimum (pre-aggregated) joined back on the node. Ends when no edge changes.
    """
    edges = stored(edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-edges")
    state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")).distinct()
        large = stored(large, "cc-large")
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).union(lowest.select("u", F.col("m").alias("v"))).distinct()
        edges = stored(small, "cc-small")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        state = now


# --- links ----------------------------------------------------------------------------------------


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b, linked, near): whether 100 x common >= percent x united, and the same for 2 x percent - 100.

    The centre's set travels, the other side's text does and becomes a set where they meet. A centre of many pairs is dealt out with them.
    """
    many = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / HOT_PAIRS).cast("int").alias("_parts")).where("_parts > 1")
    share = F.coalesce("_parts", F.lit(1))
    dealt = pairs.join(many, "a", "left").withColumn("_part", F.pmod(F.xxhash64("b"), share).cast("int")).drop("_parts")
    wanted = pairs.select("a").distinct().join(many, "a", "left").select(F.col("a").alias("node"), F.explode(F.sequence(F.lit(0), share - 1)).alias("_part"))
    centres = _sets(texts.join(wanted, "node"), size, "_a").withColumnRenamed("node", "a")
    with_text = dealt.join(texts.withColumnRenamed("node", "b"), "b").select("a", "b", "_part", "text")
    met = _sets(with_text.join(centres, ["a", "_part"]), size, "_b")
    common = F.size(F.array_intersect("_a", "_b"))
    counted = met.select("a", "b", common.alias("_n"), (F.size("_a") + F.size("_b")).alias("_m"))
    united = F.col("_m") - F.col("_n")
    return counted.select("a", "b", (100 * F.col("_n") >= percent * united).alias("linked"), (100 * F.col("_n") >= (2 * percent - 100) * united).alias("near"))


def _rooted(rows: DataFrame, column: str, roots: DataFrame, name: str) -> DataFrame:
    named = roots.select(F.col("node").alias(column), F.col("root").alias(name))
    return rows.join(named, column, "left").withColumn(name, F.coalesce(name, column))


def link(docs: DataFrame, size: int = 3, percent: int = 85, rows: int = 6) -> DataFrame:
    """One row per document row: doc_id, n_shingles, component_id, kept.

    Documents are linked if 100 x common shingles >= percent x united ones; component_id is the smallest doc_id reachable.
    ``kept`` holds for the document whose id that is. Null or empty text and text without words: an empty set, linked with nothing,
    kept. Fewer words than ``size``: the whole sequence is the one shingle. Repeated rows share a component (and, with
    one id, are all kept). Null id: linked like others; it names a component only if no id is known there.
    """
    bands = bands_for(percent / 100, rows)
    sets = _sets(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text"), size, "set")
    marked = stored(sets.mapInArrow(_sketcher(bands, rows), "doc_id long, text_hash long, n_shingles long, node long, bands array<long>"), "minhash")
    full = marked.where(F.col("n_shingles") > 0)
    # Equal sets have equal numbers; two different sets share a 64-bit number with odds of 2^-64.
    classes = stored(full.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.min(_row_key("text_hash")).alias("holder"), F.first("bands").alias("bands")), "minhash-classes")
    placed = classes.select(F.explode("bands").alias("band"), "node")
    shared = placed.groupBy("band").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    buckets = stored(placed.join(shared, "band"), "minhash-buckets")
    # The text that others were made from shares buckets with more classes than its copies do: it makes the best centre.
    ranks = stored(buckets.groupBy("node").agg(F.sum("_n").alias("rank")), "minhash-ranks")
    best = F.max(F.struct("rank", "node"))["node"].alias("a")
    centres = buckets.join(ranks, "node").groupBy("band").agg(best)
    stars = stored(buckets.join(centres, "band").where(F.col("node") != F.col("a")).select("band", "a", F.col("node").alias("b")), "minhash-stars")
    texts = _texts(docs, classes, ranks.select("node"))  # later rounds pair the same classes
    checked = stored(_confirmed(stars.select("a", "b").distinct(), texts, size, percent), "minhash-checked")
    roots = stored(components(checked.where("linked").select(F.col("a").alias("u"), F.col("b").alias("v"))), "minhash-roots")
    open_ = stored(_open_nodes(stars.join(checked, ["a", "b"]), roots), "minhash-open")
    if not open_.isEmpty():
        keyed, done, turn = stored(prefix_keys(texts.join(open_, "node"), size, percent), "minhash-keys"), 0, 0
        while True:
            turn, pairs = turn + 1, stored(_key_pairs(keyed, roots, checked, percent, done, done + 4**turn), "minhash-pairs")
            if pairs.isEmpty() and not _still_open(keyed, roots, done + 4**turn):
                break
            done += 4**turn
            found = stored(_confirmed(pairs, texts, size, percent), "minhash-found")
            checked = checked.union(found)
            linked = found.where("linked").select(F.col("a").alias("u"), F.col("b").alias("v"))
            if not linked.isEmpty():
                roots = stored(_merged(roots, linked), "minhash-roots")

    named = _rooted(classes.select("node", "first_id"), "node", roots, "root")
    firsts = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_node = named.join(firsts, "root").select("node", "component_id")
    found = full.select("doc_id", "text_hash", "n_shingles", "node").join(of_node, "node").drop("node")
    alone = marked.where(F.col("n_shingles") == 0).select("doc_id", "text_hash", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _row_key(text_hash: str):
    return F.xxhash64("doc_id", text_hash)


def _texts(docs: DataFrame, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text) of the classes in a bucket with others, the text of one row of each, as a table bucketed by node.

    Rounds join it by node without shuffling it. The rows wanted are broadcast if they are at most BROADCAST_ROWS
    pairs of numbers, else joined by shuffle.
    """
    spark = docs.sparkSession
    holders = stored(nodes.join(classes.select("node", "holder"), "node"), "minhash-holders")
    wanted = F.broadcast(holders) if holders.count() <= BROADCAST_ROWS else holders
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").select(_row_key("text_hash").alias("holder"), "text")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = rows.join(wanted, "holder").select("node", "text").repartition(n, "node").dropDuplicates(["node"])
    name = f"minhash_texts_{uuid.uuid4().hex}"
    found.write.bucketBy(n, "node").option("path", fresh_path(spark, "minhash-texts")).saveAsTable(name)
    return spark.table(name)


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The roots after more links: only the links between components are worked through."""
    between = _rooted(_rooted(links, "u", roots, "ru"), "v", roots, "rv").where(F.col("ru") != F.col("rv"))
    moved = components(between.select(F.col("ru").alias("u"), F.col("rv").alias("v")))
    known = roots.union(moved.select("node", F.col("node").alias("root")).join(roots.select("node"), "node", "left_anti"))
    return _rooted(known, "root", moved, "to").select("node", F.col("to").alias("root"))


def _open_nodes(judged: DataFrame, roots: DataFrame) -> DataFrame:
    """(node,): the members of buckets that the first stars (band, a, b, linked, near) leave open, but for their centres.

    A centre has met all others. Of those not linked with it, two components are to be compared, and a near one of another component with all that are linked.
    """
    rows = _rooted(_rooted(judged, "a", roots, "ra"), "b", roots, "rb")
    stranger = F.col("ra") != F.col("rb")
    state = rows.groupBy("band").agg(
        F.min(F.when(~F.col("linked"), F.col("rb"))).alias("_low"), F.max(F.when(~F.col("linked"), F.col("rb"))).alias("_high"),
        F.max(~F.col("linked") & F.col("near") & stranger).alias("_near"), F.max("linked").alias("_any"),
    )
    apart, crossing = F.coalesce(F.col("_low") != F.col("_high"), F.lit(False)), F.col("_near") & F.col("_any")
    state = state.withColumns({"_apart": apart, "_crossing": crossing}).where("_apart OR _crossing").select("band", "_apart", "_crossing")
    held = rows.join(state, "band").where(F.when(F.col("linked"), F.col("_crossing")).otherwise(F.col("_apart") | (F.col("_crossing") & F.col("near"))))
    return held.select(F.col("b").alias("node")).distinct()


def _bucket(n):
    return F.floor(F.log(n.cast("double")) / math.log(SIZE_STEP)).cast("int")


def prefix_keys(texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(key, node, n, spot, place) of (node, text): two linked sets share a key; only keys of several nodes are kept, each with its nodes numbered from 1.

    A key is a shingle and the size classes of both sets. For a partner of at least m shingles a set of n gives its n - a + 1 rarest ones.
    """
    # The outer form: a plain explode adds a filter on the set's size, which would make the set again for every word.
    rows = _sets(texts.select("node", "text"), size, "_s").select("node", F.explode_outer("_s").alias("g"))
    frequency = rows.groupBy("g").agg(F.count(F.lit(1)).alias("df"))
    ordered = rows.join(frequency, "g").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("df", "g"))).alias("_s"))  # a text's own shingles
    low, high = F.ceil(F.col("n") * percent / 100 - 1e-9), F.floor(F.col("n") * 100 / percent + 1e-9)
    wide = ordered.withColumn("n", F.size("_s")).select("node", "_s", "n", _bucket(F.col("n")).alias("_own"), F.explode(F.sequence(_bucket(F.greatest(low, F.lit(1))), _bucket(high))).alias("_other"))
    least = F.ceil(F.pow(F.lit(SIZE_STEP), F.col("_other"))).cast("int")  # of the size class; one less where the logarithm rounds so
    partner = F.greatest(F.when(_bucket(F.greatest(least - 1, F.lit(1))) >= F.col("_other"), least - 1).otherwise(least), low.cast("int"), F.lit(1))
    first = F.least(F.greatest(_prefix(F.col("n"), partner, percent), F.lit(0)), F.col("n"))
    keys = wide.select("node", "n", "_own", "_other", F.posexplode(F.slice("_s", F.lit(1), first)["g"]).alias("spot", "g"))
    key = F.xxhash64("g", F.least("_own", "_other"), F.greatest("_own", "_other"))
    held = stored(keys.select(key.alias("key"), "node", "n", "spot"), "minhash-prefixes")
    several = held.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("key")
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("node"), "node"))
    return held.join(several, "key").withColumn("place", place)


def _prefix(n, m, percent: int):
    """How many of its rarest shingles a set of ``n`` gives for a partner of ``m``: with fewer common ones the two are not linked."""
    return n - F.ceil(percent * (n + m) / F.lit(100 + percent) - 1e-9).cast("int") + 1


def _left_of(keyed: DataFrame, roots: DataFrame, done: int) -> DataFrame:
    """(key, node, n, spot, place, root) of the keys whose nodes after the first ``done`` are of several components."""
    left = _rooted(keyed.where(F.col("place") > done), "node", roots, "root")
    several = left.groupBy("key").agg(F.min("root").alias("_low"), F.max("root").alias("_high")).where(F.col("_low") != F.col("_high")).select("key")
    return left.join(several, "key")


def _key_pairs(keyed: DataFrame, roots: DataFrame, checked: DataFrame, percent: int, done: int, until: int) -> DataFrame:
    """(a, b): pairs of different components in one key whose first is among places ``done`` + 1 to ``until``, unless they were tested before.

    Both must have the key within the prefix for the other's own size.
    """
    left = stored(_left_of(keyed, roots, done), "minhash-left")
    centres = left.where(F.col("place") <= until).select("key", F.col("node").alias("a"), F.col("place").alias("_first"), F.col("root").alias("_root"), F.col("n").alias("_m"), F.col("spot").alias("_spot"))
    within = (F.col("spot") < _prefix(F.col("n"), F.col("_m"), percent)) & (F.col("_spot") < _prefix(F.col("_m"), F.col("n"), percent))
    met = left.join(centres, "key").where((F.col("place") > F.col("_first")) & (F.col("root") != F.col("_root")) & within).select("a", F.col("node").alias("b"))
    once = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    tested = checked.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return once.join(tested, ["a", "b"], "left_anti")


def _still_open(keyed: DataFrame, roots: DataFrame, done: int) -> bool:
    return not _left_of(keyed, roots, done).isEmpty()


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80, rows: int = 5) -> DataFrame:
    """The rows of ``docs``, all columns, with one row of each component: that of the smallest doc_id.

    Of rows repeated with one id, the one with the smallest hash of its text stays. Rows without words all stay.
    """
    linked = stored(link(docs, size, percent, rows).where(F.col("n_shingles") > 0), "minhash-linked")
    per_id = linked.where("kept").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.min("text_hash").alias("keep"))
    again = per_id.where(F.col("n") > 1).select(F.col("doc_id").alias("id"), "keep")
    dropped = linked.where(~F.col("kept")).select("doc_id", "text_hash").union(linked.where("kept").join(again, F.col("doc_id").eqNullSafe(F.col("id"))).select("doc_id", "text_hash"))
    gone = dropped.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).distinct()
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))  # so that no column of the input has a name of ours
    same = F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("row.text") == F.col("hash"))
    one = whole.join(again.withColumnRenamed("keep", "hash"), same, "left_semi").withColumn("id", F.col("row.doc_id")).dropDuplicates(["id"]).select("row")
    return whole.join(gone, same, "left_anti").unionByName(one).select("row.*")
