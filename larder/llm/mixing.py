"""Mix sources to target weights: Sainte-Laguë block quotas, then seeded blocks.

Every source gets a target number of words. Blocks of equal size are allocated to the
sources by the highest quotients target / (2k + 1), and each source's blocks to its shards
in the same way. Within a shard the documents, in seeded order, are one stream of words cut
into blocks; a seeded permutation picks the quota. A block is picked at most ``max_repeat`` times.

A shard holds a bounded number of words, so a source with a third of all rows is many shards.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import WORD, filled, ranked, stored

BLOCK = 16  # words; a source misses its target by about half a block for each of its shards at most
SHARD_WORDS = 1_000_000
MOST_SHARDS = 100_000  # of all sources; beyond it shards get larger, so that quotas stay a small table
ADDED = ["source_size", "target", "taken", "passes", "picked"]
SIZE = "_mix_size"  # a name for the words of a row where the table may have a column ``size``
PRIME = 1_000_000_007  # larger than the blocks of a shard, so k -> k * PRIME + c is a permutation of them


def cycled_weights(sources: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """(source, weight): the sources by code point, null last, take the weights in turn."""
    ordered = ranked(sources, [F.col("source").isNull(), F.col("source")], "mix-sources")
    return ordered.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))).drop("rank")


def with_targets(sources: DataFrame, ratio: float, max_repeat: int) -> DataFrame:
    """Adds ``target``: shares of ``ratio`` x all words by weight, capped at ``max_repeat`` x the source's size.

    What is above a cap is shared again by weight until no source is above. Each round is one
    aggregate over one row per source; a source that has reached its cap stays there, so it ends.
    """
    cap, weight = F.col("source_size") * float(max_repeat), F.col("weight")
    words, weights, most = sources.agg(F.sum("source_size"), F.sum(F.when(F.col("source_size") > 0, weight)), F.sum(cap)).first()
    asked = min(ratio * (words or 0), most or 0.0)
    level, pinned = (asked / weights if weights else 0.0), -1
    while True:
        above = (weight * level > cap) & (F.col("source_size") > 0)
        n, held, left = sources.agg(F.sum(above.cast("long")), F.sum(F.when(above, cap)), F.sum(F.when(~above & (F.col("source_size") > 0), weight))).first()
        if (n or 0) == pinned or not left:
            break
        pinned, level = n or 0, max(level, (asked - (held or 0.0)) / left)
    return sources.withColumn("target", F.when(F.col("source_size") > 0, F.least(cap, weight * F.lit(level))).otherwise(0.0))


def apportioned(parts: DataFrame, group: list[str], weight: str, seats: str, tie: list[str], name: str) -> DataFrame:
    """Adds ``name``: the ``seats`` of each group given to its parts by the highest quotients weight / (2k + 1).

    With P parts, a part of share s of N seats gets between s (N - P/2) - 1/2 and s (N + P/2) + 1/2 of
    them. The lower bound is given at once; only the quotients up to the upper one, some three for each part, are
    ranked for the seats that are left. Ties go by ``tie``. Parts of no weight get none.
    """
    by = Window.partitionBy(*(group or [F.lit(0)]))  # without a group: one row per source, as many as weights were stated
    share = F.try_divide(F.col(weight).cast("double"), F.sum(F.col(weight).cast("double")).over(by))
    slack = F.count(F.lit(1)).over(by) / 2
    bounded = (
        parts.withColumn("_low", F.greatest(F.floor(F.coalesce(share, F.lit(0.0)) * (F.col(seats) - slack) - 0.5), F.lit(0)))
        .withColumn("_high", F.floor(F.coalesce(share, F.lit(0.0)) * (F.col(seats) + slack) + 0.5))
        .withColumn("_left", F.col(seats) - F.sum("_low").over(by))
    )
    kth = F.explode(F.sequence(F.col("_low") + 1, F.col("_high"))).alias("_k")
    tied = list(dict.fromkeys([*group, *tie]))
    asking = bounded.where((F.col(weight) > 0) & (F.col("_high") > F.col("_low"))).select(*tied, F.col(weight).cast("double").alias("_w"), "_left", kth)
    best = Window.partitionBy(*(group or [F.lit(0)])).orderBy((F.col("_w") / (2 * F.col("_k") - 1)).desc(), *tie, "_k")
    won = asking.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= F.col("_left")).groupBy(*tied).agg(F.count(F.lit(1)).alias("_won"))
    won = won.select(*[F.col(c).alias(f"_won_{c}") for c in tied], "_won")
    on = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_won_{c}")) for c in tied])
    return bounded.join(won, on, "left").select(*parts.columns, (F.col("_low") + F.coalesce("_won", F.lit(0))).alias(name))


def mix(docs: DataFrame, weights: tuple[float, ...] | DataFrame, ratio: float = 1.5, max_repeat: int = 2, block: int = BLOCK, seed: int = 1, size: str = "size") -> DataFrame:
    """The rows (columns ``doc_id``, ``source``, the words in ``size`` and any others, kept) with their place in the mix.

    Adds source_size, target (of the source), taken (words of the row in the mix, repeats
    counted), ``passes`` (times the whole row is in) and ``picked`` (word ranges [from, to) that
    are in once more). ``weights`` is a table (source, weight), or a tuple that the sources take in turn.

    Null source: a source of its own. Null or zero size: taken 0. Repeated rows: each is taken by
    itself. Empty table: no rows. The same rows and seed give the same mix however they are partitioned.
    """
    rows = docs.drop(*ADDED).select(F.struct("*").alias("_row"), "doc_id", "source", F.coalesce(F.col(size), F.lit(0)).cast("long").alias("size"))
    sources = stored(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sizes")
    weighted = cycled_weights(sources, weights) if isinstance(weights, tuple) else sources.join(weights.select(F.col("source").alias("_s"), "weight"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    sources = stored(with_targets(stored(weighted, "mix-weights"), ratio, max_repeat), "mix-targets")
    asked, words = sources.agg(F.sum("target"), F.sum("source_size")).first()
    per_shard = max(SHARD_WORDS, (words or 0) // MOST_SHARDS)
    sources = sources.withColumn("_blocks", F.lit(round((asked or 0.0) / block))).withColumn("shards", F.greatest(F.ceil(F.col("source_size") / per_shard), F.lit(1)).cast("long"))
    sources = stored(apportioned(sources, [], "target", "_blocks", ["source"], "quota").drop("_blocks"), "mix-quotas")

    of_source = rows.join(sources.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    dealt = of_source.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(seed)), "shards"))
    shards = dealt.groupBy("source", "shard").agg(F.sum("size").alias("words"), F.first("quota").alias("quota"))
    shards = stored(apportioned(stored(shards, "mix-shards"), ["source"], "words", "quota", ["source", "shard"], "n"), "mix-shard-quotas")
    blocks = F.greatest(F.round(F.col("words") / block), F.lit(1)).cast("long")
    shards = shards.select(F.col("source").alias("_s"), F.col("shard").alias("_h"), "words", blocks.alias("blocks"), F.greatest(F.least("n", blocks * max_repeat), F.lit(0)).alias("n"))

    order = Window.partitionBy("source", "shard").orderBy(F.xxhash64("doc_id", F.lit(seed + 1)), "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("start", F.coalesce(F.sum("size").over(order), F.lit(0)))
    joined = placed.join(shards, F.col("source").eqNullSafe(F.col("_s")) & (F.col("shard") == F.col("_h")))
    return (
        joined.withColumn("passes", whole_part(F.col("n"), F.col("blocks")).cast("int"))
        .withColumn("picked", _picked(seed))
        .withColumn("taken", F.col("size") * F.col("passes") + F.aggregate("picked", F.lit(0).cast("long"), lambda a, r: a + r["to"] - r["from"]))
        .select("_row.*", *ADDED)
    )


def whole_part(a: Column, b: Column) -> Column:
    """Integer division of longs; dividing them directly would go through doubles."""
    return ((a - F.pmod(a, b)) / b).cast("long")


def _picked(seed: int) -> Column:
    """Word ranges of the row that lie in the blocks picked once more than ``passes`` times.

    Block k of a shard covers its words from k * words / blocks on; k is picked if its place in
    the seeded permutation is below the quota's remainder.
    """
    start, size, words, blocks = F.col("start"), F.col("size"), F.col("words"), F.col("blocks")
    shift = F.pmod(F.xxhash64("source", "shard", F.lit(seed)), blocks)

    def block_of(word: Column) -> Column:
        return whole_part((word + 1) * blocks - 1, words)

    def begin(k: Column) -> Column:
        return whole_part(k * words, blocks)

    inside = F.filter(
        F.sequence(block_of(start), block_of(start + size - 1)),
        lambda k: (F.pmod(k * PRIME + shift, blocks) < F.col("n") % blocks) & (F.least(begin(k + 1), start + size) > F.greatest(begin(k), start)),
    )
    ranges = F.transform(inside, lambda k: F.struct((F.greatest(begin(k), start) - start).alias("from"), (F.least(begin(k + 1), start + size) - start).alias("to")))
    return F.when((size > 0) & (F.col("n") % blocks > 0), ranges).otherwise(F.array().cast("array<struct<from:bigint,to:bigint>>"))


def mixed_texts(mixed: DataFrame, size: str = "size") -> DataFrame:
    """One row for each pass that a row of ``mix`` takes part in, ``text`` cut to the picked blocks.

    A row taken whole twice is two rows; a row not taken is none. Other columns are kept.
    """
    pieces = F.regexp_extract_all(filled("text"), F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    # As an element of an array the pieces are made once; named in the inner lambda they would be made for every range.
    both = F.array(F.struct(pieces.alias("pieces"), F.col("picked").alias("ranges")))
    cut = F.transform(both, lambda b: F.array_join(F.flatten(F.transform(b["ranges"], lambda r: F.slice(b["pieces"], (r["from"] + 1).cast("int"), (r["to"] - r["from"]).cast("int")))), ""))[0]
    whole = mixed.where(F.col("passes") > 0).withColumn("_pass", F.explode(F.sequence(F.lit(1), F.col("passes")))).drop("_pass").where(F.col(size) > 0)
    part = mixed.where(F.size("picked") > 0).withColumn("text", cut)
    return whole.unionByName(part)
