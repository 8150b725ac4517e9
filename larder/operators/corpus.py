"""Corpus build: harmonise sources, union, deduplicate, derive text and profile."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from larder import fixed
from larder.functions import text as tx


def numbered_columns(df: DataFrame, prefix: str) -> dict[int, str]:
    """Columns ``<prefix><n>`` by their number."""
    found = (re.fullmatch(rf"{re.escape(prefix)}(\d+)", c) for c in df.columns)
    return {int(m.group(1)): m.group(0) for m in found if m}


def joined_slots(ingredients: dict[int, Column], measures: dict[int, Column]) -> Column:
    """"measure name, measure name" from numbered slots, paired by number.

    Blank ingredients are dropped, a blank or absent measure is left out.
    """
    slots = []
    for n in sorted(ingredients):
        name = tx.trim_ws(tx.text_or_blank(ingredients[n]))
        measure = tx.trim_ws(tx.text_or_blank(measures[n])) if n in measures else F.lit("")
        part = F.when(measure != "", F.concat(measure, F.lit(" "), name)).otherwise(name)
        slots.append(F.when(name != "", part))
    return F.array_join(F.array_compact(F.array(*slots)), ", ") if slots else F.lit("")


def is_flat(df: DataFrame) -> bool:
    return "ingredients" in df.columns and "name" in df.columns


def is_wide(df: DataFrame) -> bool:
    return bool(numbered_columns(df, fixed.WIDE_INGREDIENT))


def keep_flat(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """An already flat source: the required and the known optional columns it has."""
    return df.select(*(keep or []), *[c for c in fixed.REQUIRED_COLUMNS + fixed.OPTIONAL_COLUMNS if c in df.columns])


def flatten_wide(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """A raw wide record: rename, and join the numbered slots into one string."""
    ingredients = numbered_columns(df, fixed.WIDE_INGREDIENT)
    measures = numbered_columns(df, fixed.WIDE_MEASURE)
    renamed = {new: F.col(old) for old, new in fixed.WIDE_COLUMNS.items() if old in df.columns}
    renamed |= {c: F.col(c) for c in fixed.REQUIRED_COLUMNS if c in df.columns and c not in renamed}
    renamed["ingredients"] = joined_slots(
        {n: F.col(c) for n, c in ingredients.items()}, {n: F.col(c) for n, c in measures.items()}
    )
    kept = [F.col(c) for c in keep or []]
    return df.select(*kept, *[renamed[c].alias(c) for c in fixed.REQUIRED_COLUMNS if c in renamed])


def harmonise(
    df: DataFrame, source: str | None = None, keep: list[str] | None = None, keep_extra: bool = False
) -> DataFrame:
    """Required columns from the first present candidate, ``""`` where there is none."""
    columns = [F.col(c) for c in keep or []]
    for name, candidates in fixed.COLUMN_CANDIDATES.items():
        found = next((c for c in candidates if c in df.columns), None)
        columns.append((F.col(found) if found else F.lit("")).alias(name))
    if keep_extra:
        columns += [F.col(c) for c in fixed.OPTIONAL_COLUMNS if c in df.columns and c != "source"]
    if source is not None:
        columns.append(F.lit(source).alias("source"))
    return df.select(*columns)


def normalise(df: DataFrame, source: str, keep: list[str] | None = None, keep_extra: bool = False) -> DataFrame:
    """Detect the layout of a source, then dispatch."""
    if not is_flat(df) and is_wide(df):
        return harmonise(flatten_wide(df, keep), source, keep)
    return harmonise(df, source, keep, keep_extra)


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """All rows of all sources; columns a source lacks are null. Order is kept as ``source_priority``."""
    tagged = [f.withColumn("source_priority", F.lit(i)) for i, f in enumerate(frames)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def keep_first(df: DataFrame, key: Column, order: list[str]) -> DataFrame:
    """One row per key: the first in ``order``, which must be unique within a key.

    Catalyst turns the rank filter into a WindowGroupLimit below the exchange, so
    a key that holds a third of all rows leaves each task as a single row.
    """
    window = Window.partitionBy("_key").orderBy(*order)
    ranked = df.withColumn("_key", key).withColumn("_place", F.row_number().over(window))
    return ranked.where("_place = 1").drop("_place", "_key")


def dedup_by_name(df: DataFrame, order: list[str], name: str = "name", keep_unnamed: bool = False) -> DataFrame:
    """One row per normalised name. Unnamed rows share one key unless ``keep_unnamed``."""
    key = tx.name_key(name)
    if keep_unnamed:
        key = F.when(key == "", F.concat(F.lit("\u0001"), F.to_json(F.struct(*order)))).otherwise(key)
    return keep_first(df, key, order)


def dedup_by_id(df: DataFrame, id_column: str, order: list[str]) -> DataFrame:
    return keep_first(df, F.col(id_column), order)


def add_search_text(df: DataFrame, column: str = "text_full") -> DataFrame:
    return df.withColumn(column, tx.search_text())


def add_profile(df: DataFrame, lexicon: dict[str, list[str]] = fixed.FLAVOR_LEXICON, text="ingredients") -> DataFrame:
    return df.withColumns({name: tx.lexicon_score(text, words) for name, words in lexicon.items()})


def profile_map(lexicon: dict[str, list[str]] = fixed.FLAVOR_LEXICON) -> Column:
    """Profile columns as one map."""
    pairs = [part for name in lexicon for part in (F.lit(name), F.col(name).cast("double"))]
    return F.create_map(*pairs)


def build_corpus(
    frames: list[DataFrame], order: list[str], lexicon: dict[str, list[str]] = fixed.FLAVOR_LEXICON
) -> DataFrame:
    """Union, deduplicate (first source wins), add search text and profile: one shuffle."""
    if not frames:
        raise ValueError("no source found")
    unique = dedup_by_name(union_sources(frames), ["source_priority", *order])
    return add_profile(add_search_text(unique), lexicon)


def seeded_sample(df: DataFrame, n: int, id_column: str, seed: int = fixed.CLUSTER_SEED) -> DataFrame:
    """``n`` rows in the order of a seeded hash: reproducible, without replacement."""
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_column).cast("string")))
    return df.orderBy(draw, id_column).limit(n)
