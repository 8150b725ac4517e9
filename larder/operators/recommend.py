"""Recommendation over an item index, for tables of requests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from larder import fixed
from larder.functions import text as tx
from larder.functions.vector import hashed_embedder
from larder.operators import corpus
from larder.operators.cache import through_cache
from larder.operators.similarity import Scoring, top_k

Embedder = Callable[[Column | str], Column]


def embed(df: DataFrame, text: str, embedder: Embedder | None = None, target: str = "embedding") -> DataFrame:
    """Add the unit vector of a text column. The default embedder needs no model."""
    return df.withColumn(target, (embedder or hashed_embedder())(tx.text_or_blank(text)))


def embed_cached(df: DataFrame, text: str, model: str, encode, cache_path: str, target: str = "embedding") -> DataFrame:
    """Add vectors from a plug-in model, called once per distinct text not in the cache.

    ``encode`` maps an iterator of pandas frames ``(key, payload)`` to frames
    ``(key, value)`` with ``value`` a list of floats.
    """
    keyed = df.withColumn("_key", tx.content_key(F.lit(model), text))
    hits = through_cache(keyed, "_key", text, encode, "array<float>", cache_path)
    return hits.withColumnRenamed("value", target).drop("_key", "cached")


def build_index(items: DataFrame, text: str = "text_full", embedder: Embedder | None = None, keep: list[str] | None = None) -> DataFrame:
    """The item index: key, vector and the columns a request may filter on."""
    if text not in items.columns:
        raise ValueError(f"column '{text}' is missing")
    kept = ["item_id", *(keep if keep is not None else [c for c in ("category", "ingredients") if c in items.columns])]
    return embed(items, text, embedder).select(*kept, "embedding")


def by_text(
    requests: DataFrame,
    index: DataFrame,
    k: int = fixed.TOP_K,
    *,
    text: str = "text",
    embedder: Embedder | None = None,
    category: str | None = None,
    category_column: str | None = None,
    mode: str = "strict",
    attach: DataFrame | None = None,
    **bounds,
) -> DataFrame:
    """Top ``k`` items per free-text request.

    ``category`` is one literal for all requests, ``category_column`` one per
    request (null: any). ``mode="strict"`` only returns items of the category;
    ``mode="mask"`` keeps the others with score -1, so they may fill up the ``k``.
    """
    if mode not in ("strict", "mask"):
        raise ValueError("mode is 'strict' or 'mask'")
    if category is not None and mode == "strict":
        index = index.where(F.lower("category") == category.lower())  # reaches the scan
    elif category is not None:
        requests = requests.withColumn("_category", F.lit(category))
        category_column = "_category"
    vectors = embed(requests, text, embedder)
    scoring = Scoring(category=category_column, mask=mode == "mask")
    return top_k(vectors, index, k, scoring, attach=attach, **bounds)


def by_ingredients(
    requests: DataFrame,
    index: DataFrame,
    k: int = fixed.TOP_K,
    *,
    available: str = "available",
    required: str | None = None,
    embedder: Embedder | None = None,
    weights: tuple[float, float] = (fixed.SEMANTIC_WEIGHT, fixed.COVERAGE_WEIGHT),
    mode: str = "strict",
    attach: DataFrame | None = None,
    **bounds,
) -> DataFrame:
    """Top ``k`` by a weighted sum of similarity and coverage of the available list.

    Items without every required substring are left out (``strict``) or get -1 (``mask``).
    """
    if mode not in ("strict", "mask"):
        raise ValueError("mode is 'strict' or 'mask'")
    asked = requests.withColumn("_request", tx.ingredient_request(available))
    scoring = Scoring(available=available, required=required, weights=weights, mask=mode == "mask")
    return top_k(embed(asked, "_request", embedder), index, k, scoring, attach=attach, **bounds)


def recommendation(lexicon: dict[str, list[str]] = fixed.FLAVOR_LEXICON) -> list[Column]:
    """Columns of a published recommendation, profile as a map."""
    return [
        F.col("query_id"), F.col("rank"), F.col("item_id"), F.col("name"), F.col("category"),
        F.col("ingredients"), F.col("instructions"), F.col("score").alias("similarity_score"),
        corpus.profile_map(lexicon).alias("flavor_profile"),
    ]
