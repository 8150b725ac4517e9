"""Language identification by nearest centroid.

A text is its letters, lower-cased, with one blank for whatever stands between: character
n-grams are hashed into a fixed number of slots, counted over the whole text, weighed by
log(1 + count) x idf and normalised. Each language has several centroids, found by spherical
k-means. The label is that of the centroid with the highest cosine.
A text farther from its centroid than nearly all texts it was learned from is ``rejected``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import stored

SLOTS = 4096
CENTROIDS = 4
FIT_ROWS = 500  # labelled texts of each language that the classifier is fitted on, chosen by hash among all
REJECT_QUANTILE, REJECT_SLACK = 0.99, 0.2
_PIECE = 1 << 16  # characters counted at a time
_TABLE: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether each code point is a letter; built once in each worker."""
    if not _TABLE:
        _TABLE.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000))
    return _TABLE[0]


def slot_counts(text: str | None) -> np.ndarray | None:
    """Counts of hashed 2- and 3-grams of the whole text; None without letters."""
    if not text:
        return None
    counts, carried, seen = np.zeros(SLOTS, dtype=np.float32), np.array([32], dtype=np.int64), False
    lowered = text.lower()
    for i in range(0, len(lowered), _PIECE):
        points = np.frombuffer(lowered[i : i + _PIECE].encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        is_letter = _letters()[points]
        seen = seen or bool(is_letter.any())
        points = np.concatenate([carried, np.where(is_letter, points, 32)])
        blank = points == 32
        keep = np.ones(len(points), dtype=bool)
        keep[1:] = ~(blank[1:] & blank[:-1])
        points = points[keep]
        a, b, c = points[:-2], points[1:-1], points[2:]
        if len(points) > 2:
            counts += np.bincount((a * 0x9E3779B1 + b * 0x85EBCA6B + c * 0xC2B2AE35 >> 7) % SLOTS, minlength=SLOTS)
        pairs = points[len(carried) - 1 :]  # the piece before has counted what it carried over
        if len(pairs) > 1:
            counts += np.bincount((pairs[:-1] * 0x27D4EB2F + pairs[1:] * 0x165667B1 >> 5) % SLOTS, minlength=SLOTS)
        carried = points[-2:]
    return counts if seen else None


def _normalised(matrix: np.ndarray) -> np.ndarray:
    return matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)


def fit(labelled: DataFrame, centroids: int = CENTROIDS, fit_rows: int = FIT_ROWS) -> dict:
    """The model from rows (doc_id, text, lang): languages, idf, centroids and rejection distances.

    At most ``fit_rows`` texts of each language are used, the ones with the smallest hash of id and text. Null labels
    and texts without letters teach nothing; a language with fewer texts than centroids has fewer centroids.
    """
    known = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", "text", F.xxhash64("doc_id", "text").alias("_h"))
    # Only about four times as many as wanted go to the ranking, whatever the number of rows and tasks.
    sizes = labelled.where(F.col("lang").isNotNull()).groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()  # a row for each language, as in the model
    share = F.coalesce(*[F.when(F.col("lang") == r["lang"], F.lit(min(1.0, 4.0 * fit_rows / r["n"]))) for r in sizes], F.lit(0.0))
    known = known.where(F.pmod("_h", F.lit(1 << 40)) < share * (1 << 40))
    chosen = known.withColumn("_n", F.row_number().over(Window.partitionBy("lang").orderBy("_h"))).where(F.col("_n") <= fit_rows).select("lang", "text", "_h")
    chosen = stored(chosen, "language-sample")

    def document_frequency(pdf: pd.DataFrame) -> pd.DataFrame:
        found = np.zeros(SLOTS)
        for text in pdf["text"]:
            counts = slot_counts(text)
            if counts is not None:
                found += counts > 0
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "n": [len(pdf)], "df": [found.tolist()]})

    per_language = chosen.groupBy("lang").applyInPandas(document_frequency, "lang string, n long, df array<double>").toPandas()
    if per_language.empty:
        return {"langs": [], "idf": np.ones(SLOTS, dtype=np.float32), "centres": np.zeros((0, SLOTS), dtype=np.float32), "far": np.zeros(0)}
    n, df = per_language["n"].sum(), np.sum([np.array(x) for x in per_language["df"]], axis=0)
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)

    def cluster(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_h")
        vectors = [c for c in map(slot_counts, pdf["text"]) if c is not None]
        if not vectors:
            return pd.DataFrame({"lang": [], "centre": [], "far": []})
        rows = _normalised(np.log1p(np.array(vectors)) * idf)
        centres = rows[:1]
        while len(centres) < min(centroids, len(rows)):  # farthest first
            centres = np.vstack([centres, rows[np.argmin((rows @ centres.T).max(axis=1))]])
        for _ in range(10):
            nearest = (rows @ centres.T).argmax(axis=1)
            centres = _normalised(np.array([rows[nearest == k].mean(axis=0) if (nearest == k).any() else centres[k] for k in range(len(centres))]))
        near = rows @ centres.T
        nearest = near.argmax(axis=1)
        far = [1 - np.quantile(near[nearest == k, k], 1 - REJECT_QUANTILE) + REJECT_SLACK if (nearest == k).any() else REJECT_SLACK for k in range(len(centres))]
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "centre": centres.astype(float).tolist(), "far": far})

    found = chosen.groupBy("lang").applyInPandas(cluster, "lang string, centre array<double>, far double").toPandas()
    found = found.sort_values("lang", kind="stable")
    return {"langs": found["lang"].tolist(), "idf": idf, "centres": np.array(found["centre"].tolist(), dtype=np.float32).reshape(-1, SLOTS), "far": found["far"].to_numpy()}


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, lang_pred, score (cosine with the nearest centroid, 0 to 1), rejected for every row.

    Null text, a text without letters or a model without languages: ``und``, score 0, rejected. Ties go to the first language in order.
    Only the text is read; repeated rows give repeated rows.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # slots x centroids x languages numbers

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                some = batch.slice(i, 256)
                counts = [slot_counts(t) for t in some.column("text").to_pylist()]
                at = [j for j, c in enumerate(counts) if c is not None and m["langs"]]
                langs, scores, rejected = ["und"] * len(counts), [0.0] * len(counts), [True] * len(counts)
                if at:
                    cosines = _normalised(np.log1p(np.array([counts[j] for j in at])) * m["idf"]) @ m["centres"].T
                    best = cosines.argmax(axis=1)
                    for j, k, s in zip(at, best.tolist(), cosines[np.arange(len(at)), best].tolist()):
                        langs[j], scores[j], rejected[j] = m["langs"][k], min(max(s, 0.0), 1.0), bool(1 - s > m["far"][k])
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), pa.array(langs), pa.array(scores, pa.float64()), pa.array(rejected)], names=["doc_id", "lang_pred", "score", "rejected"])

    return docs.select("doc_id", "text").mapInArrow(label, "doc_id long, lang_pred string, score double, rejected boolean")
