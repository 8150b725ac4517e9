"""Corpus pipeline: documents to token files in five stages.

Each stage takes (spark, docs, folder) and returns a DataFrame that is written as Parquet and read again as the
next one's docs. All but the last return the columns of documents. Every stage works on all rows that the one
before has kept; null and empty texts, repeated rows and extra columns are treated as its operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import decontamination, mixing, near_duplicates, outliers, token_files
from larder.llm.common import stored, words
from larder.session import ship_package

WEIGHTS = (5.0, 2.0, 1.0)  # of the sources in order, in turn


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that fail the base rules or are outliers of their language and source go."""
    return outliers.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group stays, that of the smallest id: five-word shingles, similarity 0.8 or more."""
    ship_package(spark)
    return near_duplicates.keep_one(docs, size=5, percent=80, rows=5)


def decontaminate(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold a window of the benchmark go."""
    ship_package(spark)
    return decontamination.without_hits(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The mix of the sources: a row for each pass that a document takes part in, its text cut to the picked blocks."""
    own = ("doc_id", "source", "text")
    others = [F.col(f"`{c}`") for c in docs.columns if c not in own]
    row = F.struct(*others) if others else F.lit(None).cast("struct<none:int>")  # apart, so that no column of the input has a name of the mix
    mixed = mixing.mix(docs.select(*own, row.alias("row"), F.size(words("text")).cast("long").alias(mixing.SIZE)), WEIGHTS, size=mixing.SIZE)
    texts = mixing.mixed_texts(mixed, size=mixing.SIZE)
    made = {"n_chars": lambda: F.length("text").cast(docs.schema["n_chars"].dataType), **{c: (lambda c=c: F.col(c)) for c in own}}
    return texts.select(*[(made[c]() if c in made else F.col("row").getField(c)).alias(c) for c in docs.columns])


def write_tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The token files, and what is read back from them."""
    ship_package(spark)
    return token_files.read_documents(spark, token_files.write_segments(docs))


STAGES = [("quality", quality), ("near_duplicates", near_dedup), ("decontamination", decontaminate), ("mixing", mix), ("token_files", write_tokens)]
ORACLE_SQL = None  # similarity, picked blocks and tokens are beyond SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
    return docs
