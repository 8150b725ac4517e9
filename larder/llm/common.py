"""Helpers shared by the training-data operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.session import fresh_path

# The word patterns of the query contracts.
WORD = r"[^\x20\x09-\x0D]+"
LETTERS_AND_DIGITS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def stored(df: DataFrame, label: str, file_rows: int = 0) -> DataFrame:
    """The rows written once below the shared folder and read back: lineage ends here, so a lost executor costs one task.

    A file has ``file_rows`` rows at most, if given: rows are read in batches, and large ones should not come by the thousand.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.option("maxRecordsPerFile", file_rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def filled(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    return F.translate(text, UPPER, LOWER)


def words(text: str | Column, pattern: str = WORD) -> Column:
    return F.regexp_extract_all(filled(text), F.lit(pattern), F.lit(0))


def id_bucket(column: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def total(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def ranked(df: DataFrame, order: list[Column], label: str) -> DataFrame:
    """Rows with ``rank`` from 0 in a global order, without a window over all rows.

    Rows are dealt out by range and numbered within their range; only one count per
    range meets in one task.
    """
    return with_running_total(df, order, F.lit(1), "rank", label)


def with_running_total(df: DataFrame, order: list[Column], value: Column, name: str, label: str) -> DataFrame:
    """Rows with ``name``: the sum of ``value`` over all rows before, in a global order."""
    dealt = stored(df.withColumn("_value", value.cast("long")).repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), label)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("_range").agg(F.sum("_value").alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        dealt.withColumn("_before", F.coalesce(F.sum("_value").over(within), F.lit(0)))
        .join(starts, "_range")
        .withColumn(name, F.col("_start") + F.col("_before"))
        .drop("_range", "_value", "_before", "_start")
    )
