"""Readers: dataset files, extra drops, payload dumps, the source cascade."""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from larder import fixed
from larder.functions import text as tx
from larder.operators import corpus

log = logging.getLogger(__name__)

# Texts that a CSV cell may hold for "missing".
NA_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes below a path, 0 when it does not exist. Only the listing is read."""
    try:
        row = spark.read.format("binaryFile").load(path).agg(F.sum("length").alias("n")).first()
    except AnalysisException:
        return 0
    return row.n or 0


def csv_layouts(spark: SparkSession, path: str) -> list[tuple[bool, list[str]]]:
    """The files below a path in groups of one header line and of whether a quoted value goes over several lines.

    One pass over the lines with a partial aggregate: one row per file is left, and one per layout comes to the driver.
    """
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2 == 1
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), place.alias("place"), odd.alias("odd"))
    files = lines.groupBy("file").agg(F.min_by("value", "place").alias("header"), F.max("odd").alias("broken"))
    groups = files.groupBy("header", "broken").agg(F.array_sort(F.collect_list("file")).alias("files")).collect()
    return sorted(((r["broken"], r["files"]) for r in groups), key=lambda g: g[1][0])


def read_csv(spark: SparkSession, path: str, malformed: bool = False) -> DataFrame:
    """All-string CSV with headers, and ``row_id``. Every file is read by its own header; columns a file lacks are null.

    Short lines are padded, lines with more fields than their header dropped; ``malformed`` gives only those, to be counted.
    Files are split among tasks, except those with line breaks inside quotes: such a file is read by one task.
    """
    tables = []
    for broken, files in csv_layouts(spark, path):
        reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", broken)
        names = reader.csv(files).columns
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "_overflow"]])
        rows = reader.schema(schema).option("mode", "PERMISSIVE").option("enforceSchema", True).csv(files)
        place = F.struct(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("row"))
        wanted = F.col("_overflow").isNotNull() if malformed else F.col("_overflow").isNull()
        placed = rows.withColumn("row_id", place).where(wanted)
        tables.append(placed.select(*[F.when(~F.col(c).isin(NA_TEXTS), F.col(c)).alias(c) for c in names], "row_id"))
    if not tables:
        raise ValueError(f"no CSV file with a header below {path}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet with ``row_id``, the place of a row in its source: file, then row in the file."""
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return spark.read.parquet(path).withColumn("row_id", place)


def read_dataset(spark: SparkSession, base: str, stem: str) -> DataFrame | None:
    """``<stem>.parquet``, else ``<stem>.csv``, with ``row_id``; empty or unreadable files count as absent, small ones are data."""
    for extension, read in (("parquet", read_parquet), ("csv", read_csv)):
        path = f"{base}/{stem}.{extension}"
        if not stored_bytes(spark, path):
            continue
        try:
            return read(spark, path)
        except Exception as error:  # a broken footer surfaces as a bare Java error
            log.warning("skipped %s: %s", path, error)
    return None


def discover_extras(spark: SparkSession, base: str, prefix: str = fixed.EXTRA_PREFIX) -> list[DataFrame]:
    """Every ``<prefix>*.parquet``, normalised and tagged with its stem; bad files are skipped."""
    try:
        listed = spark.read.format("binaryFile").load(f"{base}/{prefix}*.parquet").select("path")
    except AnalysisException:
        return []
    # One row per extra source, not per row of data; a folder counts once.
    stem = F.regexp_extract("path", rf"({prefix}[^/]*)\.parquet", 1)
    stems = [r[0] for r in listed.select(stem).distinct().collect()]
    frames = []
    for name in sorted(stems):
        try:
            frames.append(corpus.normalise(read_parquet(spark, f"{base}/{name}.parquet"), name, keep=["row_id"]))
        except Exception as error:  # a broken footer surfaces as a bare Java error
            log.warning("skipped extra %s: %s", name, error)
    return frames


def source_frames(spark: SparkSession, base: str) -> list[DataFrame]:
    """Sources in priority order: merged, else main and second; extras always."""
    frames: list[DataFrame] = []
    merged = read_dataset(spark, base, fixed.MERGED_STEM)
    if merged is not None:
        frames.append(corpus.normalise(merged, fixed.MERGED_TAG, keep=["row_id"], keep_extra=True))
    else:
        main = next((d for d in (read_dataset(spark, base, s) for s in fixed.MAIN_STEMS) if d is not None), None)
        if main is not None:
            flat = corpus.is_flat(main)
            frames.append(corpus.keep_flat(main, ["row_id"]) if flat else corpus.flatten_wide(main, ["row_id"]))
        for stem, tag in fixed.SECOND_STEMS.items():
            second = read_dataset(spark, base, stem)
            if second is not None:
                frames.append(corpus.normalise(second, tag, keep=["row_id"]))
                break
    return frames + discover_extras(spark, base)


def load_corpus(spark: SparkSession, base: str, lexicon: dict[str, list[str]] = fixed.FLAVOR_LEXICON) -> DataFrame:
    """The whole corpus below a folder; raises when no source is there."""
    return corpus.build_corpus(source_frames(spark, base), ["row_id"], lexicon)


def payload_schema() -> T.StructType:
    """Records as maps, so that a record may have any number of slots."""
    return T.StructType([T.StructField(fixed.PAYLOAD_ARRAY, T.ArrayType(T.MapType(T.StringType(), T.StringType())))])


def payload_columns(record: str) -> list[Column]:
    """Flat columns of one payload record; texts are trimmed, null becomes blank."""
    columns = []
    for name, key in fixed.PAYLOAD_FIELDS.items():
        value = tx.text_or_blank(F.try_element_at(record, F.lit(key)))
        columns.append((value if name == "id" else tx.trim_ws(value)).alias(name))
        if name == "glass":
            columns.append(payload_slots(F.col(record)).alias("ingredients"))
    return [*columns, F.lit(fixed.PAYLOAD_SOURCE).alias("source")]


def payload_slots(record: Column) -> Column:
    """"measure name, measure name" from the numbered slots of a record, paired and ordered by number."""
    number = rf"^{fixed.WIDE_INGREDIENT}([0-9]+)$"
    named = F.filter(F.map_entries(record), lambda e: e["key"].rlike(number))
    slots = F.array_sort(F.transform(named, lambda e: F.struct(F.regexp_extract(e["key"], number, 1).cast("int").alias("n"), tx.trim_ws(tx.text_or_blank(e["value"])).alias("name"))))

    def line(slot: Column) -> Column:
        measure = tx.trim_ws(tx.text_or_blank(F.try_element_at(record, F.concat(F.lit(fixed.WIDE_MEASURE), slot["n"].cast("string")))))
        return F.when(measure != "", F.concat(measure, F.lit(" "), slot["name"])).otherwise(slot["name"])

    return F.array_join(F.transform(F.filter(slots, lambda s: s["name"] != ""), line), ", ")


def parse_payload(df: DataFrame, json_column: str, keep: list[str] | None = None) -> DataFrame:
    """Payload texts ``{"drinks": [...] | null}`` to one flat row per record."""
    parsed = df.select(*(keep or []), F.from_json(json_column, payload_schema()).alias("_payload"))
    records = parsed.select(*(keep or []), F.explode(f"_payload.{fixed.PAYLOAD_ARRAY}").alias("_record"))
    return records.select(*(keep or []), *payload_columns("_record"))


def read_payload(spark: SparkSession, path: str) -> DataFrame:
    """Payload dumps: one JSON document per file; a folder of files is as many tasks."""
    return parse_payload(spark.read.text(path, wholetext=True), "value")
