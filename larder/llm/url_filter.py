"""URL filters: stated rules, and gradient-boosted trees on lexical features for what no rule decides.

Urls that a rule decides are the labelled ones. All of them make the suffix statistics, and a bounded sample of
their distinct urls fits the trees; every url is then scored. All features are built-in expressions of the url's text.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import filled, lower_ascii, stored, total

FIT_ROWS = 20_000  # distinct labelled urls the trees are fitted on, of each verdict the ones with the smallest hash
LEAST_ROWS = 100  # urls of the rarer verdict among them, if there are as many
BROADCAST_SUFFIXES = 100_000  # rows of a suffix table: some ten MB; a larger one is shuffled
PER = 1_000_000  # labelled rows that suffix counts are stated for, so that they mean the same at every size
TREES, DEPTH = 12, 4
PRIOR = 5.0  # urls that a suffix's block share starts with, at the share of all
SYMBOLS = "abcdefghijklmnopqrstuvwxyz0123456789-_.~/?=&%:#+"

LEXICAL = ["url_length", "host_length", "path_length", "depth", "host_labels", "digit_share", "entropy", "host_entropy", "n_parameters", "n_hyphens", "longest_run", "has_fragment", "is_https"]
SUFFIX = ["tld_share", "tld_count", "domain_share", "domain_count", "section_share", "section_count"]


def parts(url: Column) -> tuple[Column, Column]:
    """Host (after the first ://, A-Z lower-cased) and path; both empty for null or without ://."""
    at = F.locate("://", filled(url))
    rest = F.when(at > 0, F.substr(filled(url), at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return lower_ascii(host), F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)


def matched_rule(rules: list[tuple[str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest of the (verdict, host/path) rules that fits, and its verdict; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: len(r[1])):
        rule_host, slash, rule_path = text.partition("/")
        fits = ((host == rule_host) | F.endswith(host, F.lit(f".{rule_host}"))) & F.startswith(path, F.lit(slash + rule_path))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def _entropy(text: Column) -> Column:
    """Bits per character over the lower-cased url alphabet; other characters count as one symbol."""
    n = F.length(text)
    counts = [n - F.length(F.replace(text, F.lit(c), F.lit(""))) for c in SYMBOLS]
    other = n - total(counts)
    size = F.greatest(n, F.lit(1)).cast("double")
    return total([F.when(c > 0, -(c / size) * F.log2(c / size)).otherwise(0.0) for c in [*counts, other]])


def with_features(urls: DataFrame) -> DataFrame:
    """Adds the lexical features and the suffix keys to rows with ``url``, ``host`` and ``path``."""
    url = filled("url")
    size = F.greatest(F.length(url), F.lit(1))
    lowered = F.lower(url)
    labels = F.split("host", r"\.")
    query_text = F.regexp_extract(url, r"\?([^#]*)", 1)
    features = {
        "url_length": F.length(url), "host_length": F.length("host"), "path_length": F.length("path"),
        "depth": F.size(F.filter(F.split("path", "/"), lambda x: x != "")), "host_labels": F.size(labels),
        "digit_share": F.length(F.regexp_replace(url, "[^0-9]", "")) / size, "entropy": _entropy(lowered), "host_entropy": _entropy(F.col("host")),
        "n_parameters": F.when(query_text == "", 0).otherwise(F.size(F.split(query_text, "&"))), "n_hyphens": F.length(url) - F.length(F.replace(url, F.lit("-"), F.lit(""))),
        "longest_run": F.array_max(F.transform(F.split(url, r"[^A-Za-z0-9]+"), lambda x: F.length(x))), "has_fragment": F.contains(url, F.lit("#")).cast("int"), "is_https": F.startswith(lowered, F.lit("https:")).cast("int"),
    }
    keys = {
        "tld": F.element_at(labels, -1), "domain": F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), "."),
        "section": F.regexp_extract("path", r"^/[^/]*", 0),
    }
    return urls.select("*", *[v.cast("double").alias(k) for k, v in features.items()], *[v.alias(k) for k, v in keys.items()])


def _with_suffixes(rows: DataFrame, tables: dict[str, DataFrame], prior: float) -> DataFrame:
    """Joins the block share and log count of each suffix; an unseen one has the share of all."""
    for key, table in tables.items():
        table = F.broadcast(table) if table.count() <= BROADCAST_SUFFIXES else table
        rows = rows.join(table, key, "left").fillna({f"{key}_share": prior, f"{key}_count": 0.0})
    return rows


def _sample(known: DataFrame, urls: dict[float, int], fit_rows: int) -> DataFrame:
    """Distinct urls of each label by the smallest hash, in proportion to the (approximate) numbers of distinct ``urls``."""
    hashed = F.pmod(F.xxhash64("url"), F.lit(1 << 40))
    picked = []
    for label, n in sorted(urls.items()):
        wanted = max(math.ceil(fit_rows * n / sum(urls.values())), min(LEAST_ROWS, fit_rows // 2))
        share = min(1.0, 4.0 * wanted / n)  # only about four times as many as wanted are ranked, whatever the number of rows and tasks
        near = known.where((F.col("label") == label) & (hashed < int(share * (1 << 40))))
        picked.append(near.select("url", "label", *LEXICAL, "tld", "domain", "section").dropDuplicates(["url"]).orderBy(hashed, "url").limit(wanted))
    return stored(picked[0].unionByName(picked[1]), "url-sample")


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[GBTClassificationModel, dict[str, DataFrame], float] | None:
    """Trees and suffix tables from rows with features and ``verdict``; None if only one verdict is known."""
    known = labelled.where(F.col("verdict").isNotNull()).withColumn("label", (F.col("verdict") == "block").cast("double"))
    verdicts = {x["label"]: x for x in known.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("url").alias("urls")).collect()}
    if len(verdicts) < 2:
        return None
    n = sum(x["n"] for x in verdicts.values())
    prior = verdicts[1.0]["n"] / n
    sample = _sample(known, {label: max(x["urls"], 1) for label, x in verdicts.items()}, fit_rows)
    tables = {}
    for key in ("tld", "domain", "section"):
        counts = known.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.sum("label").alias("_b"))
        tables[key] = stored(counts.select(key, ((F.col("_b") + PRIOR * prior) / (F.col("_n") + PRIOR)).alias(f"{key}_share"), F.log1p(F.col("_n") * (PER / n)).alias(f"{key}_count")), "url-suffixes")
    ready = VectorAssembler(inputCols=LEXICAL + SUFFIX, outputCol="features").transform(_with_suffixes(sample, tables, prior)).select("features", "label")
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=1, stepSize=0.3).fit(ready)
    return model, tables, prior


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]], fit_rows: int = FIT_ROWS) -> DataFrame:
    """page_id, url, host, path, rule, verdict, score (the trees' share for block) of every row.

    The rule's verdict holds; without one the trees decide (block from 0.5 on). Null urls and urls without :// have
    an empty host and path and are scored like others. If the rules label no url, or all alike, the verdict without a rule is
    that of all labelled ones (allow if there are none) and the score is null. Repeated rows are judged each.
    """
    host, path = parts(F.col("url"))
    rule, verdict = matched_rule(rules, F.col("host"), F.col("path"))
    split = pages.select("page_id", "url").withColumn("host", host).withColumn("path", path)
    rows = with_features(split.withColumn("rule", rule).withColumn("verdict", verdict))
    kept = ["page_id", "url", "host", "path", "rule"]
    fitted = fit(rows, fit_rows)
    if fitted is None:
        only = rows.where(F.col("verdict").isNotNull()).select("verdict").limit(1).collect()
        return rows.select(*kept, F.coalesce("verdict", F.lit(only[0]["verdict"] if only else "allow")).alias("verdict"), F.lit(None).cast("double").alias("score"))
    model, tables, prior = fitted
    vectors = VectorAssembler(inputCols=LEXICAL + SUFFIX, outputCol="features").transform(_with_suffixes(rows, tables, prior))
    scored = model.transform(vectors).withColumn("score", vector_to_array("probability")[1])
    return scored.select(*kept, F.coalesce("verdict", F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "score")
