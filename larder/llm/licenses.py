"""License scans: ordered signature rules behind keyword gates.

A text becomes its lower-cased words with one blank between. Two gates keep regular expressions away from text
that cannot match: a word that any rule needs, read from the rules, then the keyword of each rule. Every rule's matches are intervals of
characters. Sorted by start, longest first, an interval that lies inside an earlier one of the same or a better priority is
suppressed. What is left gives the labels. All steps are built-in expressions within the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import LETTERS_AND_DIGITS, filled, lower_ascii

RAW_LETTER = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
RAW_WORD = f"{RAW_LETTER}+"
LICENSE = "licen[sc]"

# The phrases and labels of the query contract.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Families: label, keyword of the gate, name as a pattern over words, versions ("" for none).
FAMILIES = [
    ("mit", "mit", "(?:the )?mit(?: x11)?", [""]),
    ("apache", "apache", "(?:the )?apache(?: software)?", ["", "1 0", "1 1", "2 0"]),
    ("gpl", "public", "(?:the )?(?:gnu )?general public", ["", "1", "2", "2 0", "3", "3 0"]),
    ("lgpl", "public", "(?:the )?(?:gnu )?(?:lesser|library) general public", ["", "2", "2 1", "3", "3 0"]),
    ("agpl", "affero", "(?:the )?(?:gnu )?affero general public", ["", "3", "3 0"]),
    ("bsd", "bsd", "(?:the )?(?:new |revised |modified |simplified )?(?:[0234] clause )?bsd(?: [0234] clause)?", [""]),
    ("mpl", "mozilla", "(?:the )?mozilla public", ["", "1 0", "1 1", "2 0"]),
    ("epl", "eclipse", "(?:the )?eclipse public", ["", "1 0", "2 0"]),
    ("cddl", "common", "(?:the )?common development and distribution", ["", "1 0", "1 1"]),
    ("isc", "isc", "(?:the )?isc", [""]),
    ("zlib", "zlib", "(?:the )?zlib(?: libpng)?", [""]),
    ("boost", "boost", "(?:the )?boost software", ["", "1 0"]),
    ("artistic", "artistic", "(?:the )?(?:perl )?artistic", ["", "1 0", "2 0"]),
    ("eupl", "european", "(?:the )?european union public", ["", "1 1", "1 2"]),
    ("ms-pl", "microsoft", "(?:the )?microsoft public", [""]),
    ("wtfpl", "public", "(?:the )?do what the fuck you want to public", ["", "2"]),
    ("odbl", "database", "(?:the )?open (?:data commons )?(?:open )?database", ["", "1 0"]),
    ("ofl", "font", "(?:the )?(?:sil )?open font", ["", "1 0", "1 1"]),
    ("python", "python", "(?:the )?python software foundation", ["", "2"]),
    ("php", "php", "(?:the )?php", ["", "3 0", "3 01"]),
    ("gfdl", "documentation", "(?:the )?(?:gnu )?free documentation", ["", "1 1", "1 2", "1 3"]),
]
# Forms of a statement over a family's name: priority (smaller is better) and pattern.
FORMS = [
    (1, "(?:is |are )?licen[sc]ed under (?:the terms of )?{name} licen[sc]e{version}"),
    (1, "released under (?:the terms of )?{name} licen[sc]e{version}"),
    (1, "(?:distributed|available|published|provided) under (?:the terms of )?{name} licen[sc]e{version}"),
    (2, "{name} licen[sc]e{version}"),
]
# Creative Commons: element, gate keyword, pattern; each with its versions, as a code and in words.
COMMONS = [("cc-by", "by"), ("cc-by-sa", "by sa"), ("cc-by-nc", "by nc"), ("cc-by-nd", "by nd"), ("cc-by-nc-sa", "by nc sa"), ("cc-by-nc-nd", "by nc nd"), ("cc0", "0")]
COMMONS_VERSIONS = ["", "1 0", "2 0", "2 5", "3 0", "4 0"]
# Single statements: label, keyword, priority, pattern.
STATEMENTS = [
    ("mit", "granted", 1, "permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission", 1, "permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", "redistribution", 1, "redistribution and use in source and binary forms with or without modification are permitted"),
    ("zlib", "implied", 1, "this software is provided as is without any express or implied warranty"),
    ("unlicense", "unencumbered", 1, "this is free and unencumbered software released into the public domain"),
    ("public-domain", "domain", 2, "(?:dedicated to|released into|placed in|in) the public domain"),
    ("all-rights-reserved", "reserved", 2, "all rights reserved"),
    ("copyright", "copyright", 3, "copyright (?:c )?(?:19|20)[0-9][0-9]"),
    ("proprietary", "proprietary", 2, "proprietary and confidential"),
    ("no-redistribution", "redistribution", 2, "(?:no|not for) redistribution"),
]
SPDX = ["mit", "apache 2 0", "gpl 2 0", "gpl 2 0 only", "gpl 2 0 or later", "gpl 3 0", "gpl 3 0 only", "gpl 3 0 or later", "lgpl 2 1", "lgpl 3 0", "agpl 3 0", "bsd 2 clause", "bsd 3 clause", "mpl 2 0", "isc", "epl 2 0", "cc by 4 0", "cc by sa 4 0", "cc0 1 0", "unlicense", "bsl 1 0", "zlib"]
WEIGHT = {1: 1.0, 2: 0.8, 3: 0.4}


def signatures() -> list[tuple[str, str, int, str]]:
    """(label, keyword, priority, pattern) of all rules, in the order of the tables; patterns run from blank to word end."""
    found = []
    for label, keyword, name, versions in FAMILIES:
        for version in versions:
            digits = f" (?:v|version |v )?{version}" if version else ""
            versioned = f"{label}-{version.replace(' ', '.')}" if version else label
            for priority, form in FORMS:
                found.append((versioned, keyword, priority + (0 if version else 1), form.format(name=name, version=digits)))
    for label, words in COMMONS:
        for version in COMMONS_VERSIONS:
            versioned = f"{label}-{version.replace(' ', '.')}" if version else label
            digits = f" {version}" if version else ""
            found.append((versioned, "cc", 1 if version else 2, f"licen[sc]ed under (?:a )?cc(?: )?{words}{digits}"))
            found.append((versioned, "creative", 1 if version else 2, f"creative commons(?: attribution)? (?:cc )?{words}{digits}"))
    found += [(label, keyword, priority, pattern) for label, keyword, priority, pattern in STATEMENTS]
    found += [(f"spdx-{code.replace(' ', '-')}", "spdx", 1, f"spdx licen[sc]e identifier {code}") for code in SPDX]
    return found


def anchors() -> str:
    """Matches raw text that may hold a rule's statement: most rules need a word with LICENSE, each of the others its keyword."""
    needed = dict.fromkeys(LICENSE if LICENSE in pattern else keyword for _, keyword, _, pattern in signatures())
    return f"(?<!{RAW_LETTER})(?i:{'|'.join(needed)})"


def _rules() -> Column:
    rows = [F.struct(F.lit(label).alias("label"), F.lit(keyword).alias("keyword"), F.lit(priority).alias("priority"), F.lit(f" {pattern}(?= )").alias("pattern")) for label, keyword, priority, pattern in signatures()]
    return F.array(*rows)


def _word_count(piece: Column) -> Column:
    return F.length(piece) - F.length(F.replace(piece, F.lit(" "), F.lit("")))


def _matches(text: Column, rule: Column) -> Column:
    """Intervals (start, -end, priority, label) of a rule's matches, in order."""
    between, found = F.split(text, rule["pattern"], -1), F.regexp_extract_all(text, rule["pattern"], F.lit(0))
    sizes = F.arrays_zip(F.transform(between, lambda x: F.length(x)).alias("gap"), F.transform(found, lambda x: F.length(x)).alias("size"))
    empty = F.array().cast("array<struct<start:int,back:int,priority:int,label:string>>")
    return F.aggregate(
        F.slice(sizes, 1, F.size(found)),
        F.named_struct(F.lit("at"), F.lit(0), F.lit("out"), empty),
        lambda a, x: F.named_struct(
            F.lit("at"), a["at"] + x["gap"] + x["size"],
            F.lit("out"), F.concat(a["out"], F.array(F.named_struct(F.lit("start"), a["at"] + x["gap"], F.lit("back"), -(a["at"] + x["gap"] + x["size"]), F.lit("priority"), rule["priority"], F.lit("label"), rule["label"]))),
        ),
        lambda a: a["out"],
    )


def detect(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, method_labels, n_detections, best_priority of every row.

    ``n_base`` counts the places of the base phrases, first_word and last_word their smallest and largest start. Null or empty text: no words, empty
    labels, null places. The whole text is scanned. Repeated rows give repeated rows.
    """
    raw = filled("text")
    gate = raw.rlike(anchors())
    n_words = F.regexp_count(raw, F.lit(RAW_WORD))
    normal = F.concat(F.lit(" "), F.array_join(F.regexp_extract_all(lower_ascii(raw), F.lit(LETTERS_AND_DIGITS), F.lit(0)), " "), F.lit(" "))
    gated = docs.select("doc_id", n_words.cast("long").alias("n_words"), F.when(gate, normal).otherwise(F.lit("")).alias("_text"))

    places = []
    for phrase in BASE:
        pieces = F.when(F.contains("_text", F.lit(f" {phrase} ")), F.split("_text", f" {phrase}(?= )", -1)).otherwise(F.array(F.lit("")))
        places.append(pieces.alias(f"_p{len(places)}"))
    split = gated.select("*", *places)
    counts, firsts, lasts, labels = [], [], [], []
    for i, (phrase, label) in enumerate(BASE.items()):
        here, size = F.col(f"_p{i}"), len(phrase.split(" "))
        n = F.size(here) - 1
        counts.append(n)
        firsts.append(F.when(n > 0, _word_count(here[0])))
        lasts.append(F.when(n > 0, F.col("n_words") - (_word_count(F.element_at(here, -1)) - 1) - size))
        labels.append(F.when(n > 0, F.lit(label)))
    n_base = counts[0] + counts[1] + counts[2]
    based = split.select(
        "doc_id", "n_words", "_text", n_base.cast("long").alias("n_base"), F.least(*firsts).cast("long").alias("first_word"), F.greatest(*lasts).cast("long").alias("last_word"),
        F.array_sort(F.filter(F.array(*labels), lambda x: x.isNotNull())).alias("base_labels"),
    )
    applicable = F.when(F.col("_text") != "", F.filter(_rules(), lambda r: F.contains(F.col("_text"), F.concat(F.lit(" "), r["keyword"])))).otherwise(F.array().cast("array<struct<label:string,keyword:string,priority:int,pattern:string>>"))
    gated_rules = based.select("*", applicable.alias("_rules"))
    intervals = gated_rules.select("*", F.array_sort(F.flatten(F.transform("_rules", lambda r: _matches(F.col("_text"), r)))).alias("_found"))
    start = F.named_struct(*[x for p in (1, 2, 3) for x in (F.lit(f"r{p}"), F.lit(0))], F.lit("labels"), F.array().cast("array<string>"), F.lit("n"), F.lit(0), F.lit("best"), F.lit(9))

    def step(a: Column, x: Column) -> Column:
        end = -x["back"]
        inside = (a["r1"] >= end) | ((x["priority"] >= 2) & (a["r2"] >= end)) | ((x["priority"] >= 3) & (a["r3"] >= end))
        reach = [y for p in (1, 2, 3) for y in (F.lit(f"r{p}"), F.when(~inside & (x["priority"] == p), F.greatest(a[f"r{p}"], end)).otherwise(a[f"r{p}"]))]
        return F.named_struct(
            *reach, F.lit("labels"), F.when(inside, a["labels"]).otherwise(F.array_union(a["labels"], F.array(x["label"]))),
            F.lit("n"), a["n"] + F.when(inside, 0).otherwise(1), F.lit("best"), F.when(inside, a["best"]).otherwise(F.least(a["best"], x["priority"])),
        )

    kept = intervals.select("*", F.aggregate("_found", start, step).alias("_kept"))
    return kept.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", F.array_sort("_kept.labels").alias("method_labels"),
        F.col("_kept.n").alias("n_detections"), F.when(F.col("_kept.best") < 9, F.col("_kept.best")).alias("best_priority"),
    )


def score() -> Column:
    """1 for a statement of the best priority, less for weaker ones, 0 without any; a base phrase alone counts as the weakest."""
    chain = F.when(F.col("n_base") > 0, WEIGHT[3]).otherwise(0.0)
    return F.when(F.col("best_priority").isNotNull(), F.coalesce(*[F.when(F.col("best_priority") == p, F.lit(w)) for p, w in WEIGHT.items()], F.lit(0.0))).otherwise(chain)
