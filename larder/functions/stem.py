"""Porter stemming of token lists, in the extended variant common in text scoring."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F, types as T

# Suffix tables of the published algorithm (suffix, replacement).
STEP_2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"),
    ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
    ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"),
    ("biliti", "ble"), ("fulli", "ful"),
]
STEP_3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", "")]
STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti",
    "ous", "ive", "ize",
]
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing", "cannings": "canning",
    "canning": "canning", "howe": "howe", "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}
SHORTEST_STEMMED = 4


def _shape(word: str) -> str:
    """The word as v(owel) and c(onsonant) marks; y is a vowel after a consonant."""
    marks = ""
    for i, ch in enumerate(word):
        vowel = ch in "aeiou" or (ch == "y" and i > 0 and marks[-1] == "c")
        marks += "v" if vowel else "c"
    return marks


def _measure(stem: str) -> int:
    return _shape(stem).count("vc")


def _short_end(word: str) -> bool:
    shape = _shape(word)
    return (shape.endswith("cvc") and word[-1] not in "wxy") or shape == "vc"


def _double_end(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _plural(word: str) -> str:
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("sses"):
        return word[:-2]
    return word[:-1] if word.endswith("s") and not word.endswith("ss") else word


def _past(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        stem = word[: -len(suffix)]
        if word.endswith(suffix) and "v" in _shape(stem):
            if stem.endswith(("at", "bl", "iz")):
                return stem + "e"
            if _double_end(stem):
                return stem if stem[-1] in "lsz" else stem[:-1]
            return stem + "e" if _measure(stem) == 1 and _short_end(stem) else stem
    return word


def _final_y(word: str) -> str:
    stem = word[:-1]
    return stem + "i" if word.endswith("y") and len(stem) > 1 and _shape(stem)[-1] == "c" else word


def _longer_suffix(word: str) -> str:
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        return _longer_suffix(word[:-2])
    if word.endswith("logi"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    return _replaced(word, STEP_2)


def _replaced(word: str, table: list[tuple[str, str]]) -> str:
    for suffix, other in table:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            return stem + other if _measure(stem) > 0 else word
    return word


def _dropped(word: str) -> str:
    for suffix in STEP_4:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            allowed = _measure(stem) > 1 and (suffix != "ion" or stem.endswith(("s", "t")))
            return stem if allowed else word
    return word


def _tidy(word: str) -> str:
    if word.endswith("e"):
        stem = word[:-1]
        size = _measure(stem)
        if size > 1 or (size == 1 and not _short_end(stem)):
            word = stem
    return word[:-1] if word.endswith("ll") and _measure(word[:-1]) > 1 else word


@lru_cache(maxsize=1 << 16)
def stem(word: str) -> str:
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    for step in (_plural, _past, _final_y, _longer_suffix):
        word = step(word)
    return _tidy(_dropped(_replaced(word, STEP_3)))


@F.arrow_udf(T.ArrayType(T.StringType()))
def stem_words(lists: pa.Array) -> pa.Array:
    """Stems of tokens longer than three characters; shorter ones stay. Each word of a batch is stemmed once, as a string of its own."""
    words = lists.flatten().dictionary_encode()
    stems = pa.array([stem(t) if len(t) >= SHORTEST_STEMMED else t for t in words.dictionary.to_pylist()], pa.string())
    ends = np.cumsum(pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int32)
    return pa.ListArray.from_arrays(np.concatenate([np.zeros(1, np.int32), ends]), stems.take(words.indices))
