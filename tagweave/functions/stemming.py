"""English suffix stemming after Porter (1980), lower case in and out."""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagweave.functions.arrow import map_distinct

# The suffix tables of the published algorithm.
STEP_2 = {
    "ational": "ate",
    "tional": "tion",
    "enci": "ence",
    "anci": "ance",
    "izer": "ize",
    "abli": "able",
    "alli": "al",
    "entli": "ent",
    "eli": "e",
    "ousli": "ous",
    "ization": "ize",
    "ation": "ate",
    "ator": "ate",
    "alism": "al",
    "iveness": "ive",
    "fulness": "ful",
    "ousness": "ous",
    "aliti": "al",
    "iviti": "ive",
    "biliti": "ble",
}
STEP_3 = {
    "icate": "ic",
    "ative": "",
    "alize": "al",
    "iciti": "ic",
    "ical": "ic",
    "ful": "",
    "ness": "",
}
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment",
    "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)

VOWELS = frozenset("aeiou")


def _shape(word: str) -> str:
    """One letter per character: ``v`` for a vowel, ``c`` for a consonant."""
    shape = ""
    for ch in word:
        vowel = ch in VOWELS or (ch == "y" and shape.endswith("c"))
        shape += "v" if vowel else "c"
    return shape


def _measure(stem: str) -> int:
    """Number of vowel-to-consonant changes."""
    return _shape(stem).count("vc")


def _has_vowel(stem: str) -> bool:
    return "v" in _shape(stem)


def _ends_short(stem: str) -> bool:
    return _shape(stem).endswith("cvc") and stem[-1] not in "wxy"


def _longest(word: str, suffixes) -> str | None:
    found = [s for s in suffixes if word.endswith(s)]
    return max(found, key=len) if found else None


def _plural(word: str) -> str:
    if word.endswith(("sses", "ies")):
        return word[:-2]
    if word.endswith("s") and not word.endswith("ss"):
        return word[:-1]
    return word


def _past_or_gerund(word: str) -> str:
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    ending = _longest(word, ("ed", "ing"))
    if ending is None or not _has_vowel(word[: -len(ending)]):
        return word
    stem = word[: -len(ending)]
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if len(stem) > 1 and stem[-1] == stem[-2] and _shape(stem)[-1] == "c" and stem[-1] not in "lsz":
        return stem[:-1]
    if _measure(stem) == 1 and _ends_short(stem):
        return stem + "e"
    return stem


def _final_y(word: str) -> str:
    return word[:-1] + "i" if word.endswith("y") and _has_vowel(word[:-1]) else word


def _replace(word: str, table: dict[str, str]) -> str:
    ending = _longest(word, table)
    if ending is not None and _measure(word[: -len(ending)]) > 0:
        return word[: -len(ending)] + table[ending]
    return word


def _drop(word: str) -> str:
    ending = _longest(word, STEP_4)
    if ending is None:
        return word
    stem = word[: -len(ending)]
    if _measure(stem) <= 1 or (ending == "ion" and not stem.endswith(("s", "t"))):
        return word
    return stem


def _tidy(word: str) -> str:
    if word.endswith("e"):
        stem = word[:-1]
        if _measure(stem) > 1 or (_measure(stem) == 1 and not _ends_short(stem)):
            word = stem
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word


@lru_cache(maxsize=1 << 17)
def porter_stem(token: str) -> str:
    word = token.lower()
    if len(word) <= 2:
        return word
    word = _final_y(_past_or_gerund(_plural(word)))
    word = _replace(_replace(word, STEP_2), STEP_3)
    return _tidy(_drop(word))


@F.arrow_udf(T.ArrayType(T.StringType()))
def stem_tokens(tokens: pa.Array) -> pa.Array:
    """Stem every token of an array column, in place, without a shuffle."""
    return map_distinct(tokens, porter_stem, pa.string())
