"""Suffix stripping of English words by the published algorithm of M. F. Porter (1980)."""

from __future__ import annotations

import functools

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# Suffixes of the algorithm's steps 2 to 4, with what stands for them.
STEP_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
)
STEP_3 = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""))
STEP_4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize")


def _kinds(word: str) -> str:
    """``v`` for each vowel and ``c`` for each consonant; y is a vowel behind a consonant."""
    out = ""
    for i, x in enumerate(word):
        out += "v" if x in "aeiou" or (x == "y" and i and out[-1] == "c") else "c"
    return out


def _measure(stem: str) -> int:
    """How often a consonant follows a vowel."""
    return _kinds(stem).count("vc")


def _short(stem: str) -> bool:
    """Whether a stem ends with consonant, vowel, consonant, the last not w, x or y."""
    return _kinds(stem)[-3:] == "cvc" and stem[-1] not in "wxy"


def _replaced(word: str, rules, least: int) -> str:
    """The longest suffix that fits is replaced if what is before it measures more than ``least``."""
    for suffix, other in sorted(rules, key=lambda r: -len(r[0])):
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            return stem + other if _measure(stem) > least and (suffix != "ion" or stem[-1:] in ("s", "t")) else word
    return word


@functools.lru_cache(maxsize=100_000)
def stem(word: str) -> str:
    """The stem of a lower-case word; words of one or two letters stay."""
    if len(word) <= 2:
        return word
    for suffix, other in (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")):
        if word.endswith(suffix):
            word = word[: -len(suffix)] + other
            break
    cut = next((s for s in ("eed", "ed", "ing") if word.endswith(s)), None)
    if cut == "eed":
        word = word[:-1] if _measure(word[:-3]) > 0 else word
    elif cut and "v" in _kinds(word[: -len(cut)]):
        word = word[: -len(cut)]
        if word.endswith(("at", "bl", "iz")):
            word += "e"
        elif word[-1:] == word[-2:-1] and _kinds(word)[-1] == "c" and word[-1] not in "lsz":
            word = word[:-1]
        elif _measure(word) == 1 and _short(word):
            word += "e"
    if word.endswith("y") and "v" in _kinds(word[:-1]):
        word = word[:-1] + "i"
    word = _replaced(_replaced(word, STEP_2, 0), STEP_3, 0)
    word = _replaced(word, [(s, "") for s in STEP_4], 1)
    if word.endswith("e") and (_measure(word[:-1]) > 1 or _measure(word[:-1]) == 1 and not _short(word[:-1])):
        word = word[:-1]
    return word[:-1] if word.endswith("ll") and _measure(word[:-1]) > 1 else word


@F.pandas_udf(ArrayType(StringType()))
def stemmed(words: pd.Series) -> pd.Series:
    """Words with those of more than three letters stemmed."""
    return words.map(lambda some: None if some is None else [stem(w) if len(w) > 3 else w for w in some])
