"""Stemming, string similarity and simple entity and noun finding: the few text functions without a built-in."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VOWEL = "aeiou"


def _is_consonant(w: str, i: int) -> bool:
    return w[i] not in _VOWEL and not (w[i] == "y" and i > 0 and _is_consonant(w, i - 1))


def _measure(w: str) -> int:
    shape = "".join("c" if _is_consonant(w, i) else "v" for i in range(len(w)))
    return len(re.findall("v+c+", shape))


def _has_vowel(w: str) -> bool:
    return any(not _is_consonant(w, i) for i in range(len(w)))


def _double(w: str) -> bool:
    return len(w) > 1 and w[-1] == w[-2] and _is_consonant(w, len(w) - 1)


def _cvc(w: str) -> bool:
    n = len(w)
    return n > 2 and _is_consonant(w, n - 3) and not _is_consonant(w, n - 2) and _is_consonant(w, n - 1) and w[-1] not in "wxy"


#: Suffixes and what replaces them in the published steps 2, 3 and 4.
_STEP2 = "ational ate tional tion enci ence anci ance izer ize abli able alli al entli ent eli e ousli ous ization ize ation ate ator ate alism al iveness ive fulness ful ousness ous aliti al iviti ive biliti ble".split()
_STEP3 = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""))
_STEP4 = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize".split()


def porter(word: str) -> str:
    """The stem of an English word by the algorithm published in 1980."""
    w = word.lower()
    if len(w) < 3:
        return w
    if w.endswith("sses") or w.endswith("ies"):
        w = w[:-2]
    elif w.endswith("s") and not w.endswith("ss"):
        w = w[:-1]
    if w.endswith("eed"):
        w = w[:-1] if _measure(w[:-3]) > 0 else w
    else:
        cut = next((s for s in ("ed", "ing") if w.endswith(s) and _has_vowel(w[: -len(s)])), None)
        if cut:
            w = w[: -len(cut)]
            if w.endswith(("at", "bl", "iz")):
                w += "e"
            elif _double(w) and w[-1] not in "lsz":
                w = w[:-1]
            elif _measure(w) == 1 and _cvc(w):
                w += "e"
    if w.endswith("y") and _has_vowel(w[:-1]):
        w = w[:-1] + "i"
    for rules in (sorted(zip(_STEP2[::2], _STEP2[1::2], strict=True), key=lambda r: -len(r[0])), sorted(_STEP3, key=lambda r: -len(r[0]))):
        for suffix, by in rules:
            if w.endswith(suffix):
                if _measure(w[: -len(suffix)]) > 0:
                    w = w[: -len(suffix)] + by
                break
    for suffix in sorted(_STEP4, key=len, reverse=True):
        if w.endswith(suffix):
            stem = w[: -len(suffix)]
            if _measure(stem) > 1 and (suffix != "ion" or stem.endswith(("s", "t"))):
                w = stem
            break
    if w.endswith("e"):
        m = _measure(w[:-1])
        if m > 1 or m == 1 and not _cvc(w[:-1]):
            w = w[:-1]
    return w[:-1] if _measure(w) > 1 and _double(w) and w.endswith("l") else w


def jaro_winkler(a: str, b: str, weight: float = 0.1) -> float:
    if a == b:
        return 1.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    used, first = [False] * len(b), []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == ch:
                used[j] = True
                first.append(ch)
                break
    if not first:
        return 0.0
    second = [ch for ch, u in zip(b, used, strict=True) if u]
    m, moved = len(first), sum(x != y for x, y in zip(first, second, strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    same = 0
    while same < min(4, len(a), len(b)) and a[same] == b[same]:
        same += 1
    return jaro + same * weight * (1 - jaro) if jaro > 0.7 else jaro


@F.pandas_udf(T.StringType())
def stem(word: pd.Series) -> pd.Series:
    known: dict[str, str] = {}
    return word.map(lambda w: None if w is None else known.setdefault(w, "") or known.__setitem__(w, porter(w)) or known[w])


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([jaro_winkler(x or "", y or "") for x, y in zip(a, b, strict=True)])


#: Patterns that any regular-expression engine without lookaround can run, for one group each.
ENTITY = r"[\p{L}\p{N},;:] (\p{Lu}[\p{L}\p{N}]+(?: \p{Lu}[\p{L}\p{N}]+)*)"
NOUN = r"(?:^|[^\p{L}\p{N}_])(?:the|a|an|this|that|these|those|my|your|his|her|its|our|their) (\p{L}+)"


def entities(text):
    """Runs of capitalised words that don't open a sentence, in lower case, two characters at least: native."""
    runs = F.regexp_extract_all(text, F.lit(ENTITY), 1)
    return F.filter(F.transform(runs, lambda r: F.lower(F.trim(r))), lambda r: F.length(r) >= 2)


def nouns(text):
    """Words behind a determiner, in lower case, longer than three characters: native."""
    return F.filter(F.regexp_extract_all(F.lower(text), F.lit(NOUN), 1), lambda w: F.length(w) > 3)
