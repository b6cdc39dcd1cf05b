"""The Porter2 stemmer (the English algorithm of the Snowball project), and detachment rules for base forms."""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

# The algorithm's tables as published.
WHOLE = {"skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl"} | {w: w for w in ("sky", "news", "howe", "atlas", "cosmos", "bias", "andes")}
AFTER_1A = {"inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"}
STEP2 = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent", "izer": "ize", "ization": "ize", "ational": "ate", "ation": "ate", "ator": "ate", "alism": "al", "aliti": "al", "alli": "al",
    "fulness": "ful", "ousli": "ous", "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble", "ogi": "og", "fulli": "ful", "lessli": "less", "li": "",
}
STEP3 = {"tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ful": "", "ness": "", "ative": ""}
STEP4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "ion")
VOWELS, DOUBLES = "aeiouy", ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
#: Endings of inflected forms, and what the base form has instead.
DETACH = (
    ("noun", "s", ""), ("noun", "ses", "s"), ("noun", "xes", "x"), ("noun", "zes", "z"), ("noun", "ches", "ch"), ("noun", "shes", "sh"), ("noun", "men", "man"), ("noun", "ies", "y"),
    ("verb", "s", ""), ("verb", "ies", "y"), ("verb", "es", "e"), ("verb", "es", ""), ("verb", "ed", "e"), ("verb", "ed", ""), ("verb", "ing", "e"), ("verb", "ing", ""),
    ("adj", "er", ""), ("adj", "est", ""), ("adj", "er", "e"), ("adj", "est", "e"),
)

_REGION = re.compile(r"[aeiouy][^aeiouy]")
_SHORT_END = re.compile(r"(?:[^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])$")


def _after(word: str, start: int) -> int:
    m = _REGION.search(word, start)
    return m.end() if m else len(word)


def _ending(word: str, endings) -> str:
    """The longest of the endings that the word has."""
    return max((e for e in endings if word.endswith(e)), key=len, default="")


def _step1(w: str, r1: int) -> str:
    end = _ending(w, ("sses", "ied", "ies", "us", "ss", "s"))
    if end == "sses":
        w = w[:-2]
    elif end in ("ied", "ies"):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif end == "s" and any(c in VOWELS for c in w[:-2]):
        w = w[:-1]
    if w in AFTER_1A:
        return w
    end = _ending(w, ("eed", "eedly", "ed", "edly", "ing", "ingly"))
    stem = w[: len(w) - len(end)]
    if end in ("eed", "eedly"):
        if len(stem) >= r1:
            w = stem + "ee"
    elif end and any(c in VOWELS for c in stem):
        w = stem
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif w.endswith(DOUBLES):
            w = w[:-1]
        elif r1 >= len(w) and _SHORT_END.search(w):
            w += "e"
    if len(w) > 2 and w[-1] in "yY" and w[-2] not in VOWELS:
        w = w[:-1] + "i"
    return w


@lru_cache(maxsize=1 << 16)
def stem(word: str) -> str:
    """Stem of a lower-case word; words of two letters or fewer are their own."""
    if len(word) <= 2:
        return word
    if word in WHOLE:
        return WHOLE[word]
    w = word.removeprefix("'")
    w = re.sub(r"(^|[aeiouy])y", r"\1Y", w)
    head = next((h for h in ("gener", "commun", "arsen") if w.startswith(h)), "")
    r1 = len(head) if head else _after(w, 0)
    r2 = _after(w, r1)
    end = _ending(w, ("'s'", "'s", "'"))
    w = _step1(w[: len(w) - len(end)], r1)
    if w in AFTER_1A:
        return w
    end = _ending(w, STEP2)
    left = w[: len(w) - len(end)]
    if end and len(left) >= r1 and (end != "ogi" or left.endswith("l")) and (end != "li" or left[-1:] in tuple("cdeghkmnrt")):
        w = left + STEP2[end]
    end = _ending(w, STEP3)
    left = w[: len(w) - len(end)]
    if end and len(left) >= (r2 if end == "ative" else r1):
        w = left + STEP3[end]
    end = _ending(w, STEP4)
    left = w[: len(w) - len(end)]
    if end and len(left) >= r2 and (end != "ion" or left[-1:] in ("s", "t")):
        w = left
    if w.endswith("e"):
        if len(w) - 1 >= r2 or (len(w) - 1 >= r1 and not _SHORT_END.search(w[:-1])):
            w = w[:-1]
    elif w.endswith("ll") and len(w) - 1 >= r2:
        w = w[:-1]
    return w.replace("Y", "y")


@pandas_udf(T.StringType())
def stemmed(words: pd.Series) -> pd.Series:
    """Stems of a batch of words; null stays null."""
    return words.map(lambda w: stem(w.lower()) if isinstance(w, str) else None)


def base_forms(tokens: DataFrame, lexicon: DataFrame) -> DataFrame:
    """token, pos, base: each word of the lexicon that a detachment rule makes of a token.  Both have a column token."""
    rules = F.array(*[F.struct(F.lit(p).alias("pos"), F.lit(e).alias("ending"), F.lit(b).alias("put")) for p, e, b in DETACH])
    rows = tokens.select("token", F.explode(rules).alias("r")).where(F.expr("endswith(token, r.ending) and length(token) > length(r.ending)"))
    base = F.concat(F.expr("left(token, length(token) - length(r.ending))"), "r.put")
    rows = rows.select("token", F.col("r.pos").alias("pos"), base.alias("base")).where("base <> token").distinct()
    return rows.join(lexicon.select(F.col("token").alias("base")), "base", "left_semi").select("token", "pos", "base")


def stem_variants(tokens: DataFrame) -> DataFrame:
    """variant, base, source: words that are stems of other tokens, without the words themselves."""
    return tokens.select("token", stemmed("token").alias("variant")).where("variant <> token").select("variant", F.col("token").alias("base"), F.lit("snowball").alias("source")).distinct()
