"""Column functions of the engine; all JVM-side but for the 64-bit hash and the exact logarithm, which are Arrow UDFs."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The 64-bit FNV-1a offset basis and prime.
FNV_BASIS, FNV_PRIME = 14695981039346656037, 1099511628211
#: Upper bounds of reef counts for specificity 3, 2, 1, 0, -1; above them -2.
SPECIFICITY_STEPS = ((1, 3), (3, 2), (5, 1), (10, 0), (20, -1))
#: The same of numbers of domains, for 2, 1, 0, -1.
DOMAIN_STEPS = ((3, 2), (10, 1), (50, 0), (150, -1))
#: Particles that end a phrasal verb of two or three words.
PARTICLES = ("up", "down", "out", "in", "on", "off", "over", "away", "back", "through", "around", "about", "along", "across", "aside", "forth", "together", "apart")


@F.pandas_udf(T.LongType())
def fnv1a(words: pd.Series) -> pd.Series:
    """FNV-1a of the UTF-8 bytes as a signed 64-bit integer; null stays null.  Bytes are folded place by place over the whole batch."""
    raw = [None if w is None else w.encode() for w in words]
    sizes = np.array([0 if r is None else len(r) for r in raw])
    h = np.full(len(raw), FNV_BASIS, np.uint64)
    table = np.zeros((len(raw), int(sizes.max(initial=0))), np.uint8)
    for i, r in enumerate(raw):
        if r:
            table[i, : len(r)] = np.frombuffer(r, np.uint8)
    for j in range(table.shape[1]):
        on = sizes > j
        h[on] = (h[on] ^ table[on, j].astype(np.uint64)) * np.uint64(FNV_PRIME)
    return pd.Series(h.view(np.int64), dtype="Int64").where(pd.Series([r is not None for r in raw]), pd.NA)


def unsigned(c: Column) -> Column:
    """A signed 64-bit integer read as an unsigned one."""
    wide = c.cast("decimal(20,0)")
    return F.when(c < 0, wide + F.lit("18446744073709551616").cast("decimal(20,0)")).otherwise(wide)


def _steps(n: Column, steps: tuple, beyond: int) -> Column:
    out = F.lit(beyond)
    for bound, value in reversed(steps):
        out = F.when(n <= bound, value).otherwise(out)
    return out


def specificity(reefs: Column) -> Column:
    return _steps(reefs, SPECIFICITY_STEPS, -2)


def domain_specificity(domains: Column) -> Column:
    return F.when(domains == 0, 0).otherwise(_steps(domains, DOMAIN_STEPS, -2))


@F.pandas_udf(T.DoubleType())
def log2(x: pd.Series) -> pd.Series:
    """Logarithm to base 2 as the C library and SQL engines give it; null stays null, and x is above 0.

    The JVM divides two natural logarithms, so a third of its values have another last digit.  Where scores
    are put on a scale between their least and largest, that digit decides between 0, 128 and 255.
    """
    return x.map({v: math.log2(v) for v in x.dropna().unique()}).astype("float64")


def floored_idf(total: Column, reefs: Column) -> Column:
    """log2(total / reefs), at least 0.1; 0 where there is no reef."""
    return F.when(reefs > 0, F.greatest(log2(F.try_divide(total, reefs)), F.lit(0.1))).otherwise(F.lit(0.0))


def quantize_idf(idf: Column, scale: float = 21.0) -> Column:
    return F.greatest(F.least(F.bround(F.coalesce(idf, F.lit(0.0)) * scale), F.lit(255.0)), F.lit(0.0)).cast("int")


def min_max_u8(x: Column, lo: Column, hi: Column, flat: float = 128.0) -> Column:
    """255 (x - lo) / (hi - lo), rounded half to even; `flat` where hi = lo."""
    return F.when(hi > lo, F.bround(F.lit(255.0) * (x - lo) / F.when(hi > lo, hi - lo))).otherwise(F.lit(flat)).cast("int")


def exclusivity(n: Column) -> Column:
    return F.pow(F.greatest(n, F.lit(1)).cast("double"), F.lit(-0.33))


def dot(a: Column, b: Column) -> Column:
    pairs = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 where a vector has no length."""
    n = norm(a) * norm(b)
    return F.when(n == 0, F.lit(0.0)).otherwise(dot(a, b) / F.when(n != 0, n))


def unit(a: Column) -> Column:
    """The vector at length 1; null where it has none."""
    n = norm(a)
    return F.when(n > 0, F.transform(a, lambda x: x.cast("double") / n))


def truncate_unit(a: Column, size: int) -> Column:
    return unit(F.slice(a, 1, size))


def pack(arch: Column, reef: Column) -> Column:
    return F.shiftleft(arch.cast("long"), 16).bitwiseOR(reef.cast("long"))


def unpack(address: Column) -> tuple[Column, Column]:
    return F.shiftrightunsigned(address, 16), address.bitwiseAND(F.lit(65535).cast("long"))


def token_count(c: Column) -> Column:
    return F.when(F.trim(c) == "", 0).otherwise(F.size(F.split(F.trim(c), r"\s+")))


def category(c: Column) -> Column:
    """phrasal_verb: two or three words, the last one a particle; compound: other terms with a blank or an underscore; else single."""
    parts = F.split(F.trim(c), r"\s+")
    particle = F.lower(F.element_at(parts, -1)).isin(*PARTICLES)
    many = F.when(F.size(parts).isin(2, 3) & particle, "phrasal_verb").otherwise("compound")
    return F.when(F.contains(c, F.lit(" ")), many).when(F.contains(c, F.lit("_")), "compound").otherwise("single")


def pos_one_hot(pos: Column) -> Column:
    """1.0 at the place of noun, verb, adj or adv, 0.0 elsewhere; all 0.0 for another or none."""
    return F.array(*(F.when(pos == p, 1.0).otherwise(0.0) for p in ("noun", "verb", "adj", "adv")))


def normalize_name(c: Column) -> Column:
    return F.trim(F.lower(F.translate(c, "_", " ")))


#: First words of names of taxa.
TAXA = ("genus", "family", "order", "class", "phylum", "division", "kingdom", "suborder", "subclass", "subfamily")


def word_kind(c: Column, is_verb: Column, is_instance: Column) -> Column:
    """single, taxonomic, phrasal_verb, named_entity or compound, by the text and what a lexicon says of it."""
    taxon = F.lower(c).rlike(f"^({'|'.join(TAXA)}) ")
    return F.when(~F.contains(c, F.lit(" ")), "single").when(taxon, "taxonomic").when(is_verb, "phrasal_verb").when(is_instance, "named_entity").otherwise("compound")


def sense_texts(senses: DataFrame, prefix: str) -> DataFrame:
    """word_id, nth, text: prefix, word and sense, numbered by the senses' order; a sense equal to its word is left out."""
    rows = senses.where(F.lower("word") != F.lower("sense"))
    nth = F.row_number().over(Window.partitionBy("word_id").orderBy("sense"))
    return rows.select("word_id", nth.alias("nth"), F.concat(F.lit(prefix), "word", F.lit(": "), "sense").alias("text"))


def domain_texts(rows: DataFrame, prefix: str) -> DataFrame:
    """word_id, text: prefix, domain, word; a domain equal to its word is left out.  rows: word_id, word, domain."""
    domain = F.lower(F.translate("domain", "_", " "))
    return rows.where(domain != F.col("word")).select("word_id", F.concat(F.lit(prefix), domain, F.lit(" "), "word").alias("text"))


def hashed_vectors(rows: DataFrame, c: str, size: int) -> DataFrame:
    """c, i, x: each text's letter trigrams add plus or minus 1 at a hashed place; scaled to length 1, places of 0 left out.

    Texts are distinct.  Empty ones and null have no rows.
    """
    framed = F.concat(F.lit("<"), F.col(c), F.lit(">"))
    grams = F.transform(F.sequence(F.lit(1), F.length(framed) - 2), lambda i: F.substr(framed, i, F.lit(3)))
    hashed = rows.where(F.length(c) > 0).select(c, F.explode(grams).alias("gram")).select(c, F.conv(F.substring(F.md5("gram"), 1, 7), 16, 10).cast("long").alias("h"))
    sign = F.when(F.floor(F.col("h") / size) % 2 == 0, 1.0).otherwise(-1.0)
    sums = hashed.groupBy(c, (F.col("h") % size).alias("i")).agg(F.sum(sign).alias("s")).where("s <> 0")
    return sums.select(c, "i", (F.col("s") / F.sqrt(F.sum(F.col("s") * F.col("s")).over(Window.partitionBy(c)))).alias("x"))
