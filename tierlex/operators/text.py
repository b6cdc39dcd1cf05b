"""Scoring of texts, variants, co-occurrence and rank agreement."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import kept


def pmi(members: DataFrame, group: str, word: str) -> DataFrame:
    """Positive pointwise mutual information of pairs of groups that share words; probabilities are over all words."""
    total = members.agg(F.countDistinct(word).alias("total"))
    single = members.groupBy(group).agg(F.countDistinct(word).alias("n"))
    m = members.select(group, word).distinct()
    pairs = m.withColumnRenamed(group, "a").join(m.withColumnRenamed(group, "b"), word).where("a < b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n_both"))
    out = pairs.join(single.select(F.col(group).alias("a"), F.col("n").alias("na")), "a").join(single.select(F.col(group).alias("b"), F.col("n").alias("nb")), "b").crossJoin(F.broadcast(total))  # one row
    value = F.log2((F.col("n_both") * F.col("total").cast("double")) / (F.col("na") * F.col("nb").cast("double")))
    return out.select("a", "b", "n_both", value.alias("pmi")).where("pmi > 0")


#: Entries (group and weight) of all distinct lists of weights up to which these are broadcast, 16 bytes each.
ENTRIES = 2_000_000


def by_token(weights: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Each token with the number of its list of weights; the distinct lists, as numbers of groups and weights; and the groups by number, null among them."""
    groups = kept(weights.select("grp").distinct().withColumn("g", F.monotonically_increasing_id()))
    coded = weights.join(groups.withColumnRenamed("grp", "name"), F.col("grp").eqNullSafe(F.col("name")))
    each = kept(coded.groupBy("token").agg(F.array_sort(F.collect_list(F.struct("g", "weight"))).alias("all")))
    lists = kept(each.select("all").distinct().withColumn("list", F.monotonically_increasing_id()))
    return kept(each.join(lists, "all").select("token", "list")), lists.select("list", F.col("all.g").alias("gs"), F.col("all.weight").alias("ws")), groups


def group_sums(tokens: DataFrame, numbered: DataFrame, lists: DataFrame, groups: DataFrame) -> DataFrame:
    """doc_id, grp, s, n: sum of the weights of a text's words by group, and how many words have one there; see `by_token`.

    A word goes to its text with the number of its list, and there meets the lists, which are broadcast up to
    ENTRIES and else joined before.  Batches of texts in order are summed as arrays, so what is shuffled is a row
    a word of a text and a row or two a text and group, not words times groups.
    """
    whole = dict(lists.dtypes)["ws"] in ("array<smallint>", "array<int>", "array<bigint>")

    def added(batches):
        for b in batches:
            doc, gs = b.column(0).dictionary_encode("encode"), b.column(2)
            g, at = np.unique(gs.flatten().to_numpy(), return_inverse=True)
            sizes = gs.value_lengths().to_numpy()
            key = np.repeat(doc.indices.to_numpy().astype(np.int64), sizes) * len(g) + at
            k = np.repeat(b.column(1).to_numpy(), sizes)
            cells, at = np.unique(key, return_inverse=True)
            s = np.bincount(at, b.column(3).flatten().fill_null(0).to_numpy() * k.astype(np.float64))
            found = [doc.dictionary.take(pa.array(cells // max(len(g), 1))), pa.array(g[cells % max(len(g), 1)]), pa.array(s), pa.array(np.bincount(at, k).astype(np.int64))]
            yield pa.RecordBatch.from_arrays(found, ["doc_id", "g", "s", "n"])

    entries = lists.agg(F.coalesce(F.sum(F.size("gs")), F.lit(0))).first()[0]
    rows = tokens.join(numbered, "token").select("doc_id", "list").repartition("doc_id").groupBy("doc_id", "list").agg(F.count(F.lit(1)).alias("k"))
    if entries <= ENTRIES:
        rows = rows.sortWithinPartitions("doc_id").join(F.broadcast(lists), "list")
    else:
        rows = rows.join(lists, "list").repartition("doc_id").sortWithinPartitions("doc_id")
    each = rows.select("doc_id", "k", "gs", "ws").mapInArrow(added, f"doc_id {dict(tokens.dtypes)['doc_id']}, g long, s double, n long")
    sums = each.groupBy("doc_id", "g").agg(F.sum("s").cast("long" if whole else "double").alias("s"), F.sum("n").alias("n"))
    return sums.join(groups, "g").drop("g")


def scored(sums: DataFrame, background: DataFrame) -> DataFrame:
    score = F.col("s") / 255.0
    return sums.join(background, "grp").select("doc_id", "grp", F.col("n").alias("n_words"), score.alias("score"), ((score - F.col("mean")) / F.greatest("std", F.lit(1e-6))).alias("z"))


def text_scores(tokens: DataFrame, weights: DataFrame, background: DataFrame) -> DataFrame:
    """Sum of weight / 255 of a text's distinct words by group, and its z-score against the background."""
    return scored(group_sums(tokens, *by_token(weights)), background)


def trace(tokens: DataFrame, weights: DataFrame, k: int = 3) -> DataFrame:
    """The k best groups of each text with what each word gave; alone: a group that one word made.

    Words meet all groups once, for the sums; after that only the k best of their text.
    """
    top = group_sums(tokens, *by_token(weights)).withColumn("nth", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("s"), "grp"))).where(F.col("nth") <= k)
    top = kept(top)
    return tokens.join(top, "doc_id").join(weights, ["token", "grp"]).select("doc_id", "grp", "token", "weight", "nth", (F.col("n") == 1).alias("alone"))


def compounds_in(tokens: DataFrame, compounds: DataFrame) -> DataFrame:
    """Pairs of neighbouring tokens that are known compounds.  tokens: doc_id, pos, token."""
    nxt = tokens.select("doc_id", (F.col("pos") - 1).alias("pos"), F.col("token").alias("token2"))
    return tokens.join(nxt, ["doc_id", "pos"]).select("doc_id", "pos", F.concat_ws(" ", "token", "token2").alias("compound")).join(compounds, "compound", "left_semi")


#: Words of a block of texts, on average; its texts and the compounds that stand in them are a unit of work.
BLOCK_WORDS = 400_000


def runs_of_letters(c: str):
    """A text's words, lower-cased, as an array."""
    return F.regexp_extract_all(F.lower(c), F.lit("(\\p{L}+)"), 1)


def runs_of_words(words, size: int):
    """All runs of so many words, joined by blanks, as an array."""
    at = F.when(F.size(words) >= size, F.sequence(F.lit(1), F.size(words) - (size - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.array_join(F.slice(words, i, size), " "))


def once_each(docs: DataFrame, arrays, name: str, id_col: str = "doc_id") -> DataFrame:
    """name, n: in how many documents each entry of an array stands.  Where no id is repeated, documents are counted before anything is shuffled."""
    each = docs.select(id_col, F.explode(F.array_distinct(arrays)).alias(name))
    if docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count():
        each = each.distinct()
    return each.groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def matched_terms(docs: DataFrame, compounds: DataFrame, stop: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, token, n: how often each term stands in a text: known compounds, the longest first from left to right, else single words; stop words are left out.

    compounds: compound, lower-cased words joined by blanks, any number of them; stop: word.  A text's words
    are its runs of letters, lower-cased; null texts have none.  Texts go in blocks; a block asks once for each of its
    runs of words, by hash, and gets those that are compounds, so places of texts aren't shuffled.  A text has to fit a task.
    """
    kind = dict(docs.dtypes)[id_col]
    known = compounds.select("compound").where("compound is not null").distinct()
    sizes = sorted((r.n for r in known.select(F.size(F.split("compound", " ")).alias("n")).distinct().collect() if r.n > 1), reverse=True)  # a row a length
    words = docs.select(F.col(id_col).alias("doc_id"), runs_of_letters(text_col).alias("words")).where("doc_id is not null and size(words) > 0")
    blocks = -(-(words.agg(F.sum(F.size("words"))).first()[0] or 1) // BLOCK_WORDS)
    texts = words.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks))).repartition("block")
    runs = F.flatten(F.array(*[runs_of_words(F.col("words"), n) for n in sizes])) if sizes else F.array().cast("array<string>")
    asked = texts.select("block", F.explode(F.array_distinct(F.transform(runs, lambda x: F.xxhash64(x)))).alias("h")).distinct()
    here = asked.join(known.select(F.xxhash64("compound").alias("h"), "compound"), "h").select(F.col("block").alias("at"), "compound")

    def walk(texts: pd.DataFrame, here: pd.DataFrame) -> pd.DataFrame:
        mine, count = set(here["compound"]), Counter()
        first = {c[: c.index(" ")] for c in mine}
        for doc, words in zip(texts["doc_id"].tolist(), texts["words"]):
            words, i = list(words), 0
            while i < len(words):
                term, size = words[i], 1
                if term in first:
                    for n in sizes:
                        run = " ".join(words[i : i + n])
                        if i + n <= len(words) and run in mine:
                            term, size = run, n
                            break
                count[doc, term] += 1
                i += size
        return pd.DataFrame([(doc, term, n) for (doc, term), n in count.items()], columns=["doc_id", "token", "n"])

    terms = texts.groupBy("block").cogroup(here.groupBy("at")).applyInPandas(walk, f"doc_id {kind}, token string, n long")
    return terms.join(stop.select(F.col("word").alias("token")), "token", "left_anti").select("doc_id", "token", "n")


def score_texts(docs: DataFrame, compounds: DataFrame, stop: DataFrame, weights: DataFrame, background: DataFrame, text_col: str = "text") -> DataFrame:
    """From texts to scores: doc_id, grp, n_words, score and z of each text's distinct terms, compounds among them and stop words not; see `matched_terms` and `text_scores`."""
    return text_scores(matched_terms(docs, compounds, stop, text_col=text_col).select("doc_id", "token"), weights, background)


def rank_agreement(a: DataFrame, b: DataFrame, key: str, item: str, k: int = 10) -> DataFrame:
    """Spearman's rho over the items that both rankings have (null where one ranks them all alike), and how many of the first k they share."""
    both = a.select(key, item, F.col("score").alias("x")).join(b.select(key, item, F.col("score").alias("y")), [key, item])

    def average_rank(c):
        w = Window.partitionBy(key).orderBy(F.desc(c))
        return F.rank().over(w) + (F.count(F.lit(1)).over(Window.partitionBy(key, c)) - 1) / 2.0

    ranked = both.withColumn("rx", average_rank("x")).withColumn("ry", average_rank("y"))
    first = lambda c: F.row_number().over(Window.partitionBy(key).orderBy(F.desc(c), item)) <= k
    ranked = ranked.withColumn("top", (first("x") & first("y")).cast("int"))
    return ranked.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.try_divide(F.covar_pop("rx", "ry"), F.stddev_pop("rx") * F.stddev_pop("ry")).alias("rho"), F.sum("top").alias("overlap")).where("n >= 3")


def variants(tokens: DataFrame) -> DataFrame:
    """variant, base and source: the token itself, and what is left without s, ed or ing where that is a token too."""
    base = tokens.select(F.col("token").alias("variant"), F.col("token").alias("base"), F.lit("base").alias("source"))
    cut = tokens.select(F.col("token").alias("variant"), F.regexp_replace("token", "(ing|ed|s)$", "").alias("base")).where("variant <> base and length(base) >= 2")
    return base.unionByName(cut.join(tokens.select(F.col("token").alias("base")), "base", "left_semi").select("variant", "base", F.lit("snowball").alias("source")))
