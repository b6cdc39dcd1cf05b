"""Records of both export formats, as DataFrames; `sources.sinks` writes them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S

#: Scales of the exported numbers, and what stands for a quality that isn't computed.
IDF_SCALE, WEIGHT_SCALE, PLACEHOLDER = 21, 255.0, 128
#: Archipelago that a domain without one is sorted by.
NO_ARCH = 999
#: Kinds of words that are looked for as compounds.
COMPOUND_KINDS = ("compound", "phrasal_verb", "named_entity", "taxonomic")


def _number(rows: DataFrame, parent: str, order: list, name: str) -> DataFrame:
    """Contiguous numbers from 0 by parent, then by `order`: numbered within each parent and moved by the counts of those before."""
    sizes = rows.groupBy(parent).agg(F.count(F.lit(1)).alias("_k")).withColumn("_before", F.coalesce(F.sum("_k").over(Window.orderBy(parent).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    nth = F.row_number().over(Window.partitionBy(parent).orderBy(*order)) - 1
    return rows.withColumn("_nth", nth).join(sizes.select(parent, "_before"), parent).withColumn(name, (F.col("_nth") + F.col("_before")).cast("int")).drop("_nth", "_before")


def export_ids(archs: DataFrame, islands: DataFrame, towns: DataFrame, reefs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Contiguous ids (arch, island_no, town_no, reef_no) of topical islands and what is in them, each tier in the order of its own ids; towns and reefs are numbered by ranges."""
    a = archs.withColumn("arch", F.row_number().over(Window.orderBy("arch_id")).cast("int") - 1)  # the top tiers, a few rows
    i = islands.where("is_bucket = 0").join(F.broadcast(a.select("arch_id", "arch")), "arch_id").withColumn("island_no", F.row_number().over(Window.orderBy("island_id")).cast("int") - 1)
    t = _number(towns.join(i.select("island_id", "island_no"), "island_id").withColumn("_range", F.floor(F.col("town_id") / 1000)), "_range", ["town_id"], "town_no").drop("_range")
    r = _number(reefs.join(t.select("town_id", "town_no"), "town_id").withColumn("_range", F.substring("reef_id", 1, 2)), "_range", ["reef_id"], "reef_no").drop("_range")
    return a, i, t, r


def meta(ids: DataFrame, rollup: DataFrame, key: str, no: str, parent: str, name, quality: str | None = None, fractions: bool = False) -> DataFrame:
    """One record a group: number, parent's number, name, n_words and rounded means; groups without words have 0.  quality: name of the placeholder."""
    rows = ids.join(rollup, key, "left")
    rounded = lambda c: F.round(F.coalesce(F.col(c), F.lit(0.0)), 4).alias(c)
    more = [F.lit(PLACEHOLDER).alias(quality)] if quality else []
    fracs = [rounded(f"{p}_frac") for p in ("noun", "verb", "adj", "adv")] if fractions else []
    return rows.select(F.col(no), F.col(parent), F.coalesce(name, F.lit("")).alias("name"), F.coalesce("word_count", F.lit(0)).cast("long").alias("n_words"), *more, rounded("avg_specificity"), *fracs)


def compounds(words: DataFrame) -> DataFrame:
    """Words of several words that aren't stop words.  words: word_id, word, word_count, is_stop."""
    return words.where("word_count > 1 and is_stop = 0").select("word", "word_id")


def legacy_compounds(words: DataFrame) -> DataFrame:
    """Words with a blank of four kinds.  words: word_id, word, category."""
    return words.where(F.col("category").isin(*COMPOUND_KINDS) & F.contains("word", F.lit(" "))).select("word", "word_id")


def word_lookup(words: DataFrame, variants: DataFrame) -> DataFrame:
    """hash, word_hash, word_id, specificity, idf_q: one word for each hash; base before morphy before snowball, then higher specificity, then lower id.

    words: word_id, word_hash, specificity, idf; each is a base form of itself.  variants: hash, word_id, source.
    """
    of = words.select("word_id", "word_hash", F.coalesce("specificity", F.lit(0)).alias("specificity"), S.quantize_idf(F.col("idf"), float(IDF_SCALE)).alias("idf_q"))
    every = words.select(F.col("word_hash").alias("hash"), "word_id", F.lit(0).alias("rank")).unionByName(variants.select("hash", "word_id", F.when(F.col("source") == "base", 0).when(F.col("source") == "morphy", 1).otherwise(2).alias("rank")))
    order = Window.partitionBy("hash").orderBy("rank", F.desc("specificity"), "word_id")
    return every.join(of, "word_id").withColumn("nth", F.row_number().over(order)).where("nth = 1").select("hash", "word_hash", "word_id", "specificity", "idf_q")


def snowball_variants(words: DataFrame, variants: DataFrame, stem, hashed) -> DataFrame:
    """hash, word_id, source of stems that no variant has: single words' stems first, then those of morphy variants, the first word of a stem's hash.

    words: word_id, word; variants: variant, word_id, source; stem and hashed: column functions.
    """
    single = words.where(~F.contains("word", F.lit(" "))).select(F.lit(0).alias("turn"), "word_id", F.col("word").alias("form"))
    morphy = variants.where("source = 'morphy'").where(~F.contains("variant", F.lit(" "))).select(F.lit(1).alias("turn"), "word_id", F.col("variant").alias("form"))
    stems = single.unionByName(morphy).withColumn("stem", stem(F.col("form"))).where("stem <> form").withColumn("hash", hashed(F.col("stem")))
    free = stems.join(variants.select(hashed(F.col("variant")).alias("hash")).distinct(), "hash", "left_anti")
    order = Window.partitionBy("hash").orderBy("turn", "word_id", "form")
    return free.withColumn("nth", F.row_number().over(order)).where("nth = 1").select("hash", "word_id", F.lit("snowball").alias("source"))


def sparse(entries: DataFrame, *columns: str) -> DataFrame:
    """word_id and the sorted list of its entries; words without entries have no row."""
    return entries.groupBy("word_id").agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("entries"))


def constants(islands: DataFrame, towns: DataFrame, reefs: DataFrame, archs: DataFrame, domainless: DataFrame, town_domainless: DataFrame, bucket_only: DataFrame, buckets: DataFrame) -> DataFrame:
    """One row: counts, scales, words of each island and town by number, and lists of ids.  Lists hold one value a group of the hierarchy, or a word."""
    count = lambda d, name: d.agg(F.count(F.lit(1)).alias(name))
    sizes = lambda d, no, name: d.agg(F.transform(F.array_sort(F.collect_list(F.struct(no, "n_words"))), lambda s: s["n_words"]).alias(name))
    ids = lambda d, name: d.agg(F.array_sort(F.collect_set("word_id")).alias(name))
    parts = [
        count(islands, "N_ISLANDS"), count(towns, "N_TOWNS"), count(reefs, "N_REEFS"), count(archs, "N_ARCHS"),
        sizes(islands, "island_no", "island_n_words"), sizes(towns, "town_no", "town_n_words"),
        ids(domainless, "domainless_word_ids"), ids(town_domainless, "town_domainless_word_ids"), ids(bucket_only, "bucket_only_word_ids"),
        buckets.agg(F.array_sort(F.collect_list("island")).alias("bucket_island_names")),
    ]
    out = reduce(lambda a, b: a.crossJoin(F.broadcast(b)), parts)  # one row each
    return out.withColumn("IDF_SCALE", F.lit(IDF_SCALE)).withColumn("WEIGHT_SCALE", F.lit(WEIGHT_SCALE)).withColumn("FNV1A_OFFSET", F.lit(str(S.FNV_BASIS))).withColumn("FNV1A_PRIME", F.lit(str(S.FNV_PRIME)))


def legacy_domains(scores: DataFrame, words: DataFrame, archs: DataFrame) -> DataFrame:
    """The older export's records: domain_no, hierarchy_addr, arch, name, n_words, valence, avg_specificity and fractions of each domain.

    Domains go by archipelago number (those without one last, though their record says 0) and name.
    scores: domain, word_id, n_word_domains; words: word_id, pos; archs: domain, arch_id (below 0: none).
    """
    known = archs.where("arch_id >= 0")
    remap = known.select("arch_id").distinct().withColumn("arch", F.row_number().over(Window.orderBy("arch_id")) - 1)  # the top tier
    frac = lambda p: F.coalesce(F.avg(F.when(F.col("pos") == p, 1.0).when(F.col("pos").isNotNull(), 0.0)), F.lit(0.0)).alias(f"{p}_frac")
    spec = F.avg(F.when(F.col("n_word_domains") <= 3, 2).when(F.col("n_word_domains") <= 10, 1).when(F.col("n_word_domains") <= 50, 0).when(F.col("n_word_domains") <= 150, -1).otherwise(-2))
    rows = scores.join(words.select("word_id", "pos"), "word_id", "left").groupBy("domain").agg(F.count(F.lit(1)).alias("n_words"), spec.alias("avg_specificity"), *map(frac, ("noun", "verb", "adj", "adv")))
    rows = rows.join(known.join(F.broadcast(remap), "arch_id").select("domain", "arch"), "domain", "left").withColumn("turn", F.coalesce("arch", F.lit(NO_ARCH)))
    out = _number(rows, "turn", ["domain"], "domain_no").withColumn("arch", F.coalesce("arch", F.lit(0)).cast("int"))
    return out.select("domain_no", S.pack(F.col("arch"), F.col("domain_no")).alias("hierarchy_addr"), "arch", F.col("domain").alias("name"), "n_words", F.lit(0.0).alias("valence"), "avg_specificity", "noun_frac", "verb_frac", "adj_frac", "adv_frac")


def legacy_words(words: DataFrame, scores: DataFrame) -> DataFrame:
    """word_id, word, specificity, idf_q, word_count of every word; idf and number of domains from any of its rows (they are the same), 0 without one.

    words: word_id, word; scores: word_id, idf, n_word_domains.
    """
    one = scores.groupBy("word_id").agg(F.min("idf").alias("idf"), F.min("n_word_domains").alias("n"))
    n = F.coalesce("n", F.lit(0))
    return words.join(one, "word_id", "left").select("word_id", "word", S.domain_specificity(n).cast("int").alias("specificity"), S.quantize_idf(F.col("idf"), float(IDF_SCALE)).alias("idf_q"), F.greatest(S.token_count(F.col("word")), F.lit(0)).alias("word_count"))
