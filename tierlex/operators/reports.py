"""Reports and selections over towns, predictions and seeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import prune
from .learn import order_key

#: F1 below which a town's classifier is weak; words and towns that a sample of siblings shows.
LOW_F1, SAMPLE_WORDS, SAMPLE_TOWNS = 0.75, 15, 5


def prune_summary(predictions: DataFrame, threshold: float = prune.LEAST) -> DataFrame:
    """One row: rows before the adjustment, after it, pruned, and their share in percent."""
    rows = prune.idf_adjusted(predictions)
    n = rows.agg(F.count(F.lit(1)).alias("before"), F.count_if(F.col("adjusted") >= threshold).alias("after"))
    return n.select("before", "after", (F.col("before") - F.col("after")).alias("pruned"), (F.try_divide((F.col("before") - F.col("after")) * F.lit(100.0), F.col("before"))).alias("pruned_pct"))


def prune_samples(predictions: DataFrame, threshold: float = prune.LEAST, pruned: int = 30, kept: int = 20) -> DataFrame:
    """For each town the pruned words of the highest raw scores, and the kept ones of the lowest adjusted scores."""
    rows = prune.idf_adjusted(predictions).withColumn("fate", F.when(F.col("adjusted") < threshold, "pruned").otherwise("kept"))
    by = F.when(F.col("fate") == "pruned", -F.col("score")).otherwise(F.col("adjusted"))
    nth = F.row_number().over(Window.partitionBy("town_id", "fate").orderBy(by, "word_id"))
    return rows.withColumn("nth", nth).where(F.col("nth") <= F.when(F.col("fate") == "pruned", pruned).otherwise(kept)).select("town_id", "fate", "nth", "word_id", "score", "adjusted", "n")


def most_ubiquitous(predictions: DataFrame, least: int = 10, k: int = 30) -> DataFrame:
    """The words predicted for the most towns, `least` at the least, with the mean and least score."""
    rows = predictions.groupBy("word_id").agg(F.countDistinct("town_id").alias("n_towns"), F.avg("score").alias("avg_score"), F.min("score").alias("min_score"))
    return rows.where(F.col("n_towns") >= least).orderBy(F.desc("n_towns"), "word_id").limit(k)


def reef_spread(facts: DataFrame, stop: DataFrame, k: int = 20) -> DataFrame:
    """The words in the most islands, then towns, stop words left out.  stop: word_id."""
    rows = facts.join(stop, "word_id", "left_anti").groupBy("word_id").agg(F.countDistinct("town_id").alias("n_towns"), F.countDistinct("island_id").alias("n_islands"))
    return rows.orderBy(F.desc("n_islands"), F.desc("n_towns"), "word_id").limit(k)


def targets(towns: DataFrame, islands: DataFrame, archs: DataFrame, keep: Column | None = None) -> DataFrame:
    """town_id, town, island, archipelago of the towns that `keep` chooses; it may name any column of towns, and island, is_bucket."""
    rows = towns.join(F.broadcast(islands.select("island_id", "island", "arch_id", "is_bucket")), "island_id").join(F.broadcast(archs), "arch_id")  # tiers of the hierarchy
    return (rows if keep is None else rows.where(keep)).select("town_id", "town", "island", F.col("arch").alias("archipelago"))


def unseeded(towns: DataFrame, islands: DataFrame, archs: DataFrame, seeds: DataFrame) -> DataFrame:
    """Towns without any seed."""
    return targets(towns.join(seeds.select("town_id").distinct(), "town_id", "left_anti"), islands, archs)


def dead(towns: DataFrame, islands: DataFrame, archs: DataFrame, sizes: DataFrame) -> DataFrame:
    """Topical towns without words.  sizes: town_id, word_count."""
    return targets(towns.join(sizes.select("town_id", "word_count"), "town_id", "left"), islands, archs, (F.col("is_bucket") == 0) & (F.coalesce("word_count", F.lit(0)) == 0))


def low_f1(towns: DataFrame, islands: DataFrame, archs: DataFrame, scores: DataFrame, threshold: float = LOW_F1) -> DataFrame:
    """Topical towns whose classifier has an F1 below the threshold, with it.  scores: town_id, model_f1."""
    return targets(towns.join(scores.where(F.col("model_f1") < threshold).select("town_id"), "town_id"), islands, archs, F.col("is_bucket") == 0).join(scores.select("town_id", "model_f1"), "town_id")


def sibling_samples(seeds: DataFrame, towns: DataFrame, words: int = SAMPLE_WORDS, most: int = SAMPLE_TOWNS) -> DataFrame:
    """For each island its first towns by name that have core seeds, each with its first core words.  seeds: town_id, word, confidence."""
    core = seeds.where("confidence = 'core'").join(towns, "town_id").groupBy("island_id", "town_id", "town")
    rows = core.agg(F.slice(F.array_sort(F.collect_set("word")), 1, words).alias("w"))
    nth = F.row_number().over(Window.partitionBy("island_id").orderBy("town", "town_id"))
    return rows.withColumn("nth", nth).where(F.col("nth") <= most).select("island_id", "nth", "town", F.array_join("w", ", ").alias("words"))


def compound_check(words: DataFrame, seeds: DataFrame, towns: DataFrame, islands: DataFrame, source: str) -> DataFrame:
    """metric and n: compounds among the words, seeds of the source, those without embedding, and the seeds of each island.

    words: word_id, category, word_count, embedded; seeds: town_id, word_id, source.
    """
    mine = seeds.where(F.col("source") == source)
    one = lambda rows, name: rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("metric"), "n")
    per = mine.join(towns, "town_id").join(F.broadcast(islands), "island_id").groupBy("island").agg(F.count(F.lit(1)).alias("n")).select(F.concat(F.lit("island "), "island").alias("metric"), "n")
    out = one(words.where("category = 'compound' and word_count > 1"), "compounds").unionByName(one(mine, "seeds"))
    return out.unionByName(one(mine.join(words.where("not embedded"), "word_id"), "without embedding")).unionByName(per)


def accepted(predictions: DataFrame, seeds: DataFrame, buckets: DataFrame, stop: DataFrame, threshold: float = prune.LEAST) -> DataFrame:
    """Predictions that reach the threshold and are no seed of their town, no bucket's word and no stop word."""
    rows = predictions.where(F.col("score") >= threshold).join(seeds.select("town_id", "word_id").distinct(), ["town_id", "word_id"], "left_anti")
    return rows.join(buckets.select("word_id").distinct(), "word_id", "left_anti").join(stop.select("word_id").distinct(), "word_id", "left_anti")


def core_words(seeds: DataFrame, predictions: DataFrame, capitals: DataFrame, threshold: float) -> DataFrame:
    """For each word its towns, by seed or by a prediction of the threshold or more, and those of them that are capitals."""
    rows = seeds.select("town_id", "word_id").union(predictions.where(F.col("score") >= threshold).select("town_id", "word_id")).distinct().join(capitals.select("town_id", F.lit(1).alias("cap")), "town_id", "left")
    return rows.groupBy("word_id").agg(F.count(F.lit(1)).alias("towns"), F.count("cap").alias("capitals"))


def random_words(words: DataFrame, k: int = 10) -> DataFrame:
    """k words in a seeded order."""
    return words.orderBy(order_key(F.col("word_id").cast("string")), "word_id").limit(k)


def promote_island_words(predictions: DataFrame, towns: DataFrame, hits: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(island words, predictions): words predicted for enough towns are added to the island's, but where they are known, and taken out of its towns' predictions.

    hits: island_id, word_id, see `seeds.island_promotion`; known: island_id, word_id, source.
    """
    new = hits.select("island_id", "word_id").join(known, ["island_id", "word_id"], "left_anti").withColumn("source", F.lit("xgboost_filter"))
    left = predictions.join(towns.select("town_id", "island_id"), "town_id", "left").join(hits.select("island_id", "word_id"), ["island_id", "word_id"], "left_anti")
    return known.select("island_id", "word_id", "source").unionByName(new), left.select("town_id", "word_id", "score")


def best_scores(rows: DataFrame, reefs: DataFrame) -> DataFrame:
    """domain, word_id, reef_id, centroid_sim, n_word_domains, idf, source_quality, score: the best source of each pair, with its reef, or reef -1 and similarity 0.8.

    rows: domain, word_id, source_quality; reefs: domain, word_id, reef_id, centroid_sim.
    """
    best = rows.groupBy("domain", "word_id").agg(F.max("source_quality").alias("source_quality"))
    n = rows.groupBy("word_id").agg(F.countDistinct("domain").alias("n_word_domains"))
    total = rows.agg(F.countDistinct("domain").alias("total"))
    out = best.join(n, "word_id").crossJoin(F.broadcast(total)).join(reefs, ["domain", "word_id"], "left")  # one row
    sim, idf = F.coalesce("centroid_sim", F.lit(0.8)), F.log2(F.col("total") / F.col("n_word_domains"))
    return out.select("domain", "word_id", F.coalesce("reef_id", F.lit(-1)).alias("reef_id"), sim.alias("centroid_sim"), "n_word_domains", idf.alias("idf"), "source_quality", (idf * F.col("source_quality") * sim).alias("score"))


def domain_leaderboard(scores: DataFrame, asked: DataFrame, k: int = 10) -> DataFrame:
    """query, place, domain, total: the k domains of the largest sums of scores over a query's words.  asked: query, word_id."""
    sums = asked.distinct().join(scores, "word_id").groupBy("query", "domain").agg(F.sum("score").alias("total"))
    nth = F.row_number().over(Window.partitionBy("query").orderBy(F.desc(F.round("total", 9)), "domain"))
    return sums.withColumn("place", nth).where(F.col("place") <= k).select("query", "place", "domain", "total")
