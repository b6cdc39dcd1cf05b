"""Seed vocabularies: linking, conflicts, island words, health, transfers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S


def link(seeds: DataFrame, words: DataFrame) -> DataFrame:
    """word_id of each seed by its lower-cased text; of words that share one, the largest id."""
    ids = words.groupBy(F.lower("word").alias("key")).agg(F.max("word_id").alias("word_id"))
    return seeds.withColumn("key", F.lower("word")).join(ids, "key", "left").drop("key")


def add_missing(linked: DataFrame, words: DataFrame) -> DataFrame:
    """Words for seeds of one token that have none, numbered after the largest id in the order of their texts."""
    top = words.agg(F.coalesce(F.max("word_id"), F.lit(0)).alias("top"))
    new = linked.where(F.col("word_id").isNull() & ~F.col("word").rlike("[ -]")).select(F.lower("word").alias("word")).distinct()
    # ranges of words are numbered apart and moved by the counts before them
    new = new.withColumn("head", F.substring("word", 1, 2))
    sizes = new.groupBy("head").agg(F.count(F.lit(1)).alias("n")).withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("head").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    nth = F.row_number().over(Window.partitionBy("head").orderBy("word"))
    return new.withColumn("nth", nth).join(sizes, "head").crossJoin(F.broadcast(top)).select((F.col("top") + F.col("before") + F.col("nth")).alias("word_id"), "word")


def linkage(linked: DataFrame, key: str = "source") -> DataFrame:
    return linked.groupBy(key).agg(F.count(F.lit(1)).alias("seeds"), F.count("word_id").alias("linked"))


def best_source(rows: DataFrame, key: list[str], order: list) -> DataFrame:
    """One row per key: the first in the order given."""
    return rows.withColumn("nth", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("nth = 1").drop("nth")


def dedupe_pairs(seeds: DataFrame, sims: DataFrame, ratio: float = 2.0) -> DataFrame:
    """(town_id, word_id) to delete of words in exactly two towns of an island.

    A town with more than `ratio` times the other's seeds loses the word; else the one whose centroid
    is farther, the smaller one on a tie; towns of equal size count in the order of their ids.
    sims: town_id, word_id, cos.
    """
    sizes = seeds.groupBy("town_id").agg(F.count(F.lit(1)).alias("size"))
    rows = seeds.join(sizes, "town_id").join(sims, ["town_id", "word_id"], "left")
    by = Window.partitionBy("island_id", "word_id")
    two = rows.withColumn("n", F.count(F.lit(1)).over(by)).where("n = 2").withColumn("nth", F.row_number().over(by.orderBy(F.desc("size"), "town_id")))
    pick = lambda c, k: F.max(F.when(F.col("nth") == k, F.col(c))).alias(f"{c}{k}")
    pairs = two.groupBy("island_id", "word_id").agg(*(pick(c, k) for c in ("town_id", "size", "cos") for k in (1, 2)))
    large = F.col("size1") / F.greatest(F.col("size2"), F.lit(1)) > ratio
    nearer = F.coalesce("cos1", F.lit(-1.0)) >= F.coalesce("cos2", F.lit(-1.0))
    return pairs.select(F.when(large, F.col("town_id1")).when(nearer, F.col("town_id2")).otherwise(F.col("town_id1")).alias("town_id"), "word_id", "island_id")


def island_promotion(predictions: DataFrame, towns: DataFrame) -> DataFrame:
    """(island, word) predicted for max(2, int(0.8 towns)) towns of an island of two towns or more."""
    sizes = towns.groupBy("island_id").agg(F.count(F.lit(1)).alias("towns")).where("towns >= 2")
    need = F.greatest(F.lit(2), F.floor(F.col("towns") * 0.8))
    hits = predictions.join(towns.select("town_id", "island_id"), "town_id").groupBy("island_id", "word_id").agg(F.countDistinct("town_id").alias("hits"))
    return hits.join(sizes, "island_id").where(F.col("hits") >= need).select("island_id", "word_id", "hits")


def starve_capitals(predictions: DataFrame, towns: DataFrame) -> DataFrame:
    """Predictions without the capitals' rows whose word another town of the island has.  towns: town_id, island_id, is_capital."""
    rows = predictions.join(towns.select("town_id", "island_id", "is_capital"), "town_id")
    siblings = rows.where("is_capital = 0").select("island_id", "word_id").distinct().withColumn("taken", F.lit(1))
    out = rows.join(siblings, ["island_id", "word_id"], "left")
    return out.where("is_capital = 0 or taken is null").select("town_id", "word_id", "score")


def island_health(facts: DataFrame, towns: DataFrame, islands: DataFrame) -> DataFrame:
    """2 x % of words in two islands or fewer + seeds a town / 10 + (100 - % of words in five or more); 0 without seeds.  Buckets count nowhere."""
    kept = F.broadcast(islands.where("is_bucket = 0").select("island_id"))  # a tier of the hierarchy
    facts, towns = facts.join(kept, "island_id"), towns.join(kept, "island_id")
    spread = facts.groupBy("word_id").agg(F.countDistinct("island_id").alias("k"))
    rows = facts.select("island_id", "town_id", "word_id").distinct().join(spread, "word_id")
    words = rows.groupBy("island_id").agg(F.count(F.lit(1)).alias("seeds"), F.countDistinct("word_id").alias("words"), F.countDistinct(F.when(F.col("k") <= 2, F.col("word_id"))).alias("own"), F.countDistinct(F.when(F.col("k") >= 5, F.col("word_id"))).alias("shared"))
    sizes = towns.groupBy("island_id").agg(F.count(F.lit(1)).alias("towns"))
    own, shared = F.col("own") * 100.0 / F.col("words"), F.col("shared") * 100.0 / F.col("words")
    score = 2 * own + F.col("seeds") / F.col("towns") / 10 + (F.lit(100.0) - shared)
    nought = lambda c, name: F.coalesce(c, F.lit(0.0)).alias(name)
    return sizes.join(words, "island_id", "left").select("island_id", "towns", F.coalesce("seeds", F.lit(0)).alias("seeds"), nought(own, "exclusive_pct"), nought(shared, "shared5_pct"), nought(score, "health"))


def consolidate(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """Rename domains by the mapping; of rows of a word that come together the source of highest priority stays, then the one already there."""
    moved = rows.join(mapping, "domain", "left")
    priority = F.element_at(F.create_map(*[F.lit(x) for p in (("curated", 5), ("wordnet", 4), ("claude", 3), ("pipeline", 2), ("xgboost", 1)) for x in p]), F.col("source"))
    out = moved.select(F.coalesce("new_domain", "domain").alias("domain"), "word", "source", F.col("new_domain").isNull().alias("old"), F.coalesce(priority, F.lit(0)).alias("priority"), F.col("domain").alias("was"))
    return best_source(out, ["domain", "word"], [F.desc("priority"), F.desc("old"), "was", "source"]).select("domain", "word", "source")


def transfer(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """Seeds of mapped domains; predicted ones only where domain and town have the same name."""
    same = S.normalize_name(F.col("domain")) == F.lower("town")
    return rows.join(mapping, "domain").where((F.col("source") != "xgboost") | same).select("town", "word").distinct()


def add_compounds(candidates: DataFrame, words: DataFrame) -> DataFrame:
    """Terms of several words that the vocabulary lacks, with word count and category."""
    rows = candidates.where(F.col("word").contains(" ")).select(F.lower(F.trim("word")).alias("word")).distinct()
    known = words.select(F.lower("word").alias("word"))
    return rows.join(known, "word", "left_anti").select("word", S.token_count(F.col("word")).alias("word_count"), F.lit("compound").alias("category"))
