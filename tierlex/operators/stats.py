"""Word spread, specificity, hierarchy rollups and other statistics of the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S


def word_spread(facts: DataFrame) -> DataFrame:
    """Distinct reefs, towns and islands of each word, and its best cosine."""
    return facts.groupBy("word_id").agg(F.countDistinct("reef_id").alias("reef_count"), F.countDistinct("town_id").alias("town_count"), F.countDistinct("island_id").alias("island_count"), F.max("cosine_sim").alias("best_sim"))


def word_stats(words: DataFrame, facts: DataFrame) -> DataFrame:
    """Every word with its spread (0 where it has no reef), specificity and floored idf over all reefs."""
    total = facts.agg(F.countDistinct("reef_id").alias("reefs"))
    out = words.join(word_spread(facts), "word_id", "left").crossJoin(F.broadcast(total))  # one row
    n = F.coalesce("reef_count", F.lit(0))
    spec = F.when(n > 0, S.specificity(n))
    return out.select("word_id", "word", "pos", n.alias("reef_count"), F.coalesce("town_count", F.lit(0)).alias("town_count"), F.coalesce("island_count", F.lit(0)).alias("island_count"), spec.cast("int").alias("specificity"), S.floored_idf(F.col("reefs"), n).alias("idf"))


def word_island_stats(facts: DataFrame) -> DataFrame:
    """Per word and island: reefs, towns, share of the word's reefs, mean cosine."""
    totals = word_spread(facts).select("word_id", "reef_count")
    each = facts.groupBy("word_id", "island_id").agg(F.countDistinct("reef_id").alias("reefs"), F.countDistinct("town_id").alias("towns"), F.avg("cosine_sim").alias("avg_cosine"))
    return each.join(totals, "word_id").select("word_id", "island_id", "reefs", "towns", (F.col("reefs") / F.col("reef_count")).alias("concentration"), "avg_cosine")


def bucketed(df: DataFrame, label, by) -> DataFrame:
    """Histogram by a label, with the share of all rows; `by` orders the labels."""
    counts = df.groupBy(label.alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.min(by).alias("first"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select("bucket", "n", F.round(F.col("n") * 100.0 / F.col("total"), 4).alias("pct"), "first").orderBy("first")


def spread_label(n):
    return F.when(n == 0, "0").when(n == 1, "1").when(n.between(2, 3), "2-3").when(n.between(4, 5), "4-5").when(n.between(6, 10), "6-10").when(n.between(11, 20), "11-20").otherwise("21+")


def _profile(rows: DataFrame, key: list[str], count: str) -> DataFrame:
    frac = lambda p: F.avg(F.when(F.col("pos") == p, 1.0).otherwise(0.0)).alias(f"{p}_frac")
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias(count), *map(frac, ("noun", "verb", "adj", "adv")), F.avg("specificity").alias("avg_specificity"))


def reef_rollup(facts: DataFrame, stats: DataFrame) -> DataFrame:
    rows = facts.select("reef_id", "word_id", "is_core").join(stats.select("word_id", "pos", "specificity"), "word_id")
    core = rows.groupBy("reef_id").agg(F.sum("is_core").alias("core_count"))
    return _profile(rows, ["reef_id"], "word_count").join(core, "reef_id")


def tier_rollup(facts: DataFrame, stats: DataFrame, tier: str) -> DataFrame:
    """Town or island: every word once; reef (and town) counts come from the words' representative rows, the least ones."""
    aggs = [F.min("reef_id").alias("reef_id"), F.min("town_id").alias("rep_town")]
    once = facts.groupBy(tier, "word_id").agg(*aggs).join(stats.select("word_id", "pos", "specificity"), "word_id")
    counts = once.groupBy(tier).agg(F.countDistinct("reef_id").alias("reef_count"), F.countDistinct("rep_town").alias("town_count"))
    return _profile(once, [tier], "word_count").join(counts, tier)


def archipelago_rollup(archs: DataFrame, islands: DataFrame, towns: DataFrame, facts: DataFrame) -> DataFrame:
    """Counts of each archipelago's islands, towns, reefs and words; 0 for an empty one."""
    a = islands.groupBy("arch_id").agg(F.count(F.lit(1)).alias("island_count"))
    b = towns.join(F.broadcast(islands.select("island_id", "arch_id")), "island_id").groupBy("arch_id").agg(F.count(F.lit(1)).alias("town_count"))
    c = facts.groupBy("arch_id").agg(F.countDistinct("reef_id").alias("reef_count"), F.countDistinct("word_id").alias("word_count"))
    out = archs
    for part in (a, b, c):
        out = out.join(part, "arch_id", "left")
    return out.na.fill(0, ["island_count", "town_count", "reef_count", "word_count"])


def source_quality(facts: DataFrame) -> DataFrame:
    """1.0 for curated core, 0.9 for predicted core, 0.7 for the rest."""
    quality = F.when((F.col("source") != "xgboost") & (F.col("is_core") == 1), 1.0).when(F.col("is_core") == 1, 0.9).otherwise(0.7)
    return facts.withColumn("source_quality", quality)


def island_idf(facts: DataFrame) -> DataFrame:
    """log2(reefs of the island / reefs of the word in it)."""
    whole = facts.groupBy("island_id").agg(F.countDistinct("reef_id").alias("total"))
    mine = facts.groupBy("island_id", "word_id").agg(F.countDistinct("reef_id").alias("mine"))
    return mine.join(whole, "island_id").select("island_id", "word_id", F.log2(F.col("total") / F.col("mine")).alias("island_idf"))


def dim_stats(vectors: DataFrame, sigmas: float = 2.0) -> DataFrame:
    """Mean, population deviation and members beyond mean + sigmas deviations of each dimension."""
    long = vectors.select(F.posexplode("v").alias("dim_id", "x"))
    moments = long.groupBy("dim_id").agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"), F.count(F.lit(1)).alias("total"))
    over = long.join(F.broadcast(moments), "dim_id").where(F.col("x") > F.col("mean") + sigmas * F.col("std")).groupBy("dim_id").agg(F.count(F.lit(1)).alias("members"))  # one row a dimension
    n = F.coalesce("members", F.lit(0))
    return moments.join(over, "dim_id", "left").select("dim_id", "mean", "std", (F.col("mean") + sigmas * F.col("std")).alias("threshold"), n.alias("member_count"), (n / F.col("total")).alias("selectivity"))


def cumulative(counts: DataFrame, key: str, n: str) -> DataFrame:
    """Running total over a small histogram."""
    return counts.withColumn("cumulative", F.sum(n).over(Window.orderBy(key).rowsBetween(Window.unboundedPreceding, 0)))
