"""Promotion of every word to one export level, and the 8-bit weights of the three levels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from .stats import source_quality

#: Blend of the member's own similarity, the group's name and the island's name; floor of the quality.
OWN, NAME, ISLAND, FLOOR = 0.5, 0.2, 0.3, 0.9
#: Share of the global range in island weights.
GLOBAL = 0.8


def export_level(facts: DataFrame, stats: DataFrame) -> DataFrame:
    """reef, town or island for every word of the facts.

    Specificity 0 or more: the reef if the word has one town, else the town, or the island at 0.  Below
    0, or unknown: the island, but the reef at -1 if no island has two reefs of the word.
    """
    per_island = facts.groupBy("word_id", "island_id").agg(F.countDistinct("reef_id").alias("k")).groupBy("word_id").agg(F.max("k").alias("most"))
    s = F.col("specificity")
    low = F.when((s == -1) & (F.col("most") == 1), "reef").otherwise("island")
    high = F.when(F.col("town_count") == 1, "reef").when(s > 0, "town").otherwise("island")
    level = F.when(s >= 0, high).otherwise(low)
    return stats.join(per_island, "word_id").select("word_id", "specificity", "town_count", "island_count", level.alias("level"))


def _members(facts: DataFrame, levels: DataFrame, level: str) -> DataFrame:
    return source_quality(facts).where(F.col("cosine_sim").isNotNull()).join(levels.where(F.col("level") == level).select("word_id", "specificity", "island_count"), "word_id")


def _raw(idf, quality, own, name, island):
    return idf * F.greatest(quality, F.lit(FLOOR)) * (F.lit(OWN) * own + F.lit(NAME) * name + F.lit(ISLAND) * island)


def _scaled(rows: DataFrame, key: str) -> DataFrame:
    """Min-max by group: two small aggregates joined back, so a large group needs no single task."""
    bounds = rows.groupBy(key).agg(F.min("raw").alias("lo"), F.max("raw").alias("hi"))
    return rows.join(bounds, key).withColumn("weight", S.min_max_u8(F.col("raw"), F.col("lo"), F.col("hi"))).drop("lo", "hi")


def reef_weights(facts: DataFrame, stats: DataFrame, levels: DataFrame) -> DataFrame:
    rows = _members(facts, levels, "reef").join(stats.select("word_id", "idf"), "word_id")
    rows = rows.withColumn("raw", _raw(F.col("idf"), F.coalesce("source_quality", F.lit(1.0)), F.col("cosine_sim"), F.col("reef_cos"), F.col("island_cos")))
    return _scaled(rows, "reef_id").select("reef_id", "town_id", "island_id", "word_id", "weight")


def town_weights(facts: DataFrame, stats: DataFrame, levels: DataFrame) -> DataFrame:
    best = _members(facts, levels, "town").groupBy("town_id", "island_id", "word_id").agg(*(F.max(c).alias(c) for c in ("cosine_sim", "source_quality", "town_cos", "island_cos")))
    rows = best.join(stats.select("word_id", "idf"), "word_id").withColumn("raw", _raw(F.col("idf"), F.col("source_quality"), F.col("cosine_sim"), F.col("town_cos"), F.col("island_cos")))
    return _scaled(rows, "town_id").select("town_id", "island_id", "word_id", "weight")


def island_weights(facts: DataFrame, levels: DataFrame, islands: int) -> DataFrame:
    """0.2 of the island's and 0.8 of the global scale, rounded, times exclusivity, rounded again."""
    best = _members(facts, levels, "island").groupBy("island_id", "word_id").agg(*(F.max(c).alias(c) for c in ("cosine_sim", "source_quality", "island_cos", "island_count")))
    idf = S.log2(F.lit(float(islands)) / F.greatest(F.col("island_count"), F.lit(1)))
    rows = best.withColumn("raw", idf * F.greatest("source_quality", F.lit(FLOOR)) * (F.lit(0.5) * F.col("cosine_sim") + F.lit(0.5) * F.col("island_cos")))
    local = rows.groupBy("island_id").agg(F.min("raw").alias("lo"), F.max("raw").alias("hi"))
    whole = local.agg(F.min("lo").alias("glo"), F.max("hi").alias("ghi"))
    span = lambda a, b: F.when(F.col(b) > F.col(a), F.col(b) - F.col(a)).otherwise(F.lit(1.0))
    part = lambda share, a, b: F.lit(share) * F.lit(255.0) * (F.col("raw") - F.col(a)) / span(a, b)
    blend = F.bround(part(1 - GLOBAL, "lo", "hi") + part(GLOBAL, "glo", "ghi"))
    rows = rows.join(local, "island_id").crossJoin(F.broadcast(whole))  # one row
    return rows.select("island_id", "word_id", F.bround(blend * S.exclusivity(F.col("island_count"))).cast("int").alias("weight"))


def export_index(reefs: DataFrame, towns: DataFrame, islands: DataFrame) -> DataFrame:
    """All levels in one relation; tiers below a level are null."""
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    a = reefs.select(F.lit("reef").alias("level"), "island_id", "town_id", "reef_id", "word_id", "weight")
    b = towns.select(F.lit("town").alias("level"), "island_id", "town_id", none("string", "reef_id"), "word_id", "weight")
    c = islands.select(F.lit("island").alias("level"), "island_id", none("long", "town_id"), none("string", "reef_id"), "word_id", "weight")
    return a.unionByName(b).unionByName(c)


def level_overlap(index: DataFrame) -> DataFrame:
    """Words that two levels share; none should be."""
    words = lambda x: index.where(F.col("level") == x).select("word_id")
    out = None
    for a, b in (("reef", "town"), ("reef", "island"), ("town", "island")):
        n = words(a).intersect(words(b)).agg(F.count(F.lit(1)).alias("n")).select(F.lit(f"{a}-{b}").alias("pair"), "n")
        out = n if out is None else out.unionByName(n)
    return out


def crosstab(levels: DataFrame) -> DataFrame:
    """Words by specificity and level: what promotion would do, without doing it."""
    return levels.groupBy("specificity").pivot("level", ["reef", "town", "island"]).agg(F.count(F.lit(1))).na.fill(0)


def legacy_weights(rows: DataFrame, key: str) -> DataFrame:
    """The older export's scale of `raw` by group: 255 where all are equal; members of weight 0 are left out."""
    bounds = rows.groupBy(key).agg(F.min("raw").alias("lo"), F.max("raw").alias("hi"))
    scaled = S.min_max_u8(F.col("raw"), F.col("lo"), F.col("hi"), flat=255.0)
    return rows.join(bounds, key).withColumn("weight", scaled).where("weight > 0").drop("lo", "hi", "raw")
