"""Pruning and adjusting predicted members: idf, ubiquity, orphans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Raw scores from which no adjustment is made, and the least adjusted score that stays.
SURE, LEAST = 0.7, 0.4
#: Towns that make a word ubiquitous; scores below which it goes, or is halved.
UBIQUITOUS, DROP_BELOW, HALVE_BELOW = 20, 0.80, 0.95


def with_counts(predictions: DataFrame, key: str = "town_id") -> DataFrame:
    """n, distinct groups of the word, and total, distinct groups of all; both before any pruning."""
    n = predictions.groupBy("word_id").agg(F.countDistinct(key).alias("n"))
    total = predictions.agg(F.countDistinct(key).alias("total"))
    return predictions.join(n, "word_id").crossJoin(F.broadcast(total))  # one row


def idf_adjusted(predictions: DataFrame, key: str = "town_id") -> DataFrame:
    scaled = F.col("score") * F.log2(F.col("total") / F.col("n")) / F.log2(F.when(F.col("total") > 1, F.col("total").cast("double")))
    keep = (F.col("score") >= SURE) | (F.col("total") <= 1)
    return with_counts(predictions, key).withColumn("adjusted", F.when(keep, F.col("score")).otherwise(scaled))


def idf_adjust(predictions: DataFrame, threshold: float = LEAST, key: str = "town_id") -> DataFrame:
    """Adjusted scores that reach the threshold; rows without score or ids are dropped."""
    whole = predictions.where(F.col("score").isNotNull() & F.col("word_id").isNotNull() & F.col(key).isNotNull())
    return idf_adjusted(whole, key).where(F.col("adjusted") >= threshold).select(key, "word_id", F.col("adjusted").alias("score"))


def ubiquitous(predictions: DataFrame, towns: int = UBIQUITOUS, key: str = "town_id") -> DataFrame:
    return predictions.groupBy("word_id").agg(F.countDistinct(key).alias("n")).where(F.col("n") >= towns)


def ubiquity_prune(predictions: DataFrame, towns: int = UBIQUITOUS, key: str = "town_id") -> DataFrame:
    """Of ubiquitous words: scores below 0.80 go, below 0.95 are halved; the set is taken before."""
    marked = predictions.join(ubiquitous(predictions, towns, key).select("word_id", F.lit(1).alias("u")), "word_id", "left")
    kept = marked.where(F.col("u").isNull() | (F.col("score") >= DROP_BELOW))
    return kept.select(key, "word_id", F.when((F.col("u") == 1) & (F.col("score") < HALVE_BELOW), F.col("score") * 0.5).otherwise(F.col("score")).alias("score"))


def orphan_cleanup(facts: DataFrame, pruned: DataFrame) -> DataFrame:
    """Facts without the predicted ones whose (town, word) is pruned."""
    gone = pruned.select("town_id", "word_id").distinct().withColumn("gone", F.lit(1))
    return facts.join(gone, ["town_id", "word_id"], "left").where(~((F.col("source") == "xgboost") & (F.col("gone") == 1)) | F.col("gone").isNull()).drop("gone")


def live_reefs(reefs: DataFrame, facts: DataFrame) -> DataFrame:
    return reefs.join(facts.select("reef_id").distinct(), "reef_id", "left_semi")


def score_buckets(predictions: DataFrame, threshold: float = LEAST) -> DataFrame:
    """By tenths of the raw score: rows, means, and how many the adjustment would prune."""
    rows = idf_adjusted(predictions)
    return rows.groupBy(F.floor(F.col("score") * 10).cast("int").alias("tenth")).agg(F.count(F.lit(1)).alias("rows"), F.avg("score").alias("avg_raw"), F.avg("adjusted").alias("avg_adjusted"), F.avg("n").alias("avg_n"), F.count_if(F.col("adjusted") < threshold).alias("pruned"))


def borderline(predictions: DataFrame, threshold: float = LEAST, k: int = 30) -> DataFrame:
    rows = idf_adjusted(predictions).where((F.col("score") >= 0.4) & (F.col("score") < 0.6) & (F.col("adjusted") >= threshold))
    return rows.orderBy(F.desc("adjusted"), "town_id", "word_id").limit(k).select("town_id", "word_id", "score", "adjusted")


def biggest_drop(predictions: DataFrame, k: int = 30) -> DataFrame:
    rows = idf_adjusted(predictions).withColumn("drop", F.round(F.col("score") - F.col("adjusted"), 9))
    return rows.orderBy(F.desc("drop"), "town_id", "word_id").limit(k).select("town_id", "word_id", "drop")


def threshold_table(predictions: DataFrame, thresholds=(0.4, 0.5, 0.6, 0.7)) -> DataFrame:
    """For every town, how many rows each threshold leaves, before and after the adjustment."""
    aggs = []
    for t in thresholds:
        aggs += [F.count_if(F.col("score") >= t).alias(f"raw_{int(t * 10)}"), F.count_if(F.col("adjusted") >= t).alias(f"adj_{int(t * 10)}")]
    return idf_adjusted(predictions).groupBy("town_id").agg(*aggs)


def ubiquity_preview(predictions: DataFrame, towns: int = UBIQUITOUS) -> DataFrame:
    rows = predictions.join(ubiquitous(predictions, towns).select("word_id"), "word_id", "left_semi")
    s = F.col("score")
    return rows.agg(F.countDistinct("word_id").alias("words"), F.count_if(s < DROP_BELOW).alias("deleted"), F.count_if((s >= DROP_BELOW) & (s < HALVE_BELOW)).alias("halved"), F.count_if(s >= HALVE_BELOW).alias("kept"))


#: Fixed value: least cosine of a predicted member with its domain's name.
NAME_FLOOR = 0.65


def name_floor(rows: DataFrame, floor: float = NAME_FLOOR) -> DataFrame:
    """Rows without predicted ones whose name cosine is known and below the floor.  rows: source, name_cos."""
    return rows.where(~((F.col("source") == "xgboost") & F.col("name_cos").isNotNull() & (F.col("name_cos") < floor)))


def flag_stop_words(words: DataFrame, stop: list[str]) -> DataFrame:
    return words.withColumn("is_stop", F.lower("word").isin(*stop).cast("int"))


def domainless(words: DataFrame, members: DataFrame) -> DataFrame:
    """Embedded words without blank or hyphen that no group has, tagged as such.  words: word_id, word, embedded."""
    return words.where(F.col("embedded") & ~F.col("word").rlike("[ -]")).join(members.select("word_id").distinct(), "word_id", "left_anti").select("word_id", F.lit("domainless").alias("domain"))
