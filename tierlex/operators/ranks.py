"""Exact order statistics of groups of any size: histograms whose buckets are refined where a rank falls."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import kept

#: Buckets of a range; a group sends at most that many rows of counts a pass.
BUCKETS = 4096


def _refined(rows: DataFrame, keys: list[str], open_: DataFrame) -> DataFrame:
    """open_ (keys, rank, lo, hi, below) with the bounds, and the number of rows below them, of the bucket that holds the rank."""
    ranges = open_.select(*keys, "lo", "hi").distinct()
    inside = rows.join(ranges, keys).where("_x >= lo and _x <= hi")
    at = F.least(F.lit(BUCKETS - 1), F.floor((F.col("_x") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2) * BUCKETS)).cast("int")  # halves: a range may be wider than a double
    counts = inside.groupBy(*keys, "lo", "hi", at.alias("bucket")).agg(F.sum("_n").alias("k"), F.min("_x").alias("least"), F.max("_x").alias("most"))
    before = Window.partitionBy(*keys, "lo", "hi").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("k").over(before), F.lit(0)))
    found = open_.join(counts, [*keys, "lo", "hi"]).where("rank - below >= before and rank - below < before + k")
    return found.select(*keys, "rank", F.col("least").alias("lo"), F.col("most").alias("hi"), (F.col("below") + F.col("before")).alias("below"))


def quantiles(rows: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """keys and, under each name, the quantile of its share of the values, linear between the two nearest ranks; nulls and NaN are left out.

    A pass counts the values of a range in buckets, and the next one looks only at the bucket that a rank fell
    into, from its least to its largest value, until these are the same; a group's values are never together.
    Groups without a value have no row.
    """
    values = kept(rows.select(*keys, F.col(value).cast("double").alias("_x")).where("_x is not null and not isnan(_x)").groupBy(*keys, "_x").agg(F.count(F.lit(1)).alias("_n")))
    whole = kept(values.groupBy(*keys).agg(F.sum("_n").alias("n"), F.min("_x").alias("lo"), F.max("_x").alias("hi")))
    place = {name: (F.col("n") - 1) * share for name, share in shares.items()}
    wanted = F.explode(F.array_distinct(F.array(*[f(p).cast("long") for p in place.values() for f in (F.floor, F.ceil)])))
    open_ = whole.select(*keys, wanted.alias("rank"), "lo", "hi", F.lit(0).cast("long").alias("below"))
    found = open_.where("lo = hi")
    open_ = kept(open_.where("lo < hi"))
    while open_.limit(1).count():
        step = kept(_refined(values, keys, open_))
        found = found.unionByName(step.where("lo = hi"))
        open_ = step.where("lo < hi")
    per = found.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("rank", "lo"))).alias("at"))  # two ranks a share
    out = whole.join(per, keys)
    low = lambda p: F.col("at")[F.floor(p).cast("long")]
    high = lambda p: F.col("at")[F.ceil(p).cast("long")]
    return out.select(*keys, *[(low(p) + (high(p) - low(p)) * (p - F.floor(p))).alias(name) for name, p in place.items()])
