"""Centroids, nearest groups, neighbours and graphs over embedded words."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..sources.files import not_done
from ..sources.scratch import kept
from .ranks import quantiles


def mean_vectors(vectors: DataFrame, key: list[str], weight: str | None = None, normalise: bool = True) -> DataFrame:
    """Mean (weighted, if asked for) of the vectors of each group; at length 1 unless told otherwise.

    Sums are partial by group and dimension, so a group of any size is pre-aggregated.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    parts = vectors.select(*key, w.alias("w"), F.posexplode("v").alias("i", "x"))
    means = parts.groupBy(*key, "i").agg((F.sum(F.col("x") * F.col("w")) / F.sum("w")).alias("m"))
    rows = means.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("c"))
    return rows.withColumn("c", S.unit(F.col("c"))) if normalise else rows


#: Groups up to this number are broadcast for a comparison with every word.
FEW = 5_000


def similarities(vectors: DataFrame, centroids: DataFrame, key: str) -> DataFrame:
    """Cosine of every word with every centroid; centroids are groups of a hierarchy, whose number is checked."""
    if centroids.count() > FEW:
        raise ValueError(f"more than {FEW} centroids: compare within their parents instead")
    side = centroids.select(F.col(key).alias("other"), "c")
    return vectors.crossJoin(F.broadcast(side)).withColumn("cos", S.cosine(F.col("v"), F.col("c"))).drop("c", "v")


def nearest(sims: DataFrame) -> DataFrame:
    return sims.groupBy("vec_id").agg(F.max_by("other", F.struct("cos", -F.col("other"))).alias("nearest"), F.max("cos").alias("best"))


#: Groups of centroids that are broadcast, as many as there are centroids of them each; angles closer than this are looked at as equal.
MOST_HEADS, CLOSE = 20_000, 1e-6


def _unit_rows(column) -> np.ndarray:
    x = np.stack(column)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def nearest_centroid(vectors: DataFrame, centroids: DataFrame, key: str) -> DataFrame:
    """vec_id, nearest, best: the centroid of the largest cosine, of any number of them; equal cosines (9 places) go to the least key.

    An inverted file of two levels: some centroids, the first of a seeded order and about the root of their
    number, are heads, and every centroid belongs to the nearest head, at most a radius away.  A word looks at the
    centroids of its nearest head; by the triangle inequality of angles a head whose angle less its radius
    is above the best angle so far holds no better one, and only the other heads' centroids are looked at too.
    A vector of length 0 has cosine 0 with all.  vectors: vec_id, v; centroids: key, c.
    """
    spark = vectors.sparkSession
    rows = centroids.select(F.col(key).cast("long").alias("other"), "c")
    n = rows.count()
    if n > MOST_HEADS**2:
        raise ValueError(f"more than {MOST_HEADS ** 2} centroids")
    wanted = max(1, math.isqrt(n))
    place = F.pmod(F.xxhash64("other"), F.lit(1 << 32))
    chosen = rows.where(place < math.ceil((1.2 * wanted + 10) / max(n, 1) * (1 << 32))).orderBy(place, "other").limit(wanted).toPandas()  # at most MOST_HEADS
    if not len(chosen):
        return vectors.select("vec_id", F.lit(None).cast("long").alias("nearest"), F.lit(None).cast("double").alias("best")).limit(0)
    heads = spark.sparkContext.broadcast(_unit_rows(chosen["c"]))

    @F.pandas_udf("struct<head: int, angle: double>")
    def head_of(c: pd.Series) -> pd.DataFrame:
        cos = _unit_rows(c) @ heads.value.T
        best = cos.argmax(1)
        return pd.DataFrame({"head": best.astype(np.int32), "angle": np.arccos(np.clip(cos[np.arange(len(best)), best], -1, 1))})

    listed = kept(rows.withColumn("h", head_of("c")).select("other", "c", "h.head", "h.angle"))
    found = listed.groupBy("head").agg(F.max("angle").alias("radius")).collect()  # a row a head
    radius = np.full(len(chosen), -1.0)  # of a head without centroids: it is never looked at
    for r in found:
        radius[r["head"]] = r.radius
    sent = spark.sparkContext.broadcast(radius)

    def block_of(c: str):
        """Blocks of a head's centroids and of the words that look at it, by hash, so that neither has to fit a task."""
        return F.pmod(F.xxhash64(c), F.col("blocks")).cast("int")

    blocks = listed.groupBy("head").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    stored = kept(listed.join(F.broadcast(blocks), "head").select("head", block_of("other").alias("block"), "other", "c"))  # a row a head

    def looked(asked: DataFrame) -> DataFrame:
        """vec_id, nearest, best among the centroids of the heads that a word asks for.  asked: vec_id, v, head."""

        def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if not len(left) or not len(right):
                return pd.DataFrame({"vec_id": [], "nearest": [], "best": []})
            right = right.sort_values("other")
            y, ids = _unit_rows(right["c"]), right["other"].to_numpy()
            out = []
            for lo in range(0, len(left), BLOCK):
                part = left.iloc[lo : lo + BLOCK]
                cos = _unit_rows(part["v"]) @ y.T
                top = np.round(cos, 9).argmax(1)
                out.append(pd.DataFrame({"vec_id": part["vec_id"].to_numpy(), "nearest": ids[top], "best": cos[np.arange(len(top)), top]}))
            return pd.concat(out)

        spread = asked.join(F.broadcast(blocks), "head").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).cast("int"))
        salted = stored.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        pairs = spread.select("head", "block", "salt", "vec_id", "v").groupBy("head", "block", "salt").cogroup(salted.groupBy("head", "block", "salt"))
        each = pairs.applyInPandas(best, "vec_id long, nearest long, best double")
        order = F.struct(F.round("best", 9), -F.col("nearest"))
        return each.groupBy("vec_id").agg(F.max_by("nearest", order).alias("nearest"), F.max_by("best", order).alias("best"))

    @F.pandas_udf("int")
    def first_head(v: pd.Series) -> pd.Series:
        cos = _unit_rows(v) @ heads.value.T
        return pd.Series(np.where(sent.value >= 0, cos, -2).argmax(1).astype(np.int32))

    words = kept(vectors.select("vec_id", "v").withColumn("head", first_head("v")))
    first = kept(looked(words))

    @F.pandas_udf("array<int>")
    def others(v: pd.Series, head: pd.Series, best: pd.Series) -> pd.Series:
        angle = np.arccos(np.clip(_unit_rows(v) @ heads.value.T, -1, 1))
        able = (angle - sent.value <= np.arccos(np.clip(best.to_numpy(), -1, 1))[:, None] + CLOSE) & (sent.value >= 0)
        able[np.arange(len(head)), head.to_numpy()] = False
        return pd.Series([np.flatnonzero(row).astype(np.int32) for row in able])

    more = words.join(first, "vec_id").select("vec_id", "v", F.explode(others("v", "head", "best")).alias("head"))
    order = F.struct(F.round("best", 9), -F.col("nearest"))
    return first.unionByName(looked(more)).groupBy("vec_id").agg(F.max_by("nearest", order).alias("nearest"), F.max_by("best", order).alias("best"))


#: Parts of the words that look at a head, so that a popular one is many units of work.
SALTS = 4
#: Words of a block; a unit of work compares two blocks.
BLOCK = 2048


#: Blocks that a group's queries are cut into, of a quarter of BLOCK rows at least; and how often BLOCK rows, at most, a unit is sent of either side.
CUTS, TIMES = 8, 16
#: Queries that a unit multiplies at once; points of which only the largest cosine is looked at first; cosines closer than this may be equal at 9 places.
SLICE, STRIDE, APART = 256, 64, 2e-9


def _best_of(x: np.ndarray, words: np.ndarray, y: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of x, row of y and cosine of each query's k most similar points but itself, by the cosine at 9 places and then by place; ids ascend.

    The k-th largest of the largest cosines of strides of points bounds the k-th largest cosine from below, so
    only the few points that reach it are put in order.
    """
    nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    dots = x @ y.T
    f = dots * np.where(ny > 0, 1.0 / np.where(ny > 0, ny, 1.0), 0.0)  # cosines times the query's norm
    for i, (lo, hi) in enumerate(zip(np.searchsorted(ids, words), np.searchsorted(ids, words, "right"), strict=True)):
        f[i, lo:hi] = -np.inf
    width = max(1, min(STRIDE, len(y) // (2 * k)))
    strides = len(y) // width
    able = f > -np.inf
    if strides >= k:
        most = f[:, : strides * width].reshape(len(x), width, strides).max(1)
        bound = np.partition(most, strides - k, axis=1)[:, strides - k]
        able &= f >= (bound - APART * np.maximum(nx, 1e-300))[:, None]
    row, at = np.nonzero(able)
    n = nx[row] * ny[at]
    cos = np.where(n == 0, 0.0, dots[row, at] / np.where(n == 0, 1.0, n))
    order = np.lexsort((at, -np.round(cos, 9), row))
    row, at, cos = row[order], at[order], cos[order]
    nth = np.arange(len(row)) - np.searchsorted(row, row)
    return row[nth < k], at[nth < k], cos[nth < k]


def sent(queries: DataFrame, points: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows of queries and of points by units: k, lo, hi, id, x, and the same with 2; see `nearest_of`."""
    count = F.count(F.lit(1))
    cuts = F.greatest(F.least(F.lit(CUTS), F.ceil(count * 4 / BLOCK)), F.ceil(count / (TIMES * BLOCK))).cast("int")
    sizes = queries.groupBy(key).agg(cuts.alias("lows")).join(points.groupBy(key).agg(F.ceil(count / (TIMES * BLOCK)).cast("int").alias("highs")), key)
    sizes = F.broadcast(kept(sizes))  # a row a group
    number = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    a = queries.select(key, "vec_id", "v").join(sizes, key).select(F.col(key).alias("k"), number("lows").alias("lo"), each("highs").alias("hi"), F.col("vec_id").alias("id"), F.col("v").alias("x"))
    b = points.select(key, "vec_id", "v").join(sizes, key).select(F.col(key).alias("k2"), each("lows").alias("lo2"), number("highs").alias("hi2"), F.col("vec_id").alias("id2"), F.col("v").alias("x2"))
    return a, b


def nearest_of(queries: DataFrame, points: DataFrame, k: int = 5, key: str = "town_id") -> DataFrame:
    """For each query (key, vec_id, v) the k most similar points of its group but itself: key, a, b, cos, nth.

    A group's queries are cut into CUTS blocks and its points into as few as a unit's memory allows; each pair of blocks is
    products of matrices by slices, which give the k best of their rows only; what windows compare are k rows a query and block.  So a point
    is sent CUTS times and a query once, up to TIMES * BLOCK points and CUTS times as many queries in a group; beyond, copies grow with the
    group over these.  Multiplications are queries times points.  Cosines are compared at 9 places.
    """
    a, b = sent(queries, points, key)

    def best(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({key: [], "a": [], "b": [], "cos": []})]
        if len(a) and len(b):
            b = b.sort_values("id2", kind="stable")
            x, words, y, ids = np.stack(a["x"]), a["id"].to_numpy(), np.stack(b["x2"]), b["id2"].to_numpy()
            for lo in range(0, len(x), SLICE):
                part = slice(lo, lo + SLICE)
                row, at, cos = _best_of(x[part], words[part], y, ids, k)
                out.append(pd.DataFrame({key: a["k"].iloc[0], "a": words[part][row], "b": ids[at], "cos": cos}))
        return pd.concat(out[1:] or out)

    kind = f"{key} {dict(queries.dtypes)[key]}, a long, b long, cos double"
    pairs = a.groupBy("k", "lo", "hi").cogroup(b.groupBy("k2", "lo2", "hi2")).applyInPandas(best, kind)
    order = Window.partitionBy(key, "a").orderBy(F.desc(F.round("cos", 9)), "b")
    return pairs.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k)


def neighbours(vectors: DataFrame, k: int = 5, key: str = "town_id") -> DataFrame:
    """The k most similar other words of the same group: key, a, b, cos, nth; see `nearest_of`."""
    return nearest_of(vectors, vectors, k, key)


def knn_graph(vectors: DataFrame, k: int = 15, key: str = "town_id") -> DataFrame:
    """Edges a < b with their cosine: b among the k nearest of a, or a among those of b."""
    n = neighbours(vectors, k, key)
    return n.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.round("cos", 9).alias("w")).distinct()


def standardise(vectors: DataFrame, dims: DataFrame) -> DataFrame:
    """z-scores by dimension; a deviation of 0 counts as 1."""
    arrays = dims.agg(F.transform(F.array_sort(F.collect_list(F.struct("dim_id", "mean", "std"))), lambda s: F.struct(s["mean"].alias("m"), F.when(s["std"] == 0, 1.0).otherwise(s["std"]).alias("s"))).alias("ms"))
    return vectors.crossJoin(F.broadcast(arrays)).withColumn("z", F.zip_with("v", "ms", lambda x, y: (x - y["m"]) / y["s"])).drop("ms")  # one row


def embed_missing(texts: DataFrame, path: str, key: str, c: str, encode: Callable[[DataFrame, str], DataFrame]) -> None:
    """Add to the table at path the vectors of the texts whose key it doesn't have yet.

    encode takes distinct texts and the name of their column, and gives that column and v; a text that it gives no vector is left out.
    """
    spark = texts.sparkSession
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    left = texts.select(key, c)
    if where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        left = not_done(left, spark.read.parquet(path), key)
    left.join(encode(left.select(c).distinct(), c), c).select(key, c, "v").write.mode("append").parquet(path)


def spread_percentiles(seeds: DataFrame, towns: DataFrame) -> DataFrame:
    """island_id, p25, p50 of the population deviation of each seed's cosines with its island's centroids.  towns: island_id, c."""
    sims = seeds.select("island_id", "vec_id", "v").join(F.broadcast(towns.select("island_id", "c")), "island_id").withColumn("cos", S.cosine(F.col("v"), F.col("c")))  # towns of an island
    std = sims.groupBy("island_id", "vec_id").agg(F.stddev_pop("cos").alias("std"))
    return quantiles(std, ["island_id"], "std", {"p25": 0.25, "p50": 0.5})


def cross_town(seeds: DataFrame, threshold: float = 0.010, least_towns: int = 3) -> DataFrame:
    """vec_id, island_id, std, mean of seeds whose cosines with the centroids of their island's towns differ by less than the threshold.

    Islands of fewer than `least_towns` towns are left out, and so are words of one town alone, if that
    is no capital.  seeds: vec_id, island_id, town_id, is_capital, v; one row a word and town.
    """
    towns = mean_vectors(seeds.withColumn("v", S.unit(F.col("v"))), ["island_id", "town_id"])
    large = towns.groupBy("island_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_towns).select("island_id")
    words = seeds.groupBy("island_id", "vec_id").agg(F.first("v").alias("v"), F.count_if(F.col("is_capital") == 0).alias("plain"), F.count_if(F.col("is_capital") == 1).alias("capitals"))
    sims = words.where("not (plain = 1 and capitals = 0)").join(F.broadcast(towns.join(large, "island_id")), "island_id").withColumn("cos", S.cosine(F.col("v"), F.col("c")))  # towns of an island
    return sims.groupBy("vec_id", "island_id").agg(F.stddev_pop("cos").alias("std"), F.avg("cos").alias("mean")).where(F.col("std") < threshold)


def capital_triage(vectors: DataFrame, margin: float = 0.03) -> DataFrame:
    """Each capital seed of an island with three towns or more: generic, misplaced (and where to), or genuine."""
    plain = vectors.where("is_capital = 0")
    towns = mean_vectors(plain.withColumn("v", S.unit(F.col("v"))), ["island_id", "town_id"])
    sizes = vectors.groupBy("island_id").agg(F.countDistinct("town_id").alias("towns"), F.max("is_capital").alias("has")).where("towns >= 3 and has = 1").select("island_id")
    side = towns.join(sizes, "island_id").select("island_id", F.col("town_id").alias("other"), "c")
    sims = vectors.join(F.broadcast(side), "island_id").withColumn("cos", S.cosine(F.col("v"), F.col("c")))  # towns of an island
    per = sims.groupBy("vec_id", "island_id", "is_capital").agg(F.stddev_pop("cos").alias("std"), F.max("cos").alias("best"), F.max_by("other", F.struct("cos", -F.col("other"))).alias("best_town"), F.avg("cos").alias("mean"))
    p25 = per.where("is_capital = 0").groupBy("island_id").agg(F.percentile("std", 0.25).alias("p25"))
    whole = mean_vectors(plain.withColumn("v", S.unit(F.col("v"))), ["island_id"]).withColumnRenamed("c", "ic")
    out = per.where("is_capital = 1").join(p25, "island_id").join(vectors.select("vec_id", "v"), "vec_id").join(F.broadcast(whole), "island_id").withColumn("own", S.cosine(F.col("v"), F.col("ic")))
    verdict = F.when(F.col("std") < F.col("p25"), "generic").when(F.col("best") > F.col("own") + margin, "misplaced").otherwise("genuine")
    return out.select("vec_id", "island_id", "std", "own", "best", verdict.alias("verdict"), F.when(verdict == "misplaced", F.col("best_town")).alias("to_town"))
