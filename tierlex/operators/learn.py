"""Town classifiers, sampling of negatives, and communities of words."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..sources.scratch import kept
from . import boost
from .communities import bulk_communities
from .stats import dim_stats
from .vectors import mean_vectors, nearest_of, standardise

#: Negatives per positive, half of them from sibling towns; folds.
NEGATIVES, FOLDS, SEED = 5, 7, 42


def order_key(*cols):
    """A seeded order that any engine repeats."""
    return F.md5(F.concat_ws(":", *cols, F.lit(str(SEED))))


def numbered(rows: DataFrame, keys: list[str], order: str, ties: str) -> DataFrame:
    """rows and nth, from 1 within the keys, by order (a hash in hexadecimal digits) and ties.

    A key's rows are ranked within the 256 buckets of the hash's first digits, whose counts move them, so
    a key may have any number of rows.
    """
    rows = rows.withColumn("_bucket", F.substring(order, 1, 2))
    counts = rows.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(order, ties))
    return rows.join(counts.withColumn("_before", before), [*keys, "_bucket"]).withColumn("nth", F.col("_before") + inside).drop("_bucket", "_n", "_before")


#: Halvings of a hash's range that rows are dealt out by.
HALVINGS = 40


def negatives(vectors: DataFrame, per: int = NEGATIVES, siblings: bool = True) -> DataFrame:
    """town_id, vec_id, pool: for every town `per` negatives a positive, without replacement, the first of a seeded order.

    Half of them are words of other towns of its island (as many as there are), the rest words that no town of
    its island has; without siblings all are words of other towns.  A word meets only the towns whose need
    reaches its place in the order: both are dealt out by powers of two, so what is joined is a few times what is
    returned.  (A need takes in a fifth more rows than it asks for, and a hundred.)
    """
    order = order_key(F.col("vec_id").cast("string"))
    place = F.conv(F.substring("order", 1, 8), 16, 10).cast("double") / 4294967296.0
    words = vectors.groupBy("vec_id").agg(F.collect_set("island_id").alias("islands")).withColumn("order", order).withColumn("place", place)
    own = vectors.select("town_id", "island_id", "vec_id").distinct()
    total = vectors.agg(F.countDistinct("vec_id").alias("total"))
    in_island = vectors.groupBy("island_id").agg(F.countDistinct("vec_id").alias("in_island"))
    towns = own.groupBy("town_id", "island_id").agg(F.count(F.lit(1)).alias("n")).join(in_island, "island_id").crossJoin(F.broadcast(total))  # one row
    towns = towns.withColumn("wanted", F.col("n") * per)
    hard = F.least(F.floor(F.col("wanted") / 2), F.col("in_island") - F.col("n")) if siblings else F.lit(0)
    towns = towns.withColumn("hard", hard.cast("long"))
    easy_pool = F.col("total") - (F.col("in_island") if siblings else F.col("n"))
    towns = towns.withColumn("easy", F.least(F.col("wanted") - F.col("hard"), easy_pool).cast("long"))

    def reach(need, size):
        """Halvings of the range that the need stays within."""
        share = (F.col(need) * 1.2 + 100) / F.greatest(size, F.lit(1))
        return F.when(share >= 1, 0).otherwise(F.least(F.floor(-F.log2(share)), F.lit(HALVINGS))).cast("int")

    within = F.explode(F.sequence(F.lit(0), F.least(F.floor(-F.log2(F.greatest("place", F.lit(2.0**-HALVINGS)))), F.lit(HALVINGS)).cast("int"))).alias("reach")
    dealt = words.select("vec_id", "islands", "order", within)
    easy = towns.select("town_id", "island_id", F.col("easy").alias("need"), reach("easy", easy_pool).alias("reach"), F.lit("global").alias("pool"))
    found = dealt.join(easy, "reach")
    found = (found.where(~F.array_contains("islands", F.col("island_id"))) if siblings else found).select("town_id", "vec_id", "order", "pool", "need")
    if siblings:
        hard_towns = towns.select("town_id", "island_id", F.col("hard").alias("need"), reach("hard", F.col("in_island")).alias("reach"), F.lit("sibling").alias("pool"))
        home = dealt.select("vec_id", "order", "reach", F.explode("islands").alias("island_id"))
        found = found.unionByName(home.join(hard_towns, ["island_id", "reach"]).select("town_id", "vec_id", "order", "pool", "need"))
    found = found.join(own.select("town_id", "vec_id"), ["town_id", "vec_id"], "left_anti")
    return numbered(found, ["town_id", "pool"], "order", "vec_id").where("nth <= need").select("town_id", "vec_id", "pool")


def folds_of(rows: DataFrame, label: str = "label", group: str = "vec_id", key: str = "town_id", folds: int = FOLDS) -> DataFrame:
    """rows and fold: each class's groups are dealt out in turn in a seeded order, so folds have equal shares of the classes and no group is in two.

    A group with both classes in a town goes with its larger label.
    """
    groups = rows.groupBy(key, group).agg(F.max(label).alias("_label")).withColumn("_order", order_key(F.col(group).cast("string")))
    dealt = numbered(groups, [key, "_label"], "_order", group).select(key, group, ((F.col("nth") - 1) % folds).cast("int").alias("fold"))
    return rows.join(dealt, [key, group])


def features(rows: DataFrame, vectors: DataFrame, dims: DataFrame, k: int = 5) -> DataFrame:
    """rows and x: z-scores by dimension, the one-hot tag, the mean cosine of the k nearest positives of the row's town, and the cosine with their centroid.

    rows: town_id, vec_id, v, and pos if there are tags; vectors: the positives, town_id, vec_id, v.  A
    positive isn't its own neighbour; a town without positives gives zeros.
    """
    positives = vectors.select("town_id", "vec_id", "v")
    near = nearest_of(rows, positives, k).groupBy("town_id", F.col("a").alias("vec_id")).agg(F.avg("cos").alias("_near"))
    middle = mean_vectors(positives.withColumn("v", S.unit(F.col("v"))), ["town_id"]).withColumnRenamed("c", "_middle")
    tag = S.pos_one_hot(F.col("pos")) if "pos" in rows.columns else F.array(*[F.lit(0.0)] * 4)
    out = standardise(rows.join(near, ["town_id", "vec_id"], "left").join(F.broadcast(middle), "town_id", "left"), dims)  # a row a town
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    both = F.array(zero(F.col("_near")), zero(S.cosine(F.col("v"), F.col("_middle"))))
    return out.withColumn("x", F.concat("z", tag, both)).drop("z", "_near", "_middle")


def samples(vectors: DataFrame, dims: DataFrame | None = None, per: int = NEGATIVES, siblings: bool = True) -> DataFrame:
    """town_id, vec_id, label, weight (negatives over positives for a positive), fold, x of every town's positives and negatives.

    Towns of fewer than LEAST_POSITIVES words have no sample.
    """
    positives = vectors.select("town_id", "vec_id").distinct()
    many = positives.groupBy("town_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_POSITIVES)
    chosen = positives.withColumn("label", F.lit(1.0)).unionByName(negatives(vectors, per, siblings).select("town_id", "vec_id", F.lit(0.0).alias("label"))).join(many.select("town_id"), "town_id")
    words = vectors.drop("town_id", "island_id", "is_capital").dropDuplicates(["vec_id"])
    rows = folds_of(features(chosen.join(words, "vec_id"), vectors, dim_stats(vectors) if dims is None else dims))
    share = chosen.groupBy("town_id").agg(F.try_divide(F.count_if(F.col("label") == 0), F.count_if(F.col("label") == 1)).alias("share"))
    return rows.join(share, "town_id").select("town_id", "vec_id", "label", F.when(F.col("label") == 1, F.coalesce("share", F.lit(1.0))).otherwise(1.0).alias("weight"), "fold", "x")


#: Shallower and fewer trees than the published `boost.Setting()`, at a higher rate, which the tuning's settings start from.
QUICK = boost.Setting(depth=3, rounds=8, rate=0.3, rows=1.0, columns=1.0, patience=3)
#: What the queries train: the published trees.
PUBLISHED = boost.Setting()
#: Fixed value: fewest positives of a classifier.
LEAST_POSITIVES = 10


def train_towns(sample: DataFrame, setting: boost.Setting = PUBLISHED) -> tuple[boost.Model, DataFrame]:
    """Classifiers of all towns in one job, which stop early on fold 0, held out: the model, and the sample scored."""
    rows = sample.select(F.col("town_id").cast("string").alias("model"), "town_id", "vec_id", "label", "weight", (F.col("fold") == 0).alias("held_out"), "x")
    model = boost.train(rows, setting)
    return model, boost.predict(model.trees, rows.drop("weight"))


def train_or_load(vectors: DataFrame, path: str, dims: DataFrame | None = None, setting: boost.Setting = PUBLISHED, siblings: bool = True) -> DataFrame:
    """The trees of all towns' classifiers: those saved at path, and new ones, saved there, of towns that have none yet.

    Towns of fewer than LEAST_POSITIVES words have none.
    """
    spark = vectors.sparkSession
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    done = spark.createDataFrame([], boost.TREES)
    if where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        done = spark.read.schema(boost.TREES).parquet(path)
    left = samples(vectors, dims, siblings=siblings).join(done.select(F.col("model").cast("long").alias("town_id")).distinct(), "town_id", "left_anti")
    left = kept(left)
    if left.limit(1).count():
        train_towns(left, setting)[0].trees.write.mode("append").parquet(path)
        done = spark.read.schema(boost.TREES).parquet(path)
    return done


def predict_all(trees: DataFrame, words: DataFrame, vectors: DataFrame, dims: DataFrame) -> DataFrame:
    """town_id, word_id, score of every word (vec_id, v, pos) by every town's classifier: words times towns rows, which is what is asked for."""
    towns = trees.select(F.col("model").cast("long").alias("town_id")).distinct()  # a tier of the hierarchy
    pairs = words.select("vec_id", "v", *(c for c in ("pos",) if c in words.columns)).dropDuplicates(["vec_id"]).crossJoin(F.broadcast(towns))
    rows = features(pairs, vectors.withColumn("town_id", F.col("town_id").cast("long")), dims).select(F.col("town_id").cast("string").alias("model"), "town_id", "vec_id", "x")
    return boost.predict(trees, rows).select("town_id", F.col("vec_id").alias("word_id"), "score")


def feature_names(dims: int) -> list[str]:
    """Labels of a classifier's features by place."""
    return [*(f"dim_{i}" for i in range(dims)), "pos_noun", "pos_verb", "pos_adj", "pos_adv", "knn_mean", "centroid_cos"]


def tune(sample: DataFrame, settings: dict[str, boost.Setting], folds: int = 3) -> DataFrame:
    """town_id, setting, f1 of every setting of every town's classifier, by cross-validation; all settings, folds and towns are models of one job."""
    grid = F.explode(F.array(*[F.struct(F.lit(name).alias("setting"), F.lit(k).alias("out")) for name in settings for k in range(folds)])).alias("g")
    rows = sample.withColumn("fold", F.col("fold") % folds).select("*", grid).select("town_id", "vec_id", "label", "weight", "fold", "x", "g.*")
    rows = rows.withColumn("model", F.concat_ws("/", "setting", "out", F.col("town_id").cast("string")))
    train = rows.where("fold <> out").withColumn("held_out", F.lit(False))
    models = {r.model: settings[r.setting] for r in rows.select("model", "setting").distinct().collect()}  # a row a model
    model = boost.train(train, models)
    scored = boost.predict(model.trees, rows.where("fold = out").select("model", "town_id", "setting", "out", "vec_id", "label", "x"))
    return metrics(scored, keys=["town_id", "setting", "out"]).groupBy("town_id", "setting").agg(F.avg("f1").alias("f1"))


def tuned(sample: DataFrame, settings: dict[str, boost.Setting], folds: int = 3) -> DataFrame:
    """town_id, setting (the best; of equal ones the first by name), cv_f1, and the held-out metrics of the classifier that is trained anew with it."""
    sample = kept(sample)
    scores = kept(tune(sample, settings, folds))
    best = scores.groupBy("town_id").agg(F.max("f1").alias("cv_f1"), F.min_by("setting", F.struct(-F.round("f1", 9), "setting")).alias("setting"))
    chosen = {str(r.town_id): settings[r.setting] for r in best.collect()}  # a row a town
    rows = sample.select(F.col("town_id").cast("string").alias("model"), "town_id", "vec_id", "label", "weight", (F.col("fold") == 0).alias("held_out"), "x")
    model = boost.train(rows, chosen)
    scored = boost.predict(model.trees, rows.where("held_out").drop("weight"))
    return best.join(metrics(scored, keys=["town_id"]), "town_id")


def metrics(scored: DataFrame, threshold: float = 0.5, keys: list[str] | None = None) -> DataFrame:
    """Precision, recall, F1, accuracy and area under the precision-recall curve, by keys; 0 where nothing is predicted."""
    keys = keys or []
    yes, true = F.col("score") >= threshold, F.col("label") == 1
    n = scored.groupBy(*keys).agg(F.count_if(yes & true).alias("tp"), F.count_if(yes & ~true).alias("fp"), F.count_if(~yes & true).alias("fn"), F.count(F.lit(1)).alias("n"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    tp, fp, fn = (F.col(c) for c in ("tp", "fp", "fn"))
    out = n.select(*keys, ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"), ratio(F.col("n") - fp - fn, F.col("n")).alias("accuracy"))
    area = average_precision(scored, keys)
    return out.join(area, keys) if keys else out.crossJoin(F.broadcast(area))  # one row


def average_precision(scored: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """auc_pr, by keys: precision at each distinct score, weighted by the recall it adds; null without positives.  Equal scores are counted first."""
    keys = keys or []
    values = scored.groupBy(*keys, "score").agg(F.count_if(F.col("label") == 1).alias("p"), F.count(F.lit(1)).alias("n"))
    down = Window.partitionBy(*keys).orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)  # distinct scores of a held-out sample
    run = values.withColumn("tp", F.sum("p").over(down)).withColumn("seen", F.sum("n").over(down))
    return run.groupBy(*keys).agg(F.try_divide(F.sum(F.col("p") * F.col("tp") / F.col("seen")), F.sum("p")).alias("auc_pr"))


def _moved(links: list[dict[int, float]], degree: np.ndarray, label: np.ndarray, resolution: float, within: np.ndarray | None = None) -> np.ndarray:
    """Labels after moving nodes to the neighbouring label of the best modularity until none gains; with `within`, only nodes that are alone move, and only inside their group of it."""
    label, whole = label.copy(), degree.sum()
    total = np.bincount(label, degree, len(links))
    size = np.bincount(label, minlength=len(links))
    moved = True
    while moved:
        moved = False
        for i in range(len(links)):
            own = label[i]
            if within is not None and size[own] > 1:
                continue
            near: dict[int, float] = {}
            for j, z in links[i].items():
                if j != i and (within is None or within[j] == within[i]):
                    near[label[j]] = near.get(label[j], 0.0) + z
            total[own] -= degree[i]
            gain = lambda c: near.get(c, 0.0) - resolution * degree[i] * total[c] / whole  # noqa: B023, E731
            best = max(sorted({*near, own}), key=lambda c: (round(gain(c), 12), c == own))
            total[best] += degree[i]
            if best != own:
                size[own] -= 1
                size[best] += 1
                label[i], moved = best, True
        if within is not None:
            break
    return label


#: Edges of a group that one task takes; larger groups go through rounds over all tasks.
TASK_EDGES = 200_000


def communities(edges: DataFrame, group: str, least: int = 3, resolution: float = 1.0, most: int = TASK_EDGES) -> DataFrame:
    """group, node, community of each group's weighted graph: modularity by moving nodes, refining each community, and merging what was refined, until nothing improves.

    Refined parts are built from single nodes along links inside a community, so communities are connected;
    those of fewer than `least` nodes are -1.  Groups of up to `most` edges are tasks of their own, larger
    ones go through `bulk_communities`, which does the same in rounds.
    """
    sizes = edges.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    large = kept(sizes.where(F.col("_n") > most).select(group))
    many = large.limit(1).count() > 0
    small = edges.join(large, group, "left_anti") if many else edges

    def split(pdf: pd.DataFrame) -> pd.DataFrame:
        nodes = np.unique(np.concatenate([pdf["a"], pdf["b"]]))
        a, b, w = np.searchsorted(nodes, pdf["a"]), np.searchsorted(nodes, pdf["b"]), np.maximum(pdf["w"].to_numpy(), 1e-9)
        members, label = np.arange(len(nodes)), np.arange(len(nodes))
        while True:
            n = len(label)
            links = [dict() for _ in range(n)]
            for x, y, z in zip(members[a], members[b], w, strict=True):
                links[x][y] = links[x].get(y, 0.0) + z
                links[y][x] = links[y].get(x, 0.0) + z
            degree = np.array([sum(x.values()) for x in links])
            label = _moved(links, degree, label, resolution)
            _, first, part = np.unique(_moved(links, degree, np.arange(n), resolution, label), return_index=True, return_inverse=True)
            if len(first) == n:
                break
            members = part[members]
            _, label = np.unique(label[first], return_inverse=True)
        _, found = np.unique(label[members], return_inverse=True)
        sizes = np.bincount(found)
        return pd.DataFrame({group: pdf[group].iloc[0], "node": nodes, "community": np.where(sizes[found] >= least, found, -1)})

    found = small.groupBy(group).applyInPandas(split, f"{group} long, node long, community long")
    return found.unionByName(bulk_communities(edges.join(large, group), group, least, resolution)) if many else found
