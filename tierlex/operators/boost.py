"""Boosted trees for any number of towns in one job: histograms of gradients by town, node, feature and bin.

A model of up to TASK_CELLS bytes of bins is grown by one task, all its rounds at once.  Of larger ones each level
of all towns' trees is one pass: tasks walk their rows down the trees so far and add up gradients, one aggregation
sums them by (model, node, feature, bin), and windows over at most BINS bins find the best split of every node.
What comes to the driver is one row a node.  A model of any number of rows is spread over tasks so, since only
sums of it are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import kept, new_path


class Setting(NamedTuple):
    """Fixed values, as published: depth, rounds at most, rate, shares of rows and columns of a round, penalties, and rounds without gain that end it."""

    depth: int = 8
    rounds: int = 2000
    rate: float = 0.08
    rows: float = 0.82
    columns: float = 0.84
    alpha: float = 0.12
    penalty: float = 0.06
    patience: int = 200
    least_child: float = 1.0


#: Bins of a feature; rounds between two writings of the rows' margins and of finished trees.
BINS, KEEP = 64, 16
#: Bins (a byte a row and feature) of a model that one task grows; models that are dealt out to tasks of their own; cells of one histogram.
TASK_CELLS, MOST_TASKS, HISTOGRAM_CELLS = 50_000_000, 10_000, 2_000_000
#: Nodes of trees that are broadcast together for a prediction.
MOST_NODES = 1_000_000
TREES = "model string, tree int, node int, feature int, bin int, cut double, value double, gain double"
_HISTOGRAM = "model string, node int, feature int, bin int, g double, h double"


def edges_of(rows: DataFrame, bins: int = BINS) -> np.ndarray:
    """Upper edges of each feature's bins but the last: quantiles of the rows' x, pre-aggregated by feature."""
    each = rows.select(F.posexplode("x").alias("feature", "value")).groupBy("feature")
    found = each.agg(F.percentile_approx("value", [i / bins for i in range(1, bins)], 10_000).alias("edges")).orderBy("feature").collect()
    return np.array([r.edges for r in found]).reshape(len(found), bins - 1)


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    """Rows of an Arrow column of arrays, or of bytes, of one length."""
    if kind == "bins":
        return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def binned(rows: DataFrame, edges: np.ndarray) -> DataFrame:
    """rows with bins (a byte a feature: how many edges lie below the value) for x, written by ranges of models."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(5), "x")
                found = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)], 1).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(np.zeros(len(x))), pa.array([r.tobytes() for r in found], pa.binary())], ["model", "vec_id", "label", "weight", "held_out", "margin", "bins"])

    slim = rows.selectExpr("cast(model as string) model", "vec_id", "cast(label as double) label", "cast(weight as double) weight", "held_out", "x")
    out = slim.mapInArrow(run, "model string, vec_id long, label double, weight double, held_out boolean, margin double, bins binary")
    return kept(out.repartitionByRange("model", "vec_id").sortWithinPartitions("model"))


class Tree:
    """One tree in a heap's order: feature (-1 in a leaf), bin, value and gain by node."""

    def __init__(self, depth: int):
        self.feature, self.bin = np.full((2 << depth) - 1, -1), np.zeros((2 << depth) - 1, np.int64)
        self.value, self.gain, self.depth = np.zeros((2 << depth) - 1), np.zeros((2 << depth) - 1), depth

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        node = np.zeros(len(bins), np.int64)
        for _ in range(self.depth):
            f = self.feature[node]
            right = bins[np.arange(len(bins)), np.maximum(f, 0)] > self.bin[node]
            node = np.where(f >= 0, 2 * node + 1 + right, node)
        return node

    def rows(self, model: str, number: int, edges: np.ndarray) -> list[tuple]:
        out, front = [], [0]
        while front:
            n = front.pop()
            f, b = int(self.feature[n]), int(self.bin[n])
            out.append((model, number, n, f, b, float(edges[f, b]) if f >= 0 else None, float(self.value[n]), float(self.gain[n])))
            if f >= 0:
                front += [2 * n + 1, 2 * n + 2]
        return out


def _place(ids: np.ndarray, salt: int) -> np.ndarray:
    """A number in 0 to 1 for each id, by a seeded hash."""
    x = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((salt * 0xBF58476D1CE4E5B9 + 42) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(11)).astype(float) / (1 << 53)


def _columns(n: int, share: float, tree: int) -> np.ndarray:
    """The features that a round looks at: the first of a seeded order."""
    keep = np.zeros(n, bool)
    keep[np.argsort(_place(np.arange(n), 2 * tree + 1), kind="stable")[: max(1, round(share * n))]] = True
    return keep


class _Pass(NamedTuple):
    """What tasks need for one level: each active model's new trees, its setting, and the number and first level of the tree in work."""

    trees: dict[str, list[Tree]]
    settings: dict[str, Setting]
    tree: int
    level: int


def _sums(rows: DataFrame, at: _Pass) -> DataFrame:
    """Gradient sums by model, node, feature and bin; at the first level also, as node and feature -1, the held-out rows' loss and weight."""
    sent = rows.sparkSession.sparkContext.broadcast(at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, settings, tree, level = sent.value
        held: dict[tuple[str, int], np.ndarray] = {}
        lost: dict[str, list[float]] = {}

        def hand_on():
            for (model, node), sums in held.items():
                f, b = np.nonzero(sums[1])
                n = len(f)
                yield pa.RecordBatch.from_arrays([pa.array([model] * n, pa.string()), pa.array(np.full(n, node, np.int32)), pa.array(f.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(sums[0][f, b]), pa.array(sums[1][f, b])], ["model", "node", "feature", "bin", "g", "h"])
            if lost:
                minus = pa.array([-1] * len(lost), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(list(lost), pa.string()), minus, minus, pa.array([0] * len(lost), pa.int32()), *(pa.array([x[k] for x in lost.values()], pa.float64()) for k in (0, 1))], ["model", "node", "feature", "bin", "g", "h"])
            held.clear(), lost.clear()

        for batch in batches:
            models = np.array(batch.column(0).to_pylist(), object)
            ids, label, weight, out, margin = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(1, 6))
            bins = _matrix(batch.column(6), "bins") if batch.num_rows else np.zeros((0, 1), np.uint8)
            for model in dict.fromkeys(models.tolist()):
                if model not in trees:
                    continue
                if not any(m == model for m, _ in held) and len(held) >= 256:  # rows come by ranges of models
                    yield from hand_on()
                mine, s = models == model, settings[model]
                x, y, w, z, test = bins[mine], label[mine], weight[mine], margin[mine].copy(), out[mine].astype(bool)
                done = trees[model][: len(trees[model]) - (level > 0)]
                for t in done:
                    z += t.value[t.nodes(x)]
                p = 1 / (1 + np.exp(-z))
                if level == 0 and test.any():
                    right = np.where(y[test] == 1, p[test], 1 - p[test])
                    total = lost.setdefault(model, [0.0, 0.0])
                    total[0] += float(-(w[test] * np.log(np.maximum(right, 1e-15))).sum())
                    total[1] += float(w[test].sum())
                use = ~test & (_place(ids[mine], 2 * tree) < s.rows)
                x, g, h = x[use], (w * (p - y))[use], (w * p * (1 - p))[use]
                node = trees[model][-1].nodes(x) if level else np.zeros(len(x), np.int64)
                columns = _columns(x.shape[1], s.columns, tree)
                first = (1 << level) - 1
                for n in np.unique(node[node >= first]).tolist():
                    here = node == n
                    sums = held.setdefault((model, n), np.zeros((2, x.shape[1], BINS)))
                    place = (np.arange(x.shape[1]) * BINS)[None, columns] + x[here][:, columns]
                    for k, v in enumerate((g, h)):
                        sums[k] += np.bincount(place.ravel(), np.repeat(v[here], columns.sum()), x.shape[1] * BINS).reshape(-1, BINS)
        yield from hand_on()

    # tasks have added up already, so one shuffle serves the sums and the windows over a feature's bins
    return rows.mapInArrow(run, _HISTOGRAM).repartition("model", "node", "feature").groupBy("model", "node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def best_splits(sums: DataFrame, alpha: float, penalty: float, least: float) -> DataFrame:
    """model, node, g, h (its sums) and best: feature, bin, gain and the left side's sums; equal gains go to the first feature and bin."""
    node = Window.partitionBy("model", "node", "feature")
    left = node.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    run = sums.withColumns({"gl": F.sum("g").over(left), "hl": F.sum("h").over(left), "gt": F.sum("g").over(node), "ht": F.sum("h").over(node)})
    shrunk = lambda g: F.greatest(F.abs(g) - alpha, F.lit(0.0))
    score = lambda g, h: shrunk(g) * shrunk(g) / (h + penalty)
    gain = score(F.col("gl"), F.col("hl")) + score(F.col("gt") - F.col("gl"), F.col("ht") - F.col("hl")) - score(F.col("gt"), F.col("ht"))
    able = (F.col("feature") >= 0) & (F.col("hl") >= least) & (F.col("ht") - F.col("hl") >= least)
    run = run.withColumn("gain", F.when(able, F.round(gain, 9)).otherwise(-1.0))
    split = F.struct("feature", "bin", "gain", "gl", "hl")
    order = F.struct("gain", -F.col("feature"), -F.col("bin"))
    return run.groupBy("model", "node").agg(F.max_by(F.struct("gt", "ht"), order).alias("sums"), F.max_by(split, order).alias("best"))


def _split(x: np.ndarray, k: np.ndarray, g: np.ndarray, h: np.ndarray, n: int, s: Setting) -> tuple[np.ndarray, ...]:
    """Gain, column, bin and the left side's sums of the best split of n nodes, whose rows have k; equal gains go to the first column and bin."""
    sums = np.zeros((2, n * x.shape[1] * BINS))
    columns = np.arange(x.shape[1])
    for at in range(0, len(x), 16_384):
        part = slice(at, at + 16_384)
        place = ((k[part, None] * x.shape[1] + columns) * BINS + x[part]).ravel()
        for i, v in enumerate((g, h)):
            sums[i] += np.bincount(place, np.repeat(v[part], x.shape[1]), sums.shape[1])
    gl, hl = sums.reshape(2, n, x.shape[1], BINS).cumsum(-1)
    gt, ht = gl[..., -1:], hl[..., -1:]
    shrunk = lambda v: np.maximum(np.abs(v) - s.alpha, 0.0)
    score = lambda a, b: shrunk(a) ** 2 / (b + s.penalty)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = score(gl, hl) + score(gt - gl, ht - hl) - score(gt, ht)
    gain = np.where((hl >= s.least_child) & (ht - hl >= s.least_child), np.round(gain, 9), -1.0).reshape(n, -1)
    best, node = gain.argmax(1), np.arange(n)
    return gain[node, best], best // BINS, best % BINS, gl.reshape(n, -1)[node, best], hl.reshape(n, -1)[node, best]


def _grown(ids: np.ndarray, y: np.ndarray, w: np.ndarray, test: np.ndarray, bins: np.ndarray, s: Setting) -> list[Tree]:
    """The trees that count of a model whose rows are all here: what the passes of `train` give."""
    z, trees, best = np.zeros(len(y)), [], (np.inf, 0)
    leaf = lambda g, h: -s.rate * np.sign(g) * max(abs(g) - s.alpha, 0.0) / (h + s.penalty) if h else 0.0
    while True:
        p, number = 1 / (1 + np.exp(-z)), len(trees)
        if test.any():
            right = np.where(y[test] == 1, p[test], 1 - p[test])
            now = -(w[test] * np.log(np.maximum(right, 1e-15))).sum() / w[test].sum()
            best = (now, number) if number and now < best[0] - 1e-12 else best
        if number >= s.rounds or test.any() and number - best[1] > s.patience:
            return trees[: best[1]] if test.any() else trees
        use, tree = ~test & (_place(ids, 2 * number) < s.rows), Tree(s.depth)
        columns = np.flatnonzero(_columns(bins.shape[1], s.columns, number))
        x, g, h = bins[use][:, columns], (w * (p - y))[use], (w * p * (1 - p))[use]
        at = np.zeros(len(x), np.int64)
        tree.value[0] = leaf(g.sum(), h.sum())
        for _ in range(s.depth):
            nodes, k = np.unique(at, return_inverse=True)
            gt, ht = np.bincount(k, g, len(nodes)), np.bincount(k, h, len(nodes))
            able = np.flatnonzero(ht >= 2 * s.least_child - 1e-9)
            per = max(1, HISTOGRAM_CELLS // (len(columns) * BINS))
            for few in (able[i : i + per] for i in range(0, len(able), per)):
                place = np.full(len(nodes), -1)
                place[few] = np.arange(len(few))
                here = place[k] >= 0
                for j, gain, f, b, gl, hl in zip(few.tolist(), *_split(x[here], place[k[here]], g[here], h[here], len(few), s), strict=True):
                    if gain > 0:
                        n = nodes[j]
                        tree.feature[n], tree.bin[n], tree.gain[n] = columns[f], b, gain
                        tree.value[2 * n + 1], tree.value[2 * n + 2] = leaf(gl, hl), leaf(gt[j] - gl, ht[j] - hl)
            on = tree.feature[at] >= 0
            if not on.any():
                break
            x, g, h, at = x[on], g[on], h[on], at[on]
            column = np.searchsorted(columns, tree.feature[at])
            at = 2 * at + 1 + (x[np.arange(len(x)), column] > tree.bin[at])
        z += tree.value[tree.nodes(bins)]
        trees.append(tree)


def _in_tasks(table: DataFrame, models: list[str], settings: dict[str, Setting], edges: np.ndarray) -> DataFrame:
    """The trees that count (TREES) of the models, a model a task."""
    index = table.sparkSession.createDataFrame([(m, i % MOST_TASKS) for i, m in enumerate(sorted(models))], "model string, nth int")  # one row a model
    dealt = table.join(F.broadcast(index), "model").select(*table.columns, "nth").repartitionById(min(len(models), MOST_TASKS), F.col("nth"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []

        def hand_on(model: str):
            trees = _grown(*(np.concatenate(c) for c in zip(*parts, strict=True)), settings[model])
            for at in range(0, len(trees), 64):
                rows = [r for i, t in enumerate(trees[at : at + 64], at) for r in t.rows(model, i, edges)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
            parts.clear()

        last = None
        for batch in batches:
            models = np.array(batch.column(0).to_pylist(), object)
            for model in dict.fromkeys(models.tolist()):  # rows are sorted by models
                if parts and model != last:
                    yield from hand_on(last)
                last, mine = model, batch.filter(pa.array(models == model))
                parts.append((*(mine.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3)), mine.column(4).to_numpy(zero_copy_only=False).astype(bool), _matrix(mine.column(6), "bins")))
        if parts:
            yield from hand_on(last)

    names = [c.split()[0] for c in TREES.split(", ")]
    kinds = [pa.string(), *[pa.int32()] * 4, *[pa.float64()] * 3]
    return dealt.sortWithinPartitions("model", "vec_id").drop("nth").mapInArrow(run, TREES)


class Model(NamedTuple):
    """trees: a table of nodes (TREES); edges: of the features' bins; rounds: trees that count, by model."""

    trees: DataFrame
    edges: np.ndarray
    rounds: dict[str, int]


def train(rows: DataFrame, setting: Setting | dict[str, Setting], edges: np.ndarray | None = None) -> Model:
    """Trees for all models of rows: model, vec_id, label (0 or 1), weight, held_out, x (arrays of one length).

    A model ends when its held-out loss hasn't fallen for `patience` rounds, and keeps the rounds up to the
    lowest loss, the first at least; without held-out rows it makes all rounds.  Settings with the same penalties are trained
    together, whatever else differs.  Models of up to TASK_CELLS are grown by tasks.  The others come to the driver
    as one row a node of one level; finished trees are written every KEEP rounds.
    """
    spark = rows.sparkSession
    edges = edges_of(rows) if edges is None else edges
    table = binned(rows, edges)
    sizes = table.groupBy("model").agg(F.sum(F.length("bins")).alias("cells")).collect()  # one row a model
    names, whole = [r.model for r in sizes], sorted(r.model for r in sizes if r.cells <= TASK_CELLS)
    settings = setting if isinstance(setting, dict) else dict.fromkeys(names, setting)
    loss: dict[str, tuple[float, int]] = {m: (np.inf, 0) for m in names}  # least so far, and the rounds that gave it
    active, new, path = set(names) - set(whole), {m: [] for m in names}, new_path(spark, "trees")
    spark.createDataFrame([], TREES).write.parquet(path)
    last = dict.fromkeys(names, 0)
    common = {(s.alpha, s.penalty, s.least_child) for s in settings.values()}
    if len(common) > 1:
        raise ValueError("settings that are trained together have the same penalties")
    alpha, penalty, least = common.pop() if common else (0.0, 0.0, 0.0)
    leaf = lambda m, g, h: -settings[m].rate * np.sign(g) * max(abs(g) - alpha, 0.0) / (h + penalty) if h else 0.0

    def write(finished: dict[str, list[Tree]], before: int) -> None:
        out = [r for m, ts in finished.items() for i, t in enumerate(ts) for r in t.rows(m, before + i, edges)]
        if out:
            spark.createDataFrame(out, TREES).write.mode("append").parquet(path)

    if whole:
        _in_tasks(table, whole, settings, edges).write.mode("append").parquet(path)
        made = spark.read.schema(TREES).parquet(path).groupBy("model").agg((F.max("tree") + 1).alias("rounds")).collect()  # one row a model
        loss |= {r.model: (0.0, r.rounds) for r in made}
        if active:
            table = kept(table.join(F.broadcast(spark.createDataFrame([(m,) for m in whole], "model string")), "model", "left_anti"))
    number = before = 0
    while active:
        front: dict[str, set[int]] = {}
        for level in range(max(settings[m].depth for m in active)):
            work = {m for m in active if level == 0 or level < settings[m].depth and front.get(m)}
            if not work:
                break
            found = best_splits(_sums(table, _Pass({m: new[m] for m in work}, settings, number, level)), alpha, penalty, least).collect()
            if level == 0:
                for r in found:
                    if r.node < 0 and number and (now := r.sums.gt / r.sums.ht) < loss[r.model][0] - 1e-12:
                        loss[r.model] = now, number
                tested = {r.model for r in found if r.node < 0}
                for m in list(active):
                    last[m] = number
                    if number >= settings[m].rounds or m in tested and number - loss[m][1] > settings[m].patience:
                        active.discard(m)
                        if m not in tested:
                            loss[m] = loss[m][0], number
                for m in active:
                    new[m].append(Tree(settings[m].depth))
            nexts: dict[str, set[int]] = {}
            for r in found:
                if r.node < 0 or r.model not in active or level and r.node not in front[r.model]:
                    continue
                t, b = new[r.model][-1], r.best
                if level == 0:
                    t.value[0] = leaf(r.model, r.sums.gt, r.sums.ht)
                if b.gain <= 0:
                    continue
                t.feature[r.node], t.bin[r.node], t.gain[r.node] = b.feature, b.bin, b.gain
                t.value[2 * r.node + 1] = leaf(r.model, b.gl, b.hl)
                t.value[2 * r.node + 2] = leaf(r.model, r.sums.gt - b.gl, r.sums.ht - b.hl)
                nexts.setdefault(r.model, set()).update((2 * r.node + 1, 2 * r.node + 2))
            front = nexts
        number += 1
        if active and number - before >= KEEP:
            write(new, before)
            table = _advanced(table, {m: new[m] for m in active})
            new, before = {m: [] for m in names}, number
    write(new, before)
    rounds = {m: loss[m][1] for m in names}
    counts = spark.createDataFrame(list(rounds.items()), "model string, rounds int")  # one row a model
    trees = spark.read.schema(TREES).parquet(path).join(counts, "model").where("tree < rounds").drop("rounds")
    return Model(trees, edges, rounds)


def _advanced(table: DataFrame, trees: dict[str, list[Tree]]) -> DataFrame:
    """The rows of models that go on, with what their new trees give added to their margins."""
    sent = table.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array([m in sent.value for m in batch.column(0).to_pylist()], pa.bool_()))
            if not batch.num_rows:
                continue
            models, margin, bins = np.array(batch.column(0).to_pylist(), object), batch.column(5).to_numpy().copy(), _matrix(batch.column(6), "bins")
            for model in dict.fromkeys(models.tolist()):
                mine = models == model
                for t in sent.value[model]:
                    margin[mine] += t.value[t.nodes(bins[mine])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(margin), batch.column(6)], batch.schema.names)

    return kept(table.mapInArrow(run, table.schema))


def _blocks(trees: DataFrame) -> list[list[str]]:
    """Models whose trees are broadcast together, MOST_NODES nodes or one model at a time."""
    out, size = [[]], 0
    for r in trees.groupBy("model").agg(F.count(F.lit(1)).alias("n")).orderBy("model").collect():  # one row a model
        if out[-1] and size + r.n > MOST_NODES:
            out.append([])
            size = 0
        out[-1].append(r.model)
        size += r.n
    return out


def predict(trees: DataFrame, rows: DataFrame) -> DataFrame:
    """rows without x, and score: the probability that a model's trees give; 0.5 for a model without trees.

    Rows are read once: where trees are broadcast in several blocks, they are written first.
    """
    spark, done = rows.sparkSession, None
    plain = [c for c in rows.columns if c != "x"]
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in plain) + ", score double"
    blocks = _blocks(trees)
    rows = rows if len(blocks) == 1 else kept(rows)  # each block reads them
    for block in blocks:
        found: dict[str, dict[int, dict[int, tuple]]] = {}
        for r in trees.where(F.col("model").isin(block)).toLocalIterator():  # at most MOST_NODES, or one model
            found.setdefault(r.model, {}).setdefault(r.tree, {})[r.node] = (r.feature, r.cut, r.value)
        sent = spark.sparkContext.broadcast({m: [_flat(t) for t in ts.values()] for m, ts in found.items()})

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                models, x = np.array(batch.column(0).to_pylist(), object), _matrix(batch.column(1), "x")
                z = np.zeros(len(x))
                for model in dict.fromkeys(models.tolist()):
                    mine = models == model
                    for feature, cut, child, value in sent.value.get(model, ()):
                        node, here = np.zeros(mine.sum(), np.int64), x[mine]
                        while (feature[node] >= 0).any():
                            f = feature[node]
                            right = here[np.arange(len(here)), np.maximum(f, 0)] > cut[node]
                            node = np.where(f >= 0, child[node] + right, node)
                        z[mine] += value[node]
                yield pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array(1 / (1 + np.exp(-z)))], [*batch.schema.names[2:], "score"])

        rows_ = rows.withColumn("_model", F.col("model").cast("string"))
        if len(blocks) == 1:
            part = rows_  # rows of models without trees are scored too
        elif done is None:
            others = F.broadcast(trees.select(F.col("model").alias("_model"), F.lit(True).alias("_known")).distinct())  # one row a model
            part = rows_.join(others, "_model", "left").where(F.col("_model").isin(block) | F.col("_known").isNull())
        else:
            part = rows_.where(F.col("_model").isin(block))
        scored = part.select("_model", "x", *plain).mapInArrow(run, schema)
        done = scored if done is None else done.unionByName(scored)
    return done


def _flat(tree: dict[int, tuple]) -> tuple[np.ndarray, ...]:
    """feature, cut, place of the left child (the right one follows) and value, root first."""
    order = [0]
    child, at = [], 0
    while at < len(order):
        n = order[at]
        child.append(len(order))
        if tree[n][0] >= 0:
            order += [2 * n + 1, 2 * n + 2]
        at += 1
    cells = [tree[n] for n in order]
    return np.array([c[0] for c in cells]), np.array([np.nan if c[1] is None else c[1] for c in cells]), np.array(child), np.array([c[2] for c in cells])


def importances(trees: DataFrame, names: list[str], k: int = 15) -> DataFrame:
    """model, dim, importance of the k features that a model gains most by, as shares of all its gain."""
    labels = F.array(*map(F.lit, names))
    gains = trees.where("feature >= 0").groupBy("model", "feature").agg(F.sum("gain").alias("gain"))
    whole = Window.partitionBy("model")  # a row a feature
    ranked = gains.withColumn("importance", F.col("gain") / F.sum("gain").over(whole)).withColumn("nth", F.row_number().over(whole.orderBy(F.desc("gain"), "feature")))
    return ranked.where(F.col("nth") <= k).select("model", F.get(labels, F.col("feature")).alias("dim"), "importance")
