"""Classifiers, their samples and features, neighbours by blocks, and terms with compounds, against plain versions."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierlex.operators import boost, communities, learn, ranks, text, vectors
from tierlex.operators.stats import dim_stats


def words(spark, n=240, size=6, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        town = int(rng.integers(0, 6))
        v = rng.standard_normal(size) + 3 * np.eye(size)[town]
        rows.append((i, town, town % 3, int(town < 3), [float(x) for x in v], random.Random(i).choice(["noun", "verb", None])))
    return rows, spark.createDataFrame(rows, "vec_id long, town_id long, island_id long, is_capital int, v array<double>, pos string")


@pytest.mark.parametrize("block", [2048, 16])
def test_neighbours_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    rows, df = words(spark)
    rows = [*rows, (900, 0, 0, 1, [0.0] * 6, None), (901, 77, 0, 1, [1.0] * 6, None)]
    df = df.union(spark.createDataFrame(rows[-2:], df.schema))
    got = {}
    for r in vectors.neighbours(df, 4).collect():
        got.setdefault(r.a, []).append((r.nth, r.b, r.cos))
    unit = lambda v: np.asarray(v) / (np.linalg.norm(v) or 1.0)
    for i, town, _, _, v, _ in rows:
        near = sorted((-round(float(unit(v) @ unit(w)), 9) + 0.0, j) for j, t, _, _, w, _ in rows if t == town and j != i)[:4]
        assert [(b, pytest.approx(c)) for _, b, c in sorted(got.get(i, []))] == [(j, -c) for c, j in near]


def test_points_are_sent_a_few_times(spark):
    """Of a group with five blocks of points each query is sent once, and each point once for a block of queries."""
    points = spark.range(9000).select(F.lit(1).cast("long").alias("town_id"), F.col("id").alias("vec_id"), F.array((F.col("id") % 97).cast("double"), F.lit(1.0)).alias("v"))
    assert [x.count() for x in vectors.sent(points.where("vec_id < 40"), points, "town_id")] == [40, 9000]
    assert [x.count() for x in vectors.sent(points, points, "town_id")] == [9000, vectors.CUTS * 9000]
    near = vectors.nearest_of(points.where("vec_id < 40"), points, 3).where("a = 1").orderBy("nth").collect()
    assert [r.b for r in near] == [98, 195, 292]


def test_negatives_and_folds(spark):
    rows, df = words(spark)
    both = [(5, 77, 2, 0, [1.0] * 6, None), (6, 78, 1, 0, [1.0] * 6, None)]  # words of two towns
    rows, df = rows + both, df.union(spark.createDataFrame(both, df.schema))
    island = {r[1]: r[2] for r in rows}
    members = {t: {r[0] for r in rows if r[1] == t} for t in island}
    at = {i: {r[0] for r in rows if r[2] == i} for i in set(island.values())}
    every = {r[0] for r in rows}
    for siblings in (True, False):
        pools = {}
        for r in learn.negatives(df, per=2, siblings=siblings).collect():
            pools.setdefault((r.town_id, r.pool), []).append(r.vec_id)
        for town, own in members.items():
            hard, easy = (at[island[town]] - own, every - at[island[town]]) if siblings else (set(), every - own)
            order = lambda i: hashlib.md5(f"{i}:{learn.SEED}".encode()).hexdigest()
            n = min(len(hard), len(own))
            assert sorted(pools.get((town, "sibling"), [])) == sorted(sorted(hard, key=order)[:n])
            assert sorted(pools.get((town, "global"), [])) == sorted(sorted(easy, key=order)[: 2 * len(own) - n])
    sample = learn.samples(df, dim_stats(df)).collect()
    assert {r.town_id for r in sample} == {t for t, own in members.items() if len(own) >= learn.LEAST_POSITIVES}
    for town in {r.town_id for r in sample}:
        mine = [r for r in sample if r.town_id == town]
        for label in (0.0, 1.0):
            sizes = [sum(r.fold == k and r.label == label for r in mine) for k in range(learn.FOLDS)]
            assert max(sizes) - min(sizes) <= 1
        assert {r.weight for r in mine if r.label == 1} == {sum(r.label == 0 for r in mine) / len(members[town])}


def test_features_are_plain(spark):
    rows, df = words(spark, 60)
    pairs = df.drop("town_id").crossJoin(spark.createDataFrame([(2,), (99,)], "town_id long"))
    got = {(r.town_id, r.vec_id): r.x for r in learn.features(pairs, df, dim_stats(df), k=3).collect()}
    own = [r for r in rows if r[1] == 2]
    x = np.array([r[4] for r in rows])
    z = (x - x.mean(0)) / x.std(0)
    unit = lambda v: np.asarray(v) / np.linalg.norm(v)
    middle = unit(np.mean([unit(r[4]) for r in own], 0))
    for k, r in enumerate(rows):
        near = sorted((float(unit(r[4]) @ unit(o[4])) for o in own if o[0] != r[0]), reverse=True)[:3]
        want = [*z[k], *(float(r[5] == p) for p in ("noun", "verb", "adj", "adv")), np.mean(near), float(unit(r[4]) @ middle)]
        assert got[2, r[0]] == pytest.approx(want)
        assert got[99, r[0]] == pytest.approx([*want[:-2], 0.0, 0.0])
    assert learn.feature_names(6)[6:] == ["pos_noun", "pos_verb", "pos_adj", "pos_adv", "knn_mean", "centroid_cos"]


def plain_trees(x, y, w, out, s, edges):
    """Boosting of one model row by row, without Spark: (tree, node) to feature, bin and value; and the rounds that count."""
    bins = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)], 1)
    z, nodes, best, tree = np.zeros(len(x)), {}, (np.inf, 0), 0
    while True:
        p = 1 / (1 + np.exp(-z))
        loss = -(w * np.log(np.where(y == 1, p, 1 - p)))[out].sum() / w[out].sum()
        if loss < best[0] - 1e-12:
            best = loss, tree
        if tree >= s.rounds or tree - best[1] > s.patience:
            return nodes, best[1]
        g, h, here = w * (p - y), w * p * (1 - p), {0: np.flatnonzero(~out)}
        soft = lambda v: max(abs(v) - s.alpha, 0.0)
        score = lambda i: soft(g[i].sum()) ** 2 / (h[i].sum() + s.penalty)  # noqa: E731, B023
        at = np.zeros(len(x), int)
        for level in range(s.depth + 1):
            for n, rows in sorted(here.items()):
                value = -s.rate * np.sign(g[rows].sum()) * soft(g[rows].sum()) / (h[rows].sum() + s.penalty)
                found = []
                for f in range(x.shape[1]) if level < s.depth else ():
                    for b in sorted(set(bins[rows, f])):
                        left, right = rows[bins[rows, f] <= b], rows[bins[rows, f] > b]
                        if len(left) and len(right) and h[left].sum() >= s.least_child and h[right].sum() >= s.least_child:
                            found.append((round(score(left) + score(right) - score(rows), 9), -f, -b))
                gain, f, b = max(found, default=(0, 0, 0))
                nodes[tree, n] = (-f, -b, value) if gain > 0 else (-1, 0, value)
                if gain > 0:
                    mine = at == n
                    at[mine] = 2 * n + 1 + (bins[mine, -f] > -b)
            here = {n: np.flatnonzero(~out & (at == n)) for n in set(at[~out].tolist()) if (tree, n) not in nodes}
        z += np.array([nodes[tree, n][2] for n in at])
        tree += 1


@pytest.mark.parametrize("keep", [16, 2])
def test_trees_of_many_models_equal_plain_ones(spark, monkeypatch, keep):
    monkeypatch.setattr(boost, "KEEP", keep)
    rng = np.random.default_rng(4)
    data, settings = {}, {}
    for m in range(5):
        n = 60 + 30 * m
        x = np.round(rng.standard_normal((n, 4)), 2)
        y = (x[:, m % 4] + 0.5 * x[:, (m + 1) % 4] + rng.normal(0, 0.3, n) > 0.4).astype(float)
        data[f"m{m}"] = x, y, np.where(y == 1, 2.0, 1.0), np.arange(n) % 5 == 0
        settings[f"m{m}"] = boost.Setting(depth=2 + m % 2, rounds=3 + m, rate=0.4, rows=1.0, columns=1.0, patience=2 + m)
    rows = [(m, i, float(y[i]), float(w[i]), bool(out[i]), [float(v) for v in x[i]]) for m, (x, y, w, out) in data.items() for i in range(len(y))]
    df = spark.createDataFrame(rows, "model string, vec_id long, label double, weight double, held_out boolean, x array<double>").repartition(5)
    edges = np.tile(np.linspace(-2, 2, boost.BINS - 1), (4, 1))
    model = boost.train(df, settings, edges)
    found = {}
    for r in model.trees.collect():
        found.setdefault(r.model, {})[r.tree, r.node] = r
    scores = {(r.model, r.vec_id): r.score for r in boost.predict(model.trees, df.select("model", "vec_id", "x")).collect()}
    for m, (x, y, w, out) in data.items():
        nodes, rounds = plain_trees(x, y, w, out, settings[m], edges)
        assert model.rounds[m] == rounds > 0
        want = {k: v for k, v in nodes.items() if k[0] < rounds}
        assert set(found[m]) == set(want)
        for k, (f, b, value) in want.items():
            assert (found[m][k].feature, found[m][k].bin if f >= 0 else 0) == (f, b) and found[m][k].value == pytest.approx(value)
        bins = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)], 1)
        for i in range(len(y)):
            z = 0.0
            for t in range(rounds):
                n = 0
                while want[t, n][0] >= 0:
                    n = 2 * n + 1 + (bins[i, want[t, n][0]] > want[t, n][1])
                z += want[t, n][2]
            assert scores[m, i] == pytest.approx(1 / (1 + np.exp(-z)))
    monkeypatch.setattr(boost, "MOST_NODES", 20)
    again = {(r.model, r.vec_id): r.score for r in boost.predict(model.trees, df.unionByName(df.limit(3).withColumn("model", F.lit("none"))).select("model", "vec_id", "x")).collect()}
    assert {k: v for k, v in again.items() if k[0] != "none"} == scores and {v for k, v in again.items() if k[0] == "none"} == {0.5}


def test_rounds_with_shares_of_rows_and_columns(spark):
    """Rows and columns of a round are drawn by seeded hashes: the same trees however rows are spread, and only columns that were drawn."""
    rng = np.random.default_rng(6)
    x = rng.standard_normal((200, 10))
    rows = [("a", i, float(x[i, 0] > 0), 1.0, i % 7 == 0, x[i].tolist()) for i in range(200)]
    df = spark.createDataFrame(rows, "model string, vec_id long, label double, weight double, held_out boolean, x array<double>")
    setting, edges = boost.Setting(depth=3, rounds=4, rate=0.3), boost.edges_of(df)
    trees = lambda d: sorted((r.tree, r.node, r.feature, r.bin, round(r.value, 9)) for r in boost.train(d, setting, edges).trees.collect())
    first = trees(df.repartition(1))
    assert first == trees(df.repartition(7))
    for tree in {t for t, *_ in first}:
        assert {f for t, _, f, *_ in first if t == tree and f >= 0} <= set(np.flatnonzero(boost._columns(10, 0.84, tree)).tolist())
    assert boost.train(df.limit(0), setting, edges).trees.count() == 0


def test_classifiers_are_saved_and_predict_all_words(spark, tmp_path):
    rows, df = words(spark)
    dims, setting = dim_stats(df), learn.QUICK._replace(rounds=3)
    some = learn.train_or_load(df.where("town_id < 2"), f"{tmp_path}/m", dims, setting)
    assert {r.model for r in some.collect()} == {"0", "1"}
    trees = learn.train_or_load(df, f"{tmp_path}/m", dims, setting)
    assert {r.model for r in trees.collect()} == {str(t) for t in range(6)}
    assert learn.train_or_load(df, f"{tmp_path}/m", dims, setting).count() == trees.count()
    assert learn.train_or_load(df.limit(5), f"{tmp_path}/few", dims, setting).count() == 0
    scores = {(r.town_id, r.word_id): r.score for r in learn.predict_all(trees, df, df, dims).collect()}
    assert len(scores) == 6 * len(rows)
    for t in range(6):
        assert np.mean([scores[t, r[0]] for r in rows if r[1] == t]) > 0.2 + np.mean([scores[t, r[0]] for r in rows if r[1] != t])


def test_average_precision(spark):
    rows = [(1, 0.9), (0, 0.9), (1, 0.8), (0, 0.7), (1, 0.1)]
    df = spark.createDataFrame(rows, "label int, score double")
    assert learn.average_precision(df).first().auc_pr == pytest.approx(1 / 3 * 1 / 2 + 1 / 3 * 2 / 3 + 1 / 3 * 3 / 5)
    assert learn.average_precision(df.where("label = 0")).first().auc_pr is None
    assert learn.metrics(df).first().auc_pr == pytest.approx(0.5888888)


def test_terms_are_longest_compounds(spark):
    docs = spark.createDataFrame([(1, "New York City Hall, new york and the York city"), (2, None), (3, ""), (4, "Über-Größe of the new")], "doc_id long, text string")
    compounds = spark.createDataFrame([("new york",), ("new york city",), ("york city",), ("über größe",), ("of the",)], "compound string")
    stop = spark.createDataFrame([("the",), ("of the",)], "word string")
    got = {(r.doc_id, r.token): r.n for r in text.matched_terms(docs, compounds, stop).collect()}
    assert got == {(1, "new york city"): 1, (1, "hall"): 1, (1, "new york"): 1, (1, "and"): 1, (1, "york city"): 1, (4, "über größe"): 1, (4, "new"): 1}


def plain_terms(words, compounds):
    out, i = [], 0
    while i < len(words):
        n = max([k for k in range(2, len(words) - i + 1) if " ".join(words[i : i + k]) in compounds], default=1)
        out.append(" ".join(words[i : i + n]))
        i += n
    return out


def test_terms_equal_a_walk_from_left_to_right(spark):
    """Random texts over few words, compounds up to six words, some of which begin like others; then no compounds at all."""
    rng = random.Random(12)
    draw = lambda n: " ".join(rng.choice("abcd") for _ in range(n))
    known = {draw(rng.randint(2, 6)) for _ in range(40)} | {"a a a a a a", "a a"}
    texts = [draw(rng.randint(0, 40)) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    stop = spark.createDataFrame([("a",), ("a a",)], "word string")
    for compounds in (known, set()):
        got = {(r.doc_id, r.token): r.n for r in text.matched_terms(docs, spark.createDataFrame([(c,) for c in compounds], "compound string"), stop).collect()}
        assert got == Counter((i, w) for i, t in enumerate(texts) for w in plain_terms(t.split(), compounds) if w not in ("a", "a a"))
    weights = spark.createDataFrame([("g", "b", 51), ("g", "c d", 102), ("h", "zz", 5)], "grp string, token string, weight int")
    background = spark.createDataFrame([("g", 0.1, 0.5), ("h", 0.0, 0.0)], "grp string, mean double, std double")
    one = spark.createDataFrame([(1, "C d b b"), (2, "zz"), (3, None)], "doc_id long, text string")
    scores = {(r.doc_id, r.grp): (r.n_words, round(r.score, 9), round(r.z, 3)) for r in text.score_texts(one, spark.createDataFrame([("c d",)], "compound string"), stop, weights, background).collect()}
    assert scores == {(1, "g"): (2, 0.6, 1.0), (2, "h"): (1, round(5 / 255, 9), round(5 / 255 / 1e-6, 3))}


def test_missing_vectors_are_added_once(spark, tmp_path):
    texts = spark.createDataFrame([(i, f"t{i % 3}") for i in range(6)], "key long, text string")
    seen = []

    def encode(rows, c):
        seen.append(sorted(r[0] for r in rows.collect()))
        return rows.selectExpr(c, "array(1.0D) AS v")

    vectors.embed_missing(texts.where("key < 2"), f"{tmp_path}/v", "key", "text", encode)
    for _ in range(2):
        vectors.embed_missing(texts, f"{tmp_path}/v", "key", "text", encode)
    assert seen == [["t0", "t1"], ["t0", "t1", "t2"], []]
    assert sorted(r.key for r in spark.read.parquet(f"{tmp_path}/v").collect()) == list(range(6))


def test_communities_are_connected_and_better_than_singles(spark):
    """Planted groups are found; every community hangs together by its own links."""
    rng = random.Random(8)
    edges = [(1, a, b, 1.0) for a in range(60) for b in range(a + 1, 60) if rng.random() < (0.6 if a // 15 == b // 15 else 0.03)]
    edges += [(1, 100 + k, 101 + k, 1.0) for k in range(12)]
    got = {r.node: r.community for r in learn.communities(spark.createDataFrame(edges, "town_id long, a long, b long, w double"), "town_id").collect()}
    assert all(len({got[k] for k in range(15 * g, 15 * g + 15)}) == 1 for g in range(4)) and len({got[k] for k in range(60)}) == 4
    for c in set(got.values()) - {-1}:
        nodes = {x for x in got if got[x] == c}
        seen, front = set(), [min(nodes)]
        while front:
            x = front.pop()
            if x not in seen:
                seen.add(x)
                front += [b if a == x else a for _, a, b, _ in edges if x in (a, b) and {a, b} <= nodes]
        assert seen == nodes


def plain_modularity(edges, label):
    whole = 2 * sum(w for *_, w in edges)
    inside, total = {}, {}
    for a, b, w in edges:
        for x in (a, b):
            total[label[x]] = total.get(label[x], 0.0) + w
        if label[a] == label[b]:
            inside[label[a]] = inside.get(label[a], 0.0) + 2 * w
    return sum(inside.get(c, 0.0) / whole - (t / whole) ** 2 for c, t in total.items())


def test_modularity_is_plain(spark):
    rng = random.Random(1)
    edges = list({(a, b): (a, b, rng.random()) for a, b in (sorted(rng.sample(range(40), 2)) for _ in range(200))}.values())
    label = {x: rng.randrange(5) for x in range(40)}
    both = spark.createDataFrame([(7, *e) for e in edges] + [(7, b, a, w) for a, b, w in edges], "grp long, a long, b long, w double")
    labels = spark.createDataFrame([(7, *x) for x in label.items()], "grp long, node long, label long")
    assert communities.modularity(both, labels).first().q == pytest.approx(plain_modularity(edges, label))


def test_rounds_are_as_good_as_one_task(spark):
    """One graph in one group of many tasks: planted groups, a chain, a star and a pair; connected, and within 1 % of the moves one by one."""
    rng = random.Random(5)
    edges = [(a, b, rng.choice([1.0, 0.5])) for a in range(120) for b in range(a + 1, 120) if rng.random() < (0.5 if a // 20 == b // 20 else 0.03)]
    edges += [(200 + k, 201 + k, 1.0) for k in range(30)] + [(300, 301 + k, 1.0) for k in range(40)] + [(400, 401, 1.0)]
    df = spark.createDataFrame([(1, *e) for e in edges], "town_id long, a long, b long, w double").repartition(6)
    label = lambda rows: {r.node: r.community if r.community >= 0 else 400 for r in rows}
    bulk = learn.communities(df, "town_id", most=0).collect()
    task = learn.communities(df, "town_id").collect()
    assert {r.node for r in bulk if r.community < 0} == {400, 401} == {r.node for r in task if r.community < 0}
    assert plain_modularity(edges, label(bulk)) >= 0.99 * plain_modularity(edges, label(task)) > 0.5
    got = label(bulk)
    assert set(got) == {x for a, b, _ in edges for x in (a, b)}
    for c in set(got.values()):
        nodes = {x for x in got if got[x] == c}
        assert c == min(nodes)
        seen, front = set(), [min(nodes)]
        while front:
            x = front.pop()
            if x not in seen:
                seen.add(x)
                front += [b if a == x else a for a, b, _ in edges if x in (a, b) and {a, b} <= nodes]
        assert seen == nodes
    assert communities.bulk_communities(df.limit(0), "town_id").count() == 0


@pytest.mark.parametrize("block", [2048, 3])
def test_nearest_of_many_centroids_is_proven(spark, monkeypatch, block):
    """Any number of centroids: equal to comparing all pairs, with ties, copies, opposite vectors and one of length 0."""
    monkeypatch.setattr(vectors, "BLOCK", block)
    rng = np.random.default_rng(block)
    c = np.concatenate([rng.standard_normal((80, 5)), np.eye(5), -np.eye(5), np.eye(5)[:2]])
    v = np.concatenate([rng.standard_normal((120, 5)), np.eye(5), c[:20], np.zeros((1, 5))])
    words_ = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, v array<double>").repartition(3)
    groups = spark.createDataFrame([(int(i), x.tolist()) for i, x in enumerate(c)], "grp long, c array<double>").repartition(2)
    unit = lambda x: x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    cos = unit(v) @ unit(c).T
    got = {r.vec_id: (r.nearest, r.best) for r in vectors.nearest_centroid(words_, groups, "grp").collect()}
    assert {i: x for i, (x, _) in got.items()} == dict(enumerate(np.round(cos, 9).argmax(1).tolist()))
    assert all(b == pytest.approx(cos[i].max(), abs=1e-9) for i, (_, b) in got.items())
    assert vectors.nearest_centroid(words_, groups.limit(0), "grp").count() == 0


@pytest.mark.parametrize("buckets", [4096, 2])
def test_quantiles_are_exact(spark, monkeypatch, buckets):
    """Ties, one value, far apart values, negative ones, nulls and NaN; few buckets take more passes."""
    monkeypatch.setattr(ranks, "BUCKETS", buckets)
    rng = random.Random(buckets)
    groups = {"a": [rng.gauss(0, 1) for _ in range(101)], "b": [1.0] * 9 + [2.0], "c": [3.5], "d": [1e-300, 1e300, -1e300, 0.0], "e": [float(rng.randint(0, 3)) for _ in range(50)]}
    rows = [(g, x) for g, xs in groups.items() for x in xs] + [("a", None), ("a", float("nan")), ("f", None)]
    df = spark.createDataFrame(rows, "grp string, x double").repartition(3)
    shares = {"least": 0.0, "p25": 0.25, "half": 0.5, "p99": 0.99, "most": 1.0}
    got = {r.grp: r for r in ranks.quantiles(df, ["grp"], "x", shares).collect()}
    assert set(got) == set(groups)
    for g, xs in groups.items():
        for name, p in shares.items():
            assert got[g][name] == pytest.approx(float(np.quantile(np.array(xs), p)), rel=1e-12), (g, name)
    assert ranks.quantiles(df.limit(0), ["grp"], "x", shares).count() == 0


def test_terms_of_blocks(spark, monkeypatch):
    """Many blocks, two texts of one document, a hash that meets no run; places of texts aren't shuffled: exchanges hold whole texts, or a block's different runs."""
    rng = random.Random(5)
    known = {" ".join(rng.choice("abc") for _ in range(n)) for n in (2, 3, 2, 3, 4)} | {"zz zz"}
    rows = [(i % 15, " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 30)))) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(text, "BLOCK_WORDS", 25)
    made = text.matched_terms(docs, spark.createDataFrame([(c,) for c in known], "compound string"), spark.createDataFrame([("d",)], "word string"))
    want = Counter()
    for i, t in rows:
        want.update((i, w) for w in plain_terms(t.split(), known) if w != "d")
    assert {(r.doc_id, r.token): r.n for r in made.collect()} == want
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" not in plan and "pos#" not in plan


def test_once_each_counts_documents(spark):
    """An entry counts once a document, also where a document has two texts."""
    for rows, wanted in (([(1, ["a", "a", "b"]), (2, ["a"])], {"a": 2, "b": 1}), ([(1, ["a"]), (1, ["a", "b"]), (2, ["b"])], {"a": 1, "b": 2})):
        docs = spark.createDataFrame(rows, "doc_id long, w array<string>")
        assert {r.x: r.n for r in text.once_each(docs, "w", "x").collect()} == wanted


def test_towns_are_trained_with_the_published_trees(spark, monkeypatch):
    """All rounds and depths of the published setting unless the held-out loss ends them; models grown by a task equal those grown by passes."""
    used = []
    monkeypatch.setattr(boost, "train", lambda rows, setting, edges=None, plain=boost.train: used.append(setting) or plain(rows, setting._replace(rounds=3), edges))
    rows, df = words(spark)
    sample = learn.kept(learn.samples(df))
    model, _ = learn.train_towns(sample)
    assert used == [boost.Setting()] == [boost.Setting(depth=8, rounds=2000, rate=0.08, rows=0.82, columns=0.84, patience=200)]
    trees = lambda m: sorted((r.model, r.tree, r.node, r.feature, r.bin, round(r.value, 9), round(r.gain, 6)) for r in m.trees.collect())
    want = trees(model)
    assert len(want) > 20
    few = sorted(r.n for r in sample.groupBy("town_id").agg(F.count(F.lit(1)).alias("n")).collect())
    monkeypatch.setattr(boost, "TASK_CELLS", few[len(few) // 2] * len(sample.first().x) - 1)
    mixed = learn.train_towns(sample)[0]
    assert trees(mixed) == want and mixed.rounds == model.rounds
    rng = np.random.default_rng(1)
    bins = rng.integers(0, boost.BINS, (300, 5)).astype(np.uint8)
    grown = lambda: [(t.feature.tolist(), t.bin.tolist(), t.value.tolist()) for t in boost._grown(np.arange(300), (bins[:, 0] > 30).astype(float), np.ones(300), np.arange(300) % 7 == 0, bins, boost.Setting(rounds=4))]
    want = grown()
    monkeypatch.setattr(boost, "HISTOGRAM_CELLS", 1)
    assert grown() == want and len(want) > 1


@pytest.mark.parametrize("cells", [50_000_000, 0])
def test_a_model_that_never_gains_keeps_its_first_tree(spark, monkeypatch, cells):
    monkeypatch.setattr(boost, "TASK_CELLS", cells)
    rows = [("a", i, float(i % 2 != (i % 5 == 0)), 1.0, i % 5 == 0, [float(i % 2)]) for i in range(100)]  # held-out labels are the other way round
    df = spark.createDataFrame(rows, "model string, vec_id long, label double, weight double, held_out boolean, x array<double>")
    model = boost.train(df, boost.Setting(depth=2, rounds=9, rows=1.0, columns=1.0, patience=3), np.full((1, boost.BINS - 1), 0.5))
    assert model.rounds == {"a": 1} and {r.tree for r in model.trees.collect()} == {0}


def test_saved_classifiers_are_the_published_ones(spark, monkeypatch, tmp_path):
    used = []
    monkeypatch.setattr(boost, "train", lambda rows, setting, edges=None, plain=boost.train: used.append(setting) or plain(rows, setting._replace(rounds=1), edges))
    assert {r.model for r in learn.train_or_load(words(spark)[1], f"{tmp_path}/m").collect()} == {str(t) for t in range(6)}
    assert used == [boost.Setting()]
