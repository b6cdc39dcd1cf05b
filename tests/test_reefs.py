"""Reefs, base forms, texts for models: small fixtures worked out by hand."""

import math

import pytest
from pyspark.sql import functions as F

from tierlex.functions import scalars as S
from tierlex.functions import stemming
from tierlex.operators import boost, learn, reefs, sweep

VECTORS = "town_id long, vec_id long, v array<double>"


@pytest.fixture
def rows(spark):
    """Town 1: two tight triples at right angles and one word beside the first; town 2: two words."""
    v = [(1, 1, [1.0, 0.0]), (1, 2, [1.0, 0.01]), (1, 3, [1.0, 0.02]), (1, 4, [0.0, 1.0]), (1, 5, [0.01, 1.0]), (1, 6, [0.02, 1.0]), (1, 7, [1.0, 0.3]), (2, 8, [1.0, 1.0]), (2, 9, [1.0, 0.9])]
    return spark.createDataFrame(v, VECTORS)


def no_contexts(spark):
    return spark.createDataFrame([], "vec_id long, m map<bigint,double>")


def test_stems():
    known = {
        "consign": "consign", "consistency": "consist", "knightly": "knight", "generously": "generous", "happy": "happi", "running": "run", "hoping": "hope", "hopping": "hop",
        "communism": "communism", "relational": "relat", "conditional": "condit", "electricity": "electr", "adjustment": "adjust", "adoption": "adopt", "controlling": "control",
        "skies": "sky", "cries": "cri", "ties": "tie", "gas": "gas", "this": "this", "kiwis": "kiwi", "gaps": "gap", "succeeding": "succeed", "say": "say", "by": "by", "": "", "luxuriated": "luxuri",
    }
    assert {w: stemming.stem(w) for w in known} == known


def test_stemmed_column(spark):
    got = spark.createDataFrame([("Cats",), (None,), ("",)], "token string").select(stemming.stemmed("token")).collect()
    assert [r[0] for r in got] == ["cat", None, ""]


def test_base_forms(spark):
    words = spark.createDataFrame([("boxes",), ("box",), ("making",), ("make",), ("men",), ("man",), ("s",)], "token string")
    got = {tuple(r) for r in stemming.base_forms(words, words).collect()}
    assert got == {("boxes", "noun", "box"), ("boxes", "verb", "box"), ("making", "verb", "make")}
    women = spark.createDataFrame([("women",), ("woman",)], "token string")
    assert [tuple(r) for r in stemming.base_forms(women, women).collect()] == [("women", "noun", "woman")]


def test_hybrid(spark, rows):
    contexts = spark.createDataFrame([(1, {7: 2.0}), (2, {7: 1.0, 8: 0.0})], "vec_id long, m map<bigint,double>")
    sims = {(r.a, r.b): r.sim for r in reefs.hybrid(rows, contexts).collect()}
    assert len(sims) == 22
    assert math.isclose(sims[1, 2], 0.7 / math.sqrt(1.0001) + 0.3)
    assert math.isclose(sims[1, 4], 0.0, abs_tol=1e-12)  # no context: 0


def test_hybrid_graph_is_that_of_all_pairs(spark, monkeypatch):
    """Blocks of three words, ties, vectors without length, words without contexts, a group of one word, an empty table."""
    v = [(1 + i % 2, i, [float(i % 5), float(i % 3), 0.5 * (i % 2)]) for i in range(40)] + [(3, 99, [1.0, 0.0, 0.0]), (1, 50, [0.0, 0.0, 0.0])]
    rows = spark.createDataFrame(v, VECTORS)
    contexts = spark.createDataFrame([(i, {j: float(1 + i * j % 4) for j in range(i % 4)} | {9: 0.0}) for i in range(0, 40, 3)], "vec_id long, m map<bigint,double>")
    wanted = {tuple(r) for r in reefs.graph(reefs.hybrid(rows, contexts), k=4).collect()}
    for block in (2048, 3):
        monkeypatch.setattr(reefs.vectors, "BLOCK", block)
        got = [tuple(r) for r in reefs.hybrid_graph(rows, contexts, k=4).collect()]
        assert len(got) == len(set(got)) == len(wanted) and set(got) == wanted
    assert reefs.hybrid_graph(rows.limit(0), contexts).count() == 0


def test_hybrid_by_blocks(spark, monkeypatch):
    """Units of three words or one block give the pairs of a plain loop."""
    v = [(1 + i % 2, i, [float(i % 5), 0.1 * (i % 3), 0.3 * (i % 2)]) for i in range(30)] + [(3, 99, [1.0, 0.0, 0.0]), (1, 50, [0.0, 0.0, 0.0])]
    rows = spark.createDataFrame(v, VECTORS)
    maps = {i: {j: 0.1 + i * j % 4 for j in range(i % 4)} | {9: 0.0} for i in range(0, 30, 3)}
    contexts = spark.createDataFrame(list(maps.items()), "vec_id long, m map<bigint,double>")

    def cosine(x: list, y: list) -> float:
        size = math.sqrt(sum(a * a for a in x)) * math.sqrt(sum(b * b for b in y))
        return sum(a * b for a, b in zip(x, y)) / size if size else 0.0

    dense = lambda i: [maps.get(i, {}).get(j, 0.0) for j in range(10)]
    wanted = {(g, a, b): 0.7 * cosine(x, y) + (1 - 0.7) * cosine(dense(a), dense(b)) for g, a, x in v for h, b, y in v if g == h and a < b}
    for size in (512, 3):
        monkeypatch.setattr(reefs, "PAIRED", size)
        got = [tuple(r) for r in reefs.hybrid(rows, contexts).collect()]
        assert len(got) == len(wanted) and all(math.isclose(s, wanted[g, a, b], abs_tol=1e-15) for g, a, b, s in got)


def test_context_vectors(spark):
    members = spark.createDataFrame([(1, 1), (2, 1), (3, 2), (3, 3)], "town_id long, vec_id long")
    got = {r.vec_id: r.m for r in reefs.context_vectors(members, "town_id", "vec_id").collect()}
    assert got == {1: {1: math.log2(3), 2: math.log2(3)}}


def test_cluster_place_labels(spark, rows):
    core = rows.where("vec_id <> 7")
    found = reefs.cluster(core, no_contexts(spark), k=2, small=3)
    by = {r.vec_id: r.reef for r in found.collect()}
    assert by[1] == by[2] == by[3] != by[4] == by[5] == by[6]
    assert by[8] == by[9] == 0  # too few to be clustered
    placed = reefs.place(rows, found).cache()
    beside = placed.where("vec_id = 7").first()
    assert beside.reef == by[1] and not beside.is_core and 0.9 < beside.cos < 1
    names = rows.select("vec_id", F.concat(F.lit("w"), F.col("vec_id").cast("string")).alias("name"))
    labels = {(r.town_id, r.reef): r.label for r in reefs.labels(placed, names).collect()}
    assert labels[1, by[1]].split("_")[0] == "w2" and "w7" not in labels[1, by[1]]
    assert tuple(reefs.summary(placed).first()) == (3, 9, 2, 3, 4)
    assert reefs.place(rows.limit(0), found).count() == 0


def test_place_keeps_noise_and_groups_without_reefs(spark, rows):
    found = spark.createDataFrame([(1, 1, -1), (1, 2, 0)], "town_id long, vec_id long, reef int")
    got = {r.vec_id: (r.reef, r.cos is None, r.is_core) for r in reefs.place(rows, found).collect()}
    assert got[1] == (-1, True, True) and got[2] == (0, False, True) and got[7] == (0, False, False)
    assert got[8] == (None, True, False)


def test_bucket_and_groups(spark, rows):
    names = rows.select("vec_id", F.col("vec_id").cast("string").alias("name"))
    got = {r.town_id: (r["size"], r.label) for r in reefs.bucket_reefs(rows.where("town_id = 2"), names).collect()}
    assert got == {2: (2, "8_9")}
    towns = spark.createDataFrame([(i, i, [1.0, 0.1 * i]) for i in range(3)] + [(i, i, [0.1 * i - 1, -1.0]) for i in range(10, 13)], VECTORS)
    clusters = {r.town_id: r.cluster for r in reefs.group_clusters(towns, None, k=2).collect()}
    assert clusters[0] == clusters[1] == clusters[2] != clusters[10] == clusters[11] == clusters[12]


def test_keyword_rank(spark):
    scores = spark.createDataFrame([(1, "Sea birds", 2.0), (1, "cars", 5.0), (2, "cars", 1.0)], "query long, grp string, score double")
    words = spark.createDataFrame([(1, ["bird"]), (2, ["bird"])], "query long, keywords array<string>")
    assert {tuple(r) for r in reefs.keyword_rank(scores, words).collect()} == {(1, 2, True), (2, None, False)}


def test_kinds_and_senses(spark):
    words = spark.createDataFrame([("cat", True, True), ("Genus felis", True, True), ("give up", True, False), ("new york", False, True), ("oak tree", False, False)], "word string, v boolean, i boolean")
    assert [r[0] for r in words.select(S.word_kind(F.col("word"), F.col("v"), F.col("i"))).collect()] == ["single", "taxonomic", "phrasal_verb", "named_entity", "compound"]
    senses = spark.createDataFrame([(1, "bank", "river"), (1, "bank", "money"), (1, "bank", "Bank")], "word_id long, word string, sense string")
    assert sorted(tuple(r) for r in S.sense_texts(senses, "x: ").collect()) == [(1, 1, "x: bank: money"), (1, 2, "x: bank: river")]


def test_hashed_vectors(spark):
    got = S.hashed_vectors(spark.createDataFrame([("a",), ("abcd",), ("",), (None,)], "token string"), "token", 8).groupBy("token").agg(F.sum(F.col("x") * F.col("x")).alias("n")).collect()
    assert {r.token: round(r.n, 9) for r in got} == {"a": 1.0, "abcd": 1.0}


def test_importances_and_tuning(spark):
    rows = spark.createDataFrame([(i, i % 2, 0, [float(i % 2), float(i % 5)]) for i in range(60)], "vec_id long, town_id long, island_id long, v array<double>")
    sample = learn.samples(rows)
    model, _ = learn.train_towns(sample, learn.QUICK._replace(rounds=2))
    names = learn.feature_names(2)
    assert {r.dim for r in boost.importances(model.trees, names).collect()} <= {"dim_0", "knn_mean", "centroid_cos"}
    tuned = {r.town_id: r for r in learn.tuned(sample, {"b": learn.QUICK._replace(depth=2, rounds=2), "a": learn.QUICK._replace(depth=1, rounds=1)}).collect()}
    assert {(k, r.setting, r.cv_f1, r.f1) for k, r in tuned.items()} == {(0, "a", 1.0, 1.0), (1, "a", 1.0, 1.0)}


def test_every_town_has_rows(spark):
    rows = spark.createDataFrame([(i, i % 3, 0, [float(i % 3), float(i % 5)]) for i in range(90)], "vec_id long, town_id long, island_id long, v array<double>")
    got = learn.metrics(learn.train_towns(learn.samples(rows), learn.QUICK._replace(depth=2, rounds=2))[1], keys=["town_id"]).collect()
    assert sorted((r.town_id, r.f1, r.auc_pr) for r in got) == [(0, 1.0, 1.0), (1, 1.0, 1.0), (2, 1.0, 1.0)]


def test_sweep_grid():
    """Seven axes; both names weigh half at most; a fine grid is a step around; a sample is the same every time."""
    sets = sweep.grid()
    assert len(sets) == 19 * 4 * 4 * 6 * 3 * 4 == len({x[1:] for x in sets})
    assert all(x[1] + x[2] <= 50 for x in sets)
    near = sweep.fine([sweep.PRODUCTION])
    assert {x[7] for x in near} == set(sweep.GRID["norm"]) and {x[1] for x in near} == {15, 20, 25} and {x[5] for x in near} == {60, 80, 100}
    assert len(sweep.fine([sweep.PRODUCTION, sweep.PRODUCTION | {"blend": 55}])) > len(near)
    assert sweep.coarse(sets, 5) == sweep.coarse(sets[::-1], 5)


def test_normalisers(spark):
    rows = [("a", float(x)) for x in range(100)] + [("b", 2.0), ("b", 2.0), ("c", 0.0), ("c", 1.0)]
    got = {(r.g, r.raw): r for r in sweep.normalised(spark.createDataFrame(rows, "g string, raw double"), "g").collect()}
    assert (got["a", 1.0].trimmed, got["a", 98.0].trimmed, got["a", 50.0].trimmed) == (0.0, 255.0, 127.5)
    assert got["b", 2.0][2:] == (128.0, 128.0, 128.0, 128.0)
    assert got["c", 1.0].log == 255.0 and got["c", 1.0].zscore == 170.0


def test_sweep_margins(spark):
    """Reef and island levels by hand: a word's best weight in an island counts; a question without weights has margin 0."""
    grouped = spark.createDataFrame([("r1", 1, 1, 0.9, 0.0, 0.0, 1.0, 1.0), ("r1", 1, 2, 0.3, 0.0, 0.0, 1.0, 1.0), ("r2", 2, 1, 0.2, 0.0, 0.0, 1.0, 1.0), ("r2", 2, 3, 0.8, 0.0, 0.0, 1.0, 1.0)], "grp string, island_id int, word_id int, own double, named double, isl double, idf double, quality double")
    alone = spark.createDataFrame([(1, 4, 0.5, 0.5, 1.0, 1.0, 1), (2, 4, 0.2, 0.2, 1.0, 1.0, 4), (2, 5, 0.4, 0.4, 1.0, 1.0, 1)], "island_id int, word_id int, own double, isl double, idf double, quality double, n int")
    params = spark.createDataFrame([(0, 0.1, 0.15, 0.5, 0.9, 0.0, 0.5, "minmax"), (1, 0.1, 0.15, 0.5, 0.9, 1.0, 0.5, "minmax")], "param_id int, name double, island double, alone double, floor double, blend double, power double, norm string")
    asked = spark.createDataFrame([("q", 1), ("q", 4), ("r", 3), ("r", 5), ("none", 99)], "query string, word_id int")
    expected = spark.createDataFrame([("q", 1), ("r", 1), ("none", 1)], "query string, expected int")
    got = {r.param_id: (r.passed, r.questions, round(r.mean_margin, 6)) for r in sweep.evaluate(grouped, alone, params, asked, expected).collect()}
    # set 0: q has 255 + 128 in island 1 and nothing else; r 255 + 255 in island 2; set 1: word 4 has 255 in island 1, 0 in 2; word 5 170
    assert got == {0: (1, 3, 66.0), 1: (1, 3, 66.0)}


def test_sweep_of_a_grid_equals_sets_one_by_one(spark, monkeypatch):
    """Sets of all axes at once; words in several islands and groups, ties, questions in units of two words, and questions that nothing weighs."""
    import random

    rng = random.Random(7)
    x = lambda: rng.randrange(11) / 10
    grouped = spark.createDataFrame(sorted({(f"r{i % 9}", i % 9 % 4, w): (f"r{i % 9}", i % 9 % 4, w, x(), x(), x(), 1.0 + w % 3, (0.7, 0.9, 1.0)[w % 3]) for i in range(80) for w in [rng.randrange(20)]}.values()), "grp string, island_id int, word_id int, own double, named double, isl double, idf double, quality double")
    alone = spark.createDataFrame([(i, 20 + w, x(), x(), 0.5 + i, (0.7, 0.9)[w % 2], 1 + w % 4) for w in range(12) for i in range(4) if (w + i) % 3], "island_id int, word_id int, own double, isl double, idf double, quality double, n int")
    asked = spark.createDataFrame(sorted({(q, rng.randrange(34)) for q in range(25) for _ in range(5)}) + [(99, 500)], "query long, word_id int")
    expected = spark.createDataFrame([(q, q % 4) for q in range(25)] + [(99, 1)], "query long, expected int")
    sets = sweep.coarse(sweep.grid(), 23)
    assert len({s[-1] for s in sets}) == 4
    wanted = {r.param_id: (r.passed, r.questions, round(r.mean_margin, 9)) for r in sweep.evaluate(grouped, alone, sweep.frame(spark, sets), asked, expected).collect()}
    for unit, together in ((2_000, 64), (2, 5)):
        monkeypatch.setattr(sweep, "UNIT", unit)
        monkeypatch.setattr(sweep, "TOGETHER", together)
        got = {r.param_id: (r.passed, r.questions, round(r.mean_margin, 9)) for r in sweep.evaluate_grid(grouped, alone, sets, asked, expected).collect()}
        assert got == wanted and len(got) == 23
    assert sweep.evaluate_grid(grouped, alone, sets, asked.limit(0), expected).count() == 0


def test_sweep_sends_a_byte_a_choice_and_no_rows_by_choice(spark):
    """Groups that end and begin between batches; what is shuffled for a word doesn't grow with choices of islands, and with those of groups by a byte."""
    grouped = spark.createDataFrame([(f"r{i // 5:02}", 0, i, i % 7 / 10, i % 3 / 10, i % 4 / 10, 1.0 + i % 2, 0.9) for i in range(100)], "grp string, island_id int, word_id int, own double, named double, isl double, idf double, quality double")
    alone = spark.createDataFrame([(0, 200 + w, w / 10, 0.5, 1.0, 0.9, 1) for w in range(6)], "island_id int, word_id int, own double, isl double, idf double, quality double, n int")
    choices = sorted({x[1:3] + x[4:5] for x in sweep.grid()})
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        made = {r.word_id: list(r.w) for r in sweep.group_entries(grouped, choices).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(made) == 100 and {len(w) for w in made.values()} == {len(choices)} == {76}
    rows = {r.word_id: r for r in grouped.collect()}
    for c, (name, island, floor) in enumerate(choices):
        raw = {w: r.idf * max(r.quality, floor / 100) * ((1.0 - name / 100 - island / 100) * r.own + (name / 100 * r.named + island / 100 * r.isl)) for w, r in rows.items()}
        for w, r in rows.items():
            mine = [raw[x] for x in rows if rows[x].grp == r.grp]
            assert made[w][c] == round(255.0 * (raw[w] - min(mine)) / (max(mine) - min(mine)))
    assert {len(r.w) for r in sweep.island_entries(alone).collect()} == {8 * len(sweep.OF_ISLAND)}
