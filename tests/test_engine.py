"""Operators on small fixtures worked out by hand, connectors, streaming, and the queries' contract."""

import io
import json
import math
import os

import pytest
from pyspark.sql import functions as F

from tierlex import plans
from tierlex.functions import scalars as S
from tierlex.operators import learn, promote, prune, seeds, stats, text
from tierlex.plans import QUERIES
from tierlex.sources import files, packed, sinks
from tierlex.streaming import scorer


def column(spark, values, kind, f):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], f"x {kind}").select(f(F.col("x"))).collect()]


def test_scalars(spark):
    assert column(spark, [1, 2, 3, 4, 5, 6, 10, 11, 20, 21], "int", S.specificity) == [3, 2, 2, 1, 1, 0, 0, -1, -1, -2]
    assert column(spark, [0, 3, 4, 10, 11, 50, 51, 150, 151], "int", S.domain_specificity) == [0, 2, 1, 1, 0, 0, -1, -1, -2]
    assert column(spark, ["", "a", None, "é"], "string", S.fnv1a)[:3] == [-3750763034362895579, -5808556873153909620, None]
    assert column(spark, [-1, 5], "long", S.unsigned) == [2**64 - 1, 5]
    terms = ["give up", "machine learning", "dog", "come across", "set apart", "stand by", "look_up", "put up Off", "one two three up"]
    assert column(spark, terms, "string", S.category) == ["phrasal_verb", "compound", "single", "phrasal_verb", "phrasal_verb", "compound", "compound", "phrasal_verb", "compound"]
    assert column(spark, ["verb", None, "x"], "string", S.pos_one_hot) == [[0.0, 1.0, 0.0, 0.0], [0.0] * 4, [0.0] * 4]
    assert column(spark, [1, 8], "int", S.exclusivity) == pytest.approx([1.0, 8**-0.33])
    row = spark.range(1).select(S.pack(F.lit(2), F.lit(5)), *S.unpack(F.lit(131077).cast("long")), S.cosine(F.array(F.lit(0.0)), F.array(F.lit(1.0)))).first()
    assert tuple(row) == (131077, 2, 5, 0.0)


def test_exact_log2(spark):
    """The last digit of a logarithm decides weights of members whose scores are nearly equal."""
    rows = spark.range(1, 400).select("id", S.floored_idf(F.lit(205272), F.col("id")).alias("idf"), S.log2(F.when(F.col("id") > 1, F.col("id").cast("double"))).alias("x")).collect()
    assert all(r.idf == math.log2(205272 / r.id) and r.x == (math.log2(r.id) if r.id > 1 else None) for r in rows)


def test_unsigned_hash_wraps(spark, tmp_path):
    keys = [1, 1999, 5000, 20_000, 1_200_000, 2**62]
    spark.createDataFrame([(k,) for k in keys], "p_partkey long").write.parquet(f"{tmp_path}/part.parquet")
    got = {r.word_id: int(r.u) for r in QUERIES["unsigned_hash"](spark, str(tmp_path)).collect()}
    assert got == {k: (k * 4611686018427387 - 4611686018427387000) % 2**64 for k in keys}


def test_min_max(spark):
    rows = [(1.0, 1.0, 3.0), (2.0, 1.0, 3.0), (3.0, 1.0, 3.0), (5.0, 5.0, 5.0)]
    got = spark.createDataFrame(rows, "x double, lo double, hi double").select(S.min_max_u8(F.col("x"), F.col("lo"), F.col("hi"))).collect()
    assert [r[0] for r in got] == [0, 128, 255, 128]


def test_promotion(spark):
    cases = [(None, 1, 1, "island"), (3, 1, 1, "reef"), (2, 2, 1, "town"), (0, 1, 1, "reef"), (0, 6, 1, "island"), (-1, 11, 1, "reef"), (-1, 11, 2, "island"), (-2, 25, 1, "island")]
    facts = [(w, 0, f"r{w}-{k}") for w, c in enumerate(cases) for k in range(c[2])]
    st = spark.createDataFrame([(w, c[0], c[1], 1) for w, c in enumerate(cases)], "word_id int, specificity int, town_count int, island_count int")
    got = promote.export_level(spark.createDataFrame(facts, "word_id int, island_id int, reef_id string"), st).orderBy("word_id").collect()
    assert [r.level for r in got] == [c[3] for c in cases]


def test_idf_adjust(spark):
    rows = [(0, 1, 0.5), (0, 2, 0.5), (1, 2, 0.5)] + [(t, 3, 0.69) for t in range(4)] + [(t, 4, 0.7) for t in range(4)]
    df = spark.createDataFrame(rows, "town_id int, word_id int, score double")
    assert {(r.word_id, round(r.adjusted, 6)) for r in prune.idf_adjusted(df).collect()} == {(1, 0.5), (2, 0.25), (3, 0.0), (4, 0.7)}
    assert {r.word_id for r in prune.idf_adjust(df).collect()} == {1, 4}


def test_ubiquity(spark):
    scores = [0.79, 0.80, 0.94, 0.95] + [0.99] * 16
    df = spark.createDataFrame([(t, 1, s) for t, s in enumerate(scores)] + [(0, 2, 0.1)], "town_id int, word_id int, score double")
    got = {(r.town_id, r.word_id): round(r.score, 6) for r in prune.ubiquity_prune(df).collect()}
    assert (0, 1) not in got
    assert (got[1, 1], got[2, 1], got[3, 1], got[0, 2]) == (0.4, 0.47, 0.95, 0.1)


def test_source_quality(spark):
    df = spark.createDataFrame([("wordnet", 0), ("curated", 1), ("xgboost", 1), ("xgboost", 0)], "source string, is_core int")
    assert [r.source_quality for r in stats.source_quality(df).collect()] == [0.7, 1.0, 0.9, 0.7]


def test_seed_pairs(spark):
    def town(t, n):
        return [(0, t, 100 * t + k) for k in range(n - 1)] + [(0, t, 1)]

    for sizes, cos, loser in (((10, 4), (0.1, 0.2), 1), ((10, 6), (0.5, 0.5), 2), ((10, 6), (0.4, 0.5), 1)):
        rows = spark.createDataFrame(town(1, sizes[0]) + town(2, sizes[1]), "island_id int, town_id int, word_id int")
        sims = spark.createDataFrame([(1, 1, cos[0]), (2, 1, cos[1])], "town_id int, word_id int, cos double")
        assert [r.town_id for r in seeds.dedupe_pairs(rows, sims).collect()] == [loser]


def test_island_promotion(spark):
    towns = spark.createDataFrame([(100 * n + t, n) for n in (1, 2, 3, 5, 10) for t in range(n)], "town_id int, island_id int")
    for n, need in ((2, 2), (3, 2), (5, 4), (10, 8)):
        for hits in (need - 1, need):
            pred = spark.createDataFrame([(100 * n + t, 7) for t in range(hits)], "town_id int, word_id int")
            assert seeds.island_promotion(pred, towns).count() == (hits >= need)


def test_communities(spark):
    edges = [(1, a, b, 1.0) for group in (range(5), range(10, 15)) for a in group for b in group if a < b] + [(1, 4, 10, 0.1), (1, 30, 31, 1.0)]
    got = {r.node: r.community for r in learn.communities(spark.createDataFrame(edges, "town_id long, a long, b long, w double"), "town_id").collect()}
    assert len({got[k] for k in range(5)}) == len({got[k] for k in range(10, 15)}) == 1
    assert got[0] != got[10] and got[30] == got[31] == -1


def test_variants_and_ranks(spark):
    df = spark.createDataFrame([("walk",), ("walks",), ("walked",), ("is",)], "token string")
    assert {(r.variant, r.base) for r in text.variants(df).where("source = 'snowball'").collect()} == {("walks", "walk"), ("walked", "walk")}
    a = spark.createDataFrame([(1, i, float(i)) for i in range(5)], "q int, item int, score double")
    b = spark.createDataFrame([(1, i, float(-i)) for i in range(5)], "q int, item int, score double")
    assert text.rank_agreement(a, b, "q", "item").first().rho == pytest.approx(-1)
    assert text.rank_agreement(a, a.withColumn("score", F.lit(1.0)), "q", "item").first().rho is None


def test_readers(spark, tmp_path):
    (tmp_path / "d.tsv").write_text("00000001-n\tbiology art\n00000002-n\t\n")
    (tmp_path / "b.txt").write_text("# note\nX1 wn20:n:1,wn30:n:77\nX2 wn20:n:2\n")
    domains = files.domain_tsv(spark, f"{tmp_path}/d.tsv")
    assert {tuple(r) for r in domains.collect()} == {("00000001-n", "biology"), ("00000001-n", "art")}
    keys = files.versions(files.bridge(spark, f"{tmp_path}/b.txt"), "wn20", "wn30")
    assert [tuple(r) for r in keys.collect()] == [("00000001-n", "00000077-n")]
    lemmas = spark.createDataFrame([("00000077-n", "blue_whale")], "synset string, lemma string")
    towns = spark.createDataFrame([("biology", "Animals")], "domain string, town string")
    assert [tuple(r) for r in files.import_domains(domains, keys, lemmas, towns).collect()] == [("Animals", "blue whale")]
    (tmp_path / "v.json").write_text(json.dumps({"domain": "alchemy", "core": ["lead", "gold"], "peripheral": ["fire"], "words": []}, indent=1))
    assert files.vocabulary_json(spark, f"{tmp_path}/v.json").count() == 3
    m = {"precision": 1.0, "recall": 0.5, "f1": 0.66, "auc_pr": 0.9}
    (tmp_path / "m.json").write_text(json.dumps({"domain": "a", "metrics": m, "fold_metrics": [m, m]}, indent=1))
    assert [r.fold for r in files.metrics_json(spark, f"{tmp_path}/m.json").collect()] == [0, 1]
    (tmp_path / "map.json").write_text('{"a": "b",\n "c": "d"}')
    assert {tuple(r) for r in files.mapping_json(spark, f"{tmp_path}/map.json").collect()} == {("a", "b"), ("c", "d")}
    reply = spark.createDataFrame([('```json\n{"T": {"core": ["x"], "peripheral": ["y", "z"]}}\n```',)], "reply string")
    assert files.seeds_from_reply(reply).count() == 3
    blob = spark.createDataFrame([(bytearray(b"\x00\x00\x80\x3f\x00\x00\x00\x40"),), (None,)], "b binary")
    assert [r[0] for r in blob.select(files.decode_blob("b")).collect()] == [[1.0, 2.0], None]
    names = spark.createDataFrame([("Lists of birds",), ("Branches of physics",), ("Birds",), ("Video games",), ("Art by genre",), ("Art by Country",)], "name string")
    assert {tuple(r) for r in files.topical(names).collect()} == {("Branches of physics", True), ("Birds", False), ("Art by genre", True)}


def test_sinks(spark, tmp_path):
    values = [None, True, 0, 127, 128, 255, 70000, 2**63, -1, -33, -(2**40), 1.5, "é" * 40, b"x", [1, [2]], {"b": 1, "a": [None]}, list(range(20))]
    for v in values:
        assert sinks.unpack(sinks.pack(v)) == v
    df = spark.createDataFrame([(1, "a", 2.0), (2, None, 3.0)], "id long, name string, w double")
    assert all(packed.Decoder(io.BytesIO(sinks.pack(v))).value() == v for v in values)
    out = f"{tmp_path}/out"
    packed.export(spark, {"dims": {"a": packed.spread(df, packed.MAP, "id")}}, out)
    assert packed.verify(spark, out).count() == 0
    packed.patch(spark, out, "dims", {"c": ["c", 1.0]})
    assert packed.verify(spark, out).count() == 0 and sinks.unpack((tmp_path / "out/dims.bin").read_bytes()) == {"a": {1: ["a", 2.0], 2: [None, 3.0]}, "c": ["c", 1.0]}
    sinks.Folder(spark, out).write("dims.bin", b"\x80")
    assert [tuple(r) for r in packed.verify(spark, out).collect()] == [("dims", "checksum")]
    sinks.append_jsonl(spark.createDataFrame([(1, 2.0), (3, 1.0)], "passed int, margin double"), f"{tmp_path}/log")
    assert files.best_results(spark, f"{tmp_path}/log", 1).first().passed == 3
    sinks.write_xml(df, f"{tmp_path}/xml", "islands", "island")
    assert spark.read.format("xml").option("rowTag", "island").load(f"{tmp_path}/xml").count() == 2
    both = sinks.insert_or_ignore(df, spark.createDataFrame([(2, "z", 0.0), (3, "b", 1.0), (3, "c", 1.0)], df.schema), ["id"])
    assert {(r.id, r.name) for r in both.collect()} == {(1, "a"), (2, None), (3, "b")}
    assert sinks.violations(both, ["id"], ("w",)).first().n == 0
    wrong = spark.createDataFrame([(1, 300), (1, 5), (2, -1), (3, None)], "id int, w int")
    assert sinks.violations(wrong, ["id"], ("w",)).first().n == 3 and sinks.violations(wrong, ["id"]).first().n == 1
    vectors = spark.createDataFrame([([float(i), i / 2],) for i in range(25)], "v array<double>").repartition(4)
    written = {r["batch"]: r["rows"] for r in sinks.write_npy_batches(vectors, f"{tmp_path}/npy", 10).collect()}
    assert written == {0: 10, 1: 10, 2: 5}
    back = files.npy_batches(spark, f"{tmp_path}/npy")
    assert sorted(tuple(r.v) for r in back.collect()) == [(float(i), i / 2) for i in range(25)] and tuple(files.resume_index(back).first()) == (3, 25, 3)


def test_streaming(spark, tmp_path):
    docs = [(1, "alpha beta beta"), (2, "gamma")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/in")
    weights = spark.createDataFrame([("alpha", "g", 255), ("beta", "g", 51)], "token string, grp string, weight int")
    background = spark.createDataFrame([("g", 0.2, 0.5)], "grp string, mean double, std double")
    out = []
    scorer.score_stream(scorer.read_texts(spark, f"{tmp_path}/in"), weights, background, lambda d, n: out.extend(d.collect()), f"{tmp_path}/cp").awaitTermination(120)
    assert [(r.doc_id, r.n_words, round(r.score, 6), round(r.z, 6)) for r in out] == [(1, 2, 1.2, 2.0)]
    events = spark.sql("select timestamp'2024-01-01 01:00:00' ts, 'a' event_type, 2.0D value union all select timestamp'2024-01-01 05:00:00', 'a', 3.0D")
    assert [(r.n, r.total) for r in scorer.windowed(events).collect()] == [(2, 5.0)]


DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")
def test_index_invariants(spark):
    index = plans.QUERIES["export_index"](spark, DATA).cache()
    assert index.where("weight < 0 or weight > 255").count() == 0
    assert index.groupBy("word_id").agg(F.countDistinct("level").alias("n")).where("n > 1").count() == 0
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(plans.ORACLE_SQL) <= set(plans.QUERIES)


def test_trace_weighs_words_once_for_all_groups(spark):
    tokens = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (2, "z")], "doc_id long, token string")
    weights = spark.createDataFrame([("a", "g", 5), ("b", "g", 1), ("b", "h", 9), ("b", "i", 2)], "token string, grp string, weight int")
    got = text.trace(tokens, weights, k=2)
    want = [(1, "g", "a", 5, 2, False), (1, "g", "b", 1, 2, False), (1, "h", "b", 9, 1, True), (2, "h", "b", 9, 1, True), (2, "i", "b", 2, 2, True)]
    assert sorted(map(tuple, got.collect())) == want
    assert "sum(weight" not in got._jdf.queryExecution().optimizedPlan().toString()  # the best are a table before their words are looked up


def test_group_sums_shuffle_a_row_a_word(spark, monkeypatch):
    """A word goes to its text once, whatever its groups; null is a group of its own, and lists beyond the limit are joined."""
    weights = spark.createDataFrame([(g, w, 10 + i) for i, w in enumerate("abc") for g in [None, *(f"g{n}" for n in range(20))]], "grp string, token string, weight int")
    tokens = spark.createDataFrame([(d, w) for d in range(5) for w in "abx"[: 1 + d % 3]], "doc_id long, token string")
    for limit in (text.ENTRIES, 0):
        monkeypatch.setattr(text, "ENTRIES", limit)
        sums = text.group_sums(tokens, *text.by_token(weights))
        got = {(r.doc_id, r.grp): (r.s, r.n) for r in sums.collect()}
        assert len(got) == 5 * 21 and got[1, None] == got[1, "g7"] == got[2, "g0"] == (21, 2) and got[0, "g3"] == (10, 1)


def test_predictions_tasks_follow_the_lines(spark, tmp_path, monkeypatch):
    """Lines are dealt out to as many tasks as they need, before pairs are made of them, with the same pairs."""
    from tierlex.sources import proxy

    spark.createDataFrame([(i % 7, i % 5, i % 11 / 100) for i in range(400)], "l_suppkey long, l_partkey long, l_discount double").write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(proxy, "TASK_LINES", 10)
    made = proxy.Tables(spark, str(tmp_path)).predictions
    best = {}
    for i in range(400):
        best[i % 7, i % 5] = max(best.get((i % 7, i % 5), 0), i % 11 / 10)
    assert {(r.town_id, r.word_id): r.score for r in made.collect()} == best
    assert made.rdd.getNumPartitions() == 40
