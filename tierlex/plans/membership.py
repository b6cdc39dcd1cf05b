"""Queries over words, reefs, towns, islands and archipelagos."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import promote, prune, refresh, stats
from ..sources.proxy import Tables, fact_sql
from .catalog import query

SPREAD = "SELECT word_id, count(DISTINCT reef_id) AS reef_count, count(DISTINCT town_id) AS town_count, count(DISTINCT island_id) AS island_count, max(cosine_sim) AS best_sim FROM rw GROUP BY word_id"
SPEC = "CASE WHEN {n} <= 1 THEN 3 WHEN {n} <= 3 THEN 2 WHEN {n} <= 5 THEN 1 WHEN {n} <= 10 THEN 0 WHEN {n} <= 20 THEN -1 ELSE -2 END"
STATS = f"""
sp AS ({SPREAD}),
ws AS (SELECT w.word_id, word, pos, coalesce(reef_count, 0) AS reef_count, coalesce(town_count, 0) AS town_count, coalesce(island_count, 0) AS island_count,
       CASE WHEN reef_count IS NOT NULL THEN {SPEC.format(n="reef_count")} END AS specificity,
       CASE WHEN reef_count IS NULL THEN 0 ELSE greatest(log2((SELECT count(DISTINCT reef_id) FROM rw)::DOUBLE / reef_count), 0.1) END AS idf
       FROM w LEFT JOIN sp USING (word_id))"""
LEVELS = """
pi AS (SELECT word_id, max(k) AS most FROM (SELECT word_id, island_id, count(DISTINCT reef_id) AS k FROM rw GROUP BY ALL) GROUP BY word_id),
lv AS (SELECT word_id, specificity, town_count, island_count,
       CASE WHEN specificity IS NULL THEN 'island' WHEN specificity >= 1 AND town_count >= 2 THEN 'town' WHEN specificity >= 0 AND town_count = 1 THEN 'reef'
            WHEN specificity = -1 AND most = 1 THEN 'reef' ELSE 'island' END AS level FROM ws JOIN pi USING (word_id))"""
WEIGHTS = """
q AS (SELECT rw.*, CASE WHEN source <> 'xgboost' AND is_core = 1 THEN 1.0::DOUBLE WHEN is_core = 1 THEN 0.9 ELSE 0.7 END AS sq FROM rw),
rr AS (SELECT q.*, idf * greatest(sq, 0.9) * (0.5 * cosine_sim + 0.2 * reef_cos + 0.3 * island_cos) AS raw FROM q JOIN lv USING (word_id) JOIN ws USING (word_id) WHERE level = 'reef'),
rx AS (SELECT *, min(raw) OVER (PARTITION BY reef_id) AS lo, max(raw) OVER (PARTITION BY reef_id) AS hi FROM rr),
rwt AS (SELECT reef_id, town_id, island_id, word_id, (CASE WHEN hi > lo THEN round_even(255::DOUBLE * (raw - lo) / (hi - lo), 0) ELSE 128 END)::INT AS weight FROM rx),
t0 AS (SELECT town_id, island_id, word_id, max(cosine_sim) AS c, max(sq) AS sq, max(town_cos) AS tc, max(island_cos) AS ic FROM q JOIN lv USING (word_id) WHERE level = 'town' GROUP BY ALL),
t1 AS (SELECT t0.*, idf * greatest(sq, 0.9) * (0.5 * c + 0.2 * tc + 0.3 * ic) AS raw FROM t0 JOIN ws USING (word_id)),
tx AS (SELECT *, min(raw) OVER (PARTITION BY town_id) AS lo, max(raw) OVER (PARTITION BY town_id) AS hi FROM t1),
twt AS (SELECT town_id, island_id, word_id, (CASE WHEN hi > lo THEN round_even(255::DOUBLE * (raw - lo) / (hi - lo), 0) ELSE 128 END)::INT AS weight FROM tx),
i0 AS (SELECT island_id, word_id, max(cosine_sim) AS c, max(sq) AS sq, max(island_cos) AS ic, any_value(island_count) AS k FROM q JOIN lv USING (word_id) WHERE level = 'island' GROUP BY ALL),
i1 AS (SELECT *, log2((SELECT count(*) FROM isl)::DOUBLE / greatest(1, k)) * greatest(sq, 0.9) * (0.5 * c + 0.5 * ic) AS raw FROM i0),
ix AS (SELECT *, min(raw) OVER (PARTITION BY island_id) AS lo, max(raw) OVER (PARTITION BY island_id) AS hi, min(raw) OVER () AS glo, max(raw) OVER () AS ghi FROM i1),
iwt AS (SELECT island_id, word_id, round_even(round_even((1 - 0.8::DOUBLE) * 255::DOUBLE * (raw - lo) / (CASE WHEN hi > lo THEN hi - lo ELSE 1 END) + 0.8::DOUBLE * 255::DOUBLE * (raw - glo) / (CASE WHEN ghi > glo THEN ghi - glo ELSE 1 END), 0) * pow(k::DOUBLE, -0.33), 0)::INT AS weight FROM ix),
ei AS MATERIALIZED (SELECT 'reef' AS level, island_id, town_id, reef_id, word_id, weight FROM rwt UNION ALL SELECT 'town', island_id, town_id, NULL, word_id, weight FROM twt UNION ALL SELECT 'island', island_id, NULL, NULL, word_id, weight FROM iwt)"""
BASE = f"WITH {fact_sql()}"
FULL = f"WITH {fact_sql()}, {STATS}, {LEVELS}, {WEIGHTS}"
#: With this quantity nearly all promotion rules occur.
MIXED = 38


def word_stats_of(t: Tables, quantity: int = 45) -> tuple[DataFrame, DataFrame]:
    facts = t.reef_words(quantity)
    return facts, stats.word_stats(t.words, facts)


def levels_of(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Facts, words' statistics and levels, made once for all that a query does with them."""
    if not hasattr(t, "levels_"):
        facts = t.kept(t.reef_words())
        ws = stats.word_stats(t.words, facts)
        both = t.kept(ws.join(promote.export_level(facts, ws).select("word_id", "level"), "word_id", "left"))
        levels = both.where("level is not null").select("word_id", "specificity", "town_count", "island_count", "level")
        t.levels_ = facts, both.drop("level"), levels
    return t.levels_


def whole_index(t: Tables) -> DataFrame:
    """All three levels' weights."""
    facts, ws, levels = levels_of(t)
    return promote.export_index(promote.reef_weights(facts, ws, levels), promote.town_weights(facts, ws, levels), promote.island_weights(facts, levels, t.islands.count()))


def index_of(t: Tables) -> DataFrame:
    """The index as a table, made once."""
    if not hasattr(t, "index_"):
        t.index_ = t.kept(whole_index(t))
    return t.index_


@query(f"{BASE} {SPREAD}")
def word_spread(t):
    return stats.word_spread(t.reef_words())


@query(f"{BASE}, {STATS} SELECT * FROM ws")
def word_stats(t):
    return word_stats_of(t)[1]


@query(f"{BASE}, s AS (SELECT word_id, count(DISTINCT reef_id) AS n FROM rw GROUP BY 1) SELECT word_id, island_id, count(DISTINCT reef_id) AS reefs, count(DISTINCT town_id) AS towns, count(DISTINCT reef_id) / any_value(n) AS concentration, avg(cosine_sim) AS avg_cosine FROM rw JOIN s USING (word_id) GROUP BY word_id, island_id")
def word_island_stats(t):
    return stats.word_island_stats(t.reef_words())


@query(f"""{BASE}, {STATS} SELECT CASE WHEN reef_count = 0 THEN '0' WHEN reef_count = 1 THEN '1' WHEN reef_count <= 3 THEN '2-3' WHEN reef_count <= 5 THEN '4-5' WHEN reef_count <= 10 THEN '6-10' WHEN reef_count <= 20 THEN '11-20' ELSE '21+' END AS bucket,
count(*) AS n, round(count(*) * 100::DOUBLE / (SELECT count(*) FROM ws), 4) AS pct, min(reef_count) AS first FROM ws GROUP BY 1""")
def specificity_hist(t):
    ws = word_stats_of(t)[1]
    return stats.bucketed(ws, stats.spread_label(F.col("reef_count")), F.col("reef_count"))


@query(f"{BASE} SELECT count(*) AS rows, count(DISTINCT word_id) AS words, count(DISTINCT reef_id) AS reefs, count(DISTINCT town_id) AS towns FROM rw")
def global_counts(t):
    return t.reef_words().agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("word_id").alias("words"), F.countDistinct("reef_id").alias("reefs"), F.countDistinct("town_id").alias("towns"))


_PROFILE = "avg((pos='noun')::INT) AS noun_frac, avg((pos='verb')::INT) AS verb_frac, avg((pos='adj')::INT) AS adj_frac, avg((pos='adv')::INT) AS adv_frac, avg(specificity) AS avg_specificity"


@query(f"{BASE}, {STATS} SELECT reef_id, count(*) AS word_count, sum(is_core)::BIGINT AS core_count, {_PROFILE} FROM rw JOIN ws USING (word_id) GROUP BY reef_id")
def reef_rollup(t):
    return stats.reef_rollup(*word_stats_of(t))


def _tier(c: str) -> str:
    return f"{BASE}, {STATS}, o AS (SELECT {c}, word_id, min(reef_id) AS reef_id, min(town_id) AS rep FROM rw GROUP BY ALL) SELECT {c}, count(*) AS word_count, count(DISTINCT reef_id) AS reef_count, count(DISTINCT rep) AS town_count, {_PROFILE} FROM o JOIN ws USING (word_id) GROUP BY {c}"


@query(_tier("town_id"))
def town_rollup(t):
    return stats.tier_rollup(*word_stats_of(t), "town_id")


@query(_tier("island_id"))
def island_rollup(t):
    return stats.tier_rollup(*word_stats_of(t), "island_id")


@query(f"""{BASE} SELECT r_regionkey AS arch_id, r_name AS arch, (SELECT count(*) FROM isl WHERE arch_id = r_regionkey) AS island_count, (SELECT count(*) FROM tow JOIN isl USING (island_id) WHERE arch_id = r_regionkey) AS town_count,
(SELECT count(DISTINCT reef_id) FROM rw WHERE arch_id = r_regionkey) AS reef_count, (SELECT count(DISTINCT word_id) FROM rw WHERE arch_id = r_regionkey) AS word_count FROM region""")
def archipelago_rollup(t):
    return stats.archipelago_rollup(t.archipelagos, t.islands, t.towns, t.reef_words())


@query(f"{BASE} SELECT island_id, count(DISTINCT tow.town_id) AS towns, count(DISTINCT reef_id) AS reefs FROM isl LEFT JOIN tow USING (island_id) LEFT JOIN (SELECT DISTINCT town_id, reef_id FROM rw) r ON r.town_id = tow.town_id GROUP BY island_id")
def child_counts(t):
    reefs = t.reef_words().select("town_id", "reef_id").distinct()
    return t.islands.join(t.towns.select("island_id", "town_id"), "island_id", "left").join(reefs, "town_id", "left").groupBy("island_id").agg(F.countDistinct("town_id").alias("towns"), F.countDistinct("reef_id").alias("reefs"))


@query(f"{BASE} SELECT reef_id, word_id, source, is_core, CASE WHEN source = 'curated' AND is_core = 1 THEN 1.0::DOUBLE WHEN is_core = 1 THEN 0.9 ELSE 0.7 END AS source_quality FROM rw")
def source_quality(t):
    return stats.source_quality(t.reef_words()).select("reef_id", "word_id", "source", "is_core", "source_quality")


@query(f"{BASE}, a AS (SELECT island_id, count(DISTINCT reef_id) AS total FROM rw GROUP BY 1), b AS (SELECT island_id, word_id, count(DISTINCT reef_id) AS mine FROM rw GROUP BY 1, 2) SELECT island_id, word_id, log2(total::DOUBLE / mine) AS island_idf FROM a JOIN b USING (island_id)")
def island_idf(t):
    return stats.island_idf(t.reef_words())


_LEVEL_SQL = f"WITH {fact_sql(MIXED)}, {STATS}, {LEVELS}"


@query(f"{_LEVEL_SQL} SELECT * FROM lv")
def export_level(t):
    return promote.export_level(*word_stats_of(t, MIXED))


@query(f"{_LEVEL_SQL} SELECT specificity, count(*) FILTER (level = 'reef') AS reef, count(*) FILTER (level = 'town') AS town, count(*) FILTER (level = 'island') AS island FROM lv GROUP BY 1")
def promotion_crosstab(t):
    return promote.crosstab(promote.export_level(*word_stats_of(t, MIXED)))


@query(f"{FULL} SELECT * FROM rwt")
def reef_weights(t):
    return promote.reef_weights(*levels_of(t))


@query(f"{FULL} SELECT * FROM twt")
def town_weights(t):
    return promote.town_weights(*levels_of(t))


@query(f"{FULL} SELECT * FROM iwt")
def island_weights(t):
    facts, _, levels = levels_of(t)
    return promote.island_weights(facts, levels, t.islands.count())


@query(f"{FULL} SELECT * FROM ei")
def export_index(t):
    return whole_index(t)


@query(f"{FULL} SELECT 'reef-town' AS pair, count(*) AS n FROM (SELECT word_id FROM rwt INTERSECT SELECT word_id FROM twt) UNION ALL SELECT 'reef-island', count(*) FROM (SELECT word_id FROM rwt INTERSECT SELECT word_id FROM iwt) UNION ALL SELECT 'town-island', count(*) FROM (SELECT word_id FROM twt INTERSECT SELECT word_id FROM iwt)")
def level_overlap(t):
    return promote.level_overlap(index_of(t))


@query(f"{BASE}, r AS (SELECT reef_id, word_id, max(cosine_sim) AS raw FROM rw GROUP BY ALL), x AS (SELECT *, min(raw) OVER (PARTITION BY reef_id) AS lo, max(raw) OVER (PARTITION BY reef_id) AS hi FROM r), y AS (SELECT reef_id, word_id, (CASE WHEN hi > lo THEN round_even(255::DOUBLE * (raw - lo) / (hi - lo), 0) ELSE 255 END)::INT AS weight FROM x) SELECT * FROM y WHERE weight > 0")
def legacy_weights(t):
    return promote.legacy_weights(t.reef_words().groupBy("reef_id", "word_id").agg(F.max("cosine_sim").alias("raw")), "reef_id")


@query(f"{BASE}, d AS (SELECT island_id, island, arch_id, row_number() OVER (ORDER BY CASE WHEN is_bucket = 1 THEN 999 ELSE arch_id END, island) - 1 AS domain_no FROM isl), s AS (SELECT DISTINCT island_id, reef_id FROM rw), n AS (SELECT reef_id, row_number() OVER (ORDER BY domain_no, reef_id) - 1 AS sub_reef FROM s JOIN d USING (island_id)) SELECT DISTINCT w.word_id, coalesce(sub_reef, 65535) AS sub_reef FROM w LEFT JOIN rw USING (word_id) LEFT JOIN n USING (reef_id)")
def legacy_sub_reefs(t):
    """The older export's reef numbers: domains by archipelago (buckets last) and name, then reefs; 65535 for words without one."""
    order = F.when(F.col("is_bucket") == 1, 999).otherwise(F.col("arch_id"))
    domains = t.islands.withColumn("domain_no", F.row_number().over(Window.orderBy(order, "island")) - 1).select("island_id", "domain_no")
    facts = t.reef_words().select("island_id", "reef_id", "word_id")
    reefs = facts.select("island_id", "reef_id").distinct().join(F.broadcast(domains), "island_id")
    sizes = reefs.groupBy("domain_no").agg(F.count(F.lit(1)).alias("k")).withColumn("before", F.coalesce(F.sum("k").over(Window.orderBy("domain_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    nth = F.row_number().over(Window.partitionBy("domain_no").orderBy("reef_id")) - 1
    numbered = reefs.withColumn("nth", nth).join(sizes, "domain_no").select("reef_id", (F.col("nth") + F.col("before")).alias("sub_reef"))
    return t.words.select("word_id").join(facts.select("word_id", "reef_id"), "word_id", "left").join(numbered, "reef_id", "left").select("word_id", F.coalesce("sub_reef", F.lit(65535)).alias("sub_reef")).distinct()


# --- questions over the index

_WORDS_OF = "wq AS (SELECT DISTINCT l_orderkey AS query, l_partkey AS word_id FROM lineitem)"
_SCORES = "sc AS MATERIALIZED (SELECT query, island_id, sum(mw)::BIGINT AS score, count(*) AS n_words FROM (SELECT query, island_id, word_id, max(weight) AS mw FROM wq JOIN ei USING (word_id) GROUP BY ALL) GROUP BY ALL)"


def questions(t: Tables) -> DataFrame:
    """Question id and its words: the parts of an order."""
    return t.lineitem.select(F.col("l_orderkey").alias("query"), F.col("l_partkey").alias("word_id")).distinct()


def island_scores(words: DataFrame, index: DataFrame) -> DataFrame:
    """Best weight of each word in an island, summed by question and island; whole: the sum of all its weights.

    A word's weights in an island don't depend on the question, so they are aggregated before the join.
    """
    best = index.groupBy("word_id", "island_id").agg(F.max("weight").alias("mw"), F.sum("weight").alias("sw"))
    return words.join(best, "word_id").groupBy("query", "island_id").agg(F.sum("mw").alias("score"), F.sum("sw").alias("whole"), F.count(F.lit(1)).alias("n_words"))


def winners(scores: DataFrame) -> DataFrame:
    """Winner, runner-up and margin of each question: first over second, 99 if there is no second, or it has 0."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), "island_id")
    two = scores.select("query", "island_id", "score", "n_words").withColumn("nth", F.row_number().over(order)).where("nth <= 2")
    at = lambda c, k: F.max(F.when(F.col("nth") == k, F.col(c)))
    out = two.groupBy("query").agg(at("island_id", 1).alias("winner"), at("score", 1).alias("w1"), at("island_id", 2).alias("runner_up"), at("score", 2).alias("w2"), at("n_words", 1).alias("n_words"))
    return out.withColumn("margin", F.when(F.coalesce("w2", F.lit(0)) > 0, F.col("w1") / F.col("w2")).otherwise(F.lit(99.0)))


_WIN = "o AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, island_id) AS nth FROM sc), wn AS (SELECT a.query, a.island_id AS winner, a.score AS w1, b.island_id AS runner_up, b.score AS w2, a.n_words, CASE WHEN coalesce(b.score, 0) > 0 THEN a.score / b.score ELSE 99 END AS margin FROM o a LEFT JOIN o b ON a.query = b.query AND b.nth = 2 WHERE a.nth = 1)"


@query(f"{FULL}, {_WORDS_OF}, {_SCORES} SELECT * FROM sc")
def island_leaderboard(t):
    return island_scores(questions(t), index_of(t)).drop("whole")


@query(f"{FULL}, {_WORDS_OF}, {_SCORES}, {_WIN} SELECT * FROM wn")
def island_winner(t):
    return winners(island_scores(questions(t), index_of(t)))


#: Fixed value: a passed question whose margin is below this is thin.
THIN = 1.05

_BATTERY = """, sums AS (SELECT query, island_id, sum(weight) AS whole FROM wq JOIN ei USING (word_id) GROUP BY ALL),
e AS (SELECT query, arg_min(island_id, (-whole, island_id)) AS expected FROM sums GROUP BY query)
SELECT query, expected, winner, coalesce(margin, 0) AS margin, CASE WHEN winner = expected THEN 'PASS' ELSE 'FAIL' END AS status, coalesce(winner = expected AND margin < 1.05, false) AS thin
FROM (SELECT DISTINCT query FROM wq) LEFT JOIN wn USING (query) LEFT JOIN e USING (query)"""


@query(f"{FULL}, {_WORDS_OF}, {_SCORES}, {_WIN}{_BATTERY}")
def battery_margin(t):
    """Pass or fail of each question: the island of the largest sum of all weights is the one expected.

    The winner alone decides; a pass by a small margin is thin.  A question without any hit has no winner and fails with margin 0.
    """
    asked = questions(t)
    scores = t.kept(island_scores(asked, index_of(t)))
    top = scores.groupBy("query").agg(F.max_by("island_id", F.struct("whole", -F.col("island_id"))).alias("expected"))
    won = asked.select("query").distinct().join(winners(scores), "query", "left").join(top, "query", "left")
    passed = F.coalesce(F.col("winner") == F.col("expected"), F.lit(False))
    margin = F.coalesce("margin", F.lit(0.0))
    return won.select("query", "expected", "winner", margin.alias("margin"), F.when(passed, "PASS").otherwise("FAIL").alias("status"), (passed & (margin < THIN)).alias("thin"))


@query(f"{FULL}, {_WORDS_OF} SELECT query, town_id, sum(weight)::BIGINT AS score, count(*) AS n, string_agg(word_id::VARCHAR, ',' ORDER BY word_id) AS words FROM wq JOIN ei USING (word_id) WHERE town_id IS NOT NULL GROUP BY query, town_id")
def town_leaderboard(t):
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("word_id")), lambda x: x.cast("string")), ",")
    return questions(t).join(index_of(t).where("town_id is not null"), "word_id").groupBy("query", "town_id").agg(F.sum("weight").alias("score"), F.count(F.lit(1)).alias("n"), ids.alias("words"))


@query(f"{FULL} SELECT w.word, level, island, town, reef_id, weight FROM ei JOIN w USING (word_id) JOIN isl USING (island_id) LEFT JOIN tow USING (town_id)")
def word_placements(t):
    """All placements of all words, by word and weight."""
    words = t.words.select("word_id", "word")
    return index_of(t).join(words, "word_id").join(F.broadcast(t.islands.select("island_id", "island")), "island_id").join(t.towns.select("town_id", "town"), "town_id", "left").orderBy("word", F.desc("weight")).select("word", "level", "island", "town", "reef_id", "weight")


@query(f"{FULL}, x AS (SELECT word_id, level, island_id, weight, row_number() OVER (PARTITION BY word_id ORDER BY weight DESC, island_id, town_id NULLS FIRST, reef_id NULLS FIRST) AS k FROM ei) SELECT w.word_id, w.word, x.level, x.island_id, x.weight, x.k FROM w LEFT JOIN x ON x.word_id = w.word_id AND k <= 3")
def word_diagnosis(t):
    """The three best placements of every word; words without any are there too."""
    order = Window.partitionBy("word_id").orderBy(F.desc("weight"), "island_id", F.asc_nulls_first("town_id"), F.asc_nulls_first("reef_id"))
    top = index_of(t).withColumn("k", F.row_number().over(order)).where("k <= 3").select("word_id", "level", "island_id", "weight", "k")
    return t.words.select("word_id", "word").join(top, "word_id", "left")


@query(f"{FULL} SELECT arch_id, count(DISTINCT word_id) AS words, count(*) AS placements FROM ei JOIN isl USING (island_id) GROUP BY arch_id")
def archipelago_coverage(t):
    return index_of(t).join(F.broadcast(t.islands.select("island_id", "arch_id")), "island_id").groupBy("arch_id").agg(F.countDistinct("word_id").alias("words"), F.count(F.lit(1)).alias("placements"))


@query(f"{FULL} SELECT word_id, word FROM w WHERE word_id NOT IN (SELECT word_id FROM ei)")
def missing_words(t):
    return t.words.join(index_of(t).select("word_id"), "word_id", "left_anti").select("word_id", "word")


@query(f"{BASE} SELECT r_name AS arch, island, town, reef_id, count(*) AS words FROM rw JOIN region ON arch_id = r_regionkey JOIN isl USING (island_id) JOIN tow USING (town_id) GROUP BY ALL")
def hierarchy_path(t):
    out = t.reef_words().groupBy("arch_id", "island_id", "town_id", "reef_id").agg(F.count(F.lit(1)).alias("words"))
    return out.join(F.broadcast(t.archipelagos), "arch_id").join(F.broadcast(t.islands.drop("arch_id")), "island_id").join(t.towns.drop("island_id"), "town_id").select("arch", "island", "town", "reef_id", "words")


@query(f"{BASE} SELECT word_id, word FROM w WHERE word LIKE '% %' AND word ILIKE '%BLUE%'")
def compound_list(t):
    return t.words.where(F.col("word").contains(" ") & F.col("word").ilike("%BLUE%")).select("word_id", "word")


@query(f"{BASE}, {STATS} SELECT count(*) AS rows, count(*) FILTER (specificity IS NULL) AS null_specificity, count(*) FILTER (pos IS NULL) AS null_pos, count(*) FILTER (reef_count = 0) AS without_reef FROM ws")
def null_audit(t):
    ws = word_stats_of(t)[1]
    return ws.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("specificity").isNull()).alias("null_specificity"), F.count_if(F.col("pos").isNull()).alias("null_pos"), F.count_if(F.col("reef_count") == 0).alias("without_reef"))


# --- pruning

_PRED = f"{BASE}, c AS (SELECT pred.*, n, (SELECT count(DISTINCT town_id) FROM pred) AS total FROM pred JOIN (SELECT word_id, count(DISTINCT town_id) AS n FROM pred GROUP BY 1) USING (word_id)), a AS (SELECT *, CASE WHEN score >= 0.7 OR total <= 1 THEN score ELSE score * log2(total::DOUBLE / n) / log2(total::DOUBLE) END AS adjusted FROM c)"
_UB = f"{BASE}, u AS (SELECT word_id FROM pred GROUP BY 1 HAVING count(DISTINCT town_id) >= 20)"


@query(f"{_PRED} SELECT town_id, word_id, adjusted AS score FROM a WHERE adjusted >= 0.4")
def idf_adjust(t):
    return prune.idf_adjust(t.predictions)


@query(f"{BASE}, p AS (SELECT island_id, word_id, max(score) AS score FROM pred JOIN tow USING (town_id) GROUP BY ALL), c AS (SELECT p.*, n, (SELECT count(DISTINCT island_id) FROM p) AS total FROM p JOIN (SELECT word_id, count(DISTINCT island_id) AS n FROM p GROUP BY 1) USING (word_id)), a AS (SELECT *, CASE WHEN score >= 0.7 OR total <= 1 THEN score ELSE score * log2(total::DOUBLE / n) / log2(total::DOUBLE) END AS adjusted FROM c) SELECT island_id, word_id, adjusted AS score FROM a WHERE adjusted >= 0.4")
def domain_idf_adjust(t):
    """The adjustment with another group than towns."""
    rows = t.predictions.join(t.towns.select("town_id", "island_id"), "town_id").groupBy("island_id", "word_id").agg(F.max("score").alias("score"))
    return prune.idf_adjust(rows, key="island_id")


@query(f"{_UB} SELECT town_id, word_id, CASE WHEN u.word_id IS NOT NULL AND score < 0.95 THEN score * 0.5 ELSE score END AS score FROM pred LEFT JOIN u USING (word_id) WHERE u.word_id IS NULL OR score >= 0.8")
def ubiquity_prune(t):
    return prune.ubiquity_prune(t.predictions)


@query(f"{_UB} SELECT count(DISTINCT word_id) AS words, count(*) FILTER (score < 0.8) AS deleted, count(*) FILTER (score >= 0.8 AND score < 0.95) AS halved, count(*) FILTER (score >= 0.95) AS kept FROM pred WHERE word_id IN (SELECT word_id FROM u)")
def ubiquity_preview(t):
    return prune.ubiquity_preview(t.predictions)


@query(f"{_PRED}, g AS (SELECT town_id, word_id FROM a WHERE adjusted < 0.4) SELECT reef_id, word_id, source FROM rw WHERE NOT (source = 'xgboost' AND EXISTS (SELECT 1 FROM g WHERE g.town_id = rw.town_id AND g.word_id = rw.word_id))")
def orphan_cleanup(t):
    gone = prune.idf_adjusted(t.predictions).where(F.col("adjusted") < 0.4)
    return prune.orphan_cleanup(t.reef_words(), gone).select("reef_id", "word_id", "source")


@query(f"{_PRED}, g AS (SELECT town_id, word_id FROM a WHERE adjusted < 0.4), k AS (SELECT DISTINCT reef_id FROM rw WHERE NOT (source = 'xgboost' AND EXISTS (SELECT 1 FROM g WHERE g.town_id = rw.town_id AND g.word_id = rw.word_id))) SELECT DISTINCT reef_id, town_id FROM rw WHERE reef_id IN (SELECT reef_id FROM k)")
def live_reefs(t):
    facts = t.reef_words()
    gone = prune.idf_adjusted(t.predictions).where(F.col("adjusted") < 0.4)
    return prune.live_reefs(facts.select("reef_id", "town_id").distinct(), prune.orphan_cleanup(facts, gone))


@query(f"{_PRED} SELECT floor(score * 10)::INT AS tenth, count(*) AS rows, avg(score) AS avg_raw, avg(adjusted) AS avg_adjusted, avg(n) AS avg_n, count(*) FILTER (adjusted < 0.4) AS pruned FROM a GROUP BY 1")
def score_buckets(t):
    return prune.score_buckets(t.predictions)


@query(f"{_PRED} SELECT town_id, word_id, score, adjusted FROM a WHERE score >= 0.4 AND score < 0.6 AND adjusted >= 0.1 ORDER BY adjusted DESC, town_id, word_id LIMIT 30")
def borderline_kept(t):
    return prune.borderline(t.predictions, 0.1)


@query(f"{_PRED} SELECT town_id, word_id, round(score - adjusted, 9) AS drop FROM a ORDER BY drop DESC, town_id, word_id LIMIT 30")
def biggest_drop(t):
    return prune.biggest_drop(t.predictions)


@query(f"{_PRED} SELECT town_id, count(*) FILTER (score >= 0.4) AS raw_4, count(*) FILTER (adjusted >= 0.4) AS adj_4, count(*) FILTER (score >= 0.5) AS raw_5, count(*) FILTER (adjusted >= 0.5) AS adj_5, count(*) FILTER (score >= 0.6) AS raw_6, count(*) FILTER (adjusted >= 0.6) AS adj_6, count(*) FILTER (score >= 0.7) AS raw_7, count(*) FILTER (adjusted >= 0.7) AS adj_7 FROM a GROUP BY 1")
def threshold_table(t):
    return prune.threshold_table(t.predictions)


@query(f"{BASE}, h AS (SELECT n AS towns, count(*) AS words FROM (SELECT word_id, count(DISTINCT town_id) AS n FROM pred GROUP BY 1) GROUP BY 1) SELECT towns, words, (sum(words) OVER (ORDER BY towns))::BIGINT AS cumulative FROM h")
def towns_histogram(t):
    n = t.predictions.groupBy("word_id").agg(F.countDistinct("town_id").alias("towns"))
    return stats.cumulative(n.groupBy("towns").agg(F.count(F.lit(1)).alias("words")), "towns", "words")


@query("SELECT doc_id, token, (token IN ('the', 'of', 'and', 'la', 'der'))::INT AS is_stop FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '(\\p{L}+)', 1)) AS token FROM documents)")
def stop_words(t):
    rows = t.tokens.select("doc_id", F.col("token").alias("word")).distinct()
    return prune.flag_stop_words(rows, ["the", "of", "and", "la", "der"]).withColumnRenamed("word", "token")


_SPELLED = "CASE p_size % 4 WHEN 0 THEN replace(p_name, ' ', '-') WHEN 1 THEN p_name ELSE replace(p_name, ' ', '') END"


@query(f"WITH {fact_sql(48)} SELECT p_partkey AS word_id, 'domainless' AS domain FROM part WHERE p_size % 5 <> 0 AND {_SPELLED} NOT LIKE '% %' AND {_SPELLED} NOT LIKE '%-%' AND p_partkey NOT IN (SELECT word_id FROM rw)")
def domainless(t):
    """Names are spelt with a hyphen, with a blank, or as one word, and a fifth has no embedding, by the part's size."""
    size = F.col("p_size") % 4
    word = F.when(size == 0, F.regexp_replace("p_name", " ", "-")).when(size == 1, F.col("p_name")).otherwise(F.regexp_replace("p_name", " ", ""))
    return prune.domainless(t.part.select(F.col("p_partkey").alias("word_id"), word.alias("word"), (F.col("p_size") % 5 != 0).alias("embedded")), t.reef_words(48))


@query(f"{BASE} SELECT reef_id, word_id, source, CASE WHEN word_id % 9 <> 0 THEN reef_cos END AS name_cos FROM rw WHERE NOT (source = 'xgboost' AND word_id % 9 <> 0 AND reef_cos < 0.65)")
def name_cosine_floor(t):
    """Predicted members whose name cosine is known and below the floor go; it is unknown for each ninth word."""
    rows = t.reef_words().select("reef_id", "word_id", "source", F.when(F.col("word_id") % 9 != 0, F.col("reef_cos")).alias("name_cos"))
    return prune.name_floor(rows)


# --- refresh after deletions


def _after(sql: str) -> str:
    """The same SQL over the facts that the clean-up leaves."""
    return re.sub(r"\brw\b", "rk", sql)


_GONE = f"{_PRED}, gone AS (SELECT town_id, word_id FROM a WHERE adjusted < 0.4), rk AS MATERIALIZED (SELECT * FROM rw WHERE NOT (source = 'xgboost' AND EXISTS (SELECT 1 FROM gone WHERE gone.town_id = rw.town_id AND gone.word_id = rw.word_id))), {_after(STATS)}, {_after(LEVELS)}"


def refreshed(t: Tables, *tiers: str) -> refresh.Model:
    """The model after the pruned predictions' facts went, from the model before and these facts alone; of the model before only the tiers that are asked for are made."""
    old = refresh.build(t.words, t.kept(t.reef_words()))
    old = old._replace(**{name: t.kept(getattr(old, name)) for name in tiers})
    pruned = prune.idf_adjusted(t.kept(t.predictions)).where(F.col("adjusted") < 0.4).select("town_id", "word_id")
    gone = old.facts.where("source = 'xgboost'").join(pruned, ["town_id", "word_id"], "left_semi").select("reef_id", "word_id")
    return refresh.refresh(t.words, old, gone)


@query(f"{_GONE} SELECT ws.word_id, ws.reef_count, ws.town_count, ws.island_count, ws.specificity, level, idf FROM ws LEFT JOIN lv USING (word_id)")
def refreshed_words(t):
    """Counts, levels and idf of all words after pruning, of which only the touched ones are counted again."""
    return refresh.word_rows(t.words, refreshed(t, "reefs"))


def _tier_after(name: str, c: str) -> str:
    once = f"SELECT {c}, word_id FROM rk GROUP BY ALL"
    return f"SELECT '{name}' AS tier, {c}::VARCHAR AS grp, count(*) AS word_count, {_PROFILE} FROM ({once}) JOIN ws USING (word_id) GROUP BY {c}"


@query(f"{_GONE} {' UNION ALL '.join(_tier_after(name, c) for name, c in refresh.TIERS.items())}")
def refreshed_rollups(t):
    """Rollups of reefs, towns and islands after pruning, of which only those with a touched word are made again."""
    model, out = refreshed(t, *refresh.TIERS), None
    for name, key in refresh.TIERS.items():
        rows = getattr(model, name).select(F.lit(name).alias("tier"), F.col(key).cast("string").alias("grp"), "word_count", "noun_frac", "verb_frac", "adj_frac", "adv_frac", "avg_specificity")
        out = rows if out is None else out.unionByName(rows)
    return out
