"""Queries of reports and selections."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import ranks, reports, seeds
from ..sources import sinks
from ..sources.proxy import fact_sql
from .catalog import query
from .lexicon import TOK
from .membership import _PRED, BASE

@query(f"{_PRED} SELECT count(*) AS before, count(*) FILTER (adjusted >= 0.4) AS after, count(*) FILTER (adjusted < 0.4) AS pruned, count(*) FILTER (adjusted < 0.4) * 100::DOUBLE / count(*) AS pruned_pct FROM a")
def prune_summary(t):
    return reports.prune_summary(t.predictions)


@query(f"{_PRED}, f AS (SELECT *, CASE WHEN adjusted < 0.4 THEN 'pruned' ELSE 'kept' END AS fate FROM a), r AS (SELECT *, row_number() OVER (PARTITION BY town_id, fate ORDER BY CASE fate WHEN 'pruned' THEN -score ELSE adjusted END, word_id) AS nth FROM f) SELECT town_id, fate, nth, word_id, score, adjusted, n FROM r WHERE nth <= CASE fate WHEN 'pruned' THEN 30 ELSE 20 END")
def prune_samples(t):
    return reports.prune_samples(t.predictions)


@query(f"{BASE} SELECT word_id, count(DISTINCT town_id) AS n_towns, avg(score) AS avg_score, min(score) AS min_score FROM pred GROUP BY 1 HAVING count(DISTINCT town_id) >= 10 ORDER BY n_towns DESC, word_id LIMIT 30")
def most_ubiquitous(t):
    return reports.most_ubiquitous(t.predictions)


@query(f"{BASE} SELECT word_id, count(DISTINCT town_id) AS n_towns, count(DISTINCT island_id) AS n_islands FROM rw WHERE word_id NOT IN (SELECT word_id FROM w WHERE p_size = 50) GROUP BY 1 ORDER BY n_islands DESC, n_towns DESC, word_id LIMIT 20")
def reef_spread(t):
    return reports.reef_spread(t.reef_words(), t.words.where("p_size = 50").select("word_id"))


_PATH = "SELECT town_id, town, island, r_name AS archipelago FROM tow JOIN isl USING (island_id) JOIN region ON arch_id = r_regionkey"


@query(f"WITH {fact_sql(50)} {_PATH} WHERE town_id NOT IN (SELECT town_id FROM rw WHERE source = 'curated')")
def unseeded_towns(t):
    """Towns without a curated word, with the fewer facts of the largest quantity."""
    return reports.unseeded(t.towns, t.islands, t.archipelagos, t.reef_words(50).where("source = 'curated'"))


@query(f"WITH {fact_sql(50)} {_PATH} WHERE is_bucket = 0 AND town_id NOT IN (SELECT town_id FROM rw WHERE is_core = 0)")
def dead_towns(t):
    """Topical towns without a word outside the core."""
    sizes = t.reef_words(50).where("is_core = 0").groupBy("town_id").agg(F.count(F.lit(1)).alias("word_count"))
    return reports.dead(t.towns, t.islands, t.archipelagos, sizes)


@query(f"{BASE} SELECT p.*, f AS model_f1 FROM ({_PATH} WHERE is_bucket = 0) p JOIN (SELECT town_id, CASE WHEN town_id % 11 <> 0 THEN (town_id * 37 % 100) / 100::DOUBLE END AS f FROM tow) USING (town_id) WHERE f < 0.75")
def low_f1_towns(t):
    """Towns of weak classifiers; the F1 is made of the town's id, and unknown for each eleventh."""
    f1 = F.when(F.col("town_id") % 11 != 0, (F.col("town_id") * 37 % 100) / 100.0)
    return reports.low_f1(t.towns, t.islands, t.archipelagos, t.towns.select("town_id", f1.alias("model_f1")))


@query(f"{BASE} {_PATH} WHERE island = 'NATION_3'")
def island_targets(t):
    """The towns of one island, chosen by its name."""
    return reports.targets(t.towns, t.islands, t.archipelagos, F.col("island") == "NATION_3")


@query(f"{BASE} {_PATH} WHERE town = 'Supplier#000000004'")
def town_targets(t):
    """The towns of one name."""
    return reports.targets(t.towns, t.islands, t.archipelagos, F.col("town") == "Supplier#000000004")


@query(f"{BASE}, s AS (SELECT island_id, town_id, town, list_sort(list(DISTINCT word))[1:15] AS ws FROM rw JOIN w USING (word_id) JOIN tow USING (town_id, island_id) WHERE is_core = 1 GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY island_id ORDER BY town, town_id) AS nth FROM s) SELECT island_id, nth, town, array_to_string(ws, ', ') AS words FROM r WHERE nth <= 5")
def sibling_samples(t):
    rows = t.reef_words().join(t.words, "word_id").select("town_id", "word", F.when(F.col("is_core") == 1, "core").otherwise("peripheral").alias("confidence"))
    return reports.sibling_samples(rows, t.towns)


@query(f"{BASE}, wd AS (SELECT word_id, CASE WHEN p_size % 3 = 0 THEN 'compound' ELSE 'single' END AS category, word_count, p_size % 5 <> 0 AS embedded FROM w), sd AS (SELECT town_id, word_id FROM rw WHERE source = 'curated') SELECT 'compounds' AS metric, count(*) AS n FROM wd WHERE category = 'compound' AND word_count > 1 UNION ALL SELECT 'seeds', count(*) FROM sd UNION ALL SELECT 'without embedding', count(*) FROM sd JOIN wd USING (word_id) WHERE NOT embedded UNION ALL SELECT 'island ' || island, count(*) FROM sd JOIN tow USING (town_id) JOIN isl USING (island_id) GROUP BY island")
def compound_check(t):
    words = t.words.select("word_id", F.when(F.col("p_size") % 3 == 0, "compound").otherwise("single").alias("category"), "word_count", (F.col("p_size") % 5 != 0).alias("embedded"))
    return reports.compound_check(words, t.reef_words().select("town_id", "word_id", "source"), t.towns, t.islands, "curated")


@query(f"{BASE} SELECT town_id, word_id, score FROM pred WHERE score >= 0.4 AND NOT EXISTS (SELECT 1 FROM rw WHERE rw.town_id = pred.town_id AND rw.word_id = pred.word_id AND source = 'curated') AND word_id NOT IN (SELECT word_id FROM rw WHERE is_bucket = 1) AND word_id NOT IN (SELECT word_id FROM w WHERE p_size = 50)")
def accepted_predictions(t):
    facts = t.reef_words()
    return reports.accepted(t.predictions, facts.where("source = 'curated'"), facts.where("is_bucket = 1"), t.words.where("p_size = 50")).select("town_id", "word_id", "score")


@query(f"{BASE}, c AS (SELECT min(town_id) AS town_id FROM tow GROUP BY island_id), u AS (SELECT town_id, word_id FROM rw WHERE source = 'curated' UNION SELECT town_id, word_id FROM pred WHERE score >= 0.7) SELECT word_id, count(*) AS towns, count(*) FILTER (town_id IN (SELECT town_id FROM c)) AS capitals FROM u GROUP BY 1")
def core_words(t):
    capitals = t.towns.groupBy("island_id").agg(F.min("town_id").alias("town_id"))
    return reports.core_words(t.reef_words().where("source = 'curated'"), t.predictions, capitals, 0.7)


@query(f"{BASE} SELECT word_id, word FROM w ORDER BY md5(word_id || ':42'), word_id LIMIT 10")
def random_words(t):
    return reports.random_words(t.words.select("word_id", "word"))


_HITS = f"{BASE}, sz AS (SELECT island_id, count(*) AS towns FROM tow GROUP BY 1 HAVING count(*) >= 2), hi AS (SELECT island_id, word_id FROM pred JOIN tow USING (town_id) JOIN sz USING (island_id) GROUP BY island_id, word_id, towns HAVING count(DISTINCT town_id) >= greatest(2, floor(towns * 0.8))), kn AS (SELECT DISTINCT island_id, word_id, 'seed_cosine_std' AS source FROM rw WHERE is_core = 1 AND word_id % 3 = 0)"


def _promoted(t) -> tuple[DataFrame, DataFrame]:
    known = t.reef_words().where("is_core = 1 and word_id % 3 = 0").select("island_id", "word_id", F.lit("seed_cosine_std").alias("source")).distinct()
    return reports.promote_island_words(t.predictions, t.towns, seeds.island_promotion(t.predictions, t.towns), known)


@query(f"{_HITS} SELECT * FROM kn UNION ALL SELECT island_id, word_id, 'xgboost_filter' FROM hi ANTI JOIN kn USING (island_id, word_id)")
def island_words(t):
    """Island words found by seeds, and those that predictions promote."""
    return _promoted(t)[0]


@query(f"{_HITS} SELECT town_id, word_id, score FROM pred LEFT JOIN tow USING (town_id) ANTI JOIN hi USING (island_id, word_id)")
def predictions_left(t):
    """Predictions without the words that their island took."""
    return _promoted(t)[1]


@query(f"{BASE} SELECT reef_id, coalesce(CASE WHEN reef_id LIKE '%LARGE' OR town_id % 2 = 0 THEN NULL ELSE reef_id END, town) AS name FROM (SELECT DISTINCT reef_id, town_id FROM rw) JOIN tow USING (town_id)")
def reef_names(t):
    """A reef without a name of its own has its town's."""
    rows = t.reef_words().select("reef_id", "town_id").distinct().join(t.towns, "town_id")
    return rows.select("reef_id", F.coalesce(F.when(~(F.col("reef_id").endswith("LARGE") | (F.col("town_id") % 2 == 0)), F.col("reef_id")), "town").alias("name"))


_DSC = f"{TOK}, r0 AS (SELECT source AS domain, token AS word_id, CASE WHEN lang = 'en' THEN 1.0 WHEN lang = 'de' THEN 0.9 ELSE 0.7 END AS q FROM tok), b0 AS (SELECT domain, word_id, max(q)::DOUBLE AS source_quality FROM r0 GROUP BY ALL), n0 AS (SELECT word_id, count(DISTINCT domain) AS n_word_domains FROM r0 GROUP BY 1), k0 AS (SELECT count(DISTINCT domain) AS total FROM r0), e0 AS (SELECT DISTINCT domain, word_id, length(word_id) % 7 AS reef_id, CASE WHEN length(word_id) % 7 = 6 THEN NULL ELSE length(word_id) / 40 END AS centroid_sim FROM r0 WHERE length(word_id) % 3 = 0), ds AS (SELECT domain, word_id, coalesce(reef_id, -1) AS reef_id, coalesce(centroid_sim, 0.8)::DOUBLE AS centroid_sim, n_word_domains, log2(total::DOUBLE / n_word_domains) AS idf, source_quality, log2(total::DOUBLE / n_word_domains) * source_quality * coalesce(centroid_sim, 0.8) AS score FROM b0 JOIN n0 USING (word_id) CROSS JOIN k0 LEFT JOIN e0 USING (domain, word_id))"


def _domain_scores(t) -> DataFrame:
    quality = F.when(F.col("lang") == "en", 1.0).when(F.col("lang") == "de", 0.9).otherwise(0.7)
    rows = t.tokens.select(F.col("source").alias("domain"), F.col("token").alias("word_id"), quality.alias("source_quality"))
    size = F.length("word_id")
    reefs = rows.select("domain", "word_id").distinct().where(size % 3 == 0).select("domain", "word_id", (size % 7).alias("reef_id"), F.when(size % 7 != 6, size / 40.0).alias("centroid_sim"))
    return reports.best_scores(rows, reefs)


@query(f"{_DSC} SELECT * FROM ds")
def domain_scores(t):
    """Scores of words in domains by the best source; a pair without a reef has reef -1, and without a similarity 0.8."""
    return _domain_scores(t)


@query(f"{_DSC}, q0 AS (SELECT DISTINCT item_id AS query, unnest(regexp_extract_all(lower(text), '(\\p{{L}}+)', 1)) AS word_id FROM benchmark), s0 AS (SELECT query, domain, sum(score) AS total FROM q0 JOIN ds USING (word_id) GROUP BY ALL), o0 AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY round(total, 9) DESC, domain) AS place FROM s0) SELECT query, place, domain, total FROM o0 WHERE place <= 10")
def domain_leaderboard(t):
    """The ten best domains of each benchmark text."""
    asked = t.benchmark.select(F.col("item_id").alias("query"), F.explode(F.regexp_extract_all(F.lower("text"), F.lit("(\\p{L}+)"), 1)).alias("word_id"))
    return reports.domain_leaderboard(_domain_scores(t), asked)


# --- small functions over whole tables


@query("SELECT p_partkey AS word_id, CASE WHEN x < 0 THEN x::HUGEINT + 18446744073709551616::HUGEINT ELSE x::HUGEINT END::VARCHAR AS u FROM (SELECT p_partkey, (p_partkey * 4611686018427387 - 4611686018427387000)::BIGINT AS x FROM part)")
def unsigned_hash(t):
    """Keys times a constant as signed 64-bit numbers, read as unsigned ones; beyond the range they wrap, as hashes do."""
    wide = F.col("p_partkey").cast("decimal(19,0)") * F.lit(Decimal(4611686018427387)) - F.lit(Decimal(4611686018427387000))
    half, whole = F.lit(Decimal(2**63)), F.lit(Decimal(2**64))
    x = (F.pmod(wide + half, whole) - half).cast("long")
    return t.part.select(F.col("p_partkey").alias("word_id"), S.unsigned(x).cast("string").alias("u"))


@query("WITH n AS (SELECT s_suppkey AS id, s_suppkey * 7 % 200 AS n FROM supplier) SELECT id, n, CASE WHEN n = 0 THEN 0 WHEN n <= 3 THEN 2 WHEN n <= 10 THEN 1 WHEN n <= 50 THEN 0 WHEN n <= 150 THEN -1 ELSE -2 END AS specificity FROM n")
def domain_specificity(t):
    n = F.col("s_suppkey") * 7 % 200
    return t.supplier.select(F.col("s_suppkey").alias("id"), n.alias("n"), S.domain_specificity(n).alias("specificity"))


@query("SELECT vec_id, list_dot_product(embedding::DOUBLE[], list_reverse(embedding::DOUBLE[])) AS x FROM embeddings")
def dot_products(t):
    return t.embeddings.select("vec_id", S.dot(F.col("embedding"), F.reverse("embedding")).alias("x"))


@query(f"{BASE} SELECT word_id, (pos = 'noun')::INT::DOUBLE AS noun, (pos = 'verb')::INT::DOUBLE AS verb, (pos = 'adj')::INT::DOUBLE AS adj, (pos = 'adv')::INT::DOUBLE AS adv FROM w")
def tag_features(t):
    """The one-hot tags of the classifiers' features."""
    hot = S.pos_one_hot(F.col("pos"))
    return t.words.select("word_id", *[hot[i].alias(p) for i, p in enumerate(("noun", "verb", "adj", "adv"))])


@query("SELECT (SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)) + (SELECT count(*) FROM lineitem WHERE l_linenumber * 40 NOT BETWEEN 0 AND 255) AS n")
def key_violations(t):
    """Lines against the key of order and number, and weights beyond a byte."""
    return sinks.violations(t.lineitem.withColumn("w", F.col("l_linenumber") * 40), ["l_orderkey", "l_linenumber"], ("w",))


@query("SELECT l_returnflag AS flag, l_suppkey % 7 AS part, round(quantile_cont(l_extendedprice::DOUBLE, 0.1), 4) AS p10, round(quantile_cont(l_extendedprice::DOUBLE, 0.5), 4) AS p50, round(quantile_cont(l_extendedprice::DOUBLE, 0.999), 4) AS p999 FROM lineitem GROUP BY ALL")
def price_quantiles(t):
    """Exact quantiles of lines' prices by flag and part of the suppliers, by refined histograms."""
    rows = t.lineitem.select(F.col("l_returnflag").alias("flag"), (F.col("l_suppkey") % 7).alias("part"), "l_extendedprice")
    found = ranks.quantiles(rows, ["flag", "part"], "l_extendedprice", {"p10": 0.1, "p50": 0.5, "p999": 0.999})
    return found.select("flag", "part", *[F.round(c, 4).alias(c) for c in ("p10", "p50", "p999")])
