"""Queries over reefs of embedded words, base forms, and texts made for embedding."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import stemming
from ..operators import boost, learn, reefs, text, vectors
from ..sources import scratch
from .catalog import query
from .lexicon import _SIM, _TW, COS, TOK, tagged_vectors, text_parts, town_means

CORE = 0.25  # a word is core if its cosine with its town's mean is this or more


def memberships(t) -> DataFrame:
    """A word belongs to the two towns whose means are nearest to it."""
    sims = vectors.similarities(t.vectors, town_means(t), "town_id")
    order = Window.partitionBy("vec_id").orderBy(F.desc(F.round("cos", 9)), "other")
    return sims.withColumn("k", F.row_number().over(order)).where("k <= 2").select("vec_id", F.col("other").alias("town_id"))


_MEM = f"{_SIM}, mem AS (SELECT vec_id, other AS town_id FROM (SELECT vec_id, other, row_number() OVER (PARTITION BY vec_id ORDER BY round(cos, 9) DESC, other) AS k FROM sim) WHERE k <= 2), n1 AS (SELECT town_id, count(*) AS n FROM mem GROUP BY 1), pm0 AS (SELECT x.town_id AS a, y.town_id AS b, log2(count(*) * (SELECT count(DISTINCT vec_id) FROM mem)::DOUBLE / (any_value(p.n) * any_value(q.n)::DOUBLE)) AS pmi FROM mem x JOIN mem y USING (vec_id) JOIN n1 p ON p.town_id = x.town_id JOIN n1 q ON q.town_id = y.town_id WHERE x.town_id <> y.town_id GROUP BY ALL), cx AS (SELECT vec_id, b, sum(pmi) AS x FROM mem JOIN pm0 ON a = town_id WHERE pmi > 0 GROUP BY ALL), cn AS (SELECT vec_id, sqrt(sum(x * x)) AS n FROM cx GROUP BY 1)"


def contexts_of(t) -> DataFrame:
    return reefs.context_vectors(memberships(t), "town_id", "vec_id")


def clustered(t) -> tuple[DataFrame, DataFrame]:
    """Core words' reefs, and all words placed."""
    means = town_means(t).withColumnRenamed("c", "mean")
    core = t.vectors.join(means, "town_id").where(S.cosine(F.col("v"), F.col("mean")) >= CORE).select("town_id", "vec_id", "v")
    found = reefs.cluster(core, contexts_of(t))
    return found, reefs.place(t.vectors, found)


def names_of(t) -> DataFrame:
    return t.vectors.select("vec_id", F.concat(F.lit("w"), F.col("vec_id").cast("string")).alias("name"))


_HYBRID = (
    f"{_MEM}, dots AS (SELECT p.vec_id AS a, q.vec_id AS b, sum(p.x * q.x) AS d FROM cx p JOIN cx q USING (b) JOIN vec va ON va.vec_id = p.vec_id JOIN vec vb ON vb.vec_id = q.vec_id AND va.town_id = vb.town_id WHERE p.vec_id < q.vec_id GROUP BY ALL), "
    f"hs AS (SELECT x.town_id, x.vec_id AS a, y.vec_id AS b, 0.7 * {COS.format(a='x.v', b='y.v')} + 0.3 * coalesce(d / (ca.n * cb.n), 0) AS sim FROM vec x JOIN vec y ON x.town_id = y.town_id AND x.vec_id < y.vec_id LEFT JOIN dots ON a = x.vec_id AND b = y.vec_id LEFT JOIN cn ca ON ca.vec_id = x.vec_id LEFT JOIN cn cb ON cb.vec_id = y.vec_id)"
)


@query(f"{_HYBRID} SELECT * FROM hs")
def hybrid_similarity(t):
    return reefs.hybrid(t.vectors, contexts_of(t))


@query(f"{_HYBRID}, en AS (SELECT town_id, a, b, sim FROM hs UNION ALL SELECT town_id, b, a, sim FROM hs), nb AS (SELECT *, row_number() OVER (PARTITION BY town_id, a ORDER BY round(sim, 9) DESC, b) AS nth FROM en) SELECT DISTINCT town_id, least(a, b) AS a, greatest(a, b) AS b, greatest(round(sim, 9), 0) AS w FROM nb WHERE nth <= 15")
def hybrid_graph(t):
    """Each word with its fifteen most similar words of its town, found by blocks instead of all pairs."""
    return reefs.hybrid_graph(t.vectors, contexts_of(t))


@query()
def reef_assignment(t):
    return clustered(t)[1]


@query()
def reef_labels(t):
    return reefs.labels(clustered(t)[1], names_of(t))


@query()
def reef_summary(t):
    return reefs.summary(clustered(t)[1])


@query()
def town_clusters(t):
    """Towns put together by the similarity of their means and by the words that they share."""
    both = memberships(t)
    shared = reefs.context_vectors(both, "town_id", "vec_id")
    by_town = both.join(shared, "vec_id").select(F.col("town_id").cast("long").alias("vec_id"), F.explode("m").alias("b", "x")).groupBy("vec_id", "b").agg(F.avg("x").alias("x"))
    contexts = by_town.groupBy("vec_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("b", "x")))).alias("m"))
    return reefs.group_clusters(t.vectors, contexts)


_BUCKET = f"{_SIM}, p0 AS (SELECT town_id, unnest(range(1, 65)) AS i, unnest(list_transform(v, lambda x: x / sqrt(list_dot_product(v, v)))) AS x FROM vec), m0 AS (SELECT town_id, list(x ORDER BY i) AS m FROM (SELECT town_id, i, avg(x) AS x FROM p0 GROUP BY ALL) GROUP BY 1), k0 AS (SELECT vec_id, town_id, row_number() OVER (PARTITION BY town_id ORDER BY round({COS.format(a='v', b='m')}, 9) DESC, vec_id) AS nth FROM vec JOIN m0 USING (town_id))"


@query(f"{_BUCKET} SELECT town_id, count(*) AS size, string_agg('w' || vec_id, '_' ORDER BY nth) FILTER (nth <= 3) AS label FROM k0 GROUP BY 1")
def bucket_reefs(t):
    return reefs.bucket_reefs(t.vectors, names_of(t))


@query(f"{_TW}, s AS (SELECT doc_id AS query, grp, sum(weight)::DOUBLE AS score FROM tk JOIN gw USING (token) GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, grp) AS nth FROM s) SELECT query, min(nth) FILTER (contains(lower(grp), source)) AS position, min(nth) FILTER (contains(lower(grp), source)) IS NOT NULL AS passed FROM r JOIN documents ON doc_id = query AND source IS NOT NULL WHERE nth <= 10 GROUP BY query")
def keyword_rank(t):
    """Whether a text's own source is among its ten best groups, and where."""
    tokens, weights, _ = text_parts(t)
    scores = text.group_sums(tokens, *text.by_token(weights)).select(F.col("doc_id").alias("query"), "grp", F.col("s").cast("double").alias("score"))
    return reefs.keyword_rank(scores, t.documents.where("source is not null").select(F.col("doc_id").alias("query"), F.array("source").alias("keywords")))


# --- base forms

_RULES = ", ".join(f"('{p}', '{e}', '{b}')" for p, e, b in stemming.DETACH)


@query(f"{TOK}, x AS (SELECT DISTINCT token FROM tok), b AS (SELECT DISTINCT token, pos, left(token, length(token) - length(ending)) || put AS base FROM x JOIN (VALUES {_RULES}) r(pos, ending, put) ON ends_with(token, ending) AND length(token) > length(ending)) SELECT * FROM b WHERE base <> token AND base IN (SELECT token FROM x)")
def base_forms(t):
    tokens = t.tokens.select("token").distinct()
    return stemming.base_forms(tokens, tokens)


@query()
def stem_variants(t):
    return stemming.stem_variants(t.tokens.select("token").distinct())


@query("SELECT p_partkey AS word_id, CASE WHEN p_name NOT LIKE '% %' THEN 'single' WHEN regexp_matches(lower(p_name), '^(genus|family|order|class|phylum|division|kingdom|suborder|subclass|subfamily) ') THEN 'taxonomic' WHEN p_size % 4 = 1 THEN 'phrasal_verb' WHEN p_size % 4 = 2 THEN 'named_entity' ELSE 'compound' END AS kind FROM part")
def word_kind(t):
    """Kinds of words by their text and the lexicon's flags; the part's size stands for the flags."""
    return t.part.select(F.col("p_partkey").alias("word_id"), S.word_kind(F.col("p_name"), F.col("p_size") % 4 == 1, F.col("p_size") % 4 == 2).alias("kind"))


# --- texts and vectors for models


@query("SELECT p_partkey AS word_id, row_number() OVER (PARTITION BY p_partkey ORDER BY ps) AS nth, 'classification: ' || p_name || ': ' || ps AS text FROM part, unnest(string_split(p_type, ' ')) u(ps) WHERE lower(p_name) <> lower(ps)")
def sense_texts(t):
    """A text for each sense of a word (here the parts of its type), but where the sense is the word itself."""
    senses = t.part.select(F.col("p_partkey").alias("word_id"), F.col("p_name").alias("word"), F.explode(F.split("p_type", " ")).alias("sense"))
    return S.sense_texts(senses, "classification: ")


@query("SELECT p_partkey AS word_id, 'classification: ' || lower(domain) || ' ' || word AS text FROM (SELECT p_partkey, string_split(p_name, ' ')[2] AS word, unnest([p_type, string_split(p_name, ' ')[2]]) AS domain FROM part) WHERE lower(domain) <> word")
def domain_texts(t):
    """A text for each domain of a word, the domain before the word; a domain that is the word itself is left out."""
    word = F.split("p_name", " ")[1]
    rows = t.part.select(F.col("p_partkey").alias("word_id"), word.alias("word"), F.explode(F.array(F.col("p_type"), word)).alias("domain"))
    return S.domain_texts(rows, "classification: ")


_GRAM = "g AS (SELECT token, unnest(list_transform(range(1, length('<' || token || '>') - 1), lambda i: substr('<' || token || '>', i, 3))) AS gram FROM x), h AS (SELECT token, ('0x' || substr(md5(gram), 1, 7))::BIGINT AS h FROM g), d AS (SELECT token, h % 32 AS i, sum(CASE WHEN (h // 32) % 2 = 0 THEN 1 ELSE -1 END)::DOUBLE AS x FROM h GROUP BY ALL), n AS (SELECT token, sqrt(sum(x * x)) AS n FROM d GROUP BY 1)"


@query(f"{TOK}, x AS (SELECT DISTINCT token FROM tok), {_GRAM} SELECT token, i, x / n AS x FROM d JOIN n USING (token) WHERE x <> 0")
def hashed_vectors(t):
    """Embedding of words without a model: signed hashes of their letter trigrams, at length 1; dimensions other than 0."""
    return S.hashed_vectors(t.tokens.select("token").distinct(), "token", 32)


@query(f"{TOK}, x AS (SELECT DISTINCT token FROM tok UNION SELECT DISTINCT source FROM documents WHERE source IS NOT NULL), {_GRAM}, u AS MATERIALIZED (SELECT token, list(coalesce(x / nullif(n, 0), 0) ORDER BY i) AS v FROM (SELECT token, n, unnest(range(0, 32)) AS i FROM n) LEFT JOIN d USING (token, i) GROUP BY 1), pr AS MATERIALIZED (SELECT DISTINCT source, token FROM tok WHERE source IS NOT NULL), sv AS MATERIALIZED (SELECT token AS source, v AS w FROM u WHERE token IN (SELECT source FROM documents)), pv AS MATERIALIZED (SELECT pr.source, pr.token, v FROM pr JOIN u USING (token)) SELECT source AS domain, token AS word, list_dot_product(v, w) AS cos FROM pv JOIN sv USING (source) WHERE abs(list_dot_product(v, w)) > 1e-12")
def name_cosines(t):
    """Cosine of each word's vector with the vector of its domain's name, where it isn't 0."""
    pairs = t.tokens.where("source is not null").select("source", "token").distinct()
    names = t.documents.where("source is not null").select(F.col("source").alias("token")).distinct()
    found = S.hashed_vectors(t.tokens.select("token").union(names).distinct(), "token", 32)
    domain = found.join(F.broadcast(names), "token").select(F.col("token").alias("source"), "i", F.col("x").alias("y"))  # names of the top tier
    return pairs.join(found, "token").join(F.broadcast(domain), ["source", "i"]).groupBy(F.col("source").alias("domain"), F.col("token").alias("word")).agg(F.sum(F.col("x") * F.col("y")).alias("cos")).where("abs(cos) > 1e-12")


@query("SELECT count(*) AS texts, count(DISTINCT word_id) AS words, count(*) AS vectors FROM (SELECT p_partkey AS word_id, unnest(string_split(p_type, ' ')) AS ps, p_name FROM part) WHERE lower(p_name) <> lower(ps)")
def embedded_senses(t):
    """Sense texts embedded in two runs, the second of which finds half of them done: texts, words, and vectors written."""
    senses = t.part.select(F.col("p_partkey").alias("word_id"), F.col("p_name").alias("word"), F.explode(F.split("p_type", " ")).alias("sense"))
    texts = S.sense_texts(senses, "classification: ").withColumn("key", F.concat_ws("/", "word_id", "nth"))
    path = scratch.new_path(t.spark, "vectors")
    encode = lambda rows, c: S.hashed_vectors(rows, c, 32).groupBy(c).agg(F.map_from_entries(F.collect_list(F.struct("i", "x"))).alias("v"))
    for part in (texts.where("word_id % 2 = 0"), texts):
        vectors.embed_missing(part, path, "key", "text", encode)
    done = t.spark.read.parquet(path)
    return texts.agg(F.count(F.lit(1)).alias("texts"), F.countDistinct("word_id").alias("words")).crossJoin(F.broadcast(done.agg(F.count(F.lit(1)).alias("vectors"))))


@query()
def feature_importances(t):
    """The fifteen features that each town's classifier uses most."""
    words, dims = tagged_vectors(t)
    model, _ = learn.train_towns(t.kept(learn.samples(words, dims)))
    names = learn.feature_names(dims.count())
    return boost.importances(model.trees, names).select(F.col("model").cast("long").alias("town_id"), "dim", "importance")


#: Settings that the tuning compares: depth and rounds of `learn.QUICK`.
SETTINGS = {f"depth {d}, rounds {r}": learn.QUICK._replace(depth=d, rounds=r) for d in (2, 3) for r in (4, 8)}


@query()
def classifier_tuning(t):
    """The best setting of every town's classifier by cross-validation, and how it does when it is trained anew with it."""
    return learn.tuned(learn.samples(*tagged_vectors(t)), SETTINGS)
