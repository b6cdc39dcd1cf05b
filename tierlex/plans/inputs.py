"""Queries over files: each writes the model's text formats from the tables and reads them back."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import files, scratch, sinks
from .catalog import query


def _text(t, lines: DataFrame) -> str:
    """Folder of text files with the lines."""
    path = scratch.new_path(t.spark, "text")
    lines.toDF("value").write.text(path)
    return path


def _synsets(t) -> str:
    domains = F.concat_ws(" ", "p_name", F.lower("p_type"))
    return _text(t, t.part.select(F.concat(F.lpad(F.col("p_partkey").cast("string"), 8, "0"), F.lit("-n\t"), domains)))


_DOM = "SELECT lpad(p_partkey::VARCHAR, 8, '0') || '-n' AS synset, unnest(string_split(p_name || ' ' || lower(p_type), ' ')) AS domain FROM part"


@query(_DOM)
def domain_tsv(t):
    return files.domain_tsv(t.spark, _synsets(t))


def _bridge(t) -> DataFrame:
    """Bridge lines of parts: two versions, the second left out for a third of them, and comments."""
    key = F.col("p_partkey").cast("string")
    new = F.when(F.col("p_size") % 3 != 0, F.concat(F.lit(",wn30:n:"), (F.col("p_partkey") + 1000).cast("string"))).otherwise("")
    line = F.when(F.col("p_size") == 7, F.concat(F.lit("# "), "p_name")).otherwise(F.concat(F.lit("X"), key, F.lit(" wn20:n:"), key, new))
    return files.bridge(t.spark, _text(t, t.part.select(line)))


@query("SELECT lpad(p_partkey::VARCHAR, 8, '0') || '-n' AS old, lpad((p_partkey + 1000)::VARCHAR, 8, '0') || '-n' AS new FROM part WHERE p_size % 3 <> 0 AND p_size <> 7")
def version_bridge(t):
    return files.versions(_bridge(t), "wn20", "wn30")


@query(f"""WITH d AS ({_DOM}), k AS (SELECT lpad(p_partkey::VARCHAR, 8, '0') || '-n' AS synset, lpad((p_partkey + 1000)::VARCHAR, 8, '0') || '-n' AS new FROM part WHERE p_size % 3 <> 0 AND p_size <> 7),
l AS (SELECT lpad((p_partkey + 500)::VARCHAR, 8, '0') || '-n' AS new, p_name AS word FROM part), w AS (SELECT DISTINCT p_type AS town, lower(p_type) AS domain FROM part)
SELECT DISTINCT town, word FROM d JOIN k USING (synset) JOIN l USING (new) JOIN w USING (domain)""")
def imported_domains(t):
    """Seeds of towns over the bridge: old synset to new one to lemmas, and domain to town."""
    lemmas = t.part.select(F.concat(F.lpad((F.col("p_partkey") + 500).cast("string"), 8, "0"), F.lit("-n")).alias("synset"), F.translate("p_name", " ", "_").alias("lemma"))
    towns = t.part.select(F.lower("p_type").alias("domain"), F.col("p_type").alias("town")).distinct()
    return files.import_domains(files.domain_tsv(t.spark, _synsets(t)), files.versions(_bridge(t), "wn20", "wn30"), lemmas, F.broadcast(towns))


def _whole(t, rows: DataFrame) -> str:
    """One JSON document with all rows; they are a tier of the hierarchy."""
    return _text(t, rows.agg(F.to_json(F.collect_list(F.struct("*"))).alias("value")))


@query("SELECT r_name AS domain, n_name AS word, CASE WHEN n_nationkey % 2 = 0 THEN 'core' ELSE 'peripheral' END AS confidence FROM region JOIN nation ON n_regionkey = r_regionkey")
def vocabulary_json(t):
    kept = lambda odd, name: F.collect_list(F.when(F.col("n_nationkey") % 2 == odd, F.col("n_name"))).alias(name)
    rows = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).groupBy(F.col("r_name").alias("domain")).agg(kept(0, "core"), kept(1, "peripheral"), F.count(F.lit(1)).alias("n_words"))
    return files.vocabulary_json(t.spark, _whole(t, rows))


def _results(t) -> str:
    """Results of a classifier for each nation, with as many folds as its key modulo 4 says."""
    k = F.col("n_nationkey")
    metrics = lambda d: F.struct((k / (30.0 + d)).alias("precision"), (k / (31.0 + d)).alias("recall"), (k / (32.0 + d)).alias("f1"), (k / (33.0 + d)).alias("auc_pr"))
    features = F.array(F.struct(k.cast("int").alias("dim_id"), (k / 50.0).alias("importance"), F.col("n_name").alias("reef_name")))
    folds = F.slice(F.array(*map(metrics, (1, 2, 3))), 1, (k % 4).cast("int"))
    return _whole(t, t.nation.select(F.col("n_name").alias("domain"), metrics(0).alias("metrics"), folds.alias("fold_metrics"), k.alias("n_positive"), (k * 5).alias("n_negative"), (k % 4).alias("n_folds"), features.alias("top_features")))


@query("SELECT n_name AS domain, f AS fold, n_nationkey / (31::DOUBLE + f) AS precision, n_nationkey / (32::DOUBLE + f) AS recall, n_nationkey / (33::DOUBLE + f) AS f1, n_nationkey / (34::DOUBLE + f) AS auc_pr FROM nation, (SELECT unnest([0, 1, 2]) AS f) WHERE f < n_nationkey % 4")
def metrics_json(t):
    return files.metrics_json(t.spark, _results(t))


@query("SELECT n_name AS domain, n_nationkey / 30::DOUBLE AS precision, n_nationkey / 31::DOUBLE AS recall, n_nationkey / 32::DOUBLE AS f1, n_nationkey / 33::DOUBLE AS auc_pr, n_nationkey AS n_positive, n_nationkey * 5 AS n_negative, n_nationkey % 4 AS n_folds FROM nation")
def summary_json(t):
    return files.summary_json(t.spark, _results(t))


@query("SELECT n_name AS domain, 0 AS place, n_nationkey AS dim_id, n_nationkey / 50::DOUBLE AS importance, n_name AS reef_name FROM nation")
def features_json(t):
    return files.features_json(t.spark, _results(t))


@query("SELECT n_name AS domain, r_name AS new_domain FROM nation JOIN region ON n_regionkey = r_regionkey")
def mapping_json(t):
    rows = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return files.mapping_json(t.spark, _text(t, rows.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("n_name", "r_name")))).alias("value"))))


@query("SELECT o_orderkey % 60 AS passed, o_orderkey / 7 AS margin FROM orders ORDER BY passed DESC, margin DESC LIMIT 20")
def best_results(t):
    """The best lines of a sweep's log, to which lines are appended twice."""
    path = scratch.new_path(t.spark, "log")
    rows = t.orders.select((F.col("o_orderkey") % 60).alias("passed"), (F.col("o_orderkey") / 7.0).alias("margin"))
    for part in (0, 1):
        sinks.append_jsonl(rows.where(F.col("passed") % 2 == part), path)
    return files.best_results(t.spark, path, 20).select("passed", "margin")


@F.pandas_udf(T.BinaryType())
def _blob(vectors: pd.Series) -> pd.Series:
    return vectors.map(lambda v: np.asarray(v, "<f4").tobytes())


@query("SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS i, unnest(embedding)::DOUBLE AS x FROM embeddings")
def decoded_blobs(t):
    path = scratch.new_path(t.spark, "blobs")
    t.embeddings.select("vec_id", _blob("embedding").alias("blob")).write.parquet(path)
    rows = t.spark.read.parquet(path).select("vec_id", files.decode_blob("blob").alias("v"))
    return rows.select("vec_id", F.posexplode("v").alias("i", "x")).select("vec_id", "i", F.col("x").cast("double").alias("x"))


@query("SELECT r_name AS town, n_name AS word, CASE WHEN n_nationkey % 3 = 0 THEN 'core' ELSE 'peripheral' END AS confidence FROM region JOIN nation ON n_regionkey = r_regionkey")
def reply_seeds(t):
    """Seeds from replies that hold JSON, in a code fence for every second region."""
    kept = lambda when, name: F.collect_list(F.when(when, F.col("n_name"))).alias(name)
    rows = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_regionkey", "r_name").agg(kept(F.col("n_nationkey") % 3 == 0, "core"), kept(F.col("n_nationkey") % 3 != 0, "peripheral"))
    body = F.to_json(F.create_map("r_name", F.struct("core", "peripheral")))
    return files.seeds_from_reply(rows.select(F.when(F.col("r_regionkey") % 2 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).otherwise(body).alias("reply")))


#: A name for each pattern of categories, and some that none excludes.
_NAMES = ("Art by country", "Wars by date", "List of ships", "History of art", "People in law", "People by job", "Biographer", "Organizations", "Association", "Competitions", "Event", "Awards", "Media", "Journalism", "Photography of birds", "Films about dogs", "Fiction", "Novel", "Television", "Video game", "Museum", "Education", "Bird stubs", "Template", "WikiProject art", "Wikipedia", "Commons", "Categories", "Navboxes", "Infoboxes", "Articles", "Images", "Works about art", "Depictions", "Art in popular culture", "Culture and art", "Art and culture", "Law and art", "Legislation", "Branches of art", "Types of art", "Subfields of art", "Forms of art", "Art by type", "Art by discipline", "Art by genre", "Art by instrument", "Art by style", "Art by medium", "Painting", "Mediaeval art", "Eventful art", "Art by typeface")
_ANY = lambda patterns: "(?i)" + "|".join(patterns)


@query(f"WITH n AS (SELECT p_partkey AS id, {list(_NAMES)}[p_partkey % {len(_NAMES)} + 1] || CASE WHEN p_size % 2 = 0 THEN '' ELSE ' ' || p_name END AS name FROM part) SELECT id, name, regexp_matches(name, '{_ANY(files.DRILL)}') AS drill FROM n WHERE NOT regexp_matches(name, '{_ANY(files.NOT_TOPICAL)}')")
def topical_categories(t):
    """Categories that stay, and whether they are followed; half of the names have a part's name after them."""
    name = F.concat(F.element_at(F.array(*map(F.lit, _NAMES)), (F.col("p_partkey") % len(_NAMES) + 1).cast("int")), F.when(F.col("p_size") % 2 == 0, "").otherwise(F.concat(F.lit(" "), "p_name")))
    return files.topical(t.part.select(F.col("p_partkey").alias("id"), name.alias("name")))


_SENSES = "SELECT CASE p_size % 3 WHEN 0 THEN p_name WHEN 1 THEN replace(p_name, ' ', '_') ELSE string_split(p_name, ' ')[1] || '_up' END AS lemma, ['n', 'v', 'a', 's', 'r', 'x'][regexp_extract(p_brand, '([0-9]+)$', 1)::INT % 6 + 1] AS pos FROM part"


@query(f"""WITH s AS ({_SENSES}), n AS (SELECT lower(replace(lemma, '_', ' ')) AS word, CASE pos WHEN 'n' THEN 0 WHEN 'v' THEN 1 WHEN 'a' THEN 2 WHEN 's' THEN 2 WHEN 'r' THEN 3 END AS k, count(*) AS n FROM s WHERE pos <> 'x' GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY n DESC, k) AS nth, sum(n) OVER (PARTITION BY word) AS senses FROM n)
SELECT word, ['noun', 'verb', 'adj', 'adv'][k + 1] AS pos, senses::BIGINT AS senses, CASE WHEN NOT contains(word, ' ') THEN 'single' WHEN word LIKE '% up' THEN 'phrasal_verb' ELSE 'compound' END AS category FROM r WHERE nth = 1""")
def lemma_words(t):
    size = F.col("p_size") % 3
    lemma = F.when(size == 0, F.col("p_name")).when(size == 1, F.translate("p_name", " ", "_")).otherwise(F.concat(F.split("p_name", " ")[0], F.lit("_up")))
    pos = F.element_at(F.array(*map(F.lit, "nvasrx")), F.regexp_extract("p_brand", "([0-9]+)$", 1).cast("int") % 6 + 1)
    return files.lemma_words(t.part.select(lemma.alias("lemma"), pos.alias("pos")))


@query("WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '([a-z0-9]+)', 1)) AS word FROM documents) SELECT word FROM w WHERE NOT regexp_matches(word, '[0-9]') AND (length(word) <> 1 OR word IN ('a', 'i'))")
def listed_words(t):
    return files.listed_words(t.documents.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("([a-z0-9]+)"), 1)).alias("word")))


@query("SELECT DISTINCT p_type AS category, p_name AS title FROM part")
def category_members(t):
    """Members of categories from saved pages of replies, several a category."""
    members = F.collect_list(F.struct(F.concat(F.lit("Category:"), "p_name").alias("title")))
    pages = t.part.groupBy(F.col("p_type").alias("category"), (F.col("p_partkey") % 3).alias("page")).agg(F.struct(members.alias("categorymembers")).alias("query"))
    return files.category_members(t.spark, _text(t, pages.select(F.to_json(F.struct("category", "query")))))


def _explored(t):
    """Parts' types as domains, their brands as subcategories and the sizes of large parts as children of those; some types have no match, some are skipped."""
    named = t.part.select(F.regexp_replace("p_type", " ", "_").alias("domain"), F.initcap("p_type").alias("wiki_category"), "p_brand", "p_size", "p_partkey")
    subs = named.groupBy("domain", "p_brand").agg(F.array_sort(F.collect_set(F.when(F.col("p_size") > 40, F.concat(F.lit("size "), "p_size")))).alias("children"), F.count(F.lit(1)).alias("n"), F.min("p_partkey").alias("least"), F.first("wiki_category").alias("wiki_category"))
    found = subs.groupBy("domain", "wiki_category").agg(F.array_sort(F.collect_list(F.struct(F.col("p_brand").alias("name"), "children"))).alias("subcats"), F.sum("n").alias("raw_count"), F.min("least").alias("least"))
    status = F.when(F.col("least") % 5 == 0, files.NOT_FOUND).when(F.col("least") % 5 == 1, files.SKIPPED).otherwise(files.FOUND)
    out = found.withColumn("status", status)
    return out.withColumn("subcats", F.when(F.col("status") == files.FOUND, F.col("subcats"))).drop("least")


_EXPLORED = """
WITH su AS (SELECT replace(p_type, ' ', '_') AS domain, p_type, p_brand AS name, list_sort(list(DISTINCT 'size ' || p_size) FILTER (p_size > 40)) AS children, count(*) AS n, min(p_partkey) AS least FROM part GROUP BY ALL),
ex AS (SELECT domain, array_to_string(list_transform(string_split(p_type, ' '), lambda x: upper(x[1]) || lower(x[2:])), ' ') AS wiki_category, sum(n)::BIGINT AS raw_count, count(*) AS filtered, sum(1 + coalesce(len(children), 0))::BIGINT AS total,
       CASE min(least) % 5 WHEN 0 THEN 'not_found' WHEN 1 THEN 'skipped' ELSE 'found' END AS status,
       string_agg(CASE WHEN coalesce(len(children), 0) > 0 THEN '- **' || name || '**' || chr(10) || '  - ' || array_to_string(children, chr(10) || '  - ') ELSE '- ' || name END, chr(10) ORDER BY name) AS topics FROM su GROUP BY domain, p_type)"""


@query(f"""{_EXPLORED}, pieces AS (
SELECT 0 AS section, '' AS domain, '## Summary' || chr(10) || chr(10) || '| Metric | Count |' || chr(10) || '|--------|-------|' || chr(10) || '| Domains queried | ' || count(*) || ' |' || chr(10) || '| Wikipedia match found | ' || count(*) FILTER (status = 'found') || ' |' || chr(10) || '| No match found | ' || count(*) FILTER (status = 'not_found') || ' |' || chr(10) || '| Skipped (non-topical) | ' || count(*) FILTER (status = 'skipped') || ' |' || chr(10) || '| Total subcategories found | ' || coalesce(sum(total) FILTER (status = 'found'), 0) || ' |' || chr(10) AS text FROM ex
UNION ALL SELECT 1, '', '## Domains With No Wikipedia Category Match (' || count(*) || ')' || chr(10) FROM ex WHERE status = 'not_found' HAVING count(*) > 0
UNION ALL SELECT 2, domain, '- **' || domain || '** (tried: `' || wiki_category || '`)' FROM ex WHERE status = 'not_found'
UNION ALL SELECT 3, '', '' FROM ex WHERE status = 'not_found' HAVING count(*) > 0
UNION ALL SELECT 4, '', '## Skipped Domains — Non-Topical (' || count(*) || ')' || chr(10) FROM ex WHERE status = 'skipped' HAVING count(*) > 0
UNION ALL SELECT 5, domain, '- ' || domain FROM ex WHERE status = 'skipped'
UNION ALL SELECT 6, '', '' FROM ex WHERE status = 'skipped' HAVING count(*) > 0
UNION ALL SELECT 7, '', '## Domain → Wikipedia Subcategories' || chr(10)
UNION ALL SELECT 8, domain, '### ' || domain || chr(10) || '**Wikipedia:** `Category:' || wiki_category || '` — ' || raw_count || ' raw → ' || filtered || ' filtered subcategories' || chr(10) || chr(10) || topics || chr(10) FROM ex WHERE status = 'found'),
ln AS (SELECT section, domain, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS nth FROM pieces)
SELECT section || '/' || domain || '/' || lpad(nth::VARCHAR, 6, '0') AS place, line FROM ln""")
def wiki_report(t):
    """The Markdown report of all domains, by line."""
    return files.wiki_report(_explored(t))


@query(f"{_EXPLORED} SELECT domain, wiki_category AS tried FROM ex WHERE status = 'not_found'")
def failed_domains(t):
    """The domains without a match, as a retry reads them from the report that was written."""
    path = scratch.new_path(t.spark, "report")
    files.write_report(files.wiki_report(_explored(t)), path)
    return files.failed_domains(t.spark, path)


@query("SELECT column_name AS name FROM (DESCRIBE lineitem)")
def table_columns(t):
    return files.catalog_of(t.lineitem).select("name")


@query("SELECT n_name AS island, r_name AS arch FROM nation JOIN region ON n_regionkey = r_regionkey")
def tree_xml(t):
    """The XML tree of archipelagos and islands, read back."""
    rows = t.islands.join(t.archipelagos, "arch_id").select("arch", "island")
    path = scratch.new_path(t.spark, "xml")
    sinks.write_tree_xml(t.spark, rows, path, "tree.xml", "arch", "island")
    raw = t.spark.read.format("xml").option("rowTag", "arch").schema("_name string, island array<struct<_name: string>>").load(path)
    return raw.select(F.col("_name").alias("arch"), F.explode("island._name").alias("island"))


@query("SELECT town_id, count(*) AS n FROM (SELECT s_suppkey AS town_id FROM supplier UNION ALL SELECT s_suppkey FROM supplier WHERE s_suppkey % 2 = 0) GROUP BY ALL")
def replaced_partitions(t):
    """Rows of towns, of which the even ones are replaced, twice, by two rows each."""
    path = scratch.new_path(t.spark, "towns")
    towns = t.supplier.select((F.col("s_suppkey") % 2).alias("part"), F.col("s_suppkey").alias("town_id"))
    sinks.replace_partitions(towns, path, "part")
    for _ in range(2):
        sinks.replace_partitions(towns.where("part = 0").unionByName(towns.where("part = 0")), path, "part")
    return t.spark.read.parquet(path).groupBy("town_id").agg(F.count(F.lit(1)).alias("n"))


@query("WITH o AS (SELECT p_type, p_brand, min(p_partkey) AS p_partkey FROM part WHERE p_size <= 5 GROUP BY ALL), n AS (SELECT p_type, p_brand, min(p_partkey) AS p_partkey FROM part WHERE p_size > 5 GROUP BY ALL) SELECT * FROM o UNION ALL SELECT * FROM n WHERE NOT EXISTS (FROM o WHERE o.p_type = n.p_type AND o.p_brand = n.p_brand)")
def ignored_inserts(t):
    """Types and brands of small parts, and those of the others that are new, with the first part of each."""
    rows = t.part.select("p_type", "p_brand", "p_partkey", "p_size")
    old = rows.where("p_size <= 5").groupBy("p_type", "p_brand").agg(F.min("p_partkey").alias("p_partkey"))
    return sinks.insert_or_ignore(old, rows.where("p_size > 5").drop("p_size"), ["p_type", "p_brand"])


@query("SELECT i, count(*) AS n, round(sum(x), 6) AS x FROM (SELECT unnest(range(0, 64)) AS i, unnest(embedding::DOUBLE[]) AS x FROM embeddings) GROUP BY i")
def npy_vectors(t):
    """Sums of the vectors' dimensions, as .npy batches of them give them back."""
    path = scratch.new_path(t.spark, "npy")
    sinks.write_npy_batches(t.embeddings.select(F.col("embedding").alias("v")), path).write.format("noop").mode("overwrite").save()
    return files.npy_batches(t.spark, path).select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("x"), 6).alias("x"))
