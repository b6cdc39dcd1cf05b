"""Readers of the text formats that the model is built from; all lazy, all Spark's own readers."""

from __future__ import annotations

import io
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import category


def domain_tsv(spark: SparkSession, path: str) -> DataFrame:
    """synset and domain from lines `synset<TAB>domain domain ...`."""
    raw = spark.read.csv(path, sep="\t", schema="synset string, domains string", quote="")
    return raw.select("synset", F.explode(F.filter(F.split("domains", " "), lambda d: d != "")).alias("domain"))


def bridge(spark: SparkSession, path: str) -> DataFrame:
    """id, version, pos and zero-padded offset from lines `id ver:pos:offset,...`; lines beginning with # are comments."""
    lines = spark.read.text(path).where(~F.col("value").startswith("#") & (F.trim("value") != ""))
    parts = F.split("value", r"\s+", 2)
    each = lines.select(parts[0].alias("id"), F.explode(F.split(parts[1], ",")).alias("part"))
    fields = F.split(F.trim("part"), ":")
    return each.where(F.size(fields) == 3).select("id", fields[0].alias("version"), fields[1].alias("pos"), F.lpad(fields[2], 8, "0").alias("offset"))


def versions(bridged: DataFrame, old: str, new: str) -> DataFrame:
    """(old, new) keys `offset-pos` of ids that have both versions."""
    key = F.concat_ws("-", "offset", "pos")
    at = lambda v, name: F.max(F.when(F.col("version") == v, key)).alias(name)
    return bridged.groupBy("id").agg(at(old, "old"), at(new, "new")).where("old is not null and new is not null").select("old", "new")


def import_domains(domains: DataFrame, keys: DataFrame, lemmas: DataFrame, towns: DataFrame) -> DataFrame:
    """town and lemma: old synset to new synset to lemmas, and domain to town.  lemmas: synset, lemma; towns: domain, town."""
    moved = domains.join(keys.withColumnRenamed("old", "synset"), "synset").select(F.col("new").alias("synset"), "domain")
    return moved.join(lemmas, "synset").join(towns, "domain").select("town", F.translate("lemma", "_", " ").alias("word")).distinct()


def vocabulary_json(spark: SparkSession, path: str) -> DataFrame:
    """domain, word and confidence of files with core and peripheral word lists."""
    raw = spark.read.option("multiLine", True).json(path, schema="domain string, timestamp string, n_words int, core array<string>, peripheral array<string>, words array<string>")
    listed = lambda c: raw.select("domain", F.explode(c).alias("word"), F.lit(c).alias("confidence"))
    return listed("core").unionByName(listed("peripheral"))


METRICS = "precision double, recall double, f1 double, auc_pr double"


def _results(spark: SparkSession, path: str) -> DataFrame:
    one = METRICS.replace(" double", ": double")
    features = "array<struct<dim_id: int, importance: double, reef_name: string>>"
    return spark.read.option("multiLine", True).json(path, schema=f"domain string, metrics struct<{one}>, fold_metrics array<struct<{one}>>, n_positive int, n_negative int, n_folds int, top_features {features}")


def metrics_json(spark: SparkSession, path: str) -> DataFrame:
    """domain, fold and the fold's metrics of classifier result files."""
    return _results(spark, path).select("domain", F.posexplode("fold_metrics").alias("fold", "m")).select("domain", "fold", "m.*")


def summary_json(spark: SparkSession, path: str) -> DataFrame:
    """domain, its metrics over all folds, n_positive, n_negative and n_folds of the same files."""
    return _results(spark, path).select("domain", "metrics.*", "n_positive", "n_negative", "n_folds")


def features_json(spark: SparkSession, path: str) -> DataFrame:
    """domain, place, dim_id, importance and reef_name of each classifier's top features."""
    return _results(spark, path).select("domain", F.posexplode("top_features").alias("place", "f")).select("domain", "place", "f.*")


def mapping_json(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.explode(F.from_json("value", "map<string,string>")).alias("domain", "new_domain"))


def best_results(spark: SparkSession, path: str, k: int) -> DataFrame:
    """The k best lines of a sweep's log: most passes, then the widest margin."""
    return spark.read.json(path).orderBy(F.desc("passed"), F.desc("margin")).limit(k)


@F.pandas_udf(T.ArrayType(T.FloatType()))
def decode_blob(blobs: pd.Series) -> pd.Series:
    """Little-endian float32 values of a binary column."""
    return blobs.map(lambda b: None if b is None else np.frombuffer(b, "<f4").tolist())


def npy_batches(spark: SparkSession, path: str) -> DataFrame:
    """file, row and v of .npy files of float vectors, one row a vector; read whole by executors."""

    def read(batches):
        for table in batches:
            for file, content in zip(table["path"], table["content"], strict=True):
                rows = np.load(io.BytesIO(content)).astype(np.float64)
                yield pd.DataFrame({"file": [file.rsplit("/", 1)[-1]] * len(rows), "row": range(len(rows)), "v": list(rows)})

    files_ = spark.read.format("binaryFile").option("pathGlobFilter", "*.npy").load(path).select("path", "content")
    return files_.mapInPandas(read, "file string, row long, v array<double>")


def resume_index(batches: DataFrame) -> DataFrame:
    """One row: batches done, rows in them, and the number after the last batch, which is next.  Files are named batch_NNNNN.npy."""
    number = F.regexp_extract("file", r"batch_(\d+)\.npy$", 1).cast("int")
    return batches.agg(F.countDistinct("file").alias("batches"), F.count(F.lit(1)).alias("rows"), (F.coalesce(F.max(number), F.lit(-1)) + 1).alias("next"))


def lemma_words(senses: DataFrame) -> DataFrame:
    """word, pos (the most frequent, of equal ones the first of noun, verb, adj, adv), senses and category of each lemma, lower-cased, blanks for underscores.

    senses: lemma, pos, one row a sense; pos is n, v, a, s (an adjective) or r; others are left out.
    """
    pos = F.when(F.col("pos") == "n", 0).when(F.col("pos") == "v", 1).when(F.col("pos").isin("a", "s"), 2).when(F.col("pos") == "r", 3)
    n = senses.select(F.lower(F.translate("lemma", "_", " ")).alias("word"), pos.alias("at")).where("at is not null").groupBy("word", "at").agg(F.count(F.lit(1)).alias("n"))
    best = F.max_by("at", F.struct("n", -F.col("at")))
    label = F.element_at(F.array(*map(F.lit, ("noun", "verb", "adj", "adv"))), best + 1)
    return n.groupBy("word").agg(label.alias("pos"), F.sum("n").alias("senses")).withColumn("category", category(F.col("word")))


def listed_words(words: DataFrame, c: str = "word") -> DataFrame:
    """Distinct words without digits; of single letters only a and i."""
    return words.select(c).where(~F.col(c).rlike(r"\d") & ((F.length(c) != 1) | F.col(c).isin("a", "i"))).distinct()


def category_members(spark: SparkSession, path: str) -> DataFrame:
    """category and title from saved replies of a wiki's category query, one JSON object a line: a page of members, or several, has its category's name as `category`."""
    raw = spark.read.json(path, schema="category string, query struct<categorymembers: array<struct<title: string>>>")
    return raw.select("category", F.explode("query.categorymembers.title").alias("title")).select("category", F.regexp_replace("title", "^Category:", "").alias("title")).distinct()


#: Statuses of a domain whose categories were looked for, and what the report's headings say.
FOUND, NOT_FOUND, SKIPPED = "found", "not_found", "skipped"
NO_MATCH, TOPICS = "No Wikipedia Category Match", "Domain \u2192 Wikipedia Subcategories"


def failed_domains(spark: SparkSession, path: str) -> DataFrame:
    """domain and tried (the category that was looked for) from Markdown reports: bold items below a line that says NO_MATCH, up to the next heading.

    The category stands between back-quotes; an item without one tried its own name.
    """
    lines = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.posexplode(F.split("value", r"\r?\n")).alias("at", "line"))
    begins = F.contains("line", F.lit(NO_MATCH))
    ends = F.startswith("line", F.lit("##")) & ~F.contains("line", F.lit("No Wikipedia"))
    mark = F.when(begins, True).when(ends, False)
    inside = F.coalesce(F.last(mark, ignorenulls=True).over(Window.partitionBy("file").orderBy("at")), F.lit(False))
    item = lines.withColumn("inside", inside).where(F.col("inside") & ~begins & F.startswith("line", F.lit("- **")))
    name, quoted = F.get(F.split("line", r"\*\*"), F.lit(1)), F.get(F.split("line", "`"), F.lit(1))
    return item.select(name.alias("domain"), F.coalesce(quoted, name).alias("tried"))


def wiki_report(found: DataFrame) -> DataFrame:
    """place and line of the Markdown report: a summary, the domains without a match, those skipped, and every domain's categories with their children.

    found: domain, wiki_category, status, raw_count, subcats (array of name and children), whose size is the
    number that was left.  Places are texts in the lines' order: section, domain, and number within it.
    """
    size = F.coalesce(F.size("subcats"), F.lit(0))
    total = F.sum(F.aggregate(F.coalesce("subcats", F.array().cast(found.schema["subcats"].dataType)), F.lit(0).cast("long"), lambda n, s: n + 1 + F.size(s["children"])))
    counts = found.agg(F.count(F.lit(1)).alias("all"), *[F.count_if(F.col("status") == s).alias(s) for s in (FOUND, NOT_FOUND, SKIPPED)], F.coalesce(total, F.lit(0)).alias("total"))
    cell = lambda label, c: F.concat(F.lit(f"| {label} | "), F.col(c).cast("string"), F.lit(" |"))
    summary = F.array(F.lit("## Summary"), F.lit(""), F.lit("| Metric | Count |"), F.lit("|--------|-------|"), cell("Domains queried", "all"), cell("Wikipedia match found", FOUND), cell("No match found", NOT_FOUND), cell("Skipped (non-topical)", SKIPPED), cell("Total subcategories found", "total"), F.lit(""))

    def lines(df: DataFrame, section: int, domain, texts) -> DataFrame:
        each = df.select(domain.alias("domain"), F.posexplode(texts).alias("nth", "line"))
        return each.select(F.concat_ws("/", F.lit(str(section)), F.col("domain"), F.lpad(F.col("nth").cast("string"), 6, "0")).alias("place"), "line")

    none = F.lit("")
    some = lambda c: counts.where(F.col(c) > 0)
    heading = lambda text, c: F.concat(F.lit(f"## {text} ("), F.col(c).cast("string"), F.lit(")"))
    tried = F.concat(F.lit("- **"), "domain", F.lit("** (tried: `"), "wiki_category", F.lit("`)"))
    children = lambda s: F.concat(F.array(F.concat(F.lit("- **"), s["name"], F.lit("**"))), F.transform(s["children"], lambda c: F.concat(F.lit("  - "), c)))
    topics = F.flatten(F.transform("subcats", lambda s: F.when(F.size(s["children"]) > 0, children(s)).otherwise(F.array(F.concat(F.lit("- "), s["name"])))))
    head = F.array(F.concat(F.lit("### "), "domain"), F.concat(F.lit("**Wikipedia:** `Category:"), "wiki_category", F.lit("` \u2014 "), F.col("raw_count").cast("string"), F.lit(" raw \u2192 "), size.cast("string"), F.lit(" filtered subcategories")), F.lit(""))
    of = lambda status: found.where(F.col("status") == status)
    parts = [
        lines(counts, 0, none, summary),
        lines(some(NOT_FOUND), 1, none, F.array(heading(f"Domains With {NO_MATCH}", NOT_FOUND), none)), lines(of(NOT_FOUND), 2, F.col("domain"), F.array(tried)), lines(some(NOT_FOUND), 3, none, F.array(none)),
        lines(some(SKIPPED), 4, none, F.array(heading("Skipped Domains \u2014 Non-Topical", SKIPPED), none)), lines(of(SKIPPED), 5, F.col("domain"), F.array(F.concat(F.lit("- "), "domain"))), lines(some(SKIPPED), 6, none, F.array(none)),
        lines(counts, 7, none, F.array(F.lit(f"## {TOPICS}"), none)), lines(of(FOUND).where(size > 0), 8, F.col("domain"), F.concat(head, topics, F.array(none))),
    ]
    return reduce(DataFrame.unionByName, parts)


def write_report(lines: DataFrame, path: str) -> None:
    """The report's lines in order, as one text file in the folder: a page for one reader."""
    lines.coalesce(1).sortWithinPartitions("place").select("line").write.mode("overwrite").text(path)


def catalog_of(df: DataFrame) -> DataFrame:
    """position, name and type of the columns that a table has."""
    return df.sparkSession.createDataFrame([(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema)], "position int, name string, type string")


def not_done(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What a checkpoint table doesn't have yet."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def seeds_from_reply(rows: DataFrame) -> DataFrame:
    """town, word and confidence from replies that hold a JSON object of towns, in a code fence or not."""
    bare = F.regexp_replace(F.regexp_replace(F.trim("reply"), r"^```[a-z]*\s*", ""), r"\s*```$", "")
    parsed = rows.select(F.explode(F.from_json(bare, "map<string,struct<core:array<string>,peripheral:array<string>>>")).alias("town", "lists"))
    listed = lambda c: parsed.select("town", F.explode(f"lists.{c}").alias("word"), F.lit(c).alias("confidence"))
    return listed("core").unionByName(listed("peripheral"))


#: Patterns, in any case of letters, of names of categories that say nothing of a topic.
NOT_TOPICAL = (
    r"\bby (location|country|city|continent|region|state|province|territory|year|decade|century|period|month|date|gender|ethnicity|nationality|sport)\b",
    r"\bby country\b", r"\blists? of\b", r"\bhistory of\b", r"\bpeople in\b", r"\bpeople by\b", r"\bbiographers?\b", r"\borganizations?\b", r"\bassociations?\b",
    r"\bcompetitions?\b", r"\bevents?\b", r"\bawards?\b", r"\bmedia\b", r"\bjournalism\b", r"\bphotography of\b", r"\bfilms? (about|set)\b", r"\bfiction\b", r"\bnovels?\b",
    r"\btelevision\b", r"\bvideo games?\b", r"\bmuseums?\b", r"\beducation\b", r"\bstubs?\b", r"\btemplates?\b", r"\bwikiproject\b", r"\bwikipedia\b", r"\bcommons\b",
    r"\bcategories\b", r"\bnavboxes\b", r"\binfoboxes\b", r"\barticles\b", r"\bimages\b", r"\bworks about\b", r"\bdepictions\b", r"\bin popular culture\b", r"\bculture and\b",
    r"\band culture\b", r"\blaw and\b", r"\blegislation\b",
)
#: Patterns of names of categories worth following.
DRILL = (r"^branches of", r"^types of", r"^subfields of", r"^forms of", r"by type$", r"by discipline$", r"by genre$", r"by instrument$", r"by style$", r"by medium$")


def topical(names: DataFrame, c: str = "name") -> DataFrame:
    """Names that no pattern excludes; drill: whether to follow them."""
    any_of = lambda patterns: F.col(c).rlike("(?i)" + "|".join(patterns))
    return names.where(~any_of(NOT_TOPICAL)).withColumn("drill", any_of(DRILL))
