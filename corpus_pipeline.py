"""A corpus pipeline of five stages; each takes (spark, docs, sf_dir) and returns the documents it keeps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierlex.llm import decontamination, exact_dedup, jaccard_join, language_id, mixing
from tierlex.llm.shared import settled, tables_written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told go: null texts, texts without a letter, undecided ones.  Rows are judged one by one; an empty table learns nothing and gives no rows."""
    return language_id.accepted(docs, language_id.learn(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays; of rows equal in id and text one.  An empty table gives no rows."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that links of Jaccard similarity 0.8 on five-word grams tie together, the one with the least doc_id stays; see `one_of_each` for repeated ids and empty tables."""
    return jaccard_join.one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, edited or not, go; an empty table, or an empty benchmark, takes nothing away."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mixture, and how often each is in it; rows with equal id share the largest copies.  An empty table gives no rows."""
    return mixing.mixed(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
]

#: Language id, near copies and alignment are beyond SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's rows written before the next reads them; what they were made of is then deleted.

    An empty table gives no rows.  Of rows with equal id and text one stays; rows with equal id and other
    texts are documents of their own until the last stage, which gives them the same copies.
    """
    docs, since = spark.read.parquet(f"{sf_dir}/documents.parquet"), tables_written()
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = settled(docs, since)
    return docs
