"""The model's relations realised on the driver's tables.

archipelago: region; island: nation (a bucket where its key modulo 8 is 7); town: supplier; reef: the
parts of one type at a supplier; word: part.  A word is a member of a reef if an order line of at least
`quantity` of it came from that supplier.  A word counts as two words where the part's size is divisible by 4.  Sums are kept as integers until one division, so results
don't depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import scratch

QUANTITY = 45
#: Lines that one task makes predictions of, about, and the least number of such tasks.
TASK_LINES, LEAST_TASKS = 1_000_000, 16


class Tables:
    """The driver's tables under one folder, and the relations made of them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name.endswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def kept(self, df: DataFrame) -> DataFrame:
        """The rows as a table in the shared folder; what a query reads several times is made once."""
        return scratch.kept(df)

    @property
    def archipelagos(self) -> DataFrame:
        return self.region.select(F.col("r_regionkey").alias("arch_id"), F.col("r_name").alias("arch"))

    @property
    def islands(self) -> DataFrame:
        return self.nation.select(F.col("n_nationkey").alias("island_id"), F.col("n_name").alias("island"), F.col("n_regionkey").alias("arch_id"), (F.col("n_nationkey") % 8 == 7).cast("int").alias("is_bucket"))

    @property
    def towns(self) -> DataFrame:
        return self.supplier.select(F.col("s_suppkey").alias("town_id"), F.col("s_name").alias("town"), F.col("s_nationkey").alias("island_id"))

    @property
    def words(self) -> DataFrame:
        brand = F.regexp_extract("p_brand", "([0-9]+)$", 1).cast("int")
        pos = F.element_at(F.array(*map(F.lit, ("noun", "verb", "adj", "adv"))), brand % 4 + 1)
        return self.part.select(F.col("p_partkey").alias("word_id"), F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("word"), pos.alias("pos"), "p_type", "p_size", F.when(F.col("p_size") % 4 == 0, 2).otherwise(1).alias("word_count"))

    def reef_words(self, quantity: int = QUANTITY) -> DataFrame:
        """The fact table: one row per reef and word."""
        cents = lambda c: F.round(F.col(c) * 100).cast("long")
        lines = self.lineitem.where(F.col("l_quantity") >= quantity)
        types = self.part.select(F.col("p_partkey").alias("l_partkey"), "p_type")
        some = lambda c, v: F.max((F.col(c) == v).cast("int"))
        sums = lines.groupBy("l_suppkey", "l_partkey").agg(F.count(F.lit(1)).alias("n"), F.sum(cents("l_discount")).alias("d"), F.sum(cents("l_tax")).alias("t"), some("l_returnflag", "N").alias("curated"), some("l_linestatus", "O").alias("open"))
        out = sums.join(types, "l_partkey").join(self.towns.withColumnRenamed("town_id", "l_suppkey"), "l_suppkey").join(self.islands, "island_id")
        n = F.col("n").cast("double")
        return out.select(
            "arch_id", "island_id", "is_bucket", F.col("l_suppkey").alias("town_id"), F.concat_ws("/", F.col("l_suppkey").cast("string"), "p_type").alias("reef_id"), F.col("l_partkey").alias("word_id"),
            (F.lit(1.0) - F.col("d") / (n * 100)).alias("cosine_sim"), (F.col("t") / (n * 10)).alias("island_cos"), (F.col("t") / (n * 20)).alias("town_cos"), (F.lit(1.0) - F.col("t") / (n * 10)).alias("reef_cos"),
            F.when(F.col("curated") == 1, "curated").otherwise("xgboost").alias("source"), F.greatest("curated", "open").alias("is_core"),
        )

    @property
    def predictions(self) -> DataFrame:
        """Predicted members of towns with a score in 0 to 1.

        Most pairs of town and word have a line or two, so lines are dealt out by pairs first, by so many to a task
        that the tasks' tables of pairs don't grow with the input.
        """
        lines = self.lineitem.select("l_suppkey", "l_partkey", "l_discount")
        lines = lines.repartition(max(LEAST_TASKS, -(-lines.count() // TASK_LINES)), "l_suppkey", "l_partkey")
        return lines.groupBy(F.col("l_suppkey").alias("town_id"), F.col("l_partkey").alias("word_id")).agg((F.max(F.round(F.col("l_discount") * 100).cast("long")) / F.lit(10.0)).alias("score"))

    @property
    def tokens(self) -> DataFrame:
        """doc_id, lang, source and each run of letters of the lower-cased text."""
        return self.documents.select("doc_id", "lang", "source", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("(\\p{L}+)"), 1)).alias("token"))

    @property
    def vectors(self) -> DataFrame:
        """Words with embeddings: town is the label, island the label modulo 3; labels 0, 1 and 2 are capitals."""
        return self.embeddings.select("vec_id", F.col("label").alias("town_id"), (F.col("label") % 3).alias("island_id"), (F.col("label") < 3).cast("int").alias("is_capital"), F.transform("embedding", lambda x: x.cast("double")).alias("v"))


_LINES = "SELECT l_suppkey AS town_id, l_partkey AS word_id, count(*)::DOUBLE AS n, sum(round(l_discount*100)::BIGINT)::DOUBLE AS d, sum(round(l_tax*100)::BIGINT)::DOUBLE AS t, max((l_returnflag='N')::INT) AS curated, max((l_linestatus='O')::INT) AS open FROM lineitem WHERE l_quantity >= {q} GROUP BY ALL"


def fact_sql(q: int = QUANTITY) -> str:
    """DuckDB common table expressions of the same relations: rw, w, isl, tow, pred."""
    return f"""
l0 AS ({_LINES.format(q=q)}),
isl AS (SELECT n_nationkey AS island_id, n_name AS island, n_regionkey AS arch_id, (n_nationkey % 8 = 7)::INT AS is_bucket FROM nation),
tow AS (SELECT s_suppkey AS town_id, s_name AS town, s_nationkey AS island_id FROM supplier),
w AS (SELECT p_partkey AS word_id, p_name || ' ' || p_partkey AS word, ['noun','verb','adj','adv'][regexp_extract(p_brand, '([0-9]+)$', 1)::INT % 4 + 1] AS pos, p_type, p_size, CASE WHEN p_size % 4 = 0 THEN 2 ELSE 1 END AS word_count FROM part),
rw AS MATERIALIZED (SELECT arch_id, island_id, is_bucket, town_id, town_id || '/' || p_type AS reef_id, word_id, 1::DOUBLE - d/(n*100) AS cosine_sim, t/(n*10) AS island_cos, t/(n*20) AS town_cos, 1::DOUBLE - t/(n*10) AS reef_cos,
       CASE WHEN curated = 1 THEN 'curated' ELSE 'xgboost' END AS source, greatest(curated, open) AS is_core
       FROM l0 JOIN w USING (word_id) JOIN tow USING (town_id) JOIN isl USING (island_id)),
pred AS (SELECT l_suppkey AS town_id, l_partkey AS word_id, max(round(l_discount*100)::BIGINT) / 10::DOUBLE AS score FROM lineitem GROUP BY ALL)"""


TOKENS_SQL = "tok AS (SELECT doc_id, lang, source, unnest(regexp_extract_all(lower(text), '(\\p{L}+)', 1)) AS token FROM documents)"
VECTORS_SQL = "vec AS (SELECT vec_id, label AS town_id, label % 3 AS island_id, (label < 3)::INT AS is_capital, embedding::DOUBLE[] AS v FROM embeddings)"
