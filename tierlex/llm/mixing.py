"""Mixing sources to target weights, in DataFrame operations only.

A tree of domain, language and source carries weights.  The budget flows from the root: siblings share
it by weight, and what a child can't use (it holds at most `epochs` times its tokens) goes to its
siblings by weight before an ancestor is asked; a parent's own bound is the sum of its children's.  A
leaf takes whole epochs and then a prefix of the next, whose order is a seeded hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import durable, fresh

#: Leaves up to this number are broadcast; more are joined by a shuffle.
BROADCAST_LEAVES = 10_000
#: Characters of a hash that make a bucket: a leaf's order is cut into 16 ** 3 pieces of nearly equal size.
CUT = 3
LEVELS = ("domain", "lang", "source")
#: Production weights by level and value; 1 for others.
WEIGHTS = {"domain": {"web": 4, "books": 3, "forum": 2, "code": 1}, "lang": {"en": 5, "de": 2, "fr": 2, "es": 1}, "source": {}}
EPOCHS = 3
SEED = 17
#: Budget as a share of all tokens, in thousandths.
BUDGET_MILLI = 800


def words(text_col: str):
    """Number of maximal runs of characters other than blank, tab, line feed, carriage return and form feed."""
    bare = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), "^[ \t\n\r\f]+|[ \t\n\r\f]+$", "")
    return F.when(bare == "", F.lit(0).cast("long")).otherwise(F.size(F.split(bare, "[ \t\n\r\f]+")).cast("long"))


def domain_of(source_col: str):
    """Domain of a source: its trailing number modulo 4; web where it has none."""
    number = F.coalesce(F.expr(f"try_cast(regexp_extract(`{source_col}`, '([0-9]{{1,9}})$', 1) as int)"), F.lit(0))
    return F.element_at(F.array(*map(F.lit, ("web", "books", "forum", "code"))), F.pmod(number, F.lit(4)).cast("int") + 1)


def _weight(level: str, weights: dict[str, dict[str, int]]):
    out = F.lit(1)
    for value, w in weights.get(level, {}).items():
        out = F.when(F.col(level) == value, F.lit(int(w))).otherwise(out)
    return out.cast("long")


def _share(children: DataFrame, parent: list[str], level: str) -> DataFrame:
    """Budget of each child: columns cap, weight and given (the parent's) are there; adds `budget`.

    Children by rising cap / weight: the first ones are full as long as cap * (weight of this and all
    later ones) <= weight * (given - caps of the earlier ones); the others share the rest by weight,
    rounded down.  A weight of 0 gives nothing.
    """
    kids = children.withColumn("cap", F.when(F.col("weight") > 0, F.col("cap")).otherwise(0)).withColumn("weight", F.greatest("weight", F.lit(1)))
    order = Window.partitionBy(*parent).orderBy(F.col("cap") / F.col("weight"), level)
    whole, earlier = Window.partitionBy(*parent), order.rowsBetween(Window.unboundedPreceding, -1)
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    kids = kids.withColumn("c0", F.coalesce(F.sum("cap").over(earlier), F.lit(0)).cast("long")).withColumn("w1", F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    kids = kids.withColumn("full", (wide("cap") * wide("w1") <= wide("weight") * (F.col("given") - F.col("c0")).cast("decimal(19,0)")).cast("int"))
    kids = kids.withColumn("full", F.min("full").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    kids = kids.withColumn("cf", F.coalesce(F.sum(F.when(F.col("full") == 1, F.col("cap"))).over(whole), F.lit(0)))
    kids = kids.withColumn("wf", F.sum(F.when(F.col("full") == 0, F.col("weight"))).over(whole))
    part = F.expr("(cast(weight as decimal(19,0)) * cast(given - cf as decimal(19,0))) div wf")
    return kids.withColumn("budget", F.when(F.col("full") == 1, F.col("cap")).otherwise(part).cast("long")).drop("c0", "w1", "full", "cf", "wf", "given", "weight", "cap")


def leaf_budgets(leaves: DataFrame, weights: dict[str, dict[str, int]], epochs: int, budget: int | None, budget_milli: int) -> DataFrame:
    """domain, lang, source, tokens, leaf_budget from one row of tokens per leaf."""
    tree = leaves.withColumn("cap", F.col("tokens") * epochs)
    total = F.floor(F.sum("tokens") * budget_milli / 1000) if budget is None else F.lit(budget)
    given = tree.agg(F.coalesce(F.least(total.cast("long"), F.sum("cap")), F.lit(0)).alias("given"))
    parent: list[str] = []
    for level in LEVELS:
        kids = tree.groupBy(*parent, level).agg(F.sum("cap").alias("cap")).withColumn("weight", _weight(level, weights))
        kids = kids.join(given, parent) if parent else kids.crossJoin(given)  # one row: the root
        parent = [*parent, level]
        given = _share(kids, parent[:-1], level).withColumnRenamed("budget", "given").select(*parent, "given")
    return tree.join(given, list(LEVELS)).select(*LEVELS, "tokens", F.col("given").alias("leaf_budget"))


def mix(
    docs: DataFrame,
    weights: dict[str, dict[str, int]] = WEIGHTS,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    budget: int | None = None,
    budget_milli: int = BUDGET_MILLI,
    epochs: int = EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: doc_id, domain, lang, source, n_tokens, leaf_budget, copies.

    copies: how many of the leaf's epochs hold the document.  The prefix of the last, partial epoch is
    the longest whose tokens fit, in the order of md5(seed:epoch:doc_id), doc_id, n_tokens.  A null lang
    or source is the value ''; a null text has no tokens, and a document without tokens costs nothing;
    leaves without tokens have copies 0.  Repeated rows count as documents of their own.  An empty
    table gives no rows.  Budget beyond epochs times all tokens stays unspent, and so do less than one
    token per node lost to rounding, and what the next document of a prefix would overrun.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), blank(lang_col).alias("lang"), blank(source_col).alias("source"), words(text_col).alias("n_tokens"))
    rows = durable(rows.select("doc_id", domain_of("source").alias("domain"), "lang", "source", "n_tokens"))
    leaves = durable(rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens")))
    small = F.broadcast if leaves.count() <= BROADCAST_LEAVES else (lambda d: d)
    plan = durable(leaf_budgets(leaves, weights, epochs, budget, budget_milli).withColumn("whole", F.when(F.col("tokens") > 0, F.expr("leaf_budget div tokens")).otherwise(0)).withColumn("rest", F.col("leaf_budget") - F.col("whole") * F.col("tokens")))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = rows.join(small(plan), list(LEVELS)).withColumn("key", key).withColumn("bucket", F.substring("key", 1, CUT))
    # the bucket in which each leaf's prefix ends, and the tokens before it
    upto = Window.partitionBy(*LEVELS).orderBy("bucket")
    sums = rows.groupBy(*LEVELS, "bucket").agg(F.sum("n_tokens").alias("n"), F.first("rest").alias("rest")).withColumn("upto", F.sum("n").over(upto))
    cut = durable(sums.where("upto > rest").groupBy(*LEVELS).agg(F.min("bucket").alias("cut"), F.min(F.col("upto")).alias("upto"), F.min_by("n", "bucket").alias("n")).select(*LEVELS, "cut", (F.col("upto") - F.col("n")).alias("before")))
    rows = rows.join(small(cut), list(LEVELS), "left")
    within = Window.partitionBy(*LEVELS, "bucket").orderBy("key", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = rows.where("bucket = cut").withColumn("upto", F.col("before") + F.sum("n_tokens").over(within)).withColumn("extra", (F.col("upto") <= F.col("rest")).cast("long")).drop("upto")
    outside = rows.where("cut is null or bucket <> cut").withColumn("extra", F.coalesce((F.col("bucket") < F.col("cut")).cast("long"), F.lit(0).cast("long")))
    return inside.unionByName(outside).select("doc_id", *LEVELS, "n_tokens", "leaf_budget", (F.col("whole") + F.col("extra")).alias("copies"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents that the mixture holds, all columns, and `copies`, how often; see `mix`.

    Documents with equal doc_id share the largest copies among them.
    """
    id_col = options.get("id_col", "doc_id")
    id_, copies = fresh(docs, "_id"), fresh(docs, "copies")
    chosen = mix(docs, **options).where("copies > 0").groupBy(F.col("doc_id").alias(id_)).agg(F.max("copies").alias(copies))
    return docs.join(chosen, F.col(id_col).cast("long").eqNullSafe(F.col(id_))).drop(id_)


#: DuckDB SQL of the whole of `mix` with production parameters over a table {docs} of documents.
SQL = """
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_replace(coalesce(text, ''), '^[ \\t\\n\\r\\f]+|[ \\t\\n\\r\\f]+$', '', 'g') AS bare
  FROM {docs}),
r AS (
  SELECT doc_id, lang, source,
         ['web', 'books', 'forum', 'code'][coalesce(try_cast(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS INT), 0) % 4 + 1] AS domain,
         CASE WHEN bare = '' THEN 0 ELSE len(string_split_regex(bare, '[ \\t\\n\\r\\f]+')) END::BIGINT AS n_tokens
  FROM d),
leaf AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens, sum(n_tokens)::HUGEINT * 3 AS cap FROM r GROUP BY ALL),
l0 AS (SELECT least(sum(tokens) * 800 // 1000, sum(cap))::HUGEINT AS given FROM leaf),
k1 AS (SELECT domain, sum(cap)::HUGEINT AS cap, CASE domain WHEN 'web' THEN 4 WHEN 'books' THEN 3 WHEN 'forum' THEN 2 WHEN 'code' THEN 1 ELSE 1 END::HUGEINT AS weight, any_value(given) AS given FROM leaf, l0 GROUP BY domain),
a1 AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight::DOUBLE, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c0, sum(weight) OVER (ORDER BY cap::DOUBLE / weight::DOUBLE, domain ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w1 FROM k1),
b1 AS (SELECT *, min((cap * w1 <= weight * (given - c0))::INT) OVER (ORDER BY cap::DOUBLE / weight::DOUBLE, domain ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f FROM a1),
g1 AS (SELECT domain, CASE WHEN f = 1 THEN cap ELSE weight * (given - coalesce(sum(cap) FILTER (f = 1) OVER (), 0))::HUGEINT // (sum(weight) FILTER (f = 0) OVER ())::HUGEINT END AS given FROM b1),
k2 AS (SELECT domain, lang, sum(cap)::HUGEINT AS cap, CASE lang WHEN 'en' THEN 5 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 WHEN 'es' THEN 1 ELSE 1 END::HUGEINT AS weight, any_value(given) AS given FROM leaf JOIN g1 USING (domain) GROUP BY domain, lang),
a2 AS (SELECT *, coalesce(sum(cap) OVER (PARTITION BY domain ORDER BY cap::DOUBLE / weight::DOUBLE, lang ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c0, sum(weight) OVER (PARTITION BY domain ORDER BY cap::DOUBLE / weight::DOUBLE, lang ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w1 FROM k2),
b2 AS (SELECT *, min((cap * w1 <= weight * (given - c0))::INT) OVER (PARTITION BY domain ORDER BY cap::DOUBLE / weight::DOUBLE, lang ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f FROM a2),
g2 AS (SELECT domain, lang, CASE WHEN f = 1 THEN cap ELSE weight * (given - coalesce(sum(cap) FILTER (f = 1) OVER (PARTITION BY domain), 0))::HUGEINT // (sum(weight) FILTER (f = 0) OVER (PARTITION BY domain))::HUGEINT END AS given FROM b2),
k3 AS (SELECT domain, lang, source, tokens, cap, 1::HUGEINT AS weight, given FROM leaf JOIN g2 USING (domain, lang)),
a3 AS (SELECT *, coalesce(sum(cap) OVER (PARTITION BY domain, lang ORDER BY cap::DOUBLE / weight::DOUBLE, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c0, sum(weight) OVER (PARTITION BY domain, lang ORDER BY cap::DOUBLE / weight::DOUBLE, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w1 FROM k3),
b3 AS (SELECT *, min((cap * w1 <= weight * (given - c0))::INT) OVER (PARTITION BY domain, lang ORDER BY cap::DOUBLE / weight::DOUBLE, source ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f FROM a3),
g3 AS (SELECT domain, lang, source, tokens, CASE WHEN f = 1 THEN cap ELSE weight * (given - coalesce(sum(cap) FILTER (f = 1) OVER (PARTITION BY domain, lang), 0))::HUGEINT // (sum(weight) FILTER (f = 0) OVER (PARTITION BY domain, lang))::HUGEINT END AS leaf_budget FROM b3),
p AS (SELECT *, CASE WHEN tokens > 0 THEN leaf_budget // tokens ELSE 0 END AS whole FROM g3),
o AS (SELECT doc_id, domain, lang, source, n_tokens, leaf_budget::BIGINT AS leaf_budget, whole, leaf_budget - whole * tokens AS rest, tokens,
      sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('17:' || whole || ':' || coalesce(doc_id::VARCHAR, '')), doc_id NULLS FIRST, n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
      FROM r JOIN p USING (domain, lang, source))
SELECT doc_id, domain, lang, source, n_tokens, leaf_budget, (whole + CASE WHEN tokens > 0 AND upto <= rest THEN 1 ELSE 0 END)::BIGINT AS copies FROM o
"""
