"""Audit of how far the sources of a language differ from each other, and by which terms.

Each language keeps the terms that stand in enough of its documents.  A group (language, source) gives a
kept term with count c the share p(c) = 1 + floor(SCALE * (c + PRIOR) / (N + PRIOR * V)), V kept terms
and N of their occurrences in the group; so does the language as a whole.  The distance of two groups is the
sum of |p - q| over all V terms.  It isn't taken term by term, but by inclusion and exclusion over the
groups' supports (terms with c > 0):

    V terms as if both counts were zero                    V * |p(0) - q(0)|, a constant of the pair
    + a's support as if b had none of it, likewise b's     priced by a's histogram of shares, times b's q(0)
    + what both have                                       corrected by joining the postings of a term

so terms that neither has cost nothing, and terms that one has cost a row for each different count.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import bound_batches, durable
from .textarrays import flat

SCALE, PRIOR = 1_000_000_000, 5
#: Documents of its language that a term must stand in, and terms that a group's report names.
MIN_DOCUMENTS, TOP = 30, 50
#: Letters of ASCII, and all bytes beyond it.
TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
#: Terms that a task holds before it hands them on, and groups up to which their table is broadcast.
HELD, BROADCAST_GROUPS = 200_000, 10_000


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, term, occurrences, documents, pre-aggregated; each group has one row more, of the empty term."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def hand_on():
        rows = [(lang, source, term, n, documents[term]) for (lang, source), (counts, documents) in held.items() for term, n in [(b"", 0), *counts.items()]]
        columns = list(zip(*rows, strict=True))
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.int64())], ["lang", "source", "term", "n", "documents"])

    for batch in batches:
        data, at = flat(batch.column(2))
        for lang, source, lo, hi in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
            counts, documents = held.setdefault((lang, source), (Counter(), Counter()))
            terms = TERM.findall(data[lo:hi].tobytes().lower())  # bytes: lower() changes A to Z alone
            counts.update(terms)
            documents.update(set(terms))
            if sum(len(c) for c, _ in held.values()) >= HELD:
                yield hand_on()
    if held:
        yield hand_on()


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """A durable table of lang, source, term, n, documents; the empty term marks that a group occurs at all."""
    bound_batches(docs.sparkSession)
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(blank(lang_col).alias("lang"), blank(source_col).alias("source"), blank(text_col).alias("text"))
    each = rows.mapInArrow(_tally, "lang string, source string, term binary, n long, documents long")
    return durable(each.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(F.sum("n").alias("n"), F.sum("documents").alias("documents")))


def share(count: str, total: str, terms: str):
    """p of a count, in whole numbers; null where there are no terms at all."""
    wide = lambda x: f"cast({x} as decimal(20, 0))"
    return F.expr(f"1 + (({wide(count)} + {PRIOR}) * {SCALE}) div nullif({wide(total)} + {wide(terms)} * {PRIOR}, 0)")


def _ranked(rows: DataFrame, part: str, most: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    rows = rows.withColumn("rank", F.row_number().over(order))
    # under a bound Spark keeps each task's first rows of a group before they are shuffled
    return (rows.where(F.col("rank") <= most) if most else rows).select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_documents: int = MIN_DOCUMENTS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: parts 'pair' (other sources by distance) and 'term' (the first `top` terms by excess).

    A null text, language or source is ''.  A group without a kept term takes part with counts of 0; a
    language without kept terms has distances of 0 and no terms.  Equal values go by the item's bytes.
    Repeated rows are documents of their own; an empty table gives no rows; other columns aren't looked
    at.  Texts are read whole.  The pairs of a language are as many as its sources squared, which is the report's size.
    """
    counts = term_counts(docs, text_col, lang_col, source_col)
    terms = counts.where("term <> ''")
    kept = durable(terms.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("documents").alias("documents")).where(F.col("documents") >= min_documents).drop("documents"))
    postings = durable(terms.drop("documents").join(kept, ["lang", "term"]))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_n"))
    sizes = postings.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    groups = counts.where("term = ''").select("lang", "source").join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.na.fill(0, ["group_n", "v", "lang_n"])
    groups = durable(groups.withColumn("zero", F.coalesce(share("0", "group_n", "v"), F.lit(0))))
    small = F.broadcast if groups.count() <= BROADCAST_GROUPS else (lambda d: d)
    # a hot group's postings aren't gathered: a table of their own, its join with the groups can be split
    posted = durable(postings.join(small(groups), ["lang", "source"]).select("lang", "source", "term", share("n", "group_n", "v").alias("p"), share("total", "lang_n", "v").alias("q"), "zero"))

    other = groups.select("lang", F.col("source").alias("item"), F.col("zero").alias("other_zero"), "v")
    neither = groups.select("lang", "source", "zero").join(small(other), "lang").where("source <> item").select("lang", "source", "item", F.expr("v * abs(zero - other_zero)").alias("value"))
    histogram = durable(posted.groupBy("lang", "source", "zero", "p").agg(F.count(F.lit(1)).alias("m")))
    one_sided = histogram.join(small(other), "lang").where("source <> item").select("lang", "source", "item", F.expr("m * (abs(p - other_zero) - abs(zero - other_zero))").alias("value"))
    a, b = posted.select("lang", "term", "source", "p", "zero"), posted.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("r"), F.col("zero").alias("other_zero"))
    both = a.join(b, ["lang", "term"]).where("source < item").select("lang", "source", "item", F.expr("abs(p - r) - abs(p - other_zero) - abs(zero - r) + abs(zero - other_zero)").alias("value"))
    half = one_sided.unionByName(both).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    sides = F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))).alias("side")
    mirrored = half.select("lang", "value", sides).select("lang", "side.*", "value")
    pairs = neither.unionByName(mirrored).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    above = posted.where("p > q").select("lang", "source", F.col("term").alias("item"), F.expr("p - q").alias("value"))
    return _ranked(pairs, "pair").unionByName(_ranked(above, "term", top))


#: The audit term by term, over all groups and kept terms.
SQL = """
WITH tokens AS (
  SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM {docs})),
of_rows AS MATERIALIZED (SELECT row, lang, source, term, count(*) AS n FROM tokens GROUP BY ALL),
kept AS MATERIALIZED (SELECT lang, term, sum(n) AS total FROM of_rows GROUP BY ALL HAVING count(*) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(total) AS lang_n FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, sum(n) AS n FROM of_rows JOIN kept USING (lang, term) GROUP BY ALL),
groups AS MATERIALIZED (
  SELECT g.lang, g.source, coalesce(any_value(l.v), 0) AS v, any_value(l.lang_n) AS lang_n, coalesce(sum(c.n), 0) AS group_n
  FROM (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM {docs}) g
  LEFT JOIN langs l ON l.lang = g.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL),
shares AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + ((coalesce(c.n, 0) + 5) * 1000000000::HUGEINT) // (group_n + 5 * v)::HUGEINT AS p,
         1 + ((k.total + 5) * 1000000000::HUGEINT) // (lang_n + 5 * v)::HUGEINT AS q
  FROM groups g JOIN kept k ON k.lang = g.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY a.lang, a.source, b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE n > 0 AND p > q)
SELECT * FROM (
  SELECT lang, source, part, item, value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM found)
WHERE part = 'pair' OR rank <= 50"""
