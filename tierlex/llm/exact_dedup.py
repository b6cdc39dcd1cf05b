"""Exact deduplication with a split for heavy hitters.

Misra-Gries summaries find the digests that may be frequent, one exact count verifies them, and the
verified winners (at most `capacity` rows) are broadcast, so that rows of huge groups never meet in
one task.  All other digests take an ordinary shuffle; none of them holds more than
rows / (capacity + 1) rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import durable, fresh

#: Counters of a summary, and so the most rows that are broadcast.
CAPACITY = 1024
#: Tasks that merge the partitions' summaries before the last.
MERGERS = 32


def fold(counts: dict[bytes, int], digests, weights, capacity: int) -> dict[bytes, int]:
    """Add weighted digests to a Misra-Gries summary: keep `capacity` counters, less the next largest count."""
    for d, n in zip(digests, weights, strict=True):
        counts[d] = counts.get(d, 0) + n
    if len(counts) > capacity:
        least = sorted(counts.values(), reverse=True)[capacity]
        counts = {d: n - least for d, n in counts.items() if n > least}
    return counts


def _summaries(capacity: int):
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for batch in batches:
            digests = batch.column(0).to_pylist()
            weights = batch.column(1).to_pylist() if batch.num_columns > 1 else np.ones(len(digests), int).tolist()
            for i in range(0, len(digests), capacity):  # bounds the dictionary between cuts
                counts = fold(counts, digests[i : i + capacity], weights[i : i + capacity], capacity)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["digest", "weight"])

    return summarise


def frequent(digests: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Up to `capacity` (digest, weight) rows with every digest of more than rows / (capacity + 1) rows among them."""
    kind = "digest binary, weight long"
    each = digests.select("digest").mapInArrow(_summaries(capacity), kind)
    some = each.repartition(MERGERS).mapInArrow(_summaries(capacity), kind)
    return some.repartition(1).mapInArrow(_summaries(capacity), kind)


def heavy_winners(rows: DataFrame, capacity: int) -> DataFrame:
    """digest, keep_id, group_size of the verified heavy hitters, at most `capacity` rows; rows: doc_id, digest."""
    possible = frequent(rows, capacity).select("digest")
    return durable(rows.join(F.broadcast(possible), "digest").groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).where("group_size > 1"))


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are; a null text counts as empty.  The row with the largest
    doc_id of a group stays; a null doc_id is less than any other.  Of repeated rows (same doc_id and
    text) one stays.  An empty table gives no rows.  Other columns are not looked at.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = durable(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest")))
    winners = heavy_winners(rows, capacity)
    heavy = rows.join(F.broadcast(winners), "digest")
    top = heavy.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).withColumn("nth", F.row_number().over(Window.partitionBy("digest").orderBy("doc_id")))
    heavy = heavy.where(~F.col("doc_id").eqNullSafe(F.col("keep_id"))).withColumn("nth", F.lit(2)).unionByName(top)
    by = Window.partitionBy("digest")
    light = (
        rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
        .withColumn("nth", F.row_number().over(by.orderBy(F.col("doc_id").desc_nulls_last())))
        .withColumn("keep_id", F.max("doc_id").over(by))
        .withColumn("group_size", F.count(F.lit(1)).over(by))
    )
    return heavy.unionByName(light).select("doc_id", "keep_id", "group_size", (F.col("nth") == 1).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """The documents that stay, with all their columns; see `decisions`.

    Copies of heavy hitters go where they are read, against the broadcast winners; what is left is
    shuffled once, by digest, and each partition sends only its first row of a digest.  Rows with
    equal doc_id and text are told apart by their other columns' hash, so the same one stays every time.
    """
    id_, digest, nth, mark = (fresh(docs, f"_{x}") for x in ("id", "digest", "nth", "mark"))
    sha = F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    rows = durable(docs.select(F.col(id_col).cast("long").alias("doc_id"), sha.alias("digest")))
    winners = heavy_winners(rows, capacity).select(F.col("digest").alias(digest), F.col("keep_id").alias(id_))
    left = docs.withColumn(digest, sha).join(F.broadcast(winners.withColumn(mark, F.lit(True))), digest, "left")
    left = left.where(F.col(mark).isNull() | F.col(id_col).cast("long").eqNullSafe(F.col(id_)))
    others = F.xxhash64(*(F.col(c) for c in docs.columns if c not in (id_col, text_col)), F.lit(0))
    first = Window.partitionBy(digest).orderBy(F.col(id_col).cast("long").desc_nulls_last(), others)
    return left.withColumn(nth, F.row_number().over(first)).where(F.col(nth) == 1).select(*docs.columns)
