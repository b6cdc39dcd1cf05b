"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are runs of letters, digits and bytes above 127, ASCII in lower case.  Grams of SEED words join the
documents' passages to the test items.  Documents are read once: a place whose gram may be an item's, by a
table of SLOTS hash slots that says how far the longest such item reaches, is kept with the words around
it, and nothing else is.  The grams kept are joined with the items' grams, whatever their numbers; the
places where an item would begin are collected by passage and item; and around each of them the item is
aligned locally with the passage.  The score over the item's length says how much of it was copied, edits
included.  A gram is rare if at most a share RARE of the documents hold it; where a passage shares only
commoner grams with an item, which leaked copies bring about themselves, the alignment is left out only
if the words in common can't reach the least score.  So rarity decides the work, never the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import bound_batches, durable, ship
from .textarrays import U64, Words, flat, grams, small_batches

SEED = 3
#: Greatest share of documents that hold a rare gram.
RARE = 1e-3
MATCH, MISMATCH, GAP = 1.0, -0.5, -0.5
#: Least score over item length of a contaminated document.
LEAST = 0.5
#: Bits of a slot's number; the table that is broadcast has 2 ** SLOTS entries of two bytes at most.
SLOTS = 22
#: A reach this long takes the whole document.
FAR = (1 << 16) - 1

PLAIN = np.full(256, 32, np.uint8)
for _c in [*range(48, 58), *range(97, 123), *range(128, 256)]:
    PLAIN[_c] = _c
for _c in range(65, 91):
    PLAIN[_c] = _c + 32


def words_of(column: pa.Array) -> Words:
    data, at = flat(column)
    return Words(PLAIN[data], at, lower=False)


def member(sorted_: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Place of each value in a sorted array, or -1."""
    if not len(sorted_):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)
    return np.where(sorted_[at] == values, at, -1)


def align(item: np.ndarray, text: np.ndarray) -> tuple[float, int, int]:
    """Score of the best local alignment with linear gap costs, and the words of the text that it spans."""
    best, end = _forward(item, text)
    if best <= 0:
        return 0.0, 0, 0
    _, back = _forward(item[::-1], text[: end + 1][::-1], best)
    return best, end - back, end + 1


def _forward(item: np.ndarray, text: np.ndarray, stop: float = np.inf) -> tuple[float, int]:
    h = np.zeros(len(text) + 1)
    slope = -GAP * np.arange(len(text) + 1)
    best, end = 0.0, 0
    for word in item:
        new = np.maximum(h + GAP, 0)
        np.maximum(new[1:], h[:-1] + np.where(text == word, MATCH, MISMATCH), out=new[1:])
        h = np.maximum.accumulate(new + slope) - slope
        top = int(h.argmax())
        if h[top] > best + 1e-9:
            best, end = float(h[top]), top - 1
            if best >= stop - 1e-9:
                break
    return best, end


def common(words: np.ndarray, counts: np.ndarray, text: np.ndarray) -> int:
    """Number of an item's words, sorted and counted, that a text holds, repeats included; no alignment scores more."""
    at = member(words, text)
    return int(np.minimum(counts, np.bincount(at[at >= 0], minlength=len(words))).sum())


def best_alignment(item: np.ndarray, text: np.ndarray, begins: list[int], rare: bool, least: float) -> tuple[float, int, int]:
    """Score over the item's length and span of the best alignment around places where the item would begin; 0 if all are below `least`.

    An alignment that reaches `least` >= 0.5 and holds the gram spans at most an item's length more on either side.
    """
    n = len(item)
    words, counts = np.unique(item, return_counts=True)
    regions: list[list[int]] = []
    for b in sorted(set(begins)):
        if regions and b - n <= regions[-1][1]:
            regions[-1][1] = b + 2 * n
        else:
            regions.append([b - n, b + 2 * n])
    top = (0.0, 0, 0)
    for a, b in regions:
        a, b = max(a, 0), min(b, len(text))
        if not rare and MATCH * common(words, counts, text[a:b]) < least * MATCH * n:
            continue
        score, s, e = align(item, text[a:b])
        if score > top[0]:
            top = score, a + s, a + e
    return (top[0] / (MATCH * n), top[1], top[2]) if top[0] >= least * MATCH * n else (0.0, 0, 0)


def item_tables(bench: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(item_id, mark, words) of each item, and (item_id, mark, gram, place, n) of its grams; mark tells apart texts with one id."""
    rows = bench.where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("item_id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text"))
    rows = rows.dropDuplicates(["item_id", "mark"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            w = words_of(batch.column(2))
            keep = [i for i in range(batch.num_rows) if w.first[i + 1] - w.first[i] >= SEED]
            of = batch.select([0, 1]).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*of.columns, pa.array([w.hash[w.first[i] : w.first[i + 1]].tobytes() for i in keep], pa.binary())], ["item_id", "mark", "words"])

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, raw in enumerate(batch.column(2).to_pylist()):
                h = np.frombuffer(raw, U64)
                g = grams(h, SEED)
                of = batch.select([0, 1]).take(pa.array(np.full(len(g), row)))
                yield pa.RecordBatch.from_arrays([*of.columns, pa.array(g.view(np.int64)), pa.array(np.arange(len(g), dtype=np.int32)), pa.array(np.full(len(g), len(h), np.int32))], ["item_id", "mark", "gram", "place", "n"])

    items = durable(rows.mapInArrow(cut, "item_id long, mark long, words binary"))
    return items, durable(items.mapInArrow(explode, "item_id long, mark long, gram long, place int, n int"))


def passages(docs: DataFrame, reach: np.ndarray) -> DataFrame:
    """doc_id, body, doc (number of the row), start, words, grams, places of each passage around grams that may be items'.  docs: doc_id, body, text.

    reach: by slot of a gram, how many words before and after it belong to the passage; 0 for none.
    """
    shared = ship(docs.sparkSession, (np.flatnonzero(reach), reach[reach > 0]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, values = shared()
        reach = np.zeros(1 << SLOTS, np.int64)
        reach[slots] = values
        number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        for batch in small_batches(batches):
            w = words_of(batch.column(2))
            out: list[list] = [[] for _ in range(6)]
            if len(w.hash) >= SEED:
                g = grams(w.hash, SEED)
                r = reach[(g >> U64(64 - SLOTS)).astype(np.int64)]
                near = np.flatnonzero(r)
                near = near[w.doc[near] == w.doc[near + SEED - 1]]
                doc, r = w.doc[near], np.where(r[near] >= FAR, len(w.hash), r[near])
                lo, hi = np.maximum(near - r, w.first[doc]), np.minimum(near + SEED + r, w.first[doc + 1])
                order = np.lexsort((lo, doc))
                begin, upto = lo[order], np.maximum.accumulate(hi[order])  # documents follow each other
                new = np.flatnonzero(np.append(True, (begin[1:] >= upto[:-1]) | (doc[order][1:] != doc[order][:-1]))) if len(near) else np.zeros(0, int)
                bounds = [*new.tolist(), len(near)]
                for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                    k = np.sort(near[order[a:b]])
                    row, s, e = int(doc[order[a]]), int(begin[a]), int(upto[b - 1])
                    for column, value in zip(out, (row, number + row, s - int(w.first[row]), w.hash[s:e].tobytes(), g[k].view(np.int64), (k - s).astype(np.int32)), strict=True):
                        column.append(value)
            number += batch.num_rows
            of = batch.select([0, 1]).take(pa.array(out[0], pa.int64()))
            yield pa.RecordBatch.from_arrays([*of.columns, pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.binary()), pa.array(out[4], pa.list_(pa.int64())), pa.array(out[5], pa.list_(pa.int32()))], ["doc_id", "body", "doc", "start", "words", "grams", "places"])

    return docs.mapInArrow(scan, "doc_id long, body long, doc long, start long, words binary, grams array<long>, places array<int>")


def _found(docs: DataFrame, bench: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str, least: float, rare: float) -> DataFrame:
    """doc_id, body, doc, item_id, mark, score, start_word, end_word, n_seeds; one row per document's row and item."""
    spark = docs.sparkSession
    bound_batches(spark)
    items, item_grams = item_tables(bench, item_col, item_text)
    slot = F.shiftrightunsigned("gram", 64 - SLOTS)
    longest = item_grams.groupBy(slot.alias("slot")).agg(F.max("n").alias("n")).toArrow()  # at most 2 ** SLOTS rows
    reach = np.zeros(1 << SLOTS, np.int64)
    reach[longest["slot"].to_numpy().astype(np.int64)] = np.minimum(2 * longest["n"].to_numpy().astype(np.int64), FAR)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("body"), F.col(text_col).alias("text"))
    held = durable(passages(slim, reach))  # a table, as rows' numbers depend on the tasks
    each = held.select("doc", "start", F.explode(F.arrays_zip("grams", "places")).alias("x")).select("doc", "start", F.col("x.grams").alias("gram"), F.col("x.places").alias("at"))
    often = each.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).join(item_grams.select("gram").distinct(), "gram", "left_semi")
    seeds = item_grams.join(often.crossJoin(F.broadcast(docs.agg(F.count(F.lit(1)).alias("docs")))), "gram").withColumn("rare", F.col("df") <= F.greatest(F.lit(1.0), F.col("docs") * rare))  # one row
    pairs = each.join(seeds.select("gram", "item_id", "mark", "place", "rare"), "gram").groupBy("doc", "start", "item_id", "mark").agg(F.collect_set(F.col("at") - F.col("place")).alias("begins"), F.max("rare").alias("rare"))
    rows = pairs.join(held.select("doc", "start", "doc_id", "body", "words"), ["doc", "start"]).join(items.withColumnRenamed("words", "item"), ["item_id", "mark"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {c: batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("item", "words", "begins", "rare", "start")}
            out: list[tuple] = []
            for i, (item, text, begins, sure, start) in enumerate(zip(*columns.values(), strict=True)):
                score, s, e = best_alignment(np.frombuffer(item, U64), np.frombuffer(text, U64), begins, sure, least)
                if score:
                    out.append((i, score, start + s, start + e, len(begins)))
            cols = list(zip(*out, strict=True)) if out else [[]] * 5
            of = batch.select(["doc_id", "body", "doc", "item_id", "mark"]).take(pa.array(cols[0], pa.int64()))
            yield pa.RecordBatch.from_arrays([*of.columns, pa.array(cols[1], pa.float64()), *(pa.array(c, pa.int64()) for c in cols[2:])], [*of.schema.names, "score", "start_word", "end_word", "n_seeds"])

    key = ["doc_id", "body", "doc", "item_id", "mark"]
    aligned = rows.select(*key, "start", "words", "item", "begins", "rare").mapInArrow(run, "doc_id long, body long, doc long, item_id long, mark long, score double, start_word long, end_word long, n_seeds long")
    best = F.max_by(F.struct("score", "start_word", "end_word"), F.struct("score", -F.col("start_word"))).alias("b")
    return aligned.groupBy(*key).agg(best, F.sum("n_seeds").alias("n_seeds")).select(*key, "b.*", "n_seeds")


def contaminated(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", least: float = LEAST, rare: float = RARE) -> DataFrame:
    """One row per document and item that it holds: doc_id, item_id, score, start_word, end_word, n_seeds.

    score: alignment score over the item's length, `least` (0.5 at the least) to 1, of the best alignment
    near a shared gram.  The span counts the document's words; n_seeds, the places at which shared
    grams would have the item begin, in passages that reach `least`.  Null or empty texts match nothing,
    nor do items of fewer than SEED words, or with a null id.  Items with equal texts are all reported,
    a repeated item row once; repeated documents are all reported.  Texts of any length are read whole.
    Empty tables give no rows.
    """
    return _found(docs, bench, id_col, text_col, item_col, item_text, least, rare).select("doc_id", "item_id", "score", "start_word", "end_word", "n_seeds")


def clean(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", least: float = LEAST, rare: float = RARE) -> DataFrame:
    """The documents, all columns, that hold no item; see `contaminated`.  Rows with equal id and text go or stay together."""
    found = _found(docs, bench, id_col, text_col, item_col, item_text, least, rare).select(F.col("doc_id").alias("_held_id"), F.col("body").alias("_held_body")).distinct()
    body = F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    return docs.join(durable(found), docs[id_col].cast("long").eqNullSafe(F.col("_held_id")) & (body == F.col("_held_body")), "left_anti")
