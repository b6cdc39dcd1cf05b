"""Line deduplication by winnowing over line hashes.

A document is its sequence of lines that aren't blank, trimmed of blanks, tabs and carriage returns.
Of every WINDOW consecutive grams of GRAM lines, the one with the least hash (the last of equal ones)
is a fingerprint, so each run of WINDOW + GRAM - 1 lines holds one at a place that its lines alone
decide: two equal runs always share it.  A line of WORDS words or more is long enough to be a run by
itself, so it is a window, and its own fingerprint, too.  Fingerprints that occur once are dropped.
Each window around one of the others is joined with the first place of that fingerprint at which the
same window stands, and the match is extended both ways, line by line, as far as the two documents
agree.  The later ones of all runs, in the order of (doc_id, line), are deleted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import bound_batches, durable
from .textarrays import small_batches

GRAM, WINDOW = 1, 2
#: Words of a line that is a run by itself.
WORDS = 50
BLANKS = re.compile("[ \t]+")
SPANS = "array<struct<a: int, b: int>>"
SPANS_ARROW = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def hashed_lines(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """doc_id, body (hash of the text), lines (16 bytes for each line that isn't blank), heavy (a byte each: has `words` words) of documents with such lines."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, limit=1 << 20):
            rows, lines, heavy = [], [], []
            for row, text in enumerate(batch.column(2).to_pylist()):
                mine = [t for x in (text or "").split("\n") if (t := x.strip(" \t\r"))]
                if mine:
                    rows.append(row)
                    lines.append(b"".join(blake2b(t.encode("utf-8", "surrogatepass"), digest_size=16).digest() for t in mine))
                    heavy.append(bytes(len(t) >= 2 * words - 1 and len(BLANKS.split(t)) >= words for t in mine))
            of = batch.select([0, 1]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*of.columns, pa.array(lines, pa.binary()), pa.array(heavy, pa.binary())], ["doc_id", "body", "lines", "heavy"])

    bound_batches(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("body"), F.col(text_col).alias("text"))
    return slim.mapInArrow(cut, "doc_id long, body long, lines binary, heavy binary")


def windows_of(lined: DataFrame, gram: int, window: int) -> DataFrame:
    """Every window: doc_id, body, s (its first line), fp (its fingerprint), fresh (whether the window before has another fingerprint place), d1, d2 (its digest)."""
    run = window + gram - 1
    digest = lambda x: blake2b(x, digest_size=16).digest()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts, prints, news, digests = [], [], [], [], []
            for row, (raw, heavy) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                lines = [raw[i : i + 16] for i in range(0, len(raw), 16)]
                n, last = len(lines), -1
                # windows by themselves: their lengths keep them apart from others
                alone = [(s, digest(b"\1" + lines[s])) for s in range(n) if heavy[s]]
                if n < run:
                    alone.append((0, digest(b"\0" + bytes([n]) + raw)))
                for s, d in alone:
                    rows.append(row), starts.append(s), news.append(True), prints.append(d), digests.append(d)
                hashes = lines if gram == 1 else [digest(b"".join(lines[i : i + gram])) for i in range(n - gram + 1)]
                for s in range(n - run + 1):
                    least = min(hashes[s : s + window])
                    place = max(i for i in range(s, s + window) if hashes[i] == least)
                    rows.append(row), starts.append(s), news.append(place != last), prints.append(least)
                    digests.append(digest(b"".join(lines[s : s + run])))
                    last = place
            two = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            fp = np.frombuffer(b"".join(prints), np.int64).reshape(-1, 2)[:, 0]
            of = batch.select([0, 1]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([of.column(0), of.column(1), pa.array(starts, pa.int32()), pa.array(fp), pa.array(news, pa.bool_()), pa.array(two[:, 0]), pa.array(two[:, 1])], ["doc_id", "body", "s", "fp", "fresh", "d1", "d2"])

    return lined.mapInArrow(cut, "doc_id long, body long, s int, fp long, fresh boolean, d1 long, d2 long")


def extend(lines: bytes, others: bytes, shift: int, seeds: list[int]) -> list[tuple[int, int]]:
    """Runs [a, b) of a document's lines equal to the others `shift` places before, each the longest around a seed; a seed's window is equal."""
    mine, theirs = (np.frombuffer(x, np.int64).reshape(-1, 2) for x in (lines, others))
    lo, hi = max(0, shift), min(len(mine), len(theirs) + shift)
    same = np.concatenate([[False], (mine[lo:hi] == theirs[lo - shift : hi - shift]).all(1), [False]])
    flips = np.flatnonzero(same[1:] != same[:-1])
    begin, end = flips[::2] + lo, flips[1::2] + lo
    at = np.unique(np.searchsorted(begin, np.asarray(seeds), side="right") - 1)
    return list(zip(begin[at].tolist(), end[at].tolist(), strict=True))


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, window: int = WINDOW, words: int = WORDS) -> DataFrame:
    """doc_id, body (hash of the text), first_id, first_line and `spans`: the runs of lines that stand in first_id before, on one diagonal a row.

    A span [a, b) counts lines that aren't blank; its first line is line a - first_line of first_id.
    """
    lined = durable(hashed_lines(docs, id_col, text_col, words))
    windows = windows_of(lined, gram, window)
    # a table of its own, so that adaptive execution can split the join at fingerprints of many places
    repeated = durable(windows.where("fresh").groupBy("fp").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("fp"))
    places = durable(windows.join(repeated, "fp").select("fp", "d1", "d2", "doc_id", "body", "s"))
    first = durable(places.groupBy("fp", "d1", "d2").agg(F.min(F.struct("doc_id", "s", "body")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    later = places.join(first, ["fp", "d1", "d2"]).where(~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("s") == F.col("first.s"))))
    diagonals = durable(later.groupBy("doc_id", "body", F.col("first.doc_id").alias("first_id"), F.col("first.body").alias("first_body"), (F.col("s") - F.col("first.s")).alias("shift")).agg(F.collect_set("s").alias("seeds")))
    side = lambda a, b, c: lined.select(F.col("doc_id").alias(a), F.col("body").alias(b), F.col("lines").alias(c)).dropDuplicates([a, b])
    mine, theirs = side("id", "of", "lines"), side("id2", "of2", "others")
    both = diagonals.join(mine, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("body") == F.col("of"))).drop("id", "of")
    both = both.join(theirs, F.col("first_id").eqNullSafe(F.col("id2")) & (F.col("first_body") == F.col("of2")))

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [extend(*x) for x in zip(*(batch.column(i).to_pylist() for i in (4, 5, 3, 6)), strict=True)]
            spans = pa.array([[{"a": a, "b": b} for a, b in x] for x in found], SPANS_ARROW)
            yield pa.RecordBatch.from_arrays([*batch.select([0, 1, 2, 3]).columns, spans], ["doc_id", "body", "first_id", "first_line", "spans"])

    return both.select("doc_id", "body", "first_id", "shift", "lines", "others", "seeds").mapInArrow(grow, f"doc_id long, body long, first_id long, first_line int, spans {SPANS}")


def deduplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, window: int = WINDOW, words: int = WORDS) -> DataFrame:
    """One row per document: doc_id, text (what is left), n_lines (not blank), n_removed, n_runs (maximal removed runs).

    Blank lines stay.  A null text counts as empty and stays empty; a document of fewer than WINDOW +
    GRAM - 1 lines is one run, compared with others of that length alone (its long lines, with those of
    all documents).  Runs may overlap in a document: of four equal lines the first stays at WINDOW 2.
    Rows with equal doc_id count as one place, so none is deleted for another; a null doc_id comes
    first.  Texts of any length are read whole.  An empty table gives no rows.
    """

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            out: list[list] = [[], [], [], []]
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                lines = (text or "").split("\n")
                gone = {i for s in spans or () for i in range(s["a"], s["b"])}
                kept, n, removed, runs = [], 0, 0, 0
                for line in lines:
                    if line.strip(" \t\r"):
                        if n in gone:
                            removed += 1
                            runs += n - 1 not in gone
                        else:
                            kept.append(line)
                        n += 1
                    else:
                        kept.append(line)
                for column, value in zip(out, ("\n".join(kept), n, removed, runs), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out[0], pa.string()), *(pa.array(x, pa.int64()) for x in out[1:])], ["doc_id", "text", "n_lines", "n_removed", "n_runs"])

    found = repeated_runs(docs, id_col, text_col, gram, window, words)
    gone = found.groupBy(F.col("doc_id").alias("id"), "body").agg(F.flatten(F.collect_set("spans")).alias("spans"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("body_", F.xxhash64("text"))
    both = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("body_") == F.col("body")), "left").select("doc_id", "text", "spans")
    return both.mapInArrow(rest, "doc_id long, text string, n_lines long, n_removed long, n_runs long")


#: DuckDB SQL of the digest columns for GRAM 1, WINDOW 2 and WORDS 50 over a table {docs}.
SQL = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM {docs}),
x AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i FROM d),
y AS (SELECT doc_id, line, i, trim(line, ' ' || chr(9) || chr(13)) AS t FROM x),
n AS (SELECT doc_id, i, t, len(string_split_regex(t, '[ ' || chr(9) || ']+')) >= 50 AS heavy, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS o, count(*) OVER (PARTITION BY doc_id) AS c FROM y WHERE t <> ''),
w AS (SELECT doc_id, o, c, t, lead(t) OVER (PARTITION BY doc_id ORDER BY o) AS t2 FROM n),
k AS (SELECT doc_id, o, c, row_number() OVER (PARTITION BY c = 1, t, t2 ORDER BY doc_id, o) > 1 AS later FROM w WHERE t2 IS NOT NULL OR c = 1),
h AS (SELECT doc_id, o, row_number() OVER (PARTITION BY t ORDER BY doc_id, o) > 1 AS later FROM n WHERE heavy),
m AS (SELECT n.doc_id, n.i, n.o, coalesce(a.later, false) OR coalesce(b.later, false) OR coalesce(h.later, false) AS gone
      FROM n LEFT JOIN h ON h.doc_id = n.doc_id AND h.o = n.o LEFT JOIN k a ON a.doc_id = n.doc_id AND a.o = n.o LEFT JOIN k b ON b.doc_id = n.doc_id AND b.o = n.o - 1),
r AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY o), false) AS begins FROM m)
SELECT y.doc_id, count(r.o)::BIGINT AS n_lines, count(*) FILTER (r.gone)::BIGINT AS n_removed, count(*) FILTER (r.begins)::BIGINT AS n_runs,
       sha256(coalesce(string_agg(y.line, chr(10) ORDER BY y.i) FILTER (r.gone IS NULL OR NOT r.gone), '')) AS kept_sha256
FROM y LEFT JOIN r ON r.doc_id = y.doc_id AND r.i = y.i GROUP BY y.doc_id
"""
