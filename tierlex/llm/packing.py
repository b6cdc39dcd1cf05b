"""Packing documents into sequences by best-fit decreasing over a histogram of lengths.

Documents are cut into full windows and a rest.  Pieces of equal length are alike, so the plan needs only
how many there are of each length, whatever the number of documents: lengths go from long to short, and
a segment tree indexed by remaining capacity finds the tightest open window that a length fits.  As many
windows are open as the tokens fill (and a few to spare); a piece that fits none is cut, its first part filling
the widest window.  What doesn't fill a window goes to windows of powers of two, which need no padding.

The plan's rows are runs: the first, second, ... piece of a length goes to the first, second, ... window
of a run.  Pieces are numbered within their length by counts of the tasks that made them, and each finds
its place by its number.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytepairs import Encoder, load
from .shared import bound_batches, durable, ship
from .textarrays import small_batches

SIZE, END = 1024, 0
#: Windows to spare, in thousandths of the full ones: the more, the fewer pieces are cut and the more is padded.
SPARE_MILLI = 1
#: Numbers of pieces by task and length up to which they are broadcast.
BROADCAST_COUNTS = 500_000


class Capacities:
    """A segment tree over remaining capacities 1 to size: which ones have open windows, the nearest from either side."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.some = [False] * (2 * self.leaves)
        self.runs: list[list[tuple[int, int, int]]] = [[] for _ in range(size + 1)]  # first window, windows, their size

    def _mark(self, capacity: int) -> None:
        i = capacity + self.leaves
        self.some[i] = bool(self.runs[capacity])
        while i > 1:
            i //= 2
            self.some[i] = self.some[2 * i] or self.some[2 * i + 1]

    def put(self, capacity: int, first: int, windows: int, size: int) -> None:
        if capacity and windows:
            self.runs[capacity].append((first, windows, size))
            self._mark(capacity)

    def take(self, capacity: int) -> tuple[int, int, int]:
        run = self.runs[capacity].pop()
        self._mark(capacity)
        return run

    def _down(self, i: int, side: int) -> int:
        while i < self.leaves:
            i = 2 * i + side if self.some[2 * i + side] else 2 * i + 1 - side
        return i - self.leaves

    def tightest(self, least: int) -> int:
        """The least capacity of `least` or more with an open window; 0 if there is none."""
        i = least + self.leaves
        if self.some[i]:
            return least
        while i > 1:
            if i % 2 == 0 and self.some[i + 1]:
                return self._down(i + 1, 0)
            i //= 2
        return 0

    def widest(self) -> int:
        return self._down(1, 1) if self.some[1] else 0


class Run(NamedTuple):
    """Pieces first, first + 1, ... of a length: from `shift` on, `take` identifiers of each go to windows window, window + 1, ... at offset."""

    length: int
    first: int
    count: int
    shift: int
    take: int
    window: int
    offset: int


def best_fit(histogram: dict[int, int], size: int = SIZE, spare_milli: int = SPARE_MILLI) -> list[Run]:
    """The plan for histogram[length] pieces of each length of 1 to size."""
    total = sum(length * n for length, n in histogram.items())
    full, rest = divmod(total, size)
    windows = Capacities(size)
    windows.put(size, 0, full + full * spare_milli // 1000, size)
    number = full + full * spare_milli // 1000
    for bit in range(size.bit_length()):
        if rest >> bit & 1:
            windows.put(1 << bit, number, 1, 1 << bit)
            number += 1
    items: list[list[tuple[int, int, int, int]]] = [[] for _ in range(size + 1)]  # by length: the whole piece's length, first, count, shift
    for length, n in histogram.items():
        items[length].append((length, 0, n, 0))
    plan: list[Run] = []
    for take in range(size, 0, -1):
        while items[take]:
            length, first, count, shift = items[take].pop()
            capacity = windows.tightest(take)
            if capacity:  # a window takes as many as fit before the next one is looked at
                window, open_, whole = windows.take(capacity)
                layers = capacity // take
                used = min(open_, count // layers) or 1
                layers = min(layers, count // used)
                windows.put(capacity, window + used, open_ - used, whole)
                for layer in range(layers):
                    plan.append(Run(length, first + layer * used, used, shift, take, window, whole - capacity + layer * take))
                windows.put(capacity - layers * take, window, used, whole)
                done = layers * used
            else:
                capacity = windows.widest()
                window, open_, whole = windows.take(capacity)
                done = min(open_, count)
                windows.put(capacity, window + done, open_ - done, whole)
                plan.append(Run(length, first, done, shift, capacity, window, whole - capacity))
                items[take - capacity].append((length, first, done, shift + capacity))
            if done < count:
                items[take].append((length, first + done, count - done, shift))
    return plan


def by_number(plan: list[Run]) -> dict[int, tuple[np.ndarray, list[list[Run]]]]:
    """Of each length the numbers at which its pieces' runs change, and the runs from there on."""
    out: dict[int, tuple[np.ndarray, list[list[Run]]]] = {}
    of: dict[int, list[Run]] = {}
    for r in plan:
        of.setdefault(r.length, []).append(r)
    for length, runs in of.items():
        edges = np.unique([x for r in runs for x in (r.first, r.first + r.count)])
        parts: list[list[Run]] = [[] for _ in edges]
        for r in sorted(runs, key=lambda r: r.shift):
            for i in range(np.searchsorted(edges, r.first), np.searchsorted(edges, r.first + r.count)):
                parts[i].append(r)
        out[length] = edges, parts
    return out


def pieces(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, end: int = END) -> DataFrame:
    """A durable table of doc_id, start, length, doc_tokens, ids, task, nth: full windows and rests; nth counts a task's pieces of a length."""
    spark = docs.sparkSession
    bound_batches(spark)
    sent = ship(spark, load(vocabulary_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, seen = Encoder(*sent()), TaskContext.get().partitionId(), [0] * (size + 1)
        for batch in small_batches(batches, limit=1 << 20):
            rows: list[tuple] = []
            for doc, ids in zip(batch.column(0).to_pylist(), encoder.many(batch.column(1)), strict=True):
                n, raw = len(ids) + 1, np.append(ids, end).astype("<u4").tobytes()
                for start in range(0, n, size):
                    length = min(size, n - start)
                    rows.append((doc, start, length, n, raw[4 * start : 4 * (start + length)], task, seen[length]))
                    seen[length] += 1
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.int64())
            names = ["doc_id", "start", "length", "doc_tokens", "ids", "task", "nth"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return durable(slim.mapInArrow(run, "doc_id long, start long, length int, doc_tokens long, ids binary, task int, nth long"))


def pack(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, end: int = END, spare_milli: int = SPARE_MILLI) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (little-endian 32-bit numbers).

    A document is its text's identifiers and `end`; a null or empty text is `end` alone.  Every identifier
    is in one piece; pieces of a sequence follow each other from offset 0 without a gap.  A sequence
    has at most `size` identifiers.  Texts of any length are read whole; repeated rows and null doc_ids are
    documents of their own.  An empty table gives no rows.  Other columns are not looked at.
    """
    cut = pieces(docs, vocabulary_path, id_col, text_col, size, end)
    counts = durable(cut.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `size` rows
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # a row per task that made the length
    bases = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    small = F.broadcast if counts.count() <= BROADCAST_COUNTS else (lambda d: d)
    sent = ship(docs.sparkSession, by_number(best_fit(histogram, size, spare_milli)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = sent()
        for batch in batches:
            rows: list[tuple] = []
            doc, start, length, tokens, ids, number = (c.to_pylist() for c in batch.columns)
            for i, (s, n, raw, k) in enumerate(zip(start, length, ids, number, strict=True)):
                edges, parts = plan[n]
                for r in parts[np.searchsorted(edges, k, side="right") - 1]:
                    rows.append((doc[i], s + r.shift, r.take, tokens[i], r.window + k - r.first, r.offset, raw[4 * r.shift : 4 * (r.shift + r.take)]))
            if rows:
                names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if x == "ids" else pa.int64()) for c, x in zip(zip(*rows, strict=True), names, strict=True)], names)

    located = cut.join(small(bases), ["task", "length"]).select("doc_id", "start", "length", "doc_tokens", "ids", (F.col("base") + F.col("nth")).alias("number"))
    return located.mapInArrow(place, "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def sequences(packed: DataFrame, size: int = SIZE, pad: int = END) -> DataFrame:
    """sequence_id, n_tokens, ids: the pieces of `pack` put together; padded to `size` unless the length is a power of two."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])
    whole = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids"))
    power = F.col("n_tokens").bitwiseAND(F.col("n_tokens") - 1) == 0
    padding = F.repeat(F.lit(pad.to_bytes(4, "little").hex()), (F.lit(size) - F.col("n_tokens")).cast("int"))
    return whole.select("sequence_id", "n_tokens", F.when(power, F.col("ids")).otherwise(F.concat("ids", F.unhex(padding))).alias("ids"))
