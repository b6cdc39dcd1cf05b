"""Removal of every long repeated byte string, with an enhanced suffix array.

Of the GRAM-byte strings in a window of LENGTH bytes the one with the least hash is the window's anchor;
equal windows have equal anchors.  So windows are dealt out by anchor: a context is a row of windows
around one place of an anchor, which stays theirs as long as it is in the window, and windows of
contexts with different anchors are different.  A context alone with its anchor holds a repeat only if its
first and its last window see the anchor's string at different places, as in a phrase that goes on and on.
Equal contexts are counted as one; different ones with the same anchor go to one task, which sorts the
suffixes that may begin a repeat, computes their common prefixes, and scans the array with a stack: each
common-prefix interval of LENGTH bytes or more whose members differ in the byte before them is a maximal
repeat, all members being its occurrences.  A document loses the bytes that occurrences cover.

An anchor with more than GROUP different contexts doesn't go to one task: its windows are compared by
128-bit digests, which any number of tasks can share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from .jaccard_join import groups_of
from .shared import bound_batches, durable, forget
from .textarrays import BASE, MASK, U64, flat, mix, small_batches

LENGTH, GRAM = 200, 40
#: Windows that are looked at together; their places take 21 bits.
TILE = 1 << 20
#: Different contexts of an anchor that one task may hold, and bytes of contexts that are sorted together.
GROUP, SORTED = 20_000, 1 << 20
BASE2 = 0xD6E8FEB86659FD93


def rolling(data: np.ndarray, length: int, base: int = BASE) -> np.ndarray:
    """Hash of the `length` bytes from each place on; the last length - 1 places are missing."""
    if len(data) < length:
        return np.zeros(0, U64)
    part, size, factor = data.astype(U64) + U64(1), 1, base
    out, done = None, 0
    while True:
        if length & size:  # the parts of the binary sum, shortest first
            if out is None:
                out, done = part, size
            else:
                n = len(data) - done - size + 1
                out = part[:n] * U64(pow(base, done, 1 << 64)) + out[size : size + n]
                done += size
        if done == length:
            return out
        part = part[:-size] * U64(factor) + part[size:]
        factor = factor * factor & MASK
        size *= 2


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of the `width` values from each place on."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def contexts(data: np.ndarray, at: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """anchor, row, first window (place in the text), number of windows, and whether the anchor's string is there twice, of every context.

    Two equal windows of a context hold its anchor at places as far apart as they are; the last window then
    has a later place of it than the first.
    """
    low = U64((1 << 21) - 1)
    out: list[tuple] = []
    for base in range(0, max(1, len(data) - length + 1), TILE):
        tile = data[base : base + TILE + length - 1]
        if len(tile) < length:
            continue
        h = mix(rolling(tile, gram)) & ~low
        least = sliding_min(h | (low - np.arange(len(h), dtype=U64)), length - gram + 1)
        value, last = least & ~low, (low - (least & low)).astype(np.int64)  # the last place of the least hash
        place = np.arange(len(value))
        row = np.searchsorted(at, base + place, side="right") - 1
        ok = base + place + length <= at[row + 1]
        value, last, place, row = value[ok], last[ok], place[ok], row[ok]
        if not len(place):
            continue
        cut = np.append(True, (value[1:] != value[:-1]) | (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1))
        begin = np.flatnonzero(cut)
        end = np.append(begin[1:], len(place))
        while len(begin):  # an anchor stays as long as it is in the window, so a run of one byte changes it only now and then
            upto = np.minimum(end, begin + last[begin] - place[begin] + 1)
            out.append((mix(value[begin]), row[begin], base + place[begin] - at[row[begin]], upto - begin, last[upto - 1] > last[begin]))
            more = upto < end
            begin, end = upto[more], end[more]
    if not out:
        return np.zeros(0, U64), *(np.zeros(0, np.int64) for _ in range(3)), np.zeros(0, bool)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def maximal_repeats(texts: list[bytes], starts: list[int], length: int = LENGTH) -> list[tuple[int, np.ndarray]]:
    """(length, places) of each maximal repeat of `length` bytes or more, places counting the joined texts' bytes.

    Only the first starts[i] places of text i begin an occurrence; a text's begin differs from any byte
    before others.
    """
    t = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(x) for x in texts])
    begin = np.cumsum(np.append(0, sizes[:-1]))
    counts = np.asarray(starts)
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(np.append(0, counts[:-1])), counts)
    place, text = np.repeat(begin, counts) + offset, np.repeat(np.arange(len(texts)), counts)
    keys = rolling(t, length)[place]
    order = np.argsort(keys, kind="stable")
    keys, place, text, offset = keys[order], place[order], text[order], offset[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(keys))))
    # bytes before: a class of equal windows that all have the same one isn't the begin of a maximal repeat
    left = np.where(offset > 0, t[np.maximum(place - 1, 0)].astype(np.int64), -1 - np.arange(len(place)))
    low, high = np.minimum.reduceat(left, first), np.maximum.reduceat(left, first)
    many = np.diff(np.append(first, len(keys))) > 1
    keep = np.flatnonzero((many & (low != high))[of])
    if not len(keep):
        return []
    place, of, left, end = place[keep], of[keep], left[keep], (begin + sizes)[text[keep]]
    # the suffix array of what is left: equal windows together, then by the bytes beyond them
    joined = t.tobytes()
    beyond = [joined[p + length : e] for p, e in zip(place.tolist(), end.tolist(), strict=True)]
    array = sorted(range(len(place)), key=lambda i: (of[i], beyond[i]))
    place, of, left, end = place[array], of[array], left[array], end[array]
    n = len(array)
    common = np.zeros(n + 1, np.int64)  # common[i]: of suffixes i - 1 and i
    pairs = np.flatnonzero(of[1:] == of[:-1]) + 1
    step = 4096
    for a in range(0, len(pairs), step):
        i = pairs[a : a + step]
        room = np.minimum(end[i] - place[i], end[i - 1] - place[i - 1])
        span = np.arange(int(room.max()))
        differ = t[np.minimum(place[i][:, None] + span, len(t) - 1)] != t[np.minimum(place[i - 1][:, None] + span, len(t) - 1)]
        differ |= span >= room[:, None]
        common[i] = np.where(differ.any(1), differ.argmax(1), room)
    common[common < length] = 0  # equal hashes of unequal windows
    changes = np.cumsum(np.append(0, left[1:] != left[:-1]))
    out: list[tuple[int, np.ndarray]] = []
    stack = [(0, 0)]
    lcp = common.tolist()
    for i in range(1, n + 1):
        lb = i - 1
        while lcp[i] < stack[-1][0]:
            depth, lb = stack.pop()
            if changes[i - 1] > changes[lb]:  # left-extensions differ
                out.append((depth, place[lb:i]))
        if lcp[i] > stack[-1][0]:
            stack.append((lcp[i], lb))
    return out


def covered(texts: list[bytes], starts: list[int], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """For each text the parts that occurrences of maximal repeats cover, merged."""
    total = sum(map(len, texts))
    edge = np.zeros(total + 1, np.int64)
    for size, places in maximal_repeats(texts, starts, length):
        np.add.at(edge, places, 1)
        np.add.at(edge, places + size, -1)
    inside = np.zeros(total + 2, bool)
    inside[1:-1] = np.cumsum(edge[:-1]) > 0
    begin = np.cumsum(np.append(0, [len(x) for x in texts]))
    out = []
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
        here = np.concatenate([[False], inside[a + 1 : b + 1], [False]])
        flips = np.flatnonzero(here[1:] != here[:-1]).tolist()
        out.append(list(zip(flips[::2], flips[1::2], strict=True)))
    return out


def _spans(ranges) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


RANGES = "array<struct<a: int, b: int>>"
RANGES_ARROW = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def _ranges_of_groups(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            found = covered(texts, starts, length)
            some = [i for i, x in enumerate(found) if x]
            return pa.RecordBatch.from_arrays([*(pa.array([ids[i][k] for i in some], pa.int64()) for k in range(3)), pa.array([[{"a": a, "b": b} for a, b in found[i]] for i in some], RANGES_ARROW)], ["anchor", "d1", "d2", "ranges"])

        ids: list[tuple] = []
        texts: list[bytes] = []
        starts: list[int] = []
        held = 0
        for t in groups_of(batches, 1):
            cols = [t[c].to_pylist() for c in ("anchor", "d1", "d2", "bytes")]
            ids += zip(*cols[:3], strict=True)
            texts += cols[3]
            starts += [len(x) - length + 1 for x in cols[3]]
            held += sum(map(len, cols[3]))
            if held >= SORTED:
                yield flush()
                ids, texts, starts, held = [], [], [], 0
        if ids:
            yield flush()

    return run


def _windows(length: int):
    """Digest of each window of each context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, x in enumerate(batch.column(3).to_pylist()):
                data = np.frombuffer(x, np.uint8)
                w1, w2 = mix(rolling(data, length)).view(np.int64), mix(rolling(data, length, BASE2)).view(np.int64)
                of = batch.select([0, 1, 2]).take(pa.array(np.full(len(w1), row)))
                yield pa.RecordBatch.from_arrays([*of.columns, pa.array(np.arange(len(w1), dtype=np.int32)), pa.array(w1), pa.array(w2)], ["anchor", "d1", "d2", "place", "w1", "w2"])

    return run


class Output(NamedTuple):
    """What a document's bytes and removed spans are turned into, where they are at hand."""

    schema: str
    of: Callable[[bytes, list[list[int]]], tuple]


def without(raw: bytes, spans: list[list[int]]) -> bytes:
    """The bytes outside the spans."""
    return b"".join(raw[a:b] for a, b in zip([0, *(s[1] for s in spans)], [*(s[0] for s in spans), len(raw)], strict=True))


#: The operator's own output: the removed spans, and the bytes that are left.
KEPT = Output(f"spans {RANGES}, kept binary", lambda raw, spans: ([{"a": a, "b": b} for a, b in spans], without(raw, spans)))


class _Parts(NamedTuple):
    """Documents cut into contexts: `parted` as it was written, the contexts' places, the different contexts, and how many each anchor has."""

    parted: DataFrame
    places: DataFrame
    distinct: DataFrame
    sizes: DataFrame


def _struct(output: Output) -> tuple[pa.DataType, list[str], str]:
    """The output's columns as one Arrow struct, their names, and the struct's type in SQL."""
    kind = StructType.fromDDL(output.schema)
    return to_arrow_type(kind), kind.names, kind.simpleString()


def _cut(docs: DataFrame, id_col: str, text_col: str, length: int, gram: int, output: Output) -> _Parts:
    bound_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("body"), text.alias("text"))
    kind, names, struct = _struct(output)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, limit=TILE):
            anchor, row, start, n, twice = contexts(*flat(batch.column(2)), length, gram)
            of = batch.select([0, 1]).take(pa.array(row))
            yield pa.RecordBatch.from_arrays([*of.columns, pa.array(anchor.view(np.int64)), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(twice)], ["doc_id", "body", "anchor", "start", "n", "twice"])

    found = durable(rows.mapInArrow(cut, "doc_id long, body long, anchor long, start int, n int, twice boolean"))
    # a table of its own, so that adaptive execution can split the join at anchors of many places
    again = durable(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("times"), F.max("twice").alias("twice")).where("times > 1 or twice").select("anchor"))
    mine = durable(found.join(again, "anchor").groupBy("doc_id", "body").agg(F.collect_list(F.struct("start", "n", "anchor", "twice")).alias("parts")))
    forget(found)
    forget(again)

    def slice_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of a document without parts its output, else its text and its contexts; a task gives the bytes of equal contexts once."""
        seen: set[bytes] = set()
        for batch in small_batches(batches, limit=1 << 20):
            of, anchors, starts, twice, d1, d2, bytes_, whole, outs = [], [], [], [], [], [], [], [], []
            for row, (t, parts) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                raw = t.encode("utf-8", "surrogatepass")
                of.append(row), anchors.append(None), starts.append(len(raw)), twice.append(None), d1.append(None), d2.append(None), bytes_.append(None)
                whole.append(t if parts else None), outs.append(None if parts else dict(zip(names, output.of(raw, []), strict=True)))
                for start, n, anchor, again_ in {(p["start"], p["n"], p["anchor"], p["twice"]) for p in parts or ()}:
                    x = raw[start : start + n + length - 1]
                    digest = hashlib.blake2b(x, digest_size=16).digest()
                    if len(seen) > 100_000:
                        seen.clear()
                    of.append(row), anchors.append(anchor), starts.append(start), twice.append(again_), whole.append(None), outs.append(None)
                    d1.append(int.from_bytes(digest[:8], "little", signed=True)), d2.append(int.from_bytes(digest[8:], "little", signed=True))
                    bytes_.append(None if digest in seen else x)
                    seen.add(digest)
            keys = batch.select([0, 1]).take(pa.array(of, pa.int64()))
            yield pa.RecordBatch.from_arrays([*keys.columns, pa.array(anchors, pa.int64()), pa.array(starts, pa.int32()), pa.array(twice, pa.bool_()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(bytes_, pa.binary()), pa.array(whole, pa.string()), pa.array(outs, kind)], ["doc_id", "body", "anchor", "start", "twice", "d1", "d2", "bytes", "text", "out"])

    schema = f"doc_id long, body long, anchor long, start int, twice boolean, d1 long, d2 long, bytes binary, text string, out {struct}"
    theirs = mine.select(F.col("doc_id").alias("id"), F.col("body").alias("of"), "parts")
    parted = durable(rows.join(theirs, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("body") == F.col("of")), "left").select("doc_id", "body", "text", "parts").mapInArrow(slice_, schema))
    forget(mine)
    places = parted.where("anchor is not null").drop("text", "out")
    distinct = durable(places.groupBy("anchor", "d1", "d2").agg(F.count(F.lit(1)).alias("copies"), F.max("bytes").alias("bytes"), F.max("twice").alias("twice")))
    return _Parts(parted, places, distinct, durable(distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("contexts"), F.max("twice").alias("twice"))))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, group: int = GROUP, output: Output = KEPT) -> DataFrame:
    """One row per document: doc_id and the output's columns; by default spans, the maximal removed runs [a, b) of bytes, and kept.

    Texts are UTF-8 bytes, null being empty; what is left of a text may be no UTF-8.  Every byte that a
    string of `length` bytes covers which also begins at another place of any document goes, the first
    occurrence too; a shorter text stays whole, and texts of any length are read whole.  Repeated rows
    repeat each other.  Other columns are not looked at; an empty table gives no rows.
    """
    parted, places, distinct, sizes = _cut(docs, id_col, text_col, length, gram, output)
    one = F.array(F.struct(F.lit(0).alias("a"), F.octet_length("bytes").cast("int").alias("b")))
    copied = distinct.where("copies > 1").select("anchor", "d1", "d2", one.alias("ranges"))
    single = distinct.select("anchor", "d1", "d2", "bytes").join(sizes.where(f"(contexts > 1 or twice) and contexts <= {group}").select("anchor"), "anchor")
    sorted_ = single.select("anchor", "d1", "d2", "bytes").repartition("anchor").sortWithinPartitions("anchor")
    ranges = copied.unionByName(sorted_.mapInArrow(_ranges_of_groups(length), f"anchor long, d1 long, d2 long, ranges {RANGES}"))
    if sizes.where(f"contexts > {group}").limit(1).count():
        large = distinct.join(sizes.where(f"contexts > {group}").select("anchor"), "anchor").select("anchor", "d1", "d2", "bytes")
        windows = durable(large.mapInArrow(_windows(length), "anchor long, d1 long, d2 long, place int, w1 long, w2 long"))
        equal = windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("w1", "w2")
        part = F.struct(F.col("place").alias("a"), (F.col("place") + length).alias("b"))
        ranges = ranges.unionByName(windows.join(equal, ["w1", "w2"]).groupBy("anchor", "d1", "d2").agg(F.collect_list(part).alias("ranges")))
    shifted = F.transform("ranges", lambda r: F.struct((F.col("start") + r["a"]).alias("a"), (F.col("start") + r["b"]).alias("b")))
    lost = places.select("doc_id", "body", "anchor", "d1", "d2", "start").join(ranges, ["anchor", "d1", "d2"]).groupBy("doc_id", "body").agg(F.flatten(F.collect_list(shifted)).alias("ranges"))
    lost = lost.select(F.col("doc_id").alias("id"), F.col("body").alias("of"), "ranges")
    kind, names, struct = _struct(output)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, limit=1 << 20):
            found = (output.of(t.encode("utf-8", "surrogatepass"), _spans((r["a"], r["b"]) for r in ranges_ or ())) for t, ranges_ in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([dict(zip(names, x, strict=True)) for x in found], kind)], ["doc_id", "out"])

    texts = parted.where("anchor is null and text is not null").select("doc_id", "body", "text")
    touched = texts.join(lost, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("body") == F.col("of")), "left").select("doc_id", "text", "ranges")
    done = touched.mapInArrow(remove, f"doc_id long, out {struct}")
    return done.unionByName(parted.where("anchor is null and text is null").select("doc_id", "out")).select("doc_id", "out.*")


def repeat_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Maximal repeats inside contexts with all their occurrences: r1, r2 (digest of the string), length, doc_id, start.

    A context holds at most length + (length - gram) bytes around its anchor, so a longer repeat comes as
    several that overlap.  An anchor's contexts meet in one task.  Documents are as in `deduplicate`.
    """
    _, places, distinct, sizes = _cut(docs, id_col, text_col, length, gram, KEPT)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups_of(batches, 1):
            texts, copies = t["bytes"].to_pylist(), t["copies"].to_pylist()
            joined, begin = b"".join(texts), np.cumsum([0, *map(len, texts)])
            found = maximal_repeats(texts, [len(x) - length + 1 for x in texts], length)
            found += [(len(x), begin[[i]]) for i, x in enumerate(texts) if copies[i] > 1]
            out: set[tuple] = set()
            for size, at in found:
                digest = hashlib.blake2b(joined[at[0] : at[0] + size], digest_size=16).digest()
                r1, r2 = (int.from_bytes(digest[k : k + 8], "little", signed=True) for k in (0, 8))
                out.update((int(k), r1, r2, size, int(p - begin[k])) for p in at for k in [np.searchsorted(begin, p, side="right") - 1])
            cols = list(zip(*sorted(out), strict=True)) if out else [[]] * 5
            of = pa.Table.from_batches(t.select(["anchor", "d1", "d2"]).combine_chunks().to_batches(), t.select(["anchor", "d1", "d2"]).schema).take(pa.array(cols[0], pa.int64())).combine_chunks()
            yield pa.RecordBatch.from_arrays([*(pa.concat_arrays(c.chunks) if c.num_chunks else pa.array([], c.type) for c in of.columns), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int32()), pa.array(cols[4], pa.int32())], ["anchor", "d1", "d2", "r1", "r2", "length", "at"])

    several = distinct.drop("twice").join(sizes, "anchor").where("contexts > 1 or copies > 1 or twice")
    repeats = several.select("anchor", "d1", "d2", "bytes", "copies").repartition("anchor").sortWithinPartitions("anchor").mapInArrow(scan, "anchor long, d1 long, d2 long, r1 long, r2 long, length int, at int")
    return places.select("doc_id", "anchor", "d1", "d2", "start").join(repeats, ["anchor", "d1", "d2"]).select("r1", "r2", "length", "doc_id", (F.col("start") + F.col("at")).alias("start")).distinct()


#: Every window of 200 bytes by its digest, as hexadecimal digits.
SQL = """
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS digits FROM {docs}),
windows AS (
  SELECT row, i, md5(substr(digits, 2 * i + 1, 400)) AS digest
  FROM (SELECT row, digits, unnest(range(0, greatest(0, length(digits) // 2 - 199))) AS i FROM texts)),
repeated AS (SELECT row, i FROM windows QUALIFY count(*) OVER (PARTITION BY digest) > 1),
islands AS (SELECT row, i, sum(CASE WHEN i <= before + 200 THEN 0 ELSE 1 END) OVER (PARTITION BY row ORDER BY i) AS island
            FROM (SELECT row, i, lag(i) OVER (PARTITION BY row ORDER BY i) AS before FROM repeated)),
spans AS (SELECT row, min(i) AS a, max(i) + 200 AS b FROM islands GROUP BY row, island),
parts AS (
  SELECT s.row, s.a, s.b, substr(t.digits, 2 * coalesce(lag(s.b) OVER w, 0) + 1, 2 * (s.a - coalesce(lag(s.b) OVER w, 0))) AS kept
  FROM spans s JOIN texts t USING (row) WINDOW w AS (PARTITION BY s.row ORDER BY s.a)),
lost AS (SELECT row, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS upto, string_agg(kept, '' ORDER BY a) AS kept FROM parts GROUP BY row)
SELECT doc_id, (length(digits) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(digits, 2 * coalesce(upto, 0) + 1))) AS kept_sha256
FROM texts LEFT JOIN lost USING (row)"""
