"""Join of near-equal texts: Jaccard similarity of word n-gram sets, by MinHash banding.

1. Texts with the same n-gram set form a class, known by a 128-bit digest; only classes go on.
2. BANDS bands of ROWS MinHash values each are chosen for the target recall at the threshold.  Classes
   are shuffled on their band hashes.  In a bucket, classes are first compared with one of them, the
   pivot, by their whole signatures; only those that agree with it too little, and are so not tied to
   the others already, are compared with all others.
3. Candidates are tied into groups, and within a group every pair is verified on the full sets.  There
   too one set R is the pivot: if A and B lack ar and br of R's grams and have ao and bo others, they
   share |R| - ar - br grams or more, so they are similar for sure where q (ar + br) + p (ao + bo) <=
   (q - p) |R| for the threshold p / q.  These links are counted from the sets' distances to R alone,
   without pairs; only sets that are far from R meet all others.

What meets all others is cut into blocks on both sides, and each pair of blocks is a unit of work of its
own, so a unit's size is bounded and no pair is lost.  Units give counts and a spanning forest of the
links that they found, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import bound_batches, components, durable, fresh
from .textarrays import MIX1, MIX2, U64, Words, flat, grams, mix, small_batches

N = 5
THRESHOLD = Fraction(4, 5)
RECALL = 0.9999
#: Most MinHash values of a signature.
VALUES = 128
#: Members of a block in buckets, and in groups.
BLOCK, SET_BLOCK = 1024, 256


def bands_for(threshold: float, recall: float = RECALL, values: int = VALUES) -> tuple[int, int]:
    """(bands, rows): the most rows a band, so the fewest false candidates, at which enough bands for the recall still fit."""
    best = (values, 1)
    for rows in range(1, values + 1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows)))
        if bands * rows <= values:
            best = bands, rows
    return best


def gram_sets(column: pa.Array, n: int = N) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text; one gram of all words if there are fewer than n, none if there are none."""
    lowered = pa.array([t.lower() if t else "" for t in column.to_pylist()], pa.large_string())
    w = Words(*flat(lowered))
    g = grams(w.hash, n)
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(g[a : b - n + 1]))
        else:
            out.append(grams(w.hash[a:b], b - a)[:1] if b > a else np.zeros(0, U64))
    return out


def signatures(sets: list[np.ndarray], values: int) -> np.ndarray:
    """MinHash values of non-empty sets, one row each."""
    factors = mix(np.arange(1, values + 1, dtype=U64) * U64(MIX2)) | U64(1)
    out = np.zeros((len(sets), values), np.uint32)
    if sets:
        whole = np.concatenate(sets)
        starts = np.cumsum([0, *map(len, sets[:-1])])
        for j in range(values):
            out[:, j] = np.minimum.reduceat(((whole * factors[j]) >> U64(32)).astype(np.uint32), starts)
    return out


def digest(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, whatever the order."""
    return int(np.add.reduce(mix(s + U64(len(s))))) & (1 << 64) - 1, int(np.add.reduce(mix(s ^ U64(MIX2)))) & (1 << 64) - 1


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def groups_of(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Successive runs of rows with equal values in the first `keys` columns."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        change = np.zeros(batch.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(c[a] for c in cols)
            if key != last and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def cross_units(loose: DataFrame, members: DataFrame, key: str, node: str, block: int) -> DataFrame:
    """Every loose row meets every member of its key in one unit: columns key, lo, hi, role (0 loose, 1 member) and the others.

    A loose row comes once for each block of members, a member once for each block of loose rows.
    """
    count = lambda d, n: d.groupBy(key).agg(F.count(F.lit(1)).alias(n))
    sizes = durable(count(loose, "_u").join(count(members, "_m"), key))
    blocks = lambda n: F.ceil(F.col(n) / block).cast("int")
    own = lambda n: F.pmod(F.xxhash64(node), blocks(n)).cast("int")
    all_ = lambda n: F.explode(F.sequence(F.lit(0), blocks(n) - 1))
    a = loose.join(sizes, key).withColumn("lo", own("_u")).withColumn("hi", all_("_m")).withColumn("role", F.lit(0))
    b = members.join(sizes, key).withColumn("hi", own("_m")).withColumn("lo", all_("_u")).withColumn("role", F.lit(1))
    return a.unionByName(b).drop("_u", "_m").repartition(key, "lo", "hi").sortWithinPartitions(key, "lo", "hi")


def forest(linked: np.ndarray) -> np.ndarray:
    """For each node of a symmetric matrix the least node of its component."""
    n = len(linked)
    label = np.full(n, -1)
    for start in range(n):
        if label[start] >= 0:
            continue
        label[start] = start
        front = np.array([start])
        while len(front):
            front = np.flatnonzero(linked[front].any(0) & (label < 0))
            label[front] = start
    return label


def _edges_of(node: np.ndarray, role: np.ndarray, ok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of links between loose rows (role 0) and members (role 1); ok: one row a loose one, one column a member."""
    ids, at = np.unique(node, return_inverse=True)
    linked = np.zeros((len(ids), len(ids)), bool)
    u, m = at[role == 0], at[role == 1]
    i, j = np.nonzero(ok)
    linked[u[i], m[j]] = linked[m[j], u[i]] = True
    label = forest(linked)
    some = label != np.arange(len(ids))
    return ids[some], ids[label[some]]


def agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of equal values of each row of a with each row of b."""
    out = np.zeros((len(a), len(b)), np.int16)
    for i in range(0, len(a), 64):
        for j in range(a.shape[1]):
            out[i : i + 64] += a[i : i + 64, None, j] == b[None, :, j]
    return out


def _tie(width: int, least: float) -> Callable:
    """Whether each row's signature agrees with its pivot's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, width) for c in (2, 3)]
            tied = (both[0] == both[1]).sum(1) >= least * width
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(tied)], ["node", "pivot", "tied"])

    return run


def _candidates(width: int, least: float) -> Callable:
    """Edges between loose rows and members of a bucket whose signatures agree in at least the share `least`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups_of(batches, 3):
            node, role = t["node"].to_numpy(), t["role"].to_numpy()
            sig = np.frombuffer(b"".join(t["brief"].to_pylist()), np.uint8).reshape(-1, width)
            ok = agreement(sig[role == 0], sig[role == 1]) >= least * width
            a, b = _edges_of(node, role, ok & (node[role == 0][:, None] != node[role == 1][None, :]))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _measure(threshold: Fraction) -> Callable:
    """far: q (grams of the pivot that a set lacks) + p (grams it has beside them); room: the sum of two sets' far at which they are similar for sure."""
    p, q = threshold.numerator, threshold.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far, room = [], []
            for x, y in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                a, r = np.frombuffer(x, U64), np.frombuffer(y, U64)
                shared = len(np.intersect1d(a, r, assume_unique=True))
                far.append(q * (len(r) - shared) + p * (len(a) - shared))
                room.append((q - p) * len(r))
            yield pa.RecordBatch.from_arrays([*batch.select([0, 1, 2]).columns, pa.array(far, pa.int64()), pa.array(room, pa.int64())], ["root", "node", "copies", "far", "room"])

    return run


def _verify(threshold: Fraction) -> Callable:
    """For each node of a unit its links there that aren't sure, and an edge of the unit's forest or itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups_of(batches, 3):
            node, role, copies, far = (t[c].to_numpy() for c in ("node", "role", "copies", "far"))
            room, loose = t["room"][0].as_py(), 2 * far > t["room"][0].as_py()
            sets = [np.frombuffer(x, U64) for x in t["grams"].to_pylist()]
            n = np.array([len(s) for s in sets])
            who = np.repeat(np.arange(len(sets)), n)
            _, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
            shared = np.flatnonzero(often > 1)  # a gram of one set is in no intersection
            place = np.full(len(often), -1)
            place[shared] = np.arange(len(shared))
            column = place[column]
            who, column = who[column >= 0], column[column >= 0]
            order = np.argsort(column, kind="stable")
            who, column = who[order], column[order]
            u, m = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
            both = np.zeros((len(u), len(m)), np.float32)
            for a in range(0, len(shared), 4096):
                i, j = np.searchsorted(column, [a, a + 4096])
                x = np.zeros((len(sets), min(4096, len(shared) - a)), np.float32)
                x[who[i:j], column[i:j] - a] = 1
                both += x[u] @ x[m].T
            ok = both * (threshold.numerator + threshold.denominator) >= threshold.numerator * (n[u][:, None] + n[m][None, :]).astype(np.float64)
            ok &= (node[u][:, None] != node[m][None, :]) & (far[u][:, None] + far[m][None, :] > room)
            mine = ok & ~loose[m][None, :]  # a loose member counts its links itself
            a, b = _edges_of(node, role, ok)
            nodes = np.concatenate([node[u], node[m], a])
            links = np.concatenate([ok.sum(1), mine.sum(0), np.zeros(len(a), np.int64)])
            docs = np.concatenate([(ok * copies[m][None, :]).sum(1), (mine * copies[u][:, None]).sum(0), np.zeros(len(a), np.int64)])
            leader = np.concatenate([node[u], node[m], b])
            some = (links > 0) | (leader != nodes)
            yield pa.RecordBatch.from_arrays([pa.array(nodes[some], pa.int64()), pa.array(leader[some], pa.int64()), pa.array(links[some].astype(np.int64)), pa.array(docs[some].astype(np.int64))], ["node", "leader", "links", "docs"])

    return run


def sure_links(measured: DataFrame) -> DataFrame:
    """node, links, docs: how many sets of its group, and documents of them, are similar for sure, by the distances to the pivot.

    Distances are counted by group and value first, so what a window holds grows with the length of
    texts, not with the group.
    """
    values = measured.groupBy("root", F.col("far").alias("at")).agg(F.count(F.lit(1)).alias("n"), F.sum("copies").alias("c"))
    asked = measured.where("far <= room").select("root", (F.col("room") - F.col("far")).alias("at")).distinct()
    both = values.withColumn("ask", F.lit(0)).unionByName(asked.withColumn("ask", F.lit(1)), allowMissingColumns=True)
    upto = Window.partitionBy("root").orderBy("at", "ask").rowsBetween(Window.unboundedPreceding, 0)
    answers = both.withColumn("n", F.sum("n").over(upto)).withColumn("c", F.sum("c").over(upto)).where("ask = 1").select("root", "at", "n", "c")
    itself = F.when(2 * F.col("far") <= F.col("room"), 1).otherwise(0)
    mine = measured.where("far <= room").withColumn("at", F.col("room") - F.col("far")).join(answers, ["root", "at"])
    return mine.select("node", (F.col("n") - itself).alias("links"), (F.col("c") - itself * F.col("copies")).alias("docs"))


def _classes(docs: DataFrame, id_col: str, text_col: str, n: int, threshold: Fraction, recall: float, values: int) -> DataFrame:
    """For each row doc_id, body (hash of the text), tied (a number of its class), and the columns of `join`."""
    bound_batches(docs.sparkSession)
    bands, rows = bands_for(float(threshold), recall, values)
    width = bands * rows
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("body"), F.col(text_col).alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, limit=1 << 20):
            sets = gram_sets(batch.column(2), n)
            table = signatures([s for s in sets if len(s)], width)
            keys = np.zeros((len(table), bands), U64)
            for k in range(bands):
                for j in range(k * rows, (k + 1) * rows):
                    keys[:, k] = mix(keys[:, k] * U64(MIX1) + table[:, j].astype(U64) + U64(k + 1))
            marks = iter(zip(keys.view(np.int64).tolist(), [x.tobytes() for x in table.astype(np.uint8)], strict=True))
            two = [digest(s) for s in sets]
            both = [next(marks) if len(s) else (None, None) for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([_signed(a) for a, _ in two], pa.int64()), pa.array([_signed(b) for _, b in two], pa.int64()), pa.array([b for b, _ in both], pa.list_(pa.int64())), pa.array([b for _, b in both], pa.binary())], ["doc_id", "body", "node", "check", "bands", "brief"])

    # brief: a byte of each MinHash value, enough to leave out what agrees far too little
    signed = durable(slim.mapInArrow(sign, "doc_id long, body long, node long, check long, bands array<long>, brief binary"))
    classes = durable(signed.groupBy("node", "check").agg(F.min("doc_id").alias("copy_id"), F.count(F.lit(1)).alias("n_copies"), F.max("bands").alias("bands"), F.max("brief").alias("brief")))

    each = classes.where("brief is not null").select("node", F.explode("bands").alias("band"))
    repeated = durable(each.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("pivot")).where("size > 1"))
    members = durable(each.join(repeated, "band").where("node <> pivot"))
    brief = classes.where("brief is not null").groupBy("node").agg(F.max("brief").alias("brief"))
    # five standard deviations of a signature's agreement below the threshold
    least = float(threshold) - 5 * math.sqrt(float(threshold) * (1 - float(threshold)) / width)
    pairs = members.select("node", "pivot").distinct().join(brief, "node").join(brief.select(F.col("node").alias("pivot"), F.col("brief").alias("other")), "pivot")
    ties = durable(pairs.select("node", "pivot", "brief", "other").mapInArrow(_tie(width, least), "node long, pivot long, tied boolean"))
    loose = members.where("size > 2").join(ties.where("not tied").select("node", "pivot"), ["node", "pivot"]).select("band", "node")
    open_ = members.join(loose.select("band").distinct(), "band").select("band", "node")
    buckets = cross_units(durable(loose.join(brief, "node")), durable(open_.join(brief, "node")), "band", "node", BLOCK)
    edges = buckets.select("band", "lo", "hi", "role", "node", "brief").mapInArrow(_candidates(width, least), "a long, b long")
    groups = durable(components(ties.where("tied").select(F.col("node").alias("a"), F.col("pivot").alias("b")).unionByName(edges)))

    def regram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text="text", limit=1 << 20):
            sets = gram_sets(batch.column(batch.schema.get_field_index("text")), n)
            mine = batch.column(batch.schema.get_field_index("node")).to_pylist()
            keep = [i for i, s in enumerate(sets) if len(s) and _signed(digest(s)[0]) == mine[i]]
            out = batch.select(["root", "node", "copies"]).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array([sets[i].tobytes() for i in keep], pa.binary())], ["root", "node", "copies", "grams"])

    chosen = groups.join(classes.select("node", "copy_id", F.col("n_copies").alias("copies")), "node")
    texts = slim.join(chosen, slim["doc_id"].eqNullSafe(chosen["copy_id"])).select("root", "node", "copies", "text")
    full = durable(texts.mapInArrow(regram, "root long, node long, copies long, grams binary").dropDuplicates(["node"]))
    pivots = full.where("node = root").select("root", F.col("grams").alias("pivot"))
    measured = durable(full.join(pivots, "root").select("root", "node", "copies", "grams", "pivot").mapInArrow(_measure(threshold), "root long, node long, copies long, far long, room long"))
    others = measured.where("node <> root")
    apart = others.where("2 * far > room").select("root").distinct()
    some = durable(others.join(apart, "root").join(full.select("node", "grams"), "node").select("root", "node", "copies", "far", "room", "grams"))
    units = cross_units(some.where("2 * far > room"), some, "root", "node", SET_BLOCK).select("root", "lo", "hi", "role", "node", "copies", "far", "room", "grams")
    verified = durable(units.mapInArrow(_verify(threshold), "node long, leader long, links long, docs long"))
    sure = durable(sure_links(measured))
    totals = verified.select("node", "links", "docs").unionByName(sure).groupBy("node").agg(F.sum("links").alias("n_links"), F.sum("docs").alias("linked"))
    ends = lambda d, a, b: d.select(F.col(a).alias("a"), F.col(b).alias("b"))
    linked = durable(components(ends(verified.where("leader <> node"), "node", "leader").unionByName(ends(others.where("far <= room"), "node", "root"))))
    least_id = linked.join(classes.select("node", "copy_id"), "node").groupBy("root").agg(F.min("copy_id").alias("class_id"))
    found = linked.join(least_id, "root").join(totals, "node").select("node", "root", "class_id", "n_links", "linked")
    per_class = classes.drop("bands", "brief").join(found, "node", "left").select("node", "check", "copy_id", "n_copies", F.coalesce("root", "node").alias("tied"), F.coalesce("class_id", "copy_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), (F.coalesce("linked", F.lit(0)) + F.col("n_copies") - 1).alias("n_linked_docs"))
    return signed.select("doc_id", "body", "node", "check").join(per_class, ["node", "check"]).select("doc_id", "body", "tied", "class_id", "copy_id", "n_copies", "n_links", "n_linked_docs")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, threshold: Fraction = THRESHOLD, recall: float = RECALL, values: int = VALUES) -> DataFrame:
    """One row per document: doc_id, class_id, copy_id, n_copies, n_links, n_linked_docs.

    copy_id: least doc_id of the documents with the same n-gram set, n_copies of them; n_links: how many
    other sets are at least `threshold` similar; n_linked_docs: how many documents have one of these, or
    the same one, besides this; class_id: least doc_id that a chain of links or copies leads to.

    Words are lower-cased and parted by blanks, tabs and line ends.  A text of fewer than n words has
    one gram of them all; texts without words (null ones too) have the empty set, are copies of each
    other, and link to no other.  A link is found with probability `recall` at the threshold, and a
    greater one above it.  Repeated rows are copies; ids that are null have the class null unless others
    share it.  Texts of any length are read whole.  An empty table gives no rows.
    """
    return _classes(docs, id_col, text_col, n, threshold, recall, values).select("doc_id", "class_id", "copy_id", "n_copies", "n_links", "n_linked_docs")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, threshold: Fraction = THRESHOLD, recall: float = RECALL, values: int = VALUES) -> DataFrame:
    """The documents, all columns, one of each class: that of the least doc_id, null ones last, and then of the least hash of its text.

    Rows are told apart by id and text, so a row of another class with the same id stays; of rows equal
    in both the one with the least hash of its other columns stays.  An empty table gives no rows.
    """
    rows = durable(_classes(docs, id_col, text_col, n, threshold, recall, values).select("doc_id", "body", "tied"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("body").alias("body"))
    first = rows.groupBy("tied").agg(F.min(order).alias("first"))
    lost = rows.join(first, "tied").where(~(F.col("doc_id").eqNullSafe(F.col("first.id")) & (F.col("body") == F.col("first.body")))).select(F.col("doc_id").alias("_lost_id"), F.col("body").alias("_lost_body")).distinct()
    twice = durable(rows.groupBy("doc_id", "body").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select(F.col("doc_id").alias("_twice_id"), F.col("body").alias("_twice_body")))
    body = F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    kept = docs.join(durable(lost), docs[id_col].cast("long").eqNullSafe(F.col("_lost_id")) & (body == F.col("_lost_body")), "left_anti")
    if twice.isEmpty():
        return kept
    nth, mark = fresh(docs, "_nth"), fresh(docs, "_mark")
    hashed = F.xxhash64(*(F.col(c) for c in docs.columns if c not in (id_col, text_col)), F.lit(0))
    same = kept[id_col].cast("long").eqNullSafe(F.col("_twice_id")) & (F.xxhash64(F.coalesce(kept[text_col], F.lit(""))) == F.col("_twice_body"))
    again = kept.join(twice, same).withColumn(mark, F.col("_twice_body")).drop("_twice_body")
    again = again.withColumn(nth, F.row_number().over(Window.partitionBy("_twice_id", mark).orderBy(hashed))).where(F.col(nth) == 1).select(*docs.columns)
    return kept.join(twice, same, "left_anti").unionByName(again)
