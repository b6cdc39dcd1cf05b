"""Language identification by prediction by partial matching.

For each language a tree of byte contexts of length 0 to ORDER is counted on training texts and then
frozen.  A byte is coded in the longest context that was seen: with n(byte) / (n + d) if the context
knows it, d being the number of different bytes seen there, else with d / (n + d) for an escape and
then in the next shorter one (method C, without exclusions); below the empty context all 256 bytes are
equally likely.  Contexts that reach before a text's begin hold NUL bytes there.  As the statistics
are frozen, the code length of a byte after a context is a constant, and a text's length is a sum of
them.  The language with the shortest code wins.

All contexts and all byte values of the sample are kept.  Languages go in groups of GROUP; a group's
contexts are merged into one hash table whose rows hold the lengths in every language of the group, so
a byte costs one look-up a group, and escapes are followed only for what no language of it has seen.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import bound_batches, first_by_hash, hash_place
from .textarrays import MIX1, U64, flat, small_batches, sums_by

#: Bytes of the longest context; it and the byte after it make one 64-bit number.
ORDER = 4
#: Languages whose code lengths lie side by side.
GROUP = 4
#: Bounds of the training sample: rows by language, and bytes of each that are read in all.
SAMPLE_ROWS = 4000
SAMPLE_BYTES = 3_000_000
UNDETERMINED = "und"
LETTER = regex.compile(r"\p{L}")


def strings(data: np.ndarray, at: np.ndarray, order: int = ORDER) -> np.ndarray:
    """For each place the `order` bytes before it in its text and its own byte as a number; NUL stands for what is before a text."""
    since = np.arange(len(data)) - np.repeat(at[:-1], np.diff(at))
    out = data.astype(U64)
    for k in range(1, order + 1):
        before = np.zeros(len(data), U64)
        before[k:] = data[: len(data) - k]
        before[since < k] = 0
        out |= before << U64(8 * k)
    return out


class Places:
    """An open-addressing table from distinct 64-bit keys to their places."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift, self.mask = U64(64 - bits), (1 << bits) - 1
        self.key, self.place = np.zeros(1 << bits, U64), np.full(1 << bits, -1, np.int32)
        todo = np.arange(len(keys))
        slot = self._slot(keys)
        while len(todo):
            free = self.place[slot] < 0
            _, first = np.unique(slot[free], return_index=True)
            won = np.flatnonzero(free)[first]
            self.key[slot[won]], self.place[slot[won]] = keys[todo[won]], todo[won]
            left = np.ones(len(todo), bool)
            left[won] = False
            todo, slot = todo[left], (slot[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * U64(MIX1)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, or -1."""
        slot = self._slot(keys)
        out = self.place[slot]
        wrong = np.flatnonzero((self.key[slot] != keys) & (out >= 0))
        at = slot[wrong]
        while len(wrong):
            at = (at + 1) & self.mask
            out[wrong] = self.place[at]
            still = (self.key[at] != keys[wrong]) & (out[wrong] >= 0)
            wrong, at = wrong[still], at[still]
        return out


@dataclass
class Level:
    """Contexts of one length: strings of context and byte with their code lengths, and contexts with their escapes' (0 in a language that hasn't seen them)."""

    keys: np.ndarray
    bits: np.ndarray
    contexts: np.ndarray
    escapes: np.ndarray


def _suffixes(strings_: np.ndarray, n: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct last `size` bytes of counted strings, and their counts."""
    keys, of = np.unique(strings_ & U64((1 << (8 * size)) - 1), return_inverse=True)
    return keys, np.bincount(of, n, len(keys))


def _level(counted: list[tuple[np.ndarray, np.ndarray]], k: int, below: Level | None) -> Level:
    """Counts of the strings of k + 1 bytes by language, as code lengths."""
    keys = np.unique(np.concatenate([c[0] for c in counted]))
    contexts = np.unique(keys >> U64(8))
    of = np.searchsorted(contexts, keys >> U64(8))
    bits = np.zeros((len(keys), len(counted)), np.float32)
    escapes = np.zeros((len(contexts), len(counted)), np.float32)
    shorter = below.bits[np.searchsorted(below.keys, keys & U64((1 << (8 * k)) - 1))] if below is not None else np.full(bits.shape, 8.0, np.float32)
    for j, (seen, n) in enumerate(counted):
        at = np.searchsorted(keys, seen)
        whole = np.bincount(of[at], n, len(contexts))
        kinds = np.bincount(of[at], minlength=len(contexts))
        some = kinds > 0
        escapes[some, j] = np.log2((whole[some] + kinds[some]) / kinds[some])
        bits[:, j] = escapes[of, j] + shorter[:, j]
        bits[at, j] = np.log2((whole + kinds)[of[at]] / n)
    return Level(keys, bits, contexts, escapes)


class Trees:
    """The frozen trees of all languages."""

    def __init__(self, langs: list[str], groups: list[list[Level]]):
        self.langs, self.groups = langs, groups
        self._tables: list | None = None

    def bits(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Code length of each text (rows) in each language (columns)."""
        if self._tables is None:
            self._tables = [[(Places(level.keys), Places(level.contexts)) for level in levels] for levels in self.groups]
        order, out = len(self.groups[0]) - 1, []
        whole = strings(data, at, order)
        for levels, tables in zip(self.groups, self._tables, strict=True):
            cost = np.zeros((len(data), levels[0].bits.shape[1]), np.float32)
            left, keys = np.arange(len(data)), whole
            for k in range(order, -1, -1):
                found = tables[k][0].find(keys)
                hit = found >= 0
                if k == order:
                    cost[hit] = levels[k].bits[found[hit]]
                else:
                    cost[left[hit]] += levels[k].bits[found[hit]]
                left, keys = left[~hit], keys[~hit]
                if not len(left):
                    break
                context = tables[k][1].find(keys >> U64(8))
                cost[left[context >= 0]] += levels[k].escapes[context[context >= 0]]
                keys = keys & U64((1 << (8 * k)) - 1)
            cost[left] += 8.0  # a byte that no text of the group held
            out += [sums_by(cost[:, j], at) for j in range(cost.shape[1])]
        return np.stack(out, 1)


def train(samples: dict[str, list[str]], order: int = ORDER) -> Trees:
    """Count the trees on texts by language and freeze them."""
    langs = sorted(samples)
    groups = []
    for g in range(0, len(langs), GROUP):
        counted = [[np.unique(strings(*flat(pa.array(samples[lang], pa.string())), order), return_counts=True) for lang in langs[g : g + GROUP]]]
        for k in range(order - 1, -1, -1):
            counted.append([_suffixes(*c, k + 1) for c in counted[-1]])
        levels: list[Level] = []
        for k in range(order + 1):
            levels.append(_level(counted[order - k], k, levels[-1] if levels else None))
        groups.append(levels)
    return Trees(langs, groups)


def sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = SAMPLE_ROWS, bytes_: int = SAMPLE_BYTES) -> DataFrame:
    """lang and text: at most `rows` whole training texts of each language, in the order of their ids' hashes, until `bytes_` are reached."""
    pool = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4)) != 2))
    pool = pool.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).alias("lang"), F.octet_length(text_col).alias("n"))
    # a bit over `rows` of each language are left for the windows
    few = first_by_hash(pool, "lang", "id", rows)
    order = Window.partitionBy("lang").orderBy(hash_place("id"), "id", "n")
    picked = few.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= rows)
    picked = picked.withColumn("upto", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))).where((F.col("upto") <= bytes_) | (F.col("nth") == 1)).select("id", "lang")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(picked.distinct()), ["id", "lang"]).select("lang", "text")


def learn(docs: DataFrame, **columns) -> Trees:
    """The trees of a sample of docs; see `sample`.  One task learns, as the sample is bounded; the driver gets the tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list[str]] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if text:
                    found.setdefault(lang, []).append(text)
        t = train({lang: sorted(texts) for lang, texts in found.items()})
        raw = pickle.dumps((t.langs, [[(x.keys, x.bits, x.contexts, x.escapes) for x in levels] for levels in t.groups]))
        yield pa.RecordBatch.from_arrays([pa.array([raw], pa.binary())], ["trees"])

    bound_batches(docs.sparkSession)
    rows = sample(docs, **columns).repartition(1).mapInArrow(run, "trees binary").collect()
    return thaw(bytes(rows[0].trees)) if rows else train({})


def thaw(raw: bytes) -> Trees:
    langs, groups = pickle.loads(raw)
    return Trees(langs, [[Level(*x) for x in levels] for levels in groups])


def _ship(docs: DataFrame, trees: Trees):
    """The trees on executors, tables built there; bounded by languages x SAMPLE_BYTES strings."""
    sent = docs.sparkSession.sparkContext.broadcast((trees.langs, [[(x.keys, x.bits, x.contexts, x.escapes) for x in levels] for levels in trees.groups]))
    return lambda: Trees(sent.value[0], [[Level(*x) for x in levels] for levels in sent.value[1]])


def judge(trees: Trees, column: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    texts = column.to_pylist()
    known = np.array([bool(t) and LETTER.search(t) is not None for t in texts], bool)
    langs, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
    if trees.langs and known.any():
        data, at = flat(column)
        bits = trees.bits(data, at)
        best = bits.argmin(1)
        share = 1 / np.exp2(bits.min(1, keepdims=True) - bits).sum(1)
        for i in np.flatnonzero(known):
            langs[i], scores[i] = trees.langs[best[i]], share[i]
    return langs, scores


def identify(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    held_out: crc32 of the id as text, modulo 4, is 2 (a null id is not held out).  lang_pred is `und`,
    with score 0, where the text is null or has no letter, or nothing was learned; of languages with
    equal codes the first by name wins.  score is the winner's share of the likelihood under equal
    priors.  Texts of any length are judged whole; repeated rows are each judged; an empty table gives
    no rows.
    """
    bound_batches(docs.sparkSession)
    model = _ship(docs, trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees_ = model()
        for batch in small_batches(batches, limit=1 << 20):
            langs, scores = judge(trees_, batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    held = F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4)) == 2, F.lit(False))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), held.alias("held_out"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def accepted(docs: DataFrame, trees: Trees, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The documents, all columns, whose language can be told: not `und`, and a score of `least` or more.

    Each row is judged by itself, repeated ones too; an empty table gives no rows.
    """
    bound_batches(docs.sparkSession)
    model, at = _ship(docs, trees), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees_ = model()
        for batch in small_batches(batches, text=text_col, limit=1 << 20):
            langs, scores = judge(trees_, batch.column(at))
            yield batch.filter(pa.array([x != UNDETERMINED and s >= least for x, s in zip(langs, scores, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
