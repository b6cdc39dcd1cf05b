"""Scores of texts under a log-bilinear neural language model, and under a unigram base.

The model's words are all words of the training texts.  The OWN most frequent ones have a vector and a
bias each; every other word belongs to the class of its last TAIL bytes (TAILS classes by hash), which
has a vector and a bias, and holds the share (c + 1) / (tokens + types of the class + 1) of it, c being
its own count; an unseen word counts as c = 0.  Context words have vectors by the same classes, coarser:
CONTEXTS - 1 - CONTEXT_TAILS words of their own, else CONTEXT_TAILS tails.  The score of a word or class w
after two words is b[w] + (P[c1] + Q[c2]) . R[w].

Training is noise-contrastive, in numpy: the texts are dealt by their hashes into ROUNDS rounds and, within
a round, into shards of about SHARD_TOKENS tokens, so that neither files nor tasks matter; each shard
starts from the parameters so far, and a round ends with their average, weighted by tokens.  More text
makes more shards, not longer ones.  Log-probabilities are normalised exactly over all words: as the
score is a sum over the two context words, the normalisers of all pairs of contexts are one product of
two matrices, taken in blocks of words.

All counts cover all training texts.  The counts of frequent words, BROAD of them at most, are
broadcast; those of the rest are joined by a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import bound_batches, durable, ship
from .textarrays import U64, Words, flat, small_batches, sums_by

#: Bounds of what is broadcast: words with vectors of their own, words whose counts go along.
OWN, BROAD = 60_000, 400_000
#: Classes of the other words, by their last bytes.
TAIL, TAILS = 3, 4096
#: Classes of context words in all, and those of them that are tails.
CONTEXTS, CONTEXT_TAILS = 1024, 255
DIM, NOISE, BATCH, RATE, WARM = 16, 128, 1024, 0.03, 1.0
ROUNDS, SHARD_TOKENS = 4, 2_000_000
#: Bytes of text that are cut into words at once.
SLICE = 1 << 20
#: Tokens that are shuffled together before they are learned from.
BUFFER = 1 << 17
#: Rows that averaging ends with before the last.
AVERAGERS = 8
#: Hash that stands for the end of a text.
END = np.uint64(0x5851F42D4C957F2D)
STOP = 0  # row of the end; rows 1 to TAILS are tails


def sequence(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and tails of all tokens, an end after each text, and offsets by text."""
    texts = len(w.first) - 1
    first = w.first + np.arange(texts + 1)
    at = np.arange(len(w.hash)) + w.doc
    out, tails = np.full(len(w.hash) + texts, END), np.zeros(len(w.hash) + texts, np.int32)
    out[at], tails[at] = w.hash, 1 + (w.tails(TAIL) % U64(TAILS)).astype(np.int32)
    return out, tails, first


class Vocabulary:
    """Frequent words with their counts, sorted by hash; rows of the model; masses of the tails' classes."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, tails: np.ndarray, tail_tokens: np.ndarray, tail_types: np.ndarray, own: int):
        """hashes, counts, tails: of the frequent words; tail_tokens, tail_types: of all words by tail, place 0 being the end."""
        rank = np.lexsort((hashes, -counts))
        rank = rank[hashes[rank] != END][:own]
        self.size = 1 + TAILS + len(rank)
        rows = tails.astype(np.int32).copy()
        rows[rank] = np.arange(1 + TAILS, self.size)
        self.tokens, self.types = int(tail_tokens.sum()), int(tail_types.sum())
        rest_tokens = tail_tokens - np.bincount(tails[rank], counts[rank], 1 + TAILS).astype(np.int64)
        rest_types = tail_types - np.bincount(tails[rank], minlength=1 + TAILS)
        self.mass = np.log10(rest_tokens + rest_types + 1.0)  # the last one is for unseen words
        share = np.concatenate([rest_tokens + rest_types + 1, counts[rank] + 1]).astype(np.float64)
        self.share = share / share.sum()  # what the base gives to each row, noise and first bias of the model
        most = CONTEXTS - 1 - CONTEXT_TAILS
        coarse = lambda t: np.where(t > 0, 1 + t % CONTEXT_TAILS, STOP)
        self.context = np.concatenate([coarse(np.arange(1 + TAILS)), coarse(tails[rank])]).astype(np.int32)
        self.context[1 + TAILS : 1 + TAILS + most] = np.arange(1 + CONTEXT_TAILS, 1 + CONTEXT_TAILS + min(most, len(rank)))
        order = np.argsort(hashes)
        self.hash, self.count, self.row = hashes[order], counts[order], rows[order]

    def find(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.hash):
            return np.full(len(tokens), -1)
        at = np.minimum(np.searchsorted(self.hash, tokens), len(self.hash) - 1)
        return np.where(self.hash[at] == tokens, at, -1)

    def rows(self, at: np.ndarray, tails: np.ndarray) -> np.ndarray:
        return np.where(at >= 0, self.row[at], tails) if len(self.hash) else tails


def contexts(classes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The classes one and two before each token; before a text's begin there are ends."""
    one, two = np.full(len(classes), STOP), np.full(len(classes), STOP)
    one[1:], two[2:] = classes[:-1], classes[:-2]
    begin = first[:-1]
    one[begin] = STOP
    two[begin] = STOP
    later = begin[begin + 1 < first[1:]] + 1
    two[later] = STOP
    return one, two


class Model:
    """Parameters and their training."""

    def __init__(self, share: np.ndarray, n_contexts: int = CONTEXTS, dim: int = DIM):
        rng = np.random.default_rng(11)
        draw = lambda k: (rng.standard_normal((k, dim)) * 0.1).astype(np.float32)
        self.R, self.P, self.Q = np.zeros((len(share), dim), np.float32), draw(n_contexts), draw(n_contexts)  # at first the base
        self.b = np.log(share).astype(np.float32)[:, None]
        self.upto, self.noise = np.cumsum(share), np.log(share * NOISE).astype(np.float32)
        self.sums = {k: np.full(len(getattr(self, k)), WARM, np.float32) for k in "RPQb"}
        self.rng = np.random.default_rng(13)

    def parameters(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.R, self.P, self.Q, self.b)])

    def set_parameters(self, flat_: np.ndarray) -> None:
        at = 0
        for name in "RPQb":
            old = getattr(self, name)
            setattr(self, name, flat_[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size

    def _step(self, name: str, order: np.ndarray, rows: np.ndarray, grad: np.ndarray) -> None:
        """Per-row adaptive step with the summed gradients of each row; order sorts rows."""
        ranked = rows[order]
        begin = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
        total, of = np.add.reduceat(grad[order], begin, axis=0), ranked[begin]
        self.sums[name][of] += np.einsum("ij,ij->i", total, total) / total.shape[1]
        getattr(self, name)[of] += RATE * total / np.sqrt(self.sums[name][of])[:, None]

    @staticmethod
    def _order(rows: np.ndarray, size: int) -> np.ndarray:
        """What sorts the rows; numbers of two bytes are sorted by their digits."""
        return np.argsort(rows.astype(np.uint16) if size <= 1 << 16 else rows, kind="stable")

    def learn(self, w: np.ndarray, c1: np.ndarray, c2: np.ndarray) -> None:
        """One noise-contrastive step on a batch; all its tokens share the noise words."""
        noise = np.minimum(np.searchsorted(self.upto, self.rng.random(NOISE)), len(self.b) - 1)
        q, r, rn = self.P[c1] + self.Q[c2], self.R[w], self.R[noise]
        real = np.einsum("ij,ij->i", q, r) + self.b[w, 0] - self.noise[w]
        false = q @ rn.T + (self.b[noise, 0] - self.noise[noise])
        g = 1 / (1 + np.exp(np.clip(real, -30, 30)))
        gn = np.maximum(false, -30, out=false)
        np.exp(np.negative(gn, out=gn), out=gn)
        np.divide(-1, np.add(gn, 1, out=gn), out=gn)
        gq = g[:, None] * r + gn @ rn
        self._step("P", self._order(c1, len(self.P)), c1, gq)
        self._step("Q", self._order(c2, len(self.Q)), c2, gq)
        both = np.concatenate([w, noise])
        order = self._order(both, len(self.R))
        self._step("R", order, both, np.concatenate([g[:, None] * q, gn.T @ q]))
        self._step("b", order, both, np.concatenate([g, gn.sum(0)])[:, None])

    def normalisers(self, block: int = 4096) -> np.ndarray:
        """z[c1, c2] = log of the sum of exp(score) over all rows."""
        k = len(self.P)
        m1, m2, z = np.full((k, 1), -np.inf, np.float32), np.full((k, 1), -np.inf, np.float32), np.zeros((k, k), np.float64)
        parts = lambda i: (self.P @ self.R[i : i + block].T + self.b[i : i + block, 0], self.Q @ self.R[i : i + block].T)
        for i in range(0, len(self.R), block):
            s1, s2 = parts(i)
            m1, m2 = np.maximum(m1, s1.max(1, keepdims=True)), np.maximum(m2, s2.max(1, keepdims=True))
        for i in range(0, len(self.R), block):
            s1, s2 = parts(i)
            z += np.exp(s1 - m1) @ np.exp(s2 - m2).T
        return (np.log(z) + m1 + m2.T).astype(np.float32)

    def log10(self, z: np.ndarray, w: np.ndarray, c1: np.ndarray, c2: np.ndarray) -> np.ndarray:
        """Log-probability of each row after its contexts."""
        s = np.einsum("ij,ij->i", self.P[c1] + self.Q[c2], self.R[w]) + self.b[w, 0] - z[c1, c2]
        return s.astype(np.float64) / math.log(10)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    held = F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(7)) == 2, F.lit(False))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), held.alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def count_tokens(train: DataFrame) -> DataFrame:
    """(token, tail, n) over all texts; a token is the hash of a word or of the end, tail its class by the last bytes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, limit=SLICE):
            hashes, tails, _ = sequence(Words(*flat(batch.column(0))))
            tokens, at, n = np.unique(hashes, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(tails[at].astype(np.int32)), pa.array(n)], ["token", "tail", "n"])

    return train.select("text").mapInArrow(count, "token long, tail int, n long").groupBy("token").agg(F.min("tail").alias("tail"), F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, own: int = OWN, broad: int = BROAD) -> Vocabulary:
    """The end and the words from a count on that at most `broad` words reach, with the totals of all words by tail."""
    height = F.floor(F.log2("n") * 16).cast("int")
    steps = sorted(map(tuple, counts.groupBy(height.alias("h")).agg(F.count(F.lit(1)).alias("k")).collect()), reverse=True)  # a row for each sixteenth of a power of two
    least, room = 1 << 30, broad
    for h, k in steps:
        if k > room:
            break
        least, room = h, room - k
    top = counts.where((height >= least) | (F.col("token") == int(END.view(np.int64)))).toArrow()  # the end and `broad` words at most
    tail_tokens, tail_types = np.zeros(1 + TAILS, np.int64), np.zeros(1 + TAILS, np.int64)
    for tail, n, k in counts.groupBy("tail").agg(F.sum("n"), F.count(F.lit(1))).collect():  # TAILS + 1 rows at most
        tail_tokens[tail], tail_types[tail] = n, k
    return Vocabulary(top["token"].to_numpy().view(U64), top["n"].to_numpy(), top["tail"].to_numpy(), tail_tokens, tail_types, own)


def fit(train: DataFrame, vocab: Vocabulary, dim: int = DIM, rounds: int | None = None, shard_tokens: int | None = None) -> Model:
    """Rounds of passes over shards of all training texts, averaged after each.  train: doc_id, text."""
    rounds, shard_tokens = rounds or ROUNDS, shard_tokens or SHARD_TOKENS
    shards = max(1, -(-vocab.tokens // (shard_tokens * rounds)))
    model = Model(vocab.share, dim=dim)
    shared = ship(train.sparkSession, vocab)
    mark = F.xxhash64("doc_id", "text")
    dealt = train.select(mark.alias("mark"), "text").select("mark", F.pmod("mark", F.lit(rounds)).alias("round"), F.pmod(F.shiftright("mark", 20), F.lit(shards)).alias("shard"), "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared()
        kind = np.uint16 if vocab.size <= 1 << 16 else np.int32
        for batch in small_batches(batches, limit=SLICE):
            tokens, tails, first = sequence(Words(*flat(batch.column(2))))
            rows = vocab.rows(vocab.find(tokens), tails).astype(kind)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([rows[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary())], ["shard", "mark", "rows"])

    kind = "weight double, parameters binary"

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, total = 0.0, None
        for batch in batches:
            for n, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = np.frombuffer(raw, np.float32).astype(np.float64) * n
                weight, total = weight + n, x if total is None else total + x
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([weight]), pa.array([(total / weight).astype(np.float32).tobytes()], pa.binary())], ["weight", "parameters"])

    for r in range(rounds):
        start = train.sparkSession.sparkContext.broadcast(model.parameters())

        def pass_(batches: Iterator[pa.RecordBatch], start=start) -> Iterator[pa.RecordBatch]:
            vocab = shared()
            size = np.uint16 if vocab.size <= 1 << 16 else np.int32
            model = held = last = None
            seen = 0

            def flush() -> None:
                w = np.concatenate(held).astype(np.int64)
                first = np.cumsum([0, *map(len, held)])
                c1, c2 = contexts(vocab.context[w], first)
                order = rng.permutation(len(w))
                for i in range(0, len(order), BATCH):
                    k = order[i : i + BATCH]
                    model.learn(w[k], c1[k], c2[k])
                held.clear()

            def done() -> pa.RecordBatch:
                if held:
                    flush()
                return pa.RecordBatch.from_arrays([pa.array([float(seen)]), pa.array([model.parameters().tobytes()], pa.binary())], ["weight", "parameters"])

            for batch in batches:
                for shard, raw in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                    if shard != last:
                        if model is not None:
                            yield done()
                        model, held, seen, size_held, last = Model(vocab.share, dim=dim), [], 0, 0, shard
                        model.set_parameters(start.value)
                        rng = np.random.default_rng(5 + shard)
                    held.append(np.frombuffer(raw, size))
                    seen += len(held[-1])
                    size_held += len(held[-1])
                    if size_held >= BUFFER:
                        flush()
                        size_held = 0
            if model is not None:
                yield done()

        mine = dealt.where(F.col("round") == r).select("shard", "mark", "text").mapInArrow(encode, "shard long, mark long, rows binary")
        passed = mine.repartition(shards, "shard").sortWithinPartitions("shard", "mark").mapInArrow(pass_, kind)
        if shards > AVERAGERS:
            passed = passed.repartition(AVERAGERS).mapInArrow(average, kind)
        for row in passed.repartition(1).mapInArrow(average, kind).collect():
            model.set_parameters(np.frombuffer(row.parameters, np.float32))
    return model


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", own: int = OWN, broad: int = BROAD, dim: int = DIM) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    A null or empty text is its end alone.  Rows whose crc32(id as text) mod 7 is 2 are held out; a
    null id isn't.  Repeated rows are each scored, texts of any length whole.  Without training texts
    every count is nought.  An empty table gives no rows.
    """
    bound_batches(docs.sparkSession)
    rows = _rows(docs, id_col, text_col)
    train = rows.where("not held_out")
    counts = durable(count_tokens(train))
    vocab = vocabulary(counts, own, broad)
    model = fit(train.select("doc_id", "text"), vocab, dim)
    shared = ship(docs.sparkSession, (vocab, model.parameters(), model.normalisers()))
    floor = float(np.log10(vocab.tokens + vocab.types + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, parameters, z = shared()
        model = Model(vocab.share, dim=dim)
        model.set_parameters(parameters)
        base_of = np.log10(vocab.count + 1.0) - floor
        tail_of = np.where((vocab.row > 0) & (vocab.row <= TAILS), np.log10(vocab.count + 1.0), 0.0)
        for batch in small_batches(batches, limit=SLICE):
            tokens, tails, first = sequence(Words(*flat(batch.column(3))))
            at = vocab.find(tokens)
            w = vocab.rows(at, tails)
            c1, c2 = contexts(vocab.context[w], first)
            known = at >= 0
            mine = model.log10(z, w, c1, c2) - np.where((w > 0) & (w <= TAILS), vocab.mass[np.minimum(w, TAILS)], 0.0)
            if len(vocab.hash):
                base = np.where(known, base_of[at], 0.0)
                mine += np.where(known, tail_of[at], 0.0)
            else:
                base = np.zeros(len(tokens))
            doc = np.repeat(np.arange(batch.num_rows), np.diff(first))
            # words whose counts aren't here: once a document, with how often
            far, far_doc = tokens[~known].view(np.int64), doc[~known]
            order = np.lexsort((far, far_doc))
            far, far_doc = far[order], far_doc[order]
            begin = np.flatnonzero(np.append(True, (far[1:] != far[:-1]) | (far_doc[1:] != far_doc[:-1]))) if len(far) else np.zeros(0, int)
            often = np.diff(np.append(begin, len(far)))
            keys = batch.select([0, 1, 2])
            n = batch.num_rows
            table = [(np.arange(n), keys.column(2).to_numpy(), np.diff(first), sums_by(known.astype(float), first).round().astype(np.int64), sums_by(base, first), sums_by(mine, first), np.ones(n, np.int64)), (far_doc[begin], far[begin], often, np.zeros(len(begin), np.int64), np.zeros(len(begin)), np.zeros(len(begin)), np.zeros(len(begin), np.int64))]
            rows_, token, n_tok, n_known, base_, mine_, whole = (np.concatenate(x) for x in zip(*table, strict=True))
            k = keys.take(pa.array(rows_))
            yield pa.RecordBatch.from_arrays([*k.columns, pa.array(token), pa.array(n_tok), pa.array(n_known), pa.array(base_), pa.array(mine_), pa.array(whole)], ["doc_id", "held_out", "body", "token", "n", "n_known", "base", "own", "whole"])

    keyed = rows.select("doc_id", "held_out", F.xxhash64("text").alias("body"), "text")
    # rows of documents (whole 1) bring a hash of their own as token, so that they don't meet in one task
    each = keyed.mapInArrow(run, "doc_id long, held_out boolean, body long, token long, n long, n_known long, base double, own double, whole long")
    found = each.join(counts.select("token", F.col("n").alias("c")), "token", "left")
    c, far = F.coalesce(F.col("c"), F.lit(0)), F.col("whole") == 0
    total = found.groupBy("doc_id", "held_out", "body").agg(
        F.sum("whole").alias("rows"),
        F.sum(F.when(~far, F.col("n")).otherwise(0)).alias("n_tokens"),
        F.sum(F.when(far & (c > 0), F.col("n")).otherwise(F.col("n_known"))).alias("n_known"),
        F.sum(F.when(far, F.col("n") * (F.log10(c + 1.0) - floor)).otherwise(F.col("base"))).alias("base_score"),
        F.sum(F.when(far, F.col("n") * F.log10(c + 1.0)).otherwise(F.col("own"))).alias("score"),
    )
    # repeated rows have come together: each is given back
    share = lambda x: F.col(x) / F.col("rows")
    return total.select("doc_id", "held_out", F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("copy"), share("n_tokens").cast("long").alias("n_tokens"), share("n_known").cast("long").alias("n_known"), F.lit(vocab.tokens).cast("long").alias("train_tokens"), share("base_score").alias("base_score"), share("score").alias("score")).drop("copy")
