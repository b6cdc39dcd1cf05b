"""Toxicity by logistic regression with FTRL-proximal updates over hashed features.

Features of a text are the words, their stems, the pairs of neighbours and the pairs with one or two words between
them that occur in it (each counts once), hashed to 2 ** BITS places.  Every coordinate has its own
learning rate, and the L1 penalty keeps most weights at nought, so the model is small enough to
broadcast: at most 2 ** BITS weights, whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import bound_batches, first_by_hash, hash_place, ship
from .textarrays import U64, Words, flat, mix, small_batches

BITS = 20
#: A word also counts as its first bytes, so that inflected forms share a feature.
STEMS = (4, 6)
ALPHA, BETA, L1, L2 = 1.0, 1.0, 6.0, 1.0
EPOCHS = 3
#: Bounds of the training sample: labelled rows of each class, the first by their ids' hashes, and bytes of text in all.
SAMPLE = {1: 5000, 0: 9000}
SAMPLE_BYTES = 64 << 20


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of each occurrence of a feature."""
    h, doc = words.hash, words.doc
    rows, places = [doc] * (1 + len(STEMS)), [h, *(mix(words.stems(n) + U64(n)) for n in STEMS)]
    for gap in (1, 2, 3):
        same = doc[gap:] == doc[:-gap]
        rows.append(doc[gap:][same])
        places.append(mix(h[:-gap][same] * U64(2 * gap + 1) + (h[gap:][same] ^ U64(gap))))
    return np.concatenate(rows), (np.concatenate(places) >> U64(64 - BITS)).astype(np.int64)


def unique_features(rows: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.unique((rows << BITS) | places)
    return keys >> BITS, keys & ((1 << BITS) - 1)


def fit(texts: pa.Array, labels: np.ndarray, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray, float]:
    """Places and values of the weights that aren't nought, and the bias; the same rows give the same model."""
    examples: list[np.ndarray] = []
    for batch in small_batches(iter([pa.RecordBatch.from_arrays([texts], ["text"])]), limit=1 << 20):
        rows, places = unique_features(*features(Words(*flat(batch.column(0)))))
        examples += [x.astype(np.int32) for x in np.split(places, np.searchsorted(rows, np.arange(1, batch.num_rows)))]
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)  # the last is the bias
    order = np.random.default_rng(7)

    def weights(i):
        over = np.abs(z[i]) - np.where(np.asarray(i) == 1 << BITS, 0, L1)
        return np.where(over > 0, -np.sign(z[i]) * over / ((BETA + np.sqrt(n[i])) / ALPHA + L2), 0.0)

    for _ in range(epochs):
        for k in order.permutation(len(examples)):
            i = np.append(examples[k], 1 << BITS)
            w = weights(i)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - labels[k]
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA * w
            n[i] += g * g
    w = weights(np.arange((1 << BITS) + 1))
    places = np.flatnonzero(w[:-1])
    return places, w[places], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: dict[int, int] = SAMPLE) -> tuple[np.ndarray, np.ndarray, float]:
    """Fit on labelled rows whose crc32(id as text) mod 5 isn't 0, at most `sample` of each class.

    Labels that are null, or whose document is missing or has a null text, are left out; a doc_id
    labelled twice counts as toxic if one of its labels says so, and each of its rows is learned from.
    Texts are read whole, in the order of their ids' hashes, until SAMPLE_BYTES are reached.  Without
    labelled rows the score is the same for all texts.
    """
    bound_batches(docs.sparkSession)
    own = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max("toxic").cast("int").alias("toxic"))
    own = own.where(F.pmod(F.crc32(F.col("id").cast("string")), F.lit(5)) != 0)
    # a bit over `sample` of each class are left for the window
    nth = F.row_number().over(Window.partitionBy("toxic").orderBy(hash_place("id"), "id"))
    few = first_by_hash(own, "toxic", "id", {k: sample.get(k, sample[0]) for k in range(2)})
    picked = few.withColumn("nth", nth).where(F.col("nth") <= F.when(F.col("toxic") == 1, sample[1]).otherwise(sample[0])).select("id", "toxic", hash_place("id").alias("place"))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("text is not null")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if size <= SAMPLE_BYTES:
                held.append(batch)
                size += batch.nbytes
        table = pa.Table.from_batches(held, pa.schema([("id", pa.int64()), ("text", pa.string()), ("toxic", pa.int32()), ("place", pa.int64())]))
        places, values, bias = fit(table["text"].combine_chunks(), table["toxic"].to_numpy().astype(float))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(places, -1)), pa.array(np.append(values, bias))], ["place", "value"])

    # one task learns from the sample, which is bounded; the driver gets 2 ** BITS weights at most
    table = texts.join(F.broadcast(picked), "id").select("id", "text", "toxic", "place").repartition(1).sortWithinPartitions("place", "id", "text").mapInArrow(learn, "place long, value double").toArrow()
    places, values = table["place"].to_numpy(), table["value"].to_numpy()
    return (places[:-1], values[:-1], float(values[-1])) if len(places) else (places, values, 0.0)


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    held_out: crc32 of the id as text, modulo 5, is 0 (a null id is not held out).  A null or empty
    text has the score of the bias alone.  Repeated rows are each scored; an empty table gives no rows.
    """
    bound_batches(docs.sparkSession)
    shared = ship(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, values, bias = shared()
        table = np.zeros(1 << BITS)
        table[places] = values
        used = table != 0
        for batch in small_batches(batches, limit=1 << 20):
            rows, at = features(Words(*flat(batch.column(2))))
            hit = used[at]
            rows, at = unique_features(rows[hit], at[hit])
            total = np.bincount(rows, table[at], batch.num_rows) + bias
            p = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    held = F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(5)) == 0, F.lit(False))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), held.alias("held_out"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
