"""Running scores of conversations: state by conversation, timers that close idle ones, and the last rows of each."""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

TURNS = "conv_id long, turn long, role string, text string"
#: Rows that a conversation's state gives whenever it changes.
TOP = "conv_id long, turns long, nth int, grp string, score long, closed boolean"
#: A conversation's state: its turns, the groups with their sums, and when it counts as idle.
SUMS = "turns long, grps array<string>, scores array<long>, idle long"
#: Read when a stream starts: the store that can hold a state and timers of a key, and no batches without data, of which timers by the clock would ask for ever more.
_STREAM = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", "spark.sql.streaming.noDataMicroBatches.enabled": "false"}


def read_turns(spark: SparkSession, path: str, per_trigger: int = 64) -> DataFrame:
    """Parquet files of turns as they come into a folder; or one file, as a stream's source is a folder where it looks for that name only."""
    stream = spark.readStream.schema(TURNS).option("maxFilesPerTrigger", per_trigger)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(where).isFile():
        return stream.option("pathGlobFilter", where.getName()).parquet(where.getParent().toString())
    return stream.parquet(path)


def turn_lists(turns: DataFrame, weights: DataFrame) -> DataFrame:
    """conv_id, grps, weights: a row for each different word of a turn that a group weighs, with all its groups, and one without groups for the turn itself."""
    whole = turns.select("conv_id", "turn", "text").repartition("conv_id", "turn")  # a file of turns is one task's, however long its words take
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit("(\\p{L}+)"), 1))
    cut = whole.select("conv_id", F.explode(F.array_union(words, F.array(F.lit("")))).alias("token"))
    known = weights.where("grp is not null and token <> ''").select("token", F.struct("grp", F.col("weight").cast("long").alias("weight")).alias("x"))
    lists = known.groupBy("token").agg(F.collect_list("x").alias("x")).select("token", F.col("x.grp").alias("grps"), F.col("x.weight").alias("weights"))
    return cut.join(lists, "token", "left").where("grps is not null or token = ''").select("conv_id", "grps", "weights")


def turn_hits(turns: DataFrame, weights: DataFrame) -> DataFrame:
    """conv_id, grp, weight: a row for each different word of a turn and group that weighs it, and one without group for the turn itself."""
    return turn_lists(turns, weights).select("conv_id", F.explode_outer(F.arrays_zip("grps", "weights")).alias("x")).select("conv_id", F.col("x.grps").alias("grp"), F.col("x.weights").alias("weight"))


class Running(StatefulProcessor):
    """Sums of weights by group, and turns, of one conversation; the best groups after every batch that holds some of it.

    A conversation that is idle for `idle_ms` gives its rows once more, closed, and its state goes, with the next batch
    that comes in.  Turns that come afterwards begin anew.  All of a conversation is one value of the state, as every
    call to the store is a round trip: a few for a conversation and batch, however many groups it has.
    """

    def __init__(self, best: int, idle_ms: int):
        self.best, self.idle_ms = best, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", SUMS)

    def _rows(self, key: tuple, turns: int, scores: dict[str, int], closed: bool) -> pd.DataFrame:
        order = sorted((-score, grp) for grp, score in scores.items())[: self.best]
        rows = [(key[0], turns, i, grp, -score, closed) for i, (score, grp) in enumerate(order, 1)]
        return pd.DataFrame(rows or [(key[0], turns, None, None, None, closed)], columns=["conv_id", "turns", "nth", "grp", "score", "closed"])

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        turns, groups, known, at = self.sums.get() or (0, [], [], None)
        scores = dict(zip(groups, known, strict=True))
        for part in rows:
            for hits in part["hits"]:
                if hits is None:
                    turns += 1
                    continue
                found = json.loads(hits)
                for grp, weight in zip(found["grps"], found["weights"], strict=True):
                    scores[grp] = scores.get(grp, 0) + weight
        idle = timerValues.getCurrentProcessingTimeInMs() + self.idle_ms
        if at is not None:
            self.handle.deleteTimer(at)
        self.handle.registerTimer(idle)
        self.sums.update((turns, list(scores), list(scores.values()), idle))
        yield self._rows(key, turns, scores, False)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        held = self.sums.get()
        if held:
            yield self._rows(key, held[0], dict(zip(held[1], held[2], strict=True)), True)
        self.sums.clear()


def run(turns: DataFrame, weights: DataFrame, out: str, checkpoint: str, best: int = 3, idle_ms: int = 3_600_000) -> StreamingQuery:
    """Start the stream on what is there; started again with the same checkpoint it goes on where it ended.

    Each batch is a folder of `out` that a repeated batch overwrites, so a restart leaves no row twice.
    """
    spark = turns.sparkSession
    hits = F.when(F.col("grps").isNotNull(), F.to_json(F.struct("grps", "weights"))).alias("hits")  # arrays of arrays take pandas ten times as long as texts
    state = turn_lists(turns, weights).select("conv_id", hits).groupBy("conv_id").transformWithStateInPandas(Running(best, idle_ms), TOP, "update", "ProcessingTime")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").option("compression", "zstd").parquet(f"{out}/batch={number}")

    before = {name: spark.conf.get(name, None) for name in _STREAM}
    for name, value in _STREAM.items():
        spark.conf.set(name, value)
    try:
        return state.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def latest(spark: SparkSession, out: str) -> DataFrame:
    """The rows that each conversation gave last; those without any scored word have none of a group."""
    rows = spark.read.schema(f"{TOP}, batch long").parquet(out)
    last = rows.groupBy("conv_id").agg(F.max(F.struct("batch", "closed")).alias("last"))
    same = rows.join(last, "conv_id").where("batch = last.batch and closed = last.closed")
    return same.select("conv_id", "turns", "nth", "grp", "score", "closed")
