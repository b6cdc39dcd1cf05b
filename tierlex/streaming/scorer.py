"""A stream of texts against static word weights, and windowed totals of its scores."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.text import by_token, group_sums, scored


def read_texts(spark: SparkSession, folder: str, per_trigger: int = 4) -> DataFrame:
    """Parquet files of (doc_id, text) as they come in."""
    return spark.readStream.schema("doc_id long, text string").option("maxFilesPerTrigger", per_trigger).parquet(folder)


def score_stream(texts: DataFrame, weights: DataFrame, background: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Score every micro-batch with the batch operator; the sink gets its rows and number."""
    packed = by_token(weights)

    def each(batch: DataFrame, number: int) -> None:
        tokens = batch.select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("(\\p{L}+)"), 1))).alias("token"))
        sink(scored(group_sums(tokens, *packed), background), number)

    return texts.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed(events: DataFrame, late: str = "1 day", size: str = "6 hours") -> DataFrame:
    """Count and total of values by type in tumbling windows; what comes later than `late` is left out."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", size), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")
