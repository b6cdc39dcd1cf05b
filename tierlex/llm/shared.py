"""Durable intermediates, connected components, and names that can't clash."""

from __future__ import annotations

import atexit
import gc
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where it is unset, a temporary one, in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="tierlex-")
        atexit.register(shutil.rmtree, folder, True)
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


#: Rows and bytes of an Arrow batch on its way to or from Python.
ARROW_ROWS, ARROW_BYTES = 1000, 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Small Arrow batches from now on in this session: whole texts are long, and a task holds a batch several times."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def _forget(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session may be gone at exit
        pass


_written: list[str] = []  # paths of durable tables of this process, in the order of writing


def durable(df: DataFrame) -> DataFrame:
    """The same rows as a table in the shared folder: lost executors cost no more than what reads it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tierlex-{os.getpid()}-{uuid.uuid4().hex}"
    gc.collect()
    df.write.option("compression", "zstd").parquet(path)
    # the plan that was run is garbage now: without it Spark drops its shuffle files
    spark.sparkContext._jvm.System.gc()
    _written.append(path)
    atexit.register(_forget, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def tables_written() -> int:
    return len(_written)


def settled(df: DataFrame, since: int) -> DataFrame:
    """A durable table of the rows, which takes the place of all that were written after the first `since`: what it was made of is deleted."""
    out = durable(df)
    for path in _written[since:-1]:
        _forget(df.sparkSession, path)
    del _written[since:-1]
    return out


def forget(df: DataFrame) -> None:
    """Delete a durable table that nothing reads any more."""
    for path in {os.path.dirname(f) for f in df.inputFiles()}:
        _forget(df.sparkSession, path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have, whatever the case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Edges up to this number are joined up by one task; more of them by rounds of star steps.
FEW_EDGES = 50_000


def _union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    for batch in batches:
        for v, u in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(v), find(u)
            root[max(a, b)] = min(a, b)
    nodes = list(root)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], ["node", "root"])


def components(edges: DataFrame, a: str = "a", b: str = "b", few: int = FEW_EDGES) -> DataFrame:
    """(node, root) for every node of an edge to another: root is the least node of its connected component.

    More than `few` edges go through alternating large-star and small-star steps; both only take minima
    by node, so a hub of any degree is pre-aggregated, and the joins can be split by adaptive execution.
    """
    hi, lo = F.greatest(a, b), F.least(a, b)
    e = durable(edges.select(hi.alias("v"), lo.alias("u")).where("v <> u").distinct())
    mark = lambda d: tuple(d.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())
    seen = mark(e)
    if seen[0] <= few:
        return e.repartition(1).mapInArrow(_union, "node long, root long")
    while True:
        both = e.select(F.col("v").alias("n"), F.col("u").alias("m")).union(e.select(F.col("u").alias("n"), F.col("v").alias("m")))
        least = both.groupBy("n").agg(F.least(F.col("n"), F.min("m")).alias("low"))
        large = both.join(least, "n").where("m > n").select(F.col("m").alias("v"), F.col("low").alias("u")).distinct()
        small = large.groupBy("v").agg(F.min("u").alias("low"))
        step = large.join(small, "v").select(F.col("u").alias("v"), F.col("low").alias("u")).where("v <> u").union(small)
        e = durable(step.distinct())
        if (now := mark(e)) == seen:
            break
        seen = now
    return e.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("root")).union(e.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())


#: Values of a row's place in the order of hashes.
SPAN = 1 << 32


def hash_place(c: str):
    return F.pmod(F.xxhash64(c), F.lit(SPAN))


def first_by_hash(rows: DataFrame, key: str, of: str, most: int | dict) -> DataFrame:
    """The rows of each key whose hash of `of` is small enough that about a fifth more than `most` (or most[key]) are left.

    Keys are few (classes, languages); their numbers of rows are counted first, so that what is sorted
    by the hash afterwards is bounded by `most`, however many rows a key has.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(key).agg(F.count(F.lit(1))).collect()}
    few, rest = F.lit(False), []
    for value, n in counts.items():
        want = most[value] if isinstance(most, dict) else most
        bound = SPAN if n <= want else min(SPAN, int(SPAN * (1.2 * want + 100) / n))
        if bound < SPAN:
            few = few | ((F.col(key) == value) & (hash_place(of) < bound))
        else:
            rest.append(value)
    return rows.where(few | F.col(key).isin(rest))


def ship(spark: SparkSession, value) -> Callable:
    """A function that gives the value on executors: it is broadcast with its classes, which they needn't have."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: cloudpickle.loads(sent.value)
