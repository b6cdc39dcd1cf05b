"""Writers of the export: Parquet, message-packed files, XML, and a manifest with checksums."""

from __future__ import annotations

import io
import struct
import uuid
from collections.abc import Iterator
from decimal import Decimal
from xml.etree import ElementTree

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Elements of an XML tree, which is a dimension's.
MOST = 5_000_000


def pack(x) -> bytes:
    """MessagePack of None, bool, int, float, str, bytes, lists and maps (keys sorted)."""
    if x is None:
        return b"\xc0"
    if isinstance(x, bool):
        return b"\xc3" if x else b"\xc2"
    if isinstance(x, int):
        if 0 <= x < 128 or -32 <= x < 0:
            return struct.pack("b" if x < 0 else "B", x)
        for code, fmt in ((0xCC, ">B"), (0xCD, ">H"), (0xCE, ">I"), (0xCF, ">Q")) if x > 0 else ((0xD0, ">b"), (0xD1, ">h"), (0xD2, ">i"), (0xD3, ">q")):
            try:
                return bytes([code]) + struct.pack(fmt, x)
            except struct.error:
                continue
        raise OverflowError(x)
    if isinstance(x, float):
        return b"\xcb" + struct.pack(">d", x)
    if isinstance(x, str):
        raw = x.encode()
        return _head(len(raw), 0xA0, 32, (0xD9, 0xDA, 0xDB)) + raw
    if isinstance(x, bytes):
        return _head(len(x), 0, 0, (0xC4, 0xC5, 0xC6)) + x
    if isinstance(x, dict):
        return _head(len(x), 0x80, 16, (None, 0xDE, 0xDF)) + b"".join(pack(k) + pack(x[k]) for k in sorted(x))
    return _head(len(x), 0x90, 16, (None, 0xDC, 0xDD)) + b"".join(map(pack, x))


def _head(n: int, fix: int, fixed: int, codes: tuple) -> bytes:
    if n < fixed:
        return bytes([fix | n])
    for code, fmt, most in zip(codes, (">B", ">H", ">I"), (1 << 8, 1 << 16, 1 << 32), strict=True):
        if code is not None and n < most:
            return bytes([code]) + struct.pack(fmt, n)
    raise OverflowError(n)


def header(n: int, kind: str) -> bytes:
    """The head of a map or list of n entries."""
    return _head(n, *((0x80, 16, (None, 0xDE, 0xDF)) if kind == "map" else (0x90, 16, (None, 0xDC, 0xDD))))


def tail_of(c: int) -> int:
    """Bytes after the first one, c, of a value that isn't a container; below 0: bytes of a length, which comes first."""
    if c < 0x80 or c >= 0xE0 or c in (0xC0, 0xC2, 0xC3):
        return 0
    if 0xA0 <= c < 0xC0:
        return c & 31
    sizes = {0xC4: -1, 0xC5: -2, 0xC6: -4, 0xCB: 8, 0xCC: 1, 0xCD: 2, 0xCE: 4, 0xCF: 8, 0xD0: 1, 0xD1: 2, 0xD2: 4, 0xD3: 8, 0xD9: -1, 0xDA: -2, 0xDB: -4}
    return sizes[c]


def unpack(raw: bytes):
    """The inverse of pack, for checks."""

    def one(i: int):
        c = raw[i]
        if c < 0x80 or c >= 0xE0:
            return (c if c < 0x80 else c - 256), i + 1
        if c in (0xC0, 0xC2, 0xC3):
            return {0xC0: None, 0xC2: False, 0xC3: True}[c], i + 1
        if c in (fixed := {0xCB: ">d", 0xCC: ">B", 0xCD: ">H", 0xCE: ">I", 0xCF: ">Q", 0xD0: ">b", 0xD1: ">h", 0xD2: ">i", 0xD3: ">q"}):
            return struct.unpack_from(fixed[c], raw, i + 1)[0], i + 1 + struct.calcsize(fixed[c])
        sized = {0xD9: ("s", ">B"), 0xDA: ("s", ">H"), 0xDB: ("s", ">I"), 0xC4: ("b", ">B"), 0xC5: ("b", ">H"), 0xC6: ("b", ">I"), 0xDE: ("m", ">H"), 0xDF: ("m", ">I"), 0xDC: ("l", ">H"), 0xDD: ("l", ">I")}
        if c in sized:
            kind, fmt = sized[c]
            n, i = struct.unpack_from(fmt, raw, i + 1)[0], i + 1 + struct.calcsize(fmt)
        else:
            kind, n, i = ("m", c & 15, i + 1) if c < 0x90 else ("l", c & 15, i + 1) if c < 0xA0 else ("s", c & 31, i + 1)
        if kind in "sb":
            return (raw[i : i + n].decode() if kind == "s" else raw[i : i + n]), i + n
        out = []
        for _ in range(n * (2 if kind == "m" else 1)):
            x, i = one(i)
            out.append(x)
        return (dict(zip(out[::2], out[1::2], strict=True)) if kind == "m" else out), i

    return one(0)[0]


#: Files of both export formats, and their versions.
FILES = ("word_lookup", "word_islands", "word_towns", "island_meta", "background", "constants", "compounds", "word_detail", "town_meta", "reef_meta", "bucket_words")
LEGACY_FILES = ("word_lookup", "word_reefs", "reef_meta", "island_meta", "background", "compounds", "constants", "reef_edges", "word_reef_detail", "sub_reef_meta")
VERSION, LEGACY_VERSION = "3.1", "7.0"
#: Keys that records must have.
REQUIRED = {"island_meta": ("arch_id", "name", "n_words", "iqf", "avg_specificity", "noun_frac", "verb_frac", "adj_frac", "adv_frac"), "constants": ("N_ISLANDS", "N_TOWNS", "N_REEFS", "N_ARCHS", "domainless_word_ids", "bucket_only_word_ids")}
LEGACY_REQUIRED = {"reef_meta": ("hierarchy_addr", "n_words", "name", "valence", "avg_specificity", "noun_frac", "verb_frac", "adj_frac", "adv_frac"), "constants": ("N_REEFS", "N_ISLANDS", "N_ARCHS")}
U16 = 65535


class Folder:
    """Whole files in a folder of any file system that Spark can reach."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self.path = spark.sparkContext._jvm, path.rstrip("/")
        where = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(where)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def write(self, name: str, raw: bytes) -> None:
        out = self._fs.create(self._at(name), True)
        out.write(bytearray(raw))
        out.close()

    def read(self, name: str) -> bytes | None:
        if not self._fs.exists(self._at(name)):
            return None
        stream = self._fs.open(self._at(name))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()


def plain(x):
    """Rows as lists and decimals as integers, for packing."""
    if isinstance(x, (list, tuple)):
        return [plain(y) for y in x]
    return int(x) if isinstance(x, Decimal) else x


def bounded(df: DataFrame) -> Iterator:
    """The rows of a dimension one by one; refuses more than MOST."""
    if df.limit(MOST + 1).count() > MOST:
        raise ValueError(f"more than {MOST} elements in one XML file: write them as a table")
    return df.toLocalIterator()


def write_tree_xml(spark: SparkSession, rows: DataFrame, folder: str, name: str, outer: str, inner: str) -> None:
    """One XML file of outer elements with their inner ones, each with a name.  rows: outer, inner (null: none); they are dimensions."""
    tree = ElementTree.Element(f"{outer}s")
    nodes: dict[str, ElementTree.Element] = {}
    for r in bounded(rows.orderBy(outer, inner)):
        node = nodes.get(r[outer])
        if node is None:
            node = nodes[r[outer]] = ElementTree.SubElement(tree, outer, name=str(r[outer]))
        if r[inner] is not None:
            ElementTree.SubElement(node, inner, name=str(r[inner]))
    ElementTree.indent(tree)
    Folder(spark, folder).write(name, ElementTree.tostring(tree, "utf-8", xml_declaration=True))


def replace_partitions(new: DataFrame, path: str, key: str) -> None:
    """Rows of the keys that `new` has take the place of all rows with these keys; other keys' rows stay.  Writing twice changes nothing."""
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def write_xml(df: DataFrame, path: str, root: str, row: str) -> None:
    df.write.mode("overwrite").format("xml").option("rootTag", root).option("rowTag", row).save(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def insert_or_ignore(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of old, and those of new whose key is free; of equal new keys the first in the order of all columns."""
    from pyspark.sql import Window

    nth = F.row_number().over(Window.partitionBy(*key).orderBy(*new.columns))
    fresh = new.withColumn("nth", nth).where("nth = 1").drop("nth").join(old.select(*key), key, "left_anti")
    return old.unionByName(fresh, allowMissingColumns=True)


def violations(df: DataFrame, key: list[str], u8: tuple[str, ...] = ()) -> DataFrame:
    """One row, n: keys that stand in several rows, and weights outside 0 to 255."""
    twice = df.groupBy(*key).agg(F.count(F.lit(1)).alias("k")).agg(F.count_if(F.col("k") > 1).alias("twice"))
    beyond = sum((F.count_if(~F.col(c).between(0, 255)) for c in u8), F.lit(0))
    return df.agg(beyond.alias("beyond")).crossJoin(F.broadcast(twice)).select((F.col("beyond") + F.col("twice")).cast("long").alias("n"))  # one row


def write_npy_batches(vectors: DataFrame, path: str, size: int = 10_000) -> DataFrame:
    """The column v (vectors of one length) as .npy files batch_NNNNN.npy of float32, `size` rows at most; number and rows of each file.

    Rows are dealt out by ranges of their numbers; a batch is written by one task, under another name until it is whole.
    """
    from pyspark.sql import Window

    tasks = vectors.select("v", F.monotonically_increasing_id().alias("at"), F.spark_partition_id().alias("task"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = tasks.groupBy("task").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first")).withColumn("before", before)  # a row a task
    numbered = tasks.join(F.broadcast(counts), "task").withColumn("nth", F.col("before") + F.col("at") - F.col("first"))

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        number = int(pdf["batch"].iloc[0])
        where, folder = fs.FileSystem.from_uri(path)
        where.create_dir(folder, recursive=True)
        raw = io.BytesIO()
        np.save(raw, np.stack(pdf.sort_values("nth")["v"]).astype("<f4"))
        temporary = f"{folder}/.{uuid.uuid4().hex}"
        with where.open_output_stream(temporary) as out:
            out.write(raw.getbuffer())
        where.move(temporary, f"{folder}/batch_{number:05d}.npy")
        return pd.DataFrame({"batch": [number], "rows": [len(pdf)]})

    batches = numbered.select("v", "nth", F.expr(f"nth div {size}").alias("batch"))
    return batches.groupBy("batch").applyInPandas(write, "batch long, rows long")
