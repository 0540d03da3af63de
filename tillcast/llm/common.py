"""Helpers shared by the operators of this subpackage: table reading, Arrow batches of
bounded size and connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillcast.session import materialize

# Text bytes handled at once inside a task (one longer text is handled alone).
SLICE_BYTES = 8 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_slices(batches, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches``, cut so that a slice's texts stay within ``limit`` bytes."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_pylist()
        start = total = 0
        for i, n in enumerate(sizes):
            if i > start and total + n > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < batch.num_rows:
            yield batch.slice(start)


def release() -> None:
    """Gives memory that a worker process has freed but still holds back to the system: workers are
    used again, so that what one step needed would otherwise be missing in the next."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
    if trim is not None:
        trim(0)


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """The setting has this value meanwhile."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def utf8(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The column's values as UTF-8 bytes, null as empty."""
    values = batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()
    return [v or b"" for v in values]


def components(edges: DataFrame, tag: str = "components") -> DataFrame:
    """Connected components of an undirected graph: ``edges(src, dst)`` →
    ``(node, component)`` with ``component`` the smallest node reachable.

    Alternating large-star / small-star rounds; every round is two grouped minima
    (combined before the shuffle, so a hub with millions of edges is no hot task) and
    two joins (a hub's side is split by AQE), written to the shared folder. Isolated
    nodes are not listed. Self loops and repeated edges are harmless; nulls are dropped.
    """
    spark = edges.sparkSession
    cur = (edges.filter("src <> dst")
           .select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct())
    cur = materialize(cur, tag)
    before = _fingerprint(cur)
    while True:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.filter("v > u").join(low, "u").filter("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = materialize(large, tag)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").selectExpr("explode(array(u, v)) AS u", "m AS v")
                 .filter("u <> v").distinct())
        small = materialize(small, tag)
        # A star forest keeps its edges: as many, none new.
        cur, now = small, _fingerprint(small)
        if now == before:
            break
        before = now
    roots = cur.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def file_number(column: str = "_metadata.file_name"):
    """The number of the write task in the name of one of Spark's part files; files
    written from range-partitioned rows are in order of this number."""
    return F.regexp_extract(F.col(column), r"part-(\d+)", 1).cast("long")


def running_total(df: DataFrame, order: str, value: str) -> DataFrame:
    """``base`` = sum of ``value`` over all rows before this one in ``order``. For small
    frames of one row per file only: the window has one partition."""
    w = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("base", F.coalesce(F.sum(value).over(w), F.lit(0)))
