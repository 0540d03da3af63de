"""Vector columns as matrices inside tasks."""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def matrix(column, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """An Arrow list column as ``(row numbers, float64 matrix)`` of the usable vectors:
    ``dim`` components, all finite and not null, not all zero."""
    rows = np.flatnonzero(pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False) == dim)
    if not dim or not len(rows):
        return np.zeros(0, np.int64), np.zeros((0, dim))
    # A null component becomes NaN.
    x = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    usable = np.isfinite(x).all(axis=1) & x.any(axis=1)
    return rows[usable], x[usable]


def dimension(embeddings: DataFrame) -> int:
    """The number of components most usable vectors have (ties: the larger); 0 for none."""
    usable = "exists(embedding, x -> x <> 0) AND forall(embedding, x -> x IS NOT NULL AND abs(x) < double('Infinity'))"
    row = (embeddings.filter(usable).groupBy(F.size("embedding").alias("d")).count()
           .orderBy(F.desc("count"), F.desc("d")).first())
    return row[0] if row else 0


def rows_of(embeddings: DataFrame) -> DataFrame:
    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"),
                             F.col("embedding").cast("array<double>").alias("embedding"))


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Arrow batches of at most ``rows`` rows for the jobs run inside: rows hold whole blocks."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)
