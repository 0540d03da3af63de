"""Layered table storage (bronze / silver / gold / models), readiness and table layout.

``root`` is one folder for all layers (``<root>/<layer>/<table>``) or a mapping that names a
folder for each layer (``<root[layer]>/<table>``), on any file system.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillcast.schemas import METRICS_TABLE, MODEL_NAME, READINESS_TABLES

Root = str | Mapping[str, str]

FORMAT = "parquet"   # "delta" where the Delta Lake package is on the classpath


def path(root: Root, layer: str, name: str) -> str:
    if isinstance(root, str):
        return f"{root.rstrip('/')}/{layer}/{name}"
    if layer not in root:
        raise ValueError(f"no location for layer {layer!r}; there are {sorted(root)}")
    return f"{root[layer].rstrip('/')}/{name}"


def write(df: DataFrame, root: Root, layer: str, name: str, fmt: str = FORMAT) -> str:
    """Overwrite one table as a whole (one action per table)."""
    p = path(root, layer, name)
    df.write.format(fmt).mode("overwrite").save(p)
    return p


def read(spark: SparkSession, root: Root, layer: str, name: str, fmt: str = FORMAT) -> DataFrame:
    return spark.read.format(fmt).load(path(root, layer, name))


def _count(spark: SparkSession, root: Root, layer: str, name: str, fmt: str) -> int | None:
    try:
        return read(spark, root, layer, name, fmt).count()
    except AnalysisException:
        return None


def table_status(spark: SparkSession, root: Root, fmt: str = FORMAT) -> DataFrame:
    """``(layer, table, exists, rows)`` for the readiness tables, the metrics table
    and the saved model, plus a final ``status`` row: ``ready`` when every table
    holds data and the model exists, else ``pending_etl``. Counts come from file
    metadata where the format allows."""
    rows = []
    for name in READINESS_TABLES:
        n = _count(spark, root, "gold", name, fmt)
        rows.append(("gold", name, bool(n), n or 0))
    n = _count(spark, root, "models", METRICS_TABLE, fmt)
    rows.append(("models", METRICS_TABLE, bool(n), n or 0))
    try:   # a saved Spark ML model is a folder with a JSON metadata file
        spark.read.text(path(root, "models", MODEL_NAME) + "/metadata").limit(1).collect()
        model = True
    except AnalysisException:
        model = False
    rows.append(("models", MODEL_NAME, model, 0))
    ready = all(r[2] for r in rows[:len(READINESS_TABLES)]) and model
    rows.append(("status", "ready" if ready else "pending_etl", ready, 0))
    return spark.createDataFrame(rows, "layer string, table string, exists boolean, rows long")


METRICS_SCHEMA = "rows long, rmse double, mae double, r2 double, run_date date"


def read_metrics(spark: SparkSession, root: Root, fmt: str = FORMAT) -> DataFrame:
    """The stored accuracy metrics, one row per run; an empty frame where none are stored."""
    try:
        return read(spark, root, "models", METRICS_TABLE, fmt)
    except AnalysisException:
        return spark.createDataFrame([], METRICS_SCHEMA)


def newest_metrics(metrics: DataFrame) -> DataFrame:
    """The metrics of the newest run as one struct ``metrics``, null without any run. Of
    several runs on a date the one with the smallest RMSE counts."""
    row = F.struct("run_date", (-F.col("rmse")).alias("least"), "rmse", "mae", "r2", "rows")
    return metrics.agg(F.max(row).alias("m")).select(
        F.when(F.col("m").isNotNull(), F.struct("m.run_date", "m.rmse", "m.mae", "m.r2", "m.rows")).alias("metrics"))


def status_record(spark: SparkSession, root: Root, fmt: str = FORMAT) -> DataFrame:
    """One row: the ``status`` of the layers, how many of the tables it asks for hold data, and
    the newest accuracy metrics (null before the first run)."""
    report = table_status(spark, root, fmt)
    line = report.agg(
        F.max(F.when(F.col("layer") == "status", F.col("table"))).alias("status"),
        F.count_if((F.col("layer") == "gold") & F.col("exists")).alias("tables_ready"),
        F.bool_or((F.col("table") == MODEL_NAME) & F.col("exists")).alias("model"))
    m = newest_metrics(read_metrics(spark, root, fmt)).scalar()
    line = line.withColumn("metrics", m)
    return line.select("status", "tables_ready", "model", *[F.col("metrics")[c].alias(c) for c in ("rmse", "mae", "r2")])


def clustering_report(table: DataFrame, key: str = "id", order: Sequence[str] = ("id", "date")) -> DataFrame:
    """How a stored Parquet table lies in its files, from the rows' own file and place there:
    ``rows``, ``keys``, ``keys_in_several_files`` and ``rows_out_of_order`` (rows that come
    before the row above them in the same file). A window partition is one file."""
    rows = table.select(F.col(key).alias("key"), F.struct(*order).alias("own"),
                        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    above = F.lag("own").over(Window.partitionBy("file").orderBy("at"))
    rows = rows.withColumn("late", F.coalesce(above > F.col("own"), F.lit(False)))
    keys = rows.groupBy("key").agg(F.count("*").alias("n"), F.count_if("late").alias("late"),
                                   (F.min("file") != F.max("file")).alias("spread"))
    return keys.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("keys"),
                    F.count_if("spread").alias("keys_in_several_files"),
                    F.coalesce(F.sum("late"), F.lit(0)).alias("rows_out_of_order"))
