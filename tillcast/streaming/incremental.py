"""Gold daily sales kept current while new fact files land in a folder.

The reference has no streaming; this runs the existing daily mart incrementally.
Each micro-batch is reduced to the daily grain (sums in exact cents) and written
as its own ``batch_id=<n>`` partition, replacing that partition if the batch is
replayed after a failure, so the result is exactly-once. The mart is the sum of the
partials; it is small (one row per day and calendar key per batch).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.functions import columns as C
from tillcast.operators.marts import GOLD_KEYS

DAILY_KEYS = GOLD_KEYS["gold_daily_sales"]


def _partial(batch: DataFrame) -> DataFrame:
    return batch.groupBy(*DAILY_KEYS).agg(F.sum("sales").alias("total_units"),
                                          F.sum("revenue_cents").alias("revenue_cents"))


def run_daily_sales_stream(spark: SparkSession, fact_dir: str, schema: T.StructType, out_dir: str,
                           checkpoint: str, max_files_per_trigger: int | None = None) -> None:
    """Process every fact file not seen before (``availableNow``) and stop."""
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(fact_dir)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        _partial(batch).write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")

    q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_daily_sales(spark: SparkSession, out_dir: str) -> DataFrame:
    """The daily mart from all batch partials."""
    parts = spark.read.parquet(out_dir)
    return parts.groupBy(*DAILY_KEYS).agg(F.sum("total_units").alias("total_units"),
                                          C.from_cents(F.sum("revenue_cents")).alias("total_revenue"))
