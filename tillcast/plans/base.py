"""Silver/gold frames over the driver's tables, shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.operators.clean import clean_calendar, clean_prices
from tillcast.operators.fact import fact_with_prices, sales_fact
from tillcast.operators.features import time_features
from tillcast.session import materialize as materialize_table
from tillcast.sources.driver_tables import RetailInputs, calendar_input, priced_daily, retail_inputs


def inputs(spark: SparkSession, sf_dir: str, level: str = "item", written: bool = False) -> RetailInputs:
    return retail_inputs(spark, sf_dir, level, written)


def fact(spark: SparkSession, sf_dir: str, level: str = "item", materialize: bool = False,
         calendar: tuple[DataFrame, int] | None = None) -> DataFrame:
    """Integrated fact with time features (``silver_integrated`` + calendar flags).

    ``materialize`` writes it once as a table in the cluster's checkpoint folder
    for queries that read it several times — each scalar subquery would otherwise
    recompute it from the raw tables. ``calendar`` reuses an already built
    ``calendar_input`` (saves its bounds job).
    """
    calendar, days = calendar or calendar_input(spark, sf_dir)
    priced = priced_daily(spark, sf_dir, level).filter(F.col("sell_price") > 0.0)   # as clean_prices
    out = time_features(fact_with_prices(priced, clean_calendar(calendar), calendar_rows=days))
    return materialize_table(out, f"fact-{level}") if materialize else out


def joined_fact(spark: SparkSession, sf_dir: str, level: str = "item") -> DataFrame:
    """The same fact through the model's join path: sales ⋈ calendar ⋈ prices
    (sales and prices read from one stored daily aggregate)."""
    ri = retail_inputs(spark, sf_dir, level, written=True)
    return time_features(sales_fact(ri.sales, clean_calendar(ri.calendar), clean_prices(ri.prices),
                                    calendar_rows=ri.calendar_days))
