"""Adapter from the driver's TPC-H-style tables to the retail model.

The retail model needs three raw inputs: a calendar, weekly prices and daily unit
sales per series. The driver's tables stand in for them:

* day          = ``l_shipdate`` as a date
* store/state  = nation / region name of the supplier
* category     = ``p_type``; department = type + (brand number mod 3 + 1);
  item = department + brand number — a true item → dept → category hierarchy
* units        = sum of ``l_quantity``
* weekly price = sum of line amounts in cents div units, per store, item, year-week
* calendar     = every day from the first to the last ship date plus 30 days

Two grains: ``item`` (item × store × day) and ``category`` (category × store × day,
long dense-ish series for lags and forecasting).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillcast.functions import columns as C
from tillcast.operators.calendar import FUTURE_DAYS, calendar_dim
from tillcast.session import materialize

# Largest supplier → store dimension that is broadcast (≈ 50 MB of rows).
MAX_STORE_ROWS = 1_000_000

_SOURCES: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Source frames are registered once per session (file listing
    and footer schema are read once); every query still scans the files."""
    key = (id(spark), f"{sf_dir.rstrip('/')}/{name}.parquet")
    df = _SOURCES.get(key)
    if df is None or df.sparkSession is not spark:
        df = _SOURCES[key] = spark.read.parquet(key[1])
    return df


def item_hierarchy(part: DataFrame) -> DataFrame:
    brand_no = F.substring_index("p_brand", "#", -1).cast("int")
    dept = F.concat_ws("_", F.col("p_type"), (brand_no % 3 + 1).cast("string"))
    item = F.concat_ws("_", dept, F.lpad(brand_no.cast("string"), 3, "0"))
    return part.select("p_partkey", F.col("p_type").alias("cat_id"),
                       dept.alias("dept_id"), item.alias("item_id"))


def store_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier → (store, state). Nation (25 rows) and region (5 rows) are fixed
    by the TPC-H schema; no hint is given: the planner sizes them from their files
    (a few KB, far below the broadcast threshold) and AQE re-checks the real size
    at run time. Supplier grows with the data and is a plain join."""
    region = table(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("state_id"))
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey",
                                                    F.col("n_name").alias("store_id"))
    geo = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "store_id", "state_id")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return supplier.join(geo, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", "store_id", "state_id")


def sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item with its retail keys. Part and supplier joins are
    plain equi-joins: AQE broadcasts them when small, else sort-merge."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey",
        F.to_date("l_shipdate").alias("date"),
        F.col("l_quantity").alias("qty"),
        C.to_cents("l_extendedprice").alias("cents"))
    items = item_hierarchy(table(spark, sf_dir, "part"))
    # supplier → store is a join of three tables, which the planner over-estimates
    # (product of the sides) and would shuffle the line items for. Broadcast it
    # after a row-count check; beyond the bound (10 k suppliers per TPC-H scale
    # unit, so ~1 B at 100 TB) it stays a sort-merge join.
    stores = C.checked_broadcast(store_dim(spark, sf_dir), MAX_STORE_ROWS)
    return (li.join(items, F.col("l_partkey") == F.col("p_partkey"))
            .join(stores, F.col("l_suppkey") == F.col("s_suppkey"))
            .drop("l_partkey", "p_partkey", "l_suppkey", "s_suppkey"))


@dataclass
class RetailInputs:
    sales: DataFrame      # id, item_id, dept_id, cat_id, store_id, state_id, date, sales
    prices: DataFrame     # store_id, item_id, wm_yr_wk, sell_price
    calendar: DataFrame   # raw calendar (null event names on ordinary days)
    calendar_days: int    # rows of the calendar, known from its bounds


def daily_lines(spark: SparkSession, sf_dir: str, level: str = "item") -> DataFrame:
    """Units and cents per series and day (map-side partial aggregation first, so
    a hot item or store never reaches one reducer as raw rows)."""
    lines = sales_lines(spark, sf_dir)
    if level == "category":
        lines = lines.withColumns({"item_id": F.col("cat_id"), "dept_id": F.col("cat_id")})
    elif level != "item":
        raise ValueError(f"unknown level {level!r}")
    daily = (lines.groupBy("item_id", "dept_id", "cat_id", "store_id", "state_id", "date")
             .agg(F.sum("qty").cast("int").alias("sales"), F.sum("cents").alias("cents")))
    return daily.withColumn("id", F.concat_ws("_", "item_id", "store_id", F.lit("validation")))


def _price(cents: str, units: str):
    return C.from_cents(F.expr(f"{cents} div {units}"))


def priced_daily(spark: SparkSession, sf_dir: str, level: str = "item") -> DataFrame:
    """Daily sales that carry their weekly price, in one pass over the line items.

    The weekly price of a (store, item, week) is derived from that week's own
    daily rows, so a window over them gives the same rows as joining a separate
    price table — without aggregating the line items twice. The window runs on
    the aggregated rows (at most 14 days per store, item and week key)."""
    # Hash-partitioned by series id once, after the map-side-combined daily
    # aggregate: that one shuffle serves this window (its keys include id) and the
    # later per-series lag windows, which then need no exchange of their own.
    daily = daily_lines(spark, sf_dir, level).withColumn("wm_yr_wk", C.year_week("date")).repartition("id")
    # State, department, category and id are functions of store and item: listing
    # them does not change the partitions, but lets Catalyst push filters on them
    # (dashboard filters) through the window down to the part / region scans.
    w = Window.partitionBy("store_id", "item_id", "wm_yr_wk", "state_id", "dept_id", "cat_id", "id")
    return (daily.withColumns({"_wc": F.sum("cents").over(w), "_wu": F.sum("sales").over(w)})
            .withColumn("sell_price", _price("_wc", "_wu"))
            .drop("_wc", "_wu", "cents"))


def retail_inputs(spark: SparkSession, sf_dir: str, level: str = "item",
                  written: bool = False) -> RetailInputs:
    """The three raw inputs of the retail model. ``written`` stores the daily
    aggregate once in the checkpoint folder, so sales and prices read a table —
    as they would be two stored inputs — instead of each re-aggregating the line
    items."""
    daily = daily_lines(spark, sf_dir, level)
    if written:
        daily = materialize(daily, f"daily-{level}")
    prices = (daily.withColumn("wm_yr_wk", C.year_week("date"))
              .groupBy("store_id", "item_id", "wm_yr_wk")
              .agg(F.sum("cents").alias("_c"), F.sum("sales").alias("_u"))
              .select("store_id", "item_id", "wm_yr_wk", _price("_c", "_u").alias("sell_price")))
    sales = daily.select("id", "item_id", "dept_id", "cat_id", "store_id", "state_id", "date", "sales")
    calendar, days = calendar_input(spark, sf_dir)
    return RetailInputs(sales=sales, prices=prices, calendar=calendar, calendar_days=days)


def calendar_input(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """Calendar over the ship dates plus the forecast days, and its row count.

    Bounds: one global min/max (partial per task), two dates to the driver. The
    calendar is then built from literals and its size is known exactly, without
    a counting job."""
    lo, hi = (table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("d"))
              .agg(F.min("d"), F.max("d")).first())
    hi = hi + _dt.timedelta(days=FUTURE_DAYS)
    return calendar_dim(spark, lo, hi), (hi - lo).days + 1
