"""Gold business aggregates over the feature fact.

Sums of money run over exact integer cents (``revenue_cents``) and are turned into
currency once, at the end, so results do not depend on summation order. Every
aggregate is a hash aggregate with a map-side partial step: a key holding a third
of all rows is reduced inside each task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions import columns as C

GOLD_KEYS = {
    "gold_daily_sales": ["date", "year", "month", "wday", "is_holiday"],
    "gold_store_performance": ["store_id", "state_id"],
    "gold_product_performance": ["item_id", "dept_id", "cat_id"],
    "gold_category_sales": ["cat_id"],
    "gold_state_sales": ["state_id"],
    "gold_monthly_sales": ["year", "month"],
}


def totals() -> list[Column]:
    return [F.sum("sales").alias("total_units"),
            C.from_cents(F.sum("revenue_cents")).alias("total_revenue")]


def avg_price() -> Column:
    """Unweighted mean of row prices (the store table's definition)."""
    return (F.sum("price_cents").cast("double") / F.count("price_cents") / 100.0).alias("avg_sell_price")


def gold_table(fact: DataFrame, name: str) -> DataFrame:
    keys = GOLD_KEYS[name]
    aggs = totals() + ([avg_price()] if name == "gold_store_performance" else [])
    return fact.groupBy(*keys).agg(*aggs)


def gold_all(fact: DataFrame) -> DataFrame:
    """All six gold grains in one scan with GROUPING SETS, tagged by table name.

    The split uses ``grouping_id()`` — never null tests, since key columns may be
    null themselves. Output is small (bounded by the number of groups), so the job
    writes it once and derives the six tables from it.
    """
    cols: list[str] = []
    for keys in GOLD_KEYS.values():
        cols += [k for k in keys if k not in cols]
    sets = [[F.col(k) for k in keys] for keys in GOLD_KEYS.values()]
    agg = fact.groupingSets(sets, *cols).agg(
        *totals(),
        F.sum("price_cents").alias("_price_sum"), F.count("price_cents").alias("_price_n"),
        F.grouping_id().alias("_gid"))
    n = len(cols)
    tag = None
    for name, keys in GOLD_KEYS.items():
        gid = sum(1 << (n - 1 - i) for i, c in enumerate(cols) if c not in keys)
        cond = F.col("_gid") == gid
        tag = F.when(cond, F.lit(name)) if tag is None else tag.when(cond, F.lit(name))
    return agg.withColumn("table", tag).drop("_gid")


def split_gold(all_df: DataFrame, name: str) -> DataFrame:
    keys = GOLD_KEYS[name]
    out = all_df.filter(F.col("table") == name)
    extra = []
    if name == "gold_store_performance":
        extra = [(F.col("_price_sum").cast("double") / F.col("_price_n") / 100.0).alias("avg_sell_price")]
    return out.select(*keys, "total_units", "total_revenue", *extra)


# --- declared analyses (priority 2) -------------------------------------------------

def dept_performance(fact: DataFrame) -> DataFrame:
    return fact.groupBy("dept_id", "cat_id").agg(*totals())


def product_avg_price(fact: DataFrame) -> DataFrame:
    return fact.groupBy("item_id", "dept_id", "cat_id").agg(*totals(), avg_price())


def holiday_sales(fact: DataFrame) -> DataFrame:
    """Sales on event days vs other days, with units and revenue per day."""
    g = fact.groupBy("is_holiday").agg(*totals(), F.count_distinct("date").alias("days"))
    return g.withColumns({
        "units_per_day": C.safe_ratio("total_units", "days"),
        "revenue_per_day": C.safe_ratio("total_revenue", "days"),
    })


def seasonal_index(fact: DataFrame) -> DataFrame:
    """Mean daily units per (month, wday) over the overall mean daily units.

    Daily totals first (one row per date), then the (month, wday) grid of at most
    84 cells; the overall mean is an un-partitioned window over that grid. Means are
    integer sums over counts, so they do not depend on summation order."""
    daily = fact.groupBy("date", "month", "wday").agg(F.sum("sales").alias("units"))
    cell = daily.groupBy("month", "wday").agg(
        C.exact_avg("units").alias("mean_daily_units"), F.count("*").alias("days"),
        F.sum("units").alias("_sum"), F.count("units").alias("_n"))
    grid = Window.partitionBy()
    overall = F.sum("_sum").over(grid).cast("double") / F.sum("_n").over(grid)
    return cell.select("month", "wday", "mean_daily_units", "days",
                       (F.col("mean_daily_units") / overall).alias("seasonal_index"))


def _growth(df: DataFrame, keys: list[str]) -> DataFrame:
    """Month-over-month growth in percent of revenue per key (0 when the
    previous calendar month is missing, then with a null previous revenue, or zero)."""
    w = Window.partitionBy(*keys).orderBy("year", "month") if keys else Window.orderBy("year", "month")
    month = F.col("year") * 12 + F.col("month")
    prev = F.when(month - F.lag(month).over(w) == 1, F.lag("total_revenue").over(w))
    return df.withColumns({
        "prev_revenue": prev,
        "growth_pct": F.when(prev > 0, (F.col("total_revenue") - prev) / prev * 100.0).otherwise(F.lit(0.0)),
    })


def monthly_growth(fact: DataFrame) -> DataFrame:
    """Whole-business monthly revenue growth. The monthly table is bounded by the
    number of months, so its un-partitioned window runs on a handful of rows."""
    return _growth(gold_table(fact, "gold_monthly_sales"), [])


def category_growth(fact: DataFrame) -> DataFrame:
    return _growth(fact.groupBy("cat_id", "year", "month").agg(*totals()), ["cat_id"])


def product_growth(fact: DataFrame) -> DataFrame:
    return _growth(fact.groupBy("item_id", "year", "month").agg(*totals()), ["item_id"])


def store_vs_state(fact: DataFrame) -> DataFrame:
    """Each store's revenue against the mean store revenue of its state (the
    mean from integer cents, exact)."""
    stores = fact.groupBy("store_id", "state_id").agg(
        *totals(), avg_price(), F.sum("revenue_cents").alias("_cents"))
    w = Window.partitionBy("state_id")
    mean = F.sum("_cents").over(w).cast("double") / F.count("_cents").over(w) / 100.0
    return stores.withColumns({
        "state_mean_revenue": mean,
        "revenue_vs_state_pct": F.when(mean > 0, (F.col("total_revenue") / mean - 1.0) * 100.0)
        .otherwise(F.lit(0.0)),
        "rank_in_state": F.rank().over(w.orderBy(F.desc("total_revenue"), "store_id")),
    }).drop("_cents")
