"""KPIs, rankings, top-k, history ∪ forecast series and the text summary.

Global figures use scalar subqueries (one partial aggregate per task, value
inlined into the plan) instead of global windows or cross joins, so no step
pulls the data into one partition. Top-k uses ``orderBy().limit(k)``
(per-task top-k, then a k-row merge).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions import columns as C
from tillcast.operators import marts
from tillcast.sources import tables

# ---------------------------------------------------------------------------
# Labels and text layouts that must equal the reference's.
# ---------------------------------------------------------------------------
TYPE_HISTORICAL, TYPE_FORECASTED = "Historical", "Forecasted"     # API forecast points
TYPE_ACTUAL, TYPE_FORECAST = "Actual", "Forecast"                 # dashboard union
HISTORY_DAYS = 90          # history shown with the forecast: date >= last - 90
WOW_DAYS = 7               # week-over-week windows (last-7, last] and (last-14, last-7]
BAND_LOW, BAND_HIGH = 0.9, 1.1
SUMMARY_TEMPLATE = (  # filled in this order: revenue, units, category, store, its state, state,
    "HISTORICAL GENERAL METRICS:\n"  # forecast revenue, forecast units, mean daily units
    "- Total Revenue: $%s\n"
    "- Total Units Sold: %s\n"
    "- Top Category: %s\n"
    "- Top Performing Store: %s (located in state %s)\n"
    "- Top Performing State: %s\n\n"
    "FUTURE 30-DAY FORECAST METRICS:\n"
    "- Forecasted Total Revenue: $%s\n"
    "- Forecasted Units Sold: %s\n"
    "- Average Forecasted Daily Sales: %s units\n"
)
PROMPT_HEAD = "Here is the Gold Layer Business KPI and Forecasting Summary for our stores:\n"
PROMPT_RULE = "===================================================\n"
PROMPT_QUESTION = "User Question: "
PROMPT_TAIL = "\nAssistant Response:"


def kpi_totals(fact: DataFrame) -> DataFrame:
    """Total revenue and units, average selling price (revenue / units, 0 if no
    units), active products and stores. The fact is reduced to one row per product
    and store first, so the two distinct counts multiply only those rows."""
    pairs = fact.groupBy("item_id", "store_id").agg(
        F.sum("revenue_cents").alias("_cents"), F.sum("sales").alias("_units"))
    return pairs.agg(
        F.sum("_cents").alias("_cents"), F.sum("_units").alias("total_units_sold"),
        F.count_distinct("item_id").alias("active_products"),
        F.count_distinct("store_id").alias("active_stores"),
    ).select(
        C.from_cents("_cents").alias("total_revenue"), "total_units_sold",
        (C.safe_ratio("_cents", "total_units_sold") / 100.0).alias("average_selling_price"),
        "active_products", "active_stores")


def kpi_wow_growth(fact: DataFrame) -> DataFrame:
    """Revenue of the last 7 days vs the 7 before, growth in percent (0 when the
    earlier week has no revenue). One pass: revenue per day, then the two weeks
    from the list of days (bounded by the calendar)."""
    days = fact.groupBy("date").agg(F.sum("revenue_cents").alias("_cents"))
    g = days.agg(F.max("date").alias("max_date"), F.collect_list(F.struct("date", "_cents")).alias("_days"))

    def week(ago: int) -> Column:
        first = F.date_sub("max_date", (ago + 1) * WOW_DAYS)
        end = F.date_sub("max_date", ago * WOW_DAYS)
        return F.aggregate(
            F.filter("_days", lambda d: (d["date"] > first) & (d["date"] <= end)),
            F.lit(0).cast("long"), lambda acc, d: acc + F.coalesce(d["_cents"], F.lit(0)))

    g = g.withColumns({"_l": week(0), "_p": week(1)})
    return g.select(
        "max_date",
        C.from_cents("_l").alias("last_7_revenue"), C.from_cents("_p").alias("prev_7_revenue"),
        F.when(F.col("_p") > 0, (F.col("_l") - F.col("_p")) / F.col("_p") * 100.0)
        .otherwise(F.lit(0.0)).alias("growth_rate_wow"))


def apply_filters(fact: DataFrame, state: str = "All", category: str = "All") -> DataFrame:
    """Dashboard filters; the value ``All`` means no filter. Pushed to the scan."""
    if state != "All":
        fact = fact.filter(F.col("state_id") == state)
    if category != "All":
        fact = fact.filter(F.col("cat_id") == category)
    return fact


def kpi_filtered(fact: DataFrame, state: str = "All", category: str = "All") -> DataFrame:
    return apply_filters(fact, state, category).agg(
        C.from_cents(F.sum("revenue_cents")).alias("Total_Revenue"),
        F.sum("sales").alias("Total_Units_Sold"),
        F.count("id").alias("Record_Count"))


def daily_trend(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("date").agg(C.from_cents(F.sum("revenue_cents")).alias("Daily_Revenue"))
            .orderBy("date"))


def category_share(fact: DataFrame) -> DataFrame:
    """Category revenue and its share of the total in percent. The un-partitioned
    window runs on one row per category."""
    cat = fact.groupBy("cat_id").agg(F.sum("sales").alias("total_units"),
                                     F.sum("revenue_cents").alias("_cents"))
    total = F.sum("_cents").over(Window.partitionBy())
    return cat.select("cat_id", "total_units", C.from_cents("_cents").alias("total_revenue"),
                      (F.col("_cents") / total * 100.0).alias("share_pct"))


def store_ranking(fact: DataFrame) -> DataFrame:
    """All stores by revenue, ranked. The store table is bounded by the number of
    stores, so the un-partitioned ranking window sorts only that many rows."""
    stores = marts.gold_table(fact, "gold_store_performance")
    w = Window.orderBy(F.desc("total_revenue"), "store_id")
    return stores.withColumn("revenue_rank", F.rank().over(w)).orderBy("revenue_rank")


def top_products(fact: DataFrame, k: int, worst: bool = False) -> DataFrame:
    """Top (or bottom) ``k`` products by revenue; ties broken on item_id so the
    bottom list is exactly the tail of the top list's order."""
    prods = marts.gold_table(fact, "gold_product_performance")
    order = [F.asc("total_revenue"), F.desc("item_id")] if worst else [F.desc("total_revenue"), F.asc("item_id")]
    out = prods.orderBy(*order).limit(k)
    return out.orderBy(F.desc("total_revenue"), F.asc("item_id")) if worst else out


def _best(df: DataFrame, key: str, value: str = "_cents") -> Column:
    return df.orderBy(F.desc(value), F.asc(key)).limit(1).select(key).scalar()


def forecast_daily(fc: DataFrame) -> DataFrame:
    return fc.groupBy("date").agg(F.sum("sales").alias("total_units"),
                                  C.from_cents(F.sum(_rev_cents(fc))).alias("total_revenue"))


def _rev_cents(fc: DataFrame) -> Column:
    return F.col("sales").cast("long") * C.to_cents("sell_price")


def forecast_totals(fc: DataFrame) -> DataFrame:
    """Forecast revenue and units over the horizon and mean daily units (over the
    real number of forecast days, which is below 30 for a short calendar)."""
    g = fc.agg(F.sum(_rev_cents(fc)).alias("_cents"), F.sum("sales").alias("forecast_units"),
               F.count_distinct("date").alias("forecast_days"))
    return g.select(C.from_cents("_cents").alias("forecast_revenue"), "forecast_units", "forecast_days",
                    C.safe_ratio("forecast_units", "forecast_days").alias("mean_daily_units"))


def forecast_band(fc: DataFrame) -> DataFrame:
    """Daily forecast with the ±10 % band the dashboard draws (not a confidence
    interval)."""
    d = forecast_daily(fc)
    return d.withColumns({"band_low": F.col("total_units") * BAND_LOW,
                          "band_high": F.col("total_units") * BAND_HIGH})


def forecast_points(daily_gold: DataFrame, fc: DataFrame) -> DataFrame:
    """Last 91 days of history plus the daily forecast, one ordered series."""
    last = daily_gold.select(F.max("date")).scalar()
    hist = daily_gold.filter(F.col("date") >= F.date_sub(last, HISTORY_DAYS)).select(
        "date", F.lit(TYPE_HISTORICAL).alias("type"),
        F.col("total_units").cast("double").alias("sales"), F.col("total_revenue").alias("revenue"))
    fut = forecast_daily(fc).select(
        "date", F.lit(TYPE_FORECASTED).alias("type"),
        F.col("total_units").cast("double").alias("sales"), F.col("total_revenue").alias("revenue"))
    return hist.unionByName(fut).orderBy("date", "type")


def forecast_record(points: DataFrame, metrics: DataFrame) -> DataFrame:
    """The forecast record: the points with the accuracy of the model beside them (the newest
    run's RMSE, MAE and R², one scalar struct; nulls before the first run). ``metrics`` has
    one row per run (``sources.tables.read_metrics``)."""
    rows = points.withColumn("_m", tables.newest_metrics(metrics).scalar())
    return rows.select(*points.columns, *[F.col("_m")[c].alias(c) for c in ("rmse", "mae", "r2")])


def history_vs_forecast(fact: DataFrame, fc: DataFrame) -> DataFrame:
    actual = fact.groupBy("date").agg(F.sum("sales").alias("sales")).withColumn("type", F.lit(TYPE_ACTUAL))
    fut = fc.groupBy("date").agg(F.sum("sales").alias("sales")).withColumn("type", F.lit(TYPE_FORECAST))
    return actual.unionByName(fut).orderBy("date", "type")


def forecast_by_dimension(fc: DataFrame) -> DataFrame:
    """Forecast per (product | category | store | state, day). The series are summed to
    (product, category, store, state, day) inside the tasks first, so the four-fold GROUPING
    SETS expansion multiplies only those sums."""
    dims = ["item_id", "cat_id", "store_id", "state_id"]
    cells = fc.groupBy(*dims, "date").agg(F.sum("sales").alias("_units"), F.sum(_rev_cents(fc)).alias("_c"))
    g = cells.groupingSets([[F.col(d), F.col("date")] for d in dims], *dims, "date")
    agg = g.agg(F.sum("_units").alias("total_units"), F.sum("_c").alias("_cents"), F.grouping_id().alias("_gid"))
    # grouping_id bits over (item_id, cat_id, store_id, state_id, date): 1 = column rolled up
    dim = (F.when(F.col("_gid") == 0b01110, "item_id").when(F.col("_gid") == 0b10110, "cat_id")
           .when(F.col("_gid") == 0b11010, "store_id").otherwise("state_id"))
    key = F.coalesce(*dims)
    return agg.select(dim.alias("dimension"), key.alias("key"), "date", "total_units",
                      C.from_cents("_cents").alias("total_revenue"))


def forecast_products(fc: DataFrame) -> DataFrame:
    """Forecast per product and day over all its stores, with the number of stores in which
    any unit is expected."""
    return fc.groupBy("item_id", "dept_id", "cat_id", "date").agg(
        F.sum("sales").alias("total_units"), C.from_cents(F.sum(_rev_cents(fc))).alias("total_revenue"),
        F.count_if(F.col("sales") > 0).alias("stores"))


def _fmt_money(c: Column) -> Column:
    return F.format_number(c, 2)


def kpi_summary(fact: DataFrame, fc: DataFrame) -> DataFrame:
    """One-row summary with the figures and the text the assistant is given.

    All history figures come from one GROUPING SETS pass over the fact (totals,
    per category, per store, per state), reduced to one row; the forecast
    figures are one scalar subquery. Best = highest revenue, ties to the smallest
    key. The best store's state is the store's own state.
    """
    g = fact.groupingSets([[F.col("cat_id")], [F.col("store_id"), F.col("state_id")], [F.col("state_id")], []],
                          "cat_id", "store_id", "state_id").agg(
        F.sum("revenue_cents").alias("_cents"), F.sum("sales").alias("_units"), F.grouping_id().alias("_gid"))
    # grouping_id bits over (cat_id, store_id, state_id), 1 = rolled up
    by_cat, by_store, by_state, total = 0b011, 0b100, 0b110, 0b111

    def best(key: str, gid: int, tie: str | None = None) -> Column:
        rank = F.struct((-F.col("_cents")).alias("c"), F.col(tie or key).alias("k"))
        return F.min_by(F.col(key), F.when(F.col("_gid") == gid, rank))

    ft = forecast_totals(fc).select(F.struct("forecast_revenue", "forecast_units", "forecast_days")).scalar()
    row = g.agg(
        C.from_cents(F.max(F.when(F.col("_gid") == total, F.col("_cents")))).alias("total_revenue"),
        F.max(F.when(F.col("_gid") == total, F.col("_units"))).alias("total_units"),
        best("cat_id", by_cat).alias("top_category"),
        best("store_id", by_store).alias("top_store"),
        best("state_id", by_store, tie="store_id").alias("top_store_state"),
        best("state_id", by_state).alias("top_state"),
    ).withColumn("_ft", ft).select(
        "*", *[F.col("_ft")[c].alias(c) for c in ("forecast_revenue", "forecast_units", "forecast_days")]
    ).drop("_ft").withColumn("mean_daily_units", C.safe_ratio("forecast_units", "forecast_days"))
    text = F.format_string(
        SUMMARY_TEMPLATE,
        _fmt_money(F.col("total_revenue")), F.format_number(F.col("total_units"), 0),
        F.col("top_category"), F.col("top_store"), F.col("top_store_state"), F.col("top_state"),
        _fmt_money(F.col("forecast_revenue")), F.format_number(F.col("forecast_units"), 0),
        F.format_string("%.1f", F.col("mean_daily_units")))
    return row.withColumn("summary", text)


def _product_list(products: DataFrame) -> Column:
    """The products, best first, as one string; sorted after they are collected."""
    rows = F.array_sort(F.collect_list(F.struct((-F.col("total_revenue")).alias("r"), "item_id")))
    return products.select(F.array_join(F.transform(rows, lambda p: p["item_id"]), ", ")).scalar()


def kpi_summary_lists(fact: DataFrame, fc: DataFrame, k: int = 5, products: DataFrame | None = None) -> DataFrame:
    """The summary plus the top / bottom ``k`` products and the category list.
    ``products`` is the fact that the products come from, where ``fact`` is coarser."""
    s = kpi_summary(fact, fc)
    items = fact if products is None else products
    top, worst = _product_list(top_products(items, k)), _product_list(top_products(items, k, worst=True))
    cats = fact.select("cat_id").distinct().select(
        F.array_join(F.array_sort(F.collect_list("cat_id")), ", ")).scalar()
    return s.withColumns({"top_products": top, "worst_products": worst, "categories": cats}).withColumn(
        "summary_lists",
        F.concat(F.col("summary"), F.lit("- Top Products: "), F.col("top_products"),
                 F.lit("\n- Worst Products: "), F.col("worst_products"),
                 F.lit("\n- Categories: "), F.col("categories"), F.lit("\n")))


def question_context(questions: DataFrame, summary: DataFrame, text_col: str = "text") -> DataFrame:
    """Each question with the summary framed into the assistant prompt. The
    summary is a one-row scalar subquery, so there is no join at all."""
    s = summary.select("summary").scalar()
    prompt = F.concat(F.lit(PROMPT_HEAD + PROMPT_RULE), s, F.lit("\n" + PROMPT_RULE + "\n" + PROMPT_QUESTION),
                      F.col(text_col), F.lit(PROMPT_TAIL))
    return questions.withColumn("prompt", prompt)
