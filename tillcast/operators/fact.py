"""Silver integrated fact: long sales ⋈ calendar ⋈ weekly prices, with revenue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.functions import columns as C

# A calendar longer than this is not broadcast (≈ 270 years of days).
MAX_CALENDAR_ROWS = 100_000


def sales_fact(sales: DataFrame, calendar: DataFrame, prices: DataFrame,
               calendar_rows: int | None = None) -> DataFrame:
    """Inner-join daily sales to the calendar (days outside it drop) and to the
    weekly prices (unpriced weeks drop); revenue = units × price.

    Sales join the calendar on ``d`` when they come from a melt, else on ``date``.
    The calendar is broadcast after a size check (``calendar_rows`` when the
    caller knows it, else a bounded count); the price join is left to AQE
    (broadcast when small at run time, sort-merge with skew splitting otherwise).
    Money is also carried as exact integer cents so every later sum is exact.
    """
    key = "d" if "d" in sales.columns else "date"
    joined = sales.join(_calendar_side(calendar, calendar_rows), on=key, how="inner")
    priced = joined.join(prices, on=["store_id", "item_id", "wm_yr_wk"], how="inner")
    return with_money(priced)


def _calendar_side(calendar: DataFrame, calendar_rows: int | None) -> DataFrame:
    if calendar_rows is not None:
        return F.broadcast(calendar) if calendar_rows <= MAX_CALENDAR_ROWS else calendar
    return C.checked_broadcast(calendar, MAX_CALENDAR_ROWS)


def with_money(priced: DataFrame) -> DataFrame:
    """Units as int, price and revenue also as exact integer cents."""
    return priced.withColumns({
        "sales": F.col("sales").cast("int"),
        "price_cents": C.to_cents("sell_price"),
    }).withColumns({
        "revenue_cents": F.col("sales").cast("long") * F.col("price_cents"),
    }).withColumn("revenue", C.from_cents("revenue_cents"))


def fact_with_prices(sales: DataFrame, calendar: DataFrame, calendar_rows: int | None = None) -> DataFrame:
    """Integrated fact for sales that already carry their weekly ``sell_price``
    (and ``wm_yr_wk``): only the calendar join remains."""
    cal = _calendar_side(calendar.drop("wm_yr_wk"), calendar_rows)
    return with_money(sales.join(cal, on="date", how="inner"))
