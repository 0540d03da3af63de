"""Silver cleaning: casts, null fill, positive-price filter, de-duplication and the
series sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.schemas import EVENT_COLUMNS, SNAP_COLUMNS

CAL_INT_COLUMNS = ["wm_yr_wk", "wday", "month", "year", *SNAP_COLUMNS]


def clean_calendar(cal: DataFrame) -> DataFrame:
    """Date parse, integer casts and empty-string event names (one projection)."""
    casts = {c: F.col(c).cast("int") for c in CAL_INT_COLUMNS}
    casts["date"] = F.col("date").cast("date")
    return cal.withColumns(casts).na.fill({c: "" for c in EVENT_COLUMNS})


def clean_prices(prices: DataFrame) -> DataFrame:
    """Integer week key, double price; only strictly positive prices survive
    (null prices fail the comparison and drop too)."""
    return (prices
            .withColumns({"wm_yr_wk": F.col("wm_yr_wk").cast("int"),
                          "sell_price": F.col("sell_price").cast("double")})
            .filter(F.col("sell_price") > 0.0))


def dedupe(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key with a deterministic survivor, so reruns keep the same row: the
    smallest in the order of ``order`` (default: all other columns), at any width.

    Written as a grouped ``min`` instead of ``row_number`` so that a key with a huge
    number of copies collapses in the map-side partial aggregate rather than landing
    whole in one task. One SQL string per wide expression: a single JVM call instead of
    thousands of Python-side Column objects.
    """
    rest = [c for c in df.columns if c not in keys]
    order = order or rest
    ordered = order + [c for c in rest if c not in order]
    best = F.expr(f"min(struct({', '.join(_q(c) for c in ordered)}))").alias("_best")
    return df.groupBy(*keys).agg(best).selectExpr(*[_q(k) for k in keys], *[f"_best.{_q(c)}" for c in ordered])


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sample_series(sales: DataFrame, n: int, key: str = "id") -> DataFrame:
    """Keep the first ``n`` series by id; ``n <= 0`` keeps all. Sampling is the
    feature here, made deterministic by the sort (top-n per partition, then merge)."""
    if n <= 0:
        return sales
    return sales.orderBy(key).limit(n)
