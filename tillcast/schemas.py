"""Explicit schemas and table contracts."""

from __future__ import annotations

from pyspark.sql import types as T

CALENDAR = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("wm_yr_wk", T.IntegerType()),
    T.StructField("weekday", T.StringType()),
    T.StructField("wday", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("d", T.StringType()),
    T.StructField("event_name_1", T.StringType()),
    T.StructField("event_type_1", T.StringType()),
    T.StructField("event_name_2", T.StringType()),
    T.StructField("event_type_2", T.StringType()),
    T.StructField("snap_CA", T.IntegerType()),
    T.StructField("snap_TX", T.IntegerType()),
    T.StructField("snap_WI", T.IntegerType()),
])

PRICES = T.StructType([
    T.StructField("store_id", T.StringType()),
    T.StructField("item_id", T.StringType()),
    T.StructField("wm_yr_wk", T.IntegerType()),
    T.StructField("sell_price", T.DoubleType()),
])

SERIES_KEYS = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"]
EVENT_COLUMNS = ["event_name_1", "event_type_1", "event_name_2", "event_type_2"]
SNAP_COLUMNS = ["snap_CA", "snap_TX", "snap_WI"]
DAY_PREFIX = "d_"


def wide_sales_schema(header: list[str]) -> T.StructType:
    """Wide sales schema from the CSV header: string keys, every ``d_<n>`` an int.

    Building it from the header avoids an inference pass over ~1,900 columns.
    """
    fields = []
    for name in header:
        typ = T.IntegerType() if name.startswith(DAY_PREFIX) else T.StringType()
        fields.append(T.StructField(name, typ))
    return T.StructType(fields)


# Model contract: the 14 features and the target of the forecaster.
FEATURES = [
    "sell_price", "wday", "month", "year", "is_weekend", "is_holiday",
    "snap_CA", "snap_TX", "snap_WI",
    "lag_7", "lag_14", "lag_28", "rolling_7_avg", "rolling_30_avg",
]
TARGET = "sales"
LAG_COLUMNS = ["lag_7", "lag_14", "lag_28"]
ROLLING_COLUMNS = ["rolling_7_avg", "rolling_30_avg"]

# The tables whose presence makes the analytics layer "ready"
# (together with a saved model).
READINESS_TABLES = ["gold_daily_sales", "gold_store_performance", "gold_product_performance",
                    "gold_category_sales", "gold_state_sales", "gold_forecast_results"]
MODEL_NAME = "gbt_forecaster"
METRICS_TABLE = "evaluation_metrics"
