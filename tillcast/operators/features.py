"""Calendar, lag and rolling features over the integrated fact.

All windows partition by series ``id``. The fact has one row per (id, date), so a
window partition holds at most one row per calendar day — the frame size is
bounded by the calendar, not by the data volume, even for the busiest series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions import columns as C
from tillcast.schemas import LAG_COLUMNS, ROLLING_COLUMNS

LAGS = (7, 14, 28)
ROLLING = (7, 30)


def time_features(df: DataFrame) -> DataFrame:
    """Year, month, ``week`` (kept as the reference has it: a copy of wday),
    weekend and holiday flags, plus quarter, day name and ISO week of year."""
    return df.withColumns({
        "year": F.col("year").cast("int"),
        "month": F.col("month").cast("int"),
        "week": F.col("wday").cast("int"),
        "is_weekend": C.is_weekend("wday"),
        "is_holiday": C.is_holiday("event_name_1"),
        "quarter": F.quarter("date"),
        "day_name": C.weekday_name("date"),
        "week_of_year": F.weekofyear("date"),
    })


def lag_rolling_features(df: DataFrame, drop_warmup: bool = True) -> DataFrame:
    """Row-based lags 7/14/28 and means of the previous 7/30 rows (current row
    excluded, partial frames allowed). With ``drop_warmup`` rows missing any of
    them (the first 28 rows of every series) are dropped.

    All five share one partition/order spec, so Spark plans one Exchange, one
    Sort and one Window for them.
    """
    w = Window.partitionBy("id").orderBy("date")
    cols = {f"lag_{k}": F.lag("sales", k).over(w) for k in LAGS}
    cols.update({f"rolling_{k}_avg": F.avg("sales").over(w.rowsBetween(-k, -1)) for k in ROLLING})
    out = df.withColumns(cols)
    if drop_warmup:
        out = out.na.drop(subset=LAG_COLUMNS + ROLLING_COLUMNS)
    return out


def _day_window():
    return Window.partitionBy("id").orderBy(F.unix_date("date"))


def calendar_lags(df: DataFrame) -> DataFrame:
    """Sales of the same series exactly k calendar days earlier, 0.0 when that day
    has no row (the forecaster's definition, not the row-based one)."""
    w = _day_window()
    return df.withColumns({
        f"cal_lag_{k}": F.coalesce(F.max("sales").over(w.rangeBetween(-k, -k)).cast("double"),
                                   F.lit(0.0))
        for k in LAGS})


def calendar_rolling(df: DataFrame) -> DataFrame:
    """Mean of the rows present in the k calendar days before the day, 0.0 if none."""
    w = _day_window()
    return df.withColumns({
        f"cal_rolling_{k}_avg": F.coalesce(F.avg("sales").over(w.rangeBetween(-k, -1)), F.lit(0.0))
        for k in ROLLING})
