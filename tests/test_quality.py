import datetime as dt

import pytest


from tillcast.operators import quality
from tillcast.schemas import CALENDAR, FEATURES

D0 = dt.date(2011, 1, 29)


def test_require_columns_lists_every_missing_one(spark):
    df = spark.createDataFrame([(1, 2.0)], "wday int, sell_price double")
    with pytest.raises(ValueError) as e:
        quality.require_columns(df, FEATURES + ["sales"])
    assert "lag_7" in str(e.value) and "sales" in str(e.value) and "'wday'" not in str(e.value)


def test_schema_report(spark):
    df = spark.createDataFrame([(D0, "1101", "x")], "date date, wm_yr_wk string, extra string")
    rep = {r.column: r.status for r in quality.schema_report(df, CALENDAR).collect()}
    assert rep["date"] == "ok" and rep["wm_yr_wk"] == "type_mismatch"
    assert rep["snap_WI"] == "missing" and rep["extra"] == "unexpected"


@pytest.mark.parametrize("exact", [True, False])
def test_profile(spark, exact):
    df = spark.createDataFrame([("a", 1), ("b", None), ("a", 3)], "k string, v int")
    rows = {r.column: r for r in quality.profile(df, exact=exact).collect()}
    assert (rows["k"].rows, rows["k"].nulls, rows["k"].distinct, rows["k"].min, rows["k"].max) == (3, 0, 2, "a", "b")
    assert (rows["v"].nulls, rows["v"].distinct, rows["v"].min, rows["v"].max) == (1, 2, "1", "3")


def test_quality_report_counts(spark):
    sales = spark.createDataFrame(
        [("a", "S", "I", D0, 1), ("a", "S", "I", D0, 2), ("b", "S", "J", D0, -1),
         ("c", "S", "K", D0 + dt.timedelta(days=400), None)],
        "id string, store_id string, item_id string, date date, sales int")
    cal = spark.createDataFrame([(D0, 1104)], "date date, wm_yr_wk int")
    prices = spark.createDataFrame([("S", "I", 1104, 1.0), ("S", "J", 1104, 0.0), ("S", "J", 1104, 2.0)],
                                   "store_id string, item_id string, wm_yr_wk int, sell_price double")
    rep = {r.check: r.failed_rows for r in quality.quality_report(sales, prices, cal).collect()}
    assert rep == {"sales_outside_calendar": 1, "sales_without_price": 1, "duplicate_series_day": 1,
                   "null_sales": 1, "negative_sales": 1, "nonpositive_or_null_price": 1,
                   "duplicate_price_key": 1, "duplicate_calendar_day": 0}
