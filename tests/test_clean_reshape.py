import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillcast.operators import clean, marts, fact, reshape
from tillcast.operators.calendar import calendar_dim
from tillcast.operators.features import time_features


def test_positive_price_filter(spark):
    prices = spark.createDataFrame(
        [("S", "A", "1101", "0"), ("S", "B", "1101", "-1.5"), ("S", "C", "1101", None), ("S", "D", "1101", "2.49")],
        "store_id string, item_id string, wm_yr_wk string, sell_price string")
    out = clean.clean_prices(prices).collect()
    assert [(r.item_id, r.wm_yr_wk, r.sell_price) for r in out] == [("D", 1101, 2.49)]


def test_dedupe_keeps_a_deterministic_survivor(spark):
    rows = [("x", 3, "b"), ("x", 1, "z"), ("x", 1, "a"), ("y", 7, "q")]
    df = spark.createDataFrame(rows, "id string, v int, w string")
    for _ in range(2):
        got = sorted((r.id, r.v, r.w) for r in clean.dedupe(df.repartition(3), ["id"]).collect())
        assert got == [("x", 1, "a"), ("y", 7, "q")]


def test_sample_series_is_first_n_by_id(spark):
    df = spark.createDataFrame([(f"s{i:02d}",) for i in range(30, 0, -1)], "id string")
    assert [r.id for r in clean.sample_series(df, 3).collect()] == ["s01", "s02", "s03"]
    assert clean.sample_series(df, 0).count() == 30


def test_melt_keeps_nulls_and_counts(spark):
    wide = spark.createDataFrame([("a", "i", "d", "c", "s", "t", 1, None, 3), ("b", "i", "d", "c", "s", "t", 0, 5, 6)],
                                 "id string, item_id string, dept_id string, cat_id string, store_id string, "
                                 "state_id string, d_1 int, d_2 int, d_3 int")
    long = reshape.melt_daily(wide)
    got = sorted((r.id, r.d, r.sales) for r in long.collect())
    assert len(got) == 2 * 3
    assert ("a", "d_2", None) in got and ("b", "d_3", 6) in got
    # round trip
    back = reshape.pivot_daily(long, ["d_1", "d_2", "d_3"], fill=None)
    assert sorted(map(tuple, back.select("id", "d_1", "d_2", "d_3").collect())) == [("a", 1, None, 3), ("b", 0, 5, 6)]


def test_fact_inner_joins_and_revenue(spark):
    cal = clean.clean_calendar(calendar_dim(spark, dt.date(2011, 1, 29), dt.date(2011, 2, 8)))
    long = spark.createDataFrame(
        [("a", "I", "D", "C", "S", "T", "d_1", 2), ("a", "I", "D", "C", "S", "T", "d_9", 4),
         ("a", "I", "D", "C", "S", "T", "d_99", 1)],   # d_99 is outside the calendar
        "id string, item_id string, dept_id string, cat_id string, store_id string, state_id string, d string, "
        "sales int")
    wk1 = cal.filter(F.col("d") == "d_1").first().wm_yr_wk
    prices = spark.createDataFrame([("S", "I", wk1, 1.15)], "store_id string, item_id string, wm_yr_wk int, "
                                                             "sell_price double")
    out = fact.sales_fact(long, cal, prices).collect()
    # d_9 is in another week without a price -> dropped; d_99 has no calendar row
    assert [(r.d, r.sales, r.revenue, r.revenue_cents) for r in out] == [("d_1", 2, 2.3, 230)]


def test_null_and_empty_events_are_not_holidays(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (1, "Christmas")], "wday int, event_name_1 string")
    df = df.withColumn("date", F.lit(dt.date(2011, 12, 25)))
    rows = time_features(df.withColumns({"year": F.lit(2011), "month": F.lit(12)})).collect()
    assert [(r.is_holiday, r.is_weekend) for r in rows] == [(0, 1), (0, 1), (1, 1)]


@pytest.mark.parametrize("n", [3, 64, 65, 300])
def test_dedupe_keeps_the_smallest_row_at_any_width(spark, n):
    cols = ", ".join(f"d_{i} int" for i in range(1, n + 1))
    small, large = [1] * n, [1] * (n - 1) + [2]
    df = spark.createDataFrame([("x", *large), ("x", *small), ("x", *large), ("y", *large)], f"id string, {cols}")
    for parts in (2, 3):
        got = sorted(map(tuple, clean.dedupe(df.repartition(parts), ["id"]).collect()))
        assert got == [("x", *small), ("y", *large)]


def test_growth_is_zero_after_a_missing_month(spark):
    fact = spark.createDataFrame([("A", 2001, 12, 1, 1000), ("A", 2002, 1, 1, 1500), ("A", 2002, 3, 1, 3000)],
                                 "cat_id string, year int, month int, sales int, revenue_cents long")
    rows = {(r.year, r.month): r for r in marts.category_growth(fact).collect()}
    assert [rows[k].growth_pct for k in ((2001, 12), (2002, 1), (2002, 3))] == [0.0, 50.0, 0.0]
    assert rows[(2002, 3)].prev_revenue is None
