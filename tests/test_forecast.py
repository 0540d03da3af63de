import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillcast.operators import clean, forecast, kpi
from tillcast.operators.calendar import calendar_dim

D0 = dt.date(2011, 1, 29)
KEYS = "id string, item_id string, dept_id string, cat_id string, store_id string, state_id string"


def rule(lag7, lag14, lag28, r7, r30):
    return 0.4 * lag7 + 0.2 * lag14 + 0.1 * lag28 + 0.2 * r7 + 0.1 * r30


def brute_force(history, days):
    """Plain-Python date-lookup recursion: the forecaster's semantics
    (lags by date, 0 if absent; means over rows in [d-k, d), 0 if none;
    clip at 0, round half to even)."""
    hist = {sid: dict(rows) for sid, rows in history.items()}
    out = {}
    for day in days:
        for sid, h in hist.items():
            def at(k):
                return float(h.get(day - dt.timedelta(days=k), 0.0))

            def mean(k):
                vals = [v for d, v in h.items() if day - dt.timedelta(days=k) <= d < day]
                return sum(vals) / len(vals) if vals else 0.0
            y = round(max(rule(at(7), at(14), at(28), mean(7), mean(30)), 0.0))  # half to even
            out[(sid, day)] = y
        for sid in hist:
            hist[sid][day] = out[(sid, day)]
    return out


def _fact(spark, history, price=2.0):
    rows = []
    for sid, pts in history.items():
        for d, v in pts:
            rows.append((sid, sid, "D", "C", "S", "T", d, v, price))
    return spark.createDataFrame(rows, KEYS + ", date date, sales int, sell_price double")


@pytest.fixture()
def history():
    last = D0 + dt.timedelta(days=59)
    a = [(D0 + dt.timedelta(days=i), (i * 7) % 11) for i in range(60)]
    b = [(D0 + dt.timedelta(days=i), 3 + i % 4) for i in range(60) if i % 5 != 2]     # gaps
    c = [(D0 + dt.timedelta(days=i), 9) for i in range(40)]                            # ends 20 days early
    return {"a": a, "b": b, "c": c}, last


def test_rule_recursion_equals_date_lookup_simulation(spark, history):
    hist, last = history
    cal = clean.clean_calendar(calendar_dim(spark, D0, last + dt.timedelta(days=30)))
    fc = forecast.recursive_forecast(_fact(spark, hist), cal, forecast.weighted_lag_rule).collect()
    want = brute_force(hist, [last + dt.timedelta(days=k) for k in range(1, 31)])
    got = {(r.id, r.date): r.sales for r in fc}
    assert got == want
    assert all(r.revenue == r.sales * 2.0 for r in fc)


def test_short_calendar_and_calendar_holes(spark, history):
    hist, last = history
    cal = clean.clean_calendar(calendar_dim(spark, D0, last + dt.timedelta(days=12)))
    fc = forecast.recursive_forecast(_fact(spark, hist), cal, forecast.weighted_lag_rule)
    assert fc.select("date").distinct().count() == 12
    tot = kpi.forecast_totals(fc).first()
    assert tot.forecast_days == 12 and tot.mean_daily_units == tot.forecast_units / 12
    # a calendar with a missing day: the state skips it, lags stay date-exact
    holey = cal.filter(F.col("date") != last + dt.timedelta(days=3))
    got = {(r.id, r.date): r.sales for r in
           forecast.recursive_forecast(_fact(spark, hist), holey, forecast.weighted_lag_rule).collect()}
    days = [last + dt.timedelta(days=k) for k in range(1, 13) if k != 3]
    assert got == brute_force(hist, days)


def test_last_price_and_default(spark, history):
    hist, last = history
    f = _fact(spark, hist).withColumn(
        "sell_price", F.when(F.col("date") == last, F.lit(None)).otherwise(F.col("sell_price") + F.dayofmonth("date")))
    st = {r.id: r.sell_price for r in forecast.series_state(f, F.lit(last)).collect()}
    assert st["a"] == 2.0 + (last - dt.timedelta(days=1)).day   # last non-null price
    none = f.withColumn("sell_price", F.lit(None).cast("double"))
    assert {r.sell_price for r in forecast.series_state(none, F.lit(last)).collect()} == {1.99}


def test_holdout_metrics_match_numpy(spark):
    import numpy as np
    y = np.array([3.0, 0.0, 5.0, 2.0])
    p = np.array([2.5, 0.0, 6.0, 2.0])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "sales double, prediction double")
    m = forecast.regression_metrics(df, digits=None).first()
    assert m.rmse == pytest.approx(float(np.sqrt(np.mean((p - y) ** 2))))
    assert m.mae == pytest.approx(float(np.mean(np.abs(p - y))))
    assert m.r2 == pytest.approx(1 - np.sum((p - y) ** 2) / np.sum((y - y.mean()) ** 2))


def test_gbt_recursion_runs_with_checkpoints(spark, history):
    from tillcast.operators import features, model
    from tillcast.operators.fact import sales_fact  # noqa: F401
    hist, last = history
    cal = clean.clean_calendar(calendar_dim(spark, D0, last + dt.timedelta(days=30)))
    f = _fact(spark, hist).join(cal, "date")
    f = features.time_features(f)
    train = features.lag_rolling_features(f)
    m = model.fit(train, maxIter=3, maxDepth=3)
    fc = forecast.recursive_forecast(f, cal, m).collect()
    assert len(fc) == 3 * 30
    assert all(r.sales >= 0 for r in fc)


def test_horizon_counts_each_date_once(spark, history):
    hist, last = history
    cal = clean.clean_calendar(calendar_dim(spark, D0, last + dt.timedelta(days=30)))
    doubled = cal.unionByName(cal.filter(F.col("date") == last + dt.timedelta(days=2)))
    hz = forecast.horizon(doubled, F.lit(last)).collect()
    assert len(hz) == 30 and len({r.date for r in hz}) == 30
