import datetime as dt

from tillcast.operators import features

D0 = dt.date(2011, 1, 29)


def _series(spark, days, sid="s"):
    rows = [(sid, D0 + dt.timedelta(days=d), v) for d, v in days]
    return spark.createDataFrame(rows, "id string, date date, sales int")


def test_row_lags_and_warmup(spark):
    df = _series(spark, [(d, d + 1) for d in range(35)])
    all_rows = features.lag_rolling_features(df, drop_warmup=False).orderBy("date").collect()
    first = next(i for i, r in enumerate(all_rows) if r.lag_28 is not None)
    assert first == 28                                   # row 29 (1-based)
    assert all_rows[28].lag_28 == 1 and all_rows[34].lag_7 == 28 and all_rows[34].lag_14 == 21
    assert all_rows[1].rolling_7_avg == 1.0              # partial frame
    assert all_rows[10].rolling_7_avg == sum(range(4, 11)) / 7
    assert all_rows[34].rolling_30_avg == sum(range(5, 35)) / 30
    kept = features.lag_rolling_features(df).count()
    assert kept == 35 - 28


def test_row_lag_differs_from_calendar_lag_on_gaps(spark):
    # days 0..9 and 13..20: a 3-day hole
    df = _series(spark, [(d, d) for d in list(range(10)) + list(range(13, 21))])
    rows = {r.date: r for r in features.calendar_rolling(features.calendar_lags(
        features.lag_rolling_features(df, drop_warmup=False))).collect()}
    r = rows[D0 + dt.timedelta(days=15)]
    assert r.lag_7 == 5                       # 7 rows back
    assert r.cal_lag_7 == 8.0                 # day 8 exists
    assert rows[D0 + dt.timedelta(days=16)].cal_lag_7 == 9.0
    assert rows[D0 + dt.timedelta(days=19)].cal_lag_7 == 0.0   # day 12 is missing -> 0
    # calendar mean over [d-7, d): only days 13, 14 present for d = 15 ... plus 8, 9
    assert r.cal_rolling_7_avg == (8 + 9 + 13 + 14) / 4
    assert rows[D0].cal_rolling_7_avg == 0.0


def test_one_exchange_and_one_window_for_all_five_features(spark):
    df = _series(spark, [(d, d) for d in range(40)])
    plan = features.lag_rolling_features(df)._jdf.queryExecution().executedPlan().toString()
    lines = [ln.strip(" +-:") for ln in plan.splitlines()]
    assert sum(ln.startswith("Window [") for ln in lines) == 1
    assert sum(ln.startswith("Sort [") for ln in lines) == 1
    assert sum(ln.startswith("Exchange hashpartitioning(id") for ln in lines) == 1


def test_row_and_calendar_lags_agree_on_dense_data(spark):
    df = _series(spark, [(d, (d * 5) % 13) for d in range(60)]).unionByName(
        _series(spark, [(d, d % 4) for d in range(45)], sid="t"))
    full = features.calendar_rolling(features.calendar_lags(features.lag_rolling_features(df, drop_warmup=False)))
    rows = full.na.drop(subset=["lag_28"]).collect()      # compare where both definitions exist
    assert len(rows) == (60 - 28) + (45 - 28)
    for r in rows:
        assert (r.lag_7, r.lag_14, r.lag_28) == (r.cal_lag_7, r.cal_lag_14, r.cal_lag_28)
        assert r.rolling_7_avg == r.cal_rolling_7_avg and r.rolling_30_avg == r.cal_rolling_30_avg
