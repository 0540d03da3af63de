"""The learned forecaster: trees as a table, accuracy, a saved model, the forecast record."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillcast.operators import clean, features, forecast, kpi, model, trees
from tillcast.operators.calendar import calendar_dim
from tillcast.schemas import FEATURES
from tillcast.sources import tables

D0 = dt.date(2011, 1, 29)
DAYS = 120
KEYS = "id string, item_id string, dept_id string, cat_id string, store_id string, state_id string"


@pytest.fixture(scope="module")
def data(spark):
    """Six series with a weekly pattern, their calendar and the training table."""
    cal = clean.clean_calendar(calendar_dim(spark, D0, D0 + dt.timedelta(days=DAYS + 29)))
    rows = [(f"s{k}", f"s{k}", "D", "C", f"st{k % 2}", "T", D0 + dt.timedelta(days=i),
             5 * k + 3 * (i % 7) + (i * 13 + k) % 3, 1.5 + k) for k in range(6) for i in range(DAYS)]
    fact = spark.createDataFrame(rows, KEYS + ", date date, sales int, sell_price double")
    train = features.lag_rolling_features(features.time_features(fact.join(cal, "date"))).cache()
    return train, cal


@pytest.fixture(scope="module")
def saved(spark, data, tmp_path_factory):
    split = forecast.chrono_split(data[0], 20)
    fitted = model.fit(split.filter("split = 'train'"), maxIter=12, maxDepth=4)
    path = str(tmp_path_factory.mktemp("model") / "gbt")
    model.save(fitted, path)
    return fitted, path, split.filter("split = 'validation'")


def test_walked_trees_equal_the_model_on_every_row(spark, saved):
    fitted, path, rows = saved
    nodes = trees.nodes(spark, path)
    assert nodes.select("tree").distinct().count() == 12
    got = trees.score(rows, trees.forest(nodes), ["id", "date"], depth=4)
    want = fitted.transform(model.assemble(rows)).select("id", "date", F.col("prediction").alias("want"))
    both = got.join(want, ["id", "date"])
    assert both.count() == rows.count() > 100
    assert both.agg(F.max(F.abs(F.col("prediction") - F.col("want")))).first()[0] < 1e-9


def test_walk_without_enough_depth_stops_inside(spark, saved):
    """A depth below the trees' own ends at inner nodes, so the bound matters."""
    fitted, path, rows = saved
    got = trees.score(rows, trees.forest(trees.nodes(spark, path)), ["id", "date"], depth=1)
    want = fitted.transform(model.assemble(rows)).select("id", "date", F.col("prediction").alias("want"))
    assert got.join(want, ["id", "date"]).filter("abs(prediction - want) > 1e-6").count() > 0


def test_split_counts_name_the_features(spark, saved):
    rows = trees.split_counts(trees.nodes(spark, saved[1])).collect()
    assert {r.feature for r in rows} <= set(FEATURES) and sum(r.splits for r in rows) >= 12
    assert all(r.trees <= 12 for r in rows)


def test_model_is_better_than_the_mean(spark, data):
    m = model.holdout_metrics(data[0], days=20, maxIter=12, maxDepth=4).first()
    assert m.rows == 6 * 20 and m.r2 > 0.8 and m.mae <= m.rmse < 5


def test_saved_model_forecasts_as_the_one_in_memory(spark, data, saved):
    train, cal = data
    fitted, path, _ = saved
    fresh = spark.newSession()      # nothing of the fitting session but the folder
    assert model.load(path).getNumTrees == 12 and fresh.read.parquet(f"{path}/data").count() > 12
    one = {(r.id, r.date): r.sales for r in forecast.recursive_forecast(train, cal, fitted, days=6).collect()}
    two = {(r.id, r.date): r.sales for r in forecast.recursive_forecast(train, cal, model.load(path), days=6).collect()}
    assert one == two and len(one) == 6 * 6


def test_feature_vector_unpacks_in_the_learners_order(spark, data):
    rows = model.feature_vector(data[0], 20)
    assert rows.columns == ["id", "date", *FEATURES, "sales", "split"]
    plain = data[0].select("id", "date", *[F.col(c).cast("double").alias(c) for c in FEATURES])
    assert rows.select(*plain.columns).exceptAll(plain).isEmpty()
    assert rows.filter("split = 'validation'").count() == 6 * 20


def test_forecast_record_takes_the_newest_run(spark, scratch):
    points = spark.createDataFrame([(D0, "Historical", 1.0, 2.0)], "date date, type string, sales double, revenue double")
    none = kpi.forecast_record(points, tables.read_metrics(spark, scratch)).first()
    assert none.sales == 1.0 and none.rmse is None and none.r2 is None
    runs = spark.createDataFrame([(5, 2.0, 1.5, 0.5, D0), (5, 1.0, 0.5, 0.9, D0 + dt.timedelta(days=1)),
                                  (5, 3.0, 2.5, 0.1, D0 - dt.timedelta(days=9))], tables.METRICS_SCHEMA)
    tables.write(runs, scratch, "models", "evaluation_metrics")
    row = kpi.forecast_record(points, tables.read_metrics(spark, scratch)).first()
    assert (row.rmse, row.mae, row.r2) == (1.0, 0.5, 0.9)


def test_product_forecast_from_sparse_series(spark):
    """Series with a few rows each, shorter than any warm-up: every product is forecast, by
    the days that have rows."""
    last = D0 + dt.timedelta(days=59)
    sold = {("a", "x"): {0: 40, 7: 8, 14: 6}, ("a", "y"): {3: 10}, ("b", "x"): {45: 99}, ("b", "y"): {1: 4, 2: 5, 28: 9}}
    rows = [(f"{i}_{s}", i, "D", "C", s, "T", last - dt.timedelta(days=ago), n, 2.0)
            for (i, s), days in sold.items() for ago, n in days.items()]
    fact = spark.createDataFrame(rows, KEYS + ", date date, sales int, sell_price double")
    cal = clean.clean_calendar(calendar_dim(spark, D0, last + dt.timedelta(days=30)))
    fc = forecast.recursive_forecast(fact, cal, forecast.weighted_lag_rule)

    def expected(days):
        h, out = {-ago: n for ago, n in days.items()}, []
        for t in range(1, 31):
            def mean(k):
                v = [h[d] for d in range(t - k, t) if d in h]
                return sum(v) / len(v) if v else 0.0
            y = (0.4 * h.get(t - 7, 0) + 0.2 * h.get(t - 14, 0) + 0.1 * h.get(t - 28, 0) + 0.2 * mean(7) + 0.1 * mean(30))
            out.append(round(max(y, 0.0)))
            h[t] = out[-1]
        return out

    want = {}
    for (item, _), days in sold.items():
        for t, y in enumerate(expected(days), 1):
            units, stores = want.get((item, t), (0, 0))
            want[item, t] = (units + y, stores + (y > 0))
    got = {(r.item_id, (r.date - last).days): (r.total_units, r.stores) for r in kpi.forecast_products(fc).collect()}
    assert got == want
    by = {(r.dimension, r.key): r.n for r in kpi.forecast_by_dimension(fc).groupBy("dimension", "key")
          .agg(F.sum("total_units").alias("n")).collect()}
    assert set(by) == {("item_id", "a"), ("item_id", "b"), ("cat_id", "C"), ("store_id", "x"), ("store_id", "y"),
                       ("state_id", "T")}
    assert by["item_id", "a"] == sum(v for (i, _), (v, _) in want.items() if i == "a")
    assert by["cat_id", "C"] == by["state_id", "T"] == by["item_id", "a"] + by["item_id", "b"]
