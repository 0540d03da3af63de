"""The batch job end to end on M5-shaped CSV files written by the test."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tillcast.operators import clean
from tillcast.operators.calendar import calendar_dim
from tillcast.plans import pipeline
from tillcast.sources import m5_csv, tables

D0 = dt.date(2011, 1, 29)
DAYS = 70


def _write_csv(path, header, rows):
    with open(path, "w") as f:
        f.write(",".join(header) + "\n")
        for r in rows:
            f.write(",".join("" if v is None else str(v) for v in r) + "\n")


def _raw(spark, raw):
    os.makedirs(raw, exist_ok=True)
    cal = calendar_dim(spark, D0, D0 + dt.timedelta(days=DAYS + 29)).collect()
    cal_cols = ["date", "wm_yr_wk", "weekday", "wday", "month", "year", "d", "event_name_1", "event_type_1",
                "event_name_2", "event_type_2", "snap_CA", "snap_TX", "snap_WI"]
    _write_csv(f"{raw}/{m5_csv.CALENDAR_FILE}", cal_cols, [[getattr(r, c) for c in cal_cols] for r in cal])
    weeks = sorted({r.wm_yr_wk for r in cal})
    series = [("FOODS_1_001", "FOODS_1", "FOODS", "CA_1", "CA"), ("FOODS_1_002", "FOODS_1", "FOODS", "TX_1", "TX"),
              ("HOBBIES_1_001", "HOBBIES_1", "HOBBIES", "CA_1", "CA")]
    prices = [(st, it, w, 1.25 + i) for i, (it, _, _, st, _) in enumerate(series) for w in weeks]
    prices.append(("CA_1", "FOODS_1_001", weeks[3], 0))           # dropped: not positive ... and duplicated key
    prices = [p for p in prices if not (p[1] == "HOBBIES_1_001" and p[2] == weeks[2])]   # one unpriced week
    _write_csv(f"{raw}/{m5_csv.PRICES_FILE}", ["store_id", "item_id", "wm_yr_wk", "sell_price"], prices)
    header = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"] + [f"d_{i}" for i in range(1, DAYS + 1)]
    rows = [[f"{it}_{st}_validation", it, dp, ct, st, sa] + [(i * (k + 2)) % 7 for i in range(DAYS)]
            for k, (it, dp, ct, st, sa) in enumerate(series)]
    rows.append(list(rows[0]))                                    # duplicate id
    _write_csv(f"{raw}/{m5_csv.SALES_FILE}", header, rows)
    return series, weeks


def test_missing_inputs_are_named(spark, scratch):
    try:
        m5_csv.read_raw(spark, scratch)
    except FileNotFoundError as e:
        assert "calendar.csv" in str(e) and "sales_train_validation.csv" in str(e)
    else:
        raise AssertionError("expected FileNotFoundError")


def test_pipeline_writes_every_layer(spark, scratch):
    raw = f"{scratch}/raw"
    _raw(spark, raw)
    cfg = pipeline.PipelineConfig(raw_dir=raw, root=f"{scratch}/lake", predictor="rule")
    status = {r.table: (r.exists, r.rows) for r in pipeline.run_pipeline(spark, cfg).collect()}
    # rule predictor: every table is there, no model was trained -> not "ready"
    assert all(status[t][0] for t in ["gold_daily_sales", "gold_forecast_results", "evaluation_metrics"])
    assert status["gbt_forecaster"][0] is False and "pending_etl" in status
    integrated = tables.read(spark, cfg.root, "silver", "silver_integrated")
    # 3 distinct series x 70 days, minus the unpriced week of one series
    unpriced = integrated.filter(F.col("id").startswith("HOBBIES")).count()
    assert integrated.count() == 2 * DAYS + unpriced and unpriced in (63, 64, 65)
    assert integrated.select("id", "date").distinct().count() == integrated.count()
    # every gold mart adds to the same total as the post-warm-up feature table
    gfi = tables.read(spark, cfg.root, "gold", "gold_forecasting_input")
    total = gfi.agg(F.sum("sales")).first()[0]
    for name in ["gold_daily_sales", "gold_store_performance", "gold_product_performance", "gold_category_sales",
                 "gold_state_sales", "gold_monthly_sales"]:
        assert tables.read(spark, cfg.root, "gold", name).agg(F.sum("total_units")).first()[0] == total, name
    fc = tables.read(spark, cfg.root, "gold", "gold_forecast_results")
    assert fc.count() == 3 * 30 and fc.select("date").distinct().count() == 30
    m = tables.read(spark, cfg.root, "models", "evaluation_metrics").first()
    assert m.rows > 0 and m.rmse >= 0


def test_clean_calendar_from_csv_fills_events(spark, scratch):
    raw = f"{scratch}/raw"
    _raw(spark, raw)
    cal = clean.clean_calendar(m5_csv.read_calendar(spark, f"{raw}/{m5_csv.CALENDAR_FILE}"))
    assert cal.filter(F.col("event_name_1").isNull()).count() == 0
    assert cal.filter(F.col("event_name_1") == "SuperBowl").count() == 1


def test_streamed_daily_mart_equals_batch_and_is_incremental(spark, scratch):
    from tillcast.operators import marts
    from tillcast.streaming import incremental
    rows = [(D0 + dt.timedelta(days=i % 9), 2011, 1, 1 + i % 7, i % 2, i % 5, (i % 5) * 125) for i in range(60)]
    cols = "date date, year int, month int, wday int, is_holiday int, sales int, revenue_cents long"
    df = spark.createDataFrame(rows, cols)
    feed = f"{scratch}/feed"
    df.filter("sales < 3").repartition(3).write.parquet(feed)
    args = (spark, feed, df.schema, f"{scratch}/partials", f"{scratch}/ckpt")
    incremental.run_daily_sales_stream(*args, max_files_per_trigger=1)
    df.filter("sales >= 3").repartition(2).write.mode("append").parquet(feed)
    incremental.run_daily_sales_stream(*args)        # picks up only the new files
    got = sorted(map(tuple, incremental.read_daily_sales(spark, f"{scratch}/partials").collect()))
    want = sorted(map(tuple, marts.gold_table(df, "gold_daily_sales").collect()))
    assert got == want


def test_pipeline_with_boosted_trees(spark, scratch):
    raw = f"{scratch}/raw"
    _raw(spark, raw)
    cfg = pipeline.PipelineConfig(raw_dir=raw, root=f"{scratch}/lake", predictor="gbt",
                                  gbt_params={"maxIter": 2, "maxDepth": 3})
    status = {r.table: r.exists for r in pipeline.run_pipeline(spark, cfg).collect()}
    assert all(status.values()) and "ready" in status
    fc = tables.read(spark, cfg.root, "gold", "gold_forecast_results")
    assert fc.count() == 3 * 30 and fc.filter("sales < 0").count() == 0
    from pyspark.ml.regression import GBTRegressionModel
    m = GBTRegressionModel.load(tables.path(cfg.root, "models", "gbt_forecaster"))
    assert m.getNumTrees == 2


def test_command_line_entry(spark, scratch, capsys):
    raw = f"{scratch}/raw"
    _raw(spark, raw)
    pipeline.main(["--raw", raw, "--root", f"{scratch}/lake", "--predictor", "rule", "--sample", "2"])
    out = capsys.readouterr().out
    assert "gold_forecast_results" in out and "pending_etl" in out
    # the sample (bronze) takes the first 2 rows by id before de-duplication (silver),
    # and the fixture's first id is duplicated
    assert tables.read(spark, f"{scratch}/lake", "bronze", "bronze_sales").count() == 2
    assert tables.read(spark, f"{scratch}/lake", "silver", "silver_sales").count() == 1


def test_each_layer_has_its_own_location(spark, scratch):
    """Raw and four layers in five unrelated folders, through writer, reader and readiness."""
    raw = f"{scratch}/in/raw"
    _raw(spark, raw)
    root = {"bronze": f"{scratch}/b", "silver": f"{scratch}/s/deep", "gold": f"{scratch}/g/", "models": f"{scratch}/m"}
    cfg = pipeline.PipelineConfig(raw_dir=raw, root=root, predictor="gbt", gbt_params={"maxIter": 2, "maxDepth": 2})
    status = {r.table: r.exists for r in pipeline.run_pipeline(spark, cfg).collect()}
    assert all(status.values()) and "ready" in status
    found = {layer: set(os.listdir(path)) for layer, path in root.items()}
    assert found["bronze"] == {"bronze_calendar", "bronze_prices", "bronze_sales"}
    assert "silver_integrated" in found["silver"] and "gold_forecast_results" in found["gold"]
    assert found["models"] == {"gbt_forecaster", "evaluation_metrics"}
    assert set(os.listdir(scratch)) == {"in", "b", "s", "g", "m"}
    record = tables.status_record(spark, root).first()
    assert record.status == "ready" and record.tables_ready == 6 and record.rmse >= 0
    # The integrated table: an id lies in one file, rows by id and day.
    report = tables.clustering_report(tables.read(spark, root, "silver", "silver_integrated")).first()
    assert report["keys"] == 3 and report.keys_in_several_files == 0 and report.rows_out_of_order == 0
    try:
        tables.path({"gold": "x"}, "silver", "t")
    except ValueError as e:
        assert "silver" in str(e)
    else:
        raise AssertionError("expected ValueError")


def test_status_before_the_first_run(spark, scratch):
    record = tables.status_record(spark, scratch).first()
    assert (record.status, record.tables_ready, record.model, record.rmse) == ("pending_etl", 0, False, None)


def test_clustering_report_sees_disorder(spark, scratch):
    rows = [(f"i{k % 3}", D0 + dt.timedelta(days=(k * 7) % 10)) for k in range(30)]
    spark.createDataFrame(rows, "id string, date date").repartition(3).write.parquet(f"{scratch}/t")
    report = tables.clustering_report(spark.read.parquet(f"{scratch}/t")).first()
    assert report.rows == 30 and report["keys"] == 3 and report.keys_in_several_files > 0 and report.rows_out_of_order > 0
    empty = spark.read.parquet(f"{scratch}/t").filter("false")
    assert tuple(tables.clustering_report(empty).first()) == (0, 0, 0, 0)
