"""Registered queries over the driver's tables: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the whole driver tables (through the adapter in
``tillcast.sources.driver_tables``); nothing is capped or sampled except where the
limit is the feature (top-k reports, the series sample).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.operators import clean, features, forecast, kpi, marts, model, quality, reshape, trees
from tillcast.plans import base, pipeline
from tillcast.schemas import CALENDAR, METRICS_TABLE, MODEL_NAME, PRICES, SERIES_KEYS
from tillcast.session import materialize
from tillcast.sources import tables
from tillcast.sources.driver_tables import calendar_input, sales_lines, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FACT_COLUMNS = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id", "date", "sales",
                "wm_yr_wk", "weekday", "wday", "month", "year", "d",
                "event_name_1", "event_type_1", "event_name_2", "event_type_2",
                "snap_CA", "snap_TX", "snap_WI", "sell_price", "price_cents", "revenue_cents", "revenue"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- clean / reshape ------------------------------------------------------------

@query
def calendar_dim(spark, sf):
    return base.inputs(spark, sf).calendar


@query
def clean_calendar(spark, sf):
    return clean.clean_calendar(base.inputs(spark, sf).calendar)


@query
def clean_prices(spark, sf):
    return clean.clean_prices(base.inputs(spark, sf).prices)


@query
def dedupe_rows(spark, sf):
    return clean.dedupe(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def sample_series(spark, sf):
    directory = base.inputs(spark, sf).sales.select(*SERIES_KEYS).distinct()
    return clean.sample_series(directory, 100)


def _wide_daily(spark, sf):
    """All category × store series as a wide table over every history day (zeros kept).
    The day codes are read once from the calendar (a list bounded by the days)."""
    ri = base.inputs(spark, sf, "category")
    cal = clean.clean_calendar(ri.calendar)
    last = ri.sales.select(F.max("date")).scalar()
    codes = [r.d for r in cal.filter(F.col("date") <= last).orderBy("date").select("d").collect()]
    long = ri.sales.join(cal.select("date", "d"), "date")
    return reshape.pivot_daily(long, codes, SERIES_KEYS, fill=0)


@query
def melt_daily(spark, sf):
    return reshape.melt_daily(_wide_daily(spark, sf))


@query
def sales_fact(spark, sf):
    """Sales ⋈ calendar ⋈ weekly prices through the join operators (J1, J2)."""
    return base.joined_fact(spark, sf).select(*FACT_COLUMNS)


# --- gold -------------------------------------------------------------------------

def _gold(name):
    def q(spark, sf):
        return marts.gold_table(base.fact(spark, sf), name)
    q.__name__ = name
    return query(q)


for _name in marts.GOLD_KEYS:
    _gold(_name)


@query
def gold_all_grouping_sets(spark, sf):
    return (marts.gold_all(base.fact(spark, sf))
            .withColumnsRenamed({"_price_sum": "price_cents_sum", "_price_n": "price_rows"}))


@query
def gold_after_warmup(spark, sf):
    """Category sales over the post-warm-up feature table (the reference's
    default: each series' first 28 rows are left out of business totals)."""
    feats = features.lag_rolling_features(base.fact(spark, sf, "category"), drop_warmup=True)
    return marts.gold_table(feats, "gold_category_sales")


# --- features ---------------------------------------------------------------------

@query
def time_features(spark, sf):
    return base.fact(spark, sf).select("id", "date", "year", "month", "week", "is_weekend",
                                       "is_holiday", "quarter", "day_name", "week_of_year")


@query
def lag_rolling_features(spark, sf):
    return features.lag_rolling_features(base.fact(spark, sf, "category")).select(
        "id", "date", "sales", "lag_7", "lag_14", "lag_28", "rolling_7_avg", "rolling_30_avg")


@query
def calendar_lags(spark, sf):
    return features.calendar_lags(base.fact(spark, sf, "category")).select(
        "id", "date", "sales", "cal_lag_7", "cal_lag_14", "cal_lag_28")


@query
def calendar_rolling(spark, sf):
    return features.calendar_rolling(base.fact(spark, sf, "category")).select(
        "id", "date", "sales", "cal_rolling_7_avg", "cal_rolling_30_avg")


# --- priority-2 marts ---------------------------------------------------------------

@query
def dept_performance(spark, sf):
    return marts.dept_performance(base.fact(spark, sf))


@query
def product_avg_price(spark, sf):
    return marts.product_avg_price(base.fact(spark, sf))


@query
def holiday_sales(spark, sf):
    return marts.holiday_sales(base.fact(spark, sf))


@query
def seasonal_index(spark, sf):
    return marts.seasonal_index(base.fact(spark, sf))


@query
def monthly_growth(spark, sf):
    return marts.monthly_growth(base.fact(spark, sf))


@query
def category_growth(spark, sf):
    return marts.category_growth(base.fact(spark, sf))


@query
def product_growth(spark, sf):
    return marts.product_growth(base.fact(spark, sf))


@query
def store_vs_state(spark, sf):
    return marts.store_vs_state(base.fact(spark, sf))


# --- KPIs over the item fact ----------------------------------------------------------

KPI_STATE, KPI_CATEGORY = "AMERICA", "PROMO"


@query
def kpi_totals(spark, sf):
    return kpi.kpi_totals(base.fact(spark, sf))


@query
def kpi_wow_growth(spark, sf):
    return kpi.kpi_wow_growth(base.fact(spark, sf))


@query
def kpi_filtered(spark, sf):
    return kpi.kpi_filtered(base.fact(spark, sf), KPI_STATE, KPI_CATEGORY)


@query
def daily_trend(spark, sf):
    return kpi.daily_trend(base.fact(spark, sf))


@query
def category_share(spark, sf):
    return kpi.category_share(base.fact(spark, sf))


@query
def store_ranking(spark, sf):
    return kpi.store_ranking(base.fact(spark, sf))


@query
def top_products_5(spark, sf):
    return kpi.top_products(base.fact(spark, sf), 5)


@query
def worst_products_5(spark, sf):
    return kpi.top_products(base.fact(spark, sf), 5, worst=True)


@query
def top_products_10(spark, sf):
    return kpi.top_products(base.fact(spark, sf), 10)


# --- forecasting over the category × store series --------------------------------------

def _cat(spark, sf):
    """Forecast history and the cleaned calendar. The history is the training
    table ``gold_forecasting_input`` — category × store fact with lags and rolling
    means, warm-up rows dropped — as the forecaster reads it. It is written once
    (a table in the checkpoint folder): the recursion reads it for the state, the
    last date and the horizon."""
    cal = calendar_input(spark, sf)
    hist = materialize(features.lag_rolling_features(base.fact(spark, sf, "category", calendar=cal)), "history")
    return hist, clean.clean_calendar(cal[0])


def _rule_forecast(spark, sf, fact_and_cal=None):
    fact, cal = fact_and_cal or _cat(spark, sf)
    return forecast.recursive_forecast(fact, cal, forecast.weighted_lag_rule)


@query
def series_directory(spark, sf):
    return features.lag_rolling_features(base.fact(spark, sf, "category")).select(*SERIES_KEYS).distinct()


@query
def last_price(spark, sf):
    """The price part of the forecaster's state: the last known price, or the default."""
    hist = _cat(spark, sf)[0]
    return forecast.series_state(hist, forecast.last_date(hist)).select("id", F.col("sell_price").alias("last_price"))


@query
def forecast_horizon(spark, sf):
    fact, cal = _cat(spark, sf)
    return forecast.horizon(cal, forecast.last_date(fact))


@query
def chrono_split(spark, sf):
    hist = features.lag_rolling_features(base.fact(spark, sf, "category", materialize=True))
    return forecast.chrono_split(hist).groupBy("split").agg(F.count("*").alias("rows"))


@query
def forecast_recursive_rule(spark, sf):
    return _rule_forecast(spark, sf)


@query
def forecast_metrics_rule(spark, sf):
    return forecast.holdout_rule_metrics(_cat(spark, sf)[0])


@query
def forecast_daily(spark, sf):
    return kpi.forecast_daily(_rule_forecast(spark, sf))


@query
def forecast_totals(spark, sf):
    return kpi.forecast_totals(_rule_forecast(spark, sf))


@query
def forecast_band(spark, sf):
    return kpi.forecast_band(_rule_forecast(spark, sf))


@query
def forecast_points(spark, sf):
    fc = _cat(spark, sf)
    return kpi.forecast_points(marts.gold_table(fc[0], "gold_daily_sales"), _rule_forecast(spark, sf, fc))


@query
def history_vs_forecast(spark, sf):
    fc = _cat(spark, sf)
    return kpi.history_vs_forecast(fc[0], _rule_forecast(spark, sf, fc))


def _products(spark, sf):
    """Forecast history and calendar at item × store grain. These series are sparse, most have
    fewer rows than the warm-up, so the history is the whole fact: the state of a series is
    its last 30 calendar days by date, and a day without a sale is a day without a row."""
    cal = calendar_input(spark, sf)
    return base.fact(spark, sf, materialize=True, calendar=cal), clean.clean_calendar(cal[0])


@query
def forecast_products(spark, sf):
    """30 daily forecasts per product, over all its item × store series."""
    return kpi.forecast_products(_rule_forecast(spark, sf, _products(spark, sf)))


@query
def forecast_by_dimension(spark, sf):
    """The product forecasts by product, category, store and state."""
    return kpi.forecast_by_dimension(_rule_forecast(spark, sf, _products(spark, sf)))


@query
def forecast_record(spark, sf):
    """Forecast points with the newest stored accuracy beside them. Two runs are stored: one a
    month before the end of the history, one at its end."""
    hist, cal = _cat(spark, sf)
    last = forecast.last_date(hist)
    root = pipeline.scratch_root(spark, "models")
    runs = [forecast.holdout_rule_metrics(h).withColumn("run_date", d) for h, d in (
        (hist, last), (hist.filter(F.col("date") <= F.date_sub(last, 30)), F.date_sub(last, 30)))]
    tables.write(runs[0].unionByName(runs[1]), root, "models", METRICS_TABLE)
    points = kpi.forecast_points(marts.gold_table(hist, "gold_daily_sales"), _rule_forecast(spark, sf, (hist, cal)))
    return kpi.forecast_record(points, tables.read_metrics(spark, root))


@query
def feature_vector(spark, sf):
    return model.feature_vector(_cat(spark, sf)[0])


@query
def backtest_metrics(spark, sf):
    fact, cal = _cat(spark, sf)
    return forecast.backtest(fact, cal, forecast.weighted_lag_rule)


@query
def kpi_summary(spark, sf):
    fc = _cat(spark, sf)
    return kpi.kpi_summary(fc[0], _rule_forecast(spark, sf, fc))


@query
def kpi_summary_lists(spark, sf):
    fc = _cat(spark, sf)
    return kpi.kpi_summary_lists(fc[0], _rule_forecast(spark, sf, fc), products=base.fact(spark, sf))


@query
def question_context(spark, sf):
    questions = table(spark, sf, "conversations").filter(F.col("role") == "user").select(
        "conv_id", "turn", "text")
    fc = _cat(spark, sf)
    summary = kpi.kpi_summary(fc[0], _rule_forecast(spark, sf, fc))
    return kpi.question_context(questions, summary).select("conv_id", "turn", "prompt")


# --- learned forecaster (rows-only checks: no SQL equivalent of tree training) ---------

@query
def forecast_gbt(spark, sf):
    hist, cal = _cat(spark, sf)
    fitted = model.fit(hist)
    return forecast.recursive_forecast(hist, cal, fitted)


@query
def forecast_gbt_metrics(spark, sf):
    return model.holdout_metrics(_cat(spark, sf)[0])


@query
def forecast_gbt_saved(spark, sf):
    """The forecast of a model that was saved and loaded again; equals ``forecast_gbt``."""
    hist, cal = _cat(spark, sf)
    path = tables.path(pipeline.scratch_root(spark, "lake"), "models", MODEL_NAME)
    model.save(model.fit(hist), path)
    return forecast.recursive_forecast(hist, cal, model.load(path))


@query
def gbt_tree_scores(spark, sf):
    """Holdout rows scored by walking the saved trees as a table, without Spark ML: what was
    sold, what the trees say (not below 0), and whether it is off by more than the mean."""
    split = forecast.chrono_split(_cat(spark, sf)[0])
    train, rows = split.filter("split = 'train'"), split.filter("split = 'validation'")
    path = tables.path(pipeline.scratch_root(spark, "lake"), "models", MODEL_NAME)
    model.save(model.fit(train), path)
    forest = materialize(trees.forest(trees.nodes(spark, path)), "forest")
    scored = trees.score(rows, forest, ["id", "date"], depth=model.GBT_PARAMS["maxDepth"])
    mean = train.select(F.avg("sales")).scalar()
    p = F.greatest("prediction", F.lit(0.0))
    return (rows.select("id", "date", "sales").join(scored, ["id", "date"])
            .select("id", "date", "sales", F.round(p, 6).alias("prediction"),
                    (F.abs(p - F.col("sales")) < F.abs(mean - F.col("sales"))).alias("better_than_mean")))


# --- data quality ----------------------------------------------------------------------

PROFILE_COLUMNS = ["id", "item_id", "store_id", "state_id", "cat_id", "date", "sales", "wm_yr_wk",
                   "price_cents", "revenue_cents"]


@query
def profile_table(spark, sf):
    """Profile of the stored item fact (written once, then one job per column)."""
    return quality.profile(base.fact(spark, sf, materialize=True), PROFILE_COLUMNS)


@query
def quality_report(spark, sf):
    ri = base.inputs(spark, sf)
    li = table(spark, sf, "lineitem")
    extra = {
        "lineitem_unknown_part": li.join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"),
                                         "left_anti"),
        "lineitem_unknown_supplier": li.join(table(spark, sf, "supplier"),
                                             F.col("l_suppkey") == F.col("s_suppkey"), "left_anti"),
        "lineitem_duplicate_key": li.groupBy("l_orderkey", "l_linenumber").count().filter(F.col("count") > 1),
    }
    # Sales lines before grouping and prices before cleaning, written once (checkpoint
    # folder): eight checks read them.
    lines = sales_lines(spark, sf).select(
        F.concat_ws("_", "item_id", "store_id", F.lit("validation")).alias("id"), "store_id", "item_id", "date",
        F.col("qty").cast("int").alias("sales"))
    sales, prices = materialize(lines, "sales"), materialize(ri.prices, "prices")
    return quality.quality_report(sales, prices, clean.clean_calendar(ri.calendar), extra)


@query
def table_status(spark, sf):
    """Whole batch job on CSV files exported from the driver's tables (category
    grain, rule predictor), then the gold readiness report."""
    ri = base.inputs(spark, sf, "category")
    raw = pipeline.scratch_root(spark, "raw")
    pipeline.export_raw_csv(spark, clean.clean_calendar(ri.calendar), ri.prices, ri.sales, raw)
    cfg = pipeline.PipelineConfig(raw_dir=raw, root=pipeline.scratch_root(spark, "lake"), predictor="rule")
    return pipeline.run_pipeline(spark, cfg)


def _lake(spark, sf):
    """A folder for each layer, under the checkpoint folder."""
    return {layer: pipeline.scratch_root(spark, layer) for layer in pipeline.LAYERS}


@query
def csv_integrated(spark, sf):
    """Every cell of the integrated table that the CSV path makes (raw, bronze, silver)."""
    ri = base.inputs(spark, sf, "category", written=True)
    raw = pipeline.scratch_root(spark, "raw")
    pipeline.export_raw_csv(spark, clean.clean_calendar(ri.calendar), ri.prices, ri.sales, raw)
    cfg = pipeline.PipelineConfig(raw_dir=raw, root=_lake(spark, sf))
    pipeline.run_bronze(spark, cfg)
    pipeline.run_silver(spark, cfg)
    pipeline.run_integrated(spark, cfg)
    return tables.read(spark, cfg.root, "silver", "silver_integrated").select(*FACT_COLUMNS)


def _integrated(spark, sf):
    """The job's silver layer from the category × store fact, without the CSV files."""
    cfg = pipeline.PipelineConfig(raw_dir="", root=_lake(spark, sf), gbt_params={"maxIter": 5})
    calendar = calendar_input(spark, sf)
    tables.write(clean.clean_calendar(calendar[0]), cfg.root, "silver", "silver_calendar")
    fact = base.fact(spark, sf, "category", calendar=calendar)
    pipeline.write_integrated(fact.select(*FACT_COLUMNS), cfg)
    return cfg


@query
def silver_clustering(spark, sf):
    """How the integrated table lies in its files: ids in one file each, rows in order."""
    return tables.clustering_report(tables.read(spark, _integrated(spark, sf).root, "silver", "silver_integrated"))


@query
def status_ready(spark, sf):
    """The batch job from the integrated table on, with a trained model (few trees): the status
    is ``ready`` and the stored metrics are those of a model better than the mean."""
    cfg = _integrated(spark, sf)
    pipeline.run_features_and_gold(spark, cfg)
    pipeline.run_forecast(spark, cfg)
    return tables.status_record(spark, cfg.root).select(
        "status", "tables_ready", "model", (F.col("rmse") > 0).alias("has_rmse"), (F.col("mae") > 0).alias("has_mae"),
        (F.col("r2") > 0).alias("better_than_mean"))


@query
def schema_report(spark, sf):
    """The raw inputs' columns against the column contract, with their null cells."""
    ri = base.inputs(spark, sf)
    parts = [quality.schema_nulls(df, want).withColumn("input", F.lit(name)) for name, df, want in (
        ("calendar", ri.calendar, CALENDAR), ("prices", ri.prices, PRICES))]
    return parts[0].unionByName(parts[1])


# --- incremental (Structured Streaming) -------------------------------------------------

@query
def gold_daily_sales_stream(spark, sf):
    """The daily mart built incrementally: the fact lands as a feed of files (by
    day, as many as its size asks for), is streamed with ``availableNow`` two files per micro-batch,
    and the per-batch partials are summed. Same answer as ``gold_daily_sales``."""
    from tillcast.streaming import incremental
    f = base.fact(spark, sf).select("date", "year", "month", "wday", "is_holiday", "sales", "revenue_cents")
    root = pipeline.scratch_root(spark, "stream")
    f.repartition("date").write.parquet(f"{root}/feed")
    schema = spark.read.parquet(f"{root}/feed").schema
    incremental.run_daily_sales_stream(spark, f"{root}/feed", schema, f"{root}/partials",
                                       f"{root}/_checkpoint", max_files_per_trigger=2)
    return incremental.read_daily_sales(spark, f"{root}/partials")
