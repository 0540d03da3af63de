"""The batch job: raw CSV → bronze → silver → integrated fact → features → gold →
model → forecast, each layer written once and read back by the next.

Writing every layer cuts lineage (a lost executor recomputes from the last
written table, not from the CSVs) and lets the seven gold outputs share one
feature computation instead of recomputing windows per table.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.operators import clean, fact, features, forecast, marts, model, reshape
from tillcast.operators.quality import require_columns
from tillcast.schemas import FEATURES, LAG_COLUMNS, METRICS_TABLE, MODEL_NAME, ROLLING_COLUMNS, SERIES_KEYS
from tillcast.session import checkpoint_dir
from tillcast.sources import m5_csv, tables


LAYERS = ("bronze", "silver", "gold", "models")


@dataclass
class PipelineConfig:
    raw_dir: str
    root: tables.Root               # any Hadoop URI, or one for each layer
    fmt: str = tables.FORMAT
    sample_limit: int = 0           # keep the first n series by id; 0 = all
    exclude_warmup: bool = True     # gold marts over post-warm-up rows (reference default)
    predictor: str = "gbt"          # "gbt" (Spark ML) or "rule" (weighted lags)
    gbt_params: dict = field(default_factory=dict)


def _w(df, cfg, layer, name):
    return tables.write(df, cfg.root, layer, name, cfg.fmt)


def _r(spark, cfg, layer, name):
    return tables.read(spark, cfg.root, layer, name, cfg.fmt)


def run_bronze(spark: SparkSession, cfg: PipelineConfig) -> None:
    raw = m5_csv.read_raw(spark, cfg.raw_dir)
    _w(raw.calendar, cfg, "bronze", "bronze_calendar")
    _w(raw.prices, cfg, "bronze", "bronze_prices")
    _w(clean.sample_series(raw.sales, cfg.sample_limit), cfg, "bronze", "bronze_sales")


def run_silver(spark: SparkSession, cfg: PipelineConfig) -> None:
    _w(clean.clean_calendar(_r(spark, cfg, "bronze", "bronze_calendar")), cfg, "silver", "silver_calendar")
    _w(clean.clean_prices(_r(spark, cfg, "bronze", "bronze_prices")), cfg, "silver", "silver_prices")
    _w(clean.dedupe(_r(spark, cfg, "bronze", "bronze_sales"), ["id"]), cfg, "silver", "silver_sales")


def run_integrated(spark: SparkSession, cfg: PipelineConfig) -> None:
    long = reshape.melt_daily(_r(spark, cfg, "silver", "silver_sales"))
    write_integrated(fact.sales_fact(long, _r(spark, cfg, "silver", "silver_calendar"),
                                     _r(spark, cfg, "silver", "silver_prices")), cfg)


def write_integrated(integrated: DataFrame, cfg: PipelineConfig) -> None:
    """Clustered by series and sorted by day: the feature windows downstream read each series
    from one place."""
    _w(integrated.repartition("id").sortWithinPartitions("id", "date"), cfg, "silver", "silver_integrated")


def run_features_and_gold(spark: SparkSession, cfg: PipelineConfig) -> None:
    base = features.time_features(_r(spark, cfg, "silver", "silver_integrated"))
    feats = features.lag_rolling_features(base, drop_warmup=False)
    _w(feats, cfg, "gold", "gold_features_all")
    feats = _r(spark, cfg, "gold", "gold_features_all")
    training = feats.na.drop(subset=LAG_COLUMNS + ROLLING_COLUMNS)
    _w(training, cfg, "gold", "gold_forecasting_input")
    source = _r(spark, cfg, "gold", "gold_forecasting_input") if cfg.exclude_warmup else feats
    _w(marts.gold_all(source), cfg, "gold", "gold_all")
    all_df = _r(spark, cfg, "gold", "gold_all")
    for name in marts.GOLD_KEYS:
        _w(marts.split_gold(all_df, name), cfg, "gold", name)


def run_forecast(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    hist = _r(spark, cfg, "gold", "gold_forecasting_input")
    require_columns(hist, FEATURES + ["sales", "date"] + SERIES_KEYS)
    calendar = _r(spark, cfg, "silver", "silver_calendar")
    if cfg.predictor == "gbt":
        metrics = model.holdout_metrics(hist, **cfg.gbt_params)
        # Refitted on all history and saved; what forecasts is the model read back.
        path = tables.path(cfg.root, "models", MODEL_NAME)
        model.save(model.fit(hist, **cfg.gbt_params), path)
        predictor = model.load(path)
    elif cfg.predictor == "rule":
        metrics = forecast.holdout_rule_metrics(hist)
        predictor = forecast.weighted_lag_rule
    else:
        raise ValueError(f"unknown predictor {cfg.predictor!r}")
    _w(metrics.withColumn("run_date", F.lit(_dt.date.today())), cfg, "models", METRICS_TABLE)
    # As the reference: the forecast history is the training table (post-warm-up
    # rows) — series directory, last prices, lag look-ups and the start date.
    fc = forecast.recursive_forecast(hist, calendar, predictor)
    _w(fc, cfg, "gold", "gold_forecast_results")
    return _r(spark, cfg, "gold", "gold_forecast_results")


def run_pipeline(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """Run every layer; returns the readiness table of the gold layer."""
    run_bronze(spark, cfg)
    run_silver(spark, cfg)
    run_integrated(spark, cfg)
    run_features_and_gold(spark, cfg)
    run_forecast(spark, cfg)
    return tables.table_status(spark, cfg.root, fmt=cfg.fmt)


def scratch_root(spark: SparkSession, tag: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tillcast-{tag}-{uuid.uuid4().hex[:8]}"


def export_raw_csv(spark: SparkSession, calendar: DataFrame, prices: DataFrame, sales: DataFrame,
                   raw_dir: str) -> None:
    """Write calendar, prices and wide daily sales as the three raw CSV files
    (wide over every history day of the calendar)."""
    last = sales.select(F.max("date")).scalar()
    hist_days = calendar.filter(F.col("date") <= last).orderBy("date")
    codes = [r.d for r in hist_days.select("d").collect()]   # one code per calendar day
    long = sales.join(calendar.select("date", "d"), "date")
    wide = reshape.pivot_daily(long, codes, SERIES_KEYS, fill=0)
    for df, name in ((calendar.withColumn("date", F.date_format("date", "yyyy-MM-dd")), m5_csv.CALENDAR_FILE),
                     (prices, m5_csv.PRICES_FILE), (wide, m5_csv.SALES_FILE)):
        # A folder of part files (each with its header) reads back as one CSV input.
        df.write.mode("overwrite").option("header", True).csv(f"{raw_dir}/{name}")


def main(argv: list[str] | None = None) -> None:
    """``python -m tillcast.plans.pipeline --raw <dir> --root <dir> [...]``"""
    import argparse

    from tillcast.session import build_session

    p = argparse.ArgumentParser(description="retail batch job: raw CSV -> gold tables and forecast")
    p.add_argument("--raw", required=True, help="folder with calendar.csv, sell_prices.csv, "
                                               "sales_train_validation.csv (any Hadoop URI)")
    p.add_argument("--root", required=True, help="lake root; layers go to <root>/<layer>/<table>")
    for layer in LAYERS:
        p.add_argument(f"--{layer}", help=f"folder of the {layer} layer (default: <root>/{layer})")
    p.add_argument("--format", default=tables.FORMAT)
    p.add_argument("--sample", type=int, default=0, help="first n series by id; 0 = all")
    p.add_argument("--full-history-marts", action="store_true",
                   help="gold marts over all rows instead of post-warm-up rows")
    p.add_argument("--predictor", choices=["gbt", "rule"], default="gbt")
    p.add_argument("--trees", type=int, default=None, help="boosted trees (default 150)")
    a = p.parse_args(argv)
    spark = build_session()
    root = {layer: getattr(a, layer) or f"{a.root.rstrip('/')}/{layer}" for layer in LAYERS}
    cfg = PipelineConfig(raw_dir=a.raw, root=root, fmt=a.format, sample_limit=a.sample,
                         exclude_warmup=not a.full_history_marts, predictor=a.predictor,
                         gbt_params={"maxIter": a.trees} if a.trees else {})
    run_pipeline(spark, cfg).show(truncate=False)


if __name__ == "__main__":
    main()
