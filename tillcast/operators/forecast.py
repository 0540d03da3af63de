"""Chronological split, holdout metrics and the recursive 30-day forecast.

Recursive forecast without a shuffle per day
--------------------------------------------
State per series is ``h``: the sales of the last 30 calendar days before the day
being forecast (slot 30 = the day before, null where the series has no row). For
each horizon day the features are read from the state — lag k = ``h[31-k]``
(0 when null), rolling means = mean of the non-null slots of the last 7 / 30 —
the predictor runs, the prediction is clipped at 0 and rounded half-to-even, and
the state shifts by one slot. Thirty days is the longest look-back, so this equals
looking every lag up by date in the growing history.

* The initial state comes from **one** aggregation over the fact keyed by series:
  last price and at most 30 ``(slot, sales)`` pairs (the fact has one row per
  series and day, so the list is bounded by 30 whatever the data volume).
* A predictor given as a Column expression runs all horizon days inside one
  ``aggregate`` higher-order function over the horizon array: one narrow stage.
* A fitted Spark ML model runs one narrow ``transform`` per day; lineage is cut
  by writing the state into the cluster's checkpoint folder every few days.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.functions import columns as C
from tillcast.operators.clean import dedupe
from tillcast.schemas import FEATURES, SERIES_KEYS
from tillcast.session import materialize

HORIZON_DAYS = 30
STATE_DAYS = 30
HOLDOUT_DAYS = 30
CAL_FEATURES = ["wday", "month", "year", "is_weekend", "is_holiday", "snap_CA", "snap_TX", "snap_WI"]

Predictor = Callable[[dict], Column]


def last_date(fact: DataFrame) -> Column:
    """Latest history date as a scalar subquery (one partial max per task)."""
    return fact.select(F.max("date")).scalar()


def chrono_split(fact: DataFrame, days: int = HOLDOUT_DAYS) -> DataFrame:
    """Tag rows ``train`` (date <= last - days) or ``validation``."""
    cut = F.date_sub(last_date(fact), days)
    return fact.withColumn("split", F.when(F.col("date") <= cut, "train").otherwise("validation"))


def horizon(calendar: DataFrame, after: Column, days: int = HORIZON_DAYS) -> DataFrame:
    """The first ``days`` distinct calendar dates after ``after`` with the model's
    calendar features (calendar must be cleaned: empty event names, integer
    columns). A date listed twice counts once, with a deterministic row."""
    future = dedupe(calendar.filter(F.col("date") > after), ["date"])
    cal = future.orderBy("date").limit(days)
    return cal.select(
        "date",
        *[F.col(c).cast("int").alias(c) for c in ["wday", "month", "year"]],
        C.is_weekend("wday").alias("is_weekend"),
        C.is_holiday("event_name_1").alias("is_holiday"),
        *[F.col(c).cast("int").alias(c) for c in ["snap_CA", "snap_TX", "snap_WI"]],
    )


def series_state(fact: DataFrame, as_of: Column) -> DataFrame:
    """One row per series: keys, last known price and the 30-slot sales state
    ending at ``as_of`` (rows after ``as_of`` are ignored)."""
    hist = fact.filter(F.col("date") <= as_of)
    slot = F.datediff(F.col("date"), as_of) + STATE_DAYS  # 1..30 inside the window
    recent = F.when(slot >= 1, F.struct(slot.alias("k"), F.col("sales").cast("double").alias("v")))
    g = hist.groupBy(*SERIES_KEYS).agg(
        F.max_by(F.when(F.col("sell_price").isNotNull(), F.col("sell_price")),
                 F.when(F.col("sell_price").isNotNull(), F.col("date"))).alias("last_price"),
        F.map_from_entries(F.collect_list(recent)).alias("_recent"))
    h = F.transform(F.sequence(F.lit(1), F.lit(STATE_DAYS)), lambda i: F.try_element_at("_recent", i))
    price = F.coalesce(F.col("last_price"), F.lit(C.DEFAULT_PRICE))
    return g.select(*SERIES_KEYS, price.alias("sell_price"), h.alias("h"))


def _mean_nonnull(arr: Column) -> Column:
    acc0 = F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("n"))
    return F.aggregate(
        arr, acc0,
        lambda a, x: F.when(x.isNull(), a).otherwise(F.struct((a["s"] + x).alias("s"), (a["n"] + 1).alias("n"))),
        lambda a: F.when(a["n"] == 0, F.lit(0.0)).otherwise(a["s"] / a["n"]))


def _state_features(h: Column) -> dict:
    feats = {f"lag_{k}": F.coalesce(F.element_at(h, -k), F.lit(0.0)) for k in (7, 14, 28)}
    feats["rolling_7_avg"] = _mean_nonnull(F.slice(h, -7, 7))
    feats["rolling_30_avg"] = _mean_nonnull(h)
    return feats


def _shift(h: Column, gap: Column) -> Column:
    """State after ``gap - 1`` days without a row (calendar holes): pad with nulls,
    keep the last 30 slots."""
    pad = F.array_repeat(F.lit(None).cast("double"), F.greatest(gap - 1, F.lit(0)))
    return F.slice(F.concat(h, pad), -STATE_DAYS, STATE_DAYS)


def finish(pred: Column) -> Column:
    """Clip at zero and round half to even."""
    return F.rint(F.greatest(pred, F.lit(0.0)))


def weighted_lag_rule(f: dict) -> Column:
    """The rule predictor used for exact checks: a fixed blend of lags and means."""
    return (F.lit(0.4) * f["lag_7"] + F.lit(0.2) * f["lag_14"] + F.lit(0.1) * f["lag_28"]
            + F.lit(0.2) * f["rolling_7_avg"] + F.lit(0.1) * f["rolling_30_avg"])


def _horizon_array(hz: DataFrame) -> Column:
    """The (≤ 30-row) horizon as one array of structs, a scalar subquery."""
    return hz.select(F.array_sort(F.collect_list(F.struct(*hz.columns)))).scalar()


def recursive_forecast_expr(state: DataFrame, hz: DataFrame, start: Column,
                            predictor: Predictor) -> DataFrame:
    """Recursive forecast with a Column predictor: all days in one projection."""
    # Subqueries may not sit inside a lambda: bind horizon and start to columns first.
    state = state.withColumns({"_days": _horizon_array(hz), "_start": start})
    out_t = "array<struct<date:date,sales:double>>"
    acc0 = F.struct(F.col("h").alias("h"), F.col("_start").alias("prev"), F.array().cast(out_t).alias("out"))

    def step(acc, day):
        hs = _shift(acc["h"], F.datediff(day["date"], acc["prev"]))
        feats = _state_features(hs)
        feats["sell_price"] = F.col("sell_price")
        feats.update({c: day[c] for c in CAL_FEATURES})
        y = finish(predictor(feats))
        return F.struct(
            F.slice(F.concat(hs, F.array(y)), -STATE_DAYS, STATE_DAYS).alias("h"),
            day["date"].alias("prev"),
            F.concat(acc["out"], F.array(F.struct(day["date"].alias("date"), y.alias("sales")))).alias("out"))

    run = state.withColumn("_out", F.aggregate("_days", acc0, step, lambda a: a["out"]))
    return _explode(run)


def _explode(run: DataFrame) -> DataFrame:
    rows = run.select(*SERIES_KEYS, "sell_price", F.explode("_out").alias("_p"))
    cents = C.to_cents("sell_price")
    sales = F.col("_p.sales").cast("int")
    return rows.select("id", F.col("_p.date").alias("date"), "item_id", "dept_id", "cat_id", "store_id",
                       "state_id", "sell_price", sales.alias("sales"),
                       C.from_cents(sales.cast("long") * cents).alias("revenue"))


def recursive_forecast_model(state: DataFrame, hz: DataFrame, start: Column, model: Transformer,
                             checkpoint_every: int = 5) -> DataFrame:
    """Recursive forecast with a fitted Spark ML regressor (features column
    ``features``). One narrow map over the series per day; the ≤ 30 horizon rows
    are read once to drive the loop. Lineage is cut every ``checkpoint_every``
    days by writing the state to the shared checkpoint folder (survives executor
    loss; computed once)."""
    spark = state.sparkSession
    days = hz.orderBy("date").collect()
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep")
    out_t = "array<struct<date:date,sales:double>>"
    cur = state.withColumns({"prev": start, "_out": F.array().cast(out_t)})
    for i, day in enumerate(days, 1):
        hs = _shift(F.col("h"), F.datediff(F.lit(day["date"]), F.col("prev")))
        cur = cur.withColumn("h", hs)
        feats = _state_features(F.col("h"))
        feats.update({c: F.lit(day[c]) for c in CAL_FEATURES})
        cur = cur.withColumns({k: v.cast("double") for k, v in feats.items() if k != "sell_price"})
        scored = model.transform(assembler.transform(cur))
        y = finish(F.col("prediction"))
        cur = scored.withColumns({
            "h": F.slice(F.concat(F.col("h"), F.array(y)), -STATE_DAYS, STATE_DAYS),
            "prev": F.lit(day["date"]),
            "_out": F.concat("_out", F.array(F.struct(F.lit(day["date"]).alias("date"), y.alias("sales")))),
        }).select(*SERIES_KEYS, "sell_price", "h", "prev", "_out")
        if i % checkpoint_every == 0 and i < len(days):
            cur = materialize(cur, "forecast-state")
    return _explode(cur)


def recursive_forecast(fact: DataFrame, calendar: DataFrame, predictor, as_of: Column | None = None,
                       days: int = HORIZON_DAYS) -> DataFrame:
    """``gold_forecast_results``: ``days`` recursive daily forecasts per series,
    starting after ``as_of`` (default: the latest history date of the fact)."""
    start = as_of if as_of is not None else last_date(fact)
    state = series_state(fact, start)
    hz = horizon(calendar, start, days)
    if isinstance(predictor, Transformer):
        return recursive_forecast_model(state, hz, start, predictor)
    return recursive_forecast_expr(state, hz, start, predictor)


# --- metrics ----------------------------------------------------------------------------

def regression_metrics(df: DataFrame, label: str = "sales", pred: str = "prediction",
                       digits: int | None = 6) -> DataFrame:
    """RMSE, MAE and R² in one aggregate. SS_tot uses the sums identity
    ``Σy² − (Σy)²/n``, exact for integer labels."""
    e = F.col(pred) - F.col(label)
    y = F.col(label).cast("double")
    n = F.count("*")
    sse, sy, syy = F.sum(e * e), F.sum(y), F.sum(y * y)
    sst = syy - sy * sy / n
    m = df.agg(n.alias("rows"), F.sqrt(sse / n).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
               F.when(sst > 0, F.lit(1.0) - sse / sst).alias("r2"))
    if digits is not None:
        m = m.select("rows", *[F.round(c, digits).alias(c) for c in ("rmse", "mae", "r2")])
    return m


def holdout_rule_metrics(features: DataFrame, predictor: Predictor = weighted_lag_rule,
                         days: int = HOLDOUT_DAYS) -> DataFrame:
    """One-step holdout: predict the validation rows from their true features
    (clipped, not rounded), then A20 metrics."""
    val = chrono_split(features, days).filter(F.col("split") == "validation")
    feats = {c: F.col(c).cast("double") for c in FEATURES}
    scored = val.withColumn("prediction", F.greatest(predictor(feats), F.lit(0.0)))
    return regression_metrics(scored)


def backtest(fact: DataFrame, calendar: DataFrame, predictor, days: int = HORIZON_DAYS) -> DataFrame:
    """Forecast accuracy over the horizon: run the recursion from ``last - days``
    and score every step against what happened (no row = 0 units sold)."""
    cut = F.date_sub(last_date(fact), days)
    fc = recursive_forecast(fact, calendar, predictor, as_of=cut, days=days)
    actual = fact.select("id", "date", F.col("sales").alias("actual"))
    joined = (fc.join(actual, ["id", "date"], "left")
              .withColumns({"actual": F.coalesce("actual", F.lit(0)),
                            "step": F.datediff("date", cut)}))
    e = (F.col("sales") - F.col("actual")).cast("double")
    return joined.groupBy("step", "date").agg(
        F.count("*").alias("rows"),
        F.sum("actual").alias("actual_units"), F.sum("sales").alias("forecast_units"),
        F.round(F.sqrt(F.avg(e * e)), 6).alias("rmse"), F.round(F.avg(F.abs(e)), 6).alias("mae"))
