"""Boosted-tree sales model on Spark ML (the forecaster's learner).

One global model over all series, trained on the cluster: ``VectorAssembler`` over
the 14 features, ``GBTRegressor`` with the reference's settings (150 trees,
learning rate 0.08, depth 6, row and column subsampling 0.8, seed 42).
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.operators import forecast
from tillcast.operators.quality import require_columns
from tillcast.schemas import FEATURES, TARGET
from tillcast.session import checkpoint_dir

GBT_PARAMS = dict(maxIter=150, stepSize=0.08, maxDepth=6, subsamplingRate=0.8,
                  featureSubsetStrategy="0.8", seed=42)


def assemble(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep").transform(
        df.withColumns({c: F.col(c).cast("double") for c in FEATURES}))


def fit(train: DataFrame, **overrides) -> GBTRegressionModel:
    """Fit on a feature table (``gold_forecasting_input``). Tree lineage is
    checkpointed every 10 iterations into the shared checkpoint folder."""
    require_columns(train, FEATURES + [TARGET])
    checkpoint_dir(train.sparkSession)
    params = {**GBT_PARAMS, **overrides}
    gbt = GBTRegressor(featuresCol="features", labelCol=TARGET, checkpointInterval=10, **params)
    return gbt.fit(assemble(train).withColumn(TARGET, F.col(TARGET).cast("double")))


def save(fitted: GBTRegressionModel, path: str) -> None:
    """Save to any shared file system, over an older model."""
    fitted.write().overwrite().save(path)


def load(path: str) -> GBTRegressionModel:
    """A saved model, ready to score in any session."""
    return GBTRegressionModel.load(path)


def feature_vector(df: DataFrame, days: int = forecast.HOLDOUT_DAYS) -> DataFrame:
    """The assembled feature vectors unpacked: ``id``, ``date``, the 14 features as the learner
    sees them (doubles, in its order), the target and the chronological split."""
    rows = forecast.chrono_split(assemble(df), days).withColumn("_v", vector_to_array("features"))
    return rows.select("id", "date", *[F.get("_v", F.lit(i)).alias(c) for i, c in enumerate(FEATURES)],
                       F.col(TARGET).cast("double").alias(TARGET), "split")


def holdout_metrics(features: DataFrame, days: int = forecast.HOLDOUT_DAYS, **overrides) -> DataFrame:
    """Train on ``date <= last - days``, score the rest with its true lags, clip
    predictions at 0, report RMSE / MAE / R²."""
    split = forecast.chrono_split(features, days)
    model = fit(split.filter(F.col("split") == "train"), **overrides)
    scored = model.transform(assemble(split.filter(F.col("split") == "validation")))
    scored = scored.withColumn("prediction", F.greatest("prediction", F.lit(0.0)))
    return forecast.regression_metrics(scored)
