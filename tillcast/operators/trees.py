"""Fitted boosted trees as a relational table, read from a saved model and walked by
column expressions: scoring without Spark ML.

The table has one row per tree: ``tree``, its ``weight`` in the sum and its ``nodes`` in the
order of their numbers. A node has ``feature`` (position in the feature list), ``threshold``,
the numbers of its children (``left`` where the feature is at most the threshold, else
``right``; -1 in a leaf) and the ``prediction`` of a leaf. The size is that of the model
(trees × nodes), not of the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.functions import columns as C
from tillcast.schemas import FEATURES

# Trees that are broadcast for scoring; a model beyond it is joined by a shuffle.
MAX_TREES = 10_000


def nodes(spark: SparkSession, path: str) -> DataFrame:
    """One row per node of the boosted-tree model saved at ``path``: ``tree, weight, node,
    feature, threshold, left, right, prediction``. Splits are on numbers; a model with
    categorical splits is refused."""
    data = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    weights = spark.read.parquet(f"{path}/treesMetadata").select(F.col("_1").alias("tree"), F.col("_3").alias("weight"))
    if not data.filter(F.col("split.numCategories") >= 0).isEmpty():
        raise ValueError(f"categorical splits in the model at {path}")
    return data.join(weights, "tree").select(
        "tree", "weight", F.col("id").alias("node"), F.col("split.featureIndex").alias("feature"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.col("leftChild").alias("left"), F.col("rightChild").alias("right"), "prediction")


def forest(node_rows: DataFrame) -> DataFrame:
    """``nodes`` gathered to one row per tree, with the tree's depth bound (its node count)."""
    parts = F.struct("node", "feature", "threshold", "left", "right", "prediction")
    return node_rows.groupBy("tree", "weight").agg(F.array_sort(F.collect_list(parts)).alias("nodes"))


def leaf(nodes_: Column, values: Column, depth: int) -> Column:
    """Prediction of the leaf that ``values`` (array, in the feature list's order) reaches."""
    def step(at: Column, _: Column) -> Column:
        node = F.get(nodes_, at)
        below = F.when(F.get(values, node["feature"]) <= node["threshold"], node["left"]).otherwise(node["right"])
        return F.when(node["left"] < 0, at).otherwise(below)

    at = F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step)
    return F.get(nodes_, at)["prediction"]


def score(rows: DataFrame, trees: DataFrame, keys: Sequence[str], depth: int,
          features: Sequence[str] = FEATURES) -> DataFrame:
    """``keys`` (unique per row) and ``prediction``: the weighted sum of the trees' leaves.
    Every row meets every tree by the tree's number (an inner join on a broadcast side of
    checked size), and the sums are combined before the shuffle."""
    count = trees.select(F.max("tree")).first()[0]
    if count is None:
        raise ValueError("the model has no trees")
    values = F.array(*[F.col(c).cast("double") for c in features])
    asked = rows.select(*keys, values.alias("_values"), F.explode(F.sequence(F.lit(0), F.lit(count))).alias("tree"))
    walked = asked.join(C.checked_broadcast(trees, MAX_TREES), "tree").select(
        *keys, (F.col("weight") * leaf(F.col("nodes"), F.col("_values"), depth)).alias("_part"))
    return walked.groupBy(*keys).agg(F.sum("_part").alias("prediction"))


def split_counts(node_rows: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """How often the trees split on each feature."""
    name = F.get(F.array(*map(F.lit, features)), F.col("feature"))
    return (node_rows.filter("left >= 0").groupBy(name.alias("feature"))
            .agg(F.count("*").alias("splits"), F.count_distinct("tree").alias("trees")))
