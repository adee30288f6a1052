"""Prediction intervals (ML12, ML43).

ML12 — per-tree prediction percentiles of a random forest, distributed:
the model reports each row's leaf per tree (``leafCol``); the leaf values are
read from the saved model (shared checkpoint folder) as one row of arrays —
its size is bounded by the model (trees x 2^depth), so it is broadcast; each
row looks its trees' values up and takes the percentiles of the sorted array.

ML43 — residual-quantile bounds: prediction + empirical residual quantiles
(one percentile aggregate, broadcast back).
"""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pennant.functions.safe import attach_scalars
from pennant.session import checkpoint_dir


def leaf_values(spark: SparkSession, model) -> DataFrame:
    """One row: ``__values``, an array over trees of the leaves' values (leaves in order of their node id).  Its size
    is bounded by the model: trees x 2^depth numbers."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/forest-{uuid.uuid4().hex}"
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").where(F.col("nodeData.leftChild") < 0)
    trees = nodes.groupBy(F.col("treeID").alias("tree")).agg(F.array_sort(F.collect_list(
        F.struct(F.col("nodeData.id").alias("id"), F.col("nodeData.prediction").alias("value")))).alias("leaves"))
    return trees.agg(F.array_sort(F.collect_list(F.struct("tree", F.transform("leaves", lambda x: x["value"]).alias("v")))).alias("t")) \
        .select(F.transform("t", lambda x: x["v"]).alias("__values"))


def sorted_percentile(values, p: float):
    """Linear interpolation at place p * (n - 1) of a sorted array, as ``percentile`` does."""
    place = (F.size(values) - 1) * F.lit(p)
    low = F.get(values, F.floor(place).cast("int"))
    return low + (F.get(values, F.ceil(place).cast("int")) - low) * (place - F.floor(place))


def tree_percentile_interval(spark: SparkSession, model, df: DataFrame, keys, level: float = 0.95) -> DataFrame:
    """Per row: forest prediction, mean of tree values (= prediction), and the
    (1-level)/2 and 1-(1-level)/2 percentiles of the per-tree predictions,
    looked up and sorted inside the row: rows are neither multiplied nor shuffled."""
    lower = (1 - level) / 2
    scored = model.copy().setLeafCol("__leaves").transform(df)
    rows = attach_scalars(scored.select(*keys, "prediction", vector_to_array("__leaves").alias("__leaves")), leaf_values(spark, model))
    rows = rows.withColumn("__v", F.array_sort(F.transform("__leaves", lambda leaf, i: F.get(F.get(F.col("__values"), i), leaf.cast("int")))))
    return rows.select(*keys, "prediction",
                       (F.aggregate("__v", F.lit(0.0), lambda a, x: a + x) / F.size("__v")).alias("tree_mean"),
                       sorted_percentile(F.col("__v"), lower).alias("lower"), sorted_percentile(F.col("__v"), 1 - lower).alias("upper"),
                       F.size("__v").cast("long").alias("n_trees"))


def residual_quantile_bounds(df: DataFrame, y="y", yhat="yhat", lower: float = 0.025, upper: float = 0.975,
                             calibration: DataFrame | None = None) -> DataFrame:
    """ML43 — yhat + quantiles of (y - yhat) measured on ``calibration`` rows
    (default: the same rows)."""
    cal = calibration if calibration is not None else df
    from pennant.operators.ranking import quantiles
    q = quantiles(cal.select((F.col(y) - F.col(yhat)).alias("__r")), "__r", [lower, upper]) \
        .withColumnRenamed("quantiles", "__q")
    j = attach_scalars(df, q)
    return j.withColumns({"lower_bound": F.col(yhat) + F.col("__q")[0],
                          "upper_bound": F.col(yhat) + F.col("__q")[1]}).drop("__q")
