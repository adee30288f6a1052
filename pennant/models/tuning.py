"""Model selection (ML25-ML30): train many, cross-validate, out-of-fold
predictions, nested CV, grid search, parameter maps of a random search, learning curves.

Folds are a hash column (``split.kfold``) so every fit sees the same,
reproducible partition; folds are fitted in parallel (``parallelism``) on the
cached training frame.
"""

from __future__ import annotations

import math
import random
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pennant.operators.ranking import prefix_counts
from pennant.operators.split import kfold, learning_curve_subsets
from pennant.session import materialize


def evaluator(kind: str, label: str = "label", metric: str | None = None):
    if kind == "classification":
        return BinaryClassificationEvaluator(labelCol=label, metricName=metric or "areaUnderROC", numBins=0)
    return RegressionEvaluator(labelCol=label, metricName=metric or "rmse")


def train_many(spark: SparkSession, train: DataFrame, test: DataFrame, estimators: dict, kind: str,
               label: str = "label", own: dict | None = None) -> DataFrame:
    """ML25 — fit every estimator, score the test rows, continue past failures;
    a results table (model, metric, value, error).  ``own`` has training rows of single estimators, laid out for them."""
    ev = evaluator(kind, label)
    rows = []
    for name, est in estimators.items():
        try:
            m = est.fit((own or {}).get(name, train))
            rows.append((name, ev.getMetricName(), float(ev.evaluate(m.transform(test))), None))
        except Exception as e:  # noqa: BLE001 — the report records the failure
            rows.append((name, ev.getMetricName(), None, f"{type(e).__name__}: {str(e)[:200]}"))
    return spark.createDataFrame(rows, "model string, metric string, value double, error string")


def best_model(results: DataFrame, higher_is_better: bool = True) -> DataFrame:
    """ML25 — pick the best row (``max_by``/``min_by`` on the results table)."""
    pick = F.max_by if higher_is_better else F.min_by
    return results.where(F.col("value").isNotNull()).agg(pick("model", "value").alias("best_model"),
                                                        (F.max if higher_is_better else F.min)("value").alias("best_value"))


def scored_rows(model, rows: DataFrame, kind: str, label: str) -> DataFrame:
    """``y`` and ``s`` (probability of the positive class, or the prediction) of a fitted model's rows."""
    got = model.transform(rows)
    if kind == "classification":
        s = vector_to_array("probability" if "probability" in got.columns else "rawPrediction")[1]
    else:
        s = F.col("prediction").cast("double")
    return got.select(F.col(label).cast("double").alias("y"), s.alias("s"))


def metric_by(scored: DataFrame, keys: list[str], kind: str) -> DataFrame:
    """``keys``, ``n``, ``value``: the metric of every group of scored rows at once: the exact area under the ROC curve (null
    where a group has one class), or the root mean squared error.  However many models, it is the same few jobs."""
    if kind != "classification":
        return scored.groupBy(*keys).agg(F.count("*").alias("n"), F.sqrt(F.avg((F.col("s") - F.col("y")) ** 2)).alias("value"))
    hist = scored.groupBy(*keys, "s").agg(F.sum("y").cast("long").alias("pos"), F.sum(1 - F.col("y")).cast("long").alias("neg"))
    below = prefix_counts(hist, keys, "s", "neg")
    got = below.groupBy(*keys).agg(F.sum(F.col("pos") + F.col("neg")).alias("n"), F.sum("pos").alias("p"), F.sum("neg").alias("q"),
                                   F.sum(F.col("pos") * (F.col("__below") + F.col("neg") / 2)).alias("area"))
    return got.select(*keys, "n", F.try_divide("area", (F.col("p") * F.col("q")).cast("double")).alias("value"))


def cross_validate(spark: SparkSession, train: DataFrame, estimator, kind: str, keys, k: int = 5,
                   label: str = "label", seed: int = 42, grid=None, parallelism: int = 4):
    """ML26 — cross-validation over a hash fold column: per parameter map the mean, std, min and max of the fold metric,
    the mean of the metric on the training folds and its gap to the test folds.  Folds and maps are fitted
    ``parallelism`` at a time on the cached frame; all models are scored and measured together (:func:`metric_by`), so
    the jobs besides the fits do not grow with the maps; the best map is fitted again on all rows.  Folds whose
    held-out rows are of one class have no area under a curve and are left out of the means."""
    d = kfold(train, keys, k, seed).persist()
    grid = grid or ParamGridBuilder().build()

    def one(job):
        i, f = job
        return i, f, estimator.fit(d.where(F.col("fold") != f), grid[i])

    with ThreadPoolExecutor(parallelism) as pool:
        done = list(pool.map(one, [(i, f) for i in range(len(grid)) for f in range(k)]))
    parts = [scored_rows(m, rows, kind, label).select("*", F.lit(i).alias("param_index"), F.lit(f).alias("fold"), F.lit(held).alias("held"))
             for i, f, m in done for held, rows in ((True, d.where(F.col("fold") == f)), (False, d.where(F.col("fold") != f)))]
    got = metric_by(reduce(DataFrame.unionByName, parts), ["param_index", "fold", "held"], kind)
    test, fit = F.when(F.col("held"), F.col("value")), F.when(~F.col("held"), F.col("value"))
    names = spark.createDataFrame([(i, str({p.name: v for p, v in pm.items()})) for i, pm in enumerate(grid)], "param_index int, params string")
    table = got.groupBy("param_index").agg(F.avg(test).alias("mean_score"), F.stddev_pop(test).alias("std_score"), F.min(test).alias("min_score"),
                                           F.max(test).alias("max_score"), F.avg(fit).alias("train_score"))
    rows = names.join(table, "param_index", "left").withColumn("train_gap", F.col("train_score") - F.col("mean_score")).orderBy("param_index").collect()
    better = max if kind == "classification" else min
    scores = [r["mean_score"] for r in rows if r["mean_score"] is not None]
    pick = next((r["param_index"] for r in rows if scores and r["mean_score"] == better(scores)), 0)
    model = estimator.fit(d.drop("fold"), grid[pick])
    d.unpersist()
    return model, spark.createDataFrame(rows, "param_index int, params string, mean_score double, std_score double, min_score double, "
                                              "max_score double, train_score double, train_gap double")


def random_param_maps(space: dict, n_iter: int = 50, seed: int = 42) -> list[dict]:
    """ML29 — seeded random search: ``n_iter`` maps drawn without repeats from the product of the value lists (lists or
    ranges); all of them if the space is smaller.  50 is the reference's ``n_iter``."""
    size = math.prod(len(v) for v in space.values())
    maps = []
    for place in random.Random(seed).sample(range(size), min(n_iter, size)):
        drawn = {}
        for name, values in space.items():
            place, i = divmod(place, len(values))
            drawn[name] = values[i]
        maps.append(drawn)
    return maps


def out_of_fold(train: DataFrame, estimator, keys, k: int = 5, seed: int = 42) -> DataFrame:
    """ML27 — union of per-fold scores of models that never saw the fold."""
    d = materialize(kfold(train, keys, k, seed))
    parts = [estimator.fit(d.where(F.col("fold") != f)).transform(d.where(F.col("fold") == f)) for f in range(k)]
    return reduce(DataFrame.unionByName, parts)


def nested_cv(spark, train: DataFrame, estimator, grid, kind: str, keys, outer: int = 3, inner: int = 3,
              label: str = "label") -> DataFrame:
    """ML28 — outer folds around an inner CrossValidator; outer test scores."""
    d = kfold(train, keys, outer, seed=7).withColumnRenamed("fold", "outer_fold").persist()
    ev = evaluator(kind, label)
    rows = []
    for f in range(outer):
        tr, te = d.where(F.col("outer_fold") != f), d.where(F.col("outer_fold") == f)
        m, _ = cross_validate(spark, tr.drop("outer_fold"), estimator, kind, keys, inner, label, grid=grid)
        rows.append((f, float(ev.evaluate(m.transform(te.drop("outer_fold"))))))
    d.unpersist()
    return spark.createDataFrame(rows, "outer_fold int, score double")


def learning_curve(spark, train: DataFrame, test: DataFrame, estimator, kind: str, keys,
                   fractions=(0.1, 0.25, 0.5, 0.75, 1.0), label: str = "label") -> DataFrame:
    """ML30 — nested hash subsets; train / validation score per size and a
    bias-variance diagnosis (gap > 0.1 -> high variance; val < 0.7 -> high bias).
    All models are measured together."""
    subsets = materialize(learning_curve_subsets(train, keys, fractions))
    parts = []
    for f in fractions:
        own = subsets.where(F.col("fraction") == f).drop("fraction")
        m = estimator.fit(own)
        parts += [scored_rows(m, rows, kind, label).select("*", F.lit(float(f)).alias("fraction"), F.lit(part).alias("part"))
                  for part, rows in (("train", own), ("val", test))]
    got = metric_by(reduce(DataFrame.unionByName, parts), ["fraction", "part"], kind)
    pick = lambda part, c: F.max(F.when(F.col("part") == part, F.col(c)))
    r = got.groupBy("fraction").agg(pick("train", "n").cast("long").alias("n_train"), pick("train", "value").alias("train_score"),
                                    pick("val", "value").alias("val_score"))
    gap = F.col("train_score") - F.col("val_score")
    return r.withColumn("diagnosis", F.when(gap > 0.1, "high variance").when(F.col("val_score") < 0.7, "high bias")
                        .otherwise("good fit"))
