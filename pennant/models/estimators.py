"""Estimators on MLlib (ML1-ML8, ML11, ML14-ML18).

Training data is a DataFrame with a ``features`` vector (``VectorAssembler``)
and a label; fits are distributed MLlib jobs.  Class balancing uses a
weight column ``n / (k * n_class)`` computed with one aggregation.  Forests
cache each row's node id between levels (``cacheNodeIds``: same model, ~35 %
faster at depth 10 than re-shipping the trees); boosted trees, one small tree
at a time, do not: there the cache costs more than it saves.
"""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier, OneVsRest, RandomForestClassifier)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pennant.functions.safe import attach_scalars
from pennant.session import materialize


def assemble(df: DataFrame, features, out: str = "features", handle_invalid: str = "error") -> DataFrame:
    """CL20 — ordered feature vector; missing columns are reported together."""
    missing = [c for c in features if c not in df.columns]
    if missing:
        raise ValueError(f"missing feature columns: {missing}")
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid=handle_invalid).transform(df)


def scaler(with_mean: bool = True, with_std: bool = True, input_col="features", output_col="scaled") -> StandardScaler:
    """ML1 — fitted on the training split only (caller passes train rows)."""
    return StandardScaler(inputCol=input_col, outputCol=output_col, withMean=with_mean, withStd=with_std)


def balanced_weights(df: DataFrame, label: str = "label", out: str = "weight", train=None) -> DataFrame:
    """n / (k * n_c) per class (sklearn ``class_weight='balanced'``).  With ``train`` (a condition) only those rows are
    counted and weighted; the others have weight 1, so no held-out label has any influence."""
    counts = (df if train is None else df.where(train)).groupBy(label).agg(F.count(F.lit(1)).alias("__nc"))
    tot = counts.agg(F.sum("__nc").alias("__n"), F.count(F.lit(1)).alias("__k"))
    w = attach_scalars(counts, tot).select(label, (F.col("__n") / (F.col("__k") * F.col("__nc"))).alias(out))
    d = df.join(F.broadcast(w), label, "left")   # one row per class: size-proven
    return d if train is None else d.withColumn(out, F.when(train, F.col(out)).otherwise(1.0))


def compact(df: DataFrame, least: int = 25_000, most: int = 250_000) -> DataFrame:
    """The rows of ``df``, written once, in few partitions, for fits that pass over them hundreds of times: a pass starts a
    task per partition, which costs more than a small one's rows.  A partition has ``least`` rows or more, unless all
    have fewer, and about ``most`` once every core has one.  For estimators that draw no random numbers per partition."""
    d = materialize(df, "checkpoint")
    n = d.count()
    return d.coalesce(max(math.ceil(n / most), min(math.ceil(n / least), df.sparkSession.sparkContext.defaultParallelism), 1))


def logistic(label="label", weight="weight", reg=0.0, max_iter=100) -> LogisticRegression:
    """ML2."""
    return LogisticRegression(labelCol=label, weightCol=weight, regParam=reg, maxIter=max_iter)


def random_forest_classifier(label="label", weight="weight", trees=100, depth=10, seed=42) -> RandomForestClassifier:
    """ML3 — 100 trees, depth 10 as in the stored runs."""
    return RandomForestClassifier(labelCol=label, weightCol=weight, numTrees=trees, maxDepth=depth, seed=seed,
                                  cacheNodeIds=True)


def gbt_classifier(label="label", weight="weight", iters=100, depth=5, step=0.1, seed=42,
                   validation_col: str | None = None, tol: float = 1e-4) -> GBTClassifier:
    """ML4 — boosted trees; early stopping through a validation indicator column."""
    kw = dict(labelCol=label, weightCol=weight, maxIter=iters, maxDepth=depth, stepSize=step, seed=seed)
    if validation_col:
        kw.update(validationIndicatorCol=validation_col, validationTol=tol)
    return GBTClassifier(**kw)


def random_fourier_features(df: DataFrame, input_col="features", out="rff", dim: int = 64, gamma: float = 0.1,
                            n_in: int | None = None, seed: int = 42) -> DataFrame:
    """ML5 (re-aimed RBF kernel) — z(x) = sqrt(2/D) cos(W x + b), W ~ N(0, 2γ),
    b ~ U(0, 2π) (Rahimi & Recht).  W and b are a small constant matrix
    (D x n_in), evaluated with array higher-order functions — no UDF."""
    import random
    rnd = random.Random(seed)
    n_in = n_in or len(df.select(input_col).first()[0])
    W = [[rnd.gauss(0.0, math.sqrt(2 * gamma)) for _ in range(n_in)] for _ in range(dim)]
    b = [rnd.uniform(0, 2 * math.pi) for _ in range(dim)]
    x = vector_to_array(F.col(input_col))
    cols = []
    for j in range(dim):
        prod = F.zip_with(x, F.array(*[F.lit(w) for w in W[j]]), lambda a, c: a * c)
        dot = F.aggregate(prod, F.lit(0.0), lambda acc, v: acc + v)
        cols.append(F.cos(dot + F.lit(b[j])) * math.sqrt(2.0 / dim))
    return df.withColumn(out, array_to_vector(F.array(*cols)))


def linear_svc(label="label", features="rff", weight="weight", reg=0.01) -> LinearSVC:
    return LinearSVC(labelCol=label, featuresCol=features, weightCol=weight, regParam=reg)


def mlp(n_in: int, label="label", hidden=(100, 50), k: int = 2, seed=42) -> MultilayerPerceptronClassifier:
    """ML6 — (100, 50) hidden layers (sigmoid), L-BFGS."""
    return MultilayerPerceptronClassifier(labelCol=label, layers=[n_in, *hidden, k], seed=seed, maxIter=200)


def linear_regressor(kind: str = "linear", alpha: float = 1.0, l1_ratio: float = 0.5, n: int | None = None,
                     label="label") -> LinearRegression:
    """ML7 — linear / ridge / lasso / elastic net (standardization off, as in
    scikit-learn; ridge alpha maps to regParam = alpha / n)."""
    if kind == "linear":
        return LinearRegression(labelCol=label, regParam=0.0, standardization=False)
    if kind == "ridge":
        return LinearRegression(labelCol=label, regParam=alpha / max(n or 1, 1), elasticNetParam=0.0,
                                standardization=False)
    if kind == "lasso":
        return LinearRegression(labelCol=label, regParam=alpha, elasticNetParam=1.0, standardization=False)
    return LinearRegression(labelCol=label, regParam=alpha, elasticNetParam=l1_ratio, standardization=False)


def random_forest_regressor(label="label", trees=100, depth=10, seed=42) -> RandomForestRegressor:
    """ML8 / ML14."""
    return RandomForestRegressor(labelCol=label, numTrees=trees, maxDepth=depth, seed=seed, cacheNodeIds=True)


def gbt_regressor(label="label", iters=100, depth=5, seed=42, validation_col=None, tol=1e-4) -> GBTRegressor:
    kw = dict(labelCol=label, maxIter=iters, maxDepth=depth, seed=seed)
    if validation_col:
        kw.update(validationIndicatorCol=validation_col, validationTol=tol)
    return GBTRegressor(**kw)


def tier_classifier(label="tier", trees=100, depth=10, seed=42, boosted: bool = False):
    """ML11 — multi-class tiers: forest, or one-vs-rest boosted trees."""
    if boosted:
        return OneVsRest(classifier=GBTClassifier(maxIter=20, seed=seed), labelCol=label)
    return RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=depth, seed=seed, cacheNodeIds=True)


def fit_multi_output(train: DataFrame, labels, make_estimator, chain: bool = False) -> dict:
    """ML15 / ML16 — one estimator per label; with ``chain`` every later
    label sees the earlier labels as extra features (true labels when
    training; predictions when scoring, see :func:`predict_multi_output`)."""
    models, extra = {}, []
    data = train
    for lab in labels:
        d = data
        if chain and extra:
            d = VectorAssembler(inputCols=["features", *extra], outputCol="__fx").transform(d) \
                .drop("features").withColumnRenamed("__fx", "features")
        models[lab] = make_estimator(lab).fit(d)
        extra.append(lab)
    return models


def predict_multi_output(df: DataFrame, models: dict, chain: bool = False, prob_prefix: str = "prob_") -> DataFrame:
    """Apply per-label models; adds ``prob_<label>`` (positive-class probability)
    and ``pred_<label>``; a chain feeds predictions forward."""
    out = df
    extra = []
    for lab, m in models.items():
        d = out
        chained = chain and bool(extra)
        if chained:
            d = VectorAssembler(inputCols=["features", *[f"pred_{e}" for e in extra]], outputCol="__fx") \
                .transform(d).withColumnRenamed("features", "__orig").withColumnRenamed("__fx", "features")
        s = m.transform(d)
        if chained:
            s = s.drop("features").withColumnRenamed("__orig", "features")
        out = s.select(*out.columns, vector_to_array("probability")[1].alias(f"{prob_prefix}{lab}"),
                       F.col("prediction").cast("int").alias(f"pred_{lab}"))
        extra.append(lab)
    return out


def probability_map(df: DataFrame, labels, prob_prefix: str = "prob_", out: str = "milestone_probabilities"):
    """ML17 — label -> probability map per row."""
    return df.withColumn(out, F.map_from_arrays(F.array(*[F.lit(l) for l in labels]),
                                                F.array(*[F.col(f"{prob_prefix}{l}") for l in labels])))


def positive_probability(model_out: DataFrame, out: str = "p") -> DataFrame:
    return model_out.withColumn(out, vector_to_array("probability")[1])


def save_pipeline(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def pipeline(stages) -> Pipeline:
    return Pipeline(stages=list(stages))
