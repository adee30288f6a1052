"""Ensembles (ML19-ML23).

Member outputs are columns on the same rows (``transform`` appends; nothing
is stacked by position).  Stacking uses out-of-fold member scores so the
meta model never sees in-fold predictions.
"""

from __future__ import annotations

from graphlib import TopologicalSorter

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pennant.operators.split import kfold


def soft_vote(df: DataFrame, prob_cols, weights=None, out: str = "p_ensemble") -> DataFrame:
    """ML19 — (weighted) mean of member positive-class probabilities."""
    weights = list(weights or [1.0] * len(prob_cols))
    tot = float(sum(weights))
    expr = sum((F.col(c) * w for c, w in zip(prob_cols[1:], weights[1:])), F.col(prob_cols[0]) * weights[0]) / tot
    return df.withColumn(out, expr).withColumn(out.replace("p_", "pred_"), (F.col(out) >= 0.5).cast("int"))


def member_scores(df: DataFrame, members: dict) -> DataFrame:
    """Append each fitted member's positive-class probability as ``p_<name>``."""
    out = df
    for name, m in members.items():
        out = m.transform(out).withColumn(f"p_{name}", vector_to_array("probability")[1]) \
            .drop("rawPrediction", "probability", "prediction")
    return out


def stack(train: DataFrame, members: dict, meta, keys, k: int = 5, label: str = "label"):
    """ML20 — fit members per fold, score the held-out fold (OOF), fit the
    meta estimator on the OOF score vector; members are refitted on all rows."""
    d = kfold(train, keys, k, seed=11).persist()
    parts = []
    for f in range(k):
        fitted = {n: e.fit(d.where(F.col("fold") != f)) for n, e in members.items()}
        parts.append(member_scores(d.where(F.col("fold") == f), fitted))
    oof = parts[0]
    for p in parts[1:]:
        oof = oof.unionByName(p)
    cols = [f"p_{n}" for n in members]
    meta_model = meta.fit(VectorAssembler(inputCols=cols, outputCol="meta_features").transform(oof))
    full = {n: e.fit(d) for n, e in members.items()}
    d.unpersist()
    return full, meta_model


def stack_transform(df: DataFrame, members: dict, meta_model, out: str = "p_stacked") -> DataFrame:
    s = member_scores(df, members)
    cols = [f"p_{n}" for n in members]
    s = VectorAssembler(inputCols=cols, outputCol="meta_features").transform(s)
    r = meta_model.transform(s)
    return r.withColumn(out, vector_to_array("probability")[1]).drop("rawPrediction", "probability", "meta_features")


def blend(train: DataFrame, holdout: DataFrame, members: dict, meta, with_features: bool = False):
    """ML21 — members fitted on train, meta fitted on their scores over a
    held-out set (optionally with the original features)."""
    fitted = {n: e.fit(train) for n, e in members.items()}
    s = member_scores(holdout, fitted)
    cols = [f"p_{n}" for n in members] + (["features"] if with_features else [])
    meta_model = meta.fit(VectorAssembler(inputCols=cols, outputCol="meta_features").transform(s))
    return fitted, meta_model


def dynamic_weights(scores: DataFrame, model_col="model", order_col="step", score_col="score",
                    window: int = 5, floor: float = 0.1, init: DataFrame | None = None) -> DataFrame:
    """ML22 — member weights from each member's recent scores: the
    exponentially weighted mean of its last ``window`` scores (weights
    exp(linspace(-1, 0, m))), floored at ``floor`` and normalised to sum 1.
    ``init`` (model, weight) seeds members without scores.  The last-N filter is
    ``row_number <= window`` (WindowGroupLimit); the per-member table is tiny."""
    w = Window.partitionBy(model_col).orderBy(F.desc(order_col))
    last = scores.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= window)
    last = last.withColumn("__m", F.count(F.lit(1)).over(Window.partitionBy(model_col)))
    x = F.when(F.col("__m") > 1, -1.0 + (F.col("__m") - F.col("__rn")).cast("double") / (F.col("__m") - 1)) \
        .otherwise(F.lit(-1.0))
    recent = last.withColumn("__w", F.exp(x)).groupBy(model_col).agg(
        (F.sum(F.col("__w") * F.col(score_col)) / F.sum("__w")).alias("recent_score"))
    if init is not None:
        recent = init.join(recent, model_col, "full").select(
            model_col, F.coalesce("recent_score", "weight").alias("recent_score"))
    raw = recent.withColumn("__f", F.greatest(F.col("recent_score"), F.lit(floor)))
    tot = raw.agg(F.sum("__f").alias("__t"))
    return raw.withColumn("__k", F.lit(1)).join(F.broadcast(tot.withColumn("__k", F.lit(1))), "__k") \
        .select(model_col, "recent_score", (F.col("__f") / F.col("__t")).alias("weight"))


def topological_order(stages: dict) -> list:
    """ML23 — dependency order of a stage DAG (name -> list of inputs), on the driver over stage *names* only;
    a cycle is a ``ValueError``."""
    return list(TopologicalSorter(stages).static_order())


def hierarchical(df: DataFrame, stages: dict, fitted: dict) -> DataFrame:
    """ML23 — apply fitted stage models in dependency order; each stage's
    output ``p_<stage>`` is appended as a column (later stages may consume it)."""
    out = df
    for name in topological_order(stages):
        m = fitted[name]
        out = m.transform(out).withColumn(f"p_{name}", vector_to_array("probability")[1]) \
            .drop("rawPrediction", "probability", "prediction")
    return out
