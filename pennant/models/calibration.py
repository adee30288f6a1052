"""Probability calibration (ML9, ML10).

Leakage-free: the base model is refitted on k-1 folds and scores the held-out
fold (out-of-fold scores); a 1-D calibrator is fitted on those scores — a
logistic regression on the logit (sigmoid / Platt) or an isotonic regression
(:mod:`pennant.models.isotonic`).  The final base model is fitted on all training rows.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pennant.models.isotonic import apply_isotonic, fit_isotonic
from pennant.operators.split import kfold


def _logit(p):
    q = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.ln(q / (1 - q))


class CalibratedClassifier:
    """Base estimator + out-of-fold calibration (``method``: sigmoid | isotonic)."""

    def __init__(self, estimator, method: str = "sigmoid", folds: int = 3, keys=("team_name", "year"),
                 label: str = "label", seed: int = 42):
        self.estimator, self.method, self.folds, self.keys = estimator, method, folds, list(keys)
        self.label, self.seed = label, seed

    def fit(self, train: DataFrame) -> "CalibratedClassifier":
        d = kfold(train, self.keys, self.folds, self.seed).persist()
        oof = None
        for f in range(self.folds):
            m = self.estimator.fit(d.where(F.col("fold") != f))
            s = m.transform(d.where(F.col("fold") == f)).select(
                self.label, vector_to_array("probability")[1].alias("__p"))
            oof = s if oof is None else oof.unionByName(s)
        oof = oof.withColumn("__z", _logit(F.col("__p")))
        if self.method == "isotonic":
            self.calibrator = fit_isotonic(oof, "__p", self.label)
        else:
            v = VectorAssembler(inputCols=["__z"], outputCol="__zv").transform(oof)
            self.calibrator = LogisticRegression(featuresCol="__zv", labelCol=self.label,
                                                 probabilityCol="__calp", predictionCol="__calpred",
                                                 rawPredictionCol="__calraw").fit(v)
        self.base = self.estimator.fit(d)
        d.unpersist()
        return self

    def transform(self, df: DataFrame, out: str = "p") -> DataFrame:
        s = self.base.transform(df).withColumn("__p", vector_to_array("probability")[1])
        if self.method == "isotonic":
            r = apply_isotonic(s, self.calibrator, "__p", out)
        else:
            s = VectorAssembler(inputCols=["__z"], outputCol="__zv").transform(s.withColumn("__z", _logit(F.col("__p"))))
            r = self.calibrator.transform(s).withColumn(out, vector_to_array("__calp")[1])
        keep = [c for c in r.columns if not c.startswith("__") and c not in ("rawPrediction", "probability")]
        return r.select(*keep)
