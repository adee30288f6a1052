"""Model operators: quality floors and structural checks (rows-only keys)."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pennant.models import estimators as ES
from pennant.models import intervals as IV
from pennant.operators import metrics_cls as MC
from pennant.plans.q_models import REG_FEATURES, _split, ml_data

from conftest import SF_MID


def test_forest_classifier_quality(spark):
    tr, _, te = _split(ml_data(spark, SF_MID))
    s = ES.random_forest_classifier(trees=50).fit(tr).transform(te) \
        .withColumn("p", vector_to_array("probability")[1])
    auc = MC.roc_auc(s).first().roc_auc
    assert auc > 0.7
    assert s.where((F.col("p") < 0) | (F.col("p") > 1)).count() == 0


def test_tree_interval_mean_equals_prediction(spark):
    tr, _, te = _split(ml_data(spark, SF_MID, REG_FEATURES, "wins"))
    m = ES.random_forest_regressor(trees=20, depth=5).fit(tr)
    r = IV.tree_percentile_interval(spark, m, te, ["team_name", "year"])
    bad = r.where(F.abs(F.col("tree_mean") - F.col("prediction")) > 1e-9).count()
    assert bad == 0
    assert r.where(F.col("lower") > F.col("upper")).count() == 0


def test_calibrated_and_stacked_probabilities(spark):
    from pyspark.ml.classification import LogisticRegression
    from pennant.models import calibration as CAL
    from pennant.models import ensemble as EN
    tr, _, te = _split(ml_data(spark, SF_MID))
    cal = CAL.CalibratedClassifier(ES.random_forest_classifier(trees=20), "sigmoid", 3).fit(tr).transform(te)
    assert cal.where((F.col("p") < 0) | (F.col("p") > 1) | F.col("p").isNull()).count() == 0
    assert cal.select("p").distinct().count() > 1
    members = {"rf": ES.random_forest_classifier(trees=10), "lr": ES.logistic()}
    full, meta = EN.stack(tr, members, LogisticRegression(featuresCol="meta_features", labelCol="label"),
                          ["team_name", "year"], k=3)
    st = EN.stack_transform(te, full, meta)
    assert st.count() == te.count()
    assert st.where((F.col("p_stacked") < 0) | (F.col("p_stacked") > 1)).count() == 0


def test_metrics_of_many_models_at_once(spark):
    import numpy as np
    import pytest

    from pennant.models import search as SE
    from pennant.models import tuning as TU

    rng = np.random.default_rng(8)
    rows = [(m, int(rng.random() < 0.4) if m < 3 else 1, float(rng.integers(0, 9 + m))) for m in range(4) for _ in range(150)]
    df = spark.createDataFrame([(m, float(y), s) for m, y, s in rows], "model int, y double, s double").repartition(5)
    got = {r.model: (r.n, r.value) for r in TU.metric_by(df, ["model"], "classification").collect()}
    root = {r.model: r.value for r in TU.metric_by(df, ["model"], "regression").collect()}
    for m in range(4):
        y, s = (np.array([r[i] for r in rows if r[0] == m], float) for i in (1, 2))
        want = SE.area_under_roc(s, y)
        assert got[m][0] == 150 and (got[m][1] == pytest.approx(want) if m < 3 else got[m][1] is want is None)
        assert root[m] == pytest.approx(float(np.sqrt(np.mean((s - y) ** 2))))


def test_jobs_of_measuring_do_not_grow_with_the_maps(spark, monkeypatch):
    from pennant.models import tuning as TU
    from pyspark.ml.tuning import ParamGridBuilder

    from conftest import SF_SMALL

    tr, _, _ = _split(ml_data(spark, SF_SMALL))
    lr, calls = ES.logistic(), []
    real = TU.metric_by
    monkeypatch.setattr(TU, "metric_by", lambda *a: calls.append(1) or real(*a))
    for values in ([0.0], [0.0, 0.01, 0.1, 1.0]):
        _, table = TU.cross_validate(spark, tr, lr, "classification", ["team_name", "year"], k=3,
                                     grid=ParamGridBuilder().addGrid(lr.regParam, values).build())
        assert table.count() == len(values)
    assert len(calls) == 2


def test_tables_of_model_selection_have_scores_where_both_classes_occur(spark):
    from pennant.plans.registry import REGISTRY

    for key, columns in (("ML30_learning_curve", ("train_score", "val_score")),
                         ("ML26_cross_validate", ("mean_score", "std_score", "min_score", "max_score", "train_score", "train_gap")),
                         ("TK8_top_tuning_results", ("mean_score", "std_score", "min_score", "max_score", "train_score", "train_gap"))):
        rows = REGISTRY[key](spark, SF_MID).collect()
        assert rows and all(r[c] is not None for r in rows for c in columns), key
        assert all(0.5 < r[columns[0]] <= 1 for r in rows)
