"""Random search over forests: the tree grower, shared forests, and the table."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pennant.models import search as SE
from pennant.models import tuning as TU
from pennant.operators import metrics_cls as MC
from pennant.plans.q_models import CLS_FEATURES, FOREST_SPACE, KEY, _split, ml_data
from pennant.plans.registry import REGISTRY

from conftest import SF_MID, SF_SMALL


def brute_split(x, stats, features, leaf):
    """Best gain over all features and bins of one node."""
    gini = lambda t: (t[1] ** 2 + (t[0] - t[1]) ** 2) / t[0]
    best = 0.0
    for j in features:
        for b in range(255):
            go = x[:, j] <= b
            if go.all() or not go.any() or stats[go, 2].sum() < leaf or stats[~go, 2].sum() < leaf:
                continue
            best = max(best, gini(stats[go].sum(0)) + gini(stats[~go].sum(0)) - gini(stats.sum(0)))
    return best


def test_splits_match_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(60):
        n, nodes, leaf = int(rng.integers(4, 80)), int(rng.integers(1, 5)), int(rng.integers(1, 4))
        x, slot = rng.integers(0, 6, (n, 5)).astype(np.uint8), rng.integers(0, nodes, n)
        w, y, c = rng.random(n) + 0.1, rng.integers(0, 2, n), rng.integers(1, 3, n)
        stats = np.stack([w, w * y, c], 1)
        total = np.stack([np.bincount(slot, stats[:, i], nodes) for i in range(3)], 1)
        tried = rng.random((nodes, 5)).argsort(axis=1)[:, :3]
        gain, feature, place = SE.best_splits(x, slot, stats, tried, total, leaf)
        for s in range(nodes):
            own = slot == s
            if not own.any():
                continue
            assert max(gain[s], 0) == pytest.approx(brute_split(x[own], stats[own], tried[s], leaf), abs=1e-9)
            if gain[s] > 1e-9:
                go = x[own, feature[s]] <= place[s]
                assert feature[s] in tried[s] and min(stats[own][go, 2].sum(), stats[own][~go, 2].sum()) >= leaf


def test_a_shallow_tree_is_a_deep_one_cut():
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 32, (400, 6)).astype(np.uint8), (rng.random(400) < 0.4).astype(float)
    grown = lambda d: SE.Tree(x, y, np.ones(400), np.arange(300), d, 2, 3, np.random.default_rng(7))
    deep = grown(12).values(x, [0, 1, 3, 5, 12])
    for d in (0, 1, 3, 5):
        assert np.array_equal(grown(d).values(x, [d])[d], deep[d])
    assert len(np.unique(deep[12])) > len(np.unique(deep[1])) > len(np.unique(deep[0])) == 1


def test_area_under_roc():
    rng = np.random.default_rng(3)
    s, y = rng.integers(0, 10, 200).astype(float), rng.integers(0, 2, 200).astype(float)
    p, n = s[y == 1], s[y == 0]
    want = ((p[:, None] > n).sum() + 0.5 * (p[:, None] == n).sum()) / (len(p) * len(n))
    assert SE.area_under_roc(s, y) == pytest.approx(want)
    assert SE.area_under_roc(s, np.ones(200)) is None and SE.area_under_roc(s[:0], y[:0]) is None


def test_maps_with_the_same_settings_share_trees():
    maps = TU.random_param_maps(FOREST_SPACE, 50)
    tasks = SE.search_tasks(maps, 16, 5)
    trees = sum(high - low for _, _, _, low, high, _ in tasks)
    assert trees < 0.6 * 5 * sum(p["numTrees"] for p in maps)
    for f in range(5):
        for i, p in enumerate(maps):
            own = [(low, high) for leaf, m, g, low, high, held in tasks if g == f and i in held]
            assert sorted(own)[0][0] == 0 and max(h for _, h in own) >= p["numTrees"]


def test_random_search_draws_the_references_number_without_repeats():
    maps = TU.random_param_maps(FOREST_SPACE, 50)
    assert len({tuple(sorted(p.items())) for p in maps}) == 50
    assert all(p[name] in values for p in maps for name, values in FOREST_SPACE.items())
    assert (min(FOREST_SPACE["numTrees"]), max(FOREST_SPACE["numTrees"]), len(FOREST_SPACE["maxDepth"])) == (50, 299, 27)
    few = TU.random_param_maps({"maxDepth": [3, 5, 8], "minInstancesPerNode": range(1, 4)}, 50)
    assert len({tuple(p.values()) for p in few}) == len(few) == 9


def test_search_table_is_the_same_on_a_rerun(spark):
    tr, _, _ = _split(ml_data(spark, SF_MID))
    maps = TU.random_param_maps({**FOREST_SPACE, "numTrees": range(5, 60)}, 6)
    one = [tuple(r) for r in SE.forest_search(spark, tr, KEY, maps, k=3).orderBy("param_index").collect()]
    two = [tuple(r) for r in SE.forest_search(spark, tr.repartition(3), KEY, maps, k=3).orderBy("param_index").collect()]
    assert one == two and len(one) == 6 and all(0.6 < r[2] <= r[5] <= 1 and r[6] >= r[2] for r in one)


def test_scores_are_close_to_mllibs(spark):
    tr, _, te = _split(ml_data(spark, SF_MID))
    p = {"numTrees": 150, "maxDepth": 8, "minInstancesPerNode": 3, "featureSubsetStrategy": "sqrt"}
    from pennant.operators.split import kfold
    d = kfold(tr, KEY, 3, 42).persist()
    want = []
    for f in range(3):
        m = RandomForestClassifier(labelCol="label", weightCol="weight", seed=1, numTrees=150, maxDepth=8, minInstancesPerNode=3,
                                   featureSubsetStrategy="sqrt").fit(d.where(F.col("fold") != f))
        want.append(MC.roc_auc(m.transform(d.where(F.col("fold") == f)).withColumn("p", vector_to_array("probability")[1])).first().roc_auc)
    d.unpersist()
    got = SE.forest_search(spark, tr, KEY, [p], k=3).first()
    assert got.mean_score == pytest.approx(sum(want) / 3, abs=0.03)
    best = SE.best_forest(tr, spark.createDataFrame([(0, got.mean_score)], "param_index int, mean_score double"), [p], RandomForestClassifier(
        labelCol="label", weightCol="weight", seed=1))
    assert best.getNumTrees == 150 and best.numFeatures == len(CLS_FEATURES)


def test_rows_beyond_the_bound_are_left_to_the_refit(spark):
    tr, _, _ = _split(ml_data(spark, SF_SMALL))
    frame = SE.training_rows(tr, KEY, 5, 42, "label", "weight", "features", 20)
    assert len(frame["y"]) == 20 and set(frame["fold"]) <= set(range(5))
    empty = SE.training_rows(tr.limit(0), KEY, 5, 42, "label", "weight", "features", 20)
    assert len(empty["y"]) == 0


def test_top_tuning_results_read_the_same_table(spark):
    table = REGISTRY["ML29_random_search"](spark, SF_SMALL).collect()
    assert len(table) == 50
    assert REGISTRY["TK8_top_tuning_results"](spark, SF_SMALL).collect() == table[:3]
