"""Quantiles by selection against numpy; only values near the wanted places are sorted."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pennant.functions import safe
from pennant.operators import ranking as R

QS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]


def test_groups_match_numpy(spark):
    rng = np.random.default_rng(1)
    groups = {"a": rng.normal(size=5000), "hot": np.where(rng.random(4000) < 0.9, 3.0, rng.normal(size=4000)), "one": np.array([7.5]),
              "two": np.array([1.0, 2.0]), None: rng.integers(0, 5, 300).astype(float), "skew": np.exp(rng.normal(size=3000) * 4)}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("a", None), ("a", math.nan), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    got = {r.g: r.quantiles for r in R.quantiles(df, "v", QS, ["g"]).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        assert got[g] == pytest.approx([float(np.quantile(vs, q)) for q in QS], rel=1e-12), g


def test_whole_frame_and_empty_frame(spark):
    df = spark.range(10_001).select((F.col("id") / 7).alias("v"))
    assert R.quantiles(df, "v", [0.5, 0.1]).first().quantiles == pytest.approx([5000 / 7, 1000 / 7])
    assert R.quantiles(df.limit(0), "v", [0.5]).count() == 0


def test_few_values_are_sorted(spark, monkeypatch):
    seen, real = [], R.prefix_counts
    monkeypatch.setattr(R, "prefix_counts", lambda hist, *a, **k: seen.append(hist.count()) or real(hist, *a, **k))
    n = 200_000
    df = spark.range(n).select((F.xxhash64("id") / 1e18).alias("v"))
    got = R.quantiles(df, "v", [0.25, 0.5, 0.75]).first().quantiles
    want = df.selectExpr("percentile(v, array(0.25, 0.5, 0.75)) q").first().q
    assert got == pytest.approx(want, rel=1e-12)
    assert 0 < seen[0] < 0.05 * n


def test_no_storage_is_held_after_the_feature_table(spark):
    from pennant.plans import catalog

    from conftest import SF_SMALL

    catalog.clear_memo()
    catalog.features(spark, SF_SMALL)
    assert not safe._HELD
