"""Isotonic regression over range partitions against plain pool-adjacent-violators and MLlib."""

import math

import numpy as np
import pytest
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from pennant.models import isotonic as ISO


def plain_pav(x, y, w):
    """Blocks (low, high, w, value) of distinct x in ascending order."""
    out = []
    for v in np.unique(x):
        own = x == v
        out.append([v, v, w[own].sum(), (w[own] * y[own]).sum()])
        while len(out) > 1 and out[-2][3] / out[-2][2] >= out[-1][3] / out[-1][2]:
            b = out.pop()
            out[-1] = [out[-1][0], b[1], out[-1][2] + b[2], out[-1][3] + b[3]]
    return [(lo, hi, ww, wy / ww) for lo, hi, ww, wy in out]


def frames():
    rng = np.random.default_rng(4)
    n = 3000
    x = rng.random(n)
    yield "calibration", x, (rng.random(n) < x).astype(float), np.ones(n)
    yield "weights", np.round(x, 2), (rng.random(n) < x).astype(float), rng.integers(1, 9, n).astype(float)
    yield "falling", x, 1 - x, np.ones(n)
    yield "rising", x, x, np.ones(n)
    yield "two rises", x, np.where(x < 0.5, 2 * x, 2 * x - 1), np.ones(n)
    yield "one point", np.full(20, 0.25), rng.integers(0, 2, 20).astype(float), np.ones(20)


@pytest.mark.parametrize("name,x,y,w", list(frames()), ids=[f[0] for f in frames()])
def test_blocks_are_those_of_plain_pav(spark, name, x, y, w):
    df = spark.createDataFrame(list(zip(x.tolist(), y.tolist(), w.tolist())), "x double, y double, w double").repartition(7)
    got = sorted(tuple(r) for r in ISO.fit_isotonic(df, "x", "y", "w").collect())
    want = plain_pav(x, y, w)
    assert len(got) == len(want)
    for g, t in zip(got, want):
        assert g == pytest.approx(t, rel=1e-9)


def test_a_million_distinct_scores(spark):
    n = 1_000_000
    df = spark.range(n).select((F.col("id") / n).alias("x"), (F.pmod(F.xxhash64("id"), F.lit(n)) < F.col("id")).cast("double").alias("y"))
    blocks = ISO.fit_isotonic(df, "x", "y")
    rows = df.orderBy("x").toPandas()
    stack = ISO.pool(rows["x"].to_numpy(), rows["x"].to_numpy(), np.ones(n), rows["y"].to_numpy())
    got = blocks.orderBy("low").collect()
    assert len(got) == len(stack) < 4 * n ** (2 / 3)
    assert all(g.low == s[0] and g.high == s[1] and g.w == s[2] for g, s in zip(got, stack))
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_function_between_blocks_is_mllibs(spark):
    rng = np.random.default_rng(6)
    x = np.round(rng.random(800), 3)
    y = (rng.random(800) < x).astype(float)
    df = spark.createDataFrame(list(zip(x.tolist(), y.tolist())), "x double, y double")
    asked = spark.createDataFrame([(i, float(v)) for i, v in enumerate([-1.0, 2.0, *rng.random(200), *x[:50]])] + [(900, None), (901, math.nan)], "i long, x double")
    model = IsotonicRegression(featuresCol="x", labelCol="y", predictionCol="p").fit(df)
    want = {r.i: r.p for r in model.transform(asked.where("x is not null and not isnan(x)")).collect()}
    blocks = ISO.fit_isotonic(df, "x", "y")
    for most in (10_000, 5):                                                     # arrays in tasks; joins
        got = {r.i: r.p for r in ISO.apply_isotonic(asked, blocks, "x", "p", most).collect()}
        assert len(got) == asked.count()
        assert {i: v for i, v in got.items() if i < 900} == pytest.approx(want, abs=1e-12)
        assert got[900] is None and (got[901] is None or math.isnan(got[901]))


def test_nothing_to_fit(spark):
    df = spark.createDataFrame([(None, 1.0), (0.5, None), (math.nan, 1.0), (math.inf, 0.0)], "x double, y double")
    blocks = ISO.fit_isotonic(df, "x", "y")
    assert blocks.count() == 0
    assert [r.p for r in ISO.apply_isotonic(spark.createDataFrame([(0.5,), (None,)], "x double"), blocks, "x", "p").collect()] == [None, None]
