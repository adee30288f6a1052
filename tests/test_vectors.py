"""Vector sums per task, and ranks of pairs of columns with nulls."""

import hashlib
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pennant.models import misc as MI
from pennant.operators import aggregates as A
from pennant.operators.vectors import vector_sums


def test_vector_sums_add_up_every_row_once(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("x")).repartition(9)
    got = vector_sums(df, lambda b: np.array([len(b), b["x"].sum(), (b["x"] ** 2).sum()]), 3).first()["sums"]
    assert got == [1000.0, 499500.0, float(sum(i * i for i in range(1000)))]
    assert vector_sums(df.limit(0), lambda b: np.ones(3), 3).first()["sums"] == [0.0] * 3


def test_a_task_emits_one_row(spark):
    df = spark.range(5000).select(F.col("id").cast("double").alias("x")).repartition(6)
    plan = vector_sums(df, lambda b: np.array([b["x"].sum()]), 1)._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" in plan and "explode(sequence" not in plan


def test_exponent_matches_a_plain_grid(spark):
    rng = np.random.default_rng(1)
    rs, ra = rng.uniform(500, 900, 300), rng.uniform(500, 900, 300)
    w = 162 * rs ** 1.83 / (rs ** 1.83 + ra ** 1.83) + rng.normal(0, 3, 300)
    rows = [(float(a), float(b), float(c), 162.0) for a, b, c in zip(rs, ra, w)] + [(None, 1.0, 2.0, 3.0), (1.0, 1.0, None, 3.0)]
    got = MI.fit_pythagorean_exponent(spark.createDataFrame(rows, "runs_scored double, runs_allowed double, wins double, total_games double").repartition(3)).first()
    mse = lambda e: float(np.mean((162 * rs ** e / (rs ** e + ra ** e) - w) ** 2))
    top = min((mse(1.5 + k * 0.01), 1.5 + k * 0.01) for k in range(151))[1]
    want = min((mse(top + k * 0.0001), top + k * 0.0001) for k in range(-100, 101))
    assert got.exponent == pytest.approx(want[1], abs=1e-9) and got.mse == pytest.approx(want[0])
    empty = MI.fit_pythagorean_exponent(spark.createDataFrame([], "runs_scored double, runs_allowed double, wins double, total_games double")).first()
    assert empty.exponent is None and empty.mse is None


def test_poisson_weights_are_those_of_the_hash():
    got = MI.poisson_weights("a|2000|", [f"{r}|42".encode() for r in range(400)])
    for r in range(400):
        u = (int(hashlib.md5(f"a|2000|{r}|42".encode()).hexdigest()[:13], 16) + 0.5) / 16 ** 13
        k = next((i for i, c in enumerate(MI.POISSON_CDF) if u <= c), len(MI.POISSON_CDF))
        assert got[r] == k
    assert abs(got.mean() - 1) < 0.2


def test_bootstrap_of_no_rows_and_nulls(spark):
    df = spark.createDataFrame([("a", 1, None), ("b", 1, 2.0), (None, None, 4.0)], "team_name string, year int, wins double")
    got = MI.poisson_bootstrap(df, "wins", replicates=200).first()
    assert 2.0 <= got.lower <= got.bootstrap_mean <= got.upper <= 4.0
    assert MI.poisson_bootstrap(df.limit(1), "wins", replicates=20).first().bootstrap_mean is None


def test_spearman_ranks_the_rows_of_each_pair(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 12, (300, 4)).astype(float)
    x[:, 3] = x[:, 0] + rng.normal(0, 2, 300)
    x[rng.random((300, 4)) < 0.2] = np.nan
    x[:, 2] = rng.random(300)                                                    # no nulls
    rows = [tuple(None if math.isnan(v) else float(v) for v in r) for r in x] + [(math.nan, 1.0, 0.5, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(5)
    got = {(r.col_a, r.col_b): r["corr"] for r in A.correlation_matrix(df, list("abcd"), "spearman").collect()}
    frame = pd.DataFrame(rows, columns=list("abcd")).astype(float)
    for a in "abcd":
        for b in "abcd":
            both = frame[[a, b]].dropna() if a != b else frame[[a]].dropna()
            want = np.corrcoef(both[a].rank(), both[b].rank())[0, 1]
            assert got[a, b] == pytest.approx(want, abs=1e-12)


def test_spearman_joins_once_for_any_number_of_columns(spark):
    df = spark.range(200).select(*[(F.xxhash64("id", F.lit(i)) % 17).cast("double").alias(f"x{i}") for i in range(6)])
    per, _ = A.pairwise_ranks(df, [f"x{i}" for i in range(6)])
    plan = per._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") <= 2                                               # the ranks, and the prefix sums of their counts


def test_parallel_apply_solves_row_by_row(spark):
    from pennant.operators.apply import implied_exponents, parallel_apply

    rng = np.random.default_rng(3)
    rows = [(f"t{i}", i, int(rng.integers(1, 90)), int(rng.integers(1, 90)), int(rng.integers(300, 900)), int(rng.integers(300, 900))) for i in range(200)]
    rows += [("none", 1, 0, 5, 400, 300), ("all", 1, 5, 0, 400, 300), ("same", 1, 5, 4, 300, 300), ("null", 1, None, 4, 300, 200), ("far", 1, 80, 1, 300, 301)]
    df = spark.createDataFrame(rows, "team_name string, year int, wins int, losses int, runs_scored int, runs_allowed int").repartition(5)
    got = {r.team_name: r.exponent for r in parallel_apply(df, implied_exponents, "team_name string, year int, exponent double").collect()}
    assert len(got) == len(rows) and all(got[k] is None for k in ("none", "all", "same", "null", "far"))
    for name, _, w, l, rs, ra in rows[:200]:  # noqa: E741
        want = math.log(w / l) / math.log(rs / ra) if rs != ra else None
        assert got[name] is None if want is None or abs(want) > 59.99 else got[name] == pytest.approx(want, abs=1e-8)
    assert parallel_apply(df.limit(0), implied_exponents, "team_name string, year int, exponent double").count() == 0


def test_drift_reads_every_period(spark):
    df = spark.range(700).select((F.lit(2000) + F.col("id") % 7).cast("int").alias("year"), (F.col("id") % 50 + F.when(F.col("id") % 7 > 3, 9).otherwise(0)).cast("double").alias("v"))
    moved = MI.drift(df, "v").first()
    assert moved.psi == pytest.approx(MI.psi(df.where("year <= 2003"), df.where("year > 2003"), "v").first().psi) and moved.drift_level != "none"
    assert MI.drift(df.withColumn("v", F.lit(1.0)), "v", until=2002).first().psi == pytest.approx(0, abs=1e-9)
    assert MI.drift(df.limit(0), "v").first().psi is None
