"""Operators over model scores against DuckDB SQL on the same scores, written once."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from pennant.models import ensemble as EN
from pennant.models import misc as MI
from pennant.models import tuning as TU


@pytest.fixture(scope="module")
def scores(spark, tmp_path_factory):
    """Scores of two members and five milestones over 900 rows, with ties, nulls and one-class groups."""
    rng = np.random.default_rng(12)
    path = str(tmp_path_factory.mktemp("scores") / "s")
    rows = []
    for i in range(900):
        y = int(rng.random() < 0.35)
        a, b = np.round(np.clip(rng.normal(0.4 + 0.2 * y, 0.2), 0, 1), 2), float(rng.random())
        rows.append((i, i % 9, f"m{i % 3}", float(y if i % 9 else 1), float(a), b, None if i % 50 == 0 else float(rng.random()), float(rng.random())))
    spark.createDataFrame(rows, "id long, step int, model string, y double, p_a double, p_b double, prob_x double, prob_z double").repartition(4).write.parquet(path)
    return path


def sql(path, query):
    return duckdb.connect().execute(query.replace("scores", f"read_parquet('{path}/*.parquet')")).fetchall()


def test_soft_vote(spark, scores):
    got = EN.soft_vote(spark.read.parquet(scores), ["p_a", "p_b"], [0.6, 0.4]).select("id", "p_ensemble", "pred_ensemble").collect()
    want = {i: (p, c) for i, p, c in sql(scores, "SELECT id, (0.6 * p_a + 0.4 * p_b) / 1.0, ((0.6 * p_a + 0.4 * p_b) >= 0.5)::INT FROM scores")}
    assert len(got) == 900
    for r in got:
        assert r.p_ensemble == pytest.approx(want[r.id][0], abs=1e-12)
        assert r.pred_ensemble == want[r.id][1] or abs(r.p_ensemble - 0.5) < 1e-9


def test_dynamic_weights(spark, scores):
    per = spark.read.parquet(scores).groupBy("model", "step").agg(F.avg("p_a").alias("score"))
    init = spark.createDataFrame([("m0", 0.9), ("new", 0.05)], "model string, weight double")
    got = {r.model: (r.recent_score, r.weight) for r in EN.dynamic_weights(per, window=5, init=init).collect()}
    want = sql(scores, """
      WITH s AS (SELECT model, step, avg(p_a) AS score FROM scores GROUP BY ALL),
      l AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY step DESC) AS rn FROM s QUALIFY rn <= 5),
      m AS (SELECT *, count(*) OVER (PARTITION BY model) AS n FROM l),
      r AS (SELECT model, sum(exp(CASE WHEN n > 1 THEN -1 + (n - rn) / (n - 1.0) ELSE -1 END) * score)
              / sum(exp(CASE WHEN n > 1 THEN -1 + (n - rn) / (n - 1.0) ELSE -1 END)) AS recent FROM m GROUP BY model
            UNION ALL SELECT 'new', 0.05)
      SELECT model, recent, greatest(recent, 0.1) / (SELECT sum(greatest(recent, 0.1)) FROM r) FROM r""")
    assert set(got) == {m for m, _, _ in want}
    for m, recent, weight in want:
        assert got[m] == pytest.approx((recent, weight), rel=1e-12)


def test_milestone_report(spark, scores):
    got = [tuple(r) for r in MI.milestone_report(spark.read.parquet(scores), ["prob_x", "prob_z"]).collect()]
    want = sql(scores, """SELECT 'prob_x' AS m, avg(prob_x) AS p, count(*) FILTER (prob_x >= 0.5) FROM scores
      UNION ALL SELECT 'prob_z', avg(prob_z), count(*) FILTER (prob_z >= 0.5) FROM scores ORDER BY p DESC""")
    assert [g[0] for g in got] == [w[0] for w in want]
    for g, w in zip(got, want):
        assert g[1] == pytest.approx(w[1], rel=1e-12) and g[2] == w[2]


def test_fold_metrics(spark, scores):
    """Mean, deviation and gap of a cross-validation table from its scored rows."""
    d = spark.read.parquet(scores).select("step", "model", "y", F.col("p_a").alias("s"))
    got = {(r.step, r.model): r.value for r in TU.metric_by(d, ["step", "model"], "classification").collect()}
    want = sql(scores, """
      WITH p AS (SELECT step, model, y, p_a AS s FROM scores),
      pairs AS (SELECT a.step, a.model, avg(CASE WHEN a.s > b.s THEN 1 WHEN a.s = b.s THEN 0.5 ELSE 0 END) AS auc
        FROM p a JOIN p b ON a.step = b.step AND a.model = b.model AND a.y = 1 AND b.y = 0 GROUP BY ALL)
      SELECT DISTINCT p.step, p.model, auc FROM p LEFT JOIN pairs USING (step, model)""")
    assert len(got) == len(want) == 9
    for step, model, auc in want:
        assert got[step, model] is None if auc is None else got[step, model] == pytest.approx(auc, abs=1e-12)
