"""Property checks (hypothesis) on the distributed helpers."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pennant.operators import metrics_cls as MC
from pennant.operators.ranking import average_rank_pct
from pennant.operators.split import kfold, stratified_split

scores = st.lists(st.tuples(st.integers(0, 1), st.integers(0, 20)), min_size=4, max_size=40)


@settings(max_examples=8, deadline=None)
@given(scores)
def test_auc_complement_and_rank_bounds(spark, rows):
    if len({y for y, _ in rows}) < 2:
        return
    df = spark.createDataFrame([(y, s / 20.0) for y, s in rows], "label int, p double")
    a = MC.roc_auc(df).first().roc_auc
    b = MC.roc_auc(df.withColumn("p", 1 - F.col("p"))).first().roc_auc
    assert abs(a + b - 1) < 1e-9
    pct = [r.r for r in average_rank_pct(df.withColumn("g", F.lit(1)), [(["g"], "p", "r")]).collect()]
    assert all(0 < x <= 1 for x in pct)


@settings(max_examples=5, deadline=None)
@given(st.integers(10, 80), st.integers(2, 6))
def test_folds_partition_the_keys(spark, n, k):
    df = spark.createDataFrame([(f"t{i}", 2000 + i % 7, i % 3) for i in range(n)], "team_name string, year int, y int")
    f = kfold(df, ["team_name", "year"], k).collect()
    assert len(f) == n and all(0 <= r.fold < k for r in f)
    s = stratified_split(df, "y", ["team_name", "year"]).groupBy("y", "split").count().collect()
    assert sum(r["count"] for r in s) == n


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(-50, 50)), min_size=1, max_size=60))
def test_prefix_counts_match_brute_force(spark, rows):
    from pennant.operators.ranking import prefix_counts
    df = spark.createDataFrame([(g, float(v)) for g, v in rows], "g int, v double")
    hist = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    got = {(r["g"], r["v"]): (r["__below"], r["__tot"]) for r in prefix_counts(hist, ["g"], "v", "n", partitions=5).collect()}
    for (g, v), (below, tot) in got.items():
        assert below == sum(1 for gg, vv in rows if gg == g and vv < v)
        assert tot == sum(1 for gg, _ in rows if gg == g)


def test_prefix_counts_spread_a_group_with_an_outlier(spark):
    """Nearly all values close together and one far away: every partition still gets its share."""
    from pennant.operators.ranking import prefix_counts
    hist = spark.range(50_000).select(F.lit(0).alias("g"), F.when(F.col("id") == 0, 1e12).otherwise(F.col("id") / 1e6).alias("v"), F.lit(1).alias("n"))
    got = prefix_counts(hist, ["g"], "v", "n", partitions=8)
    assert got.where("v = 1e12").first()["__below"] == 49_999
    r = got.agg(F.min("__below").alias("lo"), F.max("__below").alias("hi"), F.count_distinct("__below").alias("n")).first()
    assert (r.lo, r.hi, r.n) == (0, 49_999, 50_000)
    sizes = [x["count"] for x in hist.repartitionByRange(8, "g", "v").groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 3 * 50_000 / 8


def test_quantiles_do_not_shuffle_by_a_constant(spark):
    from pennant.operators.ranking import quantiles
    df = spark.range(2000).select((F.col("id") * 7919 % 2003).cast("double").alias("x"))
    q = quantiles(df, "x", [0.0, 0.25, 0.5, 0.9, 1.0])
    import numpy as np
    x = np.array([i * 7919 % 2003 for i in range(2000)], float)
    assert [round(v, 9) for v in q.first()["quantiles"]] == [round(float(v), 9) for v in np.quantile(x, [0, .25, .5, .9, 1])]
    plan = q._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
