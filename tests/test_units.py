"""Unit checks for operators whose behaviour the oracle sweep does not reach."""

import pytest
from pyspark.sql import functions as F

from pennant.models import ensemble as EN
from pennant.models import forecast as FC
from pennant.models import misc as MI
from pennant.operators import quality as Q
from pennant.sources import io as IO

from conftest import SF_SMALL


def test_validation_gate_reports_issues(spark):
    # FIXTURES A2: a negative win count and a missing loss count
    rows = [("A", 2020, -1, 60, 700, 650, 0.0), ("A", 2021, 90, None, 700, 650, 0.6), ("B", 2020, 80, 82, 700, 650, 0.5),
            ("B", 2020, 80, 82, 700, 650, 0.5)]
    df = spark.createDataFrame(rows, "team_name string, year int, wins int, losses int, runs_scored int, "
                                     "runs_allowed int, winning_percentage double")
    r = Q.validate(df).first()
    assert r.is_valid == 0 and r.n_duplicate_keys == 1 and r.n_null_critical == 1
    assert "Missing required columns" in r.issues and "duplicate" in r.issues
    bad = Q.validate_input(df, max_games=163).where("is_valid = 0").count()
    assert bad == 1


def test_unsupported_formats_raise(spark):
    with pytest.raises(ValueError):
        IO.load_predictions(spark, "/nowhere/predictions.xlsx")
    with pytest.raises(ValueError):
        IO.save(spark.range(1), "/nowhere/x", "xlsx")


def test_stage_dag_cycle_detected():
    assert EN.topological_order({"c": ["a", "b"], "b": ["a"], "a": []}) == ["a", "b", "c"]
    with pytest.raises(ValueError):
        EN.topological_order({"a": ["b"], "b": ["a"]})


def test_dense_index_is_a_permutation(spark):
    df = spark.range(0, 537).select((F.col("id") * 7919 % 1000).cast("string").alias("team_name"),
                                    (F.col("id") % 5 + 2000).alias("year"))
    df = df.dropDuplicates(["team_name", "year"])
    ids = [r.Id for r in IO.dense_index(df, ["team_name", "year"], partitions=7).collect()]
    assert sorted(ids) == list(range(df.count()))


@pytest.mark.parametrize("partitions", [3, 8, 40])
def test_dense_index_with_sampled_bounds(spark, partitions):
    """More rows than range sampling reads, with columns besides the keys."""
    df = spark.range(0, 400_000).select(F.sha2(F.col("id").cast("string"), 256).alias("team_name"), (F.col("id") % 5 + 2000).alias("year"),
                                        (F.col("id") * 3).alias("wins"), F.md5(F.col("id").cast("string")).alias("extra"))
    r = IO.dense_index(df, ["team_name", "year"], partitions=partitions).agg(
        F.count_distinct("Id").alias("n"), F.min("Id").alias("lo"), F.max("Id").alias("hi")).first()
    assert (r.n, r.lo, r.hi) == (400_000, 0, 399_999)


def test_class_weights_come_from_training_rows(spark):
    from pennant.models import estimators as ES
    rows = [(i, float(i % 4 == 0), "train" if i < 40 else "test") for i in range(60)]
    d = spark.createDataFrame(rows, "id int, label double, split string")
    flipped = d.withColumn("label", F.when(F.col("split") == "test", 1 - F.col("label")).otherwise(F.col("label")))
    get = lambda x: {r.id: r.weight for r in ES.balanced_weights(x, train=F.col("split") == "train").collect()}
    assert get(d) == get(flipped)
    assert get(d)[0] == 40 / (2 * 10) and get(d)[1] == 40 / (2 * 30) and get(d)[50] == 1.0


def test_input_validation_reports_what_is_no_number(spark):
    d = spark.createDataFrame([("a", "12", 3, 1.0), ("b", "x", 3, 1.0), ("c", None, 3, 1.0)], "team_name string, wins string, losses int, runs_scored double")
    got = {r.team_name: r.errors for r in Q.validate_input(d).collect()}
    assert got == {"a": "", "b": "not a number: wins", "c": "missing wins"}


def test_stage_order_and_cycles():
    order = EN.topological_order({"c": ["a", "b"], "b": ["a"], "a": []})
    assert order.index("a") < order.index("b") < order.index("c")
    with pytest.raises(ValueError):
        EN.topological_order({"a": ["b"], "b": ["a"]})


def test_poisson_weights_have_no_cap():
    assert len(MI.POISSON_CDF) > 15 and abs(MI.POISSON_CDF[-1] - 1) < 1e-12


def test_psi_identical_is_zero_and_holt_linear(spark):
    df = spark.range(200).select((F.col("id") / 200.0).alias("x"))
    assert abs(MI.psi(df, df, "x").first().psi) < 1e-12
    lin = spark.createDataFrame([("T", 2000 + i, 50 + 2 * i) for i in range(6)], "team_name string, year int, wins int")
    f = {r.h: r.forecast for r in FC.holt(lin, "wins", 0.5, 0.3, 2).collect()}
    assert abs(f[1] - 62.0) < 1e-9 and abs(f[2] - 64.0) < 1e-9


def test_bootstrap_interval_contains_mean(spark):
    df = spark.createDataFrame([(f"t{i}", 2000 + i % 5, float(i % 17)) for i in range(300)],
                               "team_name string, year int, wins double")
    r = MI.poisson_bootstrap(df, "wins", replicates=100).first()
    mean = df.agg(F.avg("wins")).first()[0]
    assert r.lower <= mean <= r.upper


def test_approximate_paths_close_to_exact(spark):
    from pennant.operators import metrics_reg as MR
    df = spark.range(5000).select((F.col("id") % 97).cast("double").alias("y"),
                                  ((F.col("id") * 7) % 89).cast("double").alias("yhat"),
                                  (F.col("id") % 300).cast("string").alias("team_name"), F.lit(2000).alias("year"))
    ex = MR.error_profile(df).first()
    ap = MR.error_profile(df, approx=True).first()
    assert abs(ex.median_ae - ap.median_ae) <= 1.0 and abs(ex.p90_error - ap.p90_error) <= 1.0
    e = Q.data_info(df).first().n_entities
    a = Q.data_info(df, approx=True).first().n_entities
    assert e == 300 and abs(a - e) / e < 0.05
