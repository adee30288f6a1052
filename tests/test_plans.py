"""Physical-plan checks: the shapes the design relies on."""

from pennant.plans import catalog
from pennant.plans.features import engineer_features
from pennant.plans.preprocess import preprocess
from pennant.sources.panel import raw_team_season

from conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entity_history_single_shuffle_on_entity(spark):
    f = engineer_features(preprocess(raw_team_season(spark, SF_SMALL), catalog.CFG), catalog.CFG,
                          materialize_base="cache")
    p = plan(f)
    # all lag/rolling/slope/lead columns run off one hash partitioning on the entity
    assert "Window" in p and p.count("Exchange hashpartitioning(team_name#") == 1


def test_topk_per_group_uses_window_group_limit(spark):
    from pennant.operators.topk import top_n_per_group
    df = spark.range(1000).selectExpr("cast(id % 7 as int) as year", "cast(id as string) as team_name",
                                      "cast(id * 13 % 101 as int) as wins")
    p = top_n_per_group(df, ["year"], "wins", 5)._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in p


def test_parquet_scan_prunes_columns(spark):
    from pennant.plans.q_metrics import binary_scored
    p = binary_scored(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,n_chars:bigint>" in p


def test_large_rank_histogram_fallback_gives_same_rows(spark, monkeypatch):
    from pennant.plans import features as FE
    from pennant.functions.safe import round_doubles
    clean = preprocess(raw_team_season(spark, SF_SMALL), catalog.CFG)
    a = round_doubles(FE.engineer_features(clean, catalog.CFG, materialize_base="cache"))
    monkeypatch.setattr(FE, "RANK_BROADCAST_MAX_ROWS", 0)
    b = round_doubles(FE.engineer_features(clean, catalog.CFG, materialize_base="cache")).select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_wide_panel_shuffled_once(spark):
    clean = preprocess(raw_team_season(spark, SF_SMALL), catalog.CFG)
    f = engineer_features(clean, catalog.CFG, materialize_base="cache")
    p = f._jdf.queryExecution().executedPlan().toString()
    top = p.split("Window [")[1] if "Window [" in p else p
    # the only exchange between the window and the cached base is the entity partitioning
    assert p.count("Exchange hashpartitioning(team_name#") == 1


def test_flagship_plan_has_no_python_and_no_single_partition(spark):
    clean = preprocess(raw_team_season(spark, SF_SMALL), catalog.CFG)
    f = engineer_features(clean, catalog.CFG, materialize_base="cache")
    f.write.format("noop").mode("overwrite").save()
    p = f._jdf.queryExecution().executedPlan().toString()
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
        assert node not in p
    assert "SinglePartition" not in p     # no window or sort over an unpartitioned frame
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_hot_supplier_is_pre_aggregated(spark):
    """One supplier holding ~1/3 of all lines: exact counts, and the plan
    aggregates partially before the shuffle."""
    from pyspark.sql import functions as F
    from pennant.sources.panel import season_counts_from
    from pennant.sources.tables import read_table
    li = read_table(spark, SF_SMALL, "lineitem")
    hot = li.where(F.col("l_suppkey") == 0)
    n_all, n_hot = li.count(), hot.count()
    copies = max(1, (n_all // 2) // max(n_hot, 1))
    skewed = li.unionByName(hot.withColumn("__c", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("__c"))
    assert (n_hot * (copies + 1)) / skewed.count() > 0.3
    base = {(r.team_id, r.year): r.wins + r.losses for r in season_counts_from(li).collect()}
    sk = {(r.team_id, r.year): r.wins + r.losses for r in season_counts_from(skewed).collect()}
    for k, v in base.items():
        assert sk[k] == v * (copies + 1 if k[0] == 0 else 1)
    plan = season_counts_from(skewed)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_some_features_equal_those_of_the_full_build(spark):
    from pennant.functions.safe import round_doubles
    from pennant.plans.features import engineer_features as build
    clean = preprocess(raw_team_season(spark, SF_SMALL), catalog.CFG)
    full = round_doubles(build(clean, catalog.CFG, materialize_base="cache"))
    for cols in (["team_name", "year", "made_playoffs"], ["team_name", "year", "pythagorean_wins", "wins_3yr_avg"],
                 ["team_name", "year", "wins_percentile", "elite_team", "next_year_playoffs"],
                 ["team_name", "year", "offense_vs_era", "relative_strength", "historical_dominance", "performance_volatility"],
                 full.columns):
        some = round_doubles(build(clean, catalog.CFG, materialize_base="cache", columns=cols))
        want = full.select(*cols)
        assert some.columns == cols and some.exceptAll(want).count() == 0 and want.exceptAll(some).count() == 0
