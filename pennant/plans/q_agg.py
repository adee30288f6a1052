"""AG, TK, JN, ST and SP queries."""

from pyspark.sql import functions as F

from pennant.functions import scalar as S
from pennant.operators import aggregates as A
from pennant.operators import joins as J
from pennant.operators import reshape as R
from pennant.operators import split as SP
from pennant.operators import topk as T
from pennant.plans.catalog import CFG, clean_panel, features, out, register
from pennant.plans.q_metrics import reg_scored
from pennant.plans.q_scalar import scored
from pennant.sources.panel import team_dims

KEY = ["team_name", "year"]
METRICS = ["wins", "losses", "runs_scored", "runs_allowed", "run_differential", "winning_percentage"]
MILESTONES = [f"achieved_{t}_wins" for t in CFG.win_milestones]
TARGETS = ["is_division_winner", "made_playoffs", *MILESTONES, "terrible_season", "historic_season"]
CORR_COLS = ["wins", "runs_scored", "runs_allowed", "run_differential", "winning_percentage",
             "pythagorean_win_pct", "prev_wins", "wins_3yr_avg"]
FEATS = ["pythagorean_win_pct", "run_diff_per_game", "prev_wins", "wins_3yr_avg", "home_win_pct",
         "win_pct_vs_top_teams", "momentum", "wins_trend"]


def scored_levels(spark, sf):
    s = scored(spark, sf)
    return s.withColumns({"confidence_level": S.confidence_level(S.binary_confidence("division_winner_probability")),
                          "division_winner_prediction": (F.col("division_winner_probability") > 0.5).cast("int")})


@register("AG1_eda_summary")
def ag1(spark, sf):
    return out(A.eda_summary(clean_panel(spark, sf), METRICS))


@register("AG2_season_summary")
def ag2(spark, sf):
    return out(A.season_summary(clean_panel(spark, sf)))


@register("AG3_entity_era_summary")
def ag3(spark, sf):
    return out(A.entity_group_summary(features(spark, sf), ("team_name", "era")))


@register("AG4_entity_summary")
def ag4(spark, sf):
    return out(A.entity_summary(clean_panel(spark, sf), CFG.win_milestones[1]))


@register("AG5_recent_summary")
def ag5(spark, sf):
    return out(A.recent_summary(clean_panel(spark, sf), 5))


@register("AG6_latest_period_stats")
def ag6(spark, sf):
    return out(A.latest_period_stats(clean_panel(spark, sf)))


@register("AG7_error_by_period")
def ag7(spark, sf):
    return out(A.error_by_group(reg_scored(spark, sf), ["year"]))


@register("AG8_mae_by_entity_top")
def ag8(spark, sf):
    return out(A.mae_by_entity_top(reg_scored(spark, sf), 15))


@register("AG9_accuracy_by_confidence")
def ag9(spark, sf):
    return out(A.accuracy_by_level(scored_levels(spark, sf), "confidence_level", "is_division_winner",
                                   "division_winner_prediction"))


@register("AG11_target_summary")
def ag11(spark, sf):
    return out(A.target_summary(features(spark, sf, TARGETS), TARGETS))


@register("AG12_value_counts")
def ag12(spark, sf):
    return out(A.class_counts_side_by_side(scored_levels(spark, sf), "is_division_winner", "division_winner_prediction"))


@register("AG12_confidence_counts")
def ag12b(spark, sf):
    return out(scored_levels(spark, sf).groupBy("confidence_level").agg(F.count(F.lit(1)).alias("n")))


@register("AG13_prediction_summary")
def ag13(spark, sf):
    return out(A.prediction_summary(scored_levels(spark, sf)))


@register("AG14_correlation_matrix")
def ag14(spark, sf):
    return out(A.correlation_matrix(features(spark, sf, CORR_COLS), CORR_COLS))


@register("AG14_spearman_matrix")
def ag14s(spark, sf):
    return out(A.correlation_matrix(features(spark, sf, [*KEY, *CORR_COLS[:5]]), CORR_COLS[:5], method="spearman"))


@register("AG15_target_correlations")
def ag15(spark, sf):
    return out(A.target_correlations(features(spark, sf), FEATS, "next_year_wins"))


@register("AG16_label_correlations")
def ag16(spark, sf):
    return out(A.correlation_matrix(features(spark, sf), MILESTONES + ["made_playoffs"]))


@register("AG17_simple_regression")
def ag17(spark, sf):
    return out(A.simple_regression(features(spark, sf), "wins", "runs_scored"))


@register("AG18_change_distribution")
def ag18(spark, sf):
    return out(A.change_distribution(clean_panel(spark, sf), "wins"))


@register("AG19_20_trend_report")
def ag19(spark, sf):
    return out(A.trend_report(clean_panel(spark, sf), ["wins", "run_differential"]))


@register("AG21_milestone_rates")
def ag21(spark, sf):
    return out(A.rates(features(spark, sf), MILESTONES + ["made_playoffs"]))


@register("AG22_mean_importance")
def ag22(spark, sf):
    f = features(spark, sf)
    long = None
    for lab in MILESTONES:
        t = A.target_correlations(f, FEATS, lab).select("feature", F.col("abs_corr").alias("importance"))
        long = t if long is None else long.unionByName(t)
    return out(A.mean_importance(long))


@register("AG23_histogram")
def ag23(spark, sf):
    return out(A.histogram(clean_panel(spark, sf), "wins", 20))


@register("AG24_box_stats")
def ag24(spark, sf):
    return out(A.box_stats(features(spark, sf), "wins", "era"))


@register("AG25_qq_points")
def ag25(spark, sf):
    return out(A.qq_points(reg_scored(spark, sf).select((F.col("y") - F.col("yhat")).alias("residual")), "residual"))


@register("AG27_kde")
def ag27(spark, sf):
    return out(A.kde(clean_panel(spark, sf), "wins", 100))


@register("AG28_distinct_counts")
def ag28(spark, sf):
    return out(A.distinct_counts(clean_panel(spark, sf), ["team_name", "year", "wins"]))


@register("TK1_order_by_prediction")
def tk1(spark, sf):
    return out(T.order_by_value(scored(spark, sf).select(*KEY, "predicted_wins"), "predicted_wins"))


@register("TK2_top_n")
def tk2(spark, sf):
    s = scored(spark, sf).select(*KEY, "predicted_wins")
    return out(T.top_n(s, "predicted_wins", 10).withColumn("side", F.lit("largest"))
               .unionByName(T.top_n(s, "predicted_wins", 5, largest=False).withColumn("side", F.lit("smallest"))))


@register("TK3_top_n_per_period")
def tk3(spark, sf):
    return out(T.top_n_per_group(clean_panel(spark, sf).select(*KEY, "wins"), ["year"], "wins", 5))


@register("TK4_rows_of_top_entities")
def tk4(spark, sf):
    return out(T.rows_of_top_entities(clean_panel(spark, sf).select(*KEY, "wins"), "wins", 5))


@register("TK5_largest_errors")
def tk5(spark, sf):
    return out(T.largest_errors(reg_scored(spark, sf).select(*KEY, "y", "yhat"), n=10))


@register("TK6_arg_extremes")
def tk6(spark, sf):
    r = reg_scored(spark, sf).withColumn("residual", F.col("y") - F.col("yhat"))
    return out(T.arg_extremes(r, "residual"))


@register("TK7_predicted_winners")
def tk7(spark, sf):
    return out(T.predicted_winners(scored(spark, sf).select(*KEY, "division_winner_probability"),
                                   "division_winner_probability", 6))


@register("JN1_actual_vs_predicted")
def jn1(spark, sf):
    a = clean_panel(spark, sf).select(*KEY, "wins")
    p = scored(spark, sf).select(*KEY, F.col("predicted_wins").alias("wins"))
    return out(J.join_with_suffixes(a, p, KEY))


@register("JN2_dimension_lookups")
def jn2(spark, sf):
    d = J.lookup_dims(clean_panel(spark, sf).select(*KEY), spark, team_dims(spark, sf))
    return out(d.select(*KEY, "division", "league", "season_games"))


@register("JN4_membership_flag")
def jn4(spark, sf):
    p = clean_panel(spark, sf).select(*KEY, "wins")
    top = T.rows_of_top_entities(p, "wins", 10)
    return out(J.membership_flag(p, top, ["team_name"], "top_franchise").select(*KEY, "top_franchise"))


@register("JN5_align_importances")
def jn5(spark, sf):
    f = features(spark, sf)
    a = A.target_correlations(f, FEATS, "next_year_wins").select("feature", F.lit("wins_model").alias("model"),
                                                                  F.col("abs_corr").alias("importance"))
    b = A.target_correlations(f, FEATS[:5], "made_playoffs").select("feature", F.lit("playoff_model").alias("model"),
                                                                     F.col("abs_corr").alias("importance"))
    return out(J.align_importances(a.unionByName(b), ["wins_model", "playoff_model"]))


@register("JN6_group_stat_back")
def jn6(spark, sf):
    p = J.group_stat_back(clean_panel(spark, sf).select(*KEY, "wins"), "year", "wins", "mean")
    return out(p.withColumn("wins_vs_year_mean", F.col("wins") - F.col("year_mean_wins")))


@register("ST1_union_batches")
def st1(spark, sf):
    p = clean_panel(spark, sf).select(*KEY, "wins")
    return out(R.union_all([p.where(F.col("year") % 2 == 0), p.where(F.col("year") % 2 == 1)]))


@register("ST2_train_val_stack")
def st2(spark, sf):
    s = SP.three_way_period_split(clean_panel(spark, sf).select(*KEY, "wins"), 2001)
    return out(R.union_all([s.where(F.col("split") == "train"), s.where(F.col("split") == "val")]))


@register("ST3_wide_to_long")
def st3(spark, sf):
    f = features(spark, sf).select(*KEY, *MILESTONES)
    return out(R.wide_to_long(f, KEY, MILESTONES, "milestone", "achieved"))


@register("ST4_long_to_wide")
def st4(spark, sf):
    long = A.error_by_group(reg_scored(spark, sf), ["era", "year"]).select("year", "era", "mae")
    return out(R.long_to_wide(long, ["year"], "era", [e for e, *_ in CFG.era_ranges], "mae"))


@register("ST5_label_matrix")
def st5(spark, sf):
    f = clean_panel(spark, sf)
    defs = {f"wins_{t}": F.col("wins") >= t for t in CFG.win_milestones}
    defs["contender"] = (F.col("wins") >= CFG.win_milestones[0]) | F.col("games_behind").isNull()
    return out(R.label_matrix(f, defs).select(*KEY, *defs))


@register("SP1_stratified_split")
def sp1(spark, sf):
    return out(SP.stratified_split(features(spark, sf, [*KEY, "made_playoffs"]).select(*KEY, "made_playoffs"), "made_playoffs", KEY))


@register("SP2_quantile_period_split")
def sp2(spark, sf):
    return out(SP.quantile_period_split(clean_panel(spark, sf).select(*KEY), KEY))


@register("SP3_last_periods_split")
def sp3(spark, sf):
    return out(SP.last_periods_split(clean_panel(spark, sf).select(*KEY), 3))


@register("SP4_three_way_split")
def sp4(spark, sf):
    return out(SP.three_way_period_split(clean_panel(spark, sf).select(*KEY), 2000))


@register("SP5_kfold")
def sp5(spark, sf):
    return out(SP.kfold(clean_panel(spark, sf).select(*KEY), KEY, 5))


@register("SP6_stratified_kfold")
def sp6(spark, sf):
    return out(SP.stratified_kfold(features(spark, sf, [*KEY, "made_playoffs"]).select(*KEY, "made_playoffs"), "made_playoffs", KEY, 5))


@register("SP7_time_series_folds")
def sp7(spark, sf):
    return out(SP.time_series_folds(clean_panel(spark, sf).select(*KEY), k=3, gap=1, max_train=3))


@register("SP8_expanding_folds")
def sp8(spark, sf):
    return out(SP.time_series_folds(clean_panel(spark, sf).select(*KEY), k=3))


@register("SP9_learning_curve_subsets")
def sp9(spark, sf):
    return out(SP.learning_curve_subsets(clean_panel(spark, sf).select(*KEY), KEY))
