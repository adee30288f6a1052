"""WN1-WN26 queries."""


from pennant.operators import windows as W
from pennant.plans.catalog import CFG, clean_panel, features, out, register
from pennant.plans.q_scalar import scored
from pennant.sources.panel import team_dims

KEY = ["team_name", "year"]


def _feat(*cols):
    return lambda spark, sf: out(features(spark, sf).select(*KEY, *cols))


_FEATURE_BLOCKS = {
    "WN1_lag_previous": [f"prev_{c}" for c in CFG.prev_columns],
    "WN2_rolling_prior_mean": [f"{c}_{k}yr_avg" for k in CFG.rolling_windows for c in CFG.rolling_columns],
    "WN3_change": [f"{c}_change" for c in CFG.change_columns],
    "WN4_trend_slope": [f"{c}_trend" for c in CFG.trend_columns],
    "WN5_volatility": ["performance_volatility"],
    "WN6_run_diff_consistency": ["run_diff_consistency"],
    "WN7_relative_ratings": ["offensive_rating", "defensive_rating"],
    "WN8_league_strength": ["league_strength", "relative_strength"],
    "WN9_competitive_balance": ["competitive_balance", "normalized_competitive_balance"],
    "WN10_period_percentile": ["wins_percentile", "run_diff_percentile"],
    "WN11_era_zscore": [f"{c}_era_zscore" for c in CFG.era_columns],
    "WN12_era_percentile": [f"{c}_era_percentile" for c in CFG.era_columns],
    "WN13_era_run_environment": ["era", "era_run_environment"],
    "WN14_made_playoffs": ["playoff_spots", "made_playoffs"],
    "WN15_next_year": ["next_year_playoffs", "next_year_wins"],
}
for _k, _cols in _FEATURE_BLOCKS.items():
    register(_k)(_feat(*_cols))


@register("WN16_division_rank")
def q16(spark, sf):
    s = scored(spark, sf).join(team_dims(spark, sf), "team_name", "left")
    return out(W.division_rank(s, ["year", "division"], "division_winner_probability")
               .select(*KEY, "division", "division_rank"))


@register("WN17_rank_comparison")
def q17(spark, sf):
    return out(W.rank_comparison(scored(spark, sf), ["year"], "wins", "predicted_wins")
               .select(*KEY, "actual_rank", "predicted_rank", "rank_difference"))


@register("WN18_centered_mean")
def q18(spark, sf):
    return out(W.centered_mean(clean_panel(spark, sf), "wins", 5).select(*KEY, "wins_cma5"))


@register("WN19_decompose")
def q19(spark, sf):
    return out(W.decompose(clean_panel(spark, sf), "wins").select(*KEY, "trend", "residual"))


@register("WN20_detrended")
def q20(spark, sf):
    return out(W.detrended(clean_panel(spark, sf), "run_differential").select(*KEY, "run_differential_detrended"))


@register("WN21_percentile_flag")
def q21(spark, sf):
    return out(W.percentile_flag(clean_panel(spark, sf), "wins", "year", 0.75).select(*KEY, "playoff_proxy"))


@register("WN22_trailing_mean")
def q22(spark, sf):
    p = W.trailing_mean(clean_panel(spark, sf), "wins", 3)
    p = W.trailing_mean(p, "run_differential", 5, out="run_diff_ma_5")
    return out(p.select(*KEY, "wins_ma_3", "run_diff_ma_5"))


@register("WN23_era_relative")
def q23(spark, sf):
    f = features(spark, sf).select(*KEY, "era", "wins")
    return out(W.group_relative(f, "wins", "era", "era_mean_wins", "era_relative_performance")
               .select(*KEY, "era_mean_wins", "era_relative_performance"))


@register("WN24_lag_n")
def q24(spark, sf):
    p = W.lags(clean_panel(spark, sf), ["wins", "run_differential"], (1, 2, 3))
    return out(p.select(*KEY, "prev_wins", "prev2_wins", "prev3_wins", "prev_run_differential",
                        "prev2_run_differential", "prev3_run_differential"))


@register("WN25_min_max_normalize")
def q25(spark, sf):
    cols = ["wins", "runs_scored", "runs_allowed"]
    return out(W.min_max_normalize(clean_panel(spark, sf), cols).select(*KEY, *[f"{c}_norm" for c in cols]))


@register("WN26_exp_weighted_recent")
def q26(spark, sf):
    return out(W.exp_weighted_recent(clean_panel(spark, sf), "winning_percentage", 5))
