"""SC1-SC39 queries."""

from pyspark.sql import functions as F

from pennant.config import MILESTONE_THRESHOLDS
from pennant.functions import scalar as S
from pennant.functions.safe import clip, safe_divide
from pennant.plans import features as FE
from pennant.plans.catalog import CFG, clean_panel, features, out, register
from pennant.sources import dims
from pennant.sources.panel import team_dims

KEY = ["team_name", "year"]


def scored(spark, sf):
    """Deterministic scored frame: predicted wins = Pythagorean pct x 162,
    division probability = in-season wins percentile (no model needed)."""
    own = [*KEY, "era", "wins", "losses", "games_behind", "total_games", "runs_scored", "runs_allowed", "is_division_winner"]
    f = features(spark, sf, [*own, "pythagorean_win_pct", "wins_percentile"])
    return f.select(*own, (F.col("pythagorean_win_pct") * 162).alias("predicted_wins"),
                    F.col("wins_percentile").alias("division_winner_probability"))


@register("SC1_4_performance")
def q1(spark, sf):
    return out(FE.performance_features(clean_panel(spark, sf)).select(
        *KEY, "total_games", "home_games", "home_win_pct", "away_games", "away_win_pct", "home_away_diff",
        "win_pct_vs_top_teams"))


@register("SC5_7_efficiency")
def q5(spark, sf):
    return out(FE.efficiency_features(FE.performance_features(clean_panel(spark, sf))).select(
        *KEY, "runs_per_game", "runs_allowed_per_game", "run_efficiency", "close_game_factor"))


@register("SC8_9_pythagorean")
def q8(spark, sf):
    return out(FE.pythagorean_features(FE.performance_features(clean_panel(spark, sf))).select(
        *KEY, "pythagorean_wins", "pythagorean_win_pct", "luck_factor", "luck_pct", "performance_above_talent"))


@register("SC10_11_momentum")
def q10(spark, sf):
    return out(FE.momentum_features(clean_panel(spark, sf)).select(
        *KEY, "momentum", "hot_team", "cold_team", "streak_score", "long_winning_streak"))


@register("SC12_15_consistency")
def q12(spark, sf):
    return out(features(spark, sf).select(*KEY, "consistency_score", "location_consistency", "run_diff_per_game",
                                          "performance_reliability"))


@register("SC16_19_era_relative")
def q16(spark, sf):
    return out(features(spark, sf).select(*KEY, "elite_team", "above_average_team", "era_adjusted_elite_wins",
                                          "offense_vs_era", "defense_vs_era", "historical_dominance"))


@register("SC20_23_target_flags")
def q20(spark, sf):
    f = FE.target_flags(clean_panel(spark, sf), CFG)
    return out(f.select(*KEY, "is_division_winner", *[f"achieved_{t}_wins" for t in CFG.win_milestones],
                        f"scored_{CFG.runs_scored_milestone}_runs",
                        f"allowed_under_{CFG.runs_allowed_milestone}_runs", "terrible_season", "historic_season"))


@register("SC24_playoff_spots")
def q24(spark, sf):
    return out(clean_panel(spark, sf).select(*KEY, dims.playoff_spots_case(F.col("year"), CFG.playoff_steps)
                                             .alias("playoff_spots")))


@register("SC25_safe_divide")
def q25(spark, sf):
    return out(clean_panel(spark, sf).select(*KEY, safe_divide(F.col("wins"), F.col("losses") - 30, 0.0)
                                             .alias("wins_per_extra_loss")))


@register("SC26_expected_games")
def q26(spark, sf):
    return out(clean_panel(spark, sf).select(*KEY, dims.expected_games(F.col("year")).alias("expected_games"),
                                             dims.is_shortened_season(F.col("year")).alias("is_shortened")))


@register("SC27_division_league")
def q27(spark, sf):
    d = team_dims(spark, sf)
    p = clean_panel(spark, sf).select(*KEY).join(d, "team_name", "left")
    return out(p.select(*KEY, F.coalesce("division", F.lit("unknown")).alias("division"),
                        F.coalesce("league", F.lit("unknown")).alias("league")))


@register("SC28_season_dates")
def q28(spark, sf):
    d = clean_panel(spark, sf).select(*KEY, *dims.season_dates(F.col("year")))
    return out(d.select(*KEY, *[F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("season_start", "season_end")]))


@register("SC29_threshold_tiers")
def q29(spark, sf):
    return out(clean_panel(spark, sf).select(
        *KEY, S.threshold_tier("wins", MILESTONE_THRESHOLDS["wins"]).alias("wins_tier"),
        S.threshold_tier("run_differential", MILESTONE_THRESHOLDS["run_differential"]).alias("run_diff_tier")))


@register("SC30_performance_tier")
def q30(spark, sf):
    s = scored(spark, sf).select(*KEY, S.performance_tier("predicted_wins").alias("tier"))
    return out(s.withColumn("tier_label", S.tier_label("tier")))


@register("SC31_projection_category")
def q31(spark, sf):
    return out(scored(spark, sf).select(*KEY, S.projection_category("predicted_wins").alias("projection_category")))


@register("SC32_confidence")
def q32(spark, sf):
    s = scored(spark, sf).select(*KEY, S.binary_confidence("division_winner_probability").alias("confidence"))
    return out(s.withColumn("confidence_level", S.confidence_level("confidence")))


@register("SC33_report_tiers")
def q33(spark, sf):
    return out(scored(spark, sf).select(*KEY, S.report_win_tier("predicted_wins").alias("win_outlook"),
                                        S.report_division_tier("division_winner_probability").alias("division_outlook")))


@register("SC34_pythagorean_exponent")
def q34(spark, sf):
    return out(clean_panel(spark, sf).select(*KEY, S.pythagorean_wins_exp("runs_scored", "runs_allowed", 1.83)
                                             .alias("pythag_wins_162")))


@register("SC35_implied_counterpart")
def q35(spark, sf):
    return out(clean_panel(spark, sf).select(
        *KEY, S.implied_counterpart("runs_scored").alias("implied_runs_allowed"),
        (F.col("runs_scored") - S.implied_counterpart("runs_scored")).alias("implied_differential")))


@register("SC36_clip")
def q36(spark, sf):
    s = scored(spark, sf)
    return out(s.select(*KEY, clip("predicted_wins", 0, 162).alias("wins_clipped"),
                        clip("runs_scored", 400, 1100).alias("runs_clipped")))


@register("SC37_error_bounds")
def q37(spark, sf):
    s = scored(spark, sf)
    lo95, hi95 = S.error_bounds("predicted_wins", 0.95)
    lo99, hi99 = S.error_bounds("predicted_wins", 0.99)
    return out(s.select(*KEY, lo95.alias("lower_95"), hi95.alias("upper_95"), lo99.alias("lower_99"),
                        hi99.alias("upper_99")))


@register("SC38_pace_projection")
def q38(spark, sf):
    s = scored(spark, sf)
    return out(s.select(*KEY, S.pace_simple("wins", "total_games").alias("pace_simple"),
                        S.pace_weighted("wins", "total_games").alias("pace_weighted"),
                        S.pace_blended("wins", "total_games", "predicted_wins").alias("pace_blended")))


@register("SC39_standings_adjusted")
def q39(spark, sf):
    s = S.standings_adjusted(scored(spark, sf), "division_winner_probability", "games_behind", group=["year"])
    return out(s.select(*KEY, "adjusted_probability"))
