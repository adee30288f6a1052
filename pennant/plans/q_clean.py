"""CL1-CL22 queries."""

from pyspark.sql import functions as F

from pennant.config import DISPLAY_ERA_STARTS
from pennant.operators import clean as C
from pennant.plans.catalog import CFG, clean_panel, features, out, raw, register
from pennant.sources.dims import era_open_case, era_range_join
from pennant.sources.panel import team_aliases

KEY = ["team_name", "year"]


@register("CL1_drop_duplicates")
def q1(spark, sf):
    return out(C.drop_duplicate_rows(raw(spark, sf)))


@register("CL2_strip_strings")
def q2(spark, sf):
    return out(C.strip_strings(raw(spark, sf)))


@register("CL3_rename_values")
def q3(spark, sf):
    return out(C.rename_values(raw(spark, sf), "team_name").select(*KEY))


@register("CL4_normalize_names")
def q4(spark, sf):
    return out(C.normalize_names(raw(spark, sf), team_aliases(spark, sf)).select(*KEY))


@register("CL5_fill_defaults")
def q5(spark, sf):
    return out(C.fill_defaults(C.strip_strings(raw(spark, sf)))
               .select(*KEY, "record_in_the_last_10_games", "current_streak"))


@register("CL6_coerce_types")
def q6(spark, sf):
    return out(C.coerce_types(C.strip_strings(raw(spark, sf)))
               .select(*KEY, "winning_percentage", "games_behind", "wild_card_games_behind"))


@register("CL7_parse_records")
def q7(spark, sf):
    return out(clean_panel(spark, sf).select(
        *KEY, "at_home_wins", "at_home_losses", "when_away_wins", "when_away_losses",
        "against_top_50_percent_wins", "against_top_50_percent_losses",
        "expected_win_loss_record_wins", "expected_win_loss_record_losses"))


@register("CL8_parse_last_10")
def q8(spark, sf):
    return out(clean_panel(spark, sf).select(*KEY, "last_10_wins", "last_10_losses", "last_10_pct"))


@register("CL9_parse_streak")
def q9(spark, sf):
    return out(clean_panel(spark, sf).select(*KEY, "streak_type", "streak_length", "on_winning_streak"))


@register("CL10_filter_period_range")
def q10(spark, sf):
    return out(C.filter_period_range(clean_panel(spark, sf), 1996, 1999).select(*KEY, "wins"))


@register("CL11_era_strategy_filter")
def q11(spark, sf):
    return out(C.filter_era_strategy(clean_panel(spark, sf), "modern", CFG.modern_strategy_years).select(*KEY))


@register("CL12_era_splits")
def q12(spark, sf):
    return out(C.era_counts(clean_panel(spark, sf), CFG.era_ranges))


@register("CL13_era_closed_ranges")
def q13(spark, sf):
    return out(C.add_era(clean_panel(spark, sf), CFG.era_ranges).select(*KEY, "era"))


@register("JN3_era_range_join")
def q13b(spark, sf):
    return out(era_range_join(clean_panel(spark, sf).select(*KEY), spark, CFG.era_ranges))


@register("CL14_era_open_ended")
def q14(spark, sf):
    return out(clean_panel(spark, sf).select(*KEY, era_open_case(F.col("year"), CFG.era_starts).alias("era")))


@register("CL15_era_display")
def q15(spark, sf):
    return out(clean_panel(spark, sf).select(*KEY, era_open_case(F.col("year"), DISPLAY_ERA_STARTS).alias("era")))


@register("CL17_membership_filter")
def q17(spark, sf):
    return out(C.keep_members(clean_panel(spark, sf), "team_name", [f"Team {i}" for i in range(1, 10)])
               .select(*KEY, "wins"))


@register("CL18_drop_incomplete")
def q18(spark, sf):
    return out(C.drop_incomplete(clean_panel(spark, sf), ["at_home_wins", "wins"]).select(*KEY))


@register("CL19_display_projection")
def q19(spark, sf):
    return out(C.display_projection(features(spark, sf),
                                    {"team_name": "team", "year": "season", "wins": "wins",
                                     "winning_percentage": "win_pct"},
                                    round_digits={"winning_percentage": 3},
                                    percent={"pythagorean_win_pct": "pythag_pct_text"}))


@register("CL21_calculated_fields")
def q21(spark, sf):
    p = clean_panel(spark, sf).drop("winning_percentage", "run_differential")
    return out(C.add_calculated_fields(p).select(*KEY, "winning_percentage", "run_differential"))


@register("CL22_standard_scale")
def q22(spark, sf):
    cols = ["wins", "runs_scored", "runs_allowed"]
    return out(C.standard_scale(clean_panel(spark, sf), cols).select(*KEY, *[f"{c}_scaled" for c in cols]))
