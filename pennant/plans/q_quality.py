"""DQ1-DQ13 queries."""

from pennant.operators import quality as Q
from pennant.plans.catalog import features, out, raw, register
from pennant.sources.tables import read_table


@register("DQ1_validate")
def q_dq1(spark, sf):
    return out(Q.validate(raw(spark, sf)))


@register("DQ2_numeric_check")
def q_dq2(spark, sf):
    return out(Q.numeric_check(raw(spark, sf), list(Q.NUMERIC) + ["games_behind", "wild_card_games_behind"]))


@register("DQ3_duplicate_keys")
def q_dq3(spark, sf):
    return out(Q.duplicate_key_count(read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]))


@register("DQ4_period_range")
def q_dq4(spark, sf):
    return out(Q.period_range_check(raw(spark, sf), "year", 1901, 1998))


@register("DQ5_unusual_totals")
def q_dq5(spark, sf):
    return out(Q.unusual_totals(raw(spark, sf), 80, 100))


@register("DQ6_null_counts")
def q_dq6(spark, sf):
    return out(Q.null_counts(raw(spark, sf)))


@register("DQ8_data_info")
def q_dq8(spark, sf):
    return out(Q.data_info(raw(spark, sf)))


@register("DQ9_quality_profile")
def q_dq9(spark, sf):
    return out(Q.quality_profile(raw(spark, sf)))


@register("DQ9_duplicate_rows")
def q_dq9b(spark, sf):
    return out(Q.duplicate_rows(read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber",
                                                                          "l_returnflag")))


@register("DQ11_validate_input")
def q_dq11(spark, sf):
    return out(Q.validate_input(raw(spark, sf), max_games=100)
               .select("team_name", "year", "n_errors", "errors", "is_valid"))


@register("DQ12_missing_profile")
def q_dq12(spark, sf):
    return out(Q.missing_profile(features(spark, sf)))


@register("DQ13_feature_validity")
def q_dq13(spark, sf):
    ratios = ["home_win_pct", "away_win_pct", "win_pct_vs_top_teams", "pythagorean_win_pct",
              "wins_percentile", "run_diff_percentile", "last_10_pct", "winning_percentage"]
    return out(Q.feature_validity(features(spark, sf), ratios))
