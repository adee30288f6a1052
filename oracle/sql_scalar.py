"""Oracle SQL for SC1-SC39."""

from oracle.catalog_sql import P_CLEAN, P_FEAT, SQL
from oracle.panel_sql import _case_spots
from pennant.config import MILESTONE_THRESHOLDS, SYNTHETIC as CFG

SCORED = P_FEAT + """,
scored AS (
  SELECT team_name, year, era, wins, losses, games_behind, total_games, runs_scored, runs_allowed,
    is_division_winner, pythagorean_win_pct * 162 AS predicted_wins,
    wins_percentile AS division_winner_probability
  FROM features
)"""


def D(a, b):
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def tier(col, th):
    items = sorted(th.items(), key=lambda kv: kv[1], reverse=True)
    return "CASE " + " ".join(f"WHEN {col} >= {t} THEN '{n}'" for n, t in items) + " END"


SQL["SC1_4_performance"] = P_FEAT + """
SELECT team_name, year, total_games, home_games, home_win_pct, away_games, away_win_pct, home_away_diff,
  win_pct_vs_top_teams FROM features"""
SQL["SC5_7_efficiency"] = P_FEAT + """
SELECT team_name, year, runs_per_game, runs_allowed_per_game, run_efficiency, close_game_factor FROM features"""
SQL["SC8_9_pythagorean"] = P_FEAT + """
SELECT team_name, year, pythagorean_wins, pythagorean_win_pct, luck_factor, luck_pct, performance_above_talent
FROM features"""
SQL["SC10_11_momentum"] = P_FEAT + """
SELECT team_name, year, momentum, hot_team, cold_team, streak_score, long_winning_streak FROM features"""
SQL["SC12_15_consistency"] = P_FEAT + """
SELECT team_name, year, consistency_score, location_consistency, run_diff_per_game, performance_reliability
FROM features"""
SQL["SC16_19_era_relative"] = P_FEAT + """
SELECT team_name, year, elite_team, above_average_team, era_adjusted_elite_wins, offense_vs_era, defense_vs_era,
  historical_dominance FROM features"""
SQL["SC20_23_target_flags"] = P_FEAT + f"""
SELECT team_name, year, is_division_winner, {', '.join(f'achieved_{t}_wins' for t in CFG.win_milestones)},
  scored_{CFG.runs_scored_milestone}_runs, allowed_under_{CFG.runs_allowed_milestone}_runs, terrible_season,
  historic_season FROM features"""
SQL["SC24_playoff_spots"] = P_CLEAN + f"\nSELECT team_name, year, {_case_spots(CFG)} AS playoff_spots FROM clean"
SQL["SC25_safe_divide"] = P_CLEAN + f"\nSELECT team_name, year, COALESCE({D('wins', 'losses - 30')}, 0.0) AS wins_per_extra_loss FROM clean"
SQL["SC26_expected_games"] = P_CLEAN + """
SELECT team_name, year,
  CASE WHEN year = 1981 THEN 110 WHEN year = 1994 THEN 113 WHEN year = 1995 THEN 144 WHEN year = 2020 THEN 60
       WHEN year >= 1961 THEN 162 WHEN year >= 1904 THEN 154 ELSE 140 END AS expected_games,
  CAST(year IN (1981, 1994, 1995, 2020) AS INTEGER) AS is_shortened
FROM clean"""
SQL["SC27_division_league"] = P_CLEAN + """,
dims AS (
  SELECT 'Team ' || CAST(s.s_suppkey AS VARCHAR) AS team_name, n.n_name AS division, r.r_name AS league
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
)
SELECT c.team_name, c.year, COALESCE(d.division, 'unknown') AS division, COALESCE(d.league, 'unknown') AS league
FROM clean c LEFT JOIN dims d ON c.team_name = d.team_name"""
SQL["SC28_season_dates"] = P_CLEAN + """
SELECT team_name, year, strftime(make_date(year, 4, 1), '%Y-%m-%d') AS season_start,
  strftime(make_date(year, 10, 31), '%Y-%m-%d') AS season_end FROM clean"""
SQL["SC29_threshold_tiers"] = P_CLEAN + f"""
SELECT team_name, year, {tier('wins', MILESTONE_THRESHOLDS['wins'])} AS wins_tier,
  {tier('run_differential', MILESTONE_THRESHOLDS['run_differential'])} AS run_diff_tier FROM clean"""
SQL["SC30_performance_tier"] = SCORED + """,
t AS (SELECT team_name, year, CASE WHEN predicted_wins IS NULL THEN NULL WHEN predicted_wins >= 95 THEN 4
        WHEN predicted_wins >= 90 THEN 3 WHEN predicted_wins >= 81 THEN 2 WHEN predicted_wins >= 70 THEN 1
        ELSE 0 END AS tier FROM scored)
SELECT team_name, year, tier,
  (['Rebuilding', 'Below Average', 'Average', 'Contender', 'Elite'])[tier + 1] AS tier_label FROM t"""
SQL["SC31_projection_category"] = SCORED + """
SELECT team_name, year, CASE WHEN predicted_wins > 0 AND predicted_wins <= 65 THEN 'Terrible'
  WHEN predicted_wins > 65 AND predicted_wins <= 75 THEN 'Poor'
  WHEN predicted_wins > 75 AND predicted_wins <= 85 THEN 'Below Average'
  WHEN predicted_wins > 85 AND predicted_wins <= 95 THEN 'Good'
  WHEN predicted_wins > 95 AND predicted_wins <= 105 THEN 'Excellent'
  WHEN predicted_wins > 105 AND predicted_wins <= 163 THEN 'Elite' END AS projection_category FROM scored"""
SQL["SC32_confidence"] = SCORED + """,
c AS (SELECT team_name, year, ABS(division_winner_probability - 0.5) * 2 AS confidence FROM scored)
SELECT team_name, year, confidence,
  CASE WHEN confidence >= 0.7 THEN 'high' WHEN confidence >= 0.4 THEN 'medium' ELSE 'low' END AS confidence_level
FROM c"""
SQL["SC33_report_tiers"] = SCORED + """
SELECT team_name, year,
  CASE WHEN predicted_wins >= 95 THEN 'Elite team projection with strong championship potential'
       WHEN predicted_wins >= 90 THEN 'Solid playoff contender with division title possibilities'
       WHEN predicted_wins >= 85 THEN 'Wild card contender in competitive position'
       WHEN predicted_wins >= 81 THEN 'Above .500 team with outside playoff chances'
       ELSE 'Rebuilding phase with focus on development' END AS win_outlook,
  CASE WHEN division_winner_probability > 0.5 THEN 'Favored to win division'
       WHEN division_winner_probability > 0.25 THEN 'Strong division contender' END AS division_outlook
FROM scored"""
SQL["SC34_pythagorean_exponent"] = P_CLEAN + f"""
SELECT team_name, year, {D('162.0 * POW(CAST(runs_scored AS DOUBLE), 1.83)',
                            'POW(CAST(runs_scored AS DOUBLE), 1.83) + POW(CAST(runs_allowed AS DOUBLE), 1.83)')}
  AS pythag_wins_162 FROM clean"""
SQL["SC35_implied_counterpart"] = P_CLEAN + """
SELECT team_name, year, 750.0::DOUBLE + (750.0::DOUBLE - runs_scored) * 0.5::DOUBLE AS implied_runs_allowed,
  runs_scored - (750.0::DOUBLE + (750.0::DOUBLE - runs_scored) * 0.5::DOUBLE) AS implied_differential FROM clean"""
SQL["SC36_clip"] = SCORED + """
SELECT team_name, year, GREATEST(LEAST(predicted_wins, 162), 0) AS wins_clipped,
  GREATEST(LEAST(runs_scored, 1100), 400) AS runs_clipped FROM scored"""
SQL["SC37_error_bounds"] = SCORED + """
SELECT team_name, year,
  GREATEST(LEAST(predicted_wins - 1.96 * 10.0, 162.0), 0.0) AS lower_95,
  GREATEST(LEAST(predicted_wins + 1.96 * 10.0, 162.0), 0.0) AS upper_95,
  GREATEST(LEAST(predicted_wins - 2.58 * 10.0, 162.0), 0.0) AS lower_99,
  GREATEST(LEAST(predicted_wins + 2.58 * 10.0, 162.0), 0.0) AS upper_99 FROM scored"""
SQL["SC38_pace_projection"] = SCORED + f""",
p AS (SELECT *, {D('wins', 'total_games')} * 162 AS pace,
        LEAST({D('total_games', '162')}, 1.0) * 0.7 AS w, {D('total_games', '162')} AS wb FROM scored)
SELECT team_name, year, pace AS pace_simple, w * pace + (1 - w) * 81.0 AS pace_weighted,
  wb * pace + (1 - wb) * predicted_wins AS pace_blended FROM p"""
SQL["SC39_standings_adjusted"] = SCORED + """,
a AS (SELECT *, division_winner_probability * (1.0 / NULLIF(1 + COALESCE(games_behind, 0.0) / 10, 0)) AS adj
      FROM scored)
SELECT team_name, year,
  adj / NULLIF(sum(adj) OVER (PARTITION BY year), 0) * sum(division_winner_probability) OVER (PARTITION BY year)
    AS adjusted_probability
FROM a"""
