"""Oracle SQL for the single-line keys (AG26, CL20, IO4, JN7, MR8, MR16, MR17,
MR21, UD1-UD3, UD5)."""

from oracle.catalog_sql import P_CLEAN, P_FEAT, SQL
from oracle.sql_metrics import REG
from oracle.sql_scalar import SCORED

PREP = ["runs_per_game", "runs_allowed_per_game", "pythagorean_win_pct", "home_win_pct", "win_pct_vs_top_teams"]

SQL["AG26_distribution_text"] = P_CLEAN + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS metric, avg(CAST({c} AS DOUBLE)) AS mean, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median, "
    f"stddev_samp(CAST({c} AS DOUBLE)) AS std FROM clean" for c in ("wins", "run_differential", "winning_percentage"))
SQL["CL20_prepare_features"] = P_FEAT + "\nSELECT team_name, year, " + ", ".join(
    f"CAST({c} AS DOUBLE) AS f{i}" for i, c in enumerate(PREP)) + " FROM features WHERE " + \
    " AND ".join(f"{c} IS NOT NULL" for c in PREP)
SQL["IO4_save_processed"] = P_CLEAN + "\nSELECT * FROM clean"
SQL["JN7_append_scores"] = SCORED + "\nSELECT team_name, year, wins, predicted_wins, predicted_wins - wins AS error FROM scored"
SQL["MR8_adjusted_r2"] = REG + """,
c AS (SELECT count(*) AS n, 1 - avg((y - yhat) * (y - yhat)) / NULLIF(avg(y * y) - pow(avg(y), 2), 0) AS r2 FROM reg)
SELECT n, r2, CASE WHEN n > 11 THEN 1 - (1 - r2) * (n - 1) / (n - 10 - 1) ELSE r2 END AS adjusted_r2 FROM c"""
SQL["MR16_prediction_range"] = REG + """
SELECT min(yhat) AS min_prediction, max(yhat) AS max_prediction, max(yhat - y) AS largest_over,
  min(yhat - y) AS largest_under,
  first(team_name ORDER BY yhat - y DESC, team_name, year) AS over_team_name,
  first(year ORDER BY yhat - y DESC, team_name, year) AS over_year,
  first(team_name ORDER BY yhat - y ASC, team_name, year) AS under_team_name,
  first(year ORDER BY yhat - y ASC, team_name, year) AS under_year FROM reg"""
SQL["MR17_error_summary"] = REG + """
SELECT avg(yhat - y) AS mean_error, stddev_pop(yhat - y) AS std_error, quantile_cont(abs(yhat - y), 0.5) AS median_ae,
  quantile_cont(abs(yhat - y), 0.9) AS p90_error FROM reg"""
SQL["MR21_custom_scorers"] = REG + """
SELECT 'within_5' AS metric, avg(CAST(abs(y - yhat) <= 5 AS DOUBLE)) AS value FROM reg
UNION ALL SELECT 'within_10', avg(CAST(abs(y - yhat) <= 10 AS DOUBLE)) FROM reg"""
SQL["UD1_row_rules_builtin"] = P_FEAT + \
    "\nSELECT team_name, year, at_home_wins, streak_type, streak_length, era, era_adjusted_elite_wins FROM features"
SQL["UD2_group_transform_builtin"] = P_FEAT + \
    "\nSELECT team_name, year, offensive_rating, run_diff_consistency, wins_era_zscore FROM features"
SQL["UD3_rolling_slope_builtin"] = P_FEAT + "\nSELECT team_name, year, wins_trend, winning_percentage_trend FROM features"
# the solver's answer in closed form
SQL["UD5_partition_apply"] = P_CLEAN + """,
r AS (SELECT team_name, year, CASE WHEN wins > 0 AND losses > 0 AND runs_scored > 0 AND runs_allowed > 0 AND runs_scored <> runs_allowed
  THEN ln(CAST(wins AS DOUBLE) / losses) / ln(CAST(runs_scored AS DOUBLE) / runs_allowed) END AS e FROM clean)
SELECT team_name, year, CASE WHEN abs(e) < 59.999 THEN e END AS exponent FROM r"""
