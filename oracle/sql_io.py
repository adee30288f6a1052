"""Oracle SQL for the IO round trips."""

from oracle.catalog_sql import P_CLEAN, P_FEAT, SQL
from oracle.sql_scalar import SCORED
from pennant.config import SYNTHETIC as CFG

MILESTONES = [f"achieved_{t}_wins" for t in CFG.win_milestones]
PRED = SCORED + ",\npred AS (SELECT team_name, year, predicted_wins, division_winner_probability FROM scored)"


def _r(x, d):
    k = float(10 ** d)
    return f"CASE WHEN abs({x}) < 1e12 THEN floor({x} * {k!r}::DOUBLE + 0.5::DOUBLE) / {k!r}::DOUBLE ELSE {x} END"


SQL["IO1_csv_roundtrip"] = P_CLEAN + "\nSELECT * FROM clean"
SQL["IO3_load_predictions"] = PRED + "\nSELECT * FROM pred"
SQL["IO5_save_formats"] = PRED + "\nSELECT pred.*, t.format FROM pred, (VALUES ('csv'), ('json'), ('parquet')) t(format)"
SQL["IO6_report_sheets"] = PRED + """
SELECT team_name, year, predicted_wins, division_winner_probability,
  CAST(division_winner_probability > 0.5 AS INTEGER) AS division_winner_prediction
FROM pred ORDER BY predicted_wins DESC, team_name LIMIT 10"""
SQL["IO7_load_season"] = P_CLEAN + """
SELECT team_name, 2002 AS year, wins, 'historical' AS source FROM clean WHERE year = (SELECT max(year) FROM clean)
UNION ALL SELECT team_name, 1999 AS year, wins, 'historical_present' FROM clean WHERE year = 1999
UNION ALL SELECT team_name, year, wins, 'latest' FROM clean WHERE year = (SELECT max(year) FROM clean)"""
SQL["IO8_api_payload"] = P_FEAT + """,
p AS (SELECT team_name, wins, pythagorean_win_pct * 162 AS pw, wins_percentile AS prob, """ + ", ".join(
    f"CAST({m} AS DOUBLE) AS {m}" for m in MILESTONES) + """ FROM features WHERE year = (SELECT max(year) FROM features))
SELECT team_name, pw AS wins_value,
  COALESCE(CASE WHEN wins % 2 = 0 THEN pw - 19.6 END, pw - 5) AS ci_lower,
  COALESCE(CASE WHEN wins % 2 = 0 THEN pw + 19.6 END, pw + 5) AS ci_upper, 0.95::DOUBLE AS ci_level,
  prob AS dw_probability, CAST(prob > 0.5 AS INTEGER) AS dw_prediction,
  COALESCE(CASE WHEN prob > 0.5 THEN CASE WHEN abs(prob - 0.5) * 2 >= 0.7 THEN 'high'
    WHEN abs(prob - 0.5) * 2 >= 0.4 THEN 'medium' ELSE 'low' END END, 'Medium') AS dw_confidence, """ + \
    ", ".join(MILESTONES) + " FROM p"
SQL["IO9_competition_export"] = PRED + f"""
SELECT row_number() OVER (ORDER BY team_name, year) - 1 AS Id, team_name, year,
  {_r('predicted_wins', 1)} AS predicted_wins, {_r('division_winner_probability', 4)} AS division_winner_probability
FROM pred"""
SQL["IO12_engineered_export"] = P_FEAT + "\nSELECT * FROM features"

SQL["IO6_all_sheets"] = PRED + """
SELECT 'predictions' AS sheet, count(*) AS n_rows,
  'division_winner_prediction,division_winner_probability,predicted_wins,team_name,year' AS column_names FROM pred
UNION ALL SELECT 'summary', 1, 'mean,n,n_ge_100,n_ge_90,n_gt_81,n_lt_81,n_winners,std'
UNION ALL SELECT 'top10', least(10, count(*)), 'division_winner_prediction,division_winner_probability,predicted_wins,team_name,year' FROM pred"""
