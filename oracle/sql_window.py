"""Oracle SQL for WN1-WN26."""

from oracle.catalog_sql import P_CLEAN, P_FEAT, SQL
from oracle.sql_scalar import SCORED
from pennant.config import SYNTHETIC as CFG

BLOCKS = {
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
for k, cols in BLOCKS.items():
    SQL[k] = P_FEAT + f"\nSELECT team_name, year, {', '.join(cols)} FROM features"

W = "PARTITION BY team_name ORDER BY year"

SQL["WN16_division_rank"] = SCORED + """,
dims AS (SELECT 'Team ' || CAST(s.s_suppkey AS VARCHAR) AS team_name, n.n_name AS division
         FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey),
j AS (SELECT s.*, d.division FROM scored s LEFT JOIN dims d ON s.team_name = d.team_name)
SELECT team_name, year, division,
  CASE WHEN division_winner_probability IS NULL THEN NULL ELSE
  rank() OVER (PARTITION BY year, division, division_winner_probability IS NULL
               ORDER BY division_winner_probability DESC) END AS division_rank
FROM j"""

SQL["WN17_rank_comparison"] = SCORED + """,
r AS (SELECT team_name, year,
  rank() OVER (PARTITION BY year ORDER BY wins DESC) + (count(*) OVER (PARTITION BY year, wins) - 1) / 2.0 AS actual_rank,
  rank() OVER (PARTITION BY year ORDER BY predicted_wins DESC)
    + (count(*) OVER (PARTITION BY year, predicted_wins) - 1) / 2.0 AS predicted_rank
  FROM scored)
SELECT *, actual_rank - predicted_rank AS rank_difference FROM r"""

SQL["WN18_centered_mean"] = P_CLEAN + f"""
SELECT team_name, year, CASE WHEN count(wins) OVER ({W} ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) = 5
  THEN avg(wins) OVER ({W} ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) END AS wins_cma5 FROM clean"""


def _frame(width):
    lo, hi = width // 2, ((width - 1) // 2 if width % 2 == 0 else width // 2)
    return f"ROWS BETWEEN {lo} PRECEDING AND {hi} FOLLOWING"


_trend = " ".join(
    f"WHEN LEAST(5, FLOOR(n / 2)) = {w} THEN CASE WHEN count(wins) OVER ({W} {_frame(w)}) = {w} "
    f"THEN avg(wins) OVER ({W} {_frame(w)}) END" for w in (1, 2, 3, 4, 5))
SQL["WN19_decompose"] = P_CLEAN + f""",
c AS (SELECT *, count(*) OVER (PARTITION BY team_name) AS n FROM clean),
t AS (SELECT team_name, year, wins, CASE {_trend} END AS trend FROM c)
SELECT team_name, year, trend, wins - trend AS residual FROM t"""

SQL["WN20_detrended"] = P_CLEAN + f"""
SELECT team_name, year, run_differential - CASE WHEN count(run_differential) OVER ({W} {_frame(5)}) = 5
  THEN avg(run_differential) OVER ({W} {_frame(5)}) END AS run_differential_detrended FROM clean"""

SQL["WN21_percentile_flag"] = P_CLEAN + """
SELECT team_name, year, CAST(wins >= quantile_cont(wins, 0.75) OVER (PARTITION BY year) AS INTEGER) AS playoff_proxy
FROM clean"""

SQL["WN22_trailing_mean"] = P_CLEAN + f"""
SELECT team_name, year,
  CASE WHEN count(wins) OVER ({W} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) = 3
       THEN avg(wins) OVER ({W} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) END AS wins_ma_3,
  CASE WHEN count(run_differential) OVER ({W} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) = 5
       THEN avg(run_differential) OVER ({W} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) END AS run_diff_ma_5
FROM clean"""

SQL["WN23_era_relative"] = P_FEAT + """
SELECT team_name, year, avg(wins) OVER (PARTITION BY era) AS era_mean_wins,
  CAST(wins AS DOUBLE) / NULLIF(avg(wins) OVER (PARTITION BY era), 0) AS era_relative_performance FROM features"""

SQL["WN24_lag_n"] = P_CLEAN + f"""
SELECT team_name, year, lag(wins, 1) OVER ({W}) AS prev_wins, lag(wins, 2) OVER ({W}) AS prev2_wins,
  lag(wins, 3) OVER ({W}) AS prev3_wins, lag(run_differential, 1) OVER ({W}) AS prev_run_differential,
  lag(run_differential, 2) OVER ({W}) AS prev2_run_differential,
  lag(run_differential, 3) OVER ({W}) AS prev3_run_differential FROM clean"""

SQL["WN25_min_max_normalize"] = P_CLEAN + "\nSELECT team_name, year, " + ", ".join(
    f"CAST({c} - min({c}) OVER () AS DOUBLE) / NULLIF(CAST(max({c}) OVER () - min({c}) OVER () AS DOUBLE), 0) AS {c}_norm"
    for c in ("wins", "runs_scored", "runs_allowed")) + " FROM clean"

SQL["WN26_exp_weighted_recent"] = P_CLEAN + """,
l AS (SELECT team_name, year, winning_percentage,
        row_number() OVER (PARTITION BY team_name ORDER BY year DESC) AS rn
      FROM clean WHERE winning_percentage IS NOT NULL),
k AS (SELECT *, count(*) OVER (PARTITION BY team_name) AS m FROM l WHERE rn <= 5),
w AS (SELECT *, exp(CASE WHEN m > 1 THEN -1.0 + CAST(m - rn AS DOUBLE) / (m - 1) ELSE -1.0 END) AS wt FROM k)
SELECT team_name, sum(wt * winning_percentage) / NULLIF(sum(wt), 0) AS ewm_recent, max(m) AS n_used
FROM w GROUP BY team_name"""
