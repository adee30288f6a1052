"""DuckDB oracle SQL for the panel pipeline (raw -> clean -> features).

Independent formulation of the same semantics in plain SQL windows; used
only to check the Spark operators.  Every builder returns CTE text that
later queries chain with ``WITH``.
"""

from __future__ import annotations

from pennant.config import SYNTHETIC, PanelConfig

RAW = """
raw_counts AS (
  SELECT l_suppkey AS team_id, CAST(year(l_shipdate) AS INTEGER) AS year,
    CAST(count_if(l_returnflag <> 'R') AS INTEGER) AS wins,
    CAST(count_if(l_returnflag = 'R') AS INTEGER) AS losses,
    CAST(SUM(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0.0 END) AS INTEGER) AS runs_scored,
    CAST(SUM(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0.0 END) AS INTEGER) AS runs_allowed,
    CAST(count_if(l_returnflag <> 'R' AND l_linenumber % 2 = 1) AS INTEGER) AS hw,
    CAST(count_if(l_returnflag = 'R' AND l_linenumber % 2 = 1) AS INTEGER) AS hl,
    CAST(count_if(l_returnflag <> 'R' AND NOT (l_linenumber % 2 = 1)) AS INTEGER) AS aw,
    CAST(count_if(l_returnflag = 'R' AND NOT (l_linenumber % 2 = 1)) AS INTEGER) AS al,
    CAST(count_if(l_returnflag <> 'R' AND l_discount >= 0.05) AS INTEGER) AS tw,
    CAST(count_if(l_returnflag = 'R' AND l_discount >= 0.05) AS INTEGER) AS tl
  FROM lineitem GROUP BY 1, 2
),
raw_p AS (
  SELECT r.*, s.s_nationkey AS division_id, r.wins - r.losses AS wl
  FROM raw_counts r LEFT JOIN supplier s ON r.team_id = s.s_suppkey
),
raw_lead AS (
  SELECT p.*, MAX(wl) OVER (PARTITION BY year, division_id) AS div_lead,
         MAX(wl) OVER (PARTITION BY year) AS season_lead
  FROM raw_p p
),
raw AS (
  SELECT
    CASE WHEN year <= 1996 AND team_id % 7 = 3 THEN 'Old Team ' || CAST(team_id AS VARCHAR)
         ELSE 'Team ' || CAST(team_id AS VARCHAR) END AS team_name,
    year, wins, losses,
    ROUND(wins / (wins + losses), 3) AS winning_percentage,
    CASE WHEN div_lead - wl = 0 THEN '-' ELSE CAST((div_lead - wl) // 2 AS VARCHAR)
         || CASE WHEN (div_lead - wl) % 2 = 1 THEN '.5' ELSE '' END END AS games_behind,
    CASE WHEN season_lead - wl = 0 THEN '-' ELSE CAST((season_lead - wl) // 2 AS VARCHAR)
         || CASE WHEN (season_lead - wl) % 2 = 1 THEN '.5' ELSE '' END END AS wild_card_games_behind,
    runs_scored, runs_allowed, runs_scored - runs_allowed AS run_differential,
    CASE WHEN (team_id * year) % 29 = 0 THEN '' ELSE CAST(hw AS VARCHAR) || '-' || CAST(hl AS VARCHAR) END
      AS record_at_home,
    CAST(aw AS VARCHAR) || '-' || CAST(al AS VARCHAR) AS record_when_away,
    CAST(tw AS VARCHAR) || '-' || CAST(tl AS VARCHAR) AS record_against_top_50_percent,
    CASE WHEN (team_id + year) % 13 = 0 THEN NULL
         ELSE CAST(wins % 11 AS VARCHAR) || '-' || CAST(10 - wins % 11 AS VARCHAR) END
      AS record_in_the_last_10_games,
    CASE WHEN runs_scored % 17 = 0 THEN NULL WHEN runs_scored % 17 = 1 THEN ' '
         ELSE (CASE WHEN hw >= aw THEN 'W' ELSE 'L' END) || CAST(wins % 9 AS VARCHAR) END AS current_streak,
    CAST(CAST((CAST(wins + losses AS BIGINT) * runs_scored * runs_scored)
              // (CAST(runs_scored AS BIGINT) * runs_scored + CAST(runs_allowed AS BIGINT) * runs_allowed)
         AS INTEGER) AS VARCHAR) || '-' ||
    CAST(wins + losses - CAST((CAST(wins + losses AS BIGINT) * runs_scored * runs_scored)
              // (CAST(runs_scored AS BIGINT) * runs_scored + CAST(runs_allowed AS BIGINT) * runs_allowed)
         AS INTEGER) AS VARCHAR) AS expected_win_loss_record
  FROM raw_lead
)"""

# Clean: dedupe, trim/nullif, fills, casts, parses.
CLEAN = r"""
c_dedup AS (SELECT DISTINCT * FROM raw),
c_trim AS (
  SELECT
    CASE WHEN NULLIF(TRIM(team_name), '') IN ('California Angels', 'Anaheim Angels') THEN 'Los Angeles Angels'
         WHEN NULLIF(TRIM(team_name), '') = 'Florida Marlins' THEN 'Miami Marlins'
         WHEN NULLIF(TRIM(team_name), '') = 'Montreal Expos' THEN 'Washington Nationals'
         ELSE NULLIF(TRIM(team_name), '') END AS team_name,
    year, wins, losses, winning_percentage,
    NULLIF(TRIM(games_behind), '') AS games_behind,
    NULLIF(TRIM(wild_card_games_behind), '') AS wild_card_games_behind,
    runs_scored, runs_allowed, run_differential,
    NULLIF(TRIM(record_at_home), '') AS record_at_home,
    NULLIF(TRIM(record_when_away), '') AS record_when_away,
    NULLIF(TRIM(record_against_top_50_percent), '') AS record_against_top_50_percent,
    COALESCE(NULLIF(TRIM(record_in_the_last_10_games), ''), '5-5') AS record_in_the_last_10_games,
    COALESCE(NULLIF(TRIM(current_streak), ''), 'W0') AS current_streak,
    NULLIF(TRIM(expected_win_loss_record), '') AS expected_win_loss_record
  FROM c_dedup
),
clean AS (
  SELECT team_name,
    TRY_CAST(year AS INTEGER) AS year, TRY_CAST(wins AS INTEGER) AS wins,
    TRY_CAST(losses AS INTEGER) AS losses,
    TRY_CAST(winning_percentage AS DOUBLE) AS winning_percentage,
    TRY_CAST(games_behind AS DOUBLE) AS games_behind,
    TRY_CAST(wild_card_games_behind AS DOUBLE) AS wild_card_games_behind,
    TRY_CAST(runs_scored AS INTEGER) AS runs_scored, TRY_CAST(runs_allowed AS INTEGER) AS runs_allowed,
    TRY_CAST(run_differential AS INTEGER) AS run_differential,
    record_at_home, record_when_away, record_against_top_50_percent, record_in_the_last_10_games,
    current_streak, expected_win_loss_record,
    TRY_CAST(regexp_extract(record_at_home, '^(\d+)-(\d+)', 1) AS INTEGER) AS at_home_wins,
    TRY_CAST(regexp_extract(record_at_home, '^(\d+)-(\d+)', 2) AS INTEGER) AS at_home_losses,
    TRY_CAST(regexp_extract(record_when_away, '^(\d+)-(\d+)', 1) AS INTEGER) AS when_away_wins,
    TRY_CAST(regexp_extract(record_when_away, '^(\d+)-(\d+)', 2) AS INTEGER) AS when_away_losses,
    TRY_CAST(regexp_extract(record_against_top_50_percent, '^(\d+)-(\d+)', 1) AS INTEGER)
      AS against_top_50_percent_wins,
    TRY_CAST(regexp_extract(record_against_top_50_percent, '^(\d+)-(\d+)', 2) AS INTEGER)
      AS against_top_50_percent_losses,
    TRY_CAST(regexp_extract(expected_win_loss_record, '^(\d+)-(\d+)', 1) AS INTEGER)
      AS expected_win_loss_record_wins,
    TRY_CAST(regexp_extract(expected_win_loss_record, '^(\d+)-(\d+)', 2) AS INTEGER)
      AS expected_win_loss_record_losses,
    COALESCE(TRY_CAST(regexp_extract(record_in_the_last_10_games, '^(\d+)-(\d+)', 1) AS INTEGER), 5)
      AS last_10_wins,
    COALESCE(TRY_CAST(regexp_extract(record_in_the_last_10_games, '^(\d+)-(\d+)', 2) AS INTEGER), 5)
      AS last_10_losses,
    CAST(COALESCE(TRY_CAST(regexp_extract(record_in_the_last_10_games, '^(\d+)-(\d+)', 1) AS INTEGER), 5) AS DOUBLE) / 10
      AS last_10_pct,
    CASE WHEN TRIM(current_streak) = '' THEN 'W' ELSE substring(TRIM(current_streak), 1, 1) END
      AS streak_type,
    CASE WHEN TRIM(current_streak) = '' THEN 0
         ELSE COALESCE(TRY_CAST(substring(TRIM(current_streak), 2) AS INTEGER), 0) END AS streak_length,
    CAST(CASE WHEN TRIM(current_streak) = '' THEN 'W' ELSE substring(TRIM(current_streak), 1, 1) END = 'W'
         AS INTEGER) AS on_winning_streak
  FROM c_trim
)"""


def _case_era(cfg: PanelConfig, col: str = "year") -> str:
    parts = []
    for name, start in reversed(cfg.era_starts):
        if start is not None:
            parts.append(f"WHEN {col} >= {start} THEN '{name}'")
    return f"CASE {' '.join(parts)} ELSE '{cfg.era_starts[0][0]}' END"


def _case_spots(cfg: PanelConfig, col: str = "year") -> str:
    parts = []
    for start, spots in reversed(cfg.playoff_steps):
        if start is not None:
            parts.append(f"WHEN {col} >= {start} THEN {spots}")
    return f"CASE {' '.join(parts)} ELSE {cfg.playoff_steps[0][1]} END"


def _case_elite(cfg: PanelConfig) -> str:
    parts = [f"WHEN era = '{e}' THEN {t}" for e, t in cfg.era_elite_wins.items()]
    return f"CASE {' '.join(parts)} ELSE {cfg.era_elite_default} END"


def _div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def _pct(part: str, col: str, out: str) -> str:
    """pandas rank(pct=True) within ``part`` (NULL-aware average rank)."""
    return (f"CASE WHEN {col} IS NULL THEN NULL ELSE "
            f"(CAST(rank() OVER (PARTITION BY {part}, {col} IS NULL ORDER BY {col}) AS DOUBLE) "
            f"+ (count(*) OVER (PARTITION BY {part}, {col}) - 1) / 2.0) "
            f"/ count({col}) OVER (PARTITION BY {part}) END AS {out}")


def features_cte(cfg: PanelConfig = SYNTHETIC) -> str:
    """CTEs f_row, f_grp, f_hist, features (final table)."""
    ent, per = cfg.entity, cfg.period
    W = f"PARTITION BY {ent} ORDER BY {per}"
    milestones = ",\n    ".join(f"CAST(COALESCE(wins >= {t}, false) AS INTEGER) AS achieved_{t}_wins"
                                  for t in cfg.win_milestones)
    zs = ",\n    ".join(
        f"({c} - AVG({c}) OVER (PARTITION BY era)) / NULLIF(STDDEV_SAMP({c}) OVER (PARTITION BY era), 0)"
        f" AS {c}_era_zscore" for c in cfg.era_columns)
    eps = ",\n    ".join(_pct("era", c, f"{c}_era_percentile") for c in cfg.era_columns)
    prev = ",\n    ".join(f"LAG({c}) OVER ({W}) AS prev_{c}" for c in cfg.prev_columns)
    roll = ",\n    ".join(f"AVG({c}) OVER ({W} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING) AS {c}_{k}yr_avg"
                          for k in cfg.rolling_windows for c in cfg.rolling_columns)
    pos = ",\n    ".join(f"COUNT({c}) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pos_{c}"
                         for c in cfg.trend_columns)
    k = cfg.trend_window
    trend = ",\n    ".join(
        f"CASE WHEN COUNT({c}) OVER ({W} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING) >= 2 THEN "
        f"REGR_SLOPE(CAST({c} AS DOUBLE), CAST(pos_{c} AS DOUBLE)) OVER ({W} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)"
        f" END AS {c}_trend" for c in cfg.trend_columns)
    change = ",\n    ".join(f"{c} - prev_{c} AS {c}_change" for c in cfg.change_columns)
    return f"""
f_row AS (
  SELECT *, {_case_era(cfg, per)} AS era,
    wins + losses AS total_games,
    at_home_wins + at_home_losses AS home_games,
    COALESCE({_div('at_home_wins', 'at_home_wins + at_home_losses')}, 0.5) AS home_win_pct,
    when_away_wins + when_away_losses AS away_games,
    COALESCE({_div('when_away_wins', 'when_away_wins + when_away_losses')}, 0.5) AS away_win_pct,
    COALESCE({_div('against_top_50_percent_wins', 'against_top_50_percent_wins + against_top_50_percent_losses')}, 0.5)
      AS win_pct_vs_top_teams,
    {_div('runs_scored', 'wins + losses')} AS runs_per_game,
    {_div('runs_allowed', 'wins + losses')} AS runs_allowed_per_game,
    COALESCE({_div('runs_scored', 'runs_allowed')}, 1.0) AS run_efficiency,
    1.0 / NULLIF(1 + ABS({_div('run_differential', 'wins + losses')}), 0) AS close_game_factor,
    {_div('(wins + losses) * POW(CAST(runs_scored AS DOUBLE), 2)',
          'POW(CAST(runs_scored AS DOUBLE), 2) + POW(CAST(runs_allowed AS DOUBLE), 2)')} AS pythagorean_wins,
    last_10_pct - winning_percentage AS momentum,
    CAST(COALESCE(last_10_pct >= 0.7, false) AS INTEGER) AS hot_team,
    CAST(COALESCE(last_10_pct <= 0.3, false) AS INTEGER) AS cold_team,
    streak_length * (2 * on_winning_streak - 1) AS streak_score,
    CAST(COALESCE(on_winning_streak = 1 AND streak_length >= 5, false) AS INTEGER) AS long_winning_streak,
    CAST(games_behind IS NULL AS INTEGER) AS is_division_winner,
    {_case_spots(cfg, per)} AS playoff_spots,
    {milestones},
    CAST(COALESCE(runs_scored >= {cfg.runs_scored_milestone}, false) AS INTEGER) AS scored_{cfg.runs_scored_milestone}_runs,
    CAST(COALESCE(runs_allowed < {cfg.runs_allowed_milestone}, false) AS INTEGER) AS allowed_under_{cfg.runs_allowed_milestone}_runs,
    CAST(COALESCE(wins < {cfg.terrible_wins}, false) AS INTEGER) AS terrible_season,
    CAST(COALESCE(wins >= {cfg.historic_wins}, false) AS INTEGER) AS historic_season
  FROM clean
),
f_row2 AS (
  SELECT *, home_win_pct - away_win_pct AS home_away_diff,
    {_div('pythagorean_wins', 'total_games')} AS pythagorean_win_pct,
    wins - pythagorean_wins AS luck_factor,
    {_div('wins - pythagorean_wins', 'total_games')} AS performance_above_talent
  FROM f_row
),
f_grp AS (
  SELECT *, winning_percentage - pythagorean_win_pct AS luck_pct,
    {_div('runs_per_game', f'AVG(runs_per_game) OVER (PARTITION BY {per})')} AS offensive_rating,
    {_div(f'AVG(runs_allowed_per_game) OVER (PARTITION BY {per})', 'runs_allowed_per_game')} AS defensive_rating,
    {_div(f'AVG(wins) OVER (PARTITION BY {per})', 'total_games')} AS league_strength,
    STDDEV_SAMP(wins) OVER (PARTITION BY {per}) AS competitive_balance,
    {_div(f'STDDEV_SAMP(wins) OVER (PARTITION BY {per})', 'total_games')} AS normalized_competitive_balance,
    AVG(runs_per_game) OVER (PARTITION BY era, {per}) AS era_run_environment,
    {zs},
    {_pct(per, 'wins', 'wins_percentile')},
    {_pct(per, 'run_differential', 'run_diff_percentile')},
    {eps},
    CASE WHEN wins IS NULL THEN 0 ELSE CAST(row_number() OVER (PARTITION BY {per}, wins IS NULL
         ORDER BY wins DESC, {ent}) <= playoff_spots AS INTEGER) END AS made_playoffs
  FROM f_row2
),
f_grp2 AS (
  SELECT *, {_div('winning_percentage', 'league_strength')} AS relative_strength,
    CAST(COALESCE(wins_percentile >= 0.9, false) AS INTEGER) AS elite_team,
    CAST(COALESCE(winning_percentage > 0.5, false) AS INTEGER) AS above_average_team,
    CAST(COALESCE(wins >= {_case_elite(cfg)}, false) AS INTEGER) AS era_adjusted_elite_wins,
    {_div('runs_per_game', 'era_run_environment')} AS offense_vs_era,
    {_div('era_run_environment', 'runs_allowed_per_game')} AS defense_vs_era,
    wins_era_percentile * 0.4 + run_differential_era_percentile * 0.3
      + winning_percentage_era_percentile * 0.3 AS historical_dominance,
    {_div('run_differential', 'total_games')} AS run_diff_per_game
  FROM f_grp
),
f_hist AS (
  SELECT *, {prev},
    {roll},
    {pos},
    CASE WHEN COUNT(winning_percentage) OVER ({W} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) >= 3
         THEN STDDEV_SAMP(winning_percentage) OVER ({W} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)
    END AS performance_volatility,
    LEAD(made_playoffs) OVER ({W}) AS next_year_playoffs,
    LEAD(wins) OVER ({W}) AS next_year_wins,
    1.0 / NULLIF(1 + STDDEV_SAMP(run_diff_per_game) OVER ({W} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 0)
      AS run_diff_consistency
  FROM f_grp2
),
features AS (
  SELECT * EXCLUDE ({', '.join('pos_' + c for c in cfg.trend_columns)}),
    {change},
    {trend},
    1.0 / NULLIF(1 + performance_volatility, 0) AS consistency_score,
    1 - ABS(home_away_diff) AS location_consistency,
    1 - ABS(luck_pct) AS performance_reliability
  FROM f_hist
)"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts)


def panel_prefix(cfg: PanelConfig = SYNTHETIC, features: bool = True) -> str:
    """WITH raw, clean[, features] — callers append ``, x AS (...) SELECT ...`` or a SELECT."""
    parts = [RAW, CLEAN]
    if features:
        parts.append(features_cte(cfg))
    return with_ctes(*parts)
