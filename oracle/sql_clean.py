"""Oracle SQL for CL1-CL22 (and JN3)."""

from oracle.catalog_sql import P_CLEAN, P_FEAT, P_RAW, SQL
from oracle.panel_sql import _case_era
from pennant.config import DISPLAY_ERA_STARTS, SYNTHETIC as CFG

STR = ["team_name", "games_behind", "wild_card_games_behind", "record_at_home", "record_when_away",
       "record_against_top_50_percent", "record_in_the_last_10_games", "current_streak",
       "expected_win_loss_record"]
RAW_COLS = ["team_name", "year", "wins", "losses", "winning_percentage", "games_behind",
            "wild_card_games_behind", "runs_scored", "runs_allowed", "run_differential", "record_at_home",
            "record_when_away", "record_against_top_50_percent", "record_in_the_last_10_games",
            "current_streak", "expected_win_loss_record"]
STRIP = ", ".join(f"NULLIF(TRIM({c}), '') AS {c}" if c in STR else c for c in RAW_COLS)
RENAME = ("CASE WHEN team_name IN ('California Angels', 'Anaheim Angels') THEN 'Los Angeles Angels' "
          "WHEN team_name = 'Florida Marlins' THEN 'Miami Marlins' "
          "WHEN team_name = 'Montreal Expos' THEN 'Washington Nationals' ELSE team_name END")


def _closed_era(ranges) -> str:
    return "CASE " + " ".join(f"WHEN year BETWEEN {lo} AND {hi} THEN '{n}'" for n, lo, hi in ranges) + \
        " ELSE 'unknown' END"


SQL["CL1_drop_duplicates"] = P_RAW + "\nSELECT DISTINCT * FROM raw"
SQL["CL2_strip_strings"] = P_RAW + f"\nSELECT {STRIP} FROM raw"
SQL["CL3_rename_values"] = P_RAW + f"\nSELECT {RENAME} AS team_name, year FROM raw"
SQL["CL4_normalize_names"] = P_RAW + """,
alias AS (SELECT 'Old Team ' || CAST(s_suppkey AS VARCHAR) AS historical,
                 'Team ' || CAST(s_suppkey AS VARCHAR) AS current
          FROM supplier WHERE s_suppkey % 7 = 3)
SELECT COALESCE(a.current, r.team_name) AS team_name, r.year
FROM raw r LEFT JOIN alias a ON r.team_name = a.historical"""
SQL["CL5_fill_defaults"] = P_RAW + f""",
s AS (SELECT {STRIP} FROM raw)
SELECT team_name, year, COALESCE(record_in_the_last_10_games, '5-5') AS record_in_the_last_10_games,
  COALESCE(current_streak, 'W0') AS current_streak FROM s"""
SQL["CL6_coerce_types"] = P_RAW + f""",
s AS (SELECT {STRIP} FROM raw)
SELECT team_name, TRY_CAST(year AS INTEGER) AS year, TRY_CAST(winning_percentage AS DOUBLE) AS winning_percentage,
  TRY_CAST(games_behind AS DOUBLE) AS games_behind,
  TRY_CAST(wild_card_games_behind AS DOUBLE) AS wild_card_games_behind FROM s"""
SQL["CL7_parse_records"] = P_CLEAN + """
SELECT team_name, year, at_home_wins, at_home_losses, when_away_wins, when_away_losses,
  against_top_50_percent_wins, against_top_50_percent_losses, expected_win_loss_record_wins,
  expected_win_loss_record_losses FROM clean"""
SQL["CL8_parse_last_10"] = P_CLEAN + "\nSELECT team_name, year, last_10_wins, last_10_losses, last_10_pct FROM clean"
SQL["CL9_parse_streak"] = P_CLEAN + "\nSELECT team_name, year, streak_type, streak_length, on_winning_streak FROM clean"
SQL["CL10_filter_period_range"] = P_CLEAN + "\nSELECT team_name, year, wins FROM clean WHERE year BETWEEN 1996 AND 1999"
SQL["CL11_era_strategy_filter"] = P_CLEAN + (
    f"\nSELECT team_name, year FROM clean WHERE year BETWEEN {CFG.modern_strategy_years[0]} "
    f"AND {CFG.modern_strategy_years[1]}")
SQL["CL12_era_splits"] = P_CLEAN + f""",
e AS (SELECT {_closed_era(CFG.era_ranges)} AS era FROM clean)
SELECT era, count(*) AS n_rows FROM e WHERE era <> 'unknown' GROUP BY era"""
SQL["CL12_era_split_files"] = P_CLEAN + f""",
e AS (SELECT team_name, year, wins, {_closed_era(CFG.era_ranges)} AS era FROM clean)
SELECT * FROM e WHERE era <> 'unknown'"""
SQL["CL13_era_closed_ranges"] = P_CLEAN + f"\nSELECT team_name, year, {_closed_era(CFG.era_ranges)} AS era FROM clean"
SQL["JN3_era_range_join"] = P_CLEAN + f""",
dim AS (SELECT * FROM (VALUES {', '.join(f"('{n}', {lo}, {hi})" for n, lo, hi in CFG.era_ranges)}) t(era, lo, hi))
SELECT c.team_name, c.year, COALESCE(d.era, 'unknown') AS era
FROM clean c LEFT JOIN dim d ON c.year >= d.lo AND c.year <= d.hi"""
SQL["CL14_era_open_ended"] = P_CLEAN + f"\nSELECT team_name, year, {_case_era(CFG, 'year')} AS era FROM clean"
SQL["CL15_era_display"] = P_CLEAN + (
    f"\nSELECT team_name, year, {_case_era(CFG.with_(era_starts=DISPLAY_ERA_STARTS), 'year')} AS era FROM clean")
SQL["CL17_membership_filter"] = P_CLEAN + (
    "\nSELECT team_name, year, wins FROM clean WHERE team_name IN ("
    + ", ".join(f"'Team {i}'" for i in range(1, 10)) + ")")
SQL["CL18_drop_incomplete"] = P_CLEAN + (
    "\nSELECT team_name, year FROM clean WHERE at_home_wins IS NOT NULL AND wins IS NOT NULL")
SQL["CL19_display_projection"] = P_FEAT + """
SELECT team_name AS team, year AS season, wins, ROUND(winning_percentage, 3) AS win_pct,
  CAST(ROUND(pythagorean_win_pct * 100, 1) AS VARCHAR) || '%' AS pythag_pct_text FROM features"""
SQL["CL21_calculated_fields"] = P_CLEAN + """
SELECT team_name, year, CAST(wins AS DOUBLE) / NULLIF(CAST(wins + losses AS DOUBLE), 0) AS winning_percentage,
  runs_scored - runs_allowed AS run_differential FROM clean"""
SQL["CL22_standard_scale"] = P_CLEAN + """
SELECT team_name, year,
  (wins - avg(wins) OVER ()) / NULLIF(stddev_pop(wins) OVER (), 0) AS wins_scaled,
  (runs_scored - avg(runs_scored) OVER ()) / NULLIF(stddev_pop(runs_scored) OVER (), 0) AS runs_scored_scaled,
  (runs_allowed - avg(runs_allowed) OVER ()) / NULLIF(stddev_pop(runs_allowed) OVER (), 0) AS runs_allowed_scaled
FROM clean"""
