"""Oracle SQL for DQ1-DQ13."""

from oracle.catalog_sql import P_FEAT, P_RAW, SQL

RAW_COLS = ["team_name", "year", "wins", "losses", "winning_percentage", "games_behind",
            "wild_card_games_behind", "runs_scored", "runs_allowed", "run_differential", "record_at_home",
            "record_when_away", "record_against_top_50_percent", "record_in_the_last_10_games",
            "current_streak", "expected_win_loss_record"]
NUMERIC = ["year", "wins", "losses", "winning_percentage", "runs_scored", "runs_allowed", "run_differential"]

SQL["DQ1_validate"] = P_RAW + """,
a AS (
  SELECT count(*) AS n_rows, count(*) - count(DISTINCT (team_name, year)) AS n_duplicate_keys,
    min(year) AS min_period, max(year) AS max_period,
    CAST(count_if(wins + losses < 100 OR wins + losses > 165) AS BIGINT) AS n_unusual_totals,
    CAST(count_if(team_name IS NULL) + count_if(year IS NULL) + count_if(wins IS NULL)
         + count_if(losses IS NULL) AS BIGINT) AS n_null_critical
  FROM raw
),
m AS (
  SELECT *, list_filter([
    CASE WHEN n_rows < 1 THEN 'Too few rows: ' || CAST(n_rows AS VARCHAR) END,
    CASE WHEN n_duplicate_keys > 0 THEN 'Found ' || CAST(n_duplicate_keys AS VARCHAR) || ' duplicate key combinations' END,
    CASE WHEN min_period < 1901 THEN 'Data contains periods before 1901' END,
    CASE WHEN max_period > 2025 THEN 'Data contains periods after 2025' END,
    CASE WHEN n_null_critical > 0 THEN 'Critical columns have ' || CAST(n_null_critical AS VARCHAR) || ' missing values' END
  ], lambda x: x IS NOT NULL) AS iss FROM a
)
SELECT n_rows, n_duplicate_keys, min_period, max_period, n_unusual_totals, n_null_critical,
  CAST(len(iss) AS INTEGER) AS n_issues, array_to_string(iss, '; ') AS issues,
  CAST(len(iss) = 0 AS INTEGER) AS is_valid
FROM m"""

_dq2 = []
for c in NUMERIC + ["games_behind", "wild_card_games_behind"]:
    if c in NUMERIC:
        _dq2.append(f"SELECT '{c}' AS column_name, 1 AS is_numeric, CAST(0 AS BIGINT) AS n_unparseable")
    else:
        _dq2.append(f"SELECT '{c}' AS column_name, 0 AS is_numeric, "
                    f"CAST(count_if({c} IS NOT NULL AND TRY_CAST({c} AS DOUBLE) IS NULL) AS BIGINT) AS n_unparseable "
                    f"FROM raw")
SQL["DQ2_numeric_check"] = P_RAW + "\n" + "\nUNION ALL\n".join(_dq2)

SQL["DQ3_duplicate_keys"] = """
SELECT count(*) AS n_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS n_distinct_keys,
  count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS n_duplicate_keys
FROM lineitem"""

SQL["DQ4_period_range"] = P_RAW + """
SELECT min(year) AS min_period, max(year) AS max_period,
  CAST(count_if(year < 1901) AS BIGINT) AS n_before, CAST(count_if(year > 1998) AS BIGINT) AS n_after
FROM raw"""

SQL["DQ5_unusual_totals"] = P_RAW + """
SELECT CAST(count_if(wins + losses < 80 OR wins + losses > 100) AS BIGINT) AS n_unusual, count(*) AS n_rows
FROM raw"""

SQL["DQ6_null_counts"] = P_RAW + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS n_null FROM raw" for c in RAW_COLS)

SQL["DQ8_data_info"] = P_RAW + f"""
SELECT count(*) AS n_rows, {len(RAW_COLS)} AS n_columns, min(year) AS min_period, max(year) AS max_period,
  count(DISTINCT team_name) AS n_entities,
  CAST({' + '.join(f'count_if({c} IS NULL)' for c in RAW_COLS)} AS BIGINT) AS n_missing_total, '{','.join(RAW_COLS)}' AS column_names,
  concat_ws(',', {', '.join(f"'{c}:' || count_if({c} IS NULL)" for c in RAW_COLS)}) AS missing_by_column
FROM raw"""

SQL["DQ9_quality_profile"] = P_RAW + "\n" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column_name, any_value(CASE typeof({c}) WHEN 'INTEGER' THEN 'int' ELSE lower(typeof({c})) END) AS dtype, avg(CAST({c} AS DOUBLE)) AS mean, stddev_samp(CAST({c} AS DOUBLE)) AS std,
  min(CAST({c} AS DOUBLE)) AS min, max(CAST({c} AS DOUBLE)) AS max,
  CAST(count_if({c} = 0) AS BIGINT) AS n_zero, CAST(count_if({c} < 0) AS BIGINT) AS n_negative,
  CAST(count_if({c} IS NULL) AS BIGINT) AS n_missing, count_if({c} IS NULL) * 100.0 / count(*) AS pct_missing
FROM raw""" for c in NUMERIC)

SQL["DQ9_duplicate_rows"] = """
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_distinct_rows, CAST(sum(n) - count(*) AS BIGINT) AS n_duplicate_rows
FROM (SELECT l_orderkey, l_linenumber, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL)"""

SQL["DQ11_validate_input"] = P_RAW + """,
e AS (
  SELECT team_name, year, list_filter([
    CASE WHEN team_name IS NULL THEN 'missing team_name' END,
    CASE WHEN wins IS NULL THEN 'missing wins' END,
    CASE WHEN losses IS NULL THEN 'missing losses' END,
    CASE WHEN runs_scored IS NULL THEN 'missing runs_scored' END,
    CASE WHEN wins + losses > 100 THEN 'too many games' END], lambda x: x IS NOT NULL) AS errs
  FROM raw
)
SELECT team_name, year, CAST(len(errs) AS INTEGER) AS n_errors, array_to_string(errs, '; ') AS errors,
  CAST(len(errs) = 0 AS INTEGER) AS is_valid
FROM e"""

SQL["DQ12_missing_profile"] = P_FEAT + """,
cnt AS (SELECT count(*) - count(COLUMNS(*)) FROM features),
long AS (UNPIVOT cnt ON COLUMNS(*) INTO NAME column_name VALUE n_missing)
SELECT column_name, n_missing, n_missing * 100.0 / (SELECT count(*) FROM features) AS pct_missing
FROM long WHERE n_missing > 0"""


def _dq13() -> str:
    from oracle.catalog_sql import _describe_con
    cols = _describe_con().execute(f"DESCRIBE ({P_FEAT} SELECT * FROM features)").fetchall()
    dbl = [r[0] for r in cols if r[1] == "DOUBLE"]
    inf = " + ".join(f"COALESCE(count_if(isnan({c}) OR isinf({c})), 0)" for c in dbl) or "0"
    ratios = ["home_win_pct", "away_win_pct", "win_pct_vs_top_teams", "pythagorean_win_pct",
              "wins_percentile", "run_diff_percentile", "last_10_pct", "winning_percentage"]
    bad = " + ".join(f"COALESCE(count_if({c} < 0 OR {c} > 1), 0)" for c in ratios)
    return P_FEAT + f"\nSELECT CAST({inf} AS BIGINT) AS n_non_finite, CAST({bad} AS BIGINT) AS n_ratio_out_of_range FROM features"


try:
    SQL["DQ13_feature_validity"] = _dq13()
except Exception:  # noqa: BLE001
    pass
