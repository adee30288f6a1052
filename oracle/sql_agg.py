"""Oracle SQL for AG, TK, JN, ST and SP keys."""

import math
from statistics import NormalDist

from oracle.catalog_sql import P_CLEAN, P_FEAT, SQL
from oracle.sql_metrics import REG
from oracle.sql_scalar import SCORED
from pennant.config import SYNTHETIC as CFG

METRICS = ["wins", "losses", "runs_scored", "runs_allowed", "run_differential", "winning_percentage"]
MILESTONES = [f"achieved_{t}_wins" for t in CFG.win_milestones]
TARGETS = ["is_division_winner", "made_playoffs", *MILESTONES, "terrible_season", "historic_season"]
CORR_COLS = ["wins", "runs_scored", "runs_allowed", "run_differential", "winning_percentage",
             "pythagorean_win_pct", "prev_wins", "wins_3yr_avg"]
FEATS = ["pythagorean_win_pct", "run_diff_per_game", "prev_wins", "wins_3yr_avg", "home_win_pct",
         "win_pct_vs_top_teams", "momentum", "wins_trend"]
H = "('0x' || substr(md5(concat_ws('|', team_name, CAST(year AS VARCHAR), '42')), 1, 13))::BIGINT"

LEVELS = SCORED + """,
lv AS (SELECT *, CASE WHEN abs(division_winner_probability - 0.5) * 2 >= 0.7 THEN 'high'
          WHEN abs(division_winner_probability - 0.5) * 2 >= 0.4 THEN 'medium' ELSE 'low' END AS confidence_level,
        CAST(division_winner_probability > 0.5 AS INTEGER) AS division_winner_prediction FROM scored)"""

SQL["AG1_eda_summary"] = P_CLEAN + "\n" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS metric, avg(CAST({c} AS DOUBLE)) AS mean, stddev_samp(CAST({c} AS DOUBLE)) AS std,
  min(CAST({c} AS DOUBLE)) AS min, max(CAST({c} AS DOUBLE)) AS max, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1,
  quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM clean"""
    for c in METRICS)
SQL["AG2_season_summary"] = P_CLEAN + """
SELECT year, avg(wins) AS mean_wins, avg(run_differential) AS mean_run_diff, CAST(sum(runs_scored) AS BIGINT) AS total_runs,
  CAST(sum(runs_scored) AS DOUBLE) / NULLIF(sum(wins + losses), 0) AS runs_per_game FROM clean GROUP BY year"""
SQL["AG3_entity_era_summary"] = P_FEAT + """
SELECT team_name, era, avg(wins) AS mean_wins, max(wins) AS max_wins, count(wins) AS seasons,
  avg(winning_percentage) AS mean_win_pct FROM features GROUP BY team_name, era"""
SQL["AG4_entity_summary"] = P_CLEAN + f"""
SELECT team_name, count(*) AS seasons, avg(wins) AS mean_wins, max(wins) AS max_wins,
  CAST(count_if(wins >= {CFG.win_milestones[1]}) AS BIGINT) AS n_above_threshold FROM clean GROUP BY team_name"""
SQL["AG5_recent_summary"] = P_CLEAN + """,
l AS (SELECT team_name, year, wins, row_number() OVER (PARTITION BY team_name ORDER BY year DESC) AS rn FROM clean)
SELECT team_name, avg(wins) AS recent_mean_wins, first(year ORDER BY wins DESC, year ASC) AS best_season
FROM l WHERE rn <= 5 GROUP BY team_name"""
SQL["AG6_latest_period_stats"] = P_CLEAN + """
SELECT max(year) AS season, count(*) AS n_teams, avg(wins) AS mean_wins, max(wins) AS max_wins,
  first(team_name ORDER BY wins DESC, team_name ASC) AS best_team
FROM clean WHERE year = (SELECT max(year) FROM clean)"""
SQL["AG7_error_by_period"] = REG + """
SELECT year, CASE WHEN abs(avg(abs(yhat - y))) < 1e12 THEN floor(avg(abs(yhat - y)) * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE ELSE avg(abs(yhat - y)) END AS mae, CASE WHEN abs(stddev_samp(abs(yhat - y))) < 1e12 THEN floor(stddev_samp(abs(yhat - y)) * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE ELSE stddev_samp(abs(yhat - y)) END AS std_ae,
  CASE WHEN abs(avg(yhat - y)) < 1e12 THEN floor(avg(yhat - y) * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE ELSE avg(yhat - y) END AS mean_error, count(*) AS n FROM reg GROUP BY year"""
SQL["AG8_mae_by_entity_top"] = REG + """
SELECT team_name, avg(abs(yhat - y)) AS mae FROM reg GROUP BY team_name ORDER BY mae DESC, team_name LIMIT 15"""
SQL["AG9_accuracy_by_confidence"] = LEVELS + """
SELECT confidence_level, avg(CAST(is_division_winner = division_winner_prediction AS DOUBLE)) AS accuracy,
  count(*) AS n FROM lv GROUP BY confidence_level"""
SQL["AG11_target_summary"] = P_FEAT + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS target, avg(CAST({t} AS DOUBLE)) AS positive_rate, CAST(sum({t}) AS BIGINT) AS positives, "
    f"count({t}) AS total FROM features" for t in TARGETS)
SQL["AG12_value_counts"] = LEVELS + """,
a AS (SELECT is_division_winner AS cls, count(*) AS n_actual FROM lv GROUP BY 1),
p AS (SELECT division_winner_prediction AS cls, count(*) AS n_predicted FROM lv GROUP BY 1)
SELECT COALESCE(a.cls, p.cls) AS cls, COALESCE(n_actual, 0) AS n_actual, COALESCE(n_predicted, 0) AS n_predicted
FROM a FULL JOIN p ON a.cls = p.cls"""
SQL["AG12_confidence_counts"] = LEVELS + "\nSELECT confidence_level, count(*) AS n FROM lv GROUP BY 1"
SQL["AG13_prediction_summary"] = LEVELS + """
SELECT count(predicted_wins) AS n, avg(predicted_wins) AS mean, stddev_samp(predicted_wins) AS std,
  CAST(count_if(predicted_wins >= 90) AS BIGINT) AS n_ge_90, CAST(count_if(predicted_wins >= 100) AS BIGINT) AS n_ge_100,
  CAST(count_if(predicted_wins < 81) AS BIGINT) AS n_lt_81, CAST(count_if(predicted_wins > 81) AS BIGINT) AS n_gt_81,
  CAST(sum(division_winner_prediction) AS BIGINT) AS n_winners FROM lv"""


def _corr_matrix(cols, src="features", rank=False):
    body = "\nUNION ALL\n".join(f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) "
                                f"AS corr FROM {src}" for a in cols for b in cols)
    return body


SQL["AG14_correlation_matrix"] = P_FEAT + "\n" + _corr_matrix(CORR_COLS)
_sp = CORR_COLS[:5]
# ranks among the rows where both columns are there, pair by pair
SQL["AG14_spearman_matrix"] = P_FEAT + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr(ra, rb) AS corr FROM (SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2.0 AS ra, "
    f"rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2.0 AS rb FROM features WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
    for a in _sp for b in _sp)
SQL["AG15_target_correlations"] = P_FEAT + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{f}' AS feature, corr(CAST({f} AS DOUBLE), CAST(next_year_wins AS DOUBLE)) AS corr, "
    f"abs(corr(CAST({f} AS DOUBLE), CAST(next_year_wins AS DOUBLE))) AS abs_corr FROM features" for f in FEATS)
SQL["AG16_label_correlations"] = P_FEAT + "\n" + _corr_matrix(MILESTONES + ["made_playoffs"])
SQL["AG17_simple_regression"] = P_FEAT + """
SELECT regr_slope(CAST(wins AS DOUBLE), CAST(runs_scored AS DOUBLE)) AS slope,
  regr_intercept(CAST(wins AS DOUBLE), CAST(runs_scored AS DOUBLE)) AS intercept,
  corr(CAST(wins AS DOUBLE), CAST(runs_scored AS DOUBLE)) AS r FROM features"""
SQL["AG18_change_distribution"] = P_CLEAN + """,
d AS (SELECT wins - lag(wins) OVER (PARTITION BY team_name ORDER BY year) AS d FROM clean)
SELECT avg(d) AS mean_change, stddev_samp(d) AS std_change, count(d) AS n_changes FROM d"""
_tr = []
for m in ("wins", "run_differential"):
    _tr.append(f"regr_slope(CAST({m} AS DOUBLE), CAST(pos AS DOUBLE)) AS {m}_trend, "
               f"avg(CASE WHEN rd <= 5 THEN CAST({m} AS DOUBLE) END) AS {m}_recent_avg, "
               f"avg(CAST({m} AS DOUBLE)) AS {m}_historical_avg, stddev_pop(CAST({m} AS DOUBLE)) AS {m}_volatility")
SQL["AG19_20_trend_report"] = P_CLEAN + """,
d AS (SELECT team_name, wins, run_differential, row_number() OVER (PARTITION BY team_name ORDER BY year) - 1 AS pos,
        row_number() OVER (PARTITION BY team_name ORDER BY year DESC) AS rd FROM clean),
a AS (SELECT team_name, """ + ", ".join(_tr) + """ FROM d GROUP BY team_name HAVING count(*) >= 5)
SELECT *, wins_recent_avg - wins_historical_avg AS wins_improvement,
  run_differential_recent_avg - run_differential_historical_avg AS run_differential_improvement,
  CASE WHEN wins_trend >= 1.0 THEN 'improving' WHEN wins_trend <= -1.0 THEN 'declining' ELSE 'stable' END AS trend_class
FROM a"""
SQL["AG21_milestone_rates"] = P_FEAT + "\nSELECT " + ", ".join(
    f"avg(CAST({f} AS DOUBLE)) AS {f}_rate" for f in MILESTONES + ["made_playoffs"]) + " FROM features"
SQL["AG22_mean_importance"] = P_FEAT + ",\nlong AS (\n" + "\nUNION ALL\n".join(
    f"SELECT '{f}' AS feature, abs(corr(CAST({f} AS DOUBLE), CAST({lab} AS DOUBLE))) AS importance FROM features"
    for lab in MILESTONES for f in FEATS) + """)
SELECT feature, avg(importance) AS mean_importance, count(*) AS n_labels FROM long GROUP BY feature"""
SQL["AG23_histogram"] = P_CLEAN + """,
st AS (SELECT min(wins) AS lo, max(wins) AS hi FROM clean),
b AS (SELECT c.wins, st.lo, st.hi, CASE WHEN st.hi = st.lo THEN 1 ELSE
        LEAST(CAST(floor(20 * CAST(c.wins - st.lo AS DOUBLE) / CAST(st.hi - st.lo AS DOUBLE)) AS INTEGER) + 1, 20) END AS bin
      FROM clean c, st WHERE c.wins IS NOT NULL)
SELECT bin, lo + (bin - 1) * (CAST(hi - lo AS DOUBLE) / 20) AS bin_lo, lo + bin * (CAST(hi - lo AS DOUBLE) / 20) AS bin_hi,
  count(*) AS n FROM b GROUP BY bin, lo, hi"""
SQL["AG24_box_stats"] = P_FEAT + """,
q AS (SELECT era, quantile_cont(CAST(wins AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(wins AS DOUBLE), 0.5) AS median,
        quantile_cont(CAST(wins AS DOUBLE), 0.75) AS q3 FROM features GROUP BY era),
j AS (SELECT f.era, CAST(f.wins AS DOUBLE) AS v, q.q1, q.median, q.q3,
        CAST(f.wins AS DOUBLE) >= q.q1 - 1.5 * (q.q3 - q.q1) AND CAST(f.wins AS DOUBLE) <= q.q3 + 1.5 * (q.q3 - q.q1) AS inside
      FROM features f JOIN q ON f.era = q.era)
SELECT era, q1, median, q3, min(CASE WHEN inside THEN v END) AS whisker_low, max(CASE WHEN inside THEN v END) AS whisker_high,
  CAST(count_if(NOT inside) AS BIGINT) AS n_outliers FROM j GROUP BY era, q1, median, q3"""
_probs = [i / 100 for i in range(1, 100)]
_normal = [NormalDist().inv_cdf(p) for p in _probs]
SQL["AG25_qq_points"] = REG + f""",
q AS (SELECT quantile_cont(y - yhat, [{', '.join(repr(p) for p in _probs)}]) AS qs FROM reg)
SELECT CAST(i AS DOUBLE) / 100 AS prob, CAST(([{', '.join(repr(x) for x in _normal)}])[i] AS DOUBLE) AS normal_quantile,
  qs[i] AS sample_quantile
FROM q, range(1, 100) t(i)"""
SQL["AG27_kde"] = P_CLEAN + f""",
st AS (SELECT min(wins) AS lo, max(wins) AS hi, stddev_samp(wins) AS sd, count(wins) AS n FROM clean),
g AS (SELECT k, lo + CAST((hi - lo) * k AS DOUBLE) / 99 AS x, sd * pow(CAST(n AS DOUBLE), -0.2) AS h, n
      FROM st, range(0, 100) t(k))
SELECT CAST(g.k AS INTEGER) AS k, g.x,
  sum(exp(-0.5 * pow((g.x - c.wins) / g.h, 2)) / (g.h * {math.sqrt(2 * math.pi)!r})) / g.n AS density
FROM g, clean c WHERE c.wins IS NOT NULL GROUP BY g.k, g.x, g.n"""
SQL["AG28_distinct_counts"] = P_CLEAN + """
SELECT count(DISTINCT team_name) AS n_distinct_team_name, count(DISTINCT year) AS n_distinct_year,
  count(DISTINCT wins) AS n_distinct_wins FROM clean"""

SQL["TK1_order_by_prediction"] = SCORED + "\nSELECT team_name, year, predicted_wins FROM scored ORDER BY predicted_wins DESC, team_name"
SQL["TK2_top_n"] = SCORED + """
(SELECT team_name, year, predicted_wins, 'largest' AS side FROM scored ORDER BY predicted_wins DESC, team_name LIMIT 10)
UNION ALL
(SELECT team_name, year, predicted_wins, 'smallest' AS side FROM scored ORDER BY predicted_wins ASC, team_name LIMIT 5)"""
SQL["TK3_top_n_per_period"] = P_CLEAN + """,
r AS (SELECT team_name, year, wins, CAST(row_number() OVER (PARTITION BY year ORDER BY wins DESC, team_name) AS INTEGER)
        AS rank_in_group FROM clean)
SELECT * FROM r WHERE rank_in_group <= 5"""
SQL["TK4_rows_of_top_entities"] = P_CLEAN + """,
t AS (SELECT team_name FROM clean GROUP BY team_name ORDER BY avg(wins) DESC, team_name LIMIT 5)
SELECT team_name, year, wins FROM clean WHERE team_name IN (SELECT team_name FROM t)"""
SQL["TK5_largest_errors"] = REG + """
SELECT team_name, year, y, yhat, abs(yhat - y) AS abs_error FROM reg ORDER BY abs_error DESC, team_name, year LIMIT 10"""
SQL["TK6_arg_extremes"] = REG + """,
r AS (SELECT team_name, year, y - yhat AS residual FROM reg)
SELECT first(team_name ORDER BY residual DESC, team_name, year) AS argmax_team_name,
  first(year ORDER BY residual DESC, team_name, year) AS argmax_year, max(residual) AS max_value,
  first(team_name ORDER BY residual ASC, team_name, year) AS argmin_team_name,
  first(year ORDER BY residual ASC, team_name, year) AS argmin_year, min(residual) AS min_value FROM r"""
SQL["TK7_predicted_winners"] = SCORED + """
SELECT team_name, year, division_winner_probability FROM scored WHERE division_winner_probability > 0.5
ORDER BY division_winner_probability DESC, team_name LIMIT 6"""

SQL["JN1_actual_vs_predicted"] = SCORED + """
SELECT c.team_name, c.year, c.wins AS wins_actual, s.predicted_wins AS wins_predicted
FROM clean c JOIN scored s ON c.team_name = s.team_name AND c.year = s.year"""
SQL["JN2_dimension_lookups"] = P_CLEAN + """,
dims AS (SELECT 'Team ' || CAST(s.s_suppkey AS VARCHAR) AS team_name, n.n_name AS division, r.r_name AS league
         FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
         LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
short AS (SELECT * FROM (VALUES (1981, 110), (1994, 113), (1995, 144), (2020, 60)) t(year, season_games))
SELECT c.team_name, c.year, COALESCE(d.division, 'unknown') AS division, COALESCE(d.league, 'unknown') AS league,
  s.season_games FROM clean c LEFT JOIN dims d ON c.team_name = d.team_name LEFT JOIN short s ON c.year = s.year"""
SQL["JN4_membership_flag"] = P_CLEAN + """,
t AS (SELECT team_name FROM clean GROUP BY team_name ORDER BY avg(wins) DESC, team_name LIMIT 10)
SELECT team_name, year, CAST(team_name IN (SELECT team_name FROM t) AS INTEGER) AS top_franchise FROM clean"""
SQL["JN5_align_importances"] = P_FEAT + ",\na AS (\n" + "\nUNION ALL\n".join(
    f"SELECT '{f}' AS feature, abs(corr(CAST({f} AS DOUBLE), CAST(next_year_wins AS DOUBLE))) AS imp FROM features"
    for f in FEATS) + "),\nb AS (\n" + "\nUNION ALL\n".join(
    f"SELECT '{f}' AS feature, abs(corr(CAST({f} AS DOUBLE), CAST(made_playoffs AS DOUBLE))) AS imp FROM features"
    for f in FEATS[:5]) + """)
SELECT COALESCE(a.feature, b.feature) AS feature, COALESCE(a.imp, 0.0) AS wins_model, COALESCE(b.imp, 0.0) AS playoff_model,
  (COALESCE(a.imp, 0.0) + COALESCE(b.imp, 0.0)) / 2 AS mean_importance
FROM a FULL JOIN b ON a.feature = b.feature"""
SQL["JN6_group_stat_back"] = P_CLEAN + """
SELECT year, team_name, wins, avg(wins) OVER (PARTITION BY year) AS year_mean_wins,
  wins - avg(wins) OVER (PARTITION BY year) AS wins_vs_year_mean FROM clean"""

SQL["ST1_union_batches"] = P_CLEAN + "\nSELECT team_name, year, wins FROM clean"
SQL["ST2_train_val_stack"] = P_CLEAN + """
SELECT team_name, year, wins, CASE WHEN year = 2000 THEN 'val' ELSE 'train' END AS split FROM clean WHERE year < 2001"""
SQL["ST3_wide_to_long"] = P_FEAT + "\n" + "\nUNION ALL\n".join(
    f"SELECT team_name, year, '{m}' AS milestone, {m} AS achieved FROM features" for m in MILESTONES)
_eras = [e for e, *_ in CFG.era_ranges]
SQL["ST4_long_to_wide"] = REG + ",\ne AS (SELECT year, era, CASE WHEN abs(avg(abs(yhat - y))) < 1e12 THEN floor(avg(abs(yhat - y)) * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE ELSE avg(abs(yhat - y)) END AS mae FROM reg GROUP BY year, era)\n" + \
    "SELECT year, " + ", ".join(f"max(CASE WHEN era = '{e}' THEN mae END) AS {e}"
                                for e in _eras) + " FROM e GROUP BY year"
SQL["ST5_label_matrix"] = P_CLEAN + "\nSELECT team_name, year, " + ", ".join(
    f"CAST(COALESCE(wins >= {t}, false) AS INTEGER) AS wins_{t}" for t in CFG.win_milestones) + \
    f", CAST(COALESCE(wins >= {CFG.win_milestones[0]} OR games_behind IS NULL, false) AS INTEGER) AS contender FROM clean"

SQL["SP1_stratified_split"] = P_FEAT + f""",
h AS (SELECT team_name, year, made_playoffs, {H} AS h FROM features),
r AS (SELECT *, rank() OVER (PARTITION BY made_playoffs ORDER BY h) AS r,
        count(*) OVER (PARTITION BY made_playoffs) AS nc FROM h)
SELECT team_name, year, made_playoffs,
  CASE WHEN r <= floor(nc * 0.2 + 0.5) THEN 'test' WHEN r <= floor(nc * 0.2 + 0.5) + floor(nc * 0.1 + 0.5) THEN 'val'
       ELSE 'train' END AS split FROM r"""
SQL["SP2_quantile_period_split"] = P_CLEAN + f""",
c AS (SELECT quantile_cont(CAST(year AS DOUBLE), 0.8) AS cut FROM clean),
h AS (SELECT team_name, year, year > cut AS is_test, {H} AS h FROM clean, c),
r AS (SELECT *, rank() OVER (PARTITION BY is_test ORDER BY h) AS r FROM h),
n AS (SELECT count(*) AS n FROM h WHERE NOT is_test)
SELECT team_name, year, CASE WHEN is_test THEN 'test' WHEN r <= floor(n * 0.2 + 0.5) THEN 'val' ELSE 'train' END AS split
FROM r, n"""
SQL["SP3_last_periods_split"] = P_CLEAN + """
SELECT team_name, year, CASE WHEN year > (SELECT max(year) FROM clean) - 3 THEN 'test' ELSE 'train' END AS split FROM clean"""
SQL["SP4_three_way_split"] = P_CLEAN + """
SELECT team_name, year, CASE WHEN year >= 2000 THEN 'test' WHEN year = 1999 THEN 'val' ELSE 'train' END AS split FROM clean"""
SQL["SP5_kfold"] = P_CLEAN + f"\nSELECT team_name, year, CAST({H} % 5 AS INTEGER) AS fold FROM clean"
SQL["SP6_stratified_kfold"] = P_FEAT + f""",
h AS (SELECT team_name, year, made_playoffs, {H} AS h FROM features)
SELECT team_name, year, made_playoffs,
  CAST((rank() OVER (PARTITION BY made_playoffs ORDER BY h) - 1) % 5 AS INTEGER) AS fold FROM h"""


def _ts(k, gap, max_train):
    tstart = f"GREATEST(0, train_end - {max_train})" if max_train else "0"
    return P_CLEAN + f""",
p AS (SELECT year, row_number() OVER (ORDER BY year) - 1 AS pos, count(*) OVER () AS n FROM (SELECT DISTINCT year FROM clean)),
f AS (SELECT year, pos, CAST(fold AS INTEGER) AS fold, n - ({k} - fold) * (n // {k + 1}) AS start, n // {k + 1} AS t
      FROM p, range(0, {k}) r(fold)),
f2 AS (SELECT *, start - {gap} AS train_end FROM f),
roles AS (SELECT year, fold, CASE WHEN pos >= start AND pos < start + t THEN 'test'
            WHEN pos >= {tstart} AND pos < train_end THEN 'train' END AS role FROM f2)
SELECT c.year, c.team_name, r.fold, r.role FROM clean c JOIN roles r ON c.year = r.year WHERE r.role IS NOT NULL"""


SQL["SP7_time_series_folds"] = _ts(3, 1, 3)
SQL["SP8_expanding_folds"] = _ts(3, 0, None)
SQL["SP9_learning_curve_subsets"] = P_CLEAN + f""",
u AS (SELECT team_name, year, CAST({H} AS DOUBLE) / {float(16 ** 13)!r} AS u FROM clean)
SELECT team_name, year, f AS fraction FROM u, (VALUES (0.1::DOUBLE), (0.25::DOUBLE), (0.5::DOUBLE), (0.75::DOUBLE), (1.0::DOUBLE)) t(f) WHERE u < f"""
