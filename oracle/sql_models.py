"""Oracle SQL for the aggregation-only model operators (ML13, ML31, ML35-ML37,
ML41-ML43)."""

import math

from pennant.models.misc import POISSON_CDF
from oracle.catalog_sql import P_CLEAN, P_FEAT, SQL
from pennant.config import SYNTHETIC as CFG

SQL["ML13_pythagorean_exponent"] = P_FEAT + """,
b AS (SELECT CAST(runs_scored AS DOUBLE) AS rs, CAST(runs_allowed AS DOUBLE) AS ra, CAST(wins AS DOUBLE) AS w,
        CAST(total_games AS DOUBLE) AS g FROM features
      WHERE runs_scored IS NOT NULL AND runs_allowed IS NOT NULL AND wins IS NOT NULL),
c AS (SELECT e, avg(pow(g * pow(rs, e) / (pow(rs, e) + pow(ra, e)) - w, 2)) AS mse
      FROM b, (SELECT 1.5::DOUBLE + k * 0.01::DOUBLE AS e FROM range(0, 151) t(k)) GROUP BY e),
best AS (SELECT arg_min(e, mse) AS e0 FROM c),
f AS (SELECT e, avg(pow(g * pow(rs, e) / (pow(rs, e) + pow(ra, e)) - w, 2)) AS mse
      FROM b, (SELECT e0 + k * 0.0001::DOUBLE AS e FROM best, range(-100, 101) t(k)) grid
      WHERE e >= 1.5 - 1e-12 AND e <= 3.0 + 1e-12 GROUP BY e)
SELECT arg_min(e, mse) AS exponent, min(mse) AS mse FROM f"""


def _ml31():
    from oracle.catalog_sql import _describe_con
    from pennant.models.misc import select_features
    cols = [r[0] for r in _describe_con().execute(f"DESCRIBE ({P_FEAT} SELECT * FROM features)").fetchall()]
    milestones = [f"achieved_{t}_wins" for t in CFG.win_milestones] + ["made_playoffs"]
    sel = select_features(cols, "division_winner", exclude=milestones + ["is_division_winner"])
    return P_FEAT + f"\nSELECT team_name, year, {', '.join(sel)} FROM features"


try:
    SQL["ML31_select_features"] = _ml31()
except Exception:  # noqa: BLE001
    pass


def _holt(alpha, beta, horizon, name="h"):
    return f"""
{name}_s AS (SELECT team_name, year, CAST(wins AS DOUBLE) AS y,
        row_number() OVER (PARTITION BY team_name ORDER BY year, CAST(wins AS DOUBLE)) AS i,
        count(*) OVER (PARTITION BY team_name) AS n, max(year) OVER (PARTITION BY team_name) AS last_period
      FROM clean WHERE wins IS NOT NULL),
{name}_rec AS (
  SELECT s1.team_name, 1 AS i, s1.y AS l, s2.y - s1.y AS b
  FROM {name}_s s1 JOIN {name}_s s2 ON s1.team_name = s2.team_name AND s1.i = 1 AND s2.i = 2
  UNION ALL
  SELECT r.team_name, r.i + 1, {alpha}::DOUBLE * s.y + {1 - alpha!r}::DOUBLE * (r.l + r.b),
    {beta}::DOUBLE * (({alpha}::DOUBLE * s.y + {1 - alpha!r}::DOUBLE * (r.l + r.b)) - r.l) + {1 - beta!r}::DOUBLE * r.b
  FROM {name}_rec r JOIN {name}_s s ON s.team_name = r.team_name AND s.i = r.i + 1
),
{name}_fin AS (SELECT r.team_name, r.l, r.b, s.last_period FROM {name}_rec r
               JOIN (SELECT DISTINCT team_name, n, last_period FROM {name}_s) s
               ON r.team_name = s.team_name AND r.i = s.n),
{name} AS (SELECT team_name, CAST(last_period + h AS INTEGER) AS forecast_period, CAST(h AS INTEGER) AS h,
             l + h * b AS forecast FROM {name}_fin, range(1, {horizon + 1}) t(h))"""


SQL["ML35_holt_forecasts"] = "WITH RECURSIVE " + P_CLEAN[len("WITH "):] + "," + _holt(0.5, 0.3, 2) + \
    "\nSELECT team_name, forecast_period, h, forecast FROM h"
SQL["ML36_forecast_ensemble"] = "WITH RECURSIVE " + P_CLEAN[len("WITH "):] + "," + _holt(0.5, 0.3, 2, "ha") + "," + \
    _holt(0.8, 0.2, 2, "hb") + """
SELECT team_name, forecast_period, avg(forecast) AS ensemble_forecast, stddev_pop(forecast) AS ensemble_std,
  count(*) AS n_members
FROM (SELECT team_name, forecast_period, forecast FROM ha UNION ALL SELECT team_name, forecast_period, forecast FROM hb)
GROUP BY team_name, forecast_period"""
SQL["ML37_horizon_rows"] = P_CLEAN + """
SELECT team_name, CAST(max(year) + h AS INTEGER) AS forecast_period FROM clean, range(1, 4) t(h) GROUP BY team_name, h"""
SQL["ML41_psi_drift"] = P_CLEAN + """,
m AS (SELECT (min(year) + max(year)) // 2 AS mid FROM clean),
ed AS (SELECT quantile_cont(CAST(winning_percentage AS DOUBLE), [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges
       FROM clean WHERE year <= (SELECT mid FROM m)),
e AS (SELECT len(list_filter(edges, lambda x: winning_percentage > x)) AS bin,
        count(*) / (SELECT count(winning_percentage) FROM clean WHERE year <= (SELECT mid FROM m)) AS share
      FROM clean, ed WHERE year <= (SELECT mid FROM m) AND winning_percentage IS NOT NULL GROUP BY 1),
a AS (SELECT len(list_filter(edges, lambda x: winning_percentage > x)) AS bin,
        count(*) / (SELECT count(winning_percentage) FROM clean WHERE year > (SELECT mid FROM m)) AS share
      FROM clean, ed WHERE year > (SELECT mid FROM m) AND winning_percentage IS NOT NULL GROUP BY 1),
j AS (SELECT GREATEST(COALESCE(e.share, 0.0), 1e-4) AS e, GREATEST(COALESCE(a.share, 0.0), 1e-4) AS a
      FROM e FULL JOIN a ON e.bin = a.bin),
r AS (SELECT sum((a - e) * ln(a / e)) AS psi FROM j)
SELECT psi, CASE WHEN psi >= 0.15 THEN 'significant' WHEN psi >= 0.1 THEN 'moderate' ELSE 'none' END AS drift_level FROM r"""

_w = " ".join(f"WHEN u <= {c!r} THEN {k}" for k, c in enumerate(POISSON_CDF))
SQL["ML42_poisson_bootstrap"] = P_CLEAN + f""",
d AS (SELECT team_name, year, CAST(wins AS DOUBLE) AS v, rep,
        (CAST(('0x' || substr(md5(concat_ws('|', team_name, CAST(year AS VARCHAR), CAST(rep AS VARCHAR), '42')), 1, 13))::BIGINT
              AS DOUBLE) + 0.5) / {float(16 ** 13)!r} AS u
      FROM clean, range(0, 1000) t(rep) WHERE wins IS NOT NULL),
w AS (SELECT rep, v, CASE {_w} ELSE {len(POISSON_CDF)} END AS wt FROM d),
m AS (SELECT rep, sum(wt * v) / NULLIF(sum(wt), 0) AS mean FROM w GROUP BY rep)
SELECT avg(mean) AS bootstrap_mean, quantile_cont(mean, 0.025) AS lower, quantile_cont(mean, 0.975) AS upper FROM m"""
SQL["ML43_residual_bounds"] = P_FEAT + """,
q AS (SELECT quantile_cont(CAST(wins AS DOUBLE) - pythagorean_wins, 0.025) AS lo,
        quantile_cont(CAST(wins AS DOUBLE) - pythagorean_wins, 0.975) AS hi FROM features)
SELECT team_name, year, pythagorean_wins AS yhat, pythagorean_wins + lo AS lower_bound, pythagorean_wins + hi AS upper_bound
FROM features, q"""

# blocks of the isotonic fit from its definition: the value at i is the largest, over starts a <= i, of the smallest mean
# over ends b >= i; equal values are one block
SQL["ML9_isotonic_blocks"] = P_FEAT + """,
g AS MATERIALIZED (SELECT home_win_pct AS x, sum(CAST(wins AS DOUBLE)) AS w, sum(CAST(is_division_winner AS DOUBLE) * wins) AS wy,
        row_number() OVER (ORDER BY home_win_pct) AS i
      FROM features WHERE home_win_pct IS NOT NULL AND is_division_winner IS NOT NULL AND wins > 0 GROUP BY home_win_pct),
c AS MATERIALIZED (SELECT x, i, w, wy, sum(w) OVER (ORDER BY i) AS cw, sum(wy) OVER (ORDER BY i) AS cwy FROM g),
m AS (SELECT a.i AS a, b.i AS b, (b.cwy - a.cwy + a.wy) / (b.cw - a.cw + a.w) AS mean FROM c a JOIN c b ON a.i <= b.i),
low AS (SELECT a, b AS i, min(mean) OVER (PARTITION BY a ORDER BY b DESC) AS least FROM m),
v AS (SELECT i, max(least) AS value FROM low GROUP BY i),
k AS (SELECT c.*, sum(CASE WHEN value > before + 1e-9 THEN 1 ELSE 0 END) OVER (ORDER BY c.i) AS block
      FROM c JOIN (SELECT i, value, lag(value) OVER (ORDER BY i) AS before FROM v) u ON u.i = c.i)
SELECT min(x) AS low, max(x) AS high, sum(w) AS w, sum(wy) / sum(w) AS value FROM k GROUP BY block"""


from pennant.plans.q_models import CLS_FEATURES  # noqa: E402

_all = " AND ".join(f"{c} IS NOT NULL" for c in [*CLS_FEATURES, "is_division_winner"])
SQL["ML1_standard_scaler"] = P_FEAT + f""",
d AS (SELECT * FROM features WHERE {_all}),
t AS (SELECT {", ".join(f"avg(CAST({c} AS DOUBLE)) AS m_{c}, stddev_samp(CAST({c} AS DOUBLE)) AS s_{c}" for c in CLS_FEATURES)} FROM d WHERE year < 1999)
SELECT team_name, year, {", ".join(f"CASE WHEN s_{c} > 0 THEN ({c} - m_{c}) / s_{c} ELSE 0.0 END AS scaled_{c}" for c in CLS_FEATURES)} FROM d, t"""
