"""Oracle SQL for MC1-MC20, MR1-MR20 (and AG10)."""

from oracle.catalog_sql import P_FEAT, SQL

BIN = """WITH bin AS (
  SELECT l.doc_id, l.quality AS label, CAST(d.n_chars % 997 AS DOUBLE) / 997.0 AS p,
    CAST(CAST(d.n_chars % 997 AS DOUBLE) / 997.0 >= 0.5 AS INTEGER) AS prediction, l.toxic,
    CAST((d.n_chars * 7) % 991 AS DOUBLE) / 991.0 AS p_toxic
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id
),
cm AS (
  SELECT CAST(count_if(label = 0 AND prediction = 0) AS BIGINT) AS tn,
    CAST(count_if(label = 0 AND prediction = 1) AS BIGINT) AS fp,
    CAST(count_if(label = 1 AND prediction = 0) AS BIGINT) AS fn,
    CAST(count_if(label = 1 AND prediction = 1) AS BIGINT) AS tp FROM bin
),
m AS (
  SELECT *, CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn) AS accuracy,
    COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0), 0) AS precision,
    COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0), 0) AS recall,
    COALESCE(CAST(tn AS DOUBLE) / NULLIF(tn + fp, 0), 0) AS specificity,
    COALESCE((CAST(tp AS DOUBLE) * tn - CAST(fp AS DOUBLE) * fn)
      / NULLIF(sqrt(CAST(tp + fp AS DOUBLE) * (tp + fn) * (tn + fp) * (tn + fn)), 0), 0) AS mcc
  FROM cm
),
auc AS (
  SELECT (SUM(CASE WHEN label = 1 THEN ar END) - n_pos * (n_pos + 1) / 2.0) / (n_pos * n_neg) AS roc_auc
  FROM (SELECT label, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS ar,
          count_if(label = 1) OVER () AS n_pos, count_if(label <> 1) OVER () AS n_neg FROM bin WHERE p IS NOT NULL)
  GROUP BY n_pos, n_neg
),
hist AS (
  SELECT p AS s, count(*) AS n, count_if(label = 1) AS pos, count_if(label <> 1) AS neg FROM bin GROUP BY p
),
cum AS (
  SELECT s, n, pos, neg,
    sum(pos) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp_ge,
    sum(neg) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp_ge,
    sum(n) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n_ge,
    sum(pos) OVER () AS tot_pos, sum(neg) OVER () AS tot_neg FROM hist
)"""

SQL["MC1_classification_metrics"] = BIN + """
SELECT accuracy, precision, recall, COALESCE(2 * precision * recall / NULLIF(precision + recall, 0), 0) AS f1 FROM m"""
SQL["MC2_confusion_matrix"] = BIN + "\nSELECT tn, fp, fn, tp FROM cm"
SQL["MC3_normalized_confusion"] = BIN + """
SELECT label, prediction, count(*) AS n, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY label) AS row_share
FROM bin GROUP BY label, prediction"""
SQL["MC4_specificity_balanced"] = BIN + """
SELECT specificity, recall AS sensitivity, (specificity + recall) / 2 AS balanced_accuracy FROM m"""
SQL["MC5_matthews"] = BIN + "\nSELECT mcc FROM m"
SQL["MC6_roc_auc"] = BIN + "\nSELECT roc_auc FROM auc"
SQL["MC7_average_precision"] = BIN + """
SELECT sum(CAST(pos AS DOUBLE) / tot_pos * CAST(tp_ge AS DOUBLE) / n_ge) AS average_precision FROM cum"""
SQL["MC8_9_log_loss_brier"] = BIN + """
SELECT avg(-(label * ln(LEAST(GREATEST(p, 2.220446049250313e-16), 1 - 2.220446049250313e-16))
             + (1 - label) * ln(1 - LEAST(GREATEST(p, 2.220446049250313e-16), 1 - 2.220446049250313e-16)))) AS log_loss,
  avg(pow(p - label, 2)) AS brier_score FROM bin"""
SQL["MC10_calibration_error"] = BIN + """,
b AS (SELECT CAST(floor(p * 10) AS INTEGER) AS b, count(*) AS n, avg(CAST(label AS DOUBLE)) AS acc, avg(p) AS conf
      FROM bin GROUP BY 1)
SELECT sum(n * abs(acc - conf)) / (SELECT count(*) FROM bin) AS ece, COALESCE(max(abs(acc - conf)), 0.0) AS mce
FROM b WHERE b >= 0 AND b < 10"""
SQL["MC11_calibration_curve"] = BIN + """
SELECT LEAST(GREATEST(CAST(ceil(p * 10) AS INTEGER) - 1, 0), 9) AS bin, avg(p) AS mean_predicted,
  avg(CAST(label AS DOUBLE)) AS fraction_positive, count(*) AS n FROM bin GROUP BY 1"""

MCLS = """WITH e AS (SELECT vec_id, label, list_transform(range(0, 10), lambda k: list_sum(list_transform(
  list_filter(embedding, lambda v, i: (i - 1) % 10 = k), lambda v: v::DOUBLE))) AS x FROM embeddings),
e2 AS (SELECT vec_id, label, list_transform(x, lambda v: exp(v - list_max(x))) AS ex FROM e),
mc AS (SELECT vec_id, label, list_transform(ex, lambda v: v / list_sum(ex)) AS probs FROM e2),
mcp AS (SELECT *, CAST(list_position(probs, list_max(probs)) - 1 AS INTEGER) AS prediction FROM mc)"""

SQL["MC8_multiclass_log_loss"] = MCLS + """
SELECT avg(-ln(least(greatest(probs[label + 1], 2.220446049250313e-16), 1 - 2.220446049250313e-16))) AS log_loss, count(*) AS n_rows
FROM mcp WHERE label BETWEEN 0 AND 9"""
SQL["MC12_ovr_auc"] = MCLS + """,
long AS (SELECT label, CAST(k - 1 AS INTEGER) AS cls, probs[k] AS p FROM mcp, range(1, 11) t(k)),
r AS (SELECT cls, CAST(label = cls AS INTEGER) AS pos,
        rank() OVER (PARTITION BY cls ORDER BY p) + (count(*) OVER (PARTITION BY cls, p) - 1) / 2.0 AS ar FROM long),
per AS (SELECT cls, (sum(CASE WHEN pos = 1 THEN ar END) - sum(pos) * (sum(pos) + 1) / 2.0)
          / (CAST(sum(pos) AS DOUBLE) * (count(*) - sum(pos))) AS roc_auc FROM r GROUP BY cls)
SELECT cls, roc_auc FROM per UNION ALL SELECT -1 AS cls, avg(roc_auc) AS roc_auc FROM per"""

SQL["MC13_14_class_report"] = MCLS + """,
cls AS (SELECT label AS cls FROM mcp UNION SELECT prediction FROM mcp),
r AS (
  SELECT c.cls, count_if(m.label = c.cls AND m.prediction = c.cls) AS tp, count_if(m.label = c.cls) AS support,
    count_if(m.prediction = c.cls) AS n_pred
  FROM cls c, mcp m GROUP BY c.cls
),
r2 AS (SELECT CAST(cls AS VARCHAR) AS class, COALESCE(CAST(tp AS DOUBLE) / NULLIF(n_pred, 0), 0) AS precision,
         COALESCE(CAST(tp AS DOUBLE) / NULLIF(support, 0), 0) AS recall, CAST(support AS BIGINT) AS support,
         CAST(tp AS BIGINT) AS tp FROM r),
r3 AS (SELECT *, COALESCE(2 * precision * recall / NULLIF(precision + recall, 0), 0) AS f1 FROM r2)
SELECT class, precision, recall, f1, support FROM r3
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM r3
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
  sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM r3
UNION ALL SELECT 'accuracy', CAST(sum(tp) AS DOUBLE) / sum(support), CAST(sum(tp) AS DOUBLE) / sum(support),
  CAST(sum(tp) AS DOUBLE) / sum(support), CAST(sum(support) AS BIGINT) FROM r3"""

SQL["MC15_16_curves"] = BIN + """
SELECT s AS threshold, CAST(fp_ge AS DOUBLE) / tot_neg AS fpr, CAST(tp_ge AS DOUBLE) / tot_pos AS tpr,
  CAST(tp_ge AS DOUBLE) / NULLIF(tp_ge + fp_ge, 0) AS precision, CAST(tp_ge AS DOUBLE) / tot_pos AS recall FROM cum"""

SQL["MC17_multilabel"] = BIN + """,
long AS (SELECT 'label' AS label_name, label AS y, CAST(p >= 0.5 AS INTEGER) AS yhat FROM bin
         UNION ALL SELECT 'toxic', toxic, CAST(p_toxic >= 0.5 AS INTEGER) FROM bin),
c AS (SELECT label_name, count_if(y = 1 AND yhat = 1) AS tp, count_if(y = 0 AND yhat = 1) AS fp,
        count_if(y = 0 AND yhat = 0) AS tn, count_if(y = 1 AND yhat = 0) AS fn FROM long GROUP BY 1),
per AS (SELECT label_name, CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn) AS accuracy,
          COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0), 0) AS precision,
          COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0), 0) AS recall FROM c),
per2 AS (SELECT *, COALESCE(2 * precision * recall / NULLIF(precision + recall, 0), 0) AS f1 FROM per)
SELECT * FROM per2 UNION ALL SELECT 'overall', avg(accuracy), NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE FROM per2"""

SQL["MC18_prediction_analysis"] = BIN + """
SELECT CAST(count_if(prediction = 0) AS BIGINT) AS n_pred_0, CAST(count_if(prediction = 1) AS BIGINT) AS n_pred_1,
  avg(CAST(label <> prediction AS DOUBLE)) AS error_rate,
  avg(CASE WHEN label = prediction THEN p END) AS p_mean_correct,
  stddev_pop(CASE WHEN label = prediction THEN p END) AS p_std_correct,
  min(CASE WHEN label = prediction THEN p END) AS p_min_correct,
  max(CASE WHEN label = prediction THEN p END) AS p_max_correct,
  avg(CASE WHEN label <> prediction THEN p END) AS p_mean_wrong,
  stddev_pop(CASE WHEN label <> prediction THEN p END) AS p_std_wrong,
  min(CASE WHEN label <> prediction THEN p END) AS p_min_wrong,
  max(CASE WHEN label <> prediction THEN p END) AS p_max_wrong,
  avg(CAST((p > 0.8 AND label = 0) OR (p < 0.2 AND label = 1) AS DOUBLE)) AS high_confidence_error_rate
FROM bin"""

SQL["MC19_benchmark_level"] = BIN + """
SELECT m.accuracy, a.roc_auc,
  CASE WHEN a.roc_auc >= 0.9 AND m.accuracy >= 0.85 THEN 'excellent'
       WHEN a.roc_auc >= 0.8 AND m.accuracy >= 0.75 THEN 'good'
       WHEN a.roc_auc >= 0.7 AND m.accuracy >= 0.65 THEN 'acceptable' ELSE 'below_acceptable' END AS benchmark_level
FROM m, auc a"""

SQL["MC20_probability_distribution"] = BIN + """
SELECT avg(p) AS p_mean, stddev_pop(p) AS p_std, min(p) AS p_min, max(p) AS p_max,
  CAST(count_if(p >= 0.7) AS BIGINT) AS n_high, CAST(count_if(p <= 0.3) AS BIGINT) AS n_low, count(p) AS n FROM bin"""

REG = P_FEAT + """,
reg AS (SELECT team_name, year, era, total_games, CAST(wins AS DOUBLE) AS y, pythagorean_wins AS yhat,
          wins_3yr_avg AS yhat_prior FROM features)"""


def _core(w: str, group: str = "") -> str:
    g = f"{group}, " if group else ""
    gb = f" GROUP BY {group}" if group else ""
    return f"""
SELECT {g}count(*) AS n, sum({w} * (y - yhat) * (y - yhat)) / sum({w}) AS mse,
  sqrt(sum({w} * (y - yhat) * (y - yhat)) / sum({w})) AS rmse, sum({w} * abs(y - yhat)) / sum({w}) AS mae,
  1 - (sum({w} * (y - yhat) * (y - yhat)) / sum({w}))
      / NULLIF(sum({w} * y * y) / sum({w}) - pow(sum({w} * y) / sum({w}), 2), 0) AS r2,
  1 - (sum({w} * (y - yhat) * (y - yhat)) / sum({w}) - pow(sum({w} * (y - yhat)) / sum({w}), 2))
      / NULLIF(sum({w} * y * y) / sum({w}) - pow(sum({w} * y) / sum({w}), 2), 0) AS explained_variance
FROM reg{gb}"""


SQL["MR1_core_metrics"] = REG + """,
c AS (""" + _core("1.0") + """)
SELECT *, CASE WHEN n > 11 THEN 1 - (1 - r2) * (n - 1) / (n - 10 - 1) ELSE r2 END AS adjusted_r2 FROM c"""
SQL["MR1_weighted_metrics"] = REG + """,
c AS (""" + _core("CAST(total_games AS DOUBLE)") + """)
SELECT *, CASE WHEN n > 11 THEN 1 - (1 - r2) * (n - 1) / (n - 10 - 1) ELSE r2 END AS adjusted_r2 FROM c"""
SQL["AG10_metrics_by_era"] = REG + """,
c AS (""" + _core("1.0", "era") + """)
SELECT era, n, rmse, r2, mae FROM c"""

SQL["MR2_7_error_profile"] = REG + """
SELECT avg(CASE WHEN y <> 0 THEN abs(y - yhat) / abs(y) END) AS mape,
  avg(y - yhat) AS mean_residual, stddev_pop(y - yhat) AS std_residual, min(y - yhat) AS min_residual,
  max(y - yhat) AS max_residual, quantile_cont(y - yhat, 0.5) AS median_residual, max(abs(y - yhat)) AS max_abs_error,
  avg(CAST(yhat > y AS DOUBLE)) AS overestimation_rate, avg(CAST(yhat < y AS DOUBLE)) AS underestimation_rate,
  avg(CAST(abs(y - yhat) <= 5 AS DOUBLE)) AS within_5, avg(CAST(abs(y - yhat) <= 10 AS DOUBLE)) AS within_10,
  min(yhat) AS min_prediction, max(yhat) AS max_prediction, min(y - yhat) AS largest_over, max(y - yhat) AS largest_under,
  quantile_cont(abs(y - yhat), 0.5) AS median_ae, quantile_cont(abs(y - yhat), 0.9) AS p90_error,
  quantile_cont(abs(y - yhat), 0.95) AS p95_error, quantile_cont(abs(y - yhat), 0.99) AS p99_error
FROM reg"""

SQL["MR9_13_residual_tests"] = REG + """,
r AS (SELECT team_name, year, y - yhat AS e, yhat AS yh,
        (y - yhat) - lag(y - yhat) OVER (PARTITION BY team_name ORDER BY year) AS d FROM reg),
mu AS (SELECT avg(e) AS mu FROM r),
mom AS (SELECT CAST(count(e) AS DOUBLE) AS n, avg(pow(e - mu, 2)) AS m2, avg(pow(e - mu, 3)) AS m3,
          avg(pow(e - mu, 4)) AS m4, sum(d * d) AS sd2, sum(e * e) AS se2, regr_r2(e * e, yh) AS r2_residuals
        FROM r, mu),
g AS (SELECT *, m3 / pow(m2, 1.5) AS g1, m4 / (m2 * m2) - 3 AS g2 FROM mom),
s1 AS (SELECT *, g1 * sqrt((n + 1) * (n + 3) / (6.0 * (n - 2))) AS y0,
         3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) AS beta2,
         g2 + 3 AS b2, 3.0 * (n - 1) / (n + 1) AS ex,
         24.0 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5)) AS varb2,
         6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS sb1
       FROM g),
s2 AS (SELECT *, -1 + sqrt(2 * (beta2 - 1)) AS w2, CASE WHEN y0 = 0 THEN 1.0 ELSE y0 END AS yv,
         (b2 - ex) / sqrt(varb2) AS x, 6.0 + 8.0 / sb1 * (2.0 / sb1 + sqrt(1 + 4.0 / (sb1 * sb1))) AS aa FROM s1),
s3 AS (SELECT *, 1 / sqrt(0.5 * ln(w2)) AS delta, sqrt(2.0 / (w2 - 1)) AS alpha,
         1 - 2 / (9.0 * aa) AS t1, 1 + x * sqrt(2 / (aa - 4.0)) AS den FROM s2),
s4 AS (SELECT *, delta * ln(yv / alpha + sqrt(pow(yv / alpha, 2) + 1)) AS zs,
         (t1 - sign(den) * pow((1 - 2.0 / aa) / abs(den), 1 / 3.0)) / sqrt(2 / (9.0 * aa)) AS zk FROM s3)
SELECT CAST(n AS BIGINT) AS n, CASE WHEN n >= 8 THEN zs * zs + zk * zk END AS normality_statistic,
  CASE WHEN n >= 8 THEN exp(-(zs * zs + zk * zk) / 2) END AS normality_p_value,
  CASE WHEN n > 1 THEN sd2 / NULLIF(se2, 0) END AS durbin_watson, r2_residuals, n * r2_residuals AS lm_statistic,
  CAST(r2_residuals > 0.1 AS INTEGER) AS likely_heteroscedastic,
  g1 * sqrt(n * (n - 1)) / (n - 2) AS skewness, ((n + 1) * g2 + 6) * (n - 1) / ((n - 2) * (n - 3)) AS excess_kurtosis
FROM s4"""

SQL["MR10_durbin_watson"] = REG + """,
r AS (SELECT y - yhat AS e, (y - yhat) - lag(y - yhat) OVER (ORDER BY year, team_name) AS d FROM reg WHERE y - yhat IS NOT NULL)
SELECT count(e) AS n, sum(d * d) / NULLIF(sum(e * e), 0) AS durbin_watson FROM r"""
SQL["MR12_iqr_outliers"] = REG + """,
q AS (SELECT quantile_cont(y - yhat, 0.25) AS q1, quantile_cont(y - yhat, 0.75) AS q3 FROM reg),
b AS (SELECT q1, q3, q1 - 1.5 * (q3 - q1) AS lower_bound, q3 + 1.5 * (q3 - q1) AS upper_bound FROM q)
SELECT q1, q3, lower_bound, upper_bound,
  CAST(count_if(y - yhat < lower_bound OR y - yhat > upper_bound) AS BIGINT) AS n_outliers,
  avg(CAST(y - yhat < lower_bound OR y - yhat > upper_bound AS DOUBLE)) * 100 AS outlier_percentage
FROM reg, b GROUP BY ALL"""

SQL["MR14_interval_coverage"] = REG + """
SELECT avg(CAST(y BETWEEN yhat - 1.96 * 5 AND yhat + 1.96 * 5 AS DOUBLE)) AS coverage,
  avg((yhat + 1.96 * 5) - (yhat - 1.96 * 5)) AS mean_width FROM reg"""

SQL["MR15_bias_by_bin"] = REG + """,
s AS (SELECT y, row_number() OVER (ORDER BY y) - 1 AS i FROM reg WHERE y IS NOT NULL),
nb AS (SELECT count(*) AS n, GREATEST(1, LEAST(10, count(*) // 10)) AS k FROM s),
qs AS (SELECT j, CAST(j AS DOUBLE) / k * (n - 1) AS pos FROM nb, range(0, 11) t(j) WHERE j <= k),
ev AS (SELECT q.j, lo.y + (hi.y - lo.y) * (q.pos - floor(q.pos)) AS edge
       FROM qs q JOIN s lo ON lo.i = CAST(floor(q.pos) AS BIGINT) JOIN s hi ON hi.i = CAST(ceil(q.pos) AS BIGINT)),
ed AS (SELECT list_distinct(list(edge ORDER BY j)) AS edges FROM ev),
ed2 AS (SELECT list_sort(edges) AS edges FROM ed),
bb AS (SELECT r.y, r.yhat AS yh,
         len(list_filter(edges[2:len(edges) - 1], lambda e: r.y > e)) AS bin FROM reg r, ed2)
SELECT CAST(bin AS INTEGER) AS bin, count(*) AS n, avg(y) AS mean_actual, avg(yh) AS mean_predicted,
  avg(yh - y) AS bias, avg(abs(yh - y)) AS mae FROM bb GROUP BY bin"""

SQL["MR18_diagnostic_residuals"] = REG + """,
r AS (SELECT team_name, year, y - yhat AS residual FROM reg),
st AS (SELECT stddev_pop(residual) AS sd, avg(residual * residual) AS mse FROM r)
SELECT team_name, year, residual, residual / NULLIF(sqrt(abs(residual)), 0) AS standardized_residual_named,
  residual / NULLIF(sd, 0) AS standardized_residual, sqrt(abs(residual / NULLIF(sd, 0))) AS scale_location,
  residual * residual / NULLIF(mse * 1, 0) AS cooks_distance FROM r, st"""

SQL["MR19_benchmark_level"] = REG + """,
c AS (""" + _core("1.0") + """)
SELECT rmse, r2, CASE WHEN rmse <= 5.0 AND r2 >= 0.8 THEN 'excellent' WHEN rmse <= 8.0 AND r2 >= 0.65 THEN 'good'
  WHEN rmse <= 12.0 AND r2 >= 0.5 THEN 'acceptable' ELSE 'below_acceptable' END AS benchmark_level FROM c"""

SQL["MR20_model_comparison"] = REG + """,
long AS (SELECT 'pythagorean' AS model, y, yhat FROM reg WHERE yhat IS NOT NULL AND y IS NOT NULL
         UNION ALL SELECT 'prior_mean', y, yhat_prior FROM reg WHERE yhat_prior IS NOT NULL AND y IS NOT NULL),
reg2 AS (SELECT * FROM long)
SELECT model, count(*) AS n, avg((y - yhat) * (y - yhat)) AS mse, sqrt(avg((y - yhat) * (y - yhat))) AS rmse,
  avg(abs(y - yhat)) AS mae,
  1 - avg((y - yhat) * (y - yhat)) / NULLIF(avg(y * y) - pow(avg(y), 2), 0) AS r2
FROM long GROUP BY model"""

SQL["MC12_ovo_auc"] = MCLS + """,
pairs AS (SELECT a, b FROM range(0, 10) t1(a), range(0, 10) t2(b) WHERE a < b),
recs AS (
  SELECT pr.a AS class_a, pr.b AS class_b, 'a' AS side, m.probs[pr.a + 1] AS s, CAST(m.label = pr.a AS INTEGER) AS pos
  FROM mcp m JOIN pairs pr ON m.label IN (pr.a, pr.b)
  UNION ALL
  SELECT pr.a, pr.b, 'b', m.probs[pr.b + 1], CAST(m.label = pr.b AS INTEGER)
  FROM mcp m JOIN pairs pr ON m.label IN (pr.a, pr.b)
),
r AS (SELECT class_a, class_b, side, pos,
        rank() OVER (PARTITION BY class_a, class_b, side ORDER BY s)
        + (count(*) OVER (PARTITION BY class_a, class_b, side, s) - 1) / 2.0 AS ar FROM recs),
per AS (SELECT class_a, class_b, side,
          (sum(CASE WHEN pos = 1 THEN ar END) - sum(pos) * (sum(pos) + 1) / 2.0)
          / (CAST(sum(pos) AS DOUBLE) * (count(*) - sum(pos))) AS roc_auc FROM r GROUP BY class_a, class_b, side),
pair AS (SELECT CAST(class_a AS INTEGER) AS class_a, CAST(class_b AS INTEGER) AS class_b, avg(roc_auc) AS roc_auc
         FROM per GROUP BY class_a, class_b)
SELECT * FROM pair UNION ALL SELECT -1, -1, avg(roc_auc) FROM pair"""
