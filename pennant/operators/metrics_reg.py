"""Regression metrics (MR1-MR20) as aggregations over ``(y, yhat)``.

Residual convention: ``e = y - yhat``.  Every report is one aggregation (plus a
one-row mean/quantile aggregate broadcast back where a second pass is needed).
Exact quantiles use ``percentile`` (linear interpolation, = numpy default);
``approx=True`` switches to ``percentile_approx`` for very large inputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pennant.config import BENCHMARKS_REGRESSION
from pennant.functions.safe import attach_scalars, div
from pennant.operators.ranking import quantiles as exact_quantiles
from pennant.sources.io import dense_index


def _q(c: Column, qs, approx: bool):
    return F.percentile_approx(c, qs, 100000) if approx else F.percentile(c, qs)


def _quantile_row(df: DataFrame, expr: Column, qs, names, approx: bool) -> DataFrame:
    """One row of named quantiles: distributed exact (histogram + prefix counts)
    or ``percentile_approx``."""
    if approx:
        r = df.agg(F.percentile_approx(expr, list(qs), 100000).alias("__q"))
    else:
        r = exact_quantiles(df.select(expr.alias("__x")), "__x", qs).withColumnRenamed("quantiles", "__q")
    return r.select(*[F.element_at("__q", i + 1).alias(n) for i, n in enumerate(names)])


def _one(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Attach a one-row aggregate to every row (size-proven broadcast)."""
    return df.withColumn("__k", F.lit(1)).join(F.broadcast(stats.withColumn("__k", F.lit(1))), "__k").drop("__k")


def core_metrics(df: DataFrame, y="y", yhat="yhat", weight: str | None = None, group=()) -> DataFrame:
    """MR1 / MR3 (explained variance) / MR8 — MSE, RMSE, MAE, R², explained
    variance, adjusted R² (p = 10), optionally weighted; one aggregation using
    sums of weighted moments."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    yv, e = F.col(y).cast("double"), F.col(y).cast("double") - F.col(yhat).cast("double")
    g = df.groupBy(*group) if group else df.groupBy()
    a = g.agg(F.sum(w).alias("__sw"), F.sum(w * e * e).alias("__se2"), F.sum(w * F.abs(e)).alias("__sae"),
              F.sum(w * yv).alias("__sy"), F.sum(w * yv * yv).alias("__sy2"), F.sum(w * e).alias("__se"),
              F.count(F.lit(1)).alias("n"))
    sw = F.col("__sw")
    mse = F.col("__se2") / sw
    var_y = F.col("__sy2") / sw - F.pow(F.col("__sy") / sw, 2)
    var_e = mse - F.pow(F.col("__se") / sw, 2)
    r2 = 1 - div(mse, var_y)
    n = F.col("n")
    return a.select(*group, "n", mse.alias("mse"), F.sqrt(mse).alias("rmse"), (F.col("__sae") / sw).alias("mae"),
                    r2.alias("r2"), (1 - div(var_e, var_y)).alias("explained_variance"),
                    F.when(n > 11, 1 - (1 - r2) * (n - 1) / (n - 10 - 1)).otherwise(r2).alias("adjusted_r2"))


def error_profile(df: DataFrame, y="y", yhat="yhat", approx: bool = False) -> DataFrame:
    """MR2 MR3 MR4 MR5 MR6 MR7 MR16 MR17 — MAPE (non-zero y), median AE,
    residual mean / std (ddof 0) / min / max / median, abs-error percentiles,
    over/under-estimation rates, within 5 / 10, largest over/under.  One
    aggregation plus distributed exact quantiles (no group gathered in a task)."""
    e = F.col(y).cast("double") - F.col(yhat).cast("double")
    ae = F.abs(e)
    base = df.agg(
        F.avg(F.when(F.col(y) != 0, div(ae, F.abs(F.col(y))))).alias("mape"),
        F.avg(e).alias("mean_residual"), F.stddev_pop(e).alias("std_residual"),
        F.min(e).alias("min_residual"), F.max(e).alias("max_residual"), F.max(ae).alias("max_abs_error"),
        F.avg((F.col(yhat) > F.col(y)).cast("double")).alias("overestimation_rate"),
        F.avg((F.col(yhat) < F.col(y)).cast("double")).alias("underestimation_rate"),
        F.avg((ae <= 5).cast("double")).alias("within_5"), F.avg((ae <= 10).cast("double")).alias("within_10"),
        F.min(yhat).alias("min_prediction"), F.max(yhat).alias("max_prediction"),
        F.min(e).alias("largest_over"), F.max(e).alias("largest_under"))
    med = _quantile_row(df, e, [0.5], ["median_residual"], approx)
    aq = _quantile_row(df, ae, [0.5, 0.9, 0.95, 0.99], ["median_ae", "p90_error", "p95_error", "p99_error"], approx)
    return attach_scalars(attach_scalars(base, med), aq)


def residual_tests(df: DataFrame, y="y", yhat="yhat", entity="team_name", period="year") -> DataFrame:
    """MR9 MR10 MR11 MR13 — D'Agostino K² normality (skew + kurtosis tests,
    p = exp(-K²/2)), panel Durbin-Watson (differences taken inside each entity
    series ordered by period, divided by the total sum of squares),
    heteroscedasticity (R² of e² on yhat, LM = n R²) and bias-corrected skew /
    excess kurtosis.  Population moments come from Spark's skewness/kurtosis."""
    from pyspark.sql import Window
    e = F.col(y).cast("double") - F.col(yhat).cast("double")
    w = Window.partitionBy(entity).orderBy(period)
    d = df.select(e.alias("e"), F.col(yhat).cast("double").alias("yh"), entity, period) \
        .withColumn("__d", F.col("e") - F.lag("e").over(w))
    a = d.agg(F.count("e").alias("n"), F.skewness("e").alias("__g1"), F.kurtosis("e").alias("__g2"),
              F.sum(F.col("__d") * F.col("__d")).alias("__sd2"), F.sum(F.col("e") * F.col("e")).alias("__se2"),
              F.regr_r2(F.col("e") * F.col("e"), F.col("yh")).alias("r2_residuals"))
    n = F.col("n").cast("double")
    g1, g2 = F.col("__g1"), F.col("__g2")
    # skew test
    yv = g1 * F.sqrt((n + 1) * (n + 3) / (6.0 * (n - 2)))
    beta2 = 3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = -1 + F.sqrt(2 * (beta2 - 1))
    delta = 1 / F.sqrt(0.5 * F.ln(w2))
    alpha = F.sqrt(2.0 / (w2 - 1))
    yv = F.when(yv == 0, F.lit(1.0)).otherwise(yv)
    zs = delta * F.ln(yv / alpha + F.sqrt(F.pow(yv / alpha, 2) + 1))
    # kurtosis test (b2 = Pearson kurtosis = excess + 3)
    b2 = g2 + 3
    ex = 3.0 * (n - 1) / (n + 1)
    varb2 = 24.0 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (b2 - ex) / F.sqrt(varb2)
    sb1 = 6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    aa = 6.0 + 8.0 / sb1 * (2.0 / sb1 + F.sqrt(1 + 4.0 / (sb1 * sb1)))
    t1 = 1 - 2 / (9.0 * aa)
    den = 1 + x * F.sqrt(2 / (aa - 4.0))
    t2 = F.signum(den) * F.pow((1 - 2.0 / aa) / F.abs(den), 1 / 3.0)
    zk = (t1 - t2) / F.sqrt(2 / (9.0 * aa))
    k2 = zs * zs + zk * zk
    return a.select(
        "n",
        F.when(n >= 8, k2).alias("normality_statistic"),
        F.when(n >= 8, F.exp(-k2 / 2)).alias("normality_p_value"),
        F.when(n > 1, div("__sd2", "__se2")).alias("durbin_watson"),
        F.col("r2_residuals"), (n * F.col("r2_residuals")).alias("lm_statistic"),
        (F.col("r2_residuals") > 0.1).cast("int").alias("likely_heteroscedastic"),
        (g1 * F.sqrt(n * (n - 1)) / (n - 2)).alias("skewness"),
        (((n + 1) * g2 + 6) * (n - 1) / ((n - 2) * (n - 3))).alias("excess_kurtosis"))


def durbin_watson(df: DataFrame, order, y="y", yhat="yhat") -> DataFrame:
    """MR10 — Durbin-Watson over the whole residual series in the declared total order (``order`` must tell rows
    apart): sum of squared differences of neighbours over the sum of squares.  Neighbours meet in an equality join on
    a dense index, so no task holds the whole series."""
    e = F.col(y).cast("double") - F.col(yhat).cast("double")
    d = dense_index(df.select(*order, e.alias("e")).where(F.col("e").isNotNull()), list(order), "__i").select("__i", "e")
    before = d.select((F.col("__i") + 1).alias("__i"), F.col("e").alias("__p"))
    j = d.join(before, "__i", "left")
    return j.agg(F.count("e").alias("n"), div(F.sum(F.pow(F.col("e") - F.col("__p"), 2)), F.sum(F.col("e") * F.col("e"))).alias("durbin_watson"))


def iqr_outliers(df: DataFrame, y="y", yhat="yhat", approx: bool = False) -> DataFrame:
    """MR12 — residual IQR fences; count and percentage outside."""
    e = F.col(y).cast("double") - F.col(yhat).cast("double")
    d = df.select(e.alias("e"))
    q = _quantile_row(d, F.col("e"), [0.25, 0.75], ["q1", "q3"], approx)
    q = q.select("q1", "q3", (F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).alias("lower_bound"),
                 (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("upper_bound"))
    j = _one(d, q)
    out = (F.col("e") < F.col("lower_bound")) | (F.col("e") > F.col("upper_bound"))
    return j.groupBy("q1", "q3", "lower_bound", "upper_bound").agg(
        F.count_if(out).alias("n_outliers"), (F.avg(out.cast("double")) * 100).alias("outlier_percentage"))


def interval_coverage(df: DataFrame, y="y", lower="lower", upper="upper") -> DataFrame:
    """MR14 — share of actuals inside [lower, upper] and mean width."""
    return df.agg(F.avg(F.col(y).between(F.col(lower), F.col(upper)).cast("double")).alias("coverage"),
                  F.avg(F.col(upper) - F.col(lower)).alias("mean_width"))


def bias_by_quantile_bin(df: DataFrame, y="y", yhat="yhat", max_bins: int = 10) -> DataFrame:
    """MR15 — n_bins = min(max_bins, n // 10) (one scalar count job: the
    quantile list must be a literal), then :func:`bias_by_bins`."""
    n = df.where(F.col(y).isNotNull()).count()
    return bias_by_bins(df, y, yhat, max(1, min(max_bins, n // 10)))


def bias_by_bins(df: DataFrame, y="y", yhat="yhat", n_bins: int = 10) -> DataFrame:
    """MR15 — as above with the bin count given (caller passes min(10, n // 10))."""
    d = df.select(F.col(y).cast("double").alias("y"), F.col(yhat).cast("double").alias("yh"))
    qs = [i / n_bins for i in range(n_bins + 1)]
    e = exact_quantiles(d, "y", qs).select(F.array_distinct("quantiles").alias("edges"))
    j = _one(d, e)
    # bin index: number of inner edges strictly below y (right-closed), lowest edge included in bin 0
    inner = F.slice(F.col("edges"), 2, F.size("edges") - 2)
    idx = F.aggregate(inner, F.lit(0), lambda acc, x: acc + F.when(F.col("y") > x, 1).otherwise(0))
    j = j.withColumn("bin", idx)
    return j.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("mean_actual"),
                                F.avg("yh").alias("mean_predicted"), F.avg(F.col("yh") - F.col("y")).alias("bias"),
                                F.avg(F.abs(F.col("yh") - F.col("y"))).alias("mae"))


def diagnostic_residuals(df: DataFrame, y="y", yhat="yhat", keys=("team_name", "year"), p: int = 1) -> DataFrame:
    """MR18 — per row: residual, 'standardised' residual as defined in the
    original (e / sqrt|e|), proper e / sigma, sqrt|e/sigma| (scale-location),
    and a simplified Cook's distance e² / (p · MSE)."""
    e = F.col(y).cast("double") - F.col(yhat).cast("double")
    d = df.select(*keys, e.alias("residual"))
    st = d.agg(F.stddev_pop("residual").alias("__sd"), F.avg(F.col("residual") * F.col("residual")).alias("__mse"))
    j = _one(d, st)
    return j.select(*keys, "residual",
                    div(F.col("residual"), F.sqrt(F.abs("residual"))).alias("standardized_residual_named"),
                    div("residual", "__sd").alias("standardized_residual"),
                    F.sqrt(F.abs(div("residual", "__sd"))).alias("scale_location"),
                    div(F.col("residual") * F.col("residual"), F.col("__mse") * p).alias("cooks_distance"))


def benchmark_level(metrics: DataFrame, rmse_col="rmse", r2_col="r2", levels=BENCHMARKS_REGRESSION) -> DataFrame:
    """MR19 — first level with rmse <= thr and r2 >= thr (lower-better RMSE)."""
    e = None
    for name, rmse, r2 in levels:
        cond = (F.col(rmse_col) <= rmse) & (F.col(r2_col) >= r2)
        e = F.when(cond, F.lit(name)) if e is None else e.when(cond, F.lit(name))
    return metrics.withColumn("benchmark_level", e.otherwise(F.lit("below_acceptable")))


def model_comparison(df: DataFrame, y: str, models: dict) -> DataFrame:
    """MR20 — one metric row per model (name -> prediction column): unpivot
    to (model, y, yhat) then ONE grouped aggregation."""
    items = [F.struct(F.lit(m).alias("model"), F.col(y).cast("double").alias("y"),
                      F.col(c).cast("double").alias("yhat")) for m, c in models.items()]
    long = df.select(F.inline(F.array(*items))).where(F.col("yhat").isNotNull() & F.col("y").isNotNull())
    return core_metrics(long, "y", "yhat", group=["model"]).drop("explained_variance", "adjusted_r2")


from pyspark.ml.evaluation import Evaluator  # noqa: E402


class WithinKEvaluator(Evaluator):
    """MR21 / UD6 — custom scorer: share of rows with |y - yhat| <= k (higher
    is better), usable with CrossValidator / TrainValidationSplit."""

    def __init__(self, k: float = 5.0, label: str = "label", prediction: str = "prediction"):
        super().__init__()
        self.k, self.label, self.prediction = k, label, prediction

    def _evaluate(self, dataset) -> float:
        r = dataset.agg(F.avg((F.abs(F.col(self.label) - F.col(self.prediction)) <= self.k).cast("double"))).first()
        return float(r[0]) if r[0] is not None else float("nan")

    def isLargerBetter(self) -> bool:
        return True


def prediction_range(df: DataFrame, y="y", yhat="yhat", keys=("team_name", "year")) -> DataFrame:
    """MR16 — prediction range and the rows of the largest over / under estimate."""
    e = F.col(yhat).cast("double") - F.col(y).cast("double")
    k = F.struct(*[F.col(c) for c in keys])
    d = df.withColumn("__e", e)
    r = d.agg(F.min(yhat).alias("min_prediction"), F.max(yhat).alias("max_prediction"),
              F.max("__e").alias("largest_over"), F.min("__e").alias("largest_under"),
              F.min_by(k, F.struct(-F.col("__e"), k)).alias("__o"), F.min_by(k, F.struct(F.col("__e"), k)).alias("__u"))
    return r.select("min_prediction", "max_prediction", "largest_over", "largest_under",
                    *[F.col(f"__o.{c}").alias(f"over_{c}") for c in keys],
                    *[F.col(f"__u.{c}").alias(f"under_{c}") for c in keys])


def error_summary(df: DataFrame, y="y", yhat="yhat") -> DataFrame:
    """MR17 — mean / std (ddof 0) of the error (yhat - y), median AE, p90 AE."""
    e = F.col(yhat).cast("double") - F.col(y).cast("double")
    base = df.agg(F.avg(e).alias("mean_error"), F.stddev_pop(e).alias("std_error"))
    return attach_scalars(base, _quantile_row(df, F.abs(e), [0.5, 0.9], ["median_ae", "p90_error"], False))


def adjusted_r2(df: DataFrame, y="y", yhat="yhat", p: int = 10) -> DataFrame:
    """MR8 — adjusted R² with the predictor count as a parameter (default 10)."""
    c = core_metrics(df, y, yhat)
    n = F.col("n")
    return c.select("n", "r2", F.when(n > p + 1, 1 - (1 - F.col("r2")) * (n - 1) / (n - p - 1))
                    .otherwise(F.col("r2")).alias("adjusted_r2"))
