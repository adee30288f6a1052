"""Aggregations (AG1-AG28).

All grouped work is ``groupBy().agg`` (partial aggregation on every task,
so a hot group costs one row per task before the shuffle).  Wide reports
are one aggregation plus ``stack`` to long form.  Quantiles are exact
``percentile`` (= numpy linear interpolation); per-group medians and
quartiles are aggregates too (never an ordered window over raw rows).
"""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pennant.functions.safe import attach_scalars, div, round_half_up
from pennant.operators.ranking import prefix_counts, quantiles
from pennant.session import materialize


def _stack(r: DataFrame, names, fields, out_names) -> DataFrame:
    parts = ", ".join(f"'{n}', " + ", ".join(f"`{f.format(i=i)}`" for f in fields) for i, n in enumerate(names))
    return r.selectExpr(f"stack({len(names)}, {parts}) as (metric, {', '.join(out_names)})")


def eda_summary(df: DataFrame, metrics) -> DataFrame:
    """AG1 / AG26 — per metric mean, std (ddof 1), min, max, q1, median, q3:
    one unpivot, one grouped aggregation and one distributed exact quantile pass
    (grouped by metric)."""
    items = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("x")) for c in metrics]
    long = df.select(F.inline(F.array(*items)))
    mom = long.groupBy("metric").agg(F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"),
                                     F.min("x").alias("min"), F.max("x").alias("max"))
    q = quantiles(long, "x", [0.25, 0.5, 0.75], ["metric"]).select(
        "metric", F.col("quantiles")[0].alias("q1"), F.col("quantiles")[1].alias("median"),
        F.col("quantiles")[2].alias("q3"))
    return mom.join(q, "metric", "left")


def season_summary(df: DataFrame, period="year") -> DataFrame:
    """AG2 — per period: mean wins, mean run differential, total runs, runs per game."""
    return df.groupBy(period).agg(F.avg("wins").alias("mean_wins"), F.avg("run_differential").alias("mean_run_diff"),
                                  F.sum("runs_scored").alias("total_runs"),
                                  div(F.sum("runs_scored"), F.sum(F.col("wins") + F.col("losses"))).alias("runs_per_game"))


def entity_group_summary(df: DataFrame, keys=("team_name", "era")) -> DataFrame:
    """AG3 — per (entity, era): mean / max / count of wins, mean win pct.
    (Display rounding is left to the presentation layer: rounding a binary
    double at a decimal tie differs between engines.)"""
    return df.groupBy(*keys).agg(F.avg("wins").alias("mean_wins"), F.max("wins").alias("max_wins"),
                                 F.count("wins").alias("seasons"), F.avg("winning_percentage").alias("mean_win_pct"))


def entity_summary(df: DataFrame, threshold: int, entity="team_name") -> DataFrame:
    """AG4 — per entity: seasons, mean and max wins, seasons at or above a threshold."""
    return df.groupBy(entity).agg(F.count(F.lit(1)).alias("seasons"), F.avg("wins").alias("mean_wins"),
                                  F.max("wins").alias("max_wins"),
                                  F.count_if(F.col("wins") >= threshold).alias("n_above_threshold"))


def recent_summary(df: DataFrame, n: int = 10, entity="team_name", period="year") -> DataFrame:
    """AG5 — last ``n`` periods per entity (``row_number <= n`` -> WindowGroupLimit):
    mean wins and the best season (earliest on ties)."""
    w = Window.partitionBy(entity).orderBy(F.desc(period))
    last = df.select(entity, period, "wins").withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n)
    return last.groupBy(entity).agg(F.avg("wins").alias("recent_mean_wins"),
                                    F.min_by(period, F.struct(-F.col("wins"), F.col(period))).alias("best_season"))


def latest_period_stats(df: DataFrame, entity="team_name", period="year") -> DataFrame:
    """AG6 — stats of the latest period (max period: one-row aggregate, broadcast)."""
    mx = df.agg(F.max(period).alias("__mx"))
    last = df.join(F.broadcast(mx), F.col(period) == F.col("__mx"))
    return last.agg(F.max(period).alias("season"), F.count(F.lit(1)).alias("n_teams"),
                    F.avg("wins").alias("mean_wins"), F.max("wins").alias("max_wins"),
                    F.min_by(entity, F.struct(-F.col("wins"), F.col(entity))).alias("best_team"))


def error_by_group(df: DataFrame, group, y="y", yhat="yhat") -> DataFrame:
    """AG7 — per group: MAE, std of |error| (ddof 1), mean error (yhat - y), rounded 2."""
    ae = F.abs(F.col(yhat) - F.col(y))
    return df.groupBy(*group).agg(round_half_up(F.avg(ae), 2).alias("mae"),
                                  round_half_up(F.stddev_samp(ae), 2).alias("std_ae"),
                                  round_half_up(F.avg(F.col(yhat) - F.col(y)), 2).alias("mean_error"),
                                  F.count(F.lit(1)).alias("n"))


def mae_by_entity_top(df: DataFrame, n: int = 15, entity="team_name", y="y", yhat="yhat") -> DataFrame:
    """AG8 — entities with the largest MAE (top-n report; ties by entity)."""
    m = df.groupBy(entity).agg(F.avg(F.abs(F.col(yhat) - F.col(y))).alias("mae"))
    return m.orderBy(F.desc("mae"), F.asc(entity)).limit(n)


def accuracy_by_level(df: DataFrame, level: str, actual: str, predicted: str) -> DataFrame:
    """AG9 — accuracy per confidence level."""
    return df.groupBy(level).agg(F.avg((F.col(actual) == F.col(predicted)).cast("double")).alias("accuracy"),
                                 F.count(F.lit(1)).alias("n"))


def target_summary(df: DataFrame, targets) -> DataFrame:
    """AG11 — per target: positive rate, positives, rows (one unpivot + one aggregation)."""
    items = [F.struct(F.lit(t).alias("target"), F.col(t).cast("double").alias("v")) for t in targets]
    long = df.select(F.inline(F.array(*items)))
    return long.groupBy("target").agg(F.avg("v").alias("positive_rate"), F.sum("v").cast("long").alias("positives"),
                                      F.count("v").alias("total"))


def class_counts_side_by_side(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """AG12 — actual vs predicted class counts aligned by a full outer join."""
    a = df.groupBy(F.col(actual).alias("cls")).agg(F.count(F.lit(1)).alias("n_actual"))
    p = df.groupBy(F.col(predicted).alias("cls")).agg(F.count(F.lit(1)).alias("n_predicted"))
    return a.join(p, "cls", "full").na.fill(0, ["n_actual", "n_predicted"])


def prediction_summary(df: DataFrame, pred="predicted_wins", winner="division_winner_prediction",
                       cuts=(90, 100, 81)) -> DataFrame:
    """AG13 — n, mean, std (ddof 1), counts >= c1, >= c2, < c3, > c3, projected winners."""
    p = F.col(pred)
    return df.agg(F.count(p).alias("n"), F.avg(p).alias("mean"), F.stddev_samp(p).alias("std"),
                  F.count_if(p >= cuts[0]).alias(f"n_ge_{cuts[0]}"), F.count_if(p >= cuts[1]).alias(f"n_ge_{cuts[1]}"),
                  F.count_if(p < cuts[2]).alias(f"n_lt_{cuts[2]}"), F.count_if(p > cuts[2]).alias(f"n_gt_{cuts[2]}"),
                  F.sum(winner).cast("long").alias("n_winners"))


def correlation_matrix(df: DataFrame, columns, method: str = "pearson") -> DataFrame:
    """AG14 / AG16 — pairwise-complete correlations, long (col_a, col_b, corr); one
    aggregation of the k*(k-1)/2 pairs (the matrix is symmetric) and k variances (its diagonal).  Spearman = Pearson on
    average ranks (:func:`pairwise_ranks`)."""
    cols = list(columns)
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    if method == "spearman":
        df, name = pairwise_ranks(df, cols)
    else:
        name = lambda a, b: a
    r = df.agg(*[F.corr(F.col(name(cols[i], cols[j])).cast("double"), F.col(name(cols[j], cols[i])).cast("double")).alias(f"{i}_{j}") for i, j in pairs])
    parts = ", ".join(f"'{a}', '{b}', `{min(i, j)}_{max(i, j)}`" for i, a in enumerate(cols) for j, b in enumerate(cols))
    return r.selectExpr(f"stack({len(cols) ** 2}, {parts}) as (col_a, col_b, corr)")


def pairwise_ranks(df: DataFrame, cols: list):
    """Average ranks of every column, and for every other column with nulls its ranks among the rows where that one is
    there too; returns a frame of one row per row of ``df`` and a function (column, other) -> name of the rank.

    All ranks come from one long table (row, spec, value): it meets the specs' value counts in one join, whatever the
    number of columns, and its rows are put together again by one grouping.  NaN counts as null.
    """
    held = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"c{i}") for i, c in enumerate(cols)])
    held = materialize(held.withColumn("row", F.monotonically_increasing_id()))
    gaps = held.agg(*[F.count_if(F.col(f"c{i}").isNull()).alias(f"c{i}") for i in range(len(cols))]).first()
    gapped = [i for i in range(len(cols)) if gaps[f"c{i}"]]
    specs = {(i, None): F.col(f"c{i}") for i in range(len(cols))}
    specs |= {(i, j): F.when(F.col(f"c{j}").isNotNull(), F.col(f"c{i}")) for i in range(len(cols)) for j in gapped if i != j}
    number = {s: n for n, s in enumerate(specs)}
    long = held.select("row", F.posexplode(F.array(*specs.values())).alias("spec", "v")).where("v is not null")
    counted = prefix_counts(long.groupBy("spec", "v").agg(F.count("*").alias("n")), ["spec"], "v", "n")
    ranks = counted.select("spec", "v", (F.col("__below") + (F.col("n") + 1) / 2.0).alias("rank"))
    per = long.join(ranks, ["spec", "v"]).groupBy("row").agg(*[F.max(F.when(F.col("spec") == n, F.col("rank"))).alias(f"r{n}") for n in range(len(specs))])
    place = {c: i for i, c in enumerate(cols)}
    return per, lambda a, b: f"r{number[(place[a], place[b] if place[b] in gapped and a != b else None)]}"


def target_correlations(df: DataFrame, features, target: str) -> DataFrame:
    """AG15 — corr(feature, target) per feature with its absolute value."""
    r = df.agg(*[F.corr(F.col(f).cast("double"), F.col(target).cast("double")).alias(f) for f in features])
    parts = ", ".join(f"'{f}', `{f}`" for f in features)
    long = r.selectExpr(f"stack({len(features)}, {parts}) as (feature, corr)")
    return long.withColumn("abs_corr", F.abs("corr"))


def simple_regression(df: DataFrame, y: str, x: str) -> DataFrame:
    """AG17 — slope, intercept, r of y on x."""
    return df.agg(F.regr_slope(F.col(y).cast("double"), F.col(x).cast("double")).alias("slope"),
                  F.regr_intercept(F.col(y).cast("double"), F.col(x).cast("double")).alias("intercept"),
                  F.corr(F.col(y).cast("double"), F.col(x).cast("double")).alias("r"))


def change_distribution(df: DataFrame, value: str, entity="team_name", period="year") -> DataFrame:
    """AG18 — mean / std (ddof 1) of period-over-period changes within entities."""
    w = Window.partitionBy(entity).orderBy(period)
    d = df.select((F.col(value) - F.lag(value).over(w)).alias("__d"))
    return d.agg(F.avg("__d").alias("mean_change"), F.stddev_samp("__d").alias("std_change"),
                 F.count("__d").alias("n_changes"))


def trend_report(df: DataFrame, metrics, min_rows: int = 5, entity="team_name", period="year",
                 threshold: float = 1.0) -> DataFrame:
    """AG19 / AG20 — per entity with >= min_rows periods: OLS slope against the
    row position, last-5 mean, overall mean, improvement, volatility (ddof 0),
    and an improving / declining / stable class for the first metric."""
    w = Window.partitionBy(entity).orderBy(period)
    wd = Window.partitionBy(entity).orderBy(F.desc(period))
    d = df.select(entity, *metrics, (F.row_number().over(w) - 1).alias("__pos"),
                  F.row_number().over(wd).alias("__rd"))
    aggs = [F.count(F.lit(1)).alias("__n")]
    for m in metrics:
        x = F.col(m).cast("double")
        aggs += [F.regr_slope(x, F.col("__pos").cast("double")).alias(f"{m}_trend"),
                 F.avg(F.when(F.col("__rd") <= 5, x)).alias(f"{m}_recent_avg"),
                 F.avg(x).alias(f"{m}_historical_avg"), F.stddev_pop(x).alias(f"{m}_volatility")]
    r = d.groupBy(entity).agg(*aggs).where(F.col("__n") >= min_rows).drop("__n")
    r = r.withColumns({f"{m}_improvement": F.col(f"{m}_recent_avg") - F.col(f"{m}_historical_avg") for m in metrics})
    t = F.col(f"{metrics[0]}_trend")
    return r.withColumn("trend_class", F.when(t >= threshold, "improving").when(t <= -threshold, "declining")
                        .otherwise("stable"))


def rates(df: DataFrame, flags) -> DataFrame:
    """AG21 — mean of each 0/1 flag (achievement rates)."""
    return df.agg(*[F.avg(F.col(f).cast("double")).alias(f"{f}_rate") for f in flags])


def mean_importance(long: DataFrame, feature="feature", value="importance") -> DataFrame:
    """AG22 — average importance per feature across labels / models."""
    return long.groupBy(feature).agg(F.avg(value).alias("mean_importance"), F.count(F.lit(1)).alias("n_labels"))


def histogram(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """AG23 — equal-width histogram over [min, max]; the maximum falls in the
    last bin (``width_bucket`` with the last-bin fix).  min/max = one-row
    aggregate broadcast."""
    st = df.agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    d = attach_scalars(df.where(F.col(value).isNotNull()), st)
    b = F.when(F.col("__hi") == F.col("__lo"), F.lit(1)).otherwise(
        F.least(F.width_bucket(F.col(value).cast("double"), F.col("__lo").cast("double"),
                               F.col("__hi").cast("double"), F.lit(bins)), F.lit(bins)))
    width = (F.col("__hi") - F.col("__lo")) / bins
    return d.withColumn("bin", b.cast("int")).groupBy("bin", "__lo", "__hi").agg(F.count(F.lit(1)).alias("n")) \
        .select("bin", (F.col("__lo") + (F.col("bin") - 1) * width).alias("bin_lo"),
                (F.col("__lo") + F.col("bin") * width).alias("bin_hi"), "n")


def box_stats(df: DataFrame, value: str, group: str) -> DataFrame:
    """AG24 — per group q1, median, q3, whiskers (most extreme data within
    1.5 IQR) and outlier count: a quantile aggregate joined back, then one
    more aggregate."""
    q = quantiles(df, value, [0.25, 0.5, 0.75], [group]).select(
        group, F.col("quantiles")[0].alias("q1"), F.col("quantiles")[1].alias("median"),
        F.col("quantiles")[2].alias("q3"))
    j = df.select(group, F.col(value).cast("double").alias("__v")).join(q, group)
    lo = F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    inside = (F.col("__v") >= lo) & (F.col("__v") <= hi)
    return j.groupBy(group, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("__v"))).alias("whisker_low"), F.max(F.when(inside, F.col("__v"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"))


QQ_PROBS = [i / 100 for i in range(1, 100)]


def qq_points(df: DataFrame, value: str) -> DataFrame:
    """AG25 — 99 sample quantiles against standard-normal quantiles (one
    percentile aggregate; the normal quantiles are constants)."""
    normal = [NormalDist().inv_cdf(p) for p in QQ_PROBS]
    r = quantiles(df, value, QQ_PROBS).withColumnRenamed("quantiles", "__q")
    return r.select(F.posexplode("__q").alias("i", "sample_quantile")).select(
        ((F.col("i") + 1) / 100.0).alias("prob"),
        F.element_at(F.array(*[F.lit(x) for x in normal]), F.col("i") + 1).alias("normal_quantile"),
        "sample_quantile")


def kde(df: DataFrame, value: str, points: int = 100) -> DataFrame:
    """AG27 — Gaussian KDE on an equal grid over [min, max], Scott bandwidth
    (std · n^(-1/5)).  Rows are first collapsed to a value histogram (partial
    aggregation), then each distinct value emits its count-weighted kernel at
    every grid point (``explode`` of a fixed-size sequence, no join): exact,
    with work = distinct values x grid instead of rows x grid."""
    st = df.agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"), F.stddev_samp(value).alias("__sd"),
                F.count(value).alias("__n"))
    hist = df.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("__x")) \
        .agg(F.count(F.lit(1)).alias("__c"))
    d = attach_scalars(hist, st)
    h = F.col("__sd") * F.pow(F.col("__n").cast("double"), -0.2)
    g = F.col("__lo") + (F.col("__hi") - F.col("__lo")) * F.col("k") / (points - 1)
    d = d.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("k"))
    dens = F.col("__c") * F.exp(-0.5 * F.pow((g - F.col("__x")) / h, 2)) / (h * math.sqrt(2 * math.pi))
    return d.groupBy("k").agg(F.first(g).alias("x"), (F.sum(dens) / F.first("__n")).alias("density"))


def distinct_counts(df: DataFrame, columns, approx: bool = False) -> DataFrame:
    """AG28 — distinct counts (exact or HyperLogLog++)."""
    fn = F.approx_count_distinct if approx else F.count_distinct
    return df.agg(*[fn(c).alias(f"n_distinct_{c}") for c in columns])
