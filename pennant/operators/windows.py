"""Window operators beyond the feature pipeline (WN16-WN26).

Entity windows (``partitionBy(entity).orderBy(period)``) are bounded by the
number of periods per entity; group-wide quantities over low-cardinality keys
(period, era, whole frame) are aggregates joined back, never a window whose
partition is a whole period or era.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pennant.functions.safe import div
from pennant.operators.ranking import group_rank, quantiles


def _w(entity: str, period: str):
    return Window.partitionBy(entity).orderBy(period)


def lags(df: DataFrame, columns, ns=(1, 2, 3), entity="team_name", period="year") -> DataFrame:
    """WN1 / WN24 — ``prev_<c>`` (lag 1) and ``prev<n>_<c>`` on one window spec."""
    w = _w(entity, period)
    ex = {}
    for c in columns:
        for n in ns:
            ex["prev_" + c if n == 1 else f"prev{n}_{c}"] = F.lag(c, n).over(w)
    return df.withColumns(ex)


def division_rank(df: DataFrame, group, value: str, out: str = "division_rank") -> DataFrame:
    """WN16 — rank descending, ties get the minimum rank (histogram based)."""
    return group_rank(df, [(list(group), value, out, "min", True)])


def rank_comparison(df: DataFrame, group, actual: str, predicted: str) -> DataFrame:
    """WN17 — average rank (descending) of actual and predicted, and their difference."""
    r = group_rank(df, [(list(group), actual, "actual_rank", "average", True),
                        (list(group), predicted, "predicted_rank", "average", True)])
    return r.withColumn("rank_difference", F.col("actual_rank") - F.col("predicted_rank"))


def centered_mean(df: DataFrame, value: str, width: int = 5, entity="team_name", period="year",
                  out: str | None = None) -> DataFrame:
    """WN18 — centred moving average, only full windows (pandas ``center=True``).
    An even width w covers rows [-w/2, w/2 - 1]."""
    lo, hi = -(width // 2), (width - 1) // 2 if width % 2 == 0 else width // 2
    frame = _w(entity, period).rowsBetween(lo, hi)
    return df.withColumn(out or f"{value}_cma{width}",
                         F.when(F.count(value).over(frame) == width, F.avg(value).over(frame)))


def decompose(df: DataFrame, value: str, model: str = "additive", entity="team_name", period="year") -> DataFrame:
    """WN19 — trend = centred mean with width min(5, n // 2) per entity; residual
    = value - trend (additive) or value / trend (multiplicative)."""
    w = _w(entity, period)
    n = F.count(F.lit(1)).over(Window.partitionBy(entity))
    trend = None
    for width in (1, 2, 3, 4, 5):
        lo, hi = -(width // 2), ((width - 1) // 2 if width % 2 == 0 else width // 2)
        frame = w.rowsBetween(lo, hi)
        t = F.when(F.count(value).over(frame) == width, F.avg(value).over(frame))
        cond = F.least(F.lit(5), F.floor(n / 2)) == width
        trend = F.when(cond, t) if trend is None else trend.when(cond, t)
    df = df.withColumn("trend", trend)
    resid = (F.col(value) - F.col("trend")) if model == "additive" else div(value, "trend")
    return df.withColumn("residual", resid)


def detrended(df: DataFrame, value: str, width: int = 5, entity="team_name", period="year") -> DataFrame:
    """WN20 — value minus its full-window centred mean."""
    df = centered_mean(df, value, width, entity, period, out="__cma")
    return df.withColumn(f"{value}_detrended", F.col(value) - F.col("__cma")).drop("__cma")


def percentile_flag(df: DataFrame, value: str, group: str, q: float = 0.75, out: str = "playoff_proxy") -> DataFrame:
    """WN21 — value >= exact q-quantile of its group (aggregate joined back)."""
    t = quantiles(df, value, [q], [group]).select(group, F.col("quantiles")[0].alias("__q"))
    return df.join(t, group, "left").withColumn(out, (F.col(value) >= F.col("__q")).cast("int")).drop("__q")


def trailing_mean(df: DataFrame, value: str, width: int, entity="team_name", period="year",
                  out: str | None = None) -> DataFrame:
    """WN22 — moving average including the current row, full windows only."""
    frame = _w(entity, period).rowsBetween(-(width - 1), 0)
    return df.withColumn(out or f"{value}_ma_{width}",
                         F.when(F.count(value).over(frame) == width, F.avg(value).over(frame)))


def group_relative(df: DataFrame, value: str, group: str, mean_out: str, rel_out: str) -> DataFrame:
    """WN23 — group mean (aggregate + join) and value / group mean."""
    m = df.groupBy(group).agg(F.avg(value).alias(mean_out))
    return df.join(m, group, "left").withColumn(rel_out, div(value, mean_out))


def min_max_normalize(df: DataFrame, columns, suffix: str = "_norm") -> DataFrame:
    """WN25 — (x - min) / (max - min) with global min/max (one-row aggregate, broadcast)."""
    st = df.agg(*[a for c in columns for a in (F.min(c).alias(f"__lo_{c}"), F.max(c).alias(f"__hi_{c}"))])
    out = df.withColumn("__k", F.lit(1)).join(F.broadcast(st.withColumn("__k", F.lit(1))), "__k", "left")
    out = out.withColumns({f"{c}{suffix}": div(F.col(c) - F.col(f"__lo_{c}"), F.col(f"__hi_{c}") - F.col(f"__lo_{c}"))
                           for c in columns})
    return out.drop("__k", *[f"__{k}_{c}" for c in columns for k in ("lo", "hi")])


def exp_weighted_recent(df: DataFrame, value: str, n_last: int = 5, entity="team_name", period="year",
                        out: str = "ewm_recent") -> DataFrame:
    """WN26 — weighted mean of an entity's last N values, weights exp(linspace(-1, 0, m))
    in chronological order (m = values kept; m = 1 gives weight e^-1).  The
    ``row_number <= N`` filter is planned with a partial WindowGroupLimit."""
    wd = Window.partitionBy(entity).orderBy(F.desc(period))
    last = df.where(F.col(value).isNotNull()).select(entity, period, value) \
        .withColumn("__rn", F.row_number().over(wd)).where(F.col("__rn") <= n_last)
    m = F.count(F.lit(1)).over(Window.partitionBy(entity))
    last = last.withColumn("__m", m)
    pos = (F.col("__m") - F.col("__rn")).cast("double")                     # 0 = oldest kept
    x = F.when(F.col("__m") > 1, F.lit(-1.0) + pos / (F.col("__m") - 1)).otherwise(F.lit(-1.0))
    last = last.withColumn("__wt", F.exp(x))
    return last.groupBy(entity).agg(
        div(F.sum(F.col("__wt") * F.col(value)), F.sum("__wt")).alias(out), F.max("__m").alias("n_used"))
