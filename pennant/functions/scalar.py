"""Scalar feature / report expressions (SC25-SC39).  All JVM-side column
expressions: no Python in the hot path, every ``/`` is ``try_divide``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pennant.config import (CONFIDENCE_HIGH, CONFIDENCE_MEDIUM, PROJECTION_CUTS, PROJECTION_LABELS,
                            REPORT_DIVISION_TIERS, REPORT_WIN_TIERS, TIER_CUTS, TIER_LABELS)
from pennant.functions.safe import clip, col, div


def threshold_tier(c, thresholds: dict) -> Column:
    """SC29 — name of the highest named cut point reached (>=), NULL below all."""
    items = sorted(thresholds.items(), key=lambda kv: kv[1], reverse=True)
    e = None
    for name, t in items:
        e = F.when(col(c) >= t, F.lit(name)) if e is None else e.when(col(c) >= t, F.lit(name))
    return e


def performance_tier(c, cuts=TIER_CUTS) -> Column:
    """SC30 — left-closed bins [0,c1) [c1,c2) ... [ck,inf) -> 0..k, clipped at 0."""
    e = F.when(col(c).isNull(), F.lit(None).cast("int"))
    for i, t in reversed(list(enumerate(cuts, start=1))):
        e = e.when(col(c) >= t, F.lit(i))
    return e.otherwise(F.lit(0))


def tier_label(tier, labels=TIER_LABELS) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in labels]), col(tier) + 1)


def projection_category(c, cuts=PROJECTION_CUTS, labels=PROJECTION_LABELS) -> Column:
    """SC31 — right-closed bins (c0,c1] ... (c_{k-1},c_k]; outside (incl. c0) is NULL."""
    e = None
    for lo, hi, lab in zip(cuts[:-1], cuts[1:], labels):
        cond = (col(c) > lo) & (col(c) <= hi)
        e = F.when(cond, F.lit(lab)) if e is None else e.when(cond, F.lit(lab))
    return e


def binary_confidence(p) -> Column:
    """SC32 — 2 * |p - 0.5|."""
    return F.abs(col(p) - 0.5) * 2


def confidence_level(conf, high: float = CONFIDENCE_HIGH, medium: float = CONFIDENCE_MEDIUM,
                     labels=("high", "medium", "low")) -> Column:
    return (F.when(col(conf) >= high, F.lit(labels[0])).when(col(conf) >= medium, F.lit(labels[1]))
            .otherwise(F.lit(labels[2])))


def multiclass_confidence(probs) -> Column:
    """SC32 (multi-class) — max class probability of an array column."""
    return F.array_max(col(probs))


def report_win_tier(c, tiers=REPORT_WIN_TIERS) -> Column:
    """SC33 — projected-wins narrative tier."""
    e = None
    for t, lab in tiers:
        if t is None:
            return e.otherwise(F.lit(lab))
        e = F.when(col(c) >= t, F.lit(lab)) if e is None else e.when(col(c) >= t, F.lit(lab))
    return e


def report_division_tier(p, tiers=REPORT_DIVISION_TIERS) -> Column:
    e = None
    for t, lab in tiers:
        e = F.when(col(p) > t, F.lit(lab)) if e is None else e.when(col(p) > t, F.lit(lab))
    return e


def pythagorean_wins_exp(rs, ra, exponent: float = 2.0, games: int = 162) -> Column:
    """SC34 — games * rs^e / (rs^e + ra^e)."""
    a = F.pow(col(rs).cast("double"), F.lit(float(exponent)))
    b = F.pow(col(ra).cast("double"), F.lit(float(exponent)))
    return div(F.lit(float(games)) * a, a + b)


def implied_counterpart(x, center: float = 750.0, slope: float = 0.5) -> Column:
    """SC35 — 750 + (750 - x) * 0.5."""
    return F.lit(center) + (F.lit(center) - col(x)) * slope


def error_bounds(pred, level: float = 0.95, sigma: float = 10.0, lo: float = 0.0, hi: float = 162.0):
    """SC37 — fixed-error interval ±z·σ (z = 1.96 at 0.95, else 2.58), clipped."""
    z = 1.96 if level == 0.95 else 2.58
    return (clip(col(pred) - z * sigma, lo, hi), clip(col(pred) + z * sigma, lo, hi))


def pace_simple(x, games_played, total: int = 162) -> Column:
    """SC38 — x / gp * total."""
    return div(col(x), col(games_played)) * total


def pace_weighted(x, games_played, total: int = 162, played_weight: float = 0.7,
                  league_average: float = 81.0) -> Column:
    w = F.least(div(col(games_played), F.lit(total)), F.lit(1.0)) * played_weight
    return w * pace_simple(x, games_played, total) + (1 - w) * league_average


def pace_blended(x, games_played, projected, total: int = 162) -> Column:
    w = div(col(games_played), F.lit(total))
    return w * pace_simple(x, games_played, total) + (1 - w) * col(projected)


def standings_adjusted(df: DataFrame, p: str, gb: str, group=(), out: str = "adjusted_probability") -> DataFrame:
    """SC39 — p / (1 + gb/10), rescaled so the (group) sum of p is unchanged.

    The group sums are one aggregate joined back on the group key (AQE picks a
    broadcast when small); with no group, a one-row aggregate is joined on a
    constant key."""
    adj = col(p) * div(F.lit(1.0), 1 + F.coalesce(col(gb), F.lit(0.0)) / 10)
    df = df.withColumn("__adj", adj)
    keys = list(group)
    if not keys:
        df = df.withColumn("__k", F.lit(0))
        keys = ["__k"]
    sums = df.groupBy(*keys).agg(F.sum(p).alias("__sp"), F.sum("__adj").alias("__sa"))
    df = df.join(F.broadcast(sums) if keys == ["__k"] else sums, keys, "left")
    return df.withColumn(out, div(col("__adj"), "__sa") * col("__sp")).drop("__adj", "__sp", "__sa", "__k")
