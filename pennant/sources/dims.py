"""Reference dimensions (eras, playoff structure, season length) as DataFrames
and as generated CASE expressions.

Dimensions are literal tables of a handful of rows (a proven size bound), so
``F.broadcast`` on them is always safe.  For interval lookups the CASE form is
preferred: it needs no join at all and stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pennant.config import GAMES_PER_SEASON, PLAYOFF_STRUCTURE, SHORTENED_SEASONS


def era_case(period: Column, ranges, default: str = "unknown") -> Column:
    """CL13 — first matching closed range [lo, hi], else ``default``."""
    e = None
    for name, lo, hi in ranges:
        cond = period.between(lo, hi)
        e = F.when(cond, F.lit(name)) if e is None else e.when(cond, F.lit(name))
    return e.otherwise(F.lit(default)) if e is not None else F.lit(default)


def era_open_case(period: Column, starts) -> Column:
    """CL14/CL15 — open-ended thresholds: the last era whose start <= period."""
    e = None
    for name, start in reversed(starts):
        if start is None:
            continue
        cond = period >= start
        e = F.when(cond, F.lit(name)) if e is None else e.when(cond, F.lit(name))
    first = starts[0][0]
    return e.otherwise(F.lit(first)) if e is not None else F.lit(first)


def era_dim(spark: SparkSession, ranges) -> DataFrame:
    return spark.createDataFrame([(n, int(lo), int(hi)) for n, lo, hi in ranges],
                                 "era string, lo int, hi int")


def era_range_join(df: DataFrame, spark: SparkSession, ranges, period: str = "year") -> DataFrame:
    """JN3 — interval lookup as a broadcast range join (literal dim, few rows)."""
    d = F.broadcast(era_dim(spark, ranges))
    out = df.join(d, (F.col(period) >= d.lo) & (F.col(period) <= d.hi), "left")
    return out.withColumn("era", F.coalesce(F.col("era"), F.lit("unknown"))).drop("lo", "hi")


def playoff_spots_case(period: Column, steps) -> Column:
    """SC24 — step function of the period (default 2/4/8/10)."""
    e = None
    for start, spots in reversed(steps):
        if start is None:
            continue
        e = F.when(period >= start, F.lit(spots)) if e is None else e.when(period >= start, F.lit(spots))
    base = F.lit(steps[0][1])
    return e.otherwise(base) if e is not None else base


def playoff_structure_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(n, lo, hi, t) for n, lo, hi, t in PLAYOFF_STRUCTURE],
                                 "structure string, lo int, hi int, teams int")


def expected_games(period: Column) -> Column:
    """SC26 — season length: shortened-season lookup, else 162 / 154 / 140 by year."""
    e = None
    for y, g in SHORTENED_SEASONS.items():
        e = F.when(period == y, F.lit(g)) if e is None else e.when(period == y, F.lit(g))
    return (e.when(period >= 1961, F.lit(GAMES_PER_SEASON["modern"]))
            .when(period >= 1904, F.lit(GAMES_PER_SEASON["classic"]))
            .otherwise(F.lit(GAMES_PER_SEASON["early"])))


def is_shortened_season(period: Column) -> Column:
    return period.isin(list(SHORTENED_SEASONS)).cast("int")


def season_dates(period: Column) -> list[Column]:
    """SC28 — nominal season window (Apr 1 .. Oct 31)."""
    return [F.make_date(period, F.lit(4), F.lit(1)).alias("season_start"),
            F.make_date(period, F.lit(10), F.lit(31)).alias("season_end")]
