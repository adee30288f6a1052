"""Joins (JN1-JN6).  Dimension lookups are left joins; literal dimensions are
broadcast explicitly (their size is the literal's), data-derived lookups
are left to AQE (broadcast below the measured threshold, sort-merge with
skew splitting above it)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pennant.config import SHORTENED_SEASONS


def join_with_suffixes(left: DataFrame, right: DataFrame, keys, suffixes=("_actual", "_predicted"),
                       how: str = "inner") -> DataFrame:
    """JN1 — equi-join; overlapping non-key columns get suffixes."""
    keys = list(keys)
    common = (set(left.columns) & set(right.columns)) - set(keys)
    l = left.select(*[F.col(c).alias(c + suffixes[0]) if c in common else F.col(c) for c in left.columns])
    r = right.select(*[F.col(c).alias(c + suffixes[1]) if c in common else F.col(c) for c in right.columns])
    return l.join(r, keys, how)


def shortened_season_dim(spark) -> DataFrame:
    return spark.createDataFrame([(y, g) for y, g in SHORTENED_SEASONS.items()], "year int, season_games int")


def lookup_dims(df: DataFrame, spark, entity_dims: DataFrame, entity="team_name") -> DataFrame:
    """JN2 — chained left lookups: entity -> division -> league (data-derived
    dimension, AQE-chosen strategy) and period -> shortened season length
    (literal dimension, explicit broadcast)."""
    out = df.join(entity_dims, entity, "left")
    out = out.join(F.broadcast(shortened_season_dim(spark)), "year", "left")
    return out.withColumns({"division": F.coalesce("division", F.lit("unknown")),
                            "league": F.coalesce("league", F.lit("unknown"))})


def membership_flag(df: DataFrame, keys_df: DataFrame, keys, out: str) -> DataFrame:
    """JN4 — 0/1 flag for rows whose key is in a (bounded) key set."""
    k = keys_df.select(*keys).distinct().withColumn(out, F.lit(1))
    return df.join(k, list(keys), "left").withColumn(out, F.coalesce(F.col(out), F.lit(0)))


def align_importances(long: DataFrame, models, top: int | None = None, feature="feature") -> DataFrame:
    """JN5 — outer alignment of per-model importances: pivot (explicit model
    list -> no extra job), absent -> 0, mean across models, optional top-n."""
    wide = long.groupBy(feature).pivot("model", list(models)).agg(F.first("importance")).na.fill(0.0)
    mean = sum((F.col(m) for m in models[1:]), F.col(models[0])) / len(models)
    wide = wide.withColumn("mean_importance", mean)
    return wide.orderBy(F.desc("mean_importance"), F.asc(feature)).limit(top) if top else wide


def group_stat_back(df: DataFrame, group: str, value: str, stat: str = "mean") -> DataFrame:
    """JN6 — group statistic broadcast back to rows (``groupby().transform``):
    aggregate + join on the group key."""
    fn = {"mean": F.avg, "std": F.stddev_samp, "max": F.max, "min": F.min, "sum": F.sum}[stat]
    g = df.groupBy(group).agg(fn(value).alias(f"{group}_{stat}_{value}"))
    return df.join(g, group, "left")
