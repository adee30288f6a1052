"""Sort, limit, top-k and arg-extrema (TK1-TK7).

``orderBy(...).limit(n)`` plans as TakeOrderedAndProject (per-task top-n, then
a final merge of n rows per task); per-group top-n uses ``row_number <= n``
which Spark plans with a partial WindowGroupLimit before the shuffle.  Ties
are always broken by the entity key so results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def order_by_value(df: DataFrame, value: str, entity="team_name") -> DataFrame:
    """TK1 — descending order (total order via the entity tie-break)."""
    return df.orderBy(F.desc(value), F.asc(entity))


def top_n(df: DataFrame, value: str, n: int, largest: bool = True, entity="team_name") -> DataFrame:
    """TK2 — n largest / smallest rows overall."""
    o = F.desc(value) if largest else F.asc(value)
    return df.orderBy(o, F.asc(entity)).limit(n)


def top_n_per_group(df: DataFrame, group, value: str, n: int, entity="team_name") -> DataFrame:
    """TK3 — n largest per group (WindowGroupLimit keeps only n rows per group per task)."""
    w = Window.partitionBy(*group).orderBy(F.desc(value), F.asc(entity))
    return df.withColumn("rank_in_group", F.row_number().over(w)).where(F.col("rank_in_group") <= n)


def rows_of_top_entities(df: DataFrame, value: str, n: int, entity="team_name") -> DataFrame:
    """TK4 — entities with the highest mean value, then all of their rows
    (top-n keys are at most n rows: a left-semi join against them)."""
    top = df.groupBy(entity).agg(F.avg(value).alias("__m")).orderBy(F.desc("__m"), F.asc(entity)).limit(n)
    return df.join(F.broadcast(top.select(entity)), entity, "left_semi")


def largest_errors(df: DataFrame, y="y", yhat="yhat", n: int = 10, keys=("team_name", "year")) -> DataFrame:
    """TK5 — rows with the largest absolute error."""
    return (df.withColumn("abs_error", F.abs(F.col(yhat) - F.col(y)))
            .orderBy(F.desc("abs_error"), *[F.asc(k) for k in keys]).limit(n))


def arg_extremes(df: DataFrame, value: str, keys=("team_name", "year")) -> DataFrame:
    """TK6 — the rows holding the maximum and minimum value (ties -> smallest key),
    via ``max_by`` / ``min_by`` in one aggregation."""
    k = F.struct(*[F.col(c) for c in keys])
    return df.agg(F.min_by(k, F.struct(-F.col(value), k)).alias("__mx"), F.max(value).alias("max_value"),
                  F.min_by(k, F.struct(F.col(value), k)).alias("__mn"), F.min(value).alias("min_value")) \
        .select(*[F.col(f"__mx.{c}").alias(f"argmax_{c}") for c in keys], "max_value",
                *[F.col(f"__mn.{c}").alias(f"argmin_{c}") for c in keys], "min_value")


def predicted_winners(df: DataFrame, prob: str, n: int = 6, threshold: float = 0.5, entity="team_name") -> DataFrame:
    """TK7 — entities predicted positive, first n by probability."""
    return df.where(F.col(prob) > threshold).orderBy(F.desc(prob), F.asc(entity)).limit(n)
