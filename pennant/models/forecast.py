"""Per-entity forecasting (ML34-ML37).

* ML34 ARIMA order search (p <= 2, d <= 1, q <= 2) by AIC per entity: a row is
  one entity's series (at most one value per period, so it is bounded), and a
  task fits many series at once (:mod:`pennant.models.arima`).
* ML35 Holt additive trend as an ``aggregate`` fold over the ordered series
  array (JVM-side, exact for fixed alpha/beta).
* ML36 member-forecast ensemble (mean, std ddof 0) and ML37 horizon rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pennant.models.arima import select


def holt(df: DataFrame, value: str, alpha: float = 0.5, beta: float = 0.3, horizon: int = 2,
         entity="team_name", period="year") -> DataFrame:
    """ML35 — level/trend recursion l_t = a y_t + (1-a)(l+b), b_t = b (l_t - l) + (1-b) b;
    start l = y_1, b = y_2 - y_1; forecasts l + h b for h = 1..horizon.
    The series is ordered inside the group with ``array_sort`` on (period,
    value) structs — bounded by the number of periods per entity."""
    g = df.where(F.col(value).isNotNull()).groupBy(entity).agg(
        F.array_sort(F.collect_list(F.struct(F.col(period).alias("t"), F.col(value).cast("double").alias("y"))))
        .alias("__s"), F.max(period).alias("last_period"), F.count(F.lit(1)).alias("n"))
    g = g.where(F.col("n") >= 2)
    ys = F.transform("__s", lambda s: s["y"])
    init = F.struct(F.element_at(ys, 1).alias("l"), (F.element_at(ys, 2) - F.element_at(ys, 1)).alias("b"))
    tail = F.slice(ys, 2, 1 << 20)

    def step(acc, y):
        l_new = F.lit(alpha) * y + F.lit(1 - alpha) * (acc["l"] + acc["b"])
        b_new = F.lit(beta) * (l_new - acc["l"]) + F.lit(1 - beta) * acc["b"]
        return F.struct(l_new.alias("l"), b_new.alias("b"))

    st = g.withColumn("__st", F.aggregate(tail, init, step))
    h = F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h")
    return st.select(entity, "last_period", h, "__st").select(
        entity, (F.col("last_period") + F.col("h")).alias("forecast_period"), "h",
        (F.col("__st.l") + F.col("h") * F.col("__st.b")).alias("forecast"))


def horizon_rows(df: DataFrame, horizon: int = 2, entity="team_name", period="year") -> DataFrame:
    """ML37 — one row per entity and future period (last period + 1 .. + h)."""
    last = df.groupBy(entity).agg(F.max(period).alias("__last"))
    return last.select(entity, F.explode(F.sequence(F.col("__last") + 1, F.col("__last") + horizon))
                       .alias("forecast_period"))


def forecast_ensemble(members: DataFrame, entity="team_name", period="forecast_period", value="forecast") -> DataFrame:
    """ML36 — mean and std (ddof 0) of member forecasts per (entity, period)."""
    return members.groupBy(entity, period).agg(F.avg(value).alias("ensemble_forecast"),
                                               F.stddev_pop(value).alias("ensemble_std"),
                                               F.count(F.lit(1)).alias("n_members"))


def _forecast_chunks(horizon: int, chunk: int = 512):
    """Series in, forecasts of the best order out; a chunk of series is fitted at once."""
    def run(batches):
        for batch in batches:
            for low in range(0, len(batch), chunk):
                part = batch.iloc[low:low + chunk]
                best = select([np.array(s, float) for s in part["series"]], horizon)
                rows = [(name, int(last) + h + 1, h + 1, f, "({},{},{})".format(*b[0]), b[1])
                        for name, last, b in zip(part["entity"], part["last"], best) if b for h, f in enumerate(b[2])]
                yield pd.DataFrame(rows, columns=["entity", "forecast_period", "h", "forecast", "order", "aic"])
    return run


def arima_forecasts(df: DataFrame, value: str, horizon: int = 2, min_rows: int = 10,
                    entity="team_name", period="year") -> DataFrame:
    """ML34 — per-entity order search (p, q <= 2, d <= 1) by AIC of the exact
    likelihood; entities with fewer than ``min_rows`` periods, with a null value,
    or without any variance are skipped.  A series is ordered by (period, value)
    and has one value per row of its entity, so it is bounded by the periods."""
    point = F.struct(F.col(period).alias("t"), F.col(value).cast("double").alias("y"))
    g = df.groupBy(F.col(entity).cast("string").alias("entity")).agg(
        F.array_sort(F.collect_list(point)).alias("s"), F.max(period).alias("last"), F.count_if(F.col(value).isNull()).alias("gaps"))
    g = g.where((F.size("s") >= max(3, min_rows)) & (F.col("gaps") == 0) & F.col("entity").isNotNull())
    g = g.select("entity", F.transform("s", lambda x: x["y"]).alias("series"), F.col("last").cast("int").alias("last"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))   # few bytes but much work: not to be merged by size
    found = g.where(~F.exists("series", lambda v: F.isnan(v))).repartition(parts).mapInPandas(
        _forecast_chunks(horizon), "entity string, forecast_period int, h int, forecast double, order string, aic double")
    return found.withColumnRenamed("entity", entity)
