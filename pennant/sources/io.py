"""Sources and sinks (IO1-IO12).

Files go to the shared folder the cluster names in ``spark.checkpoint.dir``
(or an explicit path); only a local master falls back to a scratch folder.  Readers
take an explicit schema (no inference on the hot path).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pennant.functions.safe import attach_scalars, round_half_up
from pennant.session import checkpoint_dir, materialize

FORMATS = ("csv", "json", "parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/io-{name}-{uuid.uuid4().hex[:12]}"


def load_csv(spark: SparkSession, path: str, schema: StructType, check_empty: bool = True) -> DataFrame:
    """IO1 — CSV with header and an explicit schema; error if absent or empty."""
    df = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)
    if check_empty and df.isEmpty():
        raise ValueError(f"no rows in {path}")
    return df


def load_predictions(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """IO3 — CSV or JSON chosen by suffix, anything else is an error."""
    p = path.rstrip("/").lower()
    r = spark.read.schema(schema) if schema is not None else spark.read
    if p.endswith(".csv"):
        return r.option("header", True).csv(path) if schema is not None else \
            r.option("header", True).option("inferSchema", True).csv(path)
    if p.endswith(".json"):
        return r.json(path)
    raise ValueError(f"unsupported prediction file: {path}")


def save(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None, mode: str = "overwrite") -> str:
    """IO4 / IO5 — csv (with header) / json lines / parquet; anything else is an error."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}")
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)
    return path


def save_report_sheets(predictions: DataFrame, summary: DataFrame, top: DataFrame, base: str) -> dict:
    """IO6 — the three sheets (predictions, summary, top-10) as three datasets."""
    return {name: save(df, f"{base}/{name}", "parquet")
            for name, df in (("predictions", predictions), ("summary", summary), ("top10", top))}


def load_season(df: DataFrame, season: int | None, source: str = "latest", period: str = "year") -> DataFrame:
    """IO7 — ``latest``: rows of the max period; ``historical``: rows of
    ``season`` if present else of the max period; then the period column is
    overwritten with the target season (a scalar aggregate, broadcast)."""
    st = df.agg(F.max(period).alias("__mx"), F.max(F.when(F.col(period) == F.lit(season), 1)).alias("__has"))
    d = attach_scalars(df, st)
    if source == "latest":
        pick = F.col("__mx")
    else:
        pick = F.when(F.col("__has") == 1, F.lit(season)).otherwise(F.col("__mx"))
    target = F.lit(season) if season is not None else F.col("__mx")
    return d.where(F.col(period) == pick).withColumn(period, target.cast("int")).drop("__mx", "__has")


def api_payload(df: DataFrame, milestone_cols, entity="team_name", level: float = 0.95) -> DataFrame:
    """IO8 — nested payload per entity: wins{value, confidence_interval{lower,
    upper, level}}, division_winner{probability, prediction, confidence},
    milestones map built from the ``prob_*`` columns.  A missing interval
    becomes value ± 5, a missing confidence becomes 'Medium'."""
    v = F.col("predicted_wins")
    ci = F.struct(F.coalesce(F.col("win_prediction_lower"), v - 5).alias("lower"),
                  F.coalesce(F.col("win_prediction_upper"), v + 5).alias("upper"), F.lit(level).alias("level"))
    names = [c[len("prob_"):] if c.startswith("prob_") else c for c in milestone_cols]
    return df.select(
        F.col(entity),
        F.struct(v.alias("value"), ci.alias("confidence_interval")).alias("wins"),
        F.struct(F.col("division_winner_probability").alias("probability"),
                 F.col("division_winner_prediction").alias("prediction"),
                 F.coalesce(F.col("division_winner_confidence"), F.lit("Medium")).alias("confidence"))
        .alias("division_winner"),
        F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[F.col(c) for c in milestone_cols]))
        .alias("milestones"))


def payload_json(payload: DataFrame, entity="team_name") -> DataFrame:
    """IO8 — one JSON document per entity (write with ``save(..., 'json')`` or text)."""
    return payload.select(entity, F.to_json(F.struct(*[c for c in payload.columns if c != entity])).alias("json"))


def dense_index(df: DataFrame, order_cols, out: str = "Id", partitions: int | None = None) -> DataFrame:
    """0..n-1 in a declared total order without a single-partition window:
    range-partition (materialised once, so that the counts and the rows see the
    same partition bounds), count rows per partition (one row each,
    prefix-summed), then offset + position within the partition."""
    n = partitions or df.sparkSession.sparkContext.defaultParallelism
    s = materialize(df.repartitionByRange(n, *order_cols).withColumn("__pid", F.spark_partition_id()))
    counts = s.groupBy("__pid").agg(F.count(F.lit(1)).alias("__c"))
    counts = counts.withColumn("__off", F.coalesce(F.sum("__c").over(
        Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))  # one row per partition
    s = s.join(F.broadcast(counts.select("__pid", "__off")), "__pid")
    w = Window.partitionBy("__pid").orderBy(*order_cols)
    return s.withColumn(out, (F.col("__off") + F.row_number().over(w) - 1).cast("long")).drop("__pid", "__off")


def competition_export(df: DataFrame, order_cols=("team_name", "year")) -> DataFrame:
    """IO9 — fixed columns, dense ``Id`` in declared order, predicted wins rounded
    to 1 digit and probability to 4 (engine-neutral half-up rounding)."""
    d = dense_index(df, list(order_cols))
    return d.select("Id", "team_name", "year", round_half_up("predicted_wins", 1).alias("predicted_wins"),
                    round_half_up("division_winner_probability", 4).alias("division_winner_probability"))


def required_projection(df: DataFrame, required) -> DataFrame:
    """IO9 'custom' — projection on required columns, all missing ones reported."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df.select(*required)


def save_model_with_metadata(spark: SparkSession, model, path: str, name: str, features, params: dict) -> str:
    """IO10 — MLlib writer for the model + a one-row metadata table next to it."""
    model.write().overwrite().save(f"{path}/model")
    meta = spark.createDataFrame([(name, type(model).__name__, json.dumps(list(features)),
                                   json.dumps({k: str(v) for k, v in params.items()}))],
                                 "name string, model_class string, features string, params string") \
        .withColumn("saved_at", F.current_timestamp())
    meta.write.mode("overwrite").parquet(f"{path}/metadata")
    return path


def load_model_with_metadata(spark: SparkSession, path: str, loader):
    return loader.load(f"{path}/model"), spark.read.parquet(f"{path}/metadata")


def export_engineered(df: DataFrame, base: str, groups: dict) -> tuple[str, DataFrame]:
    """IO12 — engineered table as parquet (partitioned by period) plus a
    (feature, feature_group) metadata table."""
    save(df, f"{base}/table", "parquet", partition_by=["year"])
    rows = [(f, g) for g, fs in groups.items() for f in fs]
    meta = df.sparkSession.createDataFrame(rows, "feature string, feature_group string")
    save(meta, f"{base}/feature_groups", "parquet")
    return f"{base}/table", meta
