"""Structured Streaming: sources, scoring (SS1).

The original has an online request predictor with a TTL cache and an
online-updated ensemble; here they are streaming queries:

* SS1 scoring (this module): ``readStream`` -> per-row validation split ->
  features -> fitted ``PipelineModel.transform`` -> file sink;
* SS2 request cache and SS3 its running statistics: ``cache``;
* SS4 ensemble weights, refreshed per micro-batch: ``weights``;
* SS5 in-season projection on running totals: ``snapshots``.

Every query runs with ``trigger(availableNow=True)`` and keeps its checkpoint
(offsets + state) in the shared checkpoint folder, so a restarted driver or a
lost executor resumes exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pennant.sources.io import scratch_path
from pennant.sources.tables import read_table, table_path

EVENT_TYPES = ("view", "signup", "click", "error", "purchase")


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files: int = 1) -> DataFrame:
    """Stream one table with its schema; the table is one file or a folder of part files.

    A stream takes a single file only through a pattern, so the path's last letter is written as one."""
    schema = read_table(spark, sf_dir, name).schema
    path = table_path(sf_dir, name)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(f"{path[:-1]}[{path[-1]}]")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # testdata timestamps are TIMESTAMP_NTZ; watermarks need TIMESTAMP (session zone UTC)
    return table_stream(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def run_available(stream: DataFrame, spark: SparkSession, name: str, mode: str = "append") -> DataFrame:
    """Run to completion over everything available into a parquet sink in the
    shared folder; return the sink as a batch DataFrame."""
    base = scratch_path(spark, name)
    q = (stream.writeStream.format("parquet").option("path", f"{base}/out")
         .option("checkpointLocation", f"{base}/checkpoint").outputMode(mode)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")


def event_features(df: DataFrame) -> DataFrame:
    return df.withColumns({"k": F.get_json_object("props", "$.k").cast("double"),
                           "hour": F.hour("ts").cast("double")})


def validate_events(df: DataFrame) -> DataFrame:
    """DQ11 on a stream: per-row error text; valid rows have ``errors = ''``."""
    errs = F.array_compact(F.array(
        F.when(F.col("value").isNull(), F.lit("missing value")),
        F.when(~F.col("event_type").isin(*EVENT_TYPES), F.lit("unknown event type")),
        F.when(F.col("user_id").isNull(), F.lit("missing user"))))
    return df.withColumn("errors", F.concat_ws("; ", errs))


def train_event_model(spark: SparkSession, sf_dir: str):
    """Batch-fitted model applied by the stream (is the event an error?)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    ev = event_features(read_table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")))
    ev = ev.withColumn("label", (F.col("event_type") == "error").cast("double")).na.drop(subset=["value", "k"])
    return Pipeline(stages=[VectorAssembler(inputCols=["value", "k", "hour"], outputCol="features",
                                            handleInvalid="keep"),
                            LogisticRegression(maxIter=50)]).fit(ev)


def stream_scoring(spark: SparkSession, sf_dir: str, model=None) -> DataFrame:
    """SS1."""
    from pyspark.ml.functions import vector_to_array
    model = model or train_event_model(spark, sf_dir)
    s = validate_events(event_features(event_stream(spark, sf_dir)))
    good = s.where(F.col("errors") == "")
    scored = model.transform(good).select("event_id", "user_id", "ts", "event_type",
                                          vector_to_array("probability")[1].alias("p_error"),
                                          F.col("prediction").cast("int").alias("prediction"))
    return run_available(scored, spark, "ss1")
