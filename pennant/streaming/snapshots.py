"""Update-mode output folded into a snapshot (SS5): the latest row per key, however many micro-batches there were.

Two folders take turns: batch n reads the snapshot of batch n - 1 from one and overwrites the other, so a batch that is
tried again finds its input unchanged and leaves the same result.  A reader opens one folder of one row per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pennant.sources.io import scratch_path
from pennant.streaming.scoring import table_stream


class Snapshot:
    """The latest row per key of an update-mode stream."""

    def __init__(self, spark: SparkSession, path: str, schema, keys: list[str]):
        self.spark, self.path, self.schema, self.keys = spark, path, schema, keys
        self.at = -1

    def folder(self, batch_id: int) -> str:
        return f"{self.path}/slot={batch_id % 2}"

    def fold(self, batch: DataFrame, batch_id: int) -> None:
        """A ``foreachBatch`` sink: rows of the batch take the place of the snapshot's rows with their keys (null keys too)."""
        if batch_id:
            before = self.spark.read.schema(self.schema).parquet(self.folder(batch_id - 1))
            new = batch.select(*[F.col(k).alias(f"__{k}") for k in self.keys])
            same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in self.keys]
            batch = batch.unionByName(before.join(new, same, "left_anti"))
        batch.write.mode("overwrite").parquet(self.folder(batch_id))
        self.at = batch_id

    def read(self) -> DataFrame:
        if self.at < 0:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.folder(self.at))


def run_folded(updates: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Runs an update-mode aggregation over everything available; returns the latest row per key."""
    spark = updates.sparkSession
    base = scratch_path(spark, name)
    snapshot = Snapshot(spark, f"{base}/out", updates.schema, keys)
    q = (updates.writeStream.outputMode("update").foreachBatch(snapshot.fold)
         .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return snapshot.read()


def stream_running_totals(spark: SparkSession, sf_dir: str, total_games: int = 162) -> DataFrame:
    """SS5 — running wins / games per (supplier, season) from the line stream in update mode, folded into the current
    standings; pace projection."""
    s = table_stream(spark, sf_dir, "lineitem")
    agg = s.groupBy(F.col("l_suppkey").alias("team_id"), F.year("l_shipdate").cast("int").alias("year")).agg(
        F.count_if(F.col("l_returnflag") != "R").alias("wins"), F.count(F.lit(1)).alias("games"))
    cur = run_folded(agg, ["team_id", "year"], "ss5")
    return cur.withColumn("pace_wins", F.col("wins") / F.col("games") * total_games)
