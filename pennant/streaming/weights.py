"""Ensemble weights refreshed with every micro-batch (SS4).

The members are fitted on the oldest slice of the events; the others arrive as a stream in event time.  Micro-batch n
is scored with the weights of version n - 1, read back from the weights table; then the batch's labels give each member
a score, and version n is written: the mean of a member's last ``window`` scores, newer ones weighing more, at least
``floor``, normalised.  Version -1 comes from cross-validation on the members' own slice.  Every version and every
batch's scored rows have a folder of their own, overwritten if the batch is tried again, and a version is made from
versions before it only, so a restarted stream goes on with the same weights.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pennant.functions.safe import div
from pennant.sources.io import scratch_path
from pennant.sources.tables import read_table
from pennant.streaming.scoring import event_features

#: Members: the rate of errors among events of the same value, drawn to the overall rate by SMOOTH imagined events.
MEMBERS = ("hour", "user_id", "k")
SMOOTH = 20.0
_WEIGHTS = "model string, score double, weight double"


def labelled(events: DataFrame) -> DataFrame:
    """Events with the members' features and ``label`` (is it an error?); without a time or a type a row is no example."""
    rows = event_features(events.withColumn("ts", F.col("ts").cast("timestamp"))).where("ts is not null and event_type is not null")
    return rows.select("event_id", "ts", *[F.col(m).cast("long").alias(m) for m in MEMBERS], (F.col("event_type") == "error").cast("long").alias("label"))


def time_slices(rows: DataFrame, slices: int) -> DataFrame:
    """Adds ``slice``: the rows' time range cut into ``slices`` equal stretches."""
    at = F.unix_micros("ts")
    low, high = rows.agg(F.min(at), F.max(at)).first()
    if low is None:
        return rows.withColumn("slice", F.lit(0).cast("long"))
    return rows.withColumn("slice", F.expr(f"(unix_micros(ts) - {low}) * {slices} div {high - low + 1}"))


class RateModel:
    """Smoothed rates of the label by the value of one feature; values never seen have the overall rate."""

    def __init__(self, train: DataFrame, feature: str):
        self.feature = feature
        n, hits = train.agg(F.count("*"), F.sum("label")).first()
        self.base = (hits or 0) / n if n else 0.0
        self.rates = train.where(F.col(feature).isNotNull()).groupBy(feature).agg(
            ((F.sum("label") + SMOOTH * self.base) / (F.count("*") + SMOOTH)).alias("__rate"))

    def score(self, rows: DataFrame, out: str) -> DataFrame:
        """Adds the probability ``out``; the rates are joined by value, however many there are."""
        return rows.join(self.rates, self.feature, "left").withColumn(out, F.coalesce("__rate", F.lit(self.base))).drop("__rate")

    def right(self, p: str) -> Column:
        """Does the decision at the overall rate meet the label?"""
        return ((F.col(p) >= self.base).cast("long") == F.col("label")).cast("double")


def member_scores(scored: DataFrame, models: list[RateModel]) -> list[float | None]:
    """Each member's share of right decisions; nothing (null) without rows."""
    return list(scored.agg(*[F.avg(m.right(f"p_{m.feature}")) for m in models]).first())


def cross_validated(train: DataFrame, k: int = 5) -> list[float | None]:
    """Share of right decisions of each member over k folds (by event id) that its rates were not made from."""
    fold = F.pmod(F.col("event_id"), F.lit(k))
    parts = []
    for f in range(k):
        models = [RateModel(train.where(fold != f), m) for m in MEMBERS]
        held = train.where(fold == f)
        for m in models:
            held = m.score(held, f"p_{m.feature}")
        parts.append(held.select(*[m.right(f"p_{m.feature}").alias(m.feature) for m in models]))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return list(every.agg(*[F.avg(m) for m in MEMBERS]).first())


def normalised(scores: list[float | None], floor: float) -> list[float]:
    held = [max(floor, s or 0.0) for s in scores]
    return [s / sum(held) for s in held]


def recent_mean(scores: list[float]) -> float:
    """Mean with weights from e**-1 for the oldest to 1 for the newest, in equal steps of the exponent (e**-1 for one alone)."""
    n = len(scores)
    w = [math.exp(-1 + i / (n - 1)) if n > 1 else math.exp(-1) for i in range(n)]
    return sum(a * b for a, b in zip(w, scores)) / sum(w)


class OnlineEnsemble:
    """Scores micro-batches and refreshes the weights table: ``weights/batch_id=n``, ``scored/batch_id=n`` under ``base``."""

    def __init__(self, spark: SparkSession, base: str, models: list[RateModel], window: int = 5, floor: float = 0.1):
        self.spark, self.base, self.models, self.window, self.floor = spark, base, models, window, floor

    def save(self, version: int, scores: list[float | None], weights: list[float]) -> None:
        rows = [(m.feature, s, w) for m, s, w in zip(self.models, scores, weights)]
        self.spark.createDataFrame(rows, _WEIGHTS).coalesce(1).write.mode("overwrite").parquet(f"{self.base}/weights/batch_id={version}")

    def version(self, n: int) -> dict:
        """Version n of the weights table: one row per member."""
        got = self.spark.read.schema(_WEIGHTS).parquet(f"{self.base}/weights/batch_id={n}").collect()
        return {r["model"]: r for r in got}

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """A ``foreachBatch`` sink.  A batch without rows leaves the weights as they are, with no score."""
        before = self.version(batch_id - 1)
        rows = batch
        for m in self.models:
            rows = m.score(rows, f"p_{m.feature}")
        vote = sum((F.lit(before[m.feature]["weight"]) * F.col(f"p_{m.feature}") for m in self.models), F.lit(0.0))
        path = f"{self.base}/scored/batch_id={batch_id}"
        rows.withColumn("p", vote).write.mode("overwrite").parquet(path)
        scores = member_scores(self.spark.read.schema(rows.schema).parquet(path), self.models)
        if scores[0] is None:
            self.save(batch_id, scores, [before[m.feature]["weight"] for m in self.models])
            return
        history = [self.version(n) for n in range(max(0, batch_id - self.window + 1), batch_id)]
        recent = [recent_mean([h[m.feature]["score"] for h in history if h[m.feature]["score"] is not None] + [s]) for m, s in zip(self.models, scores)]
        self.save(batch_id, scores, normalised(recent, self.floor))


def replay(rows: DataFrame, slices: int, first: int, path: str) -> DataFrame:
    """A stream of the slices from ``first`` on, one micro-batch each, in order: every slice is one job's one file, and
    a file stream takes files by their time of writing."""
    cut = rows.select(*[c for c in rows.columns if c != "slice"])
    for i in range(first, slices):
        rows.where(F.col("slice") == i).drop("slice").coalesce(1).write.mode("append").parquet(path)
    return rows.sparkSession.readStream.schema(cut.schema).option("maxFilesPerTrigger", 1).parquet(path)


def stream_ensemble_weights(spark: SparkSession, sf_dir: str, slices: int = 8, window: int = 5, floor: float = 0.1) -> DataFrame:
    """SS4 — per micro-batch and member: events, the member's score, the weight used for the batch, the next weight, and the
    mean of the ensemble's probability over the batch."""
    rows = time_slices(labelled(read_table(spark, sf_dir, "events")), slices)
    base = scratch_path(spark, "ss4")
    train = rows.where("slice = 0").drop("slice")
    online = OnlineEnsemble(spark, base, [RateModel(train, m) for m in MEMBERS], window, floor)
    first = cross_validated(train)
    online.save(-1, first, normalised(first, floor))
    q = (replay(rows, slices, 1, f"{base}/in").writeStream.foreachBatch(online.process)
         .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    table = spark.read.schema(_WEIGHTS + ", batch_id long").option("basePath", f"{base}/weights").parquet(f"{base}/weights/batch_id=*")
    per = spark.read.option("basePath", f"{base}/scored").parquet(f"{base}/scored/batch_id=*").groupBy("batch_id").agg(
        F.count("*").alias("n_events"), F.avg("p").alias("mean_p"), F.avg("label").alias("error_rate"))
    used = table.select((F.col("batch_id") + 1).alias("batch_id"), "model", F.col("weight").alias("weight_used"))
    out = table.join(per, "batch_id").join(used, ["batch_id", "model"])
    return out.select("batch_id", "model", "n_events", "score", "weight_used", F.col("weight").alias("weight_next"), "mean_p", "error_rate",
                      div(F.col("weight"), F.col("weight_used")).alias("weight_change"))
