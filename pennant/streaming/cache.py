"""Request cache with a time to live, and its running statistics (SS2, SS3).

The state of a request key is one number, the time of its last answer, in a RocksDB store
(``transformWithState``).  An event-time timer at the end of the time to live takes the key out of the store
once the watermark has passed it, so the store holds the keys answered within the last TTL (plus the watermark's
delay), not every key ever seen.  A key has one timer: when it fires for a key that has been answered again since, it is
set anew, so an answer costs two calls to the store, not one per timer, too.

Late rows have a defined answer and none is lost: Spark would drop rows behind the watermark before the function sees
them, so a row is carried without an event time, and a second, narrow row with the event time and nothing else moves
the watermark and is dropped behind it.  A late row whose key is still held is a hit if its time lies less than the TTL after the last answer,
or before it; if the key has gone, it is answered anew.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from pennant.sources.io import scratch_path
from pennant.streaming.scoring import event_stream
from pennant.streaming.snapshots import run_folded

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Streams started inside keep their state in RocksDB, which timers and state variables need."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def answers(at: np.ndarray, ttl: int, last: int | None) -> np.ndarray:
    """Places in the ascending times ``at`` that are answered anew: the first at least ``ttl`` after the last answer,
    and so on.  One search per answer, not one step per row."""
    out, i = [], 0 if last is None else int(np.searchsorted(at, last + ttl))
    while i < len(at):
        out.append(i)
        i = int(np.searchsorted(at, at[i] + ttl))
    return np.array(out, np.int64)


class RequestCache(StatefulProcessor):
    """Answers of one request key; times are microseconds."""

    def __init__(self, ttl: int):
        self.ttl = ttl

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        own = np.array([(r["at"], r["event_id"]) for r in rows], np.int64).reshape(-1, 2)
        own = own[np.lexsort((own[:, 1], own[:, 0]))]
        held = self.last.get()
        new = answers(own[:, 0], self.ttl, held[0] if held else None)
        if len(new):
            self.last.update((int(own[new[-1], 0]),))
            if not held:                                                        # a key that is held has its timer already
                self.handle.registerTimer(self.end(int(own[new[-1], 0])))
            for at, event_id in own[new].tolist():
                yield Row(request_key=key[0], user_id=key[1], event_type=key[2], event_id=event_id, at=at)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self.last.get()
        if held:
            if self.end(held[0]) <= timerValues.getCurrentWatermarkInMs():
                self.last.clear()
            else:                                                               # answered again since: the timer moves on
                self.handle.registerTimer(self.end(held[0]))
        return iter(())

    def end(self, at: int) -> int:
        """The millisecond at which an answer's time to live is over."""
        return -(-(at + self.ttl) // 1000)

    def close(self) -> None:
        pass


def request_key(cols) -> F.Column:
    """Hash of the request fields in a fixed (sorted) order."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(cols)])), 256)


def answered(stream: DataFrame, ttl_s: float = 3600.0, delay: str = "0 seconds") -> DataFrame:
    """The requests of ``stream`` (``user_id``, ``event_type``, ``event_id``, ``ts``) that are answered anew.

    A key's rows are taken by (time, event id) within a micro-batch, so micro-batches of any size give the same answers
    as long as they follow event time.  Rows without a time or an id are no requests.  A hot key's rows meet in one
    task, as 16 bytes each, one micro-batch at a time.
    """
    ts = F.col("ts").cast("timestamp")
    rows = stream.where("ts is not null and event_id is not null").select(
        request_key(("user_id", "event_type")).alias("request_key"), "user_id", "event_type", "event_id", F.unix_micros(ts).alias("at"), ts.alias("ts"))
    both = rows.select("request_key", "user_id", "event_type", F.inline(F.array(
        F.struct("event_id", "at", F.lit(None).cast("timestamp").alias("clock")),
        F.struct(F.lit(None).cast("long").alias("event_id"), F.lit(None).cast("long").alias("at"), F.col("ts").alias("clock")))))
    # the narrow rows have done their part once the watermark has seen them: only requests are shuffled
    requests = both.withWatermark("clock", delay).where("clock is null")
    return requests.groupBy("request_key", "user_id", "event_type").transformWithState(
        RequestCache(round(ttl_s * 1e6)), "request_key string, user_id long, event_type string, event_id long, at long", "append", "eventTime")


def run_cache(spark: SparkSession, stream: DataFrame, ttl_s: float = 3600.0, delay: str = "0 seconds", name: str = "requests") -> str:
    """Runs the cache over what is available; returns a folder with its answers (``out``) and its state (``checkpoint``)."""
    base = scratch_path(spark, name)
    with rocksdb_state(spark):
        q = (answered(stream, ttl_s, delay).writeStream.format("parquet").option("path", f"{base}/out")
             .option("checkpointLocation", f"{base}/checkpoint").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return base


def stream_dedupe(spark: SparkSession, sf_dir: str, ttl_s: float = 3600.0) -> DataFrame:
    """SS2 — the requests that are answered anew; the others are hits of the cache."""
    base = run_cache(spark, event_stream(spark, sf_dir), ttl_s, name="ss2")
    return spark.read.parquet(f"{base}/out").withColumn("ts", F.timestamp_micros("at")).drop("at")


def stream_window_stats(spark: SparkSession, sf_dir: str, window: str = "1 day") -> DataFrame:
    """SS3 — per tumbling window of event time: total, hits, misses, hit rate, errors, error rate, mean value.

    Two streams in update mode, one over the requests and one over the cache's answers (the misses); each folds its
    updated windows into a snapshot, and the two snapshots meet at the end.  State and snapshots hold one row per
    window.  No row is too late for its window.
    """
    bounds = [F.date_format(f"window.{c}", "yyyy-MM-dd HH:mm:ss").alias(f"window_{c}") for c in ("start", "end")]
    requests = event_stream(spark, sf_dir).where("ts is not null and event_id is not null").groupBy(F.window("ts", window)).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("event_type") == "error").alias("errors"),
        # a decimal sum, so that the mean doesn't depend on the order in which batches arrive
        F.try_divide(F.sum(F.col("value").cast("decimal(20,6)")).cast("double"), F.count("value")).alias("mean_value"))
    requests = run_folded(requests.select(*bounds, "total", "errors", "mean_value"), ["window_start"], "ss3-requests")
    path = f"{run_cache(spark, event_stream(spark, sf_dir), name='ss3')}/out"
    log = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path).withColumn("ts", F.timestamp_micros("at"))
    missed = run_folded(log.groupBy(F.window("ts", window)).agg(F.count(F.lit(1)).alias("misses")).select(bounds[0], "misses"),
                        ["window_start"], "ss3-misses")
    both = requests.join(missed, "window_start", "left").withColumn("misses", F.coalesce("misses", F.lit(0).cast("long")))
    hits = F.col("total") - F.col("misses")
    return both.select("window_start", "window_end", "total", hits.alias("hits"), "misses", (hits / F.col("total")).alias("hit_rate"),
                       "errors", (F.col("errors") / F.col("total")).alias("error_rate"), "mean_value")
