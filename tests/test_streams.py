"""Streams: request cache, its state, window statistics, online weights, snapshots."""

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from pennant.sources.tables import read_table
from pennant.streaming import cache, scoring, snapshots, weights

from conftest import SF_SMALL

EVENT = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def answered_by_rule(rows, ttl=3600.0):
    """Brute force: event ids answered anew, rows of a key by event time."""
    last, got = {}, set()
    for r in sorted(rows, key=lambda r: (r.ts, r.event_id)):
        k = (r.user_id, r.event_type)
        if k not in last or (r.ts - last[k]).total_seconds() >= ttl:
            last[k] = r.ts
            got.add(r.event_id)
    return got


def batches(df, path, n, order="ts"):
    """Writes ``df`` as n files of equal time ranges whose times of writing follow one another."""
    at = F.unix_micros(F.col(order).cast("timestamp"))
    low, high = df.agg(F.min(at), F.max(at)).first()
    for i in range(n):
        before = set(path.glob("part-*")) if path.exists() else set()
        df.where(F.expr(f"(unix_micros(cast({order} as timestamp)) - {low}) * {n} div {high - low + 1}") == i).coalesce(1).write.mode("append").parquet(str(path))
        for f in set(path.glob("part-*")) - before:
            os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))
    for f in path.glob(".*.crc"):
        f.unlink()


def stream_of(spark, path):
    return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(str(path))


def test_answers_are_the_chain_of_first_rows():
    rng = np.random.default_rng(3)
    for _ in range(50):
        at = np.sort(rng.integers(0, 200, rng.integers(0, 30)))
        last, ttl, want = [None, 20][rng.integers(0, 2)], int(rng.integers(1, 40)), []
        held = last
        for i, t in enumerate(at):
            if held is None or t - held >= ttl:
                held = t
                want.append(i)
        assert cache.answers(at, ttl, last).tolist() == want


def test_stream_dedupe_follows_the_ttl(spark):
    rows = read_table(spark, SF_SMALL, "events").select("user_id", "event_type", "event_id", "ts").collect()
    want = answered_by_rule(rows)
    assert 75 < len(want) <= len(rows)
    assert {r.event_id for r in cache.stream_dedupe(spark, SF_SMALL).collect()} == want
    day = answered_by_rule(rows, 86400.0)
    assert {r.event_id for r in cache.stream_dedupe(spark, SF_SMALL, 86400.0).collect()} == day


def test_streams_read_part_files_in_several_batches(spark, tmp_path):
    """Four part files, one micro-batch each, give the rows of one file."""
    batches(read_table(spark, SF_SMALL, "events"), tmp_path / "events.parquet", 4)
    sf = str(tmp_path)
    ids = lambda df: sorted(r.event_id for r in df.collect())
    assert ids(cache.stream_dedupe(spark, sf)) == ids(cache.stream_dedupe(spark, SF_SMALL))
    stats = lambda d: sorted(map(str, cache.stream_window_stats(spark, d).collect()))
    assert stats(sf) == stats(SF_SMALL)


def test_the_store_holds_no_key_older_than_the_ttl(spark, tmp_path):
    """Keys asked once in the first hours leave the store when the watermark has passed their time to live."""
    day = dt.datetime(2024, 3, 1)
    rows = [(i, day + dt.timedelta(minutes=i), i, "view", 1.0, None) for i in range(60)]
    rows += [(1000 + i, day + dt.timedelta(hours=10 + i), 7, "click", 1.0, None) for i in range(6)]
    batches(spark.createDataFrame(rows, EVENT), tmp_path / "in", 6)
    base = cache.run_cache(spark, stream_of(spark, tmp_path / "in"), 3600.0, name="ttl-test")
    assert {r.event_id for r in spark.read.parquet(f"{base}/out").collect()} == {r[0] for r in rows}
    state = spark.read.format("statestore").option("path", f"{base}/checkpoint").option("stateVarName", "last").load()
    held = [(r.key.user_id, r.value["at"]) for r in state.select("key", "value").collect()]
    end = (day + dt.timedelta(hours=15) - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
    assert [u for u, _ in held] == [7] and all(at + 3_600_000_000 > end for _, at in held)


def test_late_rows_are_answered(spark, tmp_path):
    """Rows behind the watermark are neither lost nor change what later rows get."""
    day = dt.datetime(2024, 3, 1)
    first = [(1, day + dt.timedelta(hours=5), 1, "view", 1.0, None), (2, day + dt.timedelta(hours=9), 2, "view", 1.0, None)]
    late = [(3, day + dt.timedelta(hours=4), 1, "view", 1.0, None),              # its key has left the store: answered
            (4, day + dt.timedelta(hours=8), 2, "view", 1.0, None),              # before the answer that is held: a hit
            (5, day + dt.timedelta(hours=9, minutes=10), 2, "view", 1.0, None), (6, None, 2, "view", 1.0, None), (None, day, 2, "view", 1.0, None)]
    for i, part in enumerate((first, [(9, day + dt.timedelta(hours=9, minutes=1), 3, "view", 1.0, None)], late)):
        spark.createDataFrame(part, EVENT).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        for f in (tmp_path / "in").glob("part-*"):
            if os.path.getmtime(f) > 1_800_000_000 or os.path.getmtime(f) > 1_700_000_010:
                os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))
    for f in (tmp_path / "in").glob(".*.crc"):
        f.unlink()
    base = cache.run_cache(spark, stream_of(spark, tmp_path / "in"), 3600.0, name="late-test")
    assert {r.event_id for r in spark.read.parquet(f"{base}/out").collect()} == {1, 2, 9, 3}


def test_cache_of_no_rows_and_null_fields(spark, tmp_path):
    rows = [(1, dt.datetime(2024, 3, 1), None, None, None, None), (2, dt.datetime(2024, 3, 1, 0, 30), None, None, None, None),
            (3, dt.datetime(2024, 3, 1, 0, 0), None, None, None, None), (4, dt.datetime(2024, 3, 1, 2), None, None, None, None)]
    spark.createDataFrame(rows, EVENT).coalesce(1).write.parquet(str(tmp_path / "in"))
    base = cache.run_cache(spark, stream_of(spark, tmp_path / "in"), 3600.0, name="null-test")
    assert sorted(r.event_id for r in spark.read.parquet(f"{base}/out").collect()) == [1, 4]


def test_weights_use_scores_of_batches_before(spark):
    got = weights.stream_ensemble_weights(spark, SF_SMALL, slices=5, window=2).orderBy("batch_id", "model").collect()
    assert [r.batch_id for r in got] == [b for b in range(4) for _ in weights.MEMBERS]
    by = {(r.batch_id, r.model): r for r in got}
    for b in range(4):
        assert sum(by[b, m].weight_used for m in weights.MEMBERS) == pytest.approx(1)
        held = {m: max(0.1, weights.recent_mean([by[x, m].score for x in range(max(0, b - 1), b + 1)])) for m in weights.MEMBERS}
        for m in weights.MEMBERS:
            assert by[b, m].weight_next == pytest.approx(held[m] / sum(held.values()))
            if b:
                assert by[b, m].weight_used == by[b - 1, m].weight_next
    assert len({round(r.weight_used, 12) for r in got}) > 3


def test_a_batch_tried_again_leaves_the_same_weights(spark, tmp_path):
    rows = weights.time_slices(weights.labelled(read_table(spark, SF_SMALL, "events")), 3)
    online = weights.OnlineEnsemble(spark, str(tmp_path), [weights.RateModel(rows.where("slice = 0"), m) for m in weights.MEMBERS])
    online.save(-1, [0.5, 0.6, 0.7], weights.normalised([0.5, 0.6, 0.7], 0.1))
    for n in (0, 1, 1):
        online.process(rows.where(F.col("slice") == n + 1).drop("slice"), n)
        if n:
            seen = seen if "seen" in dir() else online.version(1)
            assert online.version(1) == seen
    online.process(rows.limit(0).drop("slice"), 2)
    assert {m: r["weight"] for m, r in online.version(2).items()} == {m: r["weight"] for m, r in online.version(1).items()}


def test_snapshot_keeps_the_latest_row_per_key(spark, tmp_path):
    schema = "team string, year int, n long"
    snap = snapshots.Snapshot(spark, str(tmp_path / "s"), schema, ["team", "year"])
    frame = lambda rows: spark.createDataFrame(rows, schema)
    assert snap.read().count() == 0
    snap.fold(frame([("a", 1, 1), ("b", 1, 1), (None, 1, 5)]), 0)
    for _ in range(2):                                                           # the second batch is tried again
        snap.fold(frame([("a", 1, 2), ("c", None, 1)]), 1)
    snap.fold(frame([("c", None, 9), (None, 1, 6)]), 2)
    assert sorted(map(tuple, snap.read().collect()), key=str) == sorted([("a", 1, 2), ("b", 1, 1), (None, 1, 6), ("c", None, 9)], key=str)
    assert len(list((tmp_path / "s").iterdir())) == 2                            # two folders, however many batches


def test_scored_stream_has_probabilities(spark):
    got = scoring.stream_scoring(spark, SF_SMALL)
    assert got.count() > 0 and got.where("p_error < 0 or p_error > 1 or p_error is null").count() == 0
