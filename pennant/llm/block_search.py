"""Nearest vectors by a block matrix join.

Candidates and queries are packed into blocks of bounded size; every query block meets every block of candidates in
an equality join on the stripe number (query blocks are repeated once per stripe, candidates move once).  A tile is a
matrix product of int8 codes: each vector is scale * codes + rest, so the inner product differs from the product of
the codes by at most |q codes| * |c rest| + |q rest| * |c| (Cauchy-Schwarz, with a margin for rounding).  Per query the
20th largest lower bound of the tile is a threshold that no true neighbour can lie below; the pairs whose upper bound
reaches it are computed again in double precision from the original vectors.  A task folds its tiles into k rows per
query and stripe; heaps of k merge those.

Within a block a repeated row counts once, and of equal vectors only the k + 1 with the smallest ids can be among
anyone's k nearest, so a vector that holds a third of all rows costs k + 1 rows a block.  The result is exact.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pennant.llm.common import written

BLOCK = 4096
#: Pairs computed again at once, so that memory is bounded.
_PAIRS = 200_000
#: Query blocks whose nearest so far a task holds (some 1.3 MB each); beyond that the oldest is emitted early.
_HELD = 64


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, lengths of scale * codes, lengths of what is left of each row."""
    scale = np.maximum(np.abs(x).max(axis=1), 1e-300) / 127
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    back = codes * scale[:, None]
    return codes, scale, np.linalg.norm(back, axis=1), np.linalg.norm(x - back, axis=1)


def tile(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int):
    """Exact k nearest of this tile: arrays of places in q, candidate ids, scores; own rows are left out."""
    qc, qs, qn, qr = quantise(q)
    cc, cs, cn, cr = quantise(c)
    rows, ids, scores = [], [], []
    cf, cs_ = cc.astype(np.float32), cs[None, :]
    whole = np.linalg.norm(c, axis=1)
    for low in range(0, len(q), 512):
        own = slice(low, low + 512)
        # products of codes are whole numbers below 2 ** 24 up to 1040 dimensions: exact in single precision
        mid = (qc[own].astype(np.float32) @ cf.T).astype(np.float64) * (qs[own][:, None] * cs_)
        off = (qn[own][:, None] * cr[None, :] + qr[own][:, None] * whole[None, :]) * (1 + 1e-9) + 1e-12 * (qn[own][:, None] + 1) * (cn[None, :] + 1)
        if q.shape[1] > 1000:
            off += np.abs(mid) * 1e-5
        lower = mid - off
        lower[q_ids[own][:, None] == c_ids[None, :]] = -np.inf
        upper = mid + off
        upper[lower == -np.inf] = -np.inf
        if lower.shape[1] > k:
            floor = np.partition(lower, lower.shape[1] - k, axis=1)[:, -k]
            keep = upper >= floor[:, None]
        else:
            keep = np.ones(upper.shape, bool)
        keep &= upper > -np.inf
        a, b = np.nonzero(keep)
        for at in range(0, len(a), _PAIRS):
            i, j = a[at:at + _PAIRS], b[at:at + _PAIRS]
            rows.append(i + low)
            ids.append(c_ids[j])
            scores.append((q[i + low] * c[j]).sum(axis=1))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    row, cid, score = np.concatenate(rows), np.concatenate(ids), np.concatenate(scores)
    order = np.lexsort((cid, -score, row))
    row, cid, score = row[order], cid[order], score[order]
    start = np.searchsorted(row, row)
    best = np.arange(len(row)) - start < k
    return row[best], cid[best], score[best]


def _blocks(size: int, stripes: int, k: int, queries: bool):
    """Packs rows (id, vector, is_query) into blocks of equal length vectors: ``stripe``, ``dim``, ``ids``, ``data``.

    Of candidates equal to one another a block keeps the k + 1 smallest ids; a query block is emitted for every stripe.
    """
    def packed(ids, rows, dim, number):
        x = np.stack(rows)
        own = np.array(ids, np.int64)
        order = np.argsort(own, kind="stable")
        own, x = own[order], x[order]
        if not queries:
            same = np.unique(x, axis=0, return_inverse=True)[1].reshape(-1)
            once = np.unique(np.stack([own, same], 1), axis=0, return_index=True)[1]     # a row that repeats is one
            own, x, same = own[once], x[once], same[once]
            by = np.argsort(same, kind="stable")
            rank = np.empty(len(by), np.int64)
            rank[by] = np.arange(len(by)) - np.searchsorted(same[by], same[by])
            own, x = own[rank <= k], x[rank <= k]
        for s in range(stripes) if queries else [number % stripes]:
            yield s, dim, own.tobytes(), x.astype("<f8").tobytes()

    def run(batches):
        from pyspark import TaskContext

        waiting, number = {}, TaskContext.get().partitionId()
        out = []
        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not v or any(x is None for x in v):
                    continue
                x = np.array(v, np.float64)
                if not np.isfinite(x).all() or not x.any():
                    continue
                ids, rows = waiting.setdefault(len(x), ([], []))
                ids.append(i)
                rows.append(x)
                if len(ids) >= size:
                    for row in packed(ids, rows, len(x), number):
                        yield _record([row])
                    waiting.pop(len(x))
                    number += 1
        for dim, (ids, rows) in waiting.items():
            out += packed(ids, rows, dim, number)
            number += 1
        yield _record(out)
    return run


def _record(rows):
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["stripe", "dim", "ids", "data"])


def nearer(a: tuple, b: tuple, k: int) -> tuple:
    """The k nearest of each row from two sets of (row, candidate id, score) arrays; what is in both counts once."""
    row, cid, score = (np.concatenate(x) for x in zip(a, b))
    order = np.lexsort((cid, -score, row))
    row, cid, score = row[order], cid[order], score[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (cid[1:] != cid[:-1]) | (score[1:] != score[:-1])
    row, cid, score = row[new], cid[new], score[new]
    best = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[best], cid[best], score[best]


def _tiles(k: int):
    """Tiles of a stripe, folded in the task: k rows per query and stripe, however many blocks of candidates it has."""
    def run(batches):
        held: dict[bytes, tuple] = {}

        def emit(ids):
            row, cid, score = held.pop(ids)
            return pa.record_batch([pa.array(np.frombuffer(ids, np.int64)[row]), pa.array(cid), pa.array(score)], names=["query_id", "vec_id", "score"])

        for batch in batches:
            for dim, qi, qd, ci, cd in zip(*[batch.column(i).to_pylist() for i in range(5)]):
                q_ids, c_ids = np.frombuffer(qi, np.int64), np.frombuffer(ci, np.int64)
                got = tile(q_ids, np.frombuffer(qd).reshape(-1, dim), c_ids, np.frombuffer(cd).reshape(-1, dim), k)
                held[qi] = nearer(held.pop(qi), got, k) if qi in held else got
                if len(held) > _HELD:
                    yield emit(next(iter(held)))
        for ids in list(held):
            yield emit(ids)
    return run


def _heaps(k: int):
    """Merges the tiles' rows of whole queries (partitioned and sorted by query) with a heap of k a query."""
    def run(batches):
        query, heap = None, []

        def done():
            best = sorted(heap, reverse=True)
            return [(query, n + 1, -i, s) for n, (s, i) in enumerate(best)]

        out = []
        for batch in batches:
            for q, i, s in zip(*[batch.column(c).to_pylist() for c in range(3)]):
                if q != query:
                    out += done()
                    query, heap = q, []
                if len(heap) < k:
                    heapq.heappush(heap, (s, -i))
                elif (s, -i) > heap[0]:
                    heapq.heapreplace(heap, (s, -i))
            yield _ranked(out)
            out = []
        yield _ranked(done())
    return run


def _ranked(rows):
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.float64()]
    return pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["query_id", "rank", "vec_id", "score"])


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", block: int = BLOCK) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the k candidates of largest inner product for each query.

    All rows are candidates, but not a query's own id.  Vectors that are null, empty, zero or hold null or non-finite
    components take no part, nor do rows without an id; vectors of different lengths are never compared.  Ties go to
    the smaller id.  Rows that repeat an id and vector count once.  An id with several vectors is a candidate with each
    of them, and as a query stands for the smallest by components.  An empty table gives an empty result.
    """
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    rows = rows.where("id is not null and v is not null")
    spark = vectors.sparkSession
    stripes = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)
    kind = "stripe int, dim int, ids binary, data binary"
    candidates = rows.select("id", "v").mapInArrow(_blocks(block, stripes, k, False), kind)
    sound = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    asked = rows.where("q").where(sound).groupBy("id").agg(F.min("v").alias("v"))
    queries = asked.mapInArrow(_blocks(block, stripes, k, True), kind)
    c = written(candidates, "block-candidates").withColumnsRenamed({"ids": "c_ids", "data": "c_data"})
    q = written(queries, "block-queries").withColumnsRenamed({"ids": "q_ids", "data": "q_data"})
    tiles = q.hint("shuffle_hash").join(c, ["stripe", "dim"]).select("dim", "q_ids", "q_data", "c_ids", "c_data")
    found = tiles.mapInArrow(_tiles(k), "query_id long, vec_id long, score double").distinct()
    return found.repartition("query_id").sortWithinPartitions("query_id").mapInArrow(_heaps(k), "query_id long, rank int, vec_id long, score double")
