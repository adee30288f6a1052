"""Removal of repeated 100-byte strings over a whole corpus, by prefix-free parsing.

The parse.  A rolling hash over ``GRAM`` bytes triggers where it is the smallest among the places a 100-byte string
can hold it at (the first, if several are), so every string of 100 bytes has exactly one trigger inside it, and equal
strings have it at the same place.  The stretch of strings that share a trigger is a phrase: at most 173 bytes that
overlap the next phrase, and no phrase's suffix of 100 bytes goes on differently elsewhere under the same trigger
without being another phrase.  Each phrase of the corpus is a row: trigger hash, phrase hash, place.

The dictionary is the distinct phrases, each with its first place in the corpus.  Every later place of a phrase is
removed as a whole: all its strings start earlier.  Equal strings in different phrases share the trigger and, with it,
the 64 bytes from the trigger on or the 64 bytes that end with it; only dictionary phrases that share such a half with
another one need their suffixes ranked.  Their suffixes, cut to 100 bytes, are ordered by (128-bit hash, place), an
order in which equal suffixes stand together in corpus order as they would in the suffix array; of each class all but
the first go.  The order between different classes decides nothing here, so hashes stand in for letters.

Spark moves phrases in blobs dealt by trigger hash.  Each task first combines what it has itself (later places of the
same phrase become spans at once), so a passage that a third of all documents hold sends one row per task.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pennant.llm.common import written
from pennant.llm.hashing import mix64, powers, text_bytes

LENGTH, GRAM = 100, 28
_REACH = LENGTH - GRAM + 1
_HALF = _REACH // 2
_STEP = 1 << 18
_SHIFT = np.uint64(21)
_BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)
_POW = [powers(b, _STEP + 4 * LENGTH) for b in _BASES]
_INV = [powers(pow(b, -1, 2 ** 64), _STEP + 4 * LENGTH) for b in _BASES]
#: Bytes of text whose phrases go to one bucket, which one task holds at a time.
BUCKET_BYTES = 4 << 20
LAST = 2 ** 63 - 1


class Rolling:
    """Hashes of any substring of a stretch of bytes, from sums of byte * base ** place modulo 2 ** 64."""

    def __init__(self, data: np.ndarray, which: int = 0):
        self.inverse = _INV[which]
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _POW[which][:len(data)], out=self.sums[1:])

    def at(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * self.inverse[start])

    def every(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return mix64((self.sums[size:] - self.sums[:n]) * self.inverse[:n])


def smallest_within(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[:len(x) - (width - done)], x[width - done:]) if width > done else x


def phrases(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """All phrases of texts laid one after another, as arrays: text number, trigger's place in the text, how far before
    the trigger the first and the last string start, hash of trigger, of phrase, 16 bits of the left and the right half
    (0: the phrase has no string that holds it)."""
    out = []
    for x in range(0, max(0, len(raw) - LENGTH + 1), _STEP):
        data = raw[x:x + _STEP + LENGTH - 1]
        n = len(data) - LENGTH + 1
        d0 = int(np.searchsorted(ends, x, side="right"))
        d1 = int(np.searchsorted(starts, x + n, side="left"))
        bounds = np.clip(np.append(starts[d0:d1], ends[d1 - 1]) - x, 0, n)
        owner = np.repeat(np.arange(d0, d1), np.diff(bounds))
        good = np.arange(n) + LENGTH <= np.repeat(ends[d0:d1] - x, np.diff(bounds))
        roll = Rolling(data)
        gram = roll.every(GRAM)
        place = smallest_within((gram >> _SHIFT << _SHIFT) | np.arange(len(gram), dtype=np.uint64), _REACH)
        place = (place & np.uint64((1 << int(_SHIFT)) - 1)).astype(np.int64)
        turn = np.ones(n + 1, bool)
        turn[1:-1] = (place[1:] != place[:-1]) | ~good[1:] | ~good[:-1]
        first, last = np.flatnonzero(good & turn[:-1]), np.flatnonzero(good & turn[1:])
        a = place[first]
        far, near = a - first, a - last
        whole = roll.at(first, last + LENGTH) ^ mix64((far * 128 + near).astype(np.uint64))
        left, right = far >= _HALF, near <= _HALF
        lo, hi = np.where(left, a - _HALF, a), np.where(right, a + LENGTH - _HALF, a)
        half = lambda s, e, has: np.where(has, (roll.at(s, e) >> np.uint64(48)) | np.uint64(1), 0).astype(np.uint16)
        doc = owner[first]
        out.append((doc, a + x - starts[doc], far, near, gram[a], whole, half(lo, a, left), half(a, hi, right)))
    kinds = (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64, np.uint16, np.uint16)
    return [np.concatenate([o[i] for o in out]) if out else np.zeros(0, k) for i, k in enumerate(kinds)]


_PHRASE = (("doc", "<i8"), ("text", "<u4"), ("at", "<i4"), ("far", "u1"), ("near", "u1"), ("gram", "<u8"), ("whole", "<u8"), ("left", "<u2"), ("right", "<u2"))
_SUFFIX = (("doc", "<i8"), ("text", "<u4"), ("at", "<i4"), ("one", "<u8"), ("two", "<u8"))
_SPAN = (("doc", "<i8"), ("text", "<u4"), ("start", "<i4"), ("end", "<i4"))


def _blob(columns: dict, own: np.ndarray, layout) -> bytes:
    return pa.compress(len(own).to_bytes(8, "little") + b"".join(columns[c][own].astype(t).tobytes() for c, t in layout), "zstd", asbytes=True)


def _unblob(blobs: list[tuple[int, bytes]], layout) -> dict:
    parts = {c: [] for c, _ in layout}
    for size, z in blobs:
        data, at = pa.decompress(z, size, "zstd", asbytes=True), 8
        n = int.from_bytes(data[:8], "little")
        for c, t in layout:
            parts[c].append(np.frombuffer(data, t, n, at))
            at += n * np.dtype(t).itemsize
    return {c: np.concatenate(p) if p else np.zeros(0, t) for (c, t), p in zip(layout, parts.values())}


def _size(n: int, layout) -> int:
    return 8 + n * sum(np.dtype(t).itemsize for _, t in layout)


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of spans given in order of their starts; touching ones are one run."""
    if not len(start):
        return start, end
    top = np.maximum.accumulate(end)
    cut = np.flatnonzero(start[1:] > top[:-1])
    return start[np.append(0, cut + 1)], top[np.append(cut, len(top) - 1)]


_ROW = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("doc", pa.int64()), ("text", pa.int64()), ("size", pa.int64()), ("data", pa.binary())])
ROW = "kind int, bucket int, doc long, text long, size long, data binary"
PHRASES, SPANS, RANGES, TEXTS = 0, 1, 2, 3


def _records(rows):
    for low in range(0, len(rows), 5000):
        part = rows[low:low + 5000]
        yield pa.record_batch([pa.array([r[i] for r in part], _ROW.field(i).type) for i in range(6)], schema=_ROW)


def _deal(columns: dict, keep: np.ndarray, key: np.ndarray, buckets: int, layout, kind: int = PHRASES) -> list:
    """Rows of kept entries, one blob per bucket."""
    bucket = (mix64(key[keep].astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    keep, bucket = keep[order], bucket[order]
    at = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(keep) else []
    return [(kind, int(bucket[a]), None, None, _size(b - a, layout), _blob(columns, keep[a:b], layout))
            for a, b in zip(at, np.append(at[1:], len(keep)))]


def _deal_spans(doc, text, start, end, buckets: int, kind: int = SPANS) -> list:
    """Spans, merged in each document and dealt by document."""
    order = np.lexsort((start, text, doc))
    doc, text, start, end = doc[order], text[order], start[order].astype(np.int64), end[order].astype(np.int64)
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (text[1:] != text[:-1])
    number = np.cumsum(new) - 1
    shift = number << 32                              # documents after one another on one line, so that one pass merges all
    s, e = merged(start + shift, end + shift)
    own = np.flatnonzero(new)[s >> 32] if len(s) else np.zeros(0, np.int64)
    c = {"doc": doc[own], "text": text[own], "start": s & 0xFFFFFFFF, "end": e & 0xFFFFFFFF}
    return _deal(c, np.arange(len(s)), c["doc"].astype(np.int64), buckets, _SPAN, kind)


def _firsts(keys: list[np.ndarray], c: dict) -> tuple[np.ndarray, np.ndarray]:
    """The entries that come first in the corpus among those of equal keys, and those at a later place (an entry at
    the very place of the first, from a repeated row, is neither)."""
    order = np.lexsort((c["at"], c["text"], c["doc"], *keys))
    first = np.zeros(len(order), bool)
    first[:1] = True
    for k in keys:
        first[1:] |= k[order[1:]] != k[order[:-1]]
    head = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
    later = np.zeros(len(order), bool)
    for k in ("doc", "text", "at"):
        later |= c[k][order] != c[k][head]
    return order[first], order[later]


def _parse(buckets: int):
    def run(batches):
        for batch in batches:
            docs = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            raw, starts, ends = text_bytes(batch.column(1))
            text = np.array([zlib.crc32(raw[a:b]) for a, b in zip(starts, ends)], np.int64)
            low = 0
            while low < len(starts):                  # some 16 MB of text at a time
                high = max(low + 1, int(np.searchsorted(ends, starts[low] + (16 << 20), side="right")))
                o = starts[low]
                doc, at, far, near, gram, whole, left, right = phrases(raw[o:ends[high - 1]], starts[low:high] - o, ends[low:high] - o)
                c = {"doc": docs[low:high][doc], "text": text[low:high][doc], "at": at, "far": far, "near": near, "gram": gram,
                     "whole": whole, "left": left, "right": right}
                first, again = _firsts([whole, gram], c)
                rows = _deal_spans(c["doc"][again], c["text"][again], (at - far)[again], (at - near)[again] + LENGTH, buckets)
                kept = np.sort(first)                 # in text order, which compresses well
                yield from _records(rows + _deal(c, kept, gram, buckets, _PHRASE))
                low = high
    return run


def _buckets(work):
    """Runs ``work`` over the blobs of one bucket after the other; other rows pass through."""
    def run(batches):
        bucket, blobs = None, []
        for batch in batches:
            kind, number = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            passed = []
            for i, (k, b) in enumerate(zip(kind, number)):
                if k != PHRASES:
                    passed.append(i)
                    continue
                if b != bucket:
                    yield from _records(work(blobs))
                    bucket, blobs = b, []
                blobs.append((batch.column(4)[i].as_py(), batch.column(5)[i].as_py()))
            if passed:
                yield batch.take(pa.array(passed, pa.int64()))
        yield from _records(work(blobs))
    return run


def _with_spans(batches):
    """Texts of each bucket with their spans (which come first in a bucket): ``doc``, ``text``, bytes, starts, ends."""
    bucket, blobs, c = None, [], None
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(5)]
        for i, (kind, b, doc, text, size) in enumerate(zip(*columns)):
            if b != bucket:
                bucket, blobs, c = b, [], None
            if kind != TEXTS:
                blobs.append((size, batch.column(5)[i].as_py()))
                continue
            if c is None:
                c = _unblob(blobs, _SPAN)
                order = np.lexsort((c["start"], c["text"], c["doc"]))
                c = {k: v[order] for k, v in c.items()}
                blobs = []
            low, high = np.searchsorted(c["doc"], (doc, doc + 1) if doc < LAST else (doc, doc), side="left")
            if doc == LAST:
                high = len(c["doc"])
            own = np.arange(low, high)[c["text"][low:high] == text]
            s, e = merged(c["start"][own].astype(np.int64), c["end"][own].astype(np.int64))
            data = pa.decompress(batch.column(5)[i].as_py(), size, "zstd", asbytes=True) if size else b""
            yield doc, text, data, s, e


def _dictionary(buckets: int):
    """Later places of a phrase become spans; first places that share a half with another phrase become ranges of
    string starts that must be ranked."""
    def work(blobs):
        if not blobs:
            return []
        c = _unblob(blobs, _PHRASE)
        at, far, near = (c[k].astype(np.int64) for k in ("at", "far", "near"))
        own, again = _firsts([c["whole"], c["gram"]], c)
        rows = _deal_spans(c["doc"][again], c["text"][again], (at - far)[again], (at - near)[again] + LENGTH, buckets)
        parts = []
        for half, low, high in (("left", at - far, at - np.maximum(_HALF, near)), ("right", at - np.minimum(_HALF, far), at - near)):
            has = own[c[half][own] > 0]
            _, number, count = np.unique(mix64(c["gram"][has]) ^ c[half][has].astype(np.uint64), return_inverse=True, return_counts=True)
            open_ = has[count[number] > 1]
            parts.append((c["doc"][open_], c["text"][open_], low[open_], high[open_] + 1))
        return rows + _deal_spans(*[np.concatenate(x) for x in zip(*parts)], buckets, RANGES)
    return work


def _suffixes(buckets: int):
    """Hashes of the strings that start in the ranges; what repeats within the task becomes spans at once."""
    def run(batches):
        parts, held, seen = {k: [] for k, _ in _SUFFIX}, 0, set()
        for doc, text, data, s, e in _with_spans(batches):
            if not len(s) or (doc, text) in seen:         # a repeated row
                continue
            seen.add((doc, text))
            raw = np.frombuffer(data, np.uint8)
            at = np.repeat(s - np.append(0, np.cumsum(e - s)[:-1]), e - s) + np.arange((e - s).sum())
            for x in range(0, len(raw), _STEP):
                own = at[(at >= x) & (at < x + _STEP)]
                if len(own):
                    part = raw[x:x + _STEP + LENGTH]
                    for k, which in (("one", 0), ("two", 1)):
                        parts[k].append(Rolling(part, which).at(own - x, own - x + LENGTH))
                    parts["at"].append(own)
                    parts["doc"].append(np.full(len(own), doc))
                    parts["text"].append(np.full(len(own), text))
                    held += len(own)
            if held > 1_000_000:
                yield from _records(_combine(parts, buckets))
                parts, held = {k: [] for k, _ in _SUFFIX}, 0
        yield from _records(_combine(parts, buckets))
    return run


def _combine(parts: dict, buckets: int) -> list:
    if not parts["at"]:
        return []
    c = {k: np.concatenate(v) for k, v in parts.items()}
    first, again = _firsts([c["two"], c["one"]], c)
    rows = _deal_spans(c["doc"][again], c["text"][again], c["at"][again], c["at"][again] + LENGTH, buckets)
    return rows + _deal(c, np.sort(first), c["one"], buckets, _SUFFIX)


def _classes(buckets: int):
    """Of equal suffixes all but the first in the corpus become spans."""
    def work(blobs):
        if not blobs:
            return []
        c = _unblob(blobs, _SUFFIX)
        _, again = _firsts([c["two"], c["one"]], c)
        at = c["at"][again].astype(np.int64)
        return _deal_spans(c["doc"][again], c["text"][again], at, at + LENGTH, buckets)
    return work


def _zipped(buckets: int):
    """Texts as rows, compressed and dealt by document."""
    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                raw, starts, ends = text_bytes(part.column(1))
                docs = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                own = [raw[a:b].tobytes() for a, b in zip(starts, ends)]
                bucket = (mix64(docs.astype(np.uint64)) % np.uint64(buckets)).astype(np.int32)
                yield pa.record_batch([pa.array([TEXTS] * len(own), pa.int32()), pa.array(bucket), pa.array(docs), pa.array([zlib.crc32(t) for t in own], pa.int64()),
                                       pa.array([len(t) for t in own], pa.int64()), pa.array([pa.compress(t, "zstd", asbytes=True) for t in own], pa.binary())], schema=_ROW)
    return run


def _strip(batches):
    """Removes the spans: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept``."""
    kinds = [pa.int64()] * 4 + [pa.binary()]
    made = lambda rows: pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                        names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
    out = []
    for doc, _, data, s, e in _with_spans(batches):
        kept = b"".join(data[a:b] for a, b in zip(np.append(0, e), np.append(s, len(data))))
        out.append((None if doc == LAST else doc, len(data), int((e - s).sum()), len(s), kept))
        if len(out) >= 512:
            yield made(out)
            out = []
    yield made(out)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (the bytes left) for every row.

    Each byte goes that a 100-byte string covers which also starts earlier: in a document of smaller doc_id (null is
    the largest) or earlier in the same one.  Strings are judged on the input and lie within one document.  Null and
    empty texts keep nothing and lose nothing.  Rows that repeat doc_id and text are one document and get the same
    result; of rows that repeat only the doc_id the smaller checksum of the text comes first.  An empty table gives an
    empty result; other columns are not carried.
    """
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("doc"), F.col(text).cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(total // BUCKET_BYTES) + 1
    dealt = lambda df: df.repartition("bucket").sortWithinPartitions("bucket", "kind")
    found = written(dealt(rows.mapInArrow(_parse(buckets), ROW)).mapInArrow(_buckets(_dictionary(buckets)), ROW), "repeat-phrases")
    texts = rows.mapInArrow(_zipped(buckets), ROW)
    hashed = dealt(found.where(F.col("kind") == RANGES).unionByName(texts)).mapInArrow(_suffixes(buckets), ROW)
    ranked = dealt(hashed).mapInArrow(_buckets(_classes(buckets)), ROW)
    return dealt(found.where(F.col("kind") == SPANS).unionByName(ranked).unionByName(texts)).mapInArrow(
        _strip, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
