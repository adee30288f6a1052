"""Packing along a space-filling curve.

Every document's token ids are hashed into a signed bag of ids, damped by logarithm, and projected to four dimensions
with a fixed random matrix; the quantised point's place on a Hilbert curve is the document's sort key, so documents
of like wording are neighbours along the curve.  Documents are range-sorted by (key, row number), a running sum of
their tokens gives every document its place in one long stream, and the stream is cut into sequences of ``length``
tokens: only the very last sequence can be short.

Work and data: one pass tokenises (distinct words only: words cannot influence each other because the tokeniser drops
white space) and writes compressed ids; the sort and the running sum see only narrow rows;
one join by row number brings places and ids together.  Hot keys (copies) are told apart by the row number, so a range
partition never has to take them all.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pennant.llm.common import running_sum, written
from pennant.llm.hashing import mix64, runs, seeds, text_bytes, word_hashes

DIMENSIONS, BITS, BUCKETS = 4, 15, 256
#: Learned words that an encoder keeps, and ids of all of them together; beyond either, half goes, longest unused first.
KEPT_WORDS, KEPT_IDS = 1 << 20, 1 << 23
#: Bits of a word's hash by which its place is looked up.
_SLOT_BITS = 20
#: Encoders of this Python worker, by path: the words learned in one task serve the next.
_ENCODERS: dict[str, "WordEncoder"] = {}


def hilbert_key(points: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of integer points (n, d) with coordinates below 2 ** bits; d * bits < 64.

    The points' bits are turned into the curve's transposed form (exchange and inversion of the lower bits, one bit
    plane at a time), decoded from Gray code, and interleaved.
    """
    x = points.astype(np.int64).T.copy()
    d = len(x)
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for i in range(d):
            hit = (x[i] >> bit) & 1 == 1
            swap = np.where(hit, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(hit, low, swap)
            x[i] ^= swap
    for i in range(1, d):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((x[d - 1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def curve_points(bags: np.ndarray, dimensions: int = DIMENSIONS, bits: int = BITS) -> np.ndarray:
    """Integer points of signed id bags (n, buckets): damped, scaled to length 1, projected, squashed to the unit cube."""
    v = np.sign(bags) * np.log1p(np.abs(bags))
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    matrix = np.random.default_rng(20).standard_normal((bags.shape[1], dimensions))
    u = 1 / (1 + np.exp(-1.702 * (v @ matrix)))
    return np.minimum((u * (1 << bits)).astype(np.int64), (1 << bits) - 1)


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, … of each stretch, one after another."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


class Words:
    """Learned words: sorted hashes; start and size of each word's ids in one array; and the turn that last met it.

    A slot of the hash's first bits has the place of its first word, so a word is found in few steps.
    """

    def __init__(self, kind: np.dtype):
        self.flat, self.turn = np.zeros(0, kind), 0
        self.begin, self.size, self.used = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self._hold(np.zeros(0, np.uint64))

    def _hold(self, keys: np.ndarray) -> None:
        self.ends = np.append(keys, np.uint64(2 ** 64 - 1))      # a search always ends
        self.keys = self.ends[:-1]
        count = np.bincount((keys >> np.uint64(64 - _SLOT_BITS)).view(np.int64), minlength=1 << _SLOT_BITS)
        self.slots = (np.cumsum(count) - count).astype(np.int32)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and size of each word's ids, and which words are not known (their start and size: 0)."""
        self.turn += 1
        at = self.slots.take((h >> np.uint64(64 - _SLOT_BITS)).view(np.int64)).astype(np.int64)
        key = self.ends.take(at)
        left = np.flatnonzero(key < h)
        while len(left):                                         # on to the next word until the hash is reached or passed
            at[left] += 1
            key[left] = self.ends.take(at[left])
            left = left[key[left] < h[left]]
        known = (key == h) & (at < len(self.keys))
        new = np.flatnonzero(~known)
        if not len(new):
            self.used[at] = self.turn
            return self.begin.take(at).astype(np.int64), self.size.take(at).astype(np.int64), new
        here = np.flatnonzero(known)
        at = at.take(here)
        self.used[at] = self.turn
        begin, size = np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
        begin[here], size[here] = self.begin.take(at), self.size.take(at)
        return begin, size, new

    def add(self, keys: np.ndarray, begin: np.ndarray, size: np.ndarray, flat: np.ndarray) -> None:
        """Words that are not known yet, sorted; ``begin`` counts from the end of the ids held so far."""
        at = np.searchsorted(self.keys, keys)
        self.begin, self.size = np.insert(self.begin, at, begin + len(self.flat)), np.insert(self.size, at, size)
        self.used = np.insert(self.used, at, self.turn)
        self._hold(np.insert(self.keys, at, keys))
        self.flat = np.append(self.flat, flat)

    def prune(self, words: int, ids: int) -> None:
        """If there are more than so many words or ids, those used last stay, up to half of both."""
        if len(self.keys) <= words and len(self.flat) <= ids:
            return
        late = np.argsort(-self.used, kind="stable")
        late = late[:words // 2]
        stay = np.sort(late[np.cumsum(self.size[late], dtype=np.int64) <= ids // 2])
        self.flat = self.flat[spread(self.begin[stay].astype(np.int64), self.size[stay])]
        self.size, self.used = self.size[stay], self.used[stay]
        self.begin = np.cumsum(self.size, dtype=np.int32) - self.size
        self._hold(self.keys[stay])


class WordEncoder:
    """Token ids of many texts at once, from the ids of their distinct words.

    Words end at ASCII white space, and before closing punctuation behind an ASCII letter or digit.  Right for
    tokenisers that lower-case, and drop white space before merging, as word_bpe_49k.json does: no alternative of its
    pre-tokeniser reaches over white space, or from a letter or digit into such punctuation.  Words are known by
    64-bit hashes of their bytes in lower case (very long ones by a cryptographic hash).

    What is learned stays until there is too much of it; then words that have not been met for the longest time go, so
    memory is bounded whatever the vocabulary, and frequent words are learned once.
    """

    LONG = 256

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2") if size <= 65536 else np.dtype("<u4")
        self.words = {False: Words(self.kind), True: Words(self.kind)}
        h = mix64(np.arange(size, dtype=np.uint64) * seeds(1, 5)[0])
        self.bucket, self.sign = (h >> np.uint64(8)).astype(np.int64) % BUCKETS, (h & np.uint64(1)).astype(np.float64) * 2 - 1

    def encode(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and for each text the place of its first id (one more at the end)."""
        special = b"<|" in raw.tobytes()                     # special strings are told apart by case
        h, first, w0, w1 = word_hashes(raw, starts, ends, not special, True, True)
        for i in np.flatnonzero(w1 - w0 > self.LONG):
            word = raw[w0[i]:w1[i]].tobytes()
            h[i] = int.from_bytes(hashlib.blake2b(word if special else word.lower(), digest_size=8).digest(), "little")
        words = self.words[special]
        start, count, new = words.find(h)
        if len(new):
            distinct, sample, which = np.unique(h[new], return_index=True, return_inverse=True)
            begin, size, flat = self._learn(raw, w0[new[sample]], w1[new[sample]])
            start[new], count[new] = begin[which] + len(words.flat), size[which]
            words.add(distinct, begin, size, flat)
        ids = words.flat.take(spread(start, count))
        words.prune(KEPT_WORDS, KEPT_IDS)
        after = np.append(0, np.cumsum(count))
        return ids, after[first]

    def _learn(self, raw: np.ndarray, w0: np.ndarray, w1: np.ndarray, group: int = 500) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, size and ids of words: many are encoded as the lines of one text, and offsets tell whose a token is."""
        size = w1 - w0
        line = np.append(0, np.cumsum(size + 1))
        data = np.full(line[-1], 10, np.uint8)
        data[spread(line[:-1], size)] = raw[spread(w0, size)]
        char = np.append(0, np.cumsum((data & 0xC0) != 0x80))[line]        # characters before each line
        cuts = list(range(0, len(w0), group)) + [len(w0)]
        texts = [data[line[a]:line[b] - 1].tobytes().decode() for a, b in zip(cuts, cuts[1:])]
        first, flat, total = [], [], 0
        for a, b, e in zip(cuts, cuts[1:], self.tokenizer.encode_batch(texts, add_special_tokens=False)):
            places = np.fromiter((o[0] for o in e.offsets), np.int64, len(e))
            first.append(np.searchsorted(places, char[a:b] - char[a]) + total)
            flat.append(np.array(e.ids, self.kind))
            total += len(e)
        begin = np.concatenate(first)
        return begin, np.diff(np.append(begin, total)), np.concatenate(flat)

    def bags(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Signed hashed bags of ids, one row per text."""
        text = np.repeat(np.arange(len(first) - 1) * BUCKETS, np.diff(first))
        return np.bincount(text + self.bucket[ids], self.sign[ids], (len(first) - 1) * BUCKETS).reshape(-1, BUCKETS)


def encoder_of(path: str) -> WordEncoder:
    """This process's encoder.  Tasks have to come here for it: a function sent to them brings copies of the globals
    that it names, so what they put into those is gone with the task."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _tokenise(path: str, end_id: int):
    def run(batches):
        encoder = encoder_of(path)
        end = np.array([end_id], encoder.kind).tobytes()
        for batch in batches:
            raw, starts, ends = text_bytes(batch.column(2))
            for low, high in runs(starts, ends, 4 << 20):
                n, o = high - low, starts[low]
                ids, first = encoder.encode(raw[o:ends[high - 1]], starts[low:high] - o, ends[low:high] - o)
                key = hilbert_key(curve_points(encoder.bags(ids, first)), BITS)
                packed = [pa.compress(ids[a:b].tobytes() + end, "zstd", asbytes=True) for a, b in zip(first, first[1:])]
                yield pa.record_batch([
                    batch.column(0).slice(low, n), batch.column(1).slice(low, n), pa.array(key, pa.int64()),
                    pa.array(np.diff(first) + 1, pa.int64()), pa.array(packed, pa.binary()),
                    pa.array([encoder.kind.itemsize] * n, pa.int32())],
                    names=["_row", "doc_id", "curve", "doc_tokens", "packed", "width"])
    return run


def tokenised(docs: DataFrame, path: str, end_id: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``_row``, ``doc_id``, ``curve``, ``doc_tokens``, ``packed`` (zstd of little-endian ids), ``width``; written once."""
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(key).cast("long").alias("doc_id"),
                       F.col(text).cast("string").alias("text"))
    return written(rows.mapInArrow(_tokenise(path, end_id), "_row long, doc_id long, curve long, doc_tokens long, packed binary, width int"),
                   "pack-ids")


def _cut(length: int):
    def run(batches):
        for batch in batches:
            out = []
            for doc, n, packed, width, place in zip(*[batch.column(i).to_pylist() for i in range(5)]):
                ids = np.frombuffer(pa.decompress(packed, n * width, "zstd", asbytes=True), f"<u{width}").astype("<u4")
                at = 0
                while at < n:
                    take = min(n - at, length - (place + at) % length)
                    out.append((doc, at, take, n, (place + at) // length, (place + at) % length, ids[at:at + take].tobytes()))
                    at += take
                if len(out) >= 4096:
                    yield _pieces(out)
                    out = []
            yield _pieces(out)
    return run


def _pieces(rows):
    kinds = [pa.int64()] * 6 + [pa.binary()]
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    return pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def pack(docs: DataFrame, path: str, length: int = 2048, end_id: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of the packed sequences: ``doc_id``, ``start``, ``length``, ``doc_tokens``, ``sequence_id``, ``offset``,
    ``ids`` (little-endian unsigned 32-bit).

    A document is its token ids, then ``end_id``; null and empty texts are just the end id.  Each id lies in exactly
    one piece; the pieces of a sequence follow one another from offset 0 without gaps, and all sequences but the
    last are full.  Rows that repeat (also null keys) are packed one by one; an empty table gives an empty result.
    Other columns are not carried.
    """
    ids = tokenised(docs, path, end_id, key, text)
    placed, _ = running_sum(ids.select("_row", "curve", "doc_tokens"), [F.col("curve"), F.col("_row")], "doc_tokens", "place", "pack-order")
    joined = ids.join(placed.select("_row", "place"), "_row").select("doc_id", "doc_tokens", "packed", "width", "place")
    return joined.mapInArrow(_cut(length), "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def sequences(pieces: DataFrame, length: int = 2048, pad_id: int = 0) -> DataFrame:
    """``sequence_id``, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit), ``doc_ids``: the sequences themselves.

    They are padded to ``length`` with ``pad_id`` unless their own length is a power of two.  A group is one sequence,
    so it is bounded.
    """
    rows = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    whole = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), rows.alias("rows"))
    hexed = F.array_join(F.transform("rows", lambda r: F.hex(r["ids"])), "")
    n, pad = F.col("n_tokens"), pad_id.to_bytes(4, "little").hex().upper()
    fill = F.when((F.bit_count(n) != 1) & (n < length), length - n).otherwise(F.lit(0)).cast("int")
    return whole.select("sequence_id", "n_tokens", F.unhex(F.concat(hexed, F.repeat(F.lit(pad), fill))).alias("ids"),
                        F.transform("rows", lambda r: r["doc_id"]).alias("doc_ids"))
