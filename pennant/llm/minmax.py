"""Near-duplicate documents by min-max hashing.

A document is the set of its five-word shingles.  Every permutation of the shingle hashes gives two signature values,
the smallest and the largest.  Bands and rows follow from the threshold (:func:`bands_for`), so that a pair at the
threshold shares no band with probability 1e-6 at most: 36 bands of 7 rows (126 hash evaluations per shingle) for 0.85,
46 of 6 (138) for 0.80.  A pair below 0.3 shares one with probability 0.8 % (3.3 % for 0.80).

1. One pass over the texts writes a narrow table: size of the set, a 128-bit hash of the set, the band keys.
2. Equal sets are one class, represented by its smallest doc_id (aggregated map-side: a group of copies that holds a
   third of all rows costs one row per task).
3. In every band bucket each class is tied to the smallest one (one row per class and bucket, never a pair within the
   bucket).  Connected components of these ties are the clusters in which links must be looked for.
4. Clusters are checked exactly on full sets: every pair of classes in a cluster is compared, in blocks.  Large
   clusters are cut into blocks of bounded size; a task gets two blocks, counts all intersections with a matrix
   product, and returns only a spanning forest of the links it found (at most one row per class in it).
5. Connected components of the links give the answer; all copies share their class's component.

There is no cap anywhere: the blocks of a large cluster cover all its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pennant.llm.common import written
from pennant.llm.graph import components
from pennant.llm.hashing import mix64, runs, seeds, shingle_hashes, text_bytes, word_hashes

#: A pair at the threshold shares no band with this probability at most; signature values that are spent on it.
MISS, VALUES = 1e-6, 288
#: Bounds of a block: classes, and bytes of their sets.
BLOCK_SETS, BLOCK_BYTES = 400, 8 << 20
_STEP = 1 << 15
_SIGNATURE = "doc_id long, text_hash string, n_shingles long, set_hash binary, bands array<long>"


def bands_for(percent: int) -> tuple[int, int]:
    """Bands and rows: as many rows as VALUES allow (at least one), and for them the fewest bands that keep to MISS."""
    similar, best = min(percent, 99) / 100, None
    for rows in range(1, VALUES + 1):
        bands = math.ceil(math.log(MISS) / math.log1p(-similar ** rows))
        if best and bands * rows > VALUES:
            break
        best = bands, rows
    return best


def min_max(hashes: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """Signatures of texts that have shingles: for each of n permutations the smallest and the largest value, side by side."""
    a, b = seeds(n, 11), seeds(n, 13)
    docs = len(first) - 1
    out = np.empty((docs, 2 * n), np.uint64)
    out[:, 0::2], out[:, 1::2] = np.uint64(2 ** 64 - 1), np.uint64(0)
    for low in range(0, len(hashes), _STEP):                         # steps that stay in the processor's cache
        high = min(low + _STEP, len(hashes))
        d0, d1 = int(np.searchsorted(first, low, side="right")) - 1, int(np.searchsorted(first, high, side="left"))
        at = np.maximum(first[d0:d1], low) - low
        part = hashes[low:high]
        for p in range(n):
            v = part * a[p] + b[p]
            out[d0:d1, 2 * p] = np.minimum(out[d0:d1, 2 * p], np.minimum.reduceat(v, at))
            out[d0:d1, 2 * p + 1] = np.maximum(out[d0:d1, 2 * p + 1], np.maximum.reduceat(v, at))
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key per band: a hash of its values and its number."""
    mult = seeds(rows, 17)
    out = np.empty((len(signature), bands), np.uint64)
    for j in range(bands):
        own = signature[:, j * rows:(j + 1) * rows]
        out[:, j] = mix64((mix64(own) * mult).sum(axis=1, dtype=np.uint64) + np.uint64(j))
    return out.view(np.int64)


def shingle_sets(column, size: int = 5) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of texts of an Arrow column: number of the first, shingle hashes (sorted, distinct in each text), and firsts."""
    raw, starts, ends = text_bytes(column)
    for low, high in runs(starts, ends, 1 << 20):
        origin = starts[low]
        words, first = word_hashes(raw[origin:ends[high - 1]], starts[low:high] - origin, ends[low:high] - origin)
        h, first = shingle_hashes(words, first, size)
        owner = np.repeat(np.arange(high - low), np.diff(first))
        order = np.lexsort((h, owner))
        h, owner = h[order], owner[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
        h = h[new]
        first = np.zeros(high - low + 1, np.int64)
        np.cumsum(np.bincount(owner[new], minlength=high - low), out=first[1:])
        yield low, h, first


def _signatures(bands: int, rows: int, size: int):
    import hashlib

    n = -(-bands * rows // 2)

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for low, h, first in shingle_sets(batch.column(2), size):
                count = np.diff(first)
                own = np.flatnonzero(count)
                keys = np.zeros((0, bands), np.int64)
                if len(own):
                    keys = band_keys(min_max(h, np.append(first[own], len(h)), n), bands, rows)
                offsets = np.zeros(len(count) + 1, np.int32)
                np.cumsum(np.where(count > 0, bands, 0), out=offsets[1:])
                yield pa.record_batch([
                    ids.slice(low, len(count)), batch.column(1).slice(low, len(count)), pa.array(count, pa.int64()),
                    pa.array([hashlib.blake2b(h[a:b].tobytes(), digest_size=16).digest() for a, b in zip(first, first[1:])], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel(), pa.int64()))],
                    names=["doc_id", "text_hash", "n_shingles", "set_hash", "bands"])
    return run


def text_hash(text: str) -> Column:
    """128 bits of a text; null counts as empty."""
    return F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")))


def signatures(docs: DataFrame, bands: int, rows: int, key: str = "doc_id", text: str = "text", shingle: int = 5) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_shingles``, ``set_hash``, ``bands`` for every row (no bands for an empty set)."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), text_hash(text).alias("text_hash"), F.col(text).cast("string").alias("text")).mapInArrow(
        _signatures(bands, rows, shingle), _SIGNATURE)


def clusters(classes: DataFrame) -> DataFrame:
    """``id``, ``label`` of the classes (``rep``, ``bands``) that share a band with another, directly or through others.

    A class is tied to the smallest of its buckets' pivots only; its other pivots are tied to that one, and as pivots
    repeat from class to class, few of those ties are distinct.
    """
    keyed = written(classes.select("rep", F.explode("bands").alias("band")), "minmax-bands")
    shared = keyed.groupBy("band").agg(F.min("rep").alias("pivot"), F.max("rep").alias("other")).where("pivot < other")
    own = keyed.join(shared.select("band", "pivot"), "band").groupBy("rep").agg(F.collect_set("pivot").alias("pivots"))
    own = own.select("rep", F.array_min("pivots").alias("b"), "pivots")
    ties = own.select(F.col("rep").alias("a"), "b").unionByName(own.select(F.explode("pivots").alias("a"), "b").distinct())
    return components(ties.where("a <> b"), "minmax-cluster")


def _members(size: int):
    import hashlib

    def run(batches):
        for batch in batches:
            for low, h, first in shingle_sets(batch.column(batch.schema.get_field_index("text")), size):
                keep, sets = [], []
                for i, (a, b) in enumerate(zip(first, first[1:])):
                    data = h[a:b].tobytes()
                    if hashlib.blake2b(data, digest_size=16).digest() == batch.column(1)[low + i].as_py():
                        keep.append(low + i)
                        sets.append(data)
                rows = batch.take(pa.array(keep, pa.int64()))
                yield pa.record_batch([rows.column(0), rows.column(1), rows.column(2), rows.column(3), pa.array(sets, pa.binary())],
                                      names=["rep", "set_hash", "label", "blocks", "elements"])
    return run


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of 0/1 matrices over the elements that occur twice or more."""
    n = len(sets)
    out = np.zeros((n, n), np.float32)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    value, number, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = count[number] > 1
    column = (np.cumsum(count > 1) - 1)[number[keep]]
    owner = owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    width = max(256, (1 << 22) // n)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, (low, low + width))
        m = np.zeros((n, width), np.float32)
        m[owner[a:b], column[a:b] - low] = 1
        out += m @ m.T
    return np.rint(out).astype(np.int64)


def forest(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links (100 * intersection >= percent * union) among the sets, as pairs of places."""
    size = np.array([len(s) for s in sets], np.int64)
    inter = intersections(sets)
    link = 100 * inter >= percent * (size[:, None] + size[None, :] - inter)
    left, pairs = np.ones(len(sets), bool), []
    for root in range(len(sets)):
        if not left[root]:
            continue
        left[root], todo = False, [root]
        while todo:
            found = np.flatnonzero(link[todo.pop()] & left)
            left[found] = False
            pairs += [(root, int(x)) for x in found]
            todo += found.tolist()
    return pairs


def _cells(percent: int):
    """Partitions sorted by cell; a cell's rows follow one another and are of bounded number and size."""
    def links(cell):
        if len(cell) > 1:
            ids = [r for r, _ in cell]
            for a, b in forest([s for _, s in cell], percent):
                if ids[a] != ids[b]:
                    yield ids[a], ids[b]

    def run(batches):
        name, cell, out = None, [], []
        for batch in batches:
            for i, (label, lo, hi, rep) in enumerate(zip(*[batch.column(c).to_pylist() for c in range(4)])):
                if (label, lo, hi) != name:
                    out += links(cell)
                    name, cell = (label, lo, hi), []
                cell.append((rep, np.frombuffer(batch.column(4)[i].as_buffer(), np.uint64)))   # no copy of the batch
            if len(out) > 10_000:
                yield pa.record_batch([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])
                out = []
        out += links(cell)
        yield pa.record_batch([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])
    return run


def verified_links(docs: DataFrame, classes: DataFrame, cluster: DataFrame, key: str, text: str, percent: int, shingle: int) -> DataFrame:
    """Links ``a``, ``b`` between classes, confirmed on full sets: a spanning forest for every pair of blocks."""
    inside = classes.join(cluster.withColumnRenamed("id", "rep"), "rep").select("rep", "set_hash", "n_shingles", "label")
    blocks = inside.groupBy("label").agg(F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n_shingles") * 8 / BLOCK_BYTES))
                                         .cast("int").alias("blocks"))
    inside = inside.join(blocks, "label").select("rep", "set_hash", "label", "blocks")
    texts = docs.select(F.col(key).cast("long").alias("rep"), F.col(text).cast("string").alias("text"))
    members = inside.join(texts, "rep").select("rep", "set_hash", "label", "blocks", "text").mapInArrow(
        _members(shingle), "rep long, set_hash binary, label long, blocks int, elements binary")
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    cells = members.select("rep", "elements", "label", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    cells = cells.select("label", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "rep", "elements")
    return cells.repartition("label", "lo", "hi").sortWithinPartitions("label", "lo", "hi").mapInArrow(_cells(percent), "a long, b long")


def judged(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 85, shingle: int = 5) -> DataFrame:
    """``doc_id``, ``text_hash``, ``set_hash`` (null for an empty set), ``n_shingles``, ``component_id``, ``kept`` for every row."""
    sig = written(signatures(docs, *bands_for(percent), key, text, shingle), "minmax-signatures")
    linked = sig.where("doc_id is not null and n_shingles > 0")
    classes = written(linked.groupBy("set_hash").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n_shingles"),
                                                     F.max("bands").alias("bands")), "minmax-classes")
    cluster = clusters(classes)
    label = components(verified_links(docs, classes, cluster, key, text, percent, shingle), "minmax-link")
    named = classes.select("set_hash", "rep").join(label.withColumnRenamed("id", "rep"), "rep", "left").select(
        "set_hash", F.coalesce("label", "rep").alias("component"))
    out = sig.select("doc_id", "text_hash", "n_shingles",
                     F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("set_hash")).alias("set_hash"))
    out = out.join(named, "set_hash", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "text_hash", "set_hash", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 85, shingle: int = 5) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` for every row of ``docs``.

    Documents are linked if 100 * |A & B| >= percent * |A | B| for their shingle sets; a component is named by its
    smallest doc_id, which is the one kept.  Null and empty texts (or texts of white space) have an empty set and
    are linked with nothing.  A row without doc_id is linked with nothing: component null, kept.  Rows that repeat a
    doc_id are judged by their texts.  An empty table gives an empty result.
    """
    return judged(docs, key, text, percent, shingle).select("doc_id", "n_shingles", "component_id", "kept")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 85) -> DataFrame:
    """The rows of ``docs`` that :func:`near_duplicates` keeps, with all their columns.

    A row goes only if its own set was judged a copy, whatever other rows of its doc_id hold.  Of rows with equal
    doc_id and equal sets (unless empty), those with the smallest text hash stay, and of rows with equal doc_id and
    equal texts the one with the smallest hash over all columns, so reruns agree.  Rows without a doc_id all stay; an
    empty table gives an empty result; columns may have any names, but none may be a map (maps have no hash).
    """
    verdict = judged(docs, key, text, percent).where("kept and doc_id is not null")
    empty = verdict.where("set_hash is null").select(F.col("doc_id").alias("_kept_id"), F.col("text_hash").alias("_kept_text")).distinct()
    one = verdict.where("set_hash is not null").groupBy(F.col("doc_id").alias("_kept_id"), "set_hash").agg(F.min("text_hash").alias("_kept_text"))
    kept = one.select("_kept_id", "_kept_text").unionByName(empty)
    known = docs.where(F.col(key).isNotNull()).select(F.struct("*").alias("doc"), F.col(key).cast("long").alias("_kept_id"),
                                                      text_hash(text).alias("_kept_text"), F.xxhash64("*").alias("_order"))
    rows = known.groupBy("_kept_id", "_kept_text").agg(F.min_by("doc", "_order").alias("doc")).join(kept, ["_kept_id", "_kept_text"])
    return rows.select("doc.*").unionByName(docs.where(F.col(key).isNull()))
