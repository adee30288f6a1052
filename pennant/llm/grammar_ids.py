"""Token ids in grammar-compressed files (Re-Pair), with random access.

Documents are range-sorted by key; every shard is one range, so shards in turn hold all ids in ascending order.  A
shard's ids are cut into blocks of about ``BLOCK`` ids, and in each block the frequent pairs of neighbouring symbols
are replaced by new symbols, again and again, until a round gains too little.  A round counts the pairs; where
occurrences of frequent pairs overlap, the more frequent pair wins.  No pair reaches over a document's end, so every
document is a run of whole symbols.

A block's bytes, little-endian: ``MAGIC``; as unsigned 32-bit integers the number of distinct ids, rounds, rules,
symbols, entries, and the bytes of a symbol; the distinct ids (32-bit); the rules of each round (32-bit); the left and
the right sides of all rules (symbols); their expansion lengths (32-bit); the sequence (symbols); then for each entry
its document's number in the shard, key, whether the key is not null (8-bit), first id in the document, ids of the
document (64-bit but the flag), ids here, and first symbol (32-bit).  Symbols below the number of distinct ids stand for
those, the next ones for the rules in turn.  A reader finds any id by adding up expansion lengths and goes down
only into the rules that reach over the wanted place.

The blocks are rows of a Parquet table (``shard``, ``block``, ``before``, ``n_ids``, ``parts``, ``payload``): Spark commits them as a
whole, whatever store they are in, and a task that runs again leaves no second copy.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pennant.llm.hashing import runs, seeds, text_bytes
from pennant.llm.packing import encoder_of, spread

MAGIC = b"RPG1"
#: Ids of a block (a longer document is cut into blocks of its own), and the ids' texts encoded at a time.
BLOCK, TEXT_BYTES = 1 << 18, 4 << 20
#: A rule costs 8 bytes and saves 2 for each replacement; a round must shorten the sequence by this share for another one.
LEAST_COUNT, LEAST_GAIN = 5, 0.002
#: Slots of the table that counts pairs.
SLOT_BITS = 17
#: While a block is made: the bit of a symbol that ends an entry, and the other bits.
LAST, SYMBOL = np.uint32(1 << 31), np.uint32((1 << 31) - 1)
_TABLE = "shard int, block long, before long, n_ids long, parts boolean, payload binary"
_ENTRY = [("doc_no", "<i8"), ("doc_id", "<i8"), ("known", "u1"), ("start", "<i8"), ("doc_tokens", "<i8"), ("length", "<u4"), ("symbol", "<u4")]


def _frequent(seq: np.ndarray, look: np.ndarray, least: int, turn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the pairs that begin at ``look`` (ascending): places where a pair is to be replaced, none overlapping another;
    the pair's number there; both symbols of each pair; and the places that another round has to look at even if nothing
    changes beside them.  Only pairs with at least ``least`` places to replace are taken.

    Pairs are told apart by a table of hashes: of the pairs that fall into one slot a single one counts in this round
    (a pair is the likelier to, the more frequent it is); another round has another hash.
    """
    none = 1 << SLOT_BITS
    key = seq.take(look).astype(np.uint64)
    key <<= np.uint64(32)
    key |= seq.take(look + 1) & SYMBOL
    slot = key * seeds(1, 3 + turn)[0]
    slot >>= np.uint64(64 - SLOT_BITS)
    slot = slot.view(np.int64)
    held = np.empty(none, np.uint64)
    held[slot] = key
    own = held.take(slot) == key
    if not own.all():
        late = look.compress(~own)
        own = np.flatnonzero(own)
        look, slot = look.take(own), slot.take(own)
    else:
        late = look[:0]
    count = np.bincount(slot, minlength=none)
    hot = np.flatnonzero((count >= least).take(slot))                            # the rest of the work is on frequent pairs only
    at, slot = look.take(hot), slot.take(hot)
    again = at
    prio = (count.take(slot) << SLOT_BITS) | slot                                # more frequent first; no ties between pairs
    near = at[1:] - at[:-1] == 1
    same = np.flatnonzero(near & (prio[1:] == prio[:-1])) + 1                    # runs of one symbol: every other place
    if len(same):
        begin = np.append(True, np.diff(same) != 1)
        since = np.arange(len(same)) - np.flatnonzero(begin)[np.cumsum(begin) - 1]
        prio[same[since % 2 == 0]] = 0
    sel = prio > 0
    sel[1:] &= ~near | (prio[1:] > prio[:-1])
    sel[:-1] &= ~near | (prio[:-1] > prio[1:])
    sel = np.flatnonzero(sel)
    at, slot = at.take(sel), slot.take(sel)
    chosen = np.bincount(slot, minlength=none) >= least
    fine = np.flatnonzero(chosen.take(slot))
    at, slot = at.take(fine), slot.take(fine)
    chosen = np.flatnonzero(chosen)
    pairs = held.take(chosen)
    number = np.empty(none, np.int64)
    number[chosen] = np.arange(len(chosen))
    return at, number.take(slot), np.stack([pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)]).astype(np.int64), np.append(again, late)


def compress(ids: np.ndarray, sizes: np.ndarray, entries: np.ndarray, least: int = LEAST_COUNT, gain: float = LEAST_GAIN) -> bytes:
    """A block's bytes from the ids of its entries, one after another; ``sizes``: ids of each entry.

    A round looks only at places whose pair may be frequent: those that were in the round before or were not counted
    there, and those beside a new symbol.  Of any other pair there were too few, and no round makes more of them.
    """
    alphabet = np.flatnonzero(np.bincount(ids))
    code = np.zeros(int(alphabet[-1]) + 1 if len(alphabet) else 0, np.uint32)
    code[alphabet] = np.arange(len(alphabet))
    seq = code.take(ids)
    ends = np.cumsum(sizes)
    seq[ends[sizes > 0] - 1] |= LAST
    lengths = np.ones(len(alphabet), np.int64)
    left, right, made = [], [], []
    look = np.flatnonzero(seq < LAST)
    while len(look):
        at, pair, (a, b), again = _frequent(seq, look, least, len(made))
        if not len(at):
            break
        left.append(a)
        right.append(b)
        made.append(len(a))
        after = seq.take(at + 1)
        seq[at] = (len(lengths) + pair).astype(np.uint32) | (after & LAST)
        lengths = np.append(lengths, lengths[a] + lengths[b])
        looked = np.zeros(len(seq), bool)
        looked[again] = True
        looked[at] = True
        looked[at[at > 0] - 1] = True
        stay = np.ones(len(seq), bool)
        stay[at + 1] = False
        size = len(seq)
        stay = np.flatnonzero(stay)
        seq = seq.take(stay)
        look = np.flatnonzero(looked.take(stay))
        look = look[seq.take(look) < LAST]
        if len(at) < gain * size:
            break
    seq &= SYMBOL
    wide = np.dtype("<u2") if len(lengths) <= 65536 else np.dtype("<u4")
    rows = entries.copy()
    rows["length"] = sizes
    rows["symbol"] = np.searchsorted(np.cumsum(lengths[seq]) if len(seq) else np.zeros(0), ends - sizes, side="right")
    one = lambda x: np.concatenate(x) if x else np.zeros(0)
    head = np.array([len(alphabet), len(made), sum(made), len(seq), len(rows), wide.itemsize], "<u4")
    return b"".join([MAGIC, head.tobytes(), alphabet.astype("<u4").tobytes(), np.array(made, "<u4").tobytes(), one(left).astype(wide).tobytes(),
                     one(right).astype(wide).tobytes(), lengths[len(alphabet):].astype("<u4").tobytes(), seq.astype(wide).tobytes(), rows.tobytes()])


class Block:
    """A block's parts, and its ids: all of them at once, or any stretch of one entry."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a block of grammar-compressed ids")
        n_ids, n_rounds, n_rules, n_symbols, n_entries, wide = np.frombuffer(payload, "<u4", 6, 4).tolist()
        at = 28

        def take(kind, n):
            nonlocal at
            got = np.frombuffer(payload, kind, n, at)
            at += got.nbytes
            return got
        self.alphabet, self.made = take("<u4", n_ids), take("<u4", n_rounds)
        self.left, self.right, lengths = take(f"<u{wide}", n_rules), take(f"<u{wide}", n_rules), take("<u4", n_rules)
        self.sequence, self.entries = take(f"<u{wide}", n_symbols), take(_ENTRY, n_entries)
        self.lengths = np.append(np.ones(n_ids, np.int64), lengths)

    def ids(self) -> np.ndarray:
        """All ids: rules are spelt out round by round, each from earlier ones, and the sequence from them."""
        flat, start = self.alphabet, np.arange(len(self.alphabet))
        low = 0
        for n in self.made.tolist():
            sides = np.stack([self.left[low:low + n], self.right[low:low + n]], 1).ravel()
            more = flat[spread(start[sides], self.lengths[sides])]
            own = self.lengths[len(start):len(start) + n]
            start = np.append(start, len(flat) + np.cumsum(own) - own)
            flat = np.append(flat, more)
            low += n
        return flat[spread(start[self.sequence], self.lengths[self.sequence])]

    def slice(self, entry: int, low: int, high: int) -> np.ndarray:
        """Ids low up to high (exclusive) of an entry; rules outside the stretch are passed over by their lengths."""
        row = self.entries[entry]
        low, high = max(0, low), min(high, int(row["length"]))
        stop = int(self.entries[entry + 1]["symbol"]) if entry + 1 < len(self.entries) else len(self.sequence)
        own = self.sequence[int(row["symbol"]):stop]
        ends = np.cumsum(self.lengths[own])
        first = int(np.searchsorted(ends, low, side="right"))
        stack = own[first:int(np.searchsorted(ends, high)) + 1][::-1].tolist()
        at, out, terminals = int(ends[first - 1]) if first else 0, [], len(self.alphabet)
        while stack and at < high:
            symbol = stack.pop()
            size = int(self.lengths[symbol])
            if at + size <= low:
                at += size
            elif symbol < terminals:
                out.append(self.alphabet[symbol])
                at += 1
            else:
                stack += [int(self.right[symbol - terminals]), int(self.left[symbol - terminals])]
        return np.array(out, "<u4")


def _blocks(path: str, end_id: int, size: int):
    """Blocks of a partition of sorted rows (``_part``, ``doc_id``, ``text``)."""
    def run(batches):
        encoder = encoder_of(path)
        end = np.array([end_id], np.uint32)
        held, rows, state = [], [], {"block": 0, "before": 0, "held": 0, "doc": 0}

        def flush(shard, parts):
            sizes = np.array([len(x) for x in held])
            payload = compress(np.concatenate(held), sizes, np.array(rows, _ENTRY))
            out = pa.record_batch([pa.array([shard], pa.int32()), pa.array([state["block"]], pa.int64()), pa.array([state["before"]], pa.int64()),
                                   pa.array([state["held"]], pa.int64()), pa.array([parts]), pa.array([payload], pa.binary())],
                                  names=["shard", "block", "before", "n_ids", "parts", "payload"])
            state["block"] += 1
            state["before"] += state["held"]
            state["held"] = 0
            held.clear()
            rows.clear()
            return out

        def add(doc, start, total, ids):
            held.append(ids)
            rows.append((state["doc"], doc or 0, doc is not None, start, total, len(ids), 0))
            state["held"] += len(ids)

        shard = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            shard = batch.column(0)[0].as_py()
            raw, starts, ends = text_bytes(batch.column(2))
            keys = batch.column(1).to_pylist()
            for low, high in runs(starts, ends, TEXT_BYTES):
                o = starts[low]
                ids, first = encoder.encode(raw[o:ends[high - 1]], starts[low:high] - o, ends[low:high] - o)
                for doc, a, b in zip(keys[low:high], first, first[1:]):
                    own = np.append(ids[a:b].astype(np.uint32), end)
                    if held and state["held"] + len(own) > size:
                        yield flush(shard, False)
                    if len(own) <= size:
                        add(doc, 0, len(own), own)
                    else:                                   # a document of several blocks
                        for at in range(0, len(own), size):
                            add(doc, at, len(own), own[at:at + size])
                            yield flush(shard, True)
                    state["doc"] += 1
        if held:
            yield flush(shard, False)
    return run


def write(docs: DataFrame, files: str, path: str, end_id: int = 1, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> None:
    """Writes every document's ids and ``end_id`` to ``files``, documents in ascending order of their keys.

    Null and empty texts are just the end id.  Null keys come first; rows of one key stand in the order of their
    texts' hashes, and rows that repeat stand side by side, each with ids of its own.  An empty table gives files
    without blocks.  Other columns are not carried.  One range exchange; a hot key is spread by the rows' numbers.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("_tie", F.xxhash64("text")).withColumn("_row", F.monotonically_increasing_id())
    by = [F.col("doc_id").asc_nulls_first(), F.col("_tie"), F.col("_row")]
    shards = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by).select(F.spark_partition_id().alias("_part"), "doc_id", "text")
    shards.mapInArrow(_blocks(path, end_id, block), _TABLE).write.option("compression", "zstd").parquet(files)


def blocks(spark: SparkSession, files: str) -> DataFrame:
    """The blocks of the files, with ``first``: all ids before a block (one total per shard goes through the driver)."""
    table = spark.read.schema(_TABLE).parquet(files)
    at, starts = 0, []
    for r in table.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect():
        starts.append((r["shard"], at))
        at += r["n"]
    shards = spark.createDataFrame(starts, "shard int, _start long")
    return table.join(F.broadcast(shards), "shard").withColumn("first", F.col("_start") + F.col("before")).drop("_start")


_PIECE = "shard int, doc_no long, doc_id long, piece_start long, doc_tokens long, length long, start long, ids binary"


def _decoded(batches):
    for batch in batches:
        for shard, first, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            block = Block(payload.as_py())
            ids = block.ids().astype("<u4")
            e = block.entries
            n = e["length"].astype(np.int64)
            ends = np.cumsum(n)
            data = ids.tobytes()
            yield pa.record_batch([
                pa.array([shard] * len(e), pa.int32()), pa.array(e["doc_no"]), pa.array(e["doc_id"], mask=e["known"] == 0), pa.array(e["start"]),
                pa.array(e["doc_tokens"]), pa.array(n), pa.array(first + ends - n - e["start"]),
                pa.array([data[4 * a:4 * b] for a, b in zip(ends - n, ends)], pa.binary())],
                names=["shard", "doc_no", "doc_id", "piece_start", "doc_tokens", "length", "start", "ids"])


def read(spark: SparkSession, files: str) -> DataFrame:
    """Every document from the files: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids``
    (little-endian unsigned 32-bit); documents of several blocks are put together, one group each."""
    table = blocks(spark, files).select("shard", "first", "payload", "parts")
    whole = table.where(~F.col("parts")).drop("parts").mapInArrow(_decoded, _PIECE).select("doc_id", "start", F.col("doc_tokens").alias("n_tokens"), "ids")
    cut = table.where("parts").drop("parts").mapInArrow(_decoded, _PIECE)
    cut = cut.groupBy("shard", "doc_no", "doc_id", "start", F.col("doc_tokens").alias("n_tokens")).agg(
        F.expr("listagg(ids) WITHIN GROUP (ORDER BY piece_start)").alias("ids"))
    return whole.unionByName(cut.select(*whole.columns))


def lookup(spark: SparkSession, files: str, wanted: DataFrame) -> DataFrame:
    """Random access: ``low``, ``high`` (places in the whole stream of ids, high exclusive) to the ids between, as rows
    (``low``, ``high``, ``at``, ``ids``), one per block that the stretch touches and ``at`` the place of its first id.

    Only blocks that a stretch touches are decoded, and in them only the rules over the stretch.  Empty stretches and
    those beyond the end give no row.
    """
    kind = "low long, high long, at long, ids binary"
    size = 1 << 16                                     # stretches and blocks meet by the pages of the stream that they touch
    pages = lambda a, b: F.explode(F.sequence(F.expr(f"({a}) div {size}"), F.expr(f"({b} - 1) div {size}")))
    held = blocks(spark, files)
    where = held.select("shard", "block", "first", (F.col("first") + F.col("n_ids")).alias("end")).withColumn("_page", pages("first", "end"))
    asked = wanted.select("low", "high").distinct().where("low >= 0 and high > low").withColumn("_page", pages("low", "high"))
    hits = asked.join(where, "_page").where("low < end and high > first").select("low", "high", "shard", "block").distinct()
    per = hits.groupBy("shard", "block").agg(F.collect_set(F.struct("low", "high")).alias("wanted"))

    def run(batches):
        for batch in batches:
            for first, payload, pairs in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                block, out = Block(payload.as_py()), []
                ends = first + np.cumsum(block.entries["length"].astype(np.int64))
                for p in pairs:
                    a, b = max(p["low"], first), min(p["high"], int(ends[-1]))
                    got = []
                    for i in range(int(np.searchsorted(ends, a, side="right")), int(np.searchsorted(ends, b)) + 1):
                        begin = int(ends[i]) - int(block.entries["length"][i])
                        got.append(block.slice(i, a - begin, b - begin))
                    out.append((p["low"], p["high"], a, np.concatenate(got).tobytes()))
                yield pa.record_batch([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()),
                                       pa.array([r[2] for r in out], pa.int64()), pa.array([r[3] for r in out], pa.binary())],
                                      names=["low", "high", "at", "ids"])

    return held.join(per, ["shard", "block"]).select("first", "payload", "wanted").mapInArrow(run, kind)
