"""Token counts of whole texts; huge ones are encoded in overlapping chunks and spliced where the encodings agree.

A chunk's encoding can differ from the whole text's near its ends.  Inside the overlap of two neighbouring chunks a
place at which both chunks begin a new pre-token is a proven boundary: the pre-tokeniser scans from left to right and
looks at no more than ``MARGIN`` characters ahead, so the left chunk is right up to there (it is not within MARGIN of
its end, and was right at the boundary before), and the right chunk, standing at the same boundary with the same text
ahead, goes on exactly as the whole text does.  Tokens never cross pre-tokens, so the count of the whole is the sum
over chunks of the tokens between the splices on either side.  If two chunks have no common boundary, the text is cut
anew with overlaps (and chunks) four times as wide, until every splice is proven or a chunk holds the whole text.
"""

from __future__ import annotations

import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pennant.llm.common import written
from pennant.llm.words import Generations, encode_words

#: Characters a pre-token's end can depend on beyond it: the longest special string, and more than any contraction.
MARGIN = 32
CHUNK, OVERLAP = 32_768, 512


def load(path: str):
    """The tokeniser without truncation, padding or post-processing; offsets keep leading spaces."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, processors

    t = Tokenizer.from_file(path)
    t.no_padding()
    t.no_truncation()
    t.post_processor = processors.ByteLevel(trim_offsets=False)
    return t


class WordCounter:
    """Token counts of texts whose white space is single spaces and line breaks, from the counts of their words.

    There a space opens the next word's pre-token, and a line break is one by itself: before both ends whatever came
    before (it ends in no white space, and nothing looks ahead to them), so words are encoded independently.  Other
    texts are encoded as they are.
    """

    ODD = re.compile(r"^\s|\s\s|\s$|[^\S \n]")

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.after_space, self.at_line = Generations(), Generations()
        self.line_break = len(self.tokenizer.encode("\n", add_special_tokens=False))

    def learn(self, words: Generations, need: set, separator: str, lead: int) -> None:
        new = words.missing(need)
        for low in range(0, len(new), 20_000):
            part = new[low:low + 20_000]
            for a, b, _, first, end in encode_words(self.tokenizer, part, separator, lead):
                words.young.update(zip(part[a:b], (end - first).tolist()))

    def count(self, texts: list[str]) -> list[int]:
        out = [0 if not t else None for t in texts]
        whole = [i for i, t in enumerate(texts) if t and self.ODD.search(t)]
        for i, e in zip(whole, self.tokenizer.encode_batch_fast([texts[i] for i in whole], add_special_tokens=False)):
            out[i] = len(e)
        rest = [i for i, n in enumerate(out) if n is None]
        lines = [[line.split(" ") for line in texts[i].split("\n")] for i in rest]
        self.learn(self.at_line, {line[0] for doc in lines for line in doc}, "\n", 0)
        self.learn(self.after_space, set().union(*[line[1:] for doc in lines for line in doc]), " ", 1)
        first, then = self.at_line.young.__getitem__, self.after_space.young.__getitem__
        for i, doc in zip(rest, lines):
            out[i] = (len(doc) - 1) * self.line_break + sum([first(line[0]) + sum(map(then, line[1:])) for line in doc])
        return out


#: Counters of this Python worker, by path: what one task learned serves the next.
_COUNTERS: dict[str, WordCounter] = {}


def _whole(path: str, most: int):
    """Counts texts of at most ``most`` characters; longer ones are handed on as they are, without a count."""
    def run(batches):
        counter = _COUNTERS.get(path) or WordCounter(path)
        _COUNTERS[path] = counter
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                texts = [x or "" for x in part.column(2).to_pylist()]
                counts = iter(counter.count([x for x in texts if len(x) <= most]))
                yield pa.record_batch([part.column(0), part.column(1), pc.fill_null(pc.binary_length(part.column(2)), 0).cast(pa.int64()),
                                       pa.array([next(counts) if len(x) <= most else None for x in texts], pa.int64()),
                                       pa.array([None if len(x) <= most else x for x in texts], pa.string())],
                                      names=["_row", "doc_id", "n_bytes", "n_tokens", "long_text"])
    return run


def _chunks(chunk: int, overlap: int):
    """Cuts texts into chunks that overlap: ``_row``, ``chunk``, ``chunks``, ``start``, ``text``."""
    def run(batches):
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                step = chunk - overlap
                n = max(1, -(-(len(text) - overlap) // step))
                for low in range(0, n, 64):
                    own = range(low, min(low + 64, n))
                    yield pa.record_batch([pa.array([row] * len(own), pa.int64()), pa.array(list(own), pa.int64()), pa.array([n] * len(own), pa.int64()),
                                           pa.array([i * step for i in own], pa.int64()),
                                           pa.array([text[i * step:i * step + chunk] if i < n - 1 else text[i * step:] for i in own], pa.string())],
                                          names=["_row", "chunk", "chunks", "start", "text"])
    return run


def edge_boundaries(e, length: int, overlap: int) -> tuple[list, list]:
    """Places at which a pre-token or special token begins, with the number of tokens before: those in the first
    ``overlap`` characters, and those in the last ``overlap`` but not within MARGIN of the end.  Only the tokens near
    the two ends are looked at."""
    left, right, n = [], [], len(e)
    for i in range(1, n):
        at = e.token_to_chars(i)[0]
        if at > overlap:
            break
        if at > 0 and (e.token_to_word(i) is None or e.token_to_word(i) != e.token_to_word(i - 1)):
            left.append((at, i))
    for i in range(n - 1, 0, -1):
        at = e.token_to_chars(i)[0]
        if at < length - overlap:
            break
        if at <= length - MARGIN and (e.token_to_word(i) is None or e.token_to_word(i) != e.token_to_word(i - 1)):
            right.append((at, i))
    return left, right[::-1]


def _encode(path: str, overlap: int):
    """Per chunk: its tokens, and the boundaries in its left and its right overlap with the tokens before them."""
    kind = pa.list_(pa.struct([("at", pa.int64()), ("n", pa.int64())]))

    def run(batches):
        t = load(path)
        for batch in batches:
            for low in range(0, batch.num_rows, 32):
                part = batch.slice(low, 32)
                texts, starts = part.column(4).to_pylist(), part.column(3).to_pylist()
                encoded = t.encode_batch(texts, add_special_tokens=False)
                edges = [edge_boundaries(e, len(x), overlap) for e, x in zip(encoded, texts)]
                lists = [[[{"at": at + s, "n": n} for at, n in edge[side]] for edge, s in zip(edges, starts)] for side in (0, 1)]
                yield pa.record_batch([part.column(0), part.column(1), part.column(2), pa.array([len(e) for e in encoded], pa.int64()),
                                       pa.array(lists[0], kind), pa.array(lists[1], kind)],
                                      names=["_row", "chunk", "chunks", "total", "left", "right"])
    return run


def spliced(chunks: DataFrame) -> DataFrame:
    """``_row``, ``n_tokens`` (null if a splice is missing) from encoded chunks; neighbours meet in an equality join.

    With the tokens before splice k in the left chunk (until) and in the right one (skip), the whole has
    sum(until - skip) + tokens of the last chunk.
    """
    left = chunks.select("_row", (F.col("chunk") + 1).alias("chunk"), F.col("right").alias("r"))
    pairs = chunks.join(left, ["_row", "chunk"], "left").withColumn(
        "at", F.get(F.array_intersect(F.transform("left", lambda x: x["at"]), F.transform("r", lambda x: x["at"])), F.lit(0)))
    before = lambda c: F.get(F.filter(c, lambda x: x["at"] == F.col("at")), F.lit(0))["n"]
    pairs = pairs.select("_row", "chunk", "chunks", "total", "at", before("left").alias("skip"), before("r").alias("until"))
    inner = F.col("chunk") > 0
    return pairs.groupBy("_row").agg(
        F.when(F.count_if(inner & F.col("at").isNull()) == 0,
               F.sum(F.when(inner, F.col("until") - F.col("skip")).otherwise(0))
               + F.sum(F.when(F.col("chunk") == F.col("chunks") - 1, F.col("total")).otherwise(0))).alias("n_tokens"))


def count_tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` for every row: counts of whole texts as the tokeniser gives them, without
    added tokens; special strings inside texts count as the special token, its default.

    Null and empty texts have 0.  Repeated rows (also null keys) are counted one by one; an empty table gives an empty
    result; other columns are not carried.  Texts of more than ``chunk`` characters are cut into chunks that different
    tasks encode.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    done = written(rows.mapInArrow(_whole(path, chunk), "_row long, doc_id long, n_bytes long, n_tokens long, long_text string"), "token-counts")
    cut = done.where("n_tokens is null").select("_row", F.col("long_text").alias("text"))
    kind = "array<struct<at:long,n:long>>"
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))   # few bytes but much work: not to be merged by size
    counted = None
    while True:
        pieces = cut.mapInArrow(_chunks(chunk, overlap), "_row long, chunk long, chunks long, start long, text string").repartition(parts, "_row", "chunk")
        encoded = written(pieces.mapInArrow(_encode(path, overlap), f"_row long, chunk long, chunks long, total long, left {kind}, right {kind}"), "token-chunks")
        got = written(spliced(encoded), "token-splices")
        fine = got.where("n_tokens is not null")
        counted = fine if counted is None else counted.unionByName(fine)
        failed = got.where("n_tokens is null").select("_row")
        if not failed.limit(1).count():
            break
        chunk, overlap = chunk * 4, overlap * 4
        cut = cut.join(failed, "_row")
    long = done.where("n_tokens is null").select("_row", "doc_id", "n_bytes").join(counted, "_row")
    return done.where("n_tokens is not null").select("doc_id", "n_bytes", "n_tokens").unionByName(long.select("doc_id", "n_bytes", "n_tokens"))
