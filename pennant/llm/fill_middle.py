"""Fill-in-middle transformation by repeated-capture matching.

One fullmatch of ``(unit)*`` by the regex library keeps every repetition of its group: the number of ends of group 1
is the number of units, and the ends themselves are all places at which a text can be cut.  Nothing is iterated in
Python.  Texts of more than ``SEGMENT`` characters are matched in stretches of as many units, one match each, so that
the ends held at a time are bounded; matching is possessive, so stretches cut a text exactly as one match does.

Where the cuts lie and which form a document takes follow from a hash of its key, so reruns agree and no shuffle is
needed: Python returns three numbers a row, all texts are put together by Spark's own functions.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: One unit is a code point, line breaks included.
CODE_POINT = r"(?s:.)"
SEGMENT = 1 << 20


class Units:
    """Places of units in texts."""

    def __init__(self, unit: str = CODE_POINT, segment: int = SEGMENT):
        import regex

        self.whole = regex.compile(f"({unit})*+")
        self.part = regex.compile(f"({unit}){{1,{segment}}}+")
        self.segment = segment

    def cut(self, text: str, h1: int, h2: int) -> tuple[int | None, int | None, int | None]:
        """Number of units n, and the places behind the first min and max of (h1, h2) modulo n + 1 units; nulls if
        the text is not a sequence of units."""
        if len(text) <= self.segment:
            match = self.whole.fullmatch(text)
            if match is None:
                return None, None, None
            ends = match.ends(1)
            n = len(ends)
            at = [ends[k - 1] if k else 0 for k in sorted((h1 % (n + 1), h2 % (n + 1)))]
            return n, *at
        stretches, n, pos = [], 0, 0            # units and characters before each stretch
        while pos < len(text):
            match = self.part.match(text, pos)
            if match is None or match.end() == pos:
                return None, None, None
            stretches.append((n, pos))
            n, pos = n + len(match.ends(1)), match.end()
        return n, *[self._place(text, stretches, k) for k in sorted((h1 % (n + 1), h2 % (n + 1)))]

    def _place(self, text: str, stretches: list, k: int) -> int:
        if not k:
            return 0
        before, pos = next(s for s in reversed(stretches) if s[0] < k)
        return self.part.match(text, pos).ends(1)[k - before - 1]


_UNITS: dict[tuple, Units] = {}


def cuts(unit: str = CODE_POINT, segment: int = SEGMENT):
    """Arrow function (text, h1, h2) -> n, prefix_end, middle_end; places count code points."""
    kind = pa.struct([("n", pa.int64()), ("prefix_end", pa.int64()), ("middle_end", pa.int64())])

    def run(text: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
        units = _UNITS.setdefault((unit, segment), None) or Units(unit, segment)
        _UNITS[unit, segment] = units
        got = [units.cut(t.as_py() or "", a, b) for t, a, b in zip(text, h1.to_pylist(), h2.to_pylist())]
        return pa.array([dict(zip(("n", "prefix_end", "middle_end"), g)) for g in got], kind)

    return F.arrow_udf(run, "n long, prefix_end long, middle_end long")


def draws(key: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from the hex sha256 of ``seed:key`` (a null key counts as empty)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", unit: str = CODE_POINT, rate: int = 90, spm_rate: int = 20,
              marks: tuple[str, str, str] = ("<P>", "<S>", "<M>"), seed: int = 1, segment: int = SEGMENT) -> DataFrame:
    """One row per document: the key, ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars``, ``output``.

    ``rate`` per cent of the documents are rearranged, of those ``spm_rate`` per cent suffix first (spm:
    ``<S>``suffix``<P>``prefix``<M>``middle), the others prefix first (psm: ``<P>``prefix``<S>``suffix``<M>``middle).
    The rest is plain: output is the text, and the two lengths are null.  Always plain: empty texts, texts that hold a
    mark, and texts that are no sequence of units (their ``n`` is null).

    Null texts count as empty (n 0, plain, empty output); null keys draw as an empty key; rows that repeat are
    transformed one by one, alike if their keys are equal; an empty table gives an empty result; other columns are not
    carried, so their names cannot clash.
    """
    first, last, middle = marks
    h1, h2, h3, h4 = draws(F.col(key), seed)
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).alias("_key"), whole.alias("_text"), h1.alias("_h1"), h2.alias("_h2"), h3.alias("_h3"), h4.alias("_h4"))
    rows = rows.withColumn("_cut", cuts(unit, segment)("_text", "_h1", "_h2"))
    marked = F.lit(False)
    for m in marks:
        marked = marked | F.contains("_text", F.lit(m))
    n, low, high = (F.col(f"_cut.{c}") for c in ("n", "prefix_end", "middle_end"))
    plain = (F.col("_text") == "") | n.isNull() | marked | (F.col("_h3") % 100 >= rate)
    form = F.when(plain, "plain").when(F.col("_h4") % 100 < spm_rate, "spm").otherwise("psm")
    rows = rows.select("_key", "_text", n.alias("n"), form.alias("form"), low.alias("_low"), high.alias("_high"))
    piece = lambda a, b: F.col("_text").substr((a + 1).cast("int"), (b - a).cast("int"))
    prefix, mid = piece(F.lit(0), F.col("_low")), piece(F.col("_low"), F.col("_high"))
    suffix = F.col("_text").substr((F.col("_high") + 1).cast("int"), F.lit(2 ** 31 - 1))
    psm = F.concat(F.lit(first), prefix, F.lit(last), suffix, F.lit(middle), mid)
    spm = F.concat(F.lit(last), suffix, F.lit(first), prefix, F.lit(middle), mid)
    moved = F.col("form") != "plain"
    return rows.select(F.col("_key").alias(key), "n", "form", F.when(moved, F.col("_low")).alias("prefix_chars"),
                       F.when(moved, F.col("_high") - F.col("_low")).alias("middle_chars"),
                       F.when(~moved, F.col("_text")).when(F.col("form") == "psm", psm).otherwise(spm).alias("output"))


def restored(output: Column, form: Column, marks: tuple[str, str, str] = ("<P>", "<S>", "<M>")) -> Column:
    """The text before the transformation, from output and form alone.

    A rearranged text holds no mark, and no mark can arise where a mark meets a text, so the marks cut the output into
    its three pieces.
    """
    pieces = F.split(output, "|".join(f"\\Q{m}\\E" for m in marks))
    a, b, mid = (F.get(pieces, F.lit(i)) for i in (1, 2, 3))
    return F.when(form == "plain", output).when(form == "psm", F.concat(a, mid, b)).otherwise(F.concat(b, mid, a))
