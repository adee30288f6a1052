"""Vectorised hashing of words and shingles: one pass of array operations over a whole batch of texts."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_UNBASE = np.uint64(pow(int(_BASE), -1, 2 ** 64))
_STEP = 1 << 16


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser on unsigned 64-bit integers (xor-shift and odd multipliers)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


def seeds(n: int, seed: int) -> np.ndarray:
    """n fixed odd multipliers."""
    return mix64(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) | np.uint64(1)


_POW, _INV = powers(int(_BASE), _STEP + 1), powers(int(_UNBASE), _STEP + 1)


def _between(raw: np.ndarray, first: int, last: int) -> np.ndarray:
    """Which bytes lie from first to last (arithmetic is faster than a table)."""
    return raw - np.uint8(first) <= np.uint8(last - first)


def _lower(raw: np.ndarray) -> np.ndarray:
    return raw + (_between(raw, 65, 90).view(np.uint8) << np.uint8(5))


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True, places: bool = False, closing: bool = False):
    """64-bit hashes of the words of many texts, and for each text the number of its first word (one more at the end);
    with ``places`` also where each word starts and ends.  With ``closing`` a word also ends before one of .,;:!? that
    follows an ASCII letter or digit.

    ``raw`` holds the texts' bytes one after another; ``starts``/``ends`` are their places, ascending, without gaps.
    Words are maximal runs without white space; A-Z count as a-z if ``lower``.
    """
    space = np.ones(len(raw) + 1, bool)
    space[:-1] = (raw == 32) | _between(raw, 9, 13)
    inside = ~space[:-1]
    before = np.ones(len(raw), bool)
    before[1:] = space[:-2]
    cut = starts[(starts < ends)]
    before[cut] = True                               # a word also begins where a text begins
    after = space[1:].copy()
    after[ends[starts < ends] - 1] = True
    if closing:
        stop = _between(raw, 58, 59)                  # .,;:!? and before them a letter or digit
        for c in b".,!?":
            stop |= raw == c
        alnum = _between(raw | np.uint8(32), 97, 122) | _between(raw, 48, 57)
        turn = stop[1:] & alnum[:-1]
        before[1:] |= turn
        after[:-1] |= turn
    w0 = np.flatnonzero(inside & before)
    w1 = np.flatnonzero(inside & after) + 1
    first = np.searchsorted(w0, np.append(starts, len(raw)))
    code = lambda a, b: (_lower(raw[a:b]) if lower else raw[a:b]).astype(np.uint64) + np.uint64(1)
    # sum of byte * base^place, place counted inside steps of 64 Ki bytes; a word's sum is shifted back to its start
    h = np.zeros(len(w0), np.uint64)
    low = 0
    while low < len(w0):
        origin = w0[low]
        high = int(np.searchsorted(w1, origin + _STEP, side="right"))
        if high <= low:                              # one word longer than a step
            value = np.zeros(1, np.uint64)
            for a in range(origin, w1[low], _STEP):
                part = code(a, min(a + _STEP, w1[low]))
                value = mix64(value + (part * _POW[:len(part)]).sum(dtype=np.uint64))
            h[low] = value[0]
            low += 1
            continue
        part = code(origin, w1[high - 1])
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * _POW[:len(part)], out=total[1:])
        a, b = w0[low:high] - origin, w1[low:high] - origin
        h[low:high] = (total[b] - total[a]) * _INV[a]
        low = high
    h = mix64(h ^ mix64((w1 - w0).astype(np.uint64)))
    return (h, first, w0, w1) if places else (h, first)


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles of each text (a text with fewer words: the whole sequence as one), and the
    number of each text's first shingle (one more at the end); a text without words has none."""
    n = np.diff(first)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    out_first = np.zeros(len(n) + 1, np.int64)
    np.cumsum(count, out=out_first[1:])
    if not len(words):
        return np.zeros(0, np.uint64), out_first
    mult = seeds(k, 7)
    padded = np.append(words, np.zeros(k, np.uint64))
    whole = np.zeros(len(words), np.uint64)
    for j in range(k):
        whole += mix64(padded[j:j + len(words)]) * mult[j]
    place = np.arange(out_first[-1]) - np.repeat(out_first[:-1], count) + np.repeat(first[:-1], count)
    h = whole[place]
    for d in np.flatnonzero((n > 0) & (n < k)):      # short texts: only their own words
        own = mix64(words[first[d]:first[d + 1]]) * mult[:n[d]]
        h[out_first[d]] = np.append(own, np.uint64(n[d])).sum(dtype=np.uint64)
    return mix64(h), out_first


def text_bytes(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts and ends of an Arrow string column (null: empty) without building Python strings."""
    import pyarrow as pa
    import pyarrow.compute as pc

    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if column.buffers()[2] is None:
        raw = np.zeros(0, np.uint8)
    else:
        raw = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    return raw, offsets[:-1], offsets[1:]


def runs(starts: np.ndarray, ends: np.ndarray, most: int):
    """Slices of consecutive texts of about ``most`` bytes (one text at least)."""
    low = 0
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(ends, starts[low] + most, side="right")))
        yield low, high
        low = high
