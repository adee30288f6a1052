"""Token counts and packing against the tokeniser itself."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pennant.llm import packing, token_counts
from pennant.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, place string"
BYTE, WORD = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")


def odd_texts():
    random.seed(5)
    bits = [" ", "  ", "\n", "\t", "the", "hello", "'s", "'re", "123", "ÄÖ", "日本", "<|endoftext|>", "!!", "a" * 40, " ", "é", "<|start",
            "\x0b", "\x1c", " ", "İ", "Σς", "oftext|>", "🙂", "'"]
    texts = ["".join(random.choice(bits) for _ in range(random.randint(1, 400))) for _ in range(60)]
    return texts + ["", None, " ", "\n\n\n", "x" * 9000, " " * 5000, "ab " * 4000, "<|endoftext|>" * 300, "a'r" + "e" * 50]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, None, None, None, "clash") for i, t in enumerate(odd_texts())]
    rows += [(None, "null key", None, None, None, None), (3, rows[3][1], None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("chunk,overlap", [(200, 60), (1000, 64), (32768, 512)])
def test_counts_are_those_of_whole_texts(spark, odd, chunk, overlap):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BYTE)
    got = token_counts.count_tokens(odd, BYTE, chunk=chunk, overlap=overlap).collect()
    want = [(r.doc_id, len((r.text or "").encode()), len(t.encode(r.text or "", add_special_tokens=False).ids)) for r in odd.collect()]
    key = lambda x: (x[0] is None, x)
    assert sorted(map(tuple, got), key=lambda x: str(x)) == sorted(want, key=lambda x: str(x))


def test_counts_of_an_empty_table(spark, odd):
    assert token_counts.count_tokens(odd.limit(0), BYTE).count() == 0


def test_packing_round_trip(spark, odd):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORD)
    pieces = packing.pack(odd, WORD, 256, 1).select("*", F.crc32("ids").alias("crc")).collect()
    by_doc, by_seq = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_seq.setdefault(p.sequence_id, []).append(p)
        assert p.crc == zlib.crc32(bytes(p.ids)) and len(p.ids) == 4 * p.length
    texts = {}
    for r in odd.collect():
        texts.setdefault(r.doc_id, []).append(r.text or "")
    assert set(by_doc) == set(texts)
    for d, own in texts.items():
        want = t.encode(own[0], add_special_tokens=False).ids + [1]
        assert sum(p.length for p in by_doc[d]) == len(want) * len(own)
        if len(own) == 1:
            got = b"".join(bytes(p.ids) for p in sorted(by_doc[d], key=lambda p: p.start))
            assert np.frombuffer(got, "<u4").tolist() == want
    full = 0
    for s in by_seq.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 256
        full += at == 256
    assert full >= len(by_seq) - 1
    assert sorted(by_seq) == list(range(len(by_seq)))
    whole = packing.sequences(packing.pack(odd, WORD, 256, 1), 256, 7).collect()
    assert sum(r.n_tokens for r in whole) == sum(p.length for p in pieces)
    for r in whole:
        ids = np.frombuffer(bytes(r.ids), "<u4")
        assert len(ids) == 256 or len(ids) == r.n_tokens and bin(r.n_tokens).count("1") == 1
        assert (ids[r.n_tokens:] == 7).all() and ids.tolist()[:r.n_tokens].count(1) <= len(r.doc_ids)


def test_packing_an_empty_table(spark, odd):
    assert packing.pack(odd.limit(0), WORD).count() == 0


def test_hilbert_neighbours_differ_in_one_step():
    side = 8
    grid = np.array([[x, y, z] for x in range(side) for y in range(side) for z in range(side)])
    key = packing.hilbert_key(grid, 3)
    assert sorted(key) == list(range(side ** 3))
    walk = grid[np.argsort(key)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_like_documents_are_neighbours(spark):
    random.seed(2)
    vocabulary = [["alpha beta gamma delta".split(), "un deux trois quatre".split(), "rot blau gelb weiss".split()][i % 3] for i in range(60)]
    rows = [(i, " ".join(random.choices(v, k=80)), None, None, None, None) for i, v in enumerate(vocabulary)]
    got = packing.pack(spark.createDataFrame(rows, SCHEMA), WORD, 1 << 20).orderBy("sequence_id", "offset").collect()
    kinds = [p.doc_id % 3 for p in got]
    assert sum(a != b for a, b in zip(kinds, kinds[1:])) <= 12


def test_words_are_kept_in_bounded_characters():
    from pennant.llm.words import Generations

    g = Generations(most=1000, most_chars=5000)
    for i in range(200):
        new = g.missing({"日本" * 100 + str(i), "the"})
        assert ("the" in new) == (i == 0)
        g.young.update((k, len(k)) for k in new)
        assert sum(map(len, g.young)) <= 5000 + 2 * 210 and sum(map(len, g.old)) <= 5000 + 2 * 210


def test_counts_of_lines_without_spaces(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BYTE)
    random.seed(3)
    rows = [(i, "".join(random.choice("日本語中文字あいう") for _ in range(3000)) + "\nthe end", None, None, None, None) for i in range(40)]
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(spark.createDataFrame(rows, SCHEMA), BYTE).collect()}
    assert got == {r[0]: len(t.encode(r[1], add_special_tokens=False).ids) for r in rows}
