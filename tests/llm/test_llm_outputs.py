"""Grammar-compressed ids, the Merkle manifest and fill-in-middle against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pennant.llm import fill_middle, grammar_ids, merkle
from pennant.llm.queries import QUERIES, tokenizer_path
from pennant.session import checkpoint_dir

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, hash string, path string, payload string"
WORD = tokenizer_path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


def texts():
    random.seed(11)
    bits = ["the ", "The cat ", "sat", "\n", "  ", "ÄÖ ", "日本", "🙂", "<P>", "<S", "<", ">", "é", "123 ", "!", "\r\n", "\x00"]
    made = ["".join(random.choice(bits) for _ in range(random.randint(1, 200))) for _ in range(80)]
    return made + ["", None, " ", "\n", "a", "<", "ab " * 3000, "x" * 5000, "the cat sat on the mat. " * 800]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i * 3 - 40, t, ["en", None, "", "de", "é"][i % 5], ["s", None][i % 2], i if i % 3 else None, 1, "clash", "clash", "clash") for i, t in enumerate(texts())]
    rows += [(None, "null key", "en", "s", 1, None, None, None, None), rows[3], rows[3], (rows[4][0], "other text of the id", *rows[4][2:])]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


# --- token ids ------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("seed", range(40))
def test_a_block_gives_back_its_ids(seed):
    r = np.random.default_rng(seed)
    sizes = r.integers(1, 80, r.integers(1, 40))
    ids = r.integers(0, r.integers(1, 12), sizes.sum()).astype(np.uint32) * 1000
    if seed % 8 == 0:
        ids[:] = 49407
    b = grammar_ids.Block(grammar_ids.compress(ids, sizes, np.zeros(len(sizes), grammar_ids._ENTRY), 2 + seed % 4, 0.0))
    assert b.ids().tolist() == ids.tolist()
    ends = np.cumsum(sizes)
    for i, (n, end) in enumerate(zip(sizes, ends)):
        low, high = sorted(r.integers(0, n + 1, 2))
        assert b.slice(i, low, high).tolist() == ids[end - n:end][low:high].tolist()


def test_frequent_pairs_become_rules_and_none_crosses_a_document():
    ids = np.tile(np.array([5, 6, 7, 8], np.uint32), 500)
    b = grammar_ids.Block(grammar_ids.compress(ids, np.array([1000, 1000]), np.zeros(2, grammar_ids._ENTRY)))
    assert len(b.sequence) < 40 and len(b.made) > 3 and (b.lengths[len(b.alphabet):] >= 2).all()
    first = b.entries["symbol"]
    assert b.lengths[b.sequence[:first[1]]].sum() == 1000


@pytest.mark.parametrize("block", [1 << 18, 256])
def test_files_give_back_all_documents(spark, odd, block):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORD)
    files = f"{checkpoint_dir(spark)}/grammar-{block}"
    grammar_ids.write(odd, files, WORD, 1, block=block)
    got = grammar_ids.read(spark, files).withColumn("crc", F.crc32("ids")).orderBy("start").collect()
    want = [(r.doc_id, t.encode(r.text or "", add_special_tokens=False).ids + [1]) for r in odd.collect()]
    assert [r.doc_id for r in got] == sorted([d for d, _ in want], key=lambda d: (d is not None, d or 0))
    at, stream = 0, []
    for r in got:
        own = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert (r.start, r.n_tokens, r.crc) == (at, len(own), zlib.crc32(bytes(r.ids)))
        stream += own
        at += len(own)
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])
    assert sorted([(r.doc_id, np.frombuffer(bytes(r.ids), "<u4").tolist()) for r in got], key=key) == sorted(want, key=key)
    wanted = [(0, 1), (5, 5000), (at - 3, at + 10), (at, at + 5), (7, 7), (100, 101)]
    found = {}
    for r in sorted(grammar_ids.lookup(spark, files, spark.createDataFrame(wanted, "low long, high long")).collect(), key=lambda r: r["at"]):
        found.setdefault((r.low, r.high), []).extend(np.frombuffer(bytes(r.ids), "<u4").tolist())
    assert found == {(a, b): stream[a:b] for a, b in wanted if stream[a:b]}


def test_files_of_an_empty_table(spark, odd):
    files = f"{checkpoint_dir(spark)}/grammar-empty"
    grammar_ids.write(odd.limit(0), files, WORD)
    assert grammar_ids.read(spark, files).count() == 0


def test_grammar_query_is_the_tokenisers(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORD)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op11_grammar_token_files"](spark, SF).collect()}
    at = 0
    for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect():
        ids = t.encode(r.text or "", add_special_tokens=False).ids + [1]
        assert got.pop(r.doc_id) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert not got


# --- Merkle manifest ------------------------------------------------------------------------------------------------

def brute_tree(leaves):
    """Levels from the leaves to the root."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i:i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def brute_proof(levels, i):
    out = []
    for level in levels[:-1]:
        run = i // 8 * 8
        out.append(("".join(level[run:i]), "".join(level[i + 1:run + 8])))
        i //= 8
    return out


def brute_manifest(rows):
    """(group, leaf) -> proofs, and the root; rows: (group, order, leaf)."""
    groups = {}
    for g, o, leaf in rows:
        groups.setdefault(g, []).append((o, leaf))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: brute_tree([x[1] for x in sorted(groups[g], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))]) for g in order}
    top = brute_tree([trees[g][-1][0] for g in order])
    out = []
    for i, g in enumerate(order):
        for j, leaf in enumerate(trees[g][0]):
            out.append((g, leaf, trees[g][-1][0], brute_proof(trees[g], j) + brute_proof(top, i)))
    return out, top[-1][0]


def run_manifest(df, order="doc_id"):
    leaf = merkle.row_hash(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
    rows, root = merkle.manifest(df, leaf, F.col("lang"), [F.col(order)], {"lang": F.col("lang"), "doc_id": F.col("doc_id")})
    return rows.withColumn("folded", merkle.fold(F.col("leaf"), F.col("path"))), root


def leaf_of(r):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, r.n_chars, r.text)))


def test_manifest_is_the_plain_tree(spark, odd):
    rows, root = run_manifest(odd)
    want, top = brute_manifest([(r.lang, r.doc_id, leaf_of(r)) for r in odd.collect()])
    got = [(r.lang, r.leaf, r.subroot, [tuple(x) for x in r.path]) for r in rows.collect()]
    assert root == top and sorted(got, key=str) == sorted(want, key=str)
    assert {r.folded for r in rows.select("folded").collect()} == {root}


@pytest.mark.parametrize("sizes", [[1], [8], [9, 1], [512, 64, 65], [513, 1025, 2], [4097]])
def test_tree_sizes_at_the_edges_of_stored_levels(spark, sizes):
    rows = [(i, f"t{i}", f"g{g}", None, None, None, None, None, None) for g, n in enumerate(sizes) for i in range(g * 10_000, g * 10_000 + n)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    made, root = run_manifest(df)
    want, top = brute_manifest([(r.lang, r.doc_id, leaf_of(r)) for r in df.collect()])
    got = [(r.lang, r.leaf, r.subroot, [tuple(x) for x in r.path]) for r in made.collect()]
    assert root == top and sorted(got) == sorted(want)
    assert all(r.folded == root for r in made.collect())


def test_manifest_of_an_empty_table(spark, odd):
    rows, root = run_manifest(odd.limit(0))
    assert root is None and rows.count() == 0


def test_tampered_rows_fail(spark):
    got = QUERIES["op12_merkle_manifest"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"), "doc_id").collect()
    changed = lambda r: zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and r.text is not None and any("A" <= c <= "Z" for c in r.text)
    assert any(changed(r) for r in got) and all(r.verified != changed(r) for r in got)


# --- fill-in-middle -------------------------------------------------------------------------------------------------

def brute_fill(doc_id, text):
    text = text or ""
    digest = sha(f"1:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(text)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:low], text[low:high], text[high:]
    if h[3] % 100 < 20:
        return n, "spm", low, high - low, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", low, high - low, f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("segment", [1 << 20, 7])
def test_forms_are_those_of_the_rule(spark, odd, segment):
    made = fill_middle.transform(odd, segment=segment).withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    want = [(r.doc_id, *brute_fill(r.doc_id, r.text), r.text or "") for r in odd.collect()]
    assert sorted([tuple(r) for r in made], key=str) == sorted(want, key=str)
    assert {r.form for r in made} == {"plain", "psm", "spm"}


def test_other_units(spark):
    units = fill_middle.Units(r"\s*\S+", 3)
    text = "one two  three\nfour five six seven eight"
    whole = fill_middle.Units(r"\s*\S+")
    assert [units.cut(text, a, b) for a in range(9) for b in range(9)] == [whole.cut(text, a, b) for a in range(9) for b in range(9)]
    assert whole.cut(text, 2, 3) == (8, 7, 14) and whole.cut(" ", 1, 2) == (None, None, None) and units.cut(text + " ", 1, 2) == (None, None, None)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["a b c d", "tail ", "", None])], "doc_id long, text string")
    got = {r.doc_id: r for r in fill_middle.transform(df, unit=r"\s*\S+", rate=100).collect()}
    assert got[0].n == 4 and got[0].form != "plain" and got[1].n is None and got[1].form == "plain" and got[1].output == "tail "


def test_fill_of_an_empty_table(spark, odd):
    assert fill_middle.transform(odd.limit(0)).count() == 0
