"""The pipeline against a plain version of each stage over what the stage before kept."""

import os
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from pennant.llm import mixing, packing, risk_rules, secrets
from pennant.llm.queries import tokenizer_path

from test_llm_dedup import brute_components
from test_llm_rules import brute_metrics, brute_targets

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    top = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        df = stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert df.columns == docs.columns and df.dtypes == docs.dtypes
        df.write.parquet(str(top / name))
        docs = spark.read.parquet(str(top / name))
        out.append(docs)
    return out


def test_quality_stage(spark, staged):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    kept = {r.doc_id for r in staged[0].collect()}
    for r in docs:
        n, _, _, _, _, repeat = brute_metrics(r.text)
        if n < 50 or 100 * repeat > 50 * n:
            assert r.doc_id not in kept
    verdicts = {r._id: r.kept for r in risk_rules.quality_verdicts(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    assert kept == {i for i, k in verdicts.items() if k}


def test_near_dedup_stage(staged):
    _, top = brute_components(staged[0].collect(), 80)
    assert sorted(r.doc_id for r in staged[1].collect()) == sorted(set(top.values()))


def test_secret_stage(staged):
    before = {r.doc_id: r for r in staged[1].collect()}
    after = {r.doc_id: r for r in staged[2].collect()}
    assert before.keys() == after.keys()
    planted = re.compile(r'(?<=token = ")[0-9a-f]{40}|(?<=password=)[0-9a-f]{16}\b|\bAKIA[A-Z2-7]{16}\b')
    for i, r in before.items():
        assert after[i].text == planted.sub(secrets.MARK, r.text) and after[i].n_chars == len(after[i].text)
        assert (after[i].lang, after[i].source) == (r.lang, r.source)


def test_mix_stage(spark, staged):
    docs = staged[2].collect()
    size = {r.doc_id: brute_metrics(r.text)[0] for r in docs}
    per = {}
    for r in docs:
        per[r.source] = per.get(r.source, 0) + size[r.doc_id]
    target = brute_targets(per)
    got = {}
    for r in staged[3].collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    import hashlib
    for r in docs:
        rate = target[r.source] / per[r.source]
        u = int(hashlib.md5(f"mix-1:{r.doc_id}".encode()).hexdigest()[:13], 16) / 2 ** 52
        assert got.get(r.doc_id, 0) == int(rate) + (u < rate - int(rate))


def test_pack_stage(staged):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    copies, ids = {}, {}
    for r in staged[3].collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
        ids.setdefault(r.doc_id, t.encode(r.text, add_special_tokens=False).ids + [1])
    by_seq, held = {}, {}
    for p in staged[4].collect():
        by_seq.setdefault(p.sequence_id, []).append((p.offset, p.length))
        held[p.doc_id] = held.get(p.doc_id, 0) + p.length
        own = ids[p.doc_id][p.start:p.start + p.length]
        assert p.doc_tokens == len(ids[p.doc_id]) and p.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in own))
    assert held == {i: n * len(ids[i]) for i, n in copies.items()}
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_registered():
    names = E.queries()
    assert "pipeline" in names and all(any(k.startswith(f"op{n}_") for k in names) for n in range(1, 14))


ODD = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, label string, band string, _row long"


def odd_documents():
    rng = random.Random(4)
    story = lambda: " ".join(rng.choice(("the", "house", "river", "of")) + f" {rng.choice('bcdfgh')}{rng.choice('aeiou')}{rng.choice('lmnrst')}{rng.randint(1, 400)}" for _ in range(90))
    rows = [(i, story(), ["en", None, "de"][i % 3], ["a", None][i % 2], 1, False, "l", "b", 1) for i in range(30)]
    rows += [(100, None, "en", "a", None, None, None, None, None), (101, "", "en", None, 0, True, None, None, None), (102, "short", None, "a", 5, None, None, None, None),
             rows[3], rows[3], (None, story(), "en", "a", 2, None, None, None, None), (103, "tail " * 50_000, "en", "a", 3, None, None, None, None)]
    return rows


@pytest.mark.parametrize("empty", [False, True])
def test_stages_in_turn_on_odd_and_empty_tables(spark, tmp_path, empty):
    docs = spark.createDataFrame([] if empty else odd_documents(), ODD).repartition(3)
    columns = docs.dtypes
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        made = stage(spark, docs, SF)
        made.write.parquet(str(tmp_path / name))
        docs = spark.read.schema(made.schema).parquet(str(tmp_path / name))
        if name != "pack":
            assert docs.dtypes == columns, name
        if empty:
            assert docs.count() == 0
        elif name == "quality":
            kept = {r.doc_id for r in docs.collect()}
            assert not kept & {100, 101, 102, 103} and kept >= set(range(30)) | {None}
        elif name == "near_dedup":
            ids = [r.doc_id for r in docs.collect()]
            assert len(ids) == len(set(ids)) and None in ids and 0 in ids
        elif name == "secrets":
            assert docs.count() == before.count()
    if not empty:
        assert docs.count() > 0
