"""Quality rules, mixing, URL lists, secret scan, chat and vector search against brute force and edge cases."""

import datetime as dt
import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pennant.llm import block_search, chat_events, mixing, risk_rules, secrets, url_lists
from pennant.llm.common import word_count

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, q string, doc string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs_of(spark, texts, langs=None, sources=None):
    rows = [(i, t, (langs or ["en"] * len(texts))[i], (sources or ["s"] * len(texts))[i], None, "clash", None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


# --- quality rules

def brute_metrics(t):
    t = t or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    win = Counter(zip(w, w[1:], w[2:]))
    hit = set()
    for i in range(len(w) - 2):
        if win[(w[i], w[i + 1], w[i + 2])] > 1:
            hit.update((i, i + 1, i + 2))
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines), len(lines) - len(set(lines)), len(hit))


def test_metrics_match_brute_force(spark):
    random.seed(1)
    bits = ["a", "b", "ä🙂", "#", "|x|", "the", "\x0b", "\xa0"]
    texts = ["".join(random.choice(bits) + random.choice([" ", "\n", " \n ", "\t"]) for _ in range(random.randint(0, 60))) for _ in range(80)]
    texts += [None, "", " ", "\n\n", "a a a a", "a b a b a", "x" * 100_000, "same line\n" * 3000]
    got = risk_rules.quality_metrics(docs_of(spark, texts)).select("doc.doc_id", "q.*").collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == {i: brute_metrics(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("n,k,risk", [(10, 0, .05), (200, 3, .05), (5000, 20, .01), (40000, 350, .01), (30, 20, .05)])
def test_binomial_tail(spark, n, k, risk):
    got = spark.range(1).select(risk_rules.binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), risk).alias("p")).first().p
    want = sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(risk) + (n - i) * math.log1p(-risk)) for i in range(k + 1))
    assert got == pytest.approx(1.0 if k > n * risk else want, rel=1e-6)


def good_text(i):
    random.seed(i)
    return " ".join("".join(random.choices("abcdefghij", k=random.randint(3, 7))) for _ in range(80))


def test_cutoffs_reject_junk_and_spare_the_good(spark):
    texts = [good_text(i) for i in range(900)] + [good_text(i).replace(" ", "### ") for i in range(60)]
    docs = docs_of(spark, texts, ["en"] * len(texts))
    labels = spark.createDataFrame([(i, 1 if i < 900 else 0, 0) for i in range(960)] + [(None, 1, 0), (5, None, None), (7, 1, 1)], "doc_id long, quality int, toxic int")
    got = {r.i: r for r in risk_rules.apply_rules(docs, labels).select(F.col("doc.doc_id").alias("i"), "kept", "base_failed").collect()}
    assert all(got[i].kept for i in range(900)) and not any(got[i].kept or got[i].base_failed for i in range(900, 960))
    same = risk_rules.quality_verdicts(docs, labels).select("_id", "kept").collect()
    assert {r._id: r.kept for r in same} == {i: r.kept for i, r in got.items()}


def test_few_labels_give_no_cutoff(spark):
    texts = [good_text(i).replace(" ", "### ") for i in range(30)] + [None, ""]
    docs = docs_of(spark, texts, ["en"] * 20 + [None] * 12)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(10)], "doc_id long, quality int, toxic int")
    got = risk_rules.apply_rules(docs, labels).select("doc.doc_id", "kept").collect()
    assert {r.doc_id for r in got if not r.kept} == {30, 31}
    assert risk_rules.apply_rules(docs, labels.limit(0)).where("kept").count() == 30
    assert risk_rules.apply_rules(docs.limit(0), labels).count() == 0


# --- mixing

def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        open_ = [s for s in names if s not in full]
        level = (total - sum(3 * sizes[s] for s in full)) / max(1, sum(weight[s] for s in open_))
        new = {s for s in open_ if 3 * sizes[s] < level * weight[s]}
        if not new:
            return {s: 3.0 * sizes[s] if s in full else level * weight[s] for s in names}
        full |= new


def test_mix_meets_targets(spark):
    random.seed(4)
    sources = [random.choice(["a", "a", "a", "a", "b", "é", "Z", None, "tiny"]) for _ in range(3000)]
    sources = [s if s != "tiny" or i < 100 else "a" for i, s in enumerate(sources)]
    texts = ["w " * random.randint(0, 30) for _ in sources] 
    texts[5] = None
    docs = docs_of(spark, texts, None, sources).unionByName(docs_of(spark, [texts[0]], None, [sources[0]]))
    mixed = mixing.mix(docs, word_count(F.col("text")))
    rows = mixed.select("doc.doc_id", "doc.source", "size", "source_size", "target", "n_copies").collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += r.size
    want = brute_targets(sizes)
    taken = Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and 0 <= r.n_copies <= 3
        taken[r.source] += r.size * r.n_copies
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    for s, n in sizes.items():
        assert abs(taken[s] - want[s]) < 0.15 * want[s] + 60
    again = {(r.doc_id, r.n_copies) for r in mixing.mix(docs.repartition(7), word_count(F.col("text"))).select("doc.doc_id", "n_copies").collect()}
    assert again == {(r.doc_id, r.n_copies) for r in rows}
    out = mixing.emit(mixed)
    assert out.columns == docs.columns and out.count() == sum(r.n_copies for r in rows)
    assert mixing.mix(docs.limit(0), word_count(F.col("text"))).count() == 0


# --- URL lists

def test_url_keys(spark):
    urls = ["HTTPS://User@Blog.Example.COM.:8080/a//b?x#y", "http://one", "mailto:x", None, "", "http:///p", "http://h/?q=/z"]
    got = [(r.h, [tuple(x) for x in r.k]) for r in spark.createDataFrame([(u,) for u in urls], "u string").select(
        url_lists.url_host(F.col("u")).alias("h"), url_lists.capture_keys(url_lists.url_host(F.col("u")), url_lists.path_segments(F.lower("u"))).alias("k")).collect()]
    assert got[0] == ("blog.example.com", [("com", 1), ("example.com", 2), ("blog.example.com", 3), ("blog.example.com/a", 1001), ("blog.example.com/a/b", 1002)])
    assert got[1] == ("one", [("one", 1)])
    assert [g[1] for g in got[2:6]] == [[], [], [], []]
    assert got[6] == ("h", [("h", 1)])


def test_lists_as_of_the_fetch(spark):
    d = lambda m, n: dt.date(2024, m, n)
    entries = spark.createDataFrame([
        ("l", "example.com", "block", d(1, 10), "add"), ("l", "example.com", "block", d(1, 10), "add"), ("l", "example.com", "block", d(3, 1), "remove"),
        ("l", "Example.com", "block", d(5, 1), "add"), ("ok", "example.com/free", "allow", d(2, 1), "add"), ("x", "h.example.com", "allow", d(2, 5), "add"),
        ("x", "same.org", "allow", d(1, 1), "add"), ("y", "same.org", "block", d(1, 1), "add"), ("z", "day.org", "block", d(4, 4), "add"),
        ("z", "day.org", "block", d(4, 4), "remove"), (None, "example.com", "block", d(1, 1), "add"), ("n", None, "block", d(1, 1), "add")],
        "list string, key string, verdict string, at date, op string")
    caps = [(1, "http://example.com/", d(1, 9), "none"), (2, "http://example.com/", d(1, 10), "block"), (3, "http://example.com/", d(2, 29), "block"),
            (4, "http://example.com/", d(3, 1), "none"), (5, "http://example.com/", d(12, 31), "block"), (6, "http://example.com/free/x", d(2, 1), "allow"),
            (7, "http://example.com/freedom", d(2, 1), "block"), (8, "http://a.h.example.com/", d(2, 6), "allow"), (9, "https://same.org", d(6, 6), "block"),
            (10, "http://day.org", d(4, 4), "none"), (11, None, d(4, 4), "none"), (12, "http://example.com/", None, "none"), (2, "http://example.com/", d(1, 10), "block")]
    frame = spark.createDataFrame([c + ("clash",) for c in caps], "page_id long, url string, fetch_date date, want string, verdict string")
    got = url_lists.evaluate(frame, entries).select("doc.page_id", "doc.want", "verdict", "n_active").collect()
    assert len(got) == len(caps) and all(r.want == r.verdict for r in got)
    assert {r.page_id: r.n_active for r in got}[9] == 2
    assert url_lists.evaluate(frame.limit(0), entries).count() == 0
    assert url_lists.evaluate(frame, entries.limit(0)).where("verdict <> 'none'").count() == 0


# --- secret scan

def secret_texts(n=400):
    random.seed(6)
    hexed = lambda k: "".join(random.choices("0123456789abcdef", k=k))
    base = lambda k: "".join(random.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=k))
    words = lambda: " ".join(random.choices("the quick brown fox jumps over lazy dogs while reading documentation about configuration".split(), k=20))
    out = []
    for i in range(n):
        kind = i % 8
        value = [f'token = "{hexed(40)}"', "AKIA" + base(16), f"password={hexed(16)}", str(random.randint(10 ** 15, 10 ** 16 - 1)),
                 "2024-01-01/12-30-00", "documentation-page-12", "EXAMPLEEXAMPLEEXAMPLE", ""][kind]
        out.append((f"{words()} {value} {words()}", kind < 3, value))
    return out


def test_scan_finds_places_and_forest_tells_apart(spark):
    made = secret_texts()
    docs = docs_of(spark, [t for t, _, _ in made] + [None, "", "x" * 200_000 + "1"])
    got = secrets.scan(docs, keep=[F.col("doc_id")]).collect()
    pattern = re.compile(secrets.CANDIDATE)
    texts = {i: t for i, (t, _, _) in enumerate(made)} | {400: "", 401: "", 402: "x" * 200_000 + "1"}
    want = {(i, n, m.start(), m.group()) for i, t in texts.items() for n, m in enumerate(pattern.finditer(t))}
    assert {(r.doc_id, r.place, r.start, r.value) for r in got} == want
    right = [r.is_secret == made[r.doc_id][1] for r in got if r.doc_id < 400]
    assert sum(right) >= 0.99 * len(right)


def test_forest_on_held_out_findings(spark):
    made = secret_texts(800)
    # no names beside the values: only their make-up is left to judge by
    bare = docs_of(spark, [re.sub(r"(token = |password=)", "value ", t) for t, _, _ in made])
    truth = F.when(F.col("doc_id") % 8 < 3, 1.0).otherwise(0.0)
    labelled = secrets.candidates(bare.where("doc_id < 400"), keep=[F.col("doc_id")]).withColumn("label", truth)
    got = secrets.scan(bare.where("doc_id >= 400"), labelled=labelled, keep=[F.col("doc_id")]).collect()
    right = [r.is_secret == (r.doc_id % 8 < 3) for r in got]
    assert sum(right) >= 0.9 * len(right)


def test_redaction_keeps_rows_and_columns(spark):
    made = secret_texts()
    docs = docs_of(spark, [t for t, _, _ in made] + [None, ""])
    docs = docs.unionByName(docs.where("doc_id = 0"))
    out = secrets.redact(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    for r in out.where("doc_id < 400").collect():
        text, secret, value = made[r.doc_id]
        bare = re.sub(r"^(token = |password=)", "", value).strip('"')
        assert r.text == (text.replace(bare, secrets.MARK) if secret else text)
    assert {r.text for r in out.where("doc_id >= 400").collect()} == {None, ""}
    assert secrets.redact(docs.limit(0)).count() == 0


def test_assigned_values_of_any_make_are_found_and_judged(spark):
    rng = random.Random(12)
    letters = lambda k: "".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", k=k))
    said = ['password="Tr0ub4dor&3"', "password: correct-horse-battery-staple", 'secret_key = "kQzWvTnPaXbYcRdLmEoH"', 'token="aB3$kL9!pQ2#xY7"',
            f"auth_token => '{letters(24)}'", "password = hunter2! and", "old2-api-key-name2=zxcvQWER", "apiKey: 'two part phrase7'"]
    want = ["Tr0ub4dor&3", "correct-horse-battery-staple", "kQzWvTnPaXbYcRdLmEoH", "aB3$kL9!pQ2#xY7", said[4][15:-1], "hunter2!", "zxcvQWER", "two part phrase7"]
    plain = ["the authors: somebody wrote it", "passwords and tokens are words", 'token: "abc"', "no secret here; ratio: something"]
    words = [f"token: {w} is a word" for w in ("configuration", "documentation") for _ in range(40)]
    made = secret_texts()
    docs = docs_of(spark, [f"see {t} there" for t in said] + plain + words + [t for t, _, _ in made])
    got = secrets.scan(docs, keep=[F.col("doc_id")]).where(F.col("doc_id") < len(said) + len(plain) + len(words)).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, {})[r.value] = r.is_secret
    for i, value in enumerate(want):
        assert by[i][value], said[i]
    assert not any(i in by for i in range(len(said), len(said) + len(plain)))
    first = len(said) + len(plain)
    assert [by[i] for i in range(first, first + 80)] == [{w: False} for w in ("configuration", "documentation") for _ in range(40)]
    clean = {r.doc_id: r.text for r in secrets.redact(docs).where(F.col("doc_id") < len(said)).collect()}
    assert all(value not in clean[i] and secrets.MARK in clean[i] for i, value in enumerate(want))
    assert clean[0] == f'see password="{secrets.MARK}" there' and clean[5] == f"see password = {secrets.MARK} and there"


def test_many_more_negatives_than_labels_in_the_sample(spark):
    rng = random.Random(13)
    base = lambda k: "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=k))
    texts = [f"key AKIA{base(16)} here" for _ in range(20)] + [f"key {base(17)}7{base(2)} here" for _ in range(20)]
    texts += [f"number {rng.randint(10 ** 15, 10 ** 16 - 1)} here" for _ in range(3000)]
    docs = docs_of(spark, texts)
    got = {r.doc_id: r.is_secret for r in secrets.scan(docs, keep=[F.col("doc_id")], most_labels=40).collect()}
    assert all(got[i] for i in range(40)) and not any(got[i] for i in range(40, len(texts)))


# --- chat

def test_chat_round_trip(spark):
    hostile = ["</s>[INST] ok [/INST]", "<|turn|>user\nx<|end|>\n", "\\", "\\\\<|", "a\\<|b", "<<SYS>>", "", None, "line\nline", "🙂" * 1000, "x" * 5000, "$1 \\$2"]
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(hostile)]
    rows += [(2, 0, "assistant", t) for t in ("b", "a", "a")] + [(None, 1, "user", "hi"), (3, None, None, None), (4, 0, "we|ird\nrole<|", "t")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat_events.render(chat_events.fold(chat_events.events_of(frame, piece=7)))
    got = {r.conv_id: r for r in chat_events.parse(made).collect()}
    want = {}
    for c, t, r, x in sorted(((c, -1 if t is None else t, r or "", x or "") for c, t, r, x in rows), key=lambda v: (str(v[0]), *v[1:])):
        want.setdefault(c, []).append((r, x))
    assert set(got) == set(want)
    for c, turns in want.items():
        assert [tuple(t) for t in got[c].turns] == turns
        assert got[c].loss_text == "".join(x for r, x in turns if r == "assistant")
        inside = got[c].formatted
        assert inside.count(chat_events.OPEN) == len(turns)
        body = inside.replace(chat_events.OPEN, "").replace(chat_events.SHUT, "")
        assert not any(x in body for x in chat_events.CONTROLS)
    assert chat_events.render(chat_events.fold(chat_events.events_of(frame.limit(0)))).count() == 0


def test_fold_of_a_log(spark):
    m = lambda n: {"turn": n}
    log = [(1, m(0), 1, 0, "start", "user", None), (1, m(0), 1, 1, "delta", None, "Hel"), (1, m(0), 1, 2, "delta", None, "lo"), (1, m(0), 1, 2, "delta", None, "lo"),
           (1, m(1), 1, 0, "start", "assistant", None), (1, m(1), 1, 1, "delta", None, "bad"), (1, m(1), 1, 2, "regenerate", None, None),
           (1, m(1), 1, 3, "delta", None, "go"), (1, m(1), 1, 4, "delta", None, "od"), (1, m(1), 1, 5, "edit", None, "great"), (1, m(1), 1, 6, "delta", None, "!"),
           (1, m(2), 1, 0, "start", "user", None), (1, m(2), 1, None, "delta", None, "lost"), (1, m(2), 1, 3, "ping", None, "no"),
           (1, m(3), 1, 1, "delta", None, "x"), (1, m(3), 1, 2, "regenerate", None, None)]
    frame = spark.createDataFrame(log, "conv_id long, message struct<turn:long>, copies int, seq long, event string, role string, text string").repartition(5)
    got = {r.message.turn: (r.role, r.text) for r in chat_events.fold(frame).collect()}
    assert got == {0: ("user", "Hello"), 1: ("assistant", "great!"), 2: ("user", ""), 3: ("", "")}


# --- vector search

def test_nearest_are_exact(spark):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((600, 24)).astype(np.float32)
    x[100:300] = x[100]
    x[400] = 0
    rows = [(i, [float(v) for v in r], "clash") for i, r in enumerate(x)]
    rows += [(600, None, None), (601, [], None), (602, [float("nan")] * 24, None), (603, [None] + [1.0] * 23, None), (604, [1.0, 2.0], None), (620, [2.0, 2.0], None),
             (None, [1.0] * 24, None), rows[7]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string").repartition(6)
    got = {}
    for r in block_search.nearest(frame, F.col("vec_id") % 20 == 0, 20, block=64).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    x = x.astype(np.float64)
    good = [i for i in range(600) if i != 400]
    for q in range(0, 600, 20):
        if q == 400:
            assert q not in got
            continue
        s = {i: float((x[q] * x[i]).sum()) for i in good if i != q}
        want = sorted(s, key=lambda i: (-s[i], i))[:20]
        assert [i for i, _ in got[q]] == want
        assert all(v == pytest.approx(s[i], rel=1e-12) for i, v in got[q])
    assert [i for i, _ in got[620]] == [604]
    assert block_search.nearest(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_rows_that_repeat_do_not_take_places(spark):
    """Every row three times, and an id with two vectors: still k different neighbours, and the same ones."""
    rng = np.random.default_rng(19)
    x = np.round(rng.standard_normal((300, 16)), 3)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    plain = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    thrice = spark.createDataFrame(rows * 3, "vec_id long, embedding array<float>").repartition(4)
    found = [sorted(map(tuple, block_search.nearest(f, F.col("vec_id") % 20 == 0, 20, block=97).collect())) for f in (plain, thrice)]
    assert found[0] == found[1] and len(found[0]) == 15 * 20
    twice = spark.createDataFrame(rows + [(20, [9.0] * 16), (20, [0.0] * 16), (40, None), (21, [50.0] * 16)], "vec_id long, embedding array<float>")
    got = [sorted(map(tuple, block_search.nearest(f, F.col("vec_id") % 20 == 0, 20, block=64).collect())) for f in (twice.repartition(2), twice.repartition(5))]
    assert got[0] == got[1]
    smaller = np.array(min(list(np.float32(x[20]).astype(float)), [9.0] * 16))
    best = [r for r in got[0] if r[0] == 20][0]
    scores = {(i, j): float((smaller * np.float32(v).astype(float)).sum()) for j, (i, v) in enumerate(rows + [(21, [50.0] * 16)]) if i != 20}
    assert best[3] == pytest.approx(max(scores.values()))


def test_quantisation_bounds_hold():
    rng = np.random.default_rng(1)
    q, c = rng.standard_normal((40, 64)) * 10 ** rng.uniform(-3, 3, (40, 1)), rng.standard_normal((500, 64)) * 10 ** rng.uniform(-3, 3, (500, 1))
    row, cid, score = block_search.tile(np.arange(1000, 1040), q, np.arange(500), c, 10)
    for i in range(40):
        s = (q[i] * c).sum(axis=1)
        assert set(cid[row == i]) == set(np.argsort(-s)[:10])
