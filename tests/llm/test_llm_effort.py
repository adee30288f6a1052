"""Work that grows with the input and not faster: learned words, rounds of pairs; and the arithmetic under them."""

import re

import numpy as np
import pytest

from pennant.llm import grammar_ids, hashing, packing
from pennant.llm.queries import tokenizer_path

WORD = tokenizer_path("word_bpe_49k.json")


def encoded(encoder, texts):
    raw = [t.encode() for t in texts]
    ends = np.cumsum([len(x) for x in raw])
    ids, first = encoder.encode(np.frombuffer(b"".join(raw), np.uint8), np.append(0, ends[:-1]), ends)
    return [ids[a:b].tolist() for a, b in zip(first, first[1:])]


def counted(encoder, monkeypatch):
    """An encoder's learned words, run by run."""
    learned, learn = [], encoder._learn

    def run(raw, w0, w1, *more):
        learned.append({raw[a:b].tobytes().decode().lower() for a, b in zip(w0, w1)})
        return learn(raw, w0, w1, *more)
    monkeypatch.setattr(encoder, "_learn", run)
    return learned


def test_frequent_words_are_learned_once(monkeypatch):
    encoder = packing.WordEncoder(WORD)
    learned = counted(encoder, monkeypatch)
    common = [f"common{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    for n in range(30):
        encoded(encoder, [" ".join(common), " ".join(f"rare{n}x{i}" for i in range(20))])
    assert sum(len(x) for x in learned) == 200 + 30 * 20
    assert all(x.isdisjoint(common) for x in learned[1:])


def test_tasks_of_a_process_share_the_learned_words(monkeypatch):
    import pyarrow as pa
    from pyspark import cloudpickle

    monkeypatch.setattr(packing, "_ENCODERS", {})
    rows = {"_part": pa.array([0, 0], pa.int32()), "doc_id": pa.array([1, 2]), "text": pa.array(["shared words, some", None])}
    key = {"_row": pa.array([0, 1]), "_key": pa.array([0, 1]), "text": rows["text"]}
    made = []
    for make, batch in ((grammar_ids._blocks(WORD, 1, 256), rows), (grammar_ids._blocks(WORD, 1, 256), rows), (packing._tokenise(WORD, 1), key)):
        task = cloudpickle.loads(cloudpickle.dumps(make))                     # as it reaches a worker
        made.append(sum(x.num_rows for x in task([pa.record_batch(batch)])))
        assert packing._ENCODERS[WORD].words[False].turn == len(made)
    assert made == [1, 1, 2]


def test_learned_words_are_bounded_and_the_last_used_stay(monkeypatch):
    from tokenizers import Tokenizer

    t, encoder = Tokenizer.from_file(WORD), packing.WordEncoder(WORD)
    monkeypatch.setattr(packing, "KEPT_WORDS", 100)
    monkeypatch.setattr(packing, "KEPT_IDS", 1000)
    learned = counted(encoder, monkeypatch)
    common = ["The", "ÄÖ", "don't", "cat,", "日本", "x" * 300, "🙂", "<P>", "é!"]
    for n in range(12):
        texts = [" ".join(common), "", " ".join(f"w{n}q{i}" for i in range(n * 3)), "\x00 <|x", f"<|endoftext|> {n}"][: 5 if n % 5 == 4 else 3]
        assert encoded(encoder, texts) == [t.encode(x, add_special_tokens=False).ids for x in texts]
        for words in encoder.words.values():
            assert len(words.keys) <= 100 and len(words.flat) <= 1000
            assert (np.diff(words.keys.astype(object)) > 0).all() if len(words.keys) > 1 else True
    assert sum("the" in x for x in learned) == 2                              # once without special strings, once with


def test_rounds_look_only_at_pairs_that_may_be_frequent(monkeypatch):
    r = np.random.default_rng(5)
    phrases = [r.integers(0, 30000, r.integers(2, 9)) for _ in range(200)]
    ids = np.concatenate([x for i in range(4000) for x in (phrases[r.integers(0, 200)], r.integers(0, 30000, 6))]).astype(np.uint32)
    looked, frequent = [], grammar_ids._frequent

    def run(seq, look, *more):
        looked.append(len(look))
        return frequent(seq, look, *more)
    monkeypatch.setattr(grammar_ids, "_frequent", run)
    b = grammar_ids.Block(grammar_ids.compress(ids, np.array([len(ids)]), np.zeros(1, grammar_ids._ENTRY)))
    assert b.ids().tolist() == ids.tolist()
    assert len(looked) > 2 and sum(looked) < 2 * len(ids) and max(looked[2:]) < len(ids) // 4
    assert len(b.sequence) < 4000 * 8                                         # phrases became symbols


@pytest.mark.parametrize("bits", [1, 3, 17])
def test_pairs_that_meet_in_a_slot_are_counted_in_other_rounds(monkeypatch, bits):
    monkeypatch.setattr(grammar_ids, "SLOT_BITS", bits)
    r = np.random.default_rng(bits)
    ids = np.concatenate([np.tile([1, 2, 3], 300), r.integers(0, 9, 500), np.full(200, 7), np.array([70000] * 5)]).astype(np.uint32)
    sizes = np.array([1, 899, 500, 0, 205])
    b = grammar_ids.Block(grammar_ids.compress(ids, sizes, np.zeros(5, grammar_ids._ENTRY), 2, 0.0))
    assert b.ids().tolist() == ids.tolist() and b.entries["length"].tolist() == sizes.tolist()
    ends = np.cumsum(sizes)
    assert [b.slice(i, 0, n).tolist() for i, n in enumerate(sizes)] == [ids[e - n:e].tolist() for n, e in zip(sizes, ends)]
    one = b.sequence.astype(np.int64)
    pairs, n = np.unique(one[:-1] * 2 ** 32 + one[1:], return_counts=True)
    assert bits < 17 or n.max() < 100


@pytest.mark.parametrize("closing", [False, True])
def test_words_of_every_byte(closing):
    r = np.random.default_rng(3)
    raw = np.concatenate([np.arange(256), r.choice(np.frombuffer(b"aZz .,;:!?\n\t@[`{/09\x08\x0b\x0e\x1f\xff", np.uint8), 3000)]).astype(np.uint8)
    data = raw.tobytes()
    h, first, w0, w1 = hashing.word_hashes(raw, np.array([0]), np.array([len(raw)]), True, True, closing)
    want = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", data)]
    if closing:
        cut = [[a, *(i for i in range(a + 1, b) if re.fullmatch(rb"[A-Za-z0-9][.,;:!?]", data[i - 1:i + 1])), b] for a, b in want]
        want = [x for c in cut for x in zip(c, c[1:])]
    assert list(zip(w0.tolist(), w1.tolist())) == want
    known = {}
    for x, (a, b) in zip(h.tolist(), want):
        assert known.setdefault(data[a:b].lower(), x) == x
    assert len(set(known.values())) == len(known)
