"""Packing: an exact round trip through the tokenizer, and the program's optimum."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm.cases import corpus
from tokenizers import Tokenizer

from wattline.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(texts):
    tok = Tokenizer.from_file(PATH)
    return [tok.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]


def test_white_space_at_the_ends_and_words_seen_before():
    texts = ["", " ", "\n\t\x0b\x0c\r", "  Lead and trail  ", "a\x0bB\x0cc\r\nd\te", "\x1cx\x1d y\x85z w v", "...", " ... ÄRGER! ", "a" * 5000]
    coder = packing.WordEncoder(PATH)
    for batch in (texts, texts[::-1] * 2):
        assert [ids.tolist() + [2] for ids, _ in coder.encode([t.encode() for t in batch])] == ids_of(batch)


def test_round_trip(frame):
    rows = [(i, t) for i, (_, t) in enumerate(corpus(seed=2))] + [(None, "no key")]
    rows += [(5000, "Don't STOP! 12.5 «fin» <|endoftext|> İstanbul ŒUVRE ﬁn 日本語。 ''s  x")]
    rows += [(5001, "hello <|endoftext|> world"), (5002, "a<|endoftext|>b.<|startoftext|><|endoftext|>"), (5003, "<|ENDOFTEXT|> <|EndOfText|>. x"),
             (5004, "<|endoftext|"), (5005, "<|endoftext|>"), (5006, "One. Two <|startoftext|> three. <|<|endoftext|>|> four.")]
    got = packing.pack(frame(rows).repartition(2), PATH).collect()
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    for (key, _), ids in zip(rows, ids_of([t for _, t in rows]), strict=True):
        parts = sorted(by_doc[key], key=lambda r: r["start"])
        assert [r["start"] for r in parts] == list(itertools.accumulate([0] + [r["length"] for r in parts]))[:-1]
        joined = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in parts]).tolist()
        assert joined == ids and all(r["doc_tokens"] == len(ids) for r in parts)
    padding = 0
    for parts in by_seq.values():
        parts.sort(key=lambda r: r["offset"])
        ends = list(itertools.accumulate([0] + [r["length"] for r in parts]))
        assert [r["offset"] for r in parts] == ends[:-1] and ends[-1] <= 4096
        padding += 0 if ends[-1] & (ends[-1] - 1) == 0 else 4096 - ends[-1]
    assert padding < 0.03 * sum(r["length"] for r in got)
    assert sorted(by_doc, key=str) == sorted({k for k, _ in rows}, key=str)


def test_special_tokens_keep_sentence_ends():
    ids, stops = packing.WordEncoder(PATH).encode([b"", b"One. Two <|endoftext|> three. Four <|startoftext|>five."])[1]
    want = Tokenizer.from_file(PATH).encode("One. Two <|endoftext|> three. Four <|startoftext|>five.", add_special_tokens=False)
    assert ids.tolist() == want.ids
    dot = Tokenizer.from_file(PATH).encode(".", add_special_tokens=False).ids[0]
    assert stops.tolist() == [i + 1 for i, x in enumerate(want.ids) if x == dot]


def test_crc_of_packed_ids(frame):
    r = packing.pack(frame([(1, "hello world")]), PATH).selectExpr("ids", "crc32(ids) as c").first()
    assert r["c"] == zlib.crc32(bytes(r["ids"]))


def test_long_texts_are_encoded_in_segments(monkeypatch):
    monkeypatch.setattr(packing, "SLICE", 500)
    t = (" ".join(w for _, x in corpus(seed=3, n=10) if x and len(x) < 9000 for w in x.split(" "))).encode()
    ids, stops = packing._encoded(packing.WordEncoder(PATH), [t])[0]
    assert ids.tolist() == ids_of([t.decode()])[0][:-1]
    assert (np.diff(stops) > 0).all()


@pytest.mark.parametrize("seed", range(20))
def test_plan_is_optimal(seed):
    rng = random.Random(seed)
    capacity = 512
    pos = [0]
    while len(pos) < 14:
        pos.append(pos[-1] + rng.choice([40, 100, 256, 300, rng.randint(1, 400)]))
    penalty = [0] + [rng.choice([0, 8, 64]) for _ in pos[1:]]

    def cost(ends):
        total, start = 0, 0
        for e in ends:
            n = pos[e] - start
            if n > capacity:
                return float("inf")
            total += (0 if n >= 256 and n & (n - 1) == 0 else capacity - n) + penalty[e] + packing.PER_SEQUENCE
            start = pos[e]
        return total

    inner = range(1, len(pos) - 1)
    best = min(cost([*c, len(pos) - 1]) for k in range(len(pos)) for c in itertools.combinations(inner, k))
    ends = packing.plan(pos, penalty, capacity)
    assert cost([pos.index(e) for e in ends]) == best


def test_tail_is_cut_into_powers_of_two():
    assert packing.tail(3, 4096) == [2, 1] and packing.tail(4096, 4096) == [4096] and packing.tail(4095, 4096) == [4095]


def test_every_sentence_end_is_offered(monkeypatch):
    """The ends that packing chooses cost what the plan over all sentence ends costs."""
    seen = []
    plan = packing.plan
    monkeypatch.setattr(packing, "plan", lambda pos, pen, capacity: seen.append((pos, pen)) or plan(pos, pen, capacity))
    held = packing._Held("k", 4096, 2, itertools.count())
    ids = np.arange(900, dtype=np.uint32)
    stops = np.array([3, 7, 20, 21, 400, 899, 900])
    for k in (1, 2):
        held.add(pa.scalar(k), ids, stops)
    list(held.flush(last=True))
    pos, pen = seen[0]
    assert {s + 901 * d for d in (0, 1) for s in stops.tolist()} <= {p for p, c in zip(pos, pen, strict=True) if c == packing.SENTENCE_CUT}
    assert [p for p, c in zip(pos, pen, strict=True) if c == 0] == [0, 901, 1802]


def test_empty_table(frame):
    assert packing.pack(frame([(1, "x")]).where("false"), PATH).count() == 0
