"""Byte-level BPE against the tiktoken library, and back."""

import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from llm.cases import corpus, text
from wattline.llm import bytebpe

RANKS = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bytebpe.read_ranks(RANKS), special_tokens={})


def nasty(rng, n):
    units = ["'", "'l", "'ll", "'re", "s", "  ", " ", "\n", "\r\n", "\t", " ", " ", "a", "é", "中", "1", "٣", "½", "!", "--", "\U0001F600",
             "é", "՘", "࢏", "\U000323b0", "\U0003fc3f", "\U00011de0", "<|endoftext|>", "\x00", "\x85", "\x1c", "﻿", "zzzzzzzzzz", "          "]
    return "".join(rng.choice(units) * rng.choice([1, 1, 1, 2, 9]) for _ in range(n))


def texts():
    rng = random.Random(8)
    out = [t for _, t in corpus(n=12) if t is None or len(t) < 50000]
    out += [nasty(rng, rng.randint(1, 300)) for _ in range(60)]
    out += ["z" * 3000, " " * 3000, "z" * 700 + " tail" * 20, "'" * 500 + "ll", "\n" * 500 + "x", "<|endoftext|>" * 40, text(rng, 300) + "ß" * 2000 + text(rng, 300)]
    return out


def frame(spark, given):
    rows = [(None if i % 17 == 5 else i, t) for i, t in enumerate(given)]
    df = spark.createDataFrame(rows + rows[:3], "doc_id long, text string")
    return df.selectExpr("*", "'x' as ids", "1 as _row", "2 as _start", "3 as decoded", "4 as _c0")


@pytest.mark.parametrize("chunk,overlap", [(bytebpe.CHUNK, bytebpe.OVERLAP), (97, 40), (64, 8), (50, 1), (300, 300)])
def test_ids_and_bytes(spark, library, chunk, overlap):
    given = texts()
    enc = bytebpe.encode(frame(spark, given), RANKS, P.PATTERN, chunk=chunk, overlap=overlap)
    assert enc.columns == ["doc_id", "ids"]
    got = bytebpe.decode(enc, RANKS).collect()
    want = [(None if i % 17 == 5 else i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in enumerate(given)]
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(((r["doc_id"], r["ids"], bytes(r["decoded"])) for r in got), key=key) == sorted(want + want[:3], key=key)


def test_stitched_boundaries(library):
    """Chunks cut anywhere give the boundaries of the whole text."""
    repairs = bytebpe.class_repairs(P.PATTERN)
    cut = bytebpe.Pretokeniser(P.PATTERN, repairs)
    rng = random.Random(4)
    for _ in range(300):
        t = nasty(rng, rng.randint(2, 80)) + "q" * rng.choice([0, 0, 60])
        chunk = rng.randint(3, 60)
        overlap = rng.randint(1, chunk)
        bounds = []
        for s in range(0, len(t), chunk):
            part = t[s:s + chunk + overlap]
            ends = cut.ends(part)
            last = s + chunk >= len(t)
            bounds.append(np.concatenate([[s], s + (ends if last else ends[ends + bytebpe.AHEAD <= len(part)])]))
        alike = cut.same_classes(t)
        assert bytebpe.stitch(alike, bounds, cut.match).tolist() == [0, *cut.ends(t).tolist()]


def test_keep_and_forget(spark, library, monkeypatch):
    known = bytebpe.Pieces(bytebpe.read_ranks(RANKS), P.PATTERN)
    monkeypatch.setattr(bytebpe, "STORE", 3)
    for t in ("some words here", "and some other words", ""):
        pieces = bytebpe.Pretokeniser(P.PATTERN, {}).pieces(t)
        ids, count = known.encode(pieces, np.array([len(pieces), 0]))
        assert ids.tolist() == library.encode_ordinary(t) and count.tolist() == [len(ids), 0]
    df = spark.createDataFrame([(1, "a b", "src")], "doc_id long, text string, source string")
    assert bytebpe.encode(df, RANKS, P.PATTERN, keep=("source",)).first()["source"] == "src"


def test_empty_and_unknown(spark):
    df = frame(spark, ["a"]).where("false")
    assert bytebpe.decode(bytebpe.encode(df, RANKS, P.PATTERN), RANKS).count() == 0
    bad = spark.createDataFrame([(1, [5, 50256])], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="without a token"):
        bytebpe.decode(bad, RANKS).collect()
    none = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [bytes(r["decoded"]) for r in bytebpe.decode(none, RANKS).collect()] == [b"", b""]
