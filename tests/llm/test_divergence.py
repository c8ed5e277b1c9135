"""Source divergence against a plain count in Python."""

import random
import re
from collections import Counter, defaultdict

import pytest

from llm.cases import corpus
from wattline.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top):
    df, group = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate(LOWER))
        df[lang].update(set(terms))
        group[lang, source].update(terms)
    out = []
    for lang in {g for g, _ in group}:
        kept = [t for t, n in df[lang].items() if n >= least]
        sources = [s for g, s in group if g == lang]

        def share(counts):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p = {s: share(group[lang, s]) for s in sources}
        q = share(sum((group[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if group[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, i + 1) for i, (v, item) in enumerate(found[:most])]
    return sorted(out)


def frame(spark, rows):
    rows = [(i, *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.selectExpr("*", "'x' as term", "1 as n", "2 as df", "3 as shard", "'y' as part", "4 as rank")


def check(spark, rows, least=3, top=5, **kw):
    got = divergence.audit(frame(spark, rows), least=least, top=top, **kw)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute(rows, least, top)


def test_equals_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{i}".replace("0", "a").replace("1", "É").replace("2", "ß") for i in range(300)] + ["ABC", "abc", "ÄB", "äb", "İ"]
    rows = []
    for _ in range(300):
        text = "".join(rng.choice(words) + rng.choice([" ", "\n", "1", "-", "\x00", "\x7f", "`"]) for _ in range(rng.randint(0, 60)))
        lang = rng.choice(["en", "en", "en", "de", None, ""])
        rows.append((rng.choice([text, text, text, None, ""]) if lang != "de" else text, lang, rng.choice(["a", "a", "a", "b", "é", "", None, "B"])))
    rows += rows[:40] + [("solo words only here " * 3, "fr", "one")] * 4  # repeated rows; a language of one source
    rows += [("rare", "xx", s) for s in ("p", "q", "r")] + [(None, "yy", "p"), ("...", "yy", "q")]  # no kept terms
    check(spark, rows)
    check(spark, rows, shards=1)
    check(spark, rows, least=1, top=1000, shards=29)


def test_texts_of_the_shared_corpus(spark):
    check(spark, [(t, "en" if (i or 0) % 2 else "de", f"s{(i or 0) % 4}") for i, t in corpus()], least=4, top=50)


def test_ties_go_by_bytes(spark):
    rows = [("zeta beta Zeta é z", "en", "a")] * 3 + [("other words", "en", s) for s in ("b", "é", "z", "B")] * 3
    check(spark, rows, least=2, top=3)


def test_empty_table(spark):
    assert divergence.audit(frame(spark, [("a", "b", "c")]).where("false")).count() == 0


def test_tables_are_merged_in_between(spark, monkeypatch):
    import pyarrow as pa
    rows = [(f"w{chr(97 + i % 26)} same", "en", f"s{i % 3}") for i in range(500)]
    batch = pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows]) for k in (1, 2, 0)], names=["lang", "source", "text"])
    whole = pa.Table.from_batches(divergence._partial_counts([batch]))
    monkeypatch.setattr(divergence, "SLICE", 40)
    monkeypatch.setattr(divergence, "MERGE", 20)
    monkeypatch.setattr(divergence, "HELD", 30)
    parts = pa.Table.from_batches(divergence._partial_counts([batch]))
    assert parts.num_rows > whole.num_rows
    key = [("lang", "ascending"), ("source", "ascending"), ("term", "ascending")]
    assert divergence.merged([parts]).sort_by(key) == divergence.merged([whole]).sort_by(key)


@pytest.mark.parametrize("count,total,terms", [(0, 0, 1), (10**12, 10**15, 10**6), (7, 7, 1), (123456789012345, 9 * 10**14, 3)])
def test_shares_do_not_overflow(count, total, terms):
    import numpy as np
    assert int(divergence.shares(np.array([count]), total, terms)[0]) == 1 + 10**9 * (count + 5) // (total + 5 * terms)
