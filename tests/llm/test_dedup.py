"""Substring, suffix-array and near-duplicate removal against brute force."""

import collections

import pytest
from llm.cases import LAST, LOW, corpus, data
from pyspark.sql import functions as F

from wattline.llm import neardup, substrings, suffix


def order(key):
    return LAST if key is None else key


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def brute_words(rows, window=50):
    first = {}
    for k, t in rows:
        w = data(t).split()
        for i in range(len(w) - window + 1):
            g = tuple(w[i:i + window])
            first[g] = min(first.get(g, LAST + 1), order(k))
    out = []
    for k, t in rows:
        w = data(t).split()
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < order(k):
                gone[i:i + window] = [True] * window
        out.append((k, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()))
    return sorted(out, key=repr)


def test_substrings_equal_brute_force(frame):
    rows = corpus()
    got = substrings.remove_repeats(frame(rows).repartition(3)).select("doc_id", "n_words", "n_removed", "kept_text")
    want = brute_words(rows)
    assert rows_of(got) == want
    assert sum(r[2] for r in want) > 1000


def test_substring_spans_cover_what_is_removed(frame):
    rows = corpus(seed=8, n=20)
    for r in substrings.remove_repeats(frame(rows)).collect():
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]
        assert all(0 <= s["start"] < s["end"] <= r["n_words"] for s in r["spans"])


def brute_bytes(rows, n=50):
    first = {}
    for k, t in rows:
        b = data(t)
        for i in range(len(b) - n + 1):
            g = b[i:i + n]
            first[g] = min(first.get(g, LAST + 1), order(k))
    out = []
    for k, t in rows:
        b = data(t)
        gone = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if first[b[i:i + n]] < order(k):
                gone[i:i + n] = b"\x01" * n
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(b)))
        out.append((k, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return sorted(out, key=repr)


def test_suffix_arrays_equal_brute_force(frame):
    rows = corpus(seed=6)
    got = suffix.remove_repeats(frame(rows).repartition(4)).collect()
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in got), key=repr)
    assert got == brute_bytes(rows)


def test_suffix_arrays_with_hot_anchors_equal_brute_force(frame):
    rows = corpus(seed=6)
    for hot in (0, 200, 2000):  # all anchors hot, many, a few
        got = suffix.remove_repeats(frame(rows).repartition(4), hot_bytes=hot).collect()
        got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in got), key=repr)
        assert got == brute_bytes(rows)


def test_suffix_phrase_in_many_contexts_is_no_hot_group(frame, monkeypatch):
    import random
    rng = random.Random(1)
    some = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    rows = [(i, some(60) + " the phrase that all of them hold " + some(60)) for i in range(3000)]
    rows += [(3000 + i, some(30) + rows[i][1][20:110] + some(30)) for i in range(20)]
    questions, ask = [], suffix.E.ask
    monkeypatch.setattr(suffix.E, "ask", lambda batches, question, answer: (questions.append((batches, question)), ask(batches, question, answer))[1])
    got = suffix.remove_repeats(frame(rows).repartition(4), hot_bytes=20_000).collect()
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in got), key=repr)
    assert got == brute_bytes(rows)
    texts = collections.Counter()  # bytes of run texts that each bucket gets
    batches, runs = questions[-1]
    for batch in suffix.E.batches_of(batches.toArrow().to_batches()):
        for bucket, payload in runs(batch):
            texts[bucket] += int(suffix.E.unplanes(suffix.E.split_parts(payload)[1], "int64").sum())
    assert sum(len(t) for _, t in rows[3000:]) < sum(texts.values()) and max(texts.values()) <= 20_000


def test_suffix_messages_of_a_large_corpus(frame, monkeypatch):
    rows = corpus(seed=6)
    make, replies, asked = suffix.E.make_batches, suffix.E.replies, []

    def as_large(*args, **kwargs):  # batches that say they are 10 GB
        batches = make(*args, **kwargs)
        share = (10 << 30) // batches.count()
        return batches.withColumn("n_bytes", F.lit(share))

    monkeypatch.setattr(suffix.E, "make_batches", as_large)
    monkeypatch.setattr(suffix.E, "replies", lambda batches, question, *rest: (asked.append((batches, question)), replies(batches, question, *rest))[1])
    got = suffix.remove_repeats(frame(rows).repartition(4)).collect()
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in got), key=repr)
    assert got == brute_bytes(rows)
    for batches, question in asked:
        for batch in suffix.E.batches_of(batches.toArrow().to_batches()):
            assert 0 < len(list(question(batch))) <= 256


def test_suffix_arrays_take_only_texts_that_share_their_anchor(frame, monkeypatch):
    import random
    rng = random.Random(2)
    some = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    passage = some(4000)
    rows = [(i, some(100) + passage + some(100)) for i in range(8)]
    asked, ask = [], suffix.E.ask
    monkeypatch.setattr(suffix.E, "ask", lambda *args: (asked.append(args), ask(*args))[1])
    got = suffix.remove_repeats(frame(rows).repartition(4)).collect()
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in got), key=repr)
    assert got == brute_bytes(rows)
    batches, runs, judge = asked[-1]
    sent, laid, least = collections.defaultdict(list), [], suffix.least_owner
    monkeypatch.setattr(suffix, "least_owner", lambda buf, *rest: (laid.append(len(buf)), least(buf, *rest))[1])
    for batch in suffix.E.batches_of(batches.toArrow().to_batches()):
        for bucket, payload in runs(batch):
            sent[bucket].append(payload)
    assert any([a for bucket, payloads in sent.items() for a in judge(bucket, payloads)])
    assert sum(laid) < 4000 < sum(int(suffix.E.unplanes(suffix.E.split_parts(p)[1], "int64").sum()) for x in sent.values() for p in x)


def test_suffix_spans_join_inside_rows_only():
    import numpy as np
    at, end, row = np.array([50, 10, 0, 60, 60, 70]), np.array([60, 40, 20, 65, 70, 75]), np.array([0, 0, 0, 1, 1, 1])
    got = suffix.joined(at, end, row)
    assert [x.tolist() for x in got] == [[0, 50, 60], [40, 60, 75], [0, 0, 1]]


@pytest.mark.parametrize("bits", [8, 30])  # place and name in one number, or not
def test_suffix_names_are_sorted_and_stable(bits):
    import numpy as np
    value = np.random.default_rng(1).integers(0, 1 << 63, 50).astype(np.uint64)[np.random.default_rng(2).integers(0, 50, 400)]
    order, name = suffix.by_name(value, bits)
    want = value >> np.uint64(32 - bits)
    assert order.tolist() == sorted(range(400), key=lambda i: (want[i], i)) and name.tolist() == want[order].tolist()


def test_suffix_shards_merge_by_binary_search(frame, monkeypatch):
    monkeypatch.setattr(suffix, "SHARD", 700)  # many shards in a bucket's part
    import numpy as np
    rng = np.random.default_rng(1)
    pieces = [bytes(rng.integers(97, 99, 120).astype(np.uint8)) for _ in range(30)]
    pieces += [p[:90] + b"xyz" + p[93:] for p in pieces[:10]] + [b"ab" * 60] * 3
    buf = np.frombuffer(b"".join(pieces), np.uint8)
    window = np.zeros(len(buf), bool)
    owner = np.repeat(np.arange(len(pieces))[::-1].copy(), 120)
    for i in range(len(pieces)):
        window[i * 120:i * 120 + 71] = True
    low = suffix.least_owner(buf, window, owner, list(range(600, len(buf) + 1, 600)) + ([len(buf)] if len(buf) % 600 else []))
    raw = buf.tobytes()
    least = {}
    for i in np.flatnonzero(window).tolist():
        g = raw[i:i + 50]
        least[g] = min(least.get(g, 1 << 60), int(owner[i]))
    assert all(low[i] == least[raw[i:i + 50]] for i in np.flatnonzero(window).tolist())


@pytest.mark.parametrize("seed", range(6))
def test_suffix_array_and_kasai(seed):
    import numpy as np
    rng = np.random.default_rng(seed)
    for n in (1, 2, 9, 60, 400):
        b = rng.integers(97, 97 + rng.integers(1, 4), n).astype(np.uint8)
        b = np.tile(b, 3) if seed % 2 else b
        raw, w = b.tobytes(), suffix.words8(b)
        got = suffix.suffix_array(w)
        want = sorted(range(len(b)), key=lambda i: raw[i:])
        assert got.tolist() == want
        lcp = suffix.common_prefixes(w, got, 50, lanes=int(rng.integers(1, 9))).tolist()

        def common(x, y):
            k = 0
            while k < 50 and max(x, y) + k < len(raw) and raw[x + k] == raw[y + k]:
                k += 1
            return k

        assert lcp == [0] + [common(want[i - 1], want[i]) for i in range(1, len(want))]


def brute_components(rows, size, percent=80):
    sets = []
    for _, t in rows:
        w = data(t).translate(LOW).split()
        sets.append(frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    groups = collections.defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    out = []
    for members in groups.values():
        keys = [rows[i][0] for i in members if rows[i][0] is not None]
        for i in members:
            least = min(keys) if keys else None
            out.append((rows[i][0], len(sets[i]), least, least is None or rows[i][0] == least))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates_equal_brute_force(frame, size):
    rows = [r for r in corpus(seed=7) if len(r[1] or "") < 50000]
    got = neardup.near_duplicates(frame(rows).repartition(3), shingle=size)
    want = brute_components(rows, size)
    assert rows_of(got.select("doc_id", "n_shingles", "component_id", "kept")) == want
    assert sum(not r[3] for r in want) > 10


def test_signature_keys_meet_pairs_under_the_threshold():
    import numpy as np
    rng = np.random.default_rng(3)
    for _ in range(200):
        a = rng.integers(0, 1 << 16, neardup.PLACES).astype(np.uint16)
        b = a.copy()
        wrong = rng.choice(neardup.KEYS, 2 * neardup.CHUNKS - 1, replace=False)
        b[wrong] ^= 1 + rng.integers(0, 100, len(wrong)).astype(np.uint16)
        ka, kb = neardup.index_keys(np.stack([a, b]))
        shared = np.flatnonzero(ka == kb)
        assert len(shared) and neardup.first_shared(a, b[None])[0] == shared[0]


@pytest.mark.parametrize("operator", [substrings.remove_repeats, suffix.remove_repeats, neardup.near_duplicates])
def test_empty_tables(frame, operator):
    assert operator(frame([(1, "x")]).where("false")).count() == 0


@pytest.mark.parametrize("operator", [substrings.remove_repeats, suffix.remove_repeats, neardup.near_duplicates])
def test_only_nulls(frame, operator):
    got = operator(frame([(None, None), (3, None), (None, "")])).collect()
    assert len(got) == 3
