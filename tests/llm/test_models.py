"""Language-model scores, exact search and sampled segmentations."""

import collections
import math
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm.cases import LOW, corpus, data

from wattline.llm import covertree, lm, segment, trie
from wattline.llm import text as X

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def brute_scores(rows):
    token = [[*data(t).translate(LOW).split(), None] for _, t in rows]
    fold = [None if k is None else zlib.crc32(str(k).encode()) % 5 for k, _ in rows]
    count, pair, context = collections.Counter(), collections.Counter(), collections.Counter()
    for w, f in zip(token, fold, strict=True):
        if f is not None and f != 1:
            count.update(w)
            pair.update(zip(["<"] + w[:-1], w, strict=True))
            context.update(["<"] + w[:-1])
    total, distinct = sum(count.values()), len(count)
    out = []
    for (k, _), w, f in zip(rows, token, fold, strict=True):
        base = score = 0.0
        for v, x in zip(["<"] + w[:-1], w, strict=True):
            p = (count[x] + 0.5) / (total + 0.5 * (distinct + 1))
            base += math.log10(p)
            score += math.log10(pair[(v, x)] / (context[v] + lm.PRIOR) + lm.PRIOR / (context[v] + lm.PRIOR) * p)
        out.append((k, f == 1, len(w), sum(count[x] > 0 for x in w), total, base, score))
    return sorted(out, key=repr)


def test_scores_equal_brute_force(frame):
    rows = corpus(seed=11)
    got = sorted((tuple(r) for r in lm.score(frame(rows).repartition(3)).collect()), key=repr)
    want = brute_scores(rows)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)
    assert all(abs(g[6] - w[6]) <= 3e-4 * w[2] for g, w in zip(got, want, strict=True))  # 16-bit codes


def test_split_contexts_give_the_same_scores(frame, monkeypatch):
    rows = [r for r in corpus(seed=12) if len(r[1] or "") < 9000]
    monkeypatch.setattr(lm, "HOT", 1 << 20)  # nearly every context counts as hot and is split
    got = sorted((tuple(r) for r in lm.score(frame(rows)).collect()), key=repr)
    assert all(abs(g[6] - w[6]) <= 3e-4 * w[2] for g, w in zip(got, brute_scores(rows), strict=True))


def test_score_edge_cases(frame):
    assert lm.score(frame([(1, "x")]).where("false")).count() == 0
    got = lm.score(frame([(None, None), (None, "a b")])).collect()  # nothing to learn from
    assert {r["n_tokens"] for r in got} == {1, 3} and all(r["train_tokens"] == 0 and r["n_known"] == 0 for r in got)
    assert all(math.isfinite(r["score"]) for r in got)


@pytest.mark.parametrize("seed", range(8))
def test_elias_fano(seed):
    rng = np.random.default_rng(seed)
    n, top = int(rng.integers(1, 400)), 1 << int(rng.integers(1, 64))
    v = np.sort(rng.integers(0, top, n, dtype=np.uint64))
    s = trie.Sequence(*trie.Sequence.build(v))
    assert (s.values(np.arange(n)) == v).all()
    ask = np.concatenate([v, v + np.uint64(1), rng.integers(0, top, 200, dtype=np.uint64), np.array([0, top - 1], np.uint64)])
    place, hit = s.successor(ask)
    want = np.searchsorted(v, ask)
    known = np.isin(ask, v)
    assert (hit == known).all()
    assert (place[known] == want[known]).all()


def test_trie_answers_only_its_own_contexts():
    context = np.array([5, 9, 1 << 63], np.uint64)
    t = trie.Trie(context, np.array([2, 1, 3]), np.array([3, 7, 1, 2, 4, 1 << 31], np.uint32), np.array([0.5, 0.25, 1.0, 0.1, 0.01, 1e-9]))
    got = trie.probability(t.codes(np.array([5, 6, 9, 1 << 63], np.uint64), np.array([3, 1, 2, 3]),
                                   np.array([3, 7, 8, 3, 1, 2, 2, 4, 1 << 31], np.uint32)))
    assert np.allclose(got, [0.5, 0.25, 0, 0, 1.0, 0, 0.1, 0.01, 1e-9], rtol=1e-3)


def brute_top(rows, k=20, every=20):
    fine = [(i, np.floor(64 * np.array(v, float))) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in fine:
        if q % every == 0:
            best = sorted(((-int(a @ b), i) for i, b in fine if i != q and len(b) == len(a)))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("shard", [8192, 64])
def test_top_products_equal_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(covertree, "SHARD", shard)
    monkeypatch.setattr(covertree, "QUERIES", 9)
    monkeypatch.setattr(covertree, "LEAF", 8)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 6] + rng.normal(size=8) * 0.05]) for i in range(500)]
    rows += [(1000 + i, rows[3][1]) for i in range(60)]                             # one very common vector
    rows += [(2000, None), (2020, []), (None, rows[0][1]), (2040, [1.0] * 7 + [None]), (2060, [float("nan")] * 8), (2080, [1.0, 2.0]),
             (2100, [0.0] * 8), (2120, [3.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as id", "2 as score", "3 as part")
    got = sorted(tuple(r) for r in covertree.top_inner_products(df.repartition(3)).collect())
    assert got == brute_top(rows)


def test_search_above_a_floor_gives_what_reaches_it():
    rng = np.random.default_rng(9)
    points, asked = rng.integers(-40, 40, (700, 6)).astype(float), rng.integers(-40, 40, (30, 6)).astype(float)
    q, r = covertree.Tree(asked), covertree.Tree(points)
    ids, ends = r.order, np.arange(701)
    none = np.full(30, -1)
    whole_ids, whole = covertree.search(q, none, r, ids, ends, 5)
    floor = whole[:, 2] + (np.arange(30) % 3 - 1)  # around the third score, ties included
    names, best = covertree.search(q, none, r, ids, ends, 5, floor)
    for i in range(30):
        keep = whole[i] >= floor[i]
        assert best[i][best[i] >= floor[i]].tolist() == whole[i][keep].tolist()
        assert names[i][best[i] >= floor[i]].tolist() == whole_ids[i][keep].tolist()
    high = covertree.search(q, none, r, ids, ends, 5, np.full(30, 1e9))[1]
    assert not np.isfinite(high).any()


def test_top_products_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert covertree.top_inner_products(df).count() == 0
    one = spark.createDataFrame([(20, [1.0])], "vec_id long, embedding array<float>")
    assert covertree.top_inner_products(one).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_cover_tree_covers(seed):
    rng = np.random.default_rng(seed)
    points = np.floor(64 * rng.normal(size=(700, 5)))
    t = covertree.Tree(points)
    assert sorted(t.order.tolist()) == list(range(700)) and (points[t.order] == t.points).all()
    for i, kids in enumerate(t.children):
        part = t.points[t.start[i]:t.end[i]]
        assert np.sqrt(((part - t.centre[i]) ** 2).sum(axis=1)).max() <= t.radius[i] + 1e-6
        if kids:
            assert sum(t.end[c] - t.start[c] for c in kids) == t.end[i] - t.start[i]


def draw(texts, seeds, k):
    vocab = segment.vocabulary(MODEL)
    buf, off = X.utf8(pa.array(texts, pa.string()))
    lattice, word, count = segment.lattice_of(vocab, buf, off)
    t = segment.Texts(lattice, word, count, np.array(seeds, np.int64).view(np.uint64))
    return [(d, r, tuple(segment.piece_ids(lattice, vocab, e, np.array([len(e)]))[0].tolist()), lp, g, inc) for d, r, e, lp, g, inc in segment.sample_texts(t, k)]


def all_segmentations(text):
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    vocab = segment.vocabulary(MODEL)
    index = {m.id_to_piece(i): i for i in range(m.get_piece_size()) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i))}

    def split(s):
        return [(index[s[:k]], *r) for k in range(1, len(s) + 1) if s[:k] in index for r in split(s[k:])] if s else [()]

    every = split(("▁" + text).replace(" ", "▁"))
    weight = np.array([sum(vocab.log_weight[i] for i in x) for x in every])
    p = np.exp(weight - weight.max())
    return every, p / p.sum()


def test_sampling_without_replacement():
    every, p = all_segmentations("ab the")
    n = 6000
    got = draw(["ab the"] * n, range(1, n + 1), 3)
    log = dict(zip(every, np.log(p), strict=True))
    assert all(abs(log[ids] - lp) < 1e-9 for _, _, ids, lp, _, _ in got)
    by = collections.defaultdict(list)
    for x in got:
        by[x[0]].append(x)
    assert all(len({y[2] for y in b}) == 3 and b[0][4] >= b[1][4] >= b[2][4] for b in by.values())
    second = np.array([sum(p[j] * p[i] / (1 - p[j]) for j in range(len(p)) if j != i) for i in range(len(p))])
    for rank, want in ((1, p), (2, second)):
        have = collections.Counter(x[2] for x in got if x[1] == rank)
        for i in np.argsort(-want)[:3].tolist():
            assert abs(have[every[i]] / n - want[i]) < 4 * math.sqrt(want[i] / n) + 1e-3
    # inclusion probabilities make the weighted sample unbiased
    estimate = np.mean([sum(math.exp(x[3] - x[5]) for x in b) for b in by.values()])
    assert abs(estimate - 1) < 0.02


def test_few_segmentations_are_all_drawn():
    every, _ = all_segmentations("the")
    got = draw(["the"], [7], len(every) + 5)
    assert sorted(x[2] for x in got) == sorted(every) and all(x[5] == 0.0 for x in got)


def test_samples_of_a_table_spell_their_texts(frame):
    rows = [(k, t) for k, t in corpus(seed=13) if len(t or "") < 60000] + [(9, "▶ tab\tline\r\nend  two  "), (9, "▶ tab\tline\r\nend  two  ")]
    df = frame(rows)
    got = segment.sample_segmentations(df.repartition(2), MODEL, samples=2).collect()
    again = segment.sample_segmentations(df.repartition(5), MODEL, samples=2).collect()
    pick = lambda rs: sorted((repr(r["doc_id"]), r["sample"], bytes(r["ids"]), r["spelt"]) for r in rs)
    assert pick(got) == pick(again)  # neither partitions nor order matter
    texts = collections.Counter((repr(k), t or "") for k, t in rows)
    assert collections.Counter((repr(r["doc_id"]), r["spelt"]) for r in got if r["sample"] == 1) == texts
    long = [r for r in got if r["n_pieces"] > 50]
    assert len({(repr(r["doc_id"]), r["spelt"], r["sample"], bytes(r["ids"])) for r in long}) >= 2 * len({(repr(r["doc_id"]), r["spelt"]) for r in long})


def test_decode_and_empty(frame, spark):
    rows = segment.sample_segmentations(frame([(1, "hello wörld\n日本")]), MODEL, samples=1)
    assert segment.decode(rows.drop("spelt"), MODEL, name="text").first()["text"] == "hello wörld\n日本"
    assert segment.sample_segmentations(frame([(1, "x")]).where("false"), MODEL).count() == 0
    assert segment.sample_segmentations(frame([(1, None)]), MODEL).first()["n_pieces"] == 0
    nulls = spark.createDataFrame([(None,)], "ids binary")
    assert segment.decode(nulls, MODEL).first()["text"] is None
