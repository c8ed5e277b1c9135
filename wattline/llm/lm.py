"""Language-model scoring with a sharded Elias-Fano bigram trie.

Counts are taken over the whole training corpus.  Words meet in buckets by
their hash, which gives every batch the exact counts of its words.  Word pairs
meet in buckets by their context; contexts that hold more than a small fixed
share of all tokens are split by the following word.  Each bucket builds its
part of the trie, maps it from a file, answers the pairs that the batches hold,
and forgets it: no model passes through the driver.

P(w | v) = c(vw) / (c(v) + PRIOR) + PRIOR / (c(v) + PRIOR) * P(w), where P(w)
is the add-half unigram estimate; the first term is what the trie stores.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.llm import exchange as E
from wattline.llm import text as X
from wattline.llm import tidied
from wattline.llm import trie as R

PRIOR = 100.0
HOT = 4096  # a context of more than 1/HOT of all tokens is split; there are at most HOT of them
START, STOP = X.U(0x5851F42D4C957F2D), X.U(0x14057B7EF767814F)  # before the first word, and the end token
OUTPUT = "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def fold(key, folds: int) -> int | None:
    return None if key is None else zlib.crc32(str(key).encode()) % folds


class Tokens:
    """Token hashes of a batch: each row's lower-cased words, then the end."""

    def __init__(self, batch: E.Batch, folds: int, held: int):
        _, _, row, h, _ = X.words(batch.buf, batch.off, lower=True)
        n = len(batch.keys)
        self.count = np.bincount(row, minlength=n) + 1
        end = np.cumsum(self.count)
        self.token = np.full(int(end[-1]) if n else 0, STOP)
        self.token[np.arange(len(h)) + row] = h
        self.before = np.concatenate([[START], self.token[:-1]]) if n else self.token
        self.before[end[:-1]] = START
        self.row = np.repeat(np.arange(n), self.count)
        folds_of = [fold(k, folds) for k in batch.keys]
        self.held_out = np.array([f == held for f in folds_of], bool)
        self.train = np.array([f is not None and f != held for f in folds_of], bool)

    def words(self):
        """(distinct tokens, place of each token among them, their training counts)."""
        word, which = np.unique(self.token, return_inverse=True)
        return word, which, np.bincount(which, weights=self.train[self.row], minlength=len(word)).astype(np.uint32)

    def pairs(self, bits: int, hot: dict[int, tuple[int, int]]):
        """Distinct pairs in order: (bucket, spot, word id, training count), and the place of each
        token's pair.  A spot is a context, or the part of a split context that the word falls in."""
        spot, word = self.before, word_id(self.token)
        if hot:
            names = np.array(sorted(hot), X.U)
            at = np.minimum(np.searchsorted(names, spot), len(names) - 1)
            split = np.array([hot[int(v)][1] for v in names], X.U)
            some = np.flatnonzero(names[at] == spot)
            spot = spot.copy()
            spot[some] = part_of(spot[some], word[some], split[at[some]])
        spot = X.mix(spot)
        order, first = by_pair(spot, word)
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(first) - 1
        first = order[first]
        count = np.bincount(which, weights=self.train[self.row], minlength=len(first)).astype(np.uint32)
        spot = spot[first]
        return (spot >> X.U(64 - bits)).astype(np.int64), spot, word[first], count, which


def part_of(context: np.ndarray, word: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """The name of the part of a split context that holds a word."""
    return X.mix(context + X.U(1) + X.mix(word.astype(X.U)) % parts)


def by_pair(spot: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order by the leading half of the spot, then word; where in that order a new pair begins)."""
    key = (spot & X.U(0xFFFFFFFF00000000)) | word.astype(X.U)
    order = np.argsort(key)
    k, s = key[order], spot[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    if not new[1:][s[1:] != s[:-1]].all():  # two spots with one leading half: order them fully
        order = np.lexsort((spot, key))
        k, s = key[order], spot[order]
        new[1:] = (k[1:] != k[:-1]) | (s[1:] != s[:-1])
    return order, new


def word_id(h: np.ndarray) -> np.ndarray:
    return (h >> X.U(32)).astype(np.uint32)


def heads(values: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)


def score(docs: DataFrame, key: str = "doc_id", column: str = "text", folds: int = 5, held: int = 1) -> DataFrame:
    """``key``, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Learns from the rows whose crc32 of the key's text modulo ``folds`` is not
    ``held``; a row of null key is scored, but neither held out nor learnt
    from.  Null or empty text is the end token alone.  Scores are log10
    probabilities of the whole text.  Repeated rows count as often as they
    occur.  Further columns are ignored; an empty table gives an empty result."""
    def note(keys, buf, off):
        train = np.array([f is not None and f != held for f in (fold(k, folds) for k in keys)], bool)
        return [int((X.count_words(buf, off) + 1)[train].sum()), int(train.sum())]

    batches = E.make_batches(docs, key, column, note=note)
    bits = E.bucket_bits(batches)
    sums = batches.agg(F.sum(F.col("note")[0]).alias("n"), F.sum(F.col("note")[1]).alias("rows")).first()
    total, starts = sums["n"] or 0, sums["rows"] or 0

    def ask_words(batch):
        word, _, count = Tokens(batch, folds, held).words()
        for bucket, cut in E.by_bucket(word, bits):
            yield bucket, E.join_parts([E.pack(word[cut]), E.planes(count[cut])])

    def tell_words(bucket, payloads):
        held_ = [(E.unpack(w, X.U), E.unplanes(c, np.uint32)) for w, c in map(E.split_parts, payloads)]
        word, which = np.unique(np.concatenate([w for w, _ in held_]), return_inverse=True)
        count = np.bincount(which, weights=np.concatenate([c for _, c in held_]), minlength=len(word)).astype(np.int64)
        many = np.flatnonzero(count * HOT > total)
        note = E.join_parts([np.array([int((count > 0).sum())]).tobytes(), word[many].tobytes(), count[many].tobytes()])
        return [*(E.planes(count[np.searchsorted(word, w)]) for w, _ in held_), note]

    counts = E.stage(E.replies(batches, ask_words, tell_words))
    distinct, hot = 0, {}
    for r in counts.where("batch_id = -1").select("answer").toLocalIterator():  # a small note from each bucket
        n, word, count = E.split_parts(r["answer"])
        distinct += int(np.frombuffer(n, np.int64)[0])
        hot.update(zip(np.frombuffer(word, X.U).tolist(), np.frombuffer(count, np.int64).tolist(), strict=True))
    hot.pop(int(STOP), None)
    hot[int(START)] = starts
    share = max(1, total >> bits)
    hot = {w: (c, max(1, -(-c // share))) for w, c in hot.items()}
    whole_of = {}  # spot of each part of a split context: the context's count
    for w, (c, parts) in hot.items():
        names = X.mix(X.U(w) + X.U(1) + np.arange(parts, dtype=X.U))
        whole_of.update(dict.fromkeys(X.mix(names).tolist(), c))

    def ask_pairs(batch):
        bucket, spot, word, count, _ = Tokens(batch, folds, held).pairs(bits, hot)
        cuts = np.append(heads(bucket), len(bucket))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            first = heads(spot[a:b])
            size = np.diff(np.append(first, b - a)).astype(np.uint32)
            yield int(bucket[a]), E.join_parts([E.pack(spot[a:b][first]), E.planes(size), E.planes(word[a:b]), E.planes(count[a:b])])

    def tell_pairs(bucket, payloads):
        asked = []
        for p in payloads:
            spot, size, word, count = E.split_parts(p)
            asked.append((E.unpack(spot, X.U), E.unplanes(size, np.uint32).astype(np.int64), E.unplanes(word, np.uint32), E.unplanes(count, np.uint32)))
        spot = np.concatenate([np.repeat(c, s)[n > 0] for c, s, _, n in asked])
        word = np.concatenate([w[n > 0] for _, _, w, n in asked])
        count = np.concatenate([n[n > 0] for _, _, _, n in asked]).astype(np.int64)
        order, new = by_pair(spot, word)
        first = np.flatnonzero(new)
        count = np.add.reduceat(count[order], first) if len(first) else count
        spot, word = spot[order][first], word[order][first]
        if (spot[1:] < spot[:-1]).any():  # spots with one leading half, mixed by their words
            order = np.lexsort((word, spot))
            spot, word, count = spot[order], word[order], count[order]
        at = heads(spot)
        size = np.diff(np.append(at, len(spot)))
        names = spot[at]
        whole = np.add.reduceat(count, at) if len(at) else count
        whole = np.array([whole_of.get(v, n) for v, n in zip(names.tolist(), whole.tolist(), strict=True)], np.float64)
        model = R.Trie(names, size, word, count / (np.repeat(whole, size) + PRIOR))
        return [E.planes(model.codes(c, s, w)) for c, s, w, _ in asked]

    pairs = E.replies(batches, ask_pairs, tell_pairs)
    both = (counts.where("batch_id >= 0").select("batch_id", F.col("bucket"), "answer")
            .unionByName(pairs.select("batch_id", (-1 - F.col("bucket")).alias("bucket"), "answer")))
    found = E.told(batches, E.gathered(both))

    def final(record_batches):
        for batch in E.batches_of(record_batches):
            t = Tokens(batch, folds, held)
            word, which, _ = t.words()
            count = np.concatenate([E.unplanes(batch.answers[b], np.int64) for b, _ in E.by_bucket(word, bits)] or [np.zeros(0, np.int64)])
            bucket, _, _, _, place = t.pairs(bits, hot)
            code = np.concatenate([E.unplanes(batch.answers[-1 - int(bucket[a])], np.uint16) for a in heads(bucket).tolist()] or [np.zeros(0, np.uint16)])
            seen = count[which]
            base = (seen + 0.5) / (total + 0.5 * (distinct + 1))
            n = len(batch.keys)
            before = np.concatenate([[0], seen[:-1]]) if n else seen
            first = np.cumsum(t.count) - t.count
            before[first] = starts  # rows learnt from, which the start precedes
            weight = before + PRIOR
            p = R.probability(code[place]) + PRIOR / weight * base
            yield pa.RecordBatch.from_arrays(
                [pa.array(batch.keys, pa.int64()), pa.array(t.held_out), pa.array(t.count.astype(np.int64)), pa.array(X.per_row(seen > 0, t.row, n)),
                 pa.array(np.full(n, total, np.int64)),
                 pa.array(np.bincount(t.row, weights=np.log10(base), minlength=n)), pa.array(np.bincount(t.row, weights=np.log10(p), minlength=n))],
                names=[key, *(f.name for f in fields)])

    fields = T.StructType.fromDDL(OUTPUT).fields
    return found.mapInArrow(tidied(final), T.StructType([T.StructField(key, T.LongType(), True), *fields]))
