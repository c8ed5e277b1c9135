"""Substring dedup with fixed-block anchors.

Every document's non-overlapping blocks of 25 words are the index; every
rolling window of 25 words probes it.  A passage of 50 words holds a whole
block of each document it occurs in, so the hits cover all repeated passages.
Hits are extended to the windows of 50 words around them, those are compared
by 64-bit hashes over the whole corpus, and adjoining ones form the maximal
repeats that are removed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wattline.llm import exchange as E
from wattline.llm import text as X
from wattline.llm import tidied

OUTPUT = "n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept_text string"


def index_and_probes(h, row, pos, gram, first, block):
    """Sorted distinct gram hashes of a batch: (shared by two of its documents, anchors, probes)."""
    is_block = (pos - first[row[pos]]) % block == 0
    order = np.argsort(gram)
    g, b, r = gram[order], is_block[order], row[pos][order]
    new = np.ones(len(g), bool)
    new[1:] = g[1:] != g[:-1]
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(g)))
    single = start[size == 1]
    anchor, probe = [g[single[b[single]]]], [g[single[~b[single]]]]
    known = []
    many = np.repeat(size > 1, size)
    if many.any():
        gm, bm, rm = g[many], b[many], r[many]
        lead = np.lexsort((~bm, rm, gm))  # blocks of a document before its probes
        gm, bm, rm = gm[lead], bm[lead], rm[lead]
        own = np.ones(len(gm), bool)
        own[1:] = (gm[1:] != gm[:-1]) | (rm[1:] != rm[:-1])
        gm, bm = gm[own], bm[own]  # one entry a document: a block if it has one
        head = np.ones(len(gm), bool)
        head[1:] = gm[1:] != gm[:-1]
        at = np.flatnonzero(head)
        docs = np.diff(np.append(at, len(gm)))
        blocks = np.add.reduceat(bm.astype(np.int64), at)
        value = gm[at]
        known.append(value[(blocks >= 1) & (docs > 1)])
        anchor.append(value[(blocks == 1) & (docs == 1)])
        probe.append(value[blocks == 0])
    return tuple(np.sort(np.concatenate(x)) if x else np.zeros(0, X.U) for x in (known, anchor, probe))


def remove_repeats(docs: DataFrame, key: str = "doc_id", column: str = "text", window: int = 50) -> DataFrame:
    """``key``, n_words, n_removed, spans of removed words, kept_text (kept words, one space between).

    A word goes if a window of ``window`` words that covers it also starts in
    a row with a smaller key.  Rows of equal key do not remove each other; a
    null key comes after all others.  Null, empty or short texts lose nothing.
    A word may be of any length.  Further columns are ignored; an empty table
    gives an empty result."""
    block = window // 2
    batches = E.make_batches(docs, key, column)
    bits = E.bucket_bits(batches)
    shared = E.Shared(bits)

    def hashed(batch):
        s, e, row, h, _ = X.words(batch.buf, batch.off)
        first = np.searchsorted(s, batch.off)
        long_enough = np.diff(first) >= window
        return s, e, row, h, first, long_enough

    def question(batch):
        _, _, row, h, first, long_enough = hashed(batch)
        pos, gram = X.grams(h, row, block)
        use = long_enough[row[pos]]
        yield from shared.question(*index_and_probes(h, row, pos[use], gram[use], first, block))

    anchored = E.told(batches, E.ask(batches, question, shared.answer))

    def windows(batch):
        """(position, hash) of the windows that hold an anchored block."""
        _, _, row, h, first, long_enough = hashed(batch)
        pos, gram = X.grams(h, row, block)
        use = long_enough[row[pos]]
        hit = np.zeros(len(h) + 1, np.int64)
        hit[pos[use][shared.flags(gram[use], batch.answers)] + 1] = 1
        hits = np.cumsum(hit)
        wpos, whash = X.grams(h, row, window)
        take = hits[wpos + window - block + 1] > hits[wpos]
        return row, wpos[take], whash[take]

    def extend(batch):
        row, pos, value = windows(batch)
        if not len(pos):
            return
        doc = batch.order[row[pos]]
        order = np.lexsort((doc, value))
        value, doc = value[order], doc[order]
        new = np.ones(len(value), bool)
        new[1:] = value[1:] != value[:-1]
        start = np.flatnonzero(new)
        least, most = doc[start], doc[np.append(start[1:], len(doc)) - 1]
        value = value[start]
        for bucket, cut in E.by_bucket(value, bits):
            yield bucket, E.join_parts([E.pack(value[cut]), E.planes(least[cut]), E.planes((most - least)[cut])])

    def compare(bucket, payloads):
        held = []
        for p in payloads:
            v, least, gap = E.split_parts(p)
            least = E.unplanes(least, np.int64)
            held.append((E.unpack(v, X.U), least, least + E.unplanes(gap, np.int64)))
        value = np.concatenate([v for v, _, _ in held])
        least = np.concatenate([x for _, x, _ in held])
        order = np.argsort(value)
        v = value[order]
        start = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
        firsts, lowest = v[start], np.minimum.reduceat(least[order], start)
        out = []
        for v, _, most in held:
            low = lowest[np.searchsorted(firsts, v)]
            goes = most > low
            out.append(E.join_parts([E.pack(v[goes]), E.planes(low[goes])]) if goes.any() else None)
        return out

    found = E.told(batches, E.ask(anchored, extend, compare))
    kind = T.StructField(key, T.LongType(), True)

    def cut(record_batches):
        for batch in E.batches_of(record_batches):
            s, e, row, h, first, _ = hashed(batch)
            gone = np.zeros(len(s), bool)
            if batch.answers:
                values, lows = [], []
                for _, a in sorted(batch.answers.items()):
                    v, low = E.split_parts(a)
                    values.append(E.unpack(v, X.U))
                    lows.append(E.unplanes(low, np.int64))
                value, low = np.concatenate(values), np.concatenate(lows)
                pos, g = X.grams(h, row, window)
                at = np.minimum(np.searchsorted(value, g), len(value) - 1)
                goes = (value[at] == g) & (batch.order[row[pos]] > low[at])
                step = np.bincount(pos[goes], minlength=len(s) + 1) - np.bincount(pos[goes] + window, minlength=len(s) + 1)
                gone = np.cumsum(step)[:len(s)] > 0
            yield _cut_rows(batch, s, e, row, first, gone, key)

    return found.mapInArrow(tidied(cut), T.StructType([kind, *T.StructType.fromDDL(OUTPUT).fields]))


def _cut_rows(batch, s, e, row, first, gone, key):
    n = len(batch.keys)
    raw = batch.buf.tobytes()
    texts, spans = [], []
    for i in range(n):
        a, b = int(first[i]), int(first[i + 1])
        data = raw[batch.off[i]:batch.off[i + 1]]
        if not gone[a:b].any():
            texts.append(b" ".join(data.split()))
            spans.append([])
            continue
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone[a:b].astype(np.int8), [0]])))
        spans.append([{"start": x, "end": y} for x, y in edge.reshape(-1, 2).tolist()])
        kept = np.flatnonzero(~gone[a:b]) + a
        texts.append(b" ".join([raw[x:y] for x, y in zip(s[kept].tolist(), e[kept].tolist(), strict=True)]))
    return pa.RecordBatch.from_arrays(
        [pa.array(batch.keys, pa.int64()), pa.array(np.diff(first), pa.int64()), pa.array(X.per_row(gone, row, n), pa.int64()),
         pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
         pa.array(texts, pa.binary()).cast(pa.string())],
        names=[key, "n_words", "n_removed", "spans", "kept_text"])


