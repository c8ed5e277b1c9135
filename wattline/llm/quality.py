"""Quality rules by repetition coverage.

Rolling hashes of several n-gram lengths mark every character that lies in a
later occurrence of an n-gram of its text; later copies of lines are measured
the same way.  Word pairs come again in any long text, so they are looked for
inside windows of equally many words.  Each text is judged alone, so the job is one pass without a shuffle.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wattline.llm import shipped, tidied
from wattline.llm import text as X

#: Limits: share of word characters inside later occurrences of n-grams, and
#: inside later copies of lines.
REPEATED_GRAMS = {2: 0.30, 5: 0.20, 6: 0.19, 7: 0.18, 8: 0.17, 9: 0.16, 10: 0.15}
REPEATED_LINES = 0.30
#: Words in a window: 2-grams count as repeated inside one; longer n-grams in the whole text.
WINDOW = 1000
#: Share of symbol characters among the characters of words.
SYMBOLS = 0.10
SLICE = 2 << 20

SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "dup_line_share double, dup_gram_share array<double>, base_failed boolean, kept boolean")


def measure(buf: np.ndarray, off: np.ndarray, grams: dict[int, float] | None = None) -> dict[str, np.ndarray]:
    """All figures of the rows of one slice, as arrays."""
    grams = REPEATED_GRAMS if grams is None else grams
    n = len(off) - 1
    s, e, row, h, chars = X.words(buf, off)
    n_words, word_chars = X.per_row(None, row, n), X.per_row(chars, row, n)
    symbol = np.zeros(256, bool)
    symbol[list(b"#*$%&|<>")] = True
    at = np.flatnonzero(symbol[buf])
    n_symbols = X.per_row(None, np.searchsorted(off, at, "right") - 1, n)
    salt = X.mix(np.arange(1, n + 1, dtype=np.uint64))
    shares = []
    repeat8 = np.zeros(len(h), bool)
    for k in sorted({8, *grams}):
        pos, g = X.grams(h, row, k)
        key = g ^ salt[row[pos]]
        if k == 2:
            key ^= X.mix(((pos - np.searchsorted(row, np.arange(n))[row[pos]]) // WINDOW + (1 << 40)).astype(np.uint64))
        if k == 8:
            repeat8 = _cover(pos[X.repeated(key)], k, len(h))
        if k in grams:
            cover = _cover(pos[X.later(key)], k, len(h))
            shares.append(X.per_row(chars * cover, row, n) / np.maximum(word_chars, 1))
    dup_lines, dup_share = _lines(buf, off, s, row, chars, word_chars)
    n_repeat = X.per_row(repeat8, row, n)
    failed = (n_words < 20) | (100 * n_repeat > 30 * n_words)
    bad = (dup_share > REPEATED_LINES) | (n_symbols > SYMBOLS * word_chars)
    for share, (_, most) in zip(shares, sorted(grams.items()), strict=True):
        bad |= share > most
    return {"n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": dup_lines,
            "n_repeat_words": n_repeat, "dup_line_share": dup_share, "dup_gram_share": shares,
            "base_failed": failed, "kept": ~failed & ~bad}


def _cover(pos, k, n):
    cover = np.zeros(n, bool)
    for j in range(k):
        cover[pos + j] = True
    return cover


def _lines(buf, off, s, row, chars, word_chars):
    """Per row: lines equal to an earlier one, and the share of word characters in repeated lines."""
    n = len(off) - 1
    first = np.searchsorted(s, off)  # index of each row's first word
    count, share = np.zeros(n, np.int64), np.zeros(n)
    line_breaks = np.flatnonzero(buf == 10)
    has = np.searchsorted(line_breaks, off)
    ends = np.concatenate([[0], np.cumsum(chars)])
    for i in np.flatnonzero(np.diff(has) > 0):  # rows of two lines at least
        cuts = np.concatenate([[off[i] - 1], line_breaks[has[i]:has[i + 1]], [off[i + 1]]])
        w = np.searchsorted(s[first[i]:first[i + 1]], cuts) + first[i]
        held = np.flatnonzero(np.diff(w))  # lines with a word
        data = buf[off[i]:off[i + 1]].tobytes()
        lines = [data[cuts[j] + 1 - off[i]:cuts[j + 1] - off[i]] for j in held.tolist()]
        seen = Counter(lines)
        if len(seen) < len(lines):
            count[i] = len(lines) - len(seen)
            known: set[bytes] = set()
            again = np.fromiter((x in known or known.add(x) is not None for x in lines), bool, len(lines))
            share[i] = (ends[w[held + 1]] - ends[w[held]])[again].sum() / max(int(word_chars[i]), 1)
    return count, share


def repetition_rules(docs: DataFrame, key: str = "doc_id", column: str = "text",
                     grams: dict[int, float] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """``key``, the columns of ``keep`` and the figures and verdict of each row.

    Null or empty text: all counts 0, ``base_failed`` true, ``kept`` false.
    Null keys and repeated rows are kept as they are.  A word as long as the
    whole text is one word.  An empty table gives an empty result.  Further
    columns of the input are ignored, whatever their names."""
    names = [key, *keep]

    def run(batches):
        for batch in batches:
            col = batch.column(len(names))
            buf, off = X.utf8(col)
            for a, b in X.slices(off, SLICE):
                m = measure(buf[off[a]:off[b]], off[a:b + 1] - off[a], grams)
                share = np.column_stack(m.pop("dup_gram_share")) if m["dup_gram_share"] else np.zeros((b - a, 0))
                width = share.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1) * width, pa.int32()), pa.array(share.ravel()))
                cols = [pa.array(v) for v in m.values()]
                cols.insert(6, lists)
                yield pa.RecordBatch.from_arrays([batch.column(i).slice(a, b - a) for i in range(len(names))] + cols, names=schema.names)

    fields = [docs.schema[c] for c in names] + T.StructType.fromDDL(SCHEMA).fields
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])
    return shipped(docs).select(*names, docs[column].alias("_text")).mapInArrow(tidied(run), schema)
