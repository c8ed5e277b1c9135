"""Order-preserving packing of documents into training sequences.

Each partition tokenises its documents in input order and joins them.  A
dynamic program then chooses where sequences end: at document boundaries
(free), sentence ends or any other token (penalties), so that padding plus
penalties is least.  The best start of a sequence that ends at j minimises
``f[i] + pos[i]`` over the last ``capacity`` tokens, which a monotone queue
keeps.  Partitions are packed independently, without a shuffle.
"""

from __future__ import annotations

import itertools
import re
import string

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wattline.llm import shipped, tidied
from wattline.llm import text as X

SENTENCE_CUT = 8     # penalty in tokens of a cut at a sentence end
HARD_CUT = 64        # of a cut elsewhere in a document
PER_SEQUENCE = 32    # of each sequence, so that few full ones beat many short ones
STRIDE = 128         # a hard cut is offered where no boundary comes within so many tokens
BLOCK = 1 << 20      # tokens planned at once
CACHE = 1 << 20      # words remembered by a worker process
TASK_CACHE = 1 << 18  # of them by a task that forgets its words
SLICE = 2 << 20      # bytes encoded at once
SPACE = re.compile(rb"[\x20\x09-\x0D]")
OUTPUT = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class WordEncoder:
    """Ids of words by a tokenizer that lower-cases and drops white space, remembering words seen.

    The tokenizer must never join characters across ASCII white space, so that
    a text's ids are those of its words in order.  Letter words are encoded
    apart from the ASCII punctuation that follows them; where a letter word
    ends is read from the vocabulary's word-end mark."""

    PUNCTUATION = string.punctuation
    CALL = 512  # words encoded by one call

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.most = CACHE
        added = self.tok.get_added_tokens_decoder()
        self.special = {t.content.encode(): i for i, t in added.items()}
        self.at_special = re.compile(b"(" + b"|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + b")") if added else None
        self.tok.encode_special_tokens = True  # words get here without them, but perhaps in other case, which is ordinary text
        vocab = self.tok.get_vocab()
        self.final = np.zeros(max(vocab.values()) + 1, bool)
        self.final[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        self.reset()

    def reset(self):
        self.words, self.parts = _Store(), _Store()
        for store, name in ((self.words, b""), (self.parts, "")):  # beside white space at a text's ends, and no punctuation
            store.add([name], np.zeros(0, np.uint32), np.zeros(1, np.int64))
        self.stop = np.zeros(1 << 16, bool)

    def learn(self, new: list[bytes]):
        """Remember distinct new words (lower-cased in ASCII)."""
        text = b"\n".join(new).decode("utf-8", "replace").split("\n")
        core = list(map(str.rstrip, text, itertools.repeat(self.PUNCTUATION)))
        plain = [ok and (c.isascii() or c.lower().isalpha()) for c, ok in zip(core, map(str.isalpha, core), strict=True)]
        core = [c if ok else w for c, w, ok in zip(core, text, plain, strict=True)]
        rest = [w[len(c):] for c, w in zip(core, text, strict=True)]
        known = self.parts.index
        self._letters(list({c for c, ok in zip(core, plain, strict=True) if ok and c not in known}))
        self._any(list({c for c, ok in zip(core, plain, strict=True) if not ok and c not in known} | {r for r in set(rest) if r and r not in known}))
        pair = np.empty((len(new), 2), np.int64)
        pair[:, 0] = list(map(known.__getitem__, core))
        pair[:, 1] = list(map(known.__getitem__, rest))
        start, count = self.parts.start[pair], self.parts.count[pair]
        n = self.words.size
        self.words.add(new, self.parts.ids[spread(start.ravel(), count.ravel())], count.sum(axis=1))
        while self.words.size > len(self.stop):
            self.stop = np.concatenate([self.stop, np.zeros_like(self.stop)])
        # a plain word ends a sentence by the punctuation after it
        self.stop[n:self.words.size] = [(r if ok else w).rstrip("\"')]}»”’").endswith((".", "!", "?", "…", "。")) if r or not ok else False
                                        for r, w, ok in zip(rest, text, plain, strict=True)]

    def _letters(self, new: list[str]):
        for a in range(0, len(new), self.CALL):
            part = new[a:a + self.CALL]
            ids = np.asarray(self.tok.encode(" ".join(part), add_special_tokens=False).ids, np.uint32)
            ends = np.flatnonzero(self.final[ids]) + 1
            if len(ends) == len(part):
                self.parts.add(part, ids, np.diff(ends, prepend=0))
            else:  # a letter that the tokenizer takes for something else
                self._any(part)

    def _any(self, new: list[str]):
        for a in range(0, len(new), self.CALL):
            part = new[a:a + self.CALL]
            enc = self.tok.encode(" ".join(part), add_special_tokens=False)
            first = np.cumsum([0] + [len(s) + 1 for s in part[:-1]])
            at = np.asarray(enc.offsets, np.int64).reshape(-1, 2)[:, 0]
            self.parts.add(part, np.asarray(enc.ids, np.uint32), np.bincount(np.searchsorted(first, at, "right") - 1, minlength=len(part)))

    def encode(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text: ids, and the token positions after which a sentence ends.  A special token's
        string is that token, wherever it stands; the text around it is encoded apart."""
        if self.at_special is None or not any(map(self.at_special.search, texts)):
            return self._ordinary(texts)
        parts = [self.at_special.split(t) for t in texts]  # text, special, text, ..
        plain = iter(self._ordinary([t for p in parts for t in p[::2]]))
        out = []
        for p in parts:
            ids, stops = next(plain)
            all_ids, all_stops, n = [ids], [stops], len(ids)
            for name in p[1::2]:
                ids, stops = next(plain)
                all_ids += [np.array([self.special[name]], np.uint32), ids]
                all_stops.append(stops + n + 1)
                n += 1 + len(ids)
            out.append((np.concatenate(all_ids), np.concatenate(all_stops)))
        return out

    def _ordinary(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        split = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.large_binary()).view(pa.large_string())))
        coded = split.values.dictionary_encode()  # so that each distinct word is looked up once
        words = coded.dictionary.view(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        if self.words.size > self.most:
            self.reset()
        at = np.fromiter(map(self.words.index.get, words, itertools.repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            n = self.words.size
            self.learn([words[i] for i in missing.tolist()])
            at[missing] = np.arange(n, n + len(missing))
        w = at[coded.indices.to_numpy()]
        count = self.words.count[w]
        end = np.cumsum(count)
        ids = self.words.ids[spread(self.words.start[w], count)]
        stop = self.stop[w]
        out, a, before = [], 0, 0
        for b in split.offsets.to_pylist()[1:]:
            upto = int(end[b - 1]) if b else 0
            out.append((ids[before:upto], end[a:b][stop[a:b]] - before))
            a, before = b, upto
        return out


def segments(text: bytes, size: int):
    """The text cut at white space into parts of about ``size`` bytes."""
    a = 0
    while len(text) - a > size:
        m = SPACE.search(text, a + size)
        if not m:
            break
        yield text[a:m.start()]
        a = m.start()
    yield text[a:]


class _Store:
    """Strings and their ids: names in a dictionary, ids one after the other."""

    def __init__(self):
        self.index: dict = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1 << 16, np.int64)
        self.count = np.zeros(1 << 16, np.int64)
        self.size, self.used = 0, 0

    def add(self, names: list, ids: np.ndarray, count: np.ndarray):
        n, m = self.size, len(names)
        while n + m > len(self.start):
            self.start, self.count = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.count))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used:self.used + len(ids)] = ids
        self.count[n:n + m] = count
        self.start[n:n + m] = self.used + np.cumsum(count) - count
        self.index.update(zip(names, range(n, n + m), strict=True))
        self.size, self.used = n + m, self.used + len(ids)


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker process's encoder: later tasks find its tokenizer, and the words that earlier ones learnt."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[i], start[i]+1, ... for count[i] values each."""
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


def _encoded(coder: WordEncoder, texts: list[bytes]):
    if len(texts) > 1 or len(texts[0]) <= 2 * SLICE:
        return coder.encode(texts)
    ids, stops, before = [], [], 0
    for part in segments(texts[0], SLICE):
        i, s = coder.encode([part])[0]
        ids.append(i)
        stops.append(s + before)
        before += len(i)
    return [(np.concatenate(ids), np.concatenate(stops))]


def plan(pos: list[int], penalty: list[int], capacity: int, per_sequence: int = PER_SEQUENCE) -> list[int]:
    """Ends of the sequences that cost least; pos: allowed cuts, from 0 to the last token, at most
    ``capacity`` apart.  A sequence of a power of two has no padding."""
    n, place = len(pos), np.asarray(pos, np.int64)
    full: dict[int, list[int]] = {}  # cuts that lie a power of two before a cut
    for w in (1 << k for k in range(8, capacity.bit_length())):
        k = np.searchsorted(place, place - w)
        hit = np.flatnonzero(place[k] == place - w)
        for j, i in zip(hit.tolist(), k[hit].tolist(), strict=True):
            full.setdefault(j, []).append(i)
    low = np.searchsorted(place, place - capacity).tolist()
    cost = (np.asarray(penalty, np.int64) + per_sequence).tolist()
    f, g, prev = [0] * n, [0] * n, [0] * n
    queue, head = [0], 0
    for j in range(1, n):
        p, first = pos[j], low[j]
        while queue[head] < first:
            head += 1
        i = queue[head]
        best = g[i] + capacity - p
        if j in full:
            for k in full[j]:
                if f[k] < best:
                    i, best = k, f[k]
        f[j] = best = best + cost[j]
        g[j] = best = best + p
        prev[j] = i
        while len(queue) > head and g[queue[-1]] >= best:
            queue.pop()
        queue.append(j)
    ends, j = [], n - 1
    while j:
        ends.append(pos[j])
        j = prev[j]
    return ends[::-1]


def tail(length: int, capacity: int, per_cut: int = HARD_CUT + PER_SEQUENCE) -> list[int]:
    """Lengths into which the last sequence of a partition is cut: powers of two, where that costs
    less than its padding."""
    bits = [1 << k for k in range(length.bit_length() - 1, -1, -1) if length >> k & 1]
    return bits if (len(bits) - 1) * per_cut < capacity - length else [length]


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", column: str = "text", capacity: int = 4096,
         end_id: int = 2, remember: bool = True) -> DataFrame:
    """Pieces: key, start, length, ids (packed little-endian uint32), doc_tokens, sequence_id, offset.

    Each document's ids are its tokens, then ``end_id``; every id lies in
    exactly one piece, pieces of a sequence lie gapless from offset 0, and no
    sequence is longer than ``capacity``.  Null or empty text is the end id
    alone.  Null keys and repeated rows are packed like any other; further
    columns are ignored; an empty table gives no piece.  ``tokenizer`` is a
    path that every executor can read.  With ``remember``, worker processes keep
    the words they have learnt for later tasks: faster, for about 150 MB each."""

    def run(batches):
        coder = encoder(tokenizer)
        coder.most = CACHE if remember else TASK_CACHE
        serial = itertools.count(TaskContext.get().partitionId() << 40)
        held = _Held(key, capacity, end_id, serial)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).cast(pa.large_binary())
            size = np.concatenate([[0], np.cumsum([len(t.as_buffer()) if t.is_valid else 0 for t in texts])])
            for a, b in X.slices(size, SLICE):
                for i, (ids, stops) in enumerate(_encoded(coder, [t.as_py() or b"" for t in texts[a:b]]), a):
                    held.add(keys[i], ids, stops)
                    if held.size >= BLOCK:
                        yield from held.flush(last=False)
        yield from held.flush(last=True)
        if not remember:
            coder.reset()

    kind = T.StructField(key, docs.schema[key].dataType, True)
    schema = T.StructType([kind, *T.StructType.fromDDL(OUTPUT).fields])
    return shipped(docs).select(key, docs[column].alias("_text")).mapInArrow(tidied(run), schema)


class _Held:
    """Documents whose sequences are not yet fixed."""

    def __init__(self, key, capacity, end_id, serial):
        self.key = key
        self.capacity, self.end, self.serial = capacity, np.array([end_id], np.uint32), serial
        self.docs: list[tuple] = []  # key, ids, ids before them in the document, document's size
        self.cuts: list[np.ndarray] = []
        self.size = 0

    def add(self, key, ids, stops):
        ids = np.concatenate([ids, self.end])
        self.docs.append((key, ids, 0, len(ids)))
        self.cuts.append(stops)
        self.size += len(ids)

    def flush(self, last):
        if not self.size:
            return
        pos, pen = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
        shift = 0
        for (_, ids, _, _), stops in zip(self.docs, self.cuts, strict=True):
            n = len(ids)
            soft = stops[(stops > 0) & (stops < n)]
            edges = np.concatenate([[0], soft, [n]])
            gaps = np.diff(edges)
            if gaps.max() <= STRIDE:
                pos.append(edges[1:] + shift)
                pen.append(np.full(len(edges) - 1, SENTENCE_CUT))
                pen[-1][-1] = 0
                shift += n
                continue
            hard = np.concatenate([np.arange(edges[i] + STRIDE, edges[i + 1], STRIDE) for i in np.flatnonzero(gaps > STRIDE)] or [np.zeros(0, np.int64)])
            every = np.concatenate([soft, hard, [n]])
            cost = np.concatenate([np.full(len(soft), SENTENCE_CUT), np.full(len(hard), HARD_CUT), [0]])
            order = np.argsort(every, kind="stable")
            pos.append(every[order] + shift)
            pen.append(cost[order])
            shift += n
        ends = plan(np.concatenate(pos).tolist(), np.concatenate(pen).tolist(), self.capacity)
        if last:
            begin = ends[-2] if len(ends) > 1 else 0
            ends[-1:] = (begin + np.cumsum(tail(ends[-1] - begin, self.capacity))).tolist()
        elif len(ends) > 1:
            ends.pop()
        else:
            return
        yield self._pieces(np.array(ends, np.int64))

    def _pieces(self, ends):
        starts = np.concatenate([[0], ends[:-1]])
        done, shift, s = int(ends[-1]), 0, 0
        rows: list[tuple] = []
        rest, rest_cuts = [], []
        names = [next(self.serial) for _ in ends]
        for (key, ids, before, size), stops in zip(self.docs, self.cuts, strict=True):
            n = len(ids)
            a = shift
            while a < min(shift + n, done):
                while ends[s] <= a:
                    s += 1
                b = min(shift + n, int(ends[s]))
                part = ids[a - shift:b - shift]
                rows.append((key, before + a - shift, b - a, part.astype("<u4").tobytes(), size, names[s], a - int(starts[s])))
                a = b
            if shift + n > done:
                k = max(0, done - shift)
                rest.append((key, ids[k:], before + k, size))
                rest_cuts.append(stops[stops > k] - k)
            shift += n
        self.docs, self.cuts = rest, rest_cuts
        self.size = sum(len(d[1]) for d in rest)
        key, *cols = zip(*rows, strict=True)
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        keys = pa.array([k.as_py() for k in key], key[0].type)
        return pa.RecordBatch.from_arrays([keys, *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
                                          names=[self.key, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
