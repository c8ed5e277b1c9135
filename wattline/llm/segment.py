"""Sampled sub-word segmentations without replacement, and decoding.

A text's segmentations into pieces of a SentencePiece vocabulary form a
lattice.  Pieces never reach over the start of a word (a run of word marks) or
over a line feed, so the lattice is a chain of small ones, built once for each
distinct word.  Gumbel top-k sampling draws k distinct segmentations: every
set of continuations carries the maximum of its members' perturbed scores and
the best set is opened first (A-star).  Where its maximum lies is drawn by the
edges' chances; its siblings' maxima are Gumbel variables cut off at it, drawn
only where they can still matter.  A path's choices do not depend on the
maxima, so all words of many texts are walked together.  Noise is a hash of the row's key and the place, so a
row's samples do not depend on partitions or batches.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.llm import shipped, tidy
from wattline.llm import text as X

MARK = "▁"
TABLE = 1 << 18     # slots for the vocabulary's prefixes
LATTICE = 4 << 20   # bytes whose distinct words share one lattice
WALK = 1 << 20      # bytes walked at once
SCALE = 3.0         # backward sums are raised by its exponential for each character
FRONT = 8           # edges whose siblings are looked at first
REACH = 40.0        # no set's perturbed maximum exceeds its log probability by more, with 53-bit noise
OUTPUT = "sample int, ids binary, n_pieces long, log_prob double, perturbed double, log_inclusion double, spelt string"


class Vocabulary:
    """Pieces with log weights that fall with the piece's rank, and a table of all their prefixes.

    Weight: 1 / (rank + 10); pieces without a rank stand last.  A character
    that is no piece is spelt by its bytes, each with a quarter of the last
    rank's weight."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(n)]
        special = np.array([model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)])
        rank = np.array([min(-model.get_score(i), n) for i in range(n)])
        self.log_weight = -np.log(rank + 10.0)
        self.byte_weight = -np.log(4.0 * (n + 10.0))
        self.byte_id = np.zeros(256, np.uint32)
        for i in range(n):
            if model.is_byte(i):
                self.byte_id[int(pieces[i][1:-1], 16)] = i
        self.most = 0
        entries: dict[int, int] = {}
        for i in range(n):
            if special[i]:
                continue
            p = pieces[i]
            assert MARK not in p.lstrip(MARK) and "\n" not in p, "a piece reaches over a word's start"
            self.most = max(self.most, len(p))
            h = 0
            for k, c in enumerate(p):
                h = (h * X.BASE + (ord(c) + 1) * 0xD6E8FEB86659FD93) & X.MASK
                entries[h] = i if k == len(p) - 1 else entries.get(h, -1)
        self.table = np.zeros(TABLE, X.U)  # open addressing; 0 is an empty slot
        self.piece = np.full(TABLE, -1, np.int32)
        names = np.array(list(entries), X.U)
        slot, left = (names >> X.U(40)).astype(np.int32) & (TABLE - 1), np.arange(len(names))
        pieces_of = np.array(list(entries.values()), np.int32)
        while len(left):
            free = left[self.table[slot[left]] == 0]
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.table[slot[put]], self.piece[slot[put]] = names[put], pieces_of[put]
            left = left[self.table[slot[left]] != names[left]]
            slot[left] = (slot[left] + 1) & (TABLE - 1)
        raw = [bytes([int(p[1:-1], 16)]) if model.is_byte(i) else b"" if special[i] else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_count = np.array([len(r) for r in raw], np.int64)
        self.raw_start = np.cumsum(self.raw_count) - self.raw_count

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(indices of the hashes that are prefixes of pieces, their slots)."""
        slot = (h >> X.U(40)).astype(np.int32) & (TABLE - 1)
        held = self.table[slot]
        same = held == h
        found = np.where(same, slot, np.int32(-1))
        left = np.flatnonzero(~same & (held != 0))
        while len(left):
            slot[left] = (slot[left] + 1) & (TABLE - 1)
            at = slot[left]
            held = self.table[at]
            same = held == h[left]
            found[left[same]] = at[same]
            left = left[~same & (held != 0)]
        hit = np.flatnonzero(found >= 0)
        return hit, found[hit]

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of pieces: word marks are spaces, the space put before the text is dropped."""
        got = self.raw[_spread(self.raw_start[ids], self.raw_count[ids])].tobytes()
        return got[1:] if got[:1] == b" " else got


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(path)
    return _VOCABULARIES[path]


def _spread(start, count):
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


def units(buf: np.ndarray, off: np.ndarray):
    """(bytes with a space put before every non-empty row, start, end, row, hash) of the rows' words.

    A word is a run of spaces and what follows up to the next space or line
    feed; a line feed is a word of its own."""
    size = np.diff(off)
    full = np.flatnonzero(size > 0)
    begin = off[:-1][full] + np.arange(len(full))  # each full row's place once the spaces are in
    text = np.full(len(buf) + len(full), 32, np.uint8)
    body = np.ones(len(text), bool)
    body[begin] = False
    text[body] = buf
    space, feed = text == 32, text == 10
    head = feed.copy()
    head[1:] |= feed[:-1]
    head[1:] |= space[1:] & ~space[:-1]
    head[begin] = True
    start = np.flatnonzero(head)
    end = np.append(start[1:], len(text))
    row = full[np.searchsorted(begin, start, "right") - 1] if len(full) else start
    hashes, bounds = [], [*begin.tolist(), len(text)]
    a = 0
    while a < len(full):  # whole rows, about a chunk of bytes at once
        b = max(a + 1, int(np.searchsorted(begin, begin[a] + X.CHUNK, "right")) - 1)
        x, y = bounds[a], bounds[b]
        i, j = np.searchsorted(start, [x, y])
        n = y - x
        up, down = (X.POW, X.INV) if n <= X.CHUNK else (X.powers(X.BASE, n), X.powers(pow(X.BASE, -1, 1 << 64), n))
        total = np.zeros(n + 1, X.U)
        np.cumsum(X.RND[text[x:y]] * up[:n], out=total[1:])
        hashes.append(X.mix((total[end[i:j] - x] - total[start[i:j] - x]) * down[start[i:j] - x] + (end[i:j] - start[i:j]).astype(X.U)))
        a = b
    return text, start, end, row, np.concatenate(hashes) if hashes else np.zeros(0, X.U)


def lattice_of(vocab: Vocabulary, buf: np.ndarray, off: np.ndarray):
    """(lattice of the rows' distinct words, word of each occurrence, occurrences of each row)."""
    text, start, end, row, value = units(buf, off)
    turn = np.argsort(value)
    value = value[turn]
    head = np.diff(value, prepend=~value[:1]) != 0
    first, word = turn[head], np.empty(len(turn), np.int64)
    word[turn] = np.cumsum(head) - 1
    raw = text[_spread(start[first], (end - start)[first])]
    points = np.concatenate([[0], np.cumsum(~X.CONT[raw])])
    size = np.diff(points[np.concatenate([[0], np.cumsum((end - start)[first])])])
    joined = raw.tobytes().decode("utf-8", "replace").replace(" ", MARK)
    return Lattice(vocab, joined, size), word, np.bincount(row, minlength=len(off) - 1)


class Lattice:
    """Edges of the distinct words of some texts, by start position.  Every word has one position
    more than characters, its end.  ``chance``: probability of each edge given its start."""

    def __init__(self, vocab: Vocabulary, joined: str, size: np.ndarray):
        chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.end = np.cumsum(size) + np.arange(len(size))
        self.start = self.end - size
        n = len(chars) + len(size)
        self.code = np.zeros(n, np.uint32)
        inner = np.arange(len(chars), dtype=np.int32) + np.repeat(np.arange(len(size), dtype=np.int32), size)
        self.code[inner] = chars
        left = np.zeros(n, np.int32)  # characters to the word's end
        left[inner] = np.repeat(self.end, size) - inner
        value = (self.code.astype(X.U) + X.U(1)) * X.U(0xD6E8FEB86659FD93)
        at, h = inner, np.zeros(len(chars), X.U)
        src, length, piece = [], [], []
        single = np.zeros(n, bool)
        for k in range(1, vocab.most + 1):
            ok = left[at] >= k
            at, h = at[ok], h[ok]
            h = h * X.U(X.BASE) + value[at + k - 1]
            ok, slot = vocab.find(h)
            at, h = at[ok], h[ok]
            if not len(at):
                break
            found = vocab.piece[slot]
            hit = found >= 0
            src.append(at[hit])
            length.append(np.full(int(hit.sum()), k, np.int32))
            piece.append(found[hit])
            if k == 1:
                single[at[hit]] = True
        bare = inner[~single[inner]]
        src.append(bare)
        length.append(np.ones(len(bare), np.int32))
        piece.append(np.full(len(bare), -1, np.int32))
        each = sum(np.bincount(a, minlength=n) for a in src)
        self.first = np.concatenate([[0], np.cumsum(each)]).astype(np.int64)
        place, free = [], self.first[:-1].copy()
        for a in src[::-1]:  # of each start, the longest piece first: mostly the likeliest
            place.append(free[a])
            free[a] += 1
        place = np.concatenate(place[::-1])
        rows = []
        for x in (src, length, piece):
            row = np.empty(len(place), np.int32)
            row[place] = np.concatenate(x)
            rows.append(row)
        self.source, length, self.piece = rows
        self.target = self.source + length
        width = 1 + (self.code >= 0x80).astype(np.int64) + (self.code >= 0x800) + (self.code >= 0x10000)
        weight = vocab.log_weight[self.piece]
        bare = np.flatnonzero(self.piece < 0)
        weight[bare] = vocab.byte_weight * width[self.source[bare]]
        # edges by their start's distance from the word's end: backward sums go over all words together
        far = left[self.source]
        turn = np.argsort(far.astype(np.int16) if not n or left.max() < 1 << 15 else far, kind="stable")
        far = far[turn]
        cuts = np.append(np.flatnonzero(np.diff(far, prepend=-1)), len(turn))
        self.chance = self._scaled(weight, length, turn, cuts, n)
        if self.chance is None:
            self.chance = self._logged(weight, np.split(turn, cuts[1:-1]), n)

    def _scaled(self, weight, length, turn, cuts, n):
        """Chances from backward sums scaled by a factor a character; None if they leave the range of doubles."""
        with np.errstate(over="ignore", under="ignore", invalid="ignore", divide="ignore"):
            v, source, target = np.exp(weight + SCALE * length)[turn], self.source[turn], self.target[turn]
            head = np.flatnonzero(np.diff(source, prepend=-1))
            starts, heads = source[head], np.searchsorted(head, cuts).tolist()
            total = np.ones(n)
            for a, b, i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), heads[:-1], heads[1:], strict=True):
                v[a:b] *= total[target[a:b]]
                total[starts[i:j]] = np.add.reduceat(v[a:b], head[i:j] - a)
            if not (np.isfinite(total).all() and total.min(initial=1.0) > 1e-290):
                return None
            v /= total[source]
            chance = np.empty(len(v))
            chance[turn] = v
            return chance

    def _logged(self, weight, levels, n):
        beta = np.zeros(n)
        for e in levels:
            v = weight[e] + beta[self.target[e]]
            s = self.source[e]
            head = np.flatnonzero(np.diff(s, prepend=-1))
            top = np.maximum.reduceat(v, head)
            count = np.diff(np.append(head, len(s)))
            beta[s[head]] = top + np.log(np.add.reduceat(np.exp(v - np.repeat(top, count)), head))
        return np.exp(weight + beta[self.target] - beta[self.source])


def mark(i: int, value) -> np.ndarray:
    """The i-th part of a place that noise is drawn for."""
    return np.asarray(value).astype(X.U) * X.U((0x9E3779B97F4A7C15 * (2 * i + 3)) & X.MASK)


def uniform(place: np.ndarray) -> np.ndarray:
    """Numbers between 0 and 1 from a hash of 64-bit places."""
    return ((X.mix(place) >> X.U(11)).astype(np.float64) + 0.5) * 2.0**-53


class Texts:
    """A slice of texts as occurrences of lattice words."""

    def __init__(self, lattice: Lattice, word: np.ndarray, count: np.ndarray, seed: np.ndarray):
        self.lattice, self.word, self.n = lattice, word, len(count)
        self.doc = np.repeat(np.arange(self.n), count)
        self.first = np.cumsum(count) - count
        self.place = np.arange(len(word)) - self.first[self.doc]
        self.seed = seed
        self.turn = np.argsort(word)  # equal words together: the lattice is read in order

    def walk(self, sample: int, occ: np.ndarray, node: np.ndarray, step: np.ndarray):
        """Draw edges from ``node`` to the end of each occurrence's word.

        Returns (occurrence, step, edge), sorted by occurrence and step.  The
        set that holds a perturbed maximum is drawn by the edges' chances."""
        lat = self.lattice
        if len(occ) < len(self.turn):
            place = np.full(len(self.turn), -1, np.int64)
            place[occ] = np.arange(len(occ))
            turn = place[self.turn]
            turn = turn[turn >= 0]
        else:
            turn = self.turn
        occ, node = occ[turn], node[turn]
        begin = np.zeros(len(self.word), np.int64)
        begin[occ] = step[turn]
        seeds = self.seed[self.doc[occ]] + mark(0, sample) + mark(1, self.place[occ]) + mark(2, begin[occ])
        taken = []
        while True:
            edge, last = lat.first[node], lat.first[node + 1] - 1
            live = np.flatnonzero(edge <= last)  # a word's end has no edges
            if not len(live):
                break
            if len(live) < len(occ):
                occ, edge, last, seeds = occ[live], edge[live], last[live], seeds[live]
            rest = uniform(seeds) - lat.chance[edge]
            more = np.flatnonzero((rest >= 0) & (edge < last))
            at, left, last = edge[more], rest[more], last[more]
            while len(more):
                at += 1
                left -= lat.chance[at]
                on = np.flatnonzero((left >= 0) & (at < last))
                edge[more] = at
                more, at, left, last = more[on], at[on], left[on], last[on]
            taken.append((occ, edge))
            node = lat.target[edge]
            seeds = seeds + mark(2, 1)
        if not taken:
            return (np.zeros(0, np.int64),) * 3
        count = np.bincount(np.concatenate([o for o, _ in taken]), minlength=len(self.word))
        start = np.cumsum(count) - count
        edges = np.empty(int(count.sum()), np.int64)
        for i, (o, edge) in enumerate(taken):
            edges[start[o] + i] = edge
        occ = np.repeat(np.arange(len(count)), count)
        return occ, np.arange(len(occ)) + (begin - start)[occ], edges

    def siblings(self, sample: int, occ, step, edge, level, top):
        """The edges not taken beside each taken one: (index of the taken one, edge, log probability of
        the set beyond it, that set's perturbed maximum, which the taken one's ``top`` bounds)."""
        lat = self.lattice
        node = lat.source[edge]
        first = lat.first[node]
        count = lat.first[node + 1] - first
        at = np.repeat(np.arange(len(occ)), count)
        other = _spread(first, count)
        keep = other != edge[at]
        at, other = at[keep], other[keep]
        phi = level[at] + np.log(lat.chance[other])
        seeds = self.seed[self.doc[occ]] + mark(0, sample) + mark(1, self.place[occ]) + mark(2, step)
        u = uniform(seeds[at] + mark(3, other - first[at] + 1))
        return at, other, phi, phi - np.log(np.exp(np.minimum(phi - top[at], 700.0)) - np.log(u))


def sample_texts(texts: Texts, k: int):
    """k distinct segmentations of each text, best perturbed score first.

    Yields (document, sample, edges, log probability, perturbed score, log
    inclusion probability)."""
    n, lat = texts.n, texts.lattice
    top = -np.log(-np.log(uniform(texts.seed + mark(4, 1))))
    paths: list[dict[int, tuple]] = [{} for _ in range(n)]  # of each document: sample -> (place, step, edge) arrays
    scores: list[list[tuple]] = [[] for _ in range(n)]      # (log probability, perturbed score)
    pool = _Pool(n, k + 1)
    live = np.arange(n)
    start_occ, start_node = np.arange(len(texts.word)), lat.start[texts.word]
    start_step = np.zeros(len(start_occ), np.int64)
    prefix, value, stem = np.zeros(n), top, [None] * n
    for r in range(1, k + 1):
        occ, step, edge = texts.walk(r, start_occ, start_node, start_step)
        doc, gain = texts.doc[occ], np.log(lat.chance[edge])
        upto = np.concatenate([[0.0], np.cumsum(gain)])
        cut = np.searchsorted(doc, np.arange(n + 1))
        level = (prefix - upto[cut[:-1]])[doc] + upto[:-1]  # log probability up to each edge's start
        total = prefix + upto[cut[1:]] - upto[cut[:-1]]
        new = (texts.place[occ], step, edge)
        ends = cut.tolist()
        for d in live.tolist():
            mine = tuple(x[ends[d]:ends[d + 1]] for x in new)
            if stem[d] is not None:
                mine = tuple(np.concatenate(x) for x in zip(stem[d], mine, strict=True))
            paths[d][r] = mine
            scores[d].append((float(total[d]), float(value[d])))
        # siblings along the new part of the path: near its start first, then wherever one could matter
        front = np.arange(len(occ)) < cut[:-1][doc] + FRONT
        for near in (True, False):
            pick = np.flatnonzero(front if near else ~front & (level >= pool.least()[doc] - REACH))
            if not len(pick):
                continue
            at, other, phi, bound = texts.siblings(r, occ[pick], step[pick], edge[pick], level[pick], value[doc[pick]])
            d = doc[pick][at]
            good = bound >= pool.least()[d]
            at = pick[at[good]]
            pool.add(d[good], bound[good], r, occ[at], step[at], other[good], phi[good])
        if r == k:
            break
        live, picked = pool.pop(live)
        if not len(live):
            break
        value, prefix, stem = np.zeros(n), np.zeros(n), [None] * n
        occs, nodes, steps = [], [], []
        for d, (bound, parent, o, s, e, phi) in zip(live.tolist(), picked, strict=True):
            value[d], prefix[d] = bound, phi
            place = int(texts.place[o])
            p, q, x = paths[d][parent]
            same = int(np.searchsorted(p, place)) + s
            stem[d] = (np.append(p[:same], place), np.append(q[:same], s), np.append(x[:same], e))
            last = int(texts.first[d + 1]) if d + 1 < n else len(texts.word)
            rest = np.arange(o, last)
            occs.append(rest)
            nodes.append(np.append(lat.target[e], lat.start[texts.word[rest[1:]]]))
            steps.append(np.append(s + 1, np.zeros(len(rest) - 1, np.int64)))
        start_occ, start_node, start_step = (np.concatenate(x) for x in (occs, nodes, steps))
    threshold = pool.best()
    for d in range(n):
        for r, (log_prob, score) in enumerate(scores[d], 1):
            yield d, r, paths[d][r][2], log_prob, score, _log_inclusion(log_prob - threshold[d])


def _log_inclusion(lead: float) -> float:
    """log(1 - exp(-exp(lead))): the chance that a perturbed score beats the first one left out."""
    if lead < -30:
        return lead
    return float(np.log(-np.expm1(-np.exp(min(lead, 30.0)))))


class _Pool:
    """The best unopened sets of each document."""

    def __init__(self, n: int, most: int):
        self.n, self.most = n, most
        self.rows = (np.zeros(0, np.int64), np.zeros(0), *(np.zeros(0, np.int64),) * 4, np.zeros(0))

    def add(self, doc, bound, parent, occ, step, edge, level):
        new = (doc, bound, np.full(len(doc), parent), occ, step, edge, level)
        rows = tuple(np.concatenate(x) for x in zip(self.rows, new, strict=True))
        order = np.lexsort((-rows[1], rows[0]))
        doc = rows[0][order]
        nth = np.arange(len(doc)) - np.searchsorted(doc, doc)
        self.rows = tuple(x[order[nth < self.most]] for x in rows)

    def least(self) -> np.ndarray:
        """The worst kept score of each document; minus infinity while there is room."""
        out = np.full(self.n, -np.inf)
        doc = self.rows[0]
        nth = np.arange(len(doc)) - np.searchsorted(doc, doc)
        full = nth == self.most - 1
        out[doc[full]] = self.rows[1][full]
        return out

    def best(self) -> np.ndarray:
        out = np.full(self.n, -np.inf)
        doc = self.rows[0]
        head = np.flatnonzero(np.diff(doc, prepend=-1))
        out[doc[head]] = self.rows[1][head]
        return out

    def pop(self, live):
        doc = self.rows[0]
        head = np.flatnonzero(np.diff(doc, prepend=-1))
        head = head[np.isin(doc[head], live)]
        got = [tuple(x[i] for x in self.rows[1:]) for i in head]
        keep = np.ones(len(doc), bool)
        keep[head] = False
        docs = doc[head]
        self.rows = tuple(x[keep] for x in self.rows)
        return docs, [(float(b), int(p), int(o), int(s), int(e), float(v)) for b, p, o, s, e, v in got]


def piece_ids(lattice: Lattice, vocab: Vocabulary, edges: np.ndarray, count: np.ndarray):
    """(ids of the edges of several paths, ids of each path); characters without a piece become
    their bytes' ids."""
    ids = lattice.piece[edges]
    bare = np.flatnonzero(ids < 0)
    code = lattice.code[lattice.source[edges[bare]]]
    ids[bare] = vocab.byte_id[np.minimum(code, 127)]
    wide = bare[code >= 128]
    if not len(wide):
        return ids.astype(np.uint32), count
    spelt = [list(chr(c).encode("utf-8", "replace")) for c in code[code >= 128].tolist()]
    each = np.ones(len(ids), np.int64)
    each[wide] = [len(x) for x in spelt]
    at = np.cumsum(each) - each
    out = np.repeat(ids, each).astype(np.uint32)
    out[_spread(at[wide], each[wide])] = vocab.byte_id[[b for x in spelt for b in x]]
    ends = np.cumsum(count)
    upto = np.concatenate([[0], np.cumsum(each)])
    return out, upto[ends] - upto[ends - count]


def _strings(data: np.ndarray, count: np.ndarray, kind) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
    return pa.Array.from_buffers(kind, len(count), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _rows(keys, names, lattice, vocab, drawn) -> pa.RecordBatch:
    d, r, edges, log_prob, value, inclusion = zip(*drawn, strict=True)
    ids, count = piece_ids(lattice, vocab, np.concatenate(edges), np.fromiter(map(len, edges), np.int64, len(edges)))
    raw = vocab.raw_count[ids]
    text = vocab.raw[_spread(vocab.raw_start[ids], raw)]
    ends = np.concatenate([[0], np.cumsum(raw)])[np.concatenate([[0], np.cumsum(count)])]
    full = np.diff(ends) > 0  # without the space put before the text
    keep = np.ones(len(text), bool)
    keep[ends[:-1][full]] = False
    return pa.RecordBatch.from_arrays(
        [keys.take(pa.array(d)), pa.array(r, pa.int32()), _strings(ids.astype("<u4"), count * 4, pa.binary()), pa.array(count),
         pa.array(log_prob), pa.array(value), pa.array(inclusion), _strings(text[keep], np.diff(ends) - full, pa.string())], names=names)


def sample_segmentations(docs: DataFrame, model: str, key: str = "doc_id", column: str = "text", samples: int = 2) -> DataFrame:
    """``key``, sample (from 1), ids (packed little-endian uint32), n_pieces, log_prob, perturbed,
    log_inclusion, spelt (the text decoded from the ids): up to ``samples`` distinct segmentations of each whole text.

    Samples are drawn without replacement in proportion to the product of
    their pieces' weights and come in falling perturbed score.  log_inclusion
    is the log probability of exceeding the best score left out (0 if none is
    left).  A text with fewer segmentations gives all of them; null or empty
    text gives one without pieces.  Equal keys have equal noise; a null key
    counts as seed 0.  Further columns are ignored; an empty table gives an
    empty result."""

    def run(batches):
        vocab = vocabulary(model)
        for rb in batches:
            buf, off = X.utf8(rb.column(1))
            for a, b in X.slices(off, LATTICE):
                keys = rb.column(0).slice(a, b - a)
                seeds = np.array([0 if s is None else s for s in rb.column(2).slice(a, b - a).to_pylist()], np.int64).view(X.U)
                local = off[a:b + 1] - off[a]
                lattice, word, count = lattice_of(vocab, buf[off[a]:off[b]], local)
                upto = np.concatenate([[0], np.cumsum(count)])
                for c, e in X.slices(local, WALK):
                    texts = Texts(lattice, word[upto[c]:upto[e]], count[c:e], seeds[c:e])
                    drawn = ((c + d, *rest) for d, *rest in sample_texts(texts, samples))
                    yield _rows(keys, [key, *(f.name for f in fields)], lattice, vocab, drawn)
        tidy()

    fields = T.StructType.fromDDL(OUTPUT).fields
    kind = T.StructField(key, docs.schema[key].dataType, True)
    schema = T.StructType([kind, *fields])
    seed = F.xxhash64(docs[key].cast("string"))
    return shipped(docs).select(key, docs[column].alias("_text"), F.when(docs[key].isNotNull(), seed).alias("_seed")).mapInArrow(run, schema)


def decode(rows: DataFrame, model: str, column: str = "ids", name: str = "text") -> DataFrame:
    """``rows`` with the text that packed ids spell; null ids give null."""
    fields = [f for f in rows.schema.fields if f.name != name]

    def run(batches):
        vocab = vocabulary(model)
        for rb in batches:
            at = rb.schema.names.index(column)
            texts = [None if x is None else vocab.decode(np.frombuffer(x, "<u4").astype(np.int64)).decode("utf-8", "replace") for x in rb.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*rb.columns, pa.array(texts, pa.string())], names=[*rb.schema.names, name])

    schema = T.StructType([*fields, T.StructField(name, T.StringType(), True)])
    return shipped(rows).select(*[f.name for f in fields]).mapInArrow(run, schema)
