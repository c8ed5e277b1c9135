"""Suffix-array dedup.

Removes every byte covered by a string of ``LENGTH`` bytes that also starts in
a document with a smaller key.

1. In each window of ``LENGTH`` bytes the gram with the least hash is the
   window's anchor (equal windows have equal anchors).  Anchors that only one
   document holds cannot belong to a repeated window; the rest stays.
2. Neighbouring windows with the same anchor form a run; its text goes to the
   anchor's bucket, so equal windows meet whatever documents they stand in.
   Where an anchor's distinct run texts are many, each of its windows is a run
   of its own and goes by the hash of all its bytes; again, windows that only
   one document holds are left out first.
3. A bucket keeps each run text once, with its least owner.  A text alone with
   its anchor has equal windows nowhere else.  Texts that share their anchor
   are laid into shards, an anchor's next to each other.  Each shard gets a suffix
   array by Larsson-Sadakane refinement (only groups not yet told apart are
   sorted again, by rank pairs at doubled distance), common prefixes by
   Kasai's recurrence, and so classes of equal windows; the shards of one large
   anchor are merged by binary search of their sorted classes.  Bytes are
   compared, not hashes.

Batches and buckets are large, so that messages between them stay few; a
bucket is judged in parts, so that its memory stays small.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.llm import exchange as E
from wattline.llm import text as X
from wattline.llm import tidied

LENGTH = 50
GRAM = 24
SHARD = 512 << 10  # bytes in a suffix array
SEGMENT = 1 << 17  # bytes hashed at once
BATCH = 8 << 20    # bytes of a batch
BUCKET = 64 << 20  # corpus bytes per bucket
PART = 8 << 20     # corpus bytes per part of a bucket; parts are judged one after the other
HOT = 1 << 20     # bytes of run texts, distinct within their batches, that one anchor may bring to a bucket
PLAIN = 2 * LENGTH - GRAM  # bytes of an anchor's longest run text, unless its gram comes again

OUTPUT = "n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept"


# --- suffix arrays -----------------------------------------------------------

def words8(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as a big-endian number; zeros follow the end."""
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    out = np.zeros(len(buf), X.U)
    for k in range(8):
        out = (out << X.U(8)) | padded[k:k + len(buf)]
    return out


def suffix_array(w8: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes (Larsson-Sadakane).

    A rank is the index of its group's first member; only members of groups
    larger than one are sorted again, by the rank ``h`` bytes further on."""
    n = len(w8)
    order = np.argsort(w8)
    value = w8[order]
    rank = np.empty(n, np.int64)
    new = np.ones(n, bool)
    new[1:] = value[1:] != value[:-1]
    at = np.flatnonzero(new)
    rank[order] = np.repeat(at, np.diff(np.append(at, n)))
    h = 8
    while h < n:
        lead = rank[order]
        loose = np.zeros(n, bool)
        same = lead[1:] == lead[:-1]
        loose[1:] |= same
        loose[:-1] |= same
        slot = np.flatnonzero(loose)
        if not len(slot):
            break
        item = order[slot]
        further = item + h
        follow = np.where(further < n, rank[np.minimum(further, n - 1)] + 1, 0)
        key = (rank[item].astype(X.U) << X.U(32)) | follow.astype(X.U)
        by = np.argsort(key)
        item, key = item[by], key[by]
        order[slot] = item
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        at = np.flatnonzero(new)
        rank[item] = np.repeat(slot[at], np.diff(np.append(at, len(key))))
        h *= 2
    return order


def common_prefixes(w8: np.ndarray, order: np.ndarray, most: int, lanes: int = 4096) -> np.ndarray:
    """For each place in ``order``: the common prefix with the place before, up to ``most`` (Kasai).

    The text is cut into lanes that advance together; within a lane the
    prefix of the next position is at least that of this one less one."""
    n = len(order)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    prefix = np.zeros(n, np.int64)
    step = -(-n // min(lanes, n)) if n else 1
    lane = np.arange(0, n, step)
    carry = np.zeros(len(lane), np.int64)
    for t in range(step):
        i = lane + t
        i = i[i < n]
        size = np.maximum(carry[:len(i)] - 1, 0)
        j = before[i]
        size[j < 0] = 0
        go = np.flatnonzero((j >= 0) & (size < most))
        while len(go):
            a, b = i[go] + size[go], j[go] + size[go]
            ok = (a < n) & (b < n)
            go, a, b = go[ok], a[ok], b[ok]
            differ = w8[a] ^ w8[b]
            equal = np.zeros(len(go), np.int64)
            for k in range(1, 9):
                equal += differ < X.U(1 << (64 - 8 * k)) if k < 8 else differ == 0
            size[go] += equal
            go = go[(equal == 8) & (size[go] < most)]
        size = np.minimum(size, most)
        prefix[i] = size
        carry = size
    return prefix[order]


def find(w8: np.ndarray, query: np.ndarray, sorted_at: np.ndarray) -> np.ndarray:
    """Binary search: for each query position, the place in ``sorted_at`` (positions in the order of
    their windows) of the first window not less than its own."""
    low, high = np.zeros(len(query), np.int64), np.full(len(query), len(sorted_at), np.int64)
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        mid = (low[open_] + high[open_]) // 2
        less = compare(w8, sorted_at[mid], query[open_]) < 0
        low[open_[less]] = mid[less] + 1
        high[open_[~less]] = mid[~less]


def compare(w8: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """-1, 0 or 1 for the windows of LENGTH bytes at positions a and b."""
    out = np.zeros(len(a), np.int8)
    left = np.arange(len(a))
    for k in [*range(0, LENGTH - 7, 8), LENGTH - 8]:
        x, y = w8[a[left] + k], w8[b[left] + k]
        out[left] = np.where(x < y, -1, (x > y).astype(np.int8))
        left = left[x == y]
        if not len(left):
            break
    return out


def shard_classes(buf: np.ndarray, start: int, end: int, window: np.ndarray):
    """(positions of windows in order, index of each class's first) of one shard of the text."""
    part = words8(buf[start:end])
    order = suffix_array(part)
    prefix = common_prefixes(part, order, LENGTH)
    use = window[start:end][order]
    # the prefix between kept neighbours is the least one between them
    group = np.cumsum(prefix < LENGTH)[use]
    at = order[use] + start
    new = np.ones(len(at), bool)
    new[1:] = group[1:] != group[:-1]
    return at, np.flatnonzero(new)


def least_owner(buf: np.ndarray, window: np.ndarray, owner: np.ndarray, cuts: list[int]) -> np.ndarray:
    """For every window position (where ``window``): the least owner of an equal window.

    ``cuts`` are the ends of the shards."""
    w8 = words8(buf)
    out = np.full(len(buf), E.LAST, np.int64)
    merged, low = np.zeros(0, np.int64), np.zeros(0, np.int64)
    members = []
    start = 0
    for end in cuts:
        at, first = shard_classes(buf, start, end, window)
        start = end
        if not len(at):
            continue
        lead = at[first]
        least = np.minimum.reduceat(owner[at], first)
        size = np.diff(np.append(first, len(at)))
        members.append((at, lead, size))
        if not len(merged):
            merged, low = lead, least
            continue
        place = find(w8, lead, merged)
        near = np.minimum(place, len(merged) - 1)
        same = (place < len(merged)) & (compare(w8, merged[near], lead) == 0)
        low[place[same]] = np.minimum(low[place[same]], least[same])
        merged = np.insert(merged, place[~same], lead[~same])
        low = np.insert(low, place[~same], least[~same])
    for at, lead, size in members:
        out[at] = np.repeat(low[find(w8, lead, merged)] if len(members) > 1 else low, size)
    return out


# --- anchors and runs --------------------------------------------------------

def window_anchors(part: np.ndarray) -> np.ndarray:
    """The least gram hash of each window."""
    g = X.mix(X.rolling(X.RND[part], GRAM))
    width, size = LENGTH - GRAM + 1, 1
    while 2 * size <= width:
        g = np.minimum(g[:-size], g[size:])
        size *= 2
    rest = width - size
    return np.minimum(g[:len(g) - rest], g[rest:]) if rest else g


def changes(values: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values."""
    return np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1]) if len(values) else np.zeros(0, np.int64)


def row_runs(batch: E.Batch):
    """(rows, first windows, window counts, anchor hashes) of all runs of a batch, in order."""
    n, off = len(batch.buf) - LENGTH + 1, batch.off
    ends = np.maximum(off[1:] - LENGTH + 1, off[:-1])  # the first place after each row's windows
    breaks = np.unique(np.concatenate([off[:-1], ends]))
    starts, values = [np.zeros(0, np.int64)], [np.zeros(0, X.U)]
    for a in range(0, n, SEGMENT):
        v = window_anchors(batch.buf[a:min(a + SEGMENT, n) + LENGTH - 1])
        new = np.ones(len(v), bool)
        np.not_equal(v[1:], v[:-1], out=new[1:])
        i, j = np.searchsorted(breaks, [a, a + len(v)])
        new[breaks[i:j] - a] = True
        c = np.flatnonzero(new)
        starts.append(c + a)
        values.append(v[c])
    start, value = np.concatenate(starts), np.concatenate(values)
    count = np.diff(np.append(start, max(n, 0)))
    row = np.searchsorted(off, start, "right") - 1
    inside = start < ends[row]
    row, start = row[inside], start[inside]
    # least hashes are small: mixed anew, they spread over all buckets
    return row, start - off[row], count[inside], X.mix(value[inside] + X.U(1))


def by_name(value: np.ndarray, bits: int):
    """(order, names in order): a name is the bucket's bits of a hash and the 32 that follow, as
    :class:`exchange.Shared` tells hashes apart; equal names stay as they come."""
    name = value >> X.U(32 - bits)
    width = len(value).bit_length()
    if bits + 32 + width > 64:
        order = np.argsort(name, kind="stable")
        return order, name[order]
    key = np.sort((name << X.U(width)) | np.arange(len(value), dtype=X.U))
    return (key & X.U((1 << width) - 1)).astype(np.int64), key >> X.U(width)


def named(names: np.ndarray):
    """(bucket, slice) of sorted names."""
    if not len(names):
        return
    cuts = changes(names >> X.U(32))
    top = (names[cuts] >> X.U(32)).astype(np.int64)
    for bucket, a, b in zip(top.tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(names)], strict=True):
        yield bucket, slice(a, b)


def held(name: np.ndarray, row: np.ndarray):
    """(place of each distinct name's first, whether several rows hold it) of sorted names, rows in order within each."""
    first = changes(name)
    last = first + np.diff(np.append(first, len(name))) - 1
    return first, row[first] != row[last]


def question_of(name: np.ndarray, several: np.ndarray, large: np.ndarray, size: np.ndarray):
    """(bucket, payload) for each bucket of the sorted distinct names: those that several rows of the
    batch hold, the others, and which are large, with their sizes."""
    places = np.flatnonzero(large)
    for bucket, cut in named(name):
        low, own = name[cut].astype(np.uint32), several[cut]
        i, j = np.searchsorted(places, [cut.start, cut.stop])
        yield bucket, E.join_parts([E.pack(low[own]), E.pack(low[~own]), E.pack(name[places[i:j]].astype(np.uint32)), E.planes(size[places[i:j]])])


def shared_names(payloads: list[bytes], hot_bytes: float):
    """For each payload of a bucket: its names that other rows hold too, and those of them that are hot."""
    parts = [[E.unpack(x, np.uint32) for x in E.split_parts(p)[:3]] for p in payloads]
    every = np.sort(np.concatenate([x for known, single, _ in parts for x in (known, single)]))
    known = np.sort(np.concatenate([x[0] for x in parts]))
    first = changes(every)
    heat = np.diff(np.append(first, len(every))) * PLAIN
    every = every[first]
    both = (heat > PLAIN) | E.member(every, known)
    sizes = [E.unplanes(E.split_parts(p)[3], np.int64) for p in payloads]
    np.add.at(heat, np.searchsorted(every, np.concatenate([x[2] for x in parts])), np.concatenate(sizes) - PLAIN)
    shared, hot = every[both], every[heat > hot_bytes]
    for known, single, _ in parts:
        own = np.sort(np.concatenate([known, single]))
        own = own[E.member(own, shared)]
        yield own, own[E.member(own, hot)]


def run_bytes(batch: E.Batch, first: np.ndarray, begin: np.ndarray, size: np.ndarray):
    """Bytes of the distinct run texts of each name; ``first`` has the places of the names' firsts
    among all texts, which are given by ``begin`` and ``size``."""
    runs = np.diff(np.append(first, len(begin)))
    total = size[first]
    many = np.flatnonzero(runs > 1)
    total[many] = 0
    own = spread(first[many], runs[many])
    raw = batch.buf.tobytes()
    seen: set[bytes] = set()
    new = np.zeros(len(own), bool)
    for i, (a, b) in enumerate(zip(begin[own].tolist(), (begin[own] + size[own]).tolist(), strict=True)):
        text = raw[a:b]
        if text not in seen:
            seen.add(text)
            new[i] = True
    np.add.at(total, np.repeat(many, runs[many])[new], size[own][new])
    return total


def single_windows(batch: E.Batch, row, start, count):
    """(rows, starts, hashes of all bytes) of the windows of the given runs, which are in order."""
    at = spread(batch.off[row] + start, count)
    values = [np.zeros(0, X.U)]
    for a in range(0, len(batch.buf), SEGMENT):
        i, j = np.searchsorted(at, [a, a + SEGMENT])
        if i < j:
            values.append(X.mix(X.rolling(X.RND[batch.buf[a:a + SEGMENT + LENGTH - 1]], LENGTH)[at[i:j] - a]))
    row = np.repeat(row, count)
    return row, at - batch.off[row], np.concatenate(values)


def part_edges(low: np.ndarray, part_bits: int) -> list[int]:
    """Where each part of a bucket's sorted anchors begins, and the end."""
    firsts = np.arange(1, 1 << part_bits, dtype=np.int64) << (32 - part_bits)
    return [0, *np.searchsorted(low, firsts.astype(np.uint32)).tolist(), len(low)]


class Runs:
    """The runs that a batch has sent to a bucket."""

    def __init__(self, payload: bytes, part_bits: int):
        body, size, which, low, row, start, owner = E.split_parts(payload)
        self.body, self.size = E.split_parts(body), E.unplanes(size, np.int64)
        self.which, self.low = E.unplanes(which, np.uint32), E.unpack(low, np.uint32)
        self.row, self.start, self.owner = E.unplanes(row, np.uint32), E.unplanes(start, np.int64), E.unplanes(owner, np.int64)
        self.edges = part_edges(self.low, part_bits)

    def part(self, part: int):
        """(texts, text of each run, anchors, rows, first windows, owners) of one part."""
        a, b = self.edges[part:part + 2]
        which = self.which[a:b]
        if a == b:
            return [], which, self.low[a:b], self.row[a:b], self.start[a:b], self.owner[a:b]
        first, last = int(which.min()), int(which.max()) + 1
        raw = zstandard.ZstdDecompressor().decompress(self.body[part])
        ends = np.cumsum(self.size[first:last])
        texts = [raw[x:y] for x, y in zip((ends - self.size[first:last]).tolist(), ends.tolist(), strict=True)]
        return texts, which - first, self.low[a:b], self.row[a:b], self.start[a:b], self.owner[a:b]


def judge_part(parts: list[tuple]):
    """(place, (rows, first bytes, lengths)) of the bytes that each of the batches loses, if any.

    A text alone with its anchor has equal windows only in its own copies.  Texts that share their
    anchor with others go into suffix arrays, an anchor's together, as many anchors as a shard holds."""
    ids: dict[bytes, int] = {}
    name = np.concatenate([np.array([ids.setdefault(t, len(ids)) for t in x[0]], np.int64)[x[1]] for x in parts])
    if not len(name):
        return
    low, row, start, owner = (np.concatenate([x[i] for x in parts]) for i in (2, 3, 4, 5))
    place = np.repeat(np.arange(len(parts)), [len(x[1]) for x in parts])
    texts = list(ids)
    del ids
    anchor = np.zeros(len(texts), np.uint32)
    anchor[name] = low
    least = np.full(len(texts), E.LAST, np.int64)
    np.minimum.at(least, name, owner)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    lowest, highest = least.copy(), least.copy()
    order = np.argsort(anchor, kind="stable")
    first = changes(anchor[order])
    own = order[np.repeat(np.diff(np.append(first, len(order))) > 1, np.diff(np.append(first, len(order))))]
    begins, windows = np.zeros(len(texts), np.int64), [np.zeros(0, np.int64)]
    total = np.append(0, np.cumsum(sizes[own]))
    groups = np.append(changes(anchor[own]), len(own))
    base = 0
    for a, b in X.slices(total[groups], SHARD):
        some = own[groups[a]:groups[b]]
        buf = np.frombuffer(b"".join([texts[i] for i in some.tolist()]), np.uint8)
        ends = np.cumsum(sizes[some])
        count = sizes[some] - LENGTH + 1
        at = spread(ends - sizes[some], count)
        window = np.zeros(len(buf), bool)
        window[at] = True
        cuts = [int(ends[e - 1]) for _, e in X.slices(np.append(0, ends), SHARD)]
        lows = least_owner(buf, window, np.repeat(least[some], sizes[some]), cuts)[at]
        begin = np.cumsum(count) - count
        lowest[some], highest[some] = np.minimum.reduceat(lows, begin), np.maximum.reduceat(lows, begin)
        begins[some] = begin + base
        base += len(lows)
        windows.append(lows)
    windows = np.concatenate(windows)
    # most copies lose all of a run or nothing; only the others are looked at window by window
    whole = np.flatnonzero(owner > highest[name])
    some = np.flatnonzero((owner > lowest[name]) & (owner <= highest[name]))
    n = sizes[name[some]] - LENGTH + 1
    which = np.repeat(np.arange(len(some)), n)
    gone = windows[spread(begins[name[some]], n)] < owner[some][which]
    edge, last = gone.copy(), gone.copy()
    edge[1:] &= ~gone[:-1] | (which[1:] != which[:-1])
    last[:-1] &= ~gone[1:] | (which[1:] != which[:-1])
    a, b = np.flatnonzero(edge), np.flatnonzero(last)
    r = some[which[a]]
    run = np.concatenate([whole, r])
    begin = np.concatenate([start[whole], start[r] + a - (np.cumsum(n) - n)[which[a]]])
    length = np.concatenate([sizes[name[whole]], b - a + LENGTH])
    order = np.argsort(run, kind="stable")
    run, begin, length = run[order], begin[order], length[order]
    first = changes(place[run])
    for i, j in zip(first.tolist(), [*first[1:].tolist(), len(run)], strict=True) if len(run) else ():
        yield int(place[run[i]]), (row[run[i:j]], begin[i:j], length[i:j])


def remove_repeats(docs: DataFrame, key: str = "doc_id", column: str = "text", keep: tuple[str, ...] = (),
                   as_text: bool = False, hot_bytes: int = HOT) -> DataFrame:
    """``key``, the columns of ``keep``, n_bytes, n_removed, spans (removed byte ranges), kept (the
    remaining bytes, or with ``as_text`` a string without the characters that a cut has broken).

    Matches never cross rows and are judged on the input.  Rows of equal key
    do not remove each other's bytes; a null key comes after all others.  Null
    or empty text: 0 bytes, no span.  Very long texts are hashed in segments.
    Further columns are ignored; an empty table gives an empty result."""
    batches = E.make_batches(docs, key, column, keep, size=BATCH)
    total = E.text_bytes(batches)
    bits = E.bits_for(total, BUCKET, E.LEAST_BITS)
    part_bits = E.bits_for(total, PART, bits) - bits
    shared = E.Shared(bits)

    def question(batch):
        row, start, count, value = row_runs(batch)
        order, name = by_name(value, bits)
        first, several = held(name, row[order])
        size = run_bytes(batch, first, (batch.off[row] + start)[order], count[order] + LENGTH - 1)
        yield from question_of(name[first], several, size > PLAIN, size)

    def answer(bucket, payloads):
        """To each batch: its shared anchors and the hot ones among them; a note where any is hot."""
        found = list(shared_names(payloads, hot_bytes))
        out = [E.join_parts([E.pack(own), E.pack(hot)]) if len(own) else None for own, hot in found]
        return [*out, b""] if any(len(hot) for _, hot in found) else out

    def parted(batch):
        """The answers about anchors, those about hot anchors and those about single windows."""
        about = {b: E.split_parts(a) for b, a in batch.answers.items() if b < 1 << bits}
        return ({b: a for b, (a, _) in about.items()}, {b: a for b, (_, a) in about.items()},
                {b - (1 << bits): a for b, a in batch.answers.items() if b >= 1 << bits})

    def question_windows(batch):
        _, about, _ = parted(batch)
        if not any(len(E.unpack(a, np.uint32)) for a in about.values()):
            return
        row, start, count, value = row_runs(batch)
        hot = shared.flags(value, about)
        row, _, value = single_windows(batch, row[hot], start[hot], count[hot])
        order, name = by_name(value, bits)
        first, several = held(name, row[order])
        yield from question_of(name[first], several, np.zeros(len(first), bool), np.zeros(len(first), np.int64))

    def answer_windows(bucket, payloads):
        return [E.pack(own) if len(own) else None for own, _ in shared_names(payloads, np.inf)]

    replies = E.stage(E.replies(batches, question, answer))
    anchored = E.told(batches, E.gathered(replies))
    if replies.where("batch_id = -1").first() is not None:
        windows = E.replies(anchored, question_windows, answer_windows)
        windows = windows.select("batch_id", (F.col("bucket") + (1 << bits)).cast("int").alias("bucket"), "answer")
        anchored = E.told(batches, E.gathered(replies.unionByName(windows)))

    def runs(batch):
        row, start, count, value = row_runs(batch)
        about, hot, windows = parted(batch)
        order, name = by_name(value, bits)
        row, start, count, value = row[order], start[order], count[order], value[order]
        hot = shared.flags(value, hot)
        take = shared.flags(value, about) & ~hot
        if hot.any():
            back = np.flatnonzero(hot)[np.argsort(order[hot])]
            r, at, v = single_windows(batch, row[back], start[back], count[back])
            common = shared.flags(v, windows)
            row, start, value = (np.concatenate([x[take], y[common]]) for x, y in ((row, r), (start, at), (value, v)))
            count = np.concatenate([count[take], np.ones(int(common.sum()), np.int64)])
            order, name = by_name(value, bits)
            row, start, count = row[order], start[order], count[order]
        else:
            row, start, count, name = row[take], start[take], count[take], name[take]
        raw = batch.buf.tobytes()
        begin = batch.off[row] + start
        end = begin + count + LENGTH - 1
        owner = batch.order[row]
        for bucket, cut in named(name):
            texts: dict[bytes, int] = {}
            which = [texts.setdefault(raw[a:b], len(texts)) for a, b in zip(begin[cut].tolist(), end[cut].tolist(), strict=True)]
            which, low, texts = np.array(which, np.uint32), name[cut].astype(np.uint32), list(texts)
            edges = part_edges(low, part_bits)
            ends = [int(which[:i].max()) + 1 if i else 0 for i in edges]
            body = [zstandard.ZstdCompressor(level=3).compress(b"".join(texts[a:b])) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield bucket, E.join_parts([
                E.join_parts(body), E.planes(np.fromiter(map(len, texts), np.int64, len(texts))), E.planes(which), E.pack(low),
                E.planes(row[cut].astype(np.uint32)), E.planes(start[cut].astype(np.int64)), E.planes(owner[cut])])

    def judge(bucket, payloads):
        opened = [Runs(p, part_bits) for p in payloads]
        spans = [[] for _ in payloads]
        for part in range(1 << part_bits):  # texts of one anchor are in one part
            for place, found in judge_part([x.part(part) for x in opened]):
                spans[place].append(found)
        return [E.join_parts([E.planes(np.concatenate(x)) for x in zip(*s, strict=True)]) if s else None for s in spans]

    found = E.told(batches, E.ask(anchored, runs, judge))
    fields = [T.StructField(key, T.LongType(), True), *(T.StructField(c, docs.schema[c].dataType, True) for c in keep),
              *T.StructType.fromDDL(OUTPUT + (" string" if as_text else " binary")).fields]
    names = [f.name for f in fields]

    def cut(record_batches):
        for batch in E.batches_of(record_batches):
            found = [E.split_parts(a) for a in batch.answers.values()]
            row, at, length = (np.concatenate([np.zeros(0, kind), *(E.unplanes(x[i], kind) for x in found)])
                               for i, kind in enumerate((np.uint32, np.int64, np.int64)))
            at += batch.off[row]
            yield _cut_rows(batch, *joined(at, at + length, row), names, as_text)

    return found.mapInArrow(tidied(cut), T.StructType(fields))


def spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[i], start[i]+1, ... for count[i] values each."""
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


def joined(start: np.ndarray, end: np.ndarray, row: np.ndarray):
    """(starts, ends, rows) of the spans in order, those of a row that meet or overlap made one."""
    order = np.argsort(start)
    start, row, reach = start[order], row[order], np.maximum.accumulate(end[order])
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] > reach[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    return start[first], reach[first + np.diff(np.append(first, len(start))) - 1], row[first]


def _cut_rows(batch, start, end, row, names, as_text):
    n, off = len(batch.keys), batch.off
    spans = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(row, np.arange(n + 1)), pa.int32()),
        pa.StructArray.from_arrays([pa.array(start - off[row]), pa.array(end - off[row])], names=["start", "end"]))
    step = np.zeros(len(batch.buf) + 1, np.int8)  # spans are apart, but for the ends of rows
    step[start] = 1
    np.subtract.at(step, end, 1)
    raw = batch.buf[np.cumsum(step[:-1], dtype=np.int8) == 0]
    size = np.diff(off)
    removed = np.bincount(row, end - start, n).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(size - removed)])
    if as_text:
        raw = raw.tobytes()
        kept = pa.array([raw[x:y].decode("utf-8", "ignore") for x, y in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], pa.string())
    else:
        kept = pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(raw)])
    return pa.RecordBatch.from_arrays(
        [pa.array(batch.keys, pa.int64()), *batch.kept(), pa.array(size), pa.array(removed), spans, kept], names=names)
