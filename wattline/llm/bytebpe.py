"""Byte-level BPE encoding and decoding.

Long texts are cut into overlapping chunks, which Spark deals over its tasks
and which are pre-tokenised apart.  A pre-token depends on what follows its
start alone, so two tokenisations that share one boundary agree from there
on: neighbouring chunks are stitched at the first boundary that both have in
their overlap.  Where they have none (a run longer than the overlap),
matching goes on from the last sure boundary until it meets the next chunk's.
Then the pieces between the boundaries are encoded, each by itself.  Decoding
concatenates the tokens' bytes.
"""

from __future__ import annotations

import base64
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.llm import shipped, tidy
from wattline.llm import text as X

CHUNK = 1 << 16    # code points of a chunk
OVERLAP = 1 << 10  # code points that a chunk shares with the next one
AHEAD = 4          # a match is sure if so many code points after its end were seen
STORE = 1 << 20    # ids of known pieces that a task keeps
SLICE = 4 << 20    # bytes of text encoded at once (one text at least)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def class_repairs(pattern: str) -> dict[int, int]:
    """Code points that ``regex`` and the tiktoken library class otherwise (their Unicode versions
    differ), each with a code point that both class as the latter does."""
    import regex
    import tiktoken

    classes = sorted(set(re.findall(r"\\p\{\w+\}|\\s", pattern)))
    every = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    text = "".join(map(chr, every))
    single = {bytes([i]): i for i in range(256)}
    theirs, ours = np.zeros(0x110000, np.int64), np.zeros(0x110000, np.int64)
    for i, c in enumerate(classes):
        probe = tiktoken.Encoding("probe", pat_str=c, mergeable_ranks=single, special_tokens={})
        held = probe.decode_bytes(probe.encode_ordinary(text)).decode()
        theirs[np.frombuffer(held.encode("utf-32-le"), np.uint32)] |= 1 << i
        ours[np.frombuffer("".join(regex.findall(c, text)).encode("utf-32-le"), np.uint32)] |= 1 << i
    known = np.array(every)
    agree = known[theirs[known] == ours[known]]
    kinds, first = np.unique(theirs[agree], return_index=True)
    sample = dict(zip(kinds.tolist(), agree[first].tolist(), strict=True))
    return {int(c): sample[int(theirs[c])] for c in known[theirs[known] != ours[known]]}


class Pretokeniser:
    """Boundaries of the pattern's matches, which cover a text without gaps."""

    def __init__(self, pattern: str, repairs: dict[int, int]):
        import regex
        self.pattern = regex.compile(pattern)
        self.repairs = repairs
        odd = sorted(repairs)
        spans = []
        for c in odd:
            if spans and spans[-1][1] == c - 1:
                spans[-1][1] = c
            else:
                spans.append([c, c])
        self.odd = re.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in spans) + "]").search if spans else None

    def pieces(self, text: str) -> list[str]:
        alike = self.same_classes(text)
        found = self.pattern.findall(alike)
        if alike is text:
            return found
        out, at = [], 0
        for piece in found:
            out.append(text[at:at + len(piece)])
            at += len(piece)
        return out

    def same_classes(self, text: str) -> str:
        """A text of the same length whose code points both libraries class alike."""
        return text if self.odd is None or text.isascii() or not self.odd(text) else text.translate(self.repairs)

    def match(self, text: str, at: int) -> int:
        """End of the match that starts at ``at`` of a text from :meth:`same_classes`."""
        return self.pattern.match(text, at).end()

    def ends(self, text: str) -> np.ndarray:
        got = self.pieces(text)
        return np.cumsum(np.fromiter(map(len, got), np.int64, len(got)))


class Pieces(dict):
    """Slot of each known piece; a new piece is encoded when it is first asked for."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import tiktoken
        super().__init__()
        self.encode_one = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.forget()

    def forget(self):
        self.clear()
        self.start, self.count, self.ids = array("q"), array("q"), array("i")

    def __missing__(self, piece: str) -> int:
        ids = self.encode_one(piece)
        slot = self[piece] = len(self.start)
        self.start.append(len(self.ids))
        self.count.append(len(ids))
        self.ids.extend(ids)
        return slot

    def encode(self, pieces: list[str], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each document) of documents of ``docs`` pieces each."""
        slots = np.fromiter(map(self.__getitem__, pieces), np.int64, len(pieces))
        count = np.array(self.count)[slots]
        ids = np.array(self.ids)[_spread(np.array(self.start)[slots], count)]
        if len(self.ids) > STORE:
            self.forget()
        total = np.concatenate([[0], np.cumsum(count)])
        return ids, np.diff(total[np.concatenate([[0], np.cumsum(docs)])])


def _spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, .. (count[0] of them), start[1], .."""
    ends = np.cumsum(count)
    return np.repeat(start - (ends - count), count) + np.arange(int(ends[-1]) if len(ends) else 0)


def _lists(values: np.ndarray, count: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]), pa.int32()), pa.array(values, pa.int32()))


def stitch(text: str, bounds: list[np.ndarray], match) -> np.ndarray:
    """Boundaries of the whole text from those of its chunks, in order.

    ``bounds[k]``: chunk k's start and the match ends that it is sure of,
    given that a match starts there.  The first chunk's are the text's; each
    next chunk's hold from the first boundary that it shares with what is
    known so far.  ``match(text, at)`` gives one match's end."""
    out, known = [], bounds[0]
    for later in bounds[1:]:
        both = np.intersect1d(known[np.searchsorted(known, later[0]):], later)
        if not len(both):  # a run beyond the overlap: go on, match by match, to a boundary of this chunk
            at, more, goal = int(known[-1]), [], set(later.tolist())
            while at <= later[-1] and at not in goal:
                at = match(text, at)
                more.append(at)
            known = np.concatenate([known, np.array(more, np.int64)])
            if at > later[-1]:
                continue
            both = [at]
        out.append(known[known < both[0]])
        known = later[later >= both[0]]
    return np.concatenate([*out, known])


def encode(docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", column: str = "text",
           keep: tuple[str, ...] = (), chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``key``, the columns of ``keep`` and ``ids`` (array of int) of every row.

    ``ranks``: a file of base64 tokens and ranks, one a line; ``pattern``:
    what its pre-tokens match (they cover any text).  No special tokens.
    Null and empty text have no ids.  Null keys and repeated rows stay rows of
    their own.  Texts beyond ``chunk`` code points are cut into chunks, dealt
    over the tasks and stitched; the ids do not depend on the cuts.  An empty
    table gives an empty result.  Further columns are ignored, whatever their
    names."""
    if not 0 < overlap <= chunk:
        raise ValueError("an overlap is longer than 0 and not longer than a chunk")
    names = [key, *keep]
    table, repairs = read_ranks(ranks), class_repairs(pattern)
    fields = [docs.schema[c] for c in names]
    ids = T.StructField("ids", T.ArrayType(T.IntegerType()))
    given = shipped(docs).select(*(docs[c].alias(f"_c{i}") for i, c in enumerate(names)), F.coalesce(docs[column], F.lit("")).alias("_text"),
                                 F.monotonically_increasing_id().alias("_row"))
    inner = T.StructType([T.StructField(f"_c{i}", f.dataType) for i, f in enumerate(fields)])

    def encode_short(batches):
        cut, known = Pretokeniser(pattern, repairs), Pieces(table, pattern)
        for batch in batches:
            column = batch.column(len(names))
            _, off = X.utf8(column)
            for a, b in X.slices(off, SLICE):
                pieces = [cut.pieces(t) for t in column.slice(a, b - a).to_pylist()]
                got, count = known.encode([p for t in pieces for p in t], np.array([len(t) for t in pieces]))
                yield pa.RecordBatch.from_arrays([batch.column(i).slice(a, b - a) for i in range(len(names))] + [_lists(got, count)],
                                                 names=[*inner.names, "ids"])
        tidy()

    def cut_long(batches):
        for batch in batches:
            row = batch.column(len(names) + 1)
            for i in range(batch.num_rows):
                text = batch.column(len(names))[i].as_py()
                starts = range(0, len(text), chunk)
                for part in range(0, len(starts), 16):
                    some = starts[part:part + 16]
                    again = pa.array([i] * len(some))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(j).take(again) for j in range(len(names))]
                        + [row.take(again), pa.array(some, pa.int64()), pa.array([s + chunk >= len(text) for s in some]),
                           pa.array([text[s:s + chunk + overlap] for s in some], pa.string())],
                        names=[*inner.names, "_row", "_start", "_last", "_text"])

    def pretokenise(batches):
        cut = Pretokeniser(pattern, repairs)
        for batch in batches:
            text, last = batch.column("_text").to_pylist(), batch.column("_last").to_pylist()
            sure = []
            for t, whole in zip(text, last, strict=True):
                ends = cut.ends(t)
                sure.append(ends if whole else ends[ends + AHEAD <= len(t)])
            body = [t if whole else t[:chunk] for t, whole in zip(text, last, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in [*inner.names, "_row", "_start"]]
                + [pa.array(body, pa.string()), _lists(np.concatenate(sure), np.array([len(e) for e in sure]))],
                names=[*inner.names, "_row", "_start", "_text", "_ends"])

    def encode_long(group: pa.Table) -> pa.Table:
        group = group.sort_by("_start")
        text = "".join(group["_text"].to_pylist())
        start = group["_start"].to_pylist()
        bounds = [np.concatenate([[s], s + group["_ends"][i].values.to_numpy()]) for i, s in enumerate(start)]
        cut = Pretokeniser(pattern, repairs)
        cuts = stitch(cut.same_classes(text), bounds, cut.match).tolist()
        known, parts = Pieces(table, pattern), []
        for a in range(0, len(cuts) - 1, 1 << 16):
            some = cuts[a:a + (1 << 16) + 1]
            pieces = [text[x:y] for x, y in zip(some, some[1:])]
            parts.append(known.encode(pieces, np.array([len(pieces)]))[0])
        got = np.concatenate(parts)
        return pa.table([group[c].slice(0, 1) for c in inner.names] + [_lists(got, np.array([len(got)]))], names=[*inner.names, "ids"])

    short = given.where(F.length("_text") <= chunk).drop("_row").mapInArrow(encode_short, T.StructType([*inner.fields, ids]))
    rest = T.StructType.fromDDL("_row long, _start long")
    cuts = given.where(F.length("_text") > chunk).mapInArrow(
        cut_long, T.StructType([*inner.fields, *rest.fields, *T.StructType.fromDDL("_last boolean, _text string").fields]))
    bounds = cuts.repartition("_row", "_start").mapInArrow(
        pretokenise, T.StructType([*inner.fields, *rest.fields, *T.StructType.fromDDL("_text string, _ends array<int>").fields]))
    long = bounds.groupBy("_row").applyInArrow(encode_long, T.StructType([*inner.fields, ids]))
    return short.unionAll(long).select(*(F.col(f"_c{i}").alias(c) for i, c in enumerate(names)), "ids")


def decode(encoded: DataFrame, ranks: str, column: str = "ids", out: str = "decoded") -> DataFrame:
    """The columns of ``encoded`` and ``out``: its ids' bytes, concatenated.

    Null and empty ids give no bytes; an id without a token raises."""
    table = read_ranks(ranks)
    token = [b""] * (max(table.values(), default=-1) + 1)
    for t, i in table.items():
        token[i] = t
    size = np.array([len(t) for t in token], np.int64)
    blob = np.frombuffer(b"".join(token), np.uint8)
    schema = T.StructType([f for f in encoded.schema.fields if f.name != out] + [T.StructField(out, T.BinaryType())])
    names = schema.names[:-1]

    def run(batches):
        start = np.cumsum(size) - size
        for batch in batches:
            column_ = batch.column(column)
            lists = column_.fill_null([]) if column_.null_count else column_
            ids, off = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            off = off - off[0]
            for a, b in X.slices(off, SLICE >> 1):
                some = ids[off[a]:off[b]]
                if len(some) and (some.min() < 0 or some.max() >= len(size) or not size[some].all()):
                    raise ValueError("an id without a token")
                spell = blob[_spread(start[some], size[some])]
                ends = np.concatenate([[0], np.cumsum(size[some])])[off[a:b + 1] - off[a]]
                column_out = pa.Array.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(spell)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(a, b - a) for c in names] + [column_out], names=schema.names)
        tidy()

    return encoded.select(*names).mapInArrow(run, schema)
