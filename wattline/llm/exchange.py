"""Batches of documents, and asking the whole corpus about their contents.

Texts are stored once as batches of a few megabytes (a written table).  A
question goes out as sorted hash arrays, split by hash into buckets; one task
per bucket sees what every batch holds of it and answers each batch; the
answers then meet the batch's texts again.  What a task gets is bounded: a
value occurs once per batch, however many documents hold it, and the number of
buckets follows the size of the corpus.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm import shipped, tidied, tidy
from wattline.llm import text as X
from wattline.session import checkpoint_dir

BATCH_BYTES = 4 << 20
BUCKET_BYTES = 4 << 20  # corpus bytes per bucket
LEAST_BITS = 8
LAST = np.iinfo(np.int64).max  # order of a null key: after all others

BATCH = "batch_id long, n_bytes long, keys array<long>, ends binary, blob binary, extra binary, note array<long>"


def stage(df: DataFrame) -> DataFrame:
    """``df`` written to the session's shared folder and read again."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/wattline-llm-{uuid.uuid4().hex}"
    df.write.option("parquet.block.size", 16 << 20).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def make_batches(docs: DataFrame, key: str, column: str, keep: tuple[str, ...] = (),
                 note: Callable | None = None, size: int | None = None) -> DataFrame:
    """Documents as stored batches of ``size`` bytes (default: ``BATCH_BYTES``), with the columns of
    ``keep``; a long document is a batch of its own.  ``note(keys, bytes, offsets)`` gives numbers
    stored with each batch."""
    size = size or BATCH_BYTES
    names = [f"_k{i}" for i in range(len(keep))]

    def run(record_batches):
        serial = TaskContext.get().partitionId() << 32
        for rb in record_batches:
            _, off = X.utf8(rb.column(1))
            for a, b in X.slices(off, size):
                yield _batch(serial, rb.slice(a, b - a), names, note)
                serial += 1

    source = shipped(docs).select(docs[key].cast("long").alias("_key"), docs[column].alias("_text"),
                                  *(docs[c].alias(n) for c, n in zip(keep, names, strict=True)))
    return stage(source.mapInArrow(tidied(run), BATCH))


def _batch(serial, rows: pa.RecordBatch, names: list[str], note: Callable | None = None):
    buf, off = X.utf8(rows.column(1))
    keys = rows.column(0).to_pylist()
    extra = None
    if names:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.select(names).schema) as out:
            out.write_batch(rows.select(names))
        extra = zstandard.ZstdCompressor(level=1).compress(sink.getvalue().to_pybytes())
    blob = zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(buf).data)
    return pa.RecordBatch.from_arrays(
        [pa.array([serial], pa.int64()), pa.array([int(off[-1])], pa.int64()), pa.array([keys], pa.list_(pa.int64())),
         pa.array([off[1:].tobytes()], pa.binary()), pa.array([blob], pa.binary()), pa.array([extra], pa.binary()),
         pa.array([note(keys, buf, off) if note else []], pa.list_(pa.int64()))],
        names=["batch_id", "n_bytes", "keys", "ends", "blob", "extra", "note"])


class Batch:
    """One stored batch inside a task."""

    def __init__(self, row: dict):
        self.id = row["batch_id"]
        self.keys = row["keys"]
        self.off = np.concatenate([[0], np.frombuffer(row["ends"], np.int64)])
        raw = zstandard.ZstdDecompressor().decompress(row["blob"], max_output_size=max(int(self.off[-1]), 1))
        self.buf = np.frombuffer(raw, np.uint8)
        self.order = np.array([LAST if k is None else k for k in self.keys], np.int64)
        self._extra = row["extra"]
        self.answers = {a["bucket"]: a["answer"] for a in row.get("answers") or ()}


    def kept(self) -> list[pa.Array]:
        """The columns of ``keep``."""
        if self._extra is None:
            return []
        table = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(self._extra)).read_all()
        return [c.combine_chunks() for c in table.columns]


def batches_of(record_batches) -> Iterator[Batch]:
    for rb in record_batches:
        for i in range(rb.num_rows):
            yield Batch({n: rb.column(j)[i].as_py() for j, n in enumerate(rb.schema.names)})


def text_bytes(batches: DataFrame) -> int:
    return batches.agg(F.sum("n_bytes")).first()[0] or 0


def bits_for(total: int, each: int, least: int) -> int:
    """Bits of a number that deals ``total`` bytes out by ``each``, ``least`` bits at least."""
    return max(least, math.ceil(math.log2(total / each))) if total else least


def bucket_bits(batches: DataFrame) -> int:
    """Bits of a bucket number, so that a bucket stands for ``BUCKET_BYTES`` of text."""
    return bits_for(text_bytes(batches), BUCKET_BYTES, LEAST_BITS)


def replies(batches: DataFrame, question: Callable, answer: Callable, read: Callable = None) -> DataFrame:
    """Rows (batch_id, bucket, answer) of a question to the whole corpus.

    ``question(Batch)`` yields (bucket, payload); ``answer(bucket, [payload])``
    gives one answer or None for each payload of a bucket, and may add one
    more, a note on the bucket itself, which gets batch_id -1.  ``read`` makes
    the objects with an ``id`` that ``question`` gets; default: document batches."""
    read = read or batches_of

    def send(record_batches):
        for batch in read(record_batches):
            rows = list(question(batch))
            if rows:
                b, p = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array([batch.id] * len(b), pa.int64()), pa.array(p, pa.binary())],
                                                 names=["bucket", "batch_id", "payload"])

    def reply(group: pa.Table) -> pa.Table:
        bucket, ids = group["bucket"][0].as_py(), [*group["batch_id"].to_pylist(), -1]
        got = answer(bucket, group["payload"].to_pylist())
        tidy()
        kept = [(i, a) for i, a in zip(ids, got, strict=False) if a is not None]
        return pa.table([pa.array([i for i, _ in kept], pa.int64()), pa.array([bucket] * len(kept), pa.int32()),
                         pa.array([a for _, a in kept], pa.binary())], names=["batch_id", "bucket", "answer"])

    sent = batches.mapInArrow(tidied(send), "bucket int, batch_id long, payload binary")
    return sent.groupBy("bucket").applyInArrow(reply, "batch_id long, bucket int, answer binary")


def gathered(rows: DataFrame) -> DataFrame:
    """Replies as one row per batch: (batch_id, answers)."""
    return rows.groupBy("batch_id").agg(F.collect_list(F.struct("bucket", "answer")).alias("answers"))


def ask(batches: DataFrame, question: Callable, answer: Callable, read: Callable = None) -> DataFrame:
    """Rows (batch_id, answers): what each batch learns."""
    return gathered(replies(batches, question, answer, read))


def told(batches: DataFrame, answers: DataFrame) -> DataFrame:
    """Batches with their answers."""
    return batches.join(answers, "batch_id", "left")


def pack(values: np.ndarray) -> bytes:
    """A sorted unsigned array as compressed differences, byte by byte plane."""
    diff = np.diff(values, prepend=values[:0].dtype.type(0)) if len(values) else values
    return planes(diff)


def unpack(data: bytes, dtype) -> np.ndarray:
    return np.cumsum(unplanes(data, dtype), dtype=dtype)


def planes(values: np.ndarray) -> bytes:
    width = values.dtype.itemsize
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(-1, width).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unplanes(data: bytes, dtype) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(data)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(dtype).ravel() if raw else np.zeros(0, dtype)


def join_parts(parts: list[bytes]) -> bytes:
    return np.array([len(parts), *map(len, parts)], np.int64).tobytes() + b"".join(parts)


def split_parts(data: bytes) -> list[bytes]:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    sizes = np.frombuffer(data, np.int64, n, 8)
    ends = np.cumsum(sizes) + 8 * (n + 1)
    return [data[e - s:e] for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]


def by_bucket(values: np.ndarray, bits: int):
    """(bucket, slice) of a sorted uint64 array, by its leading bits."""
    if not len(values):
        return
    top = (values >> X.U(64 - bits)).astype(np.int64)
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(top)) + 1, [len(values)]])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        yield int(top[a]), slice(a, b)


def short(values: np.ndarray, bits: int) -> np.ndarray:
    """The 32 bits that follow the bucket's."""
    return ((values >> X.U(32 - bits)) & X.U(0xFFFFFFFF)).astype(np.uint32)


def member(values: np.ndarray, within: np.ndarray) -> np.ndarray:
    """Whether each value occurs in a sorted array."""
    if not len(within):
        return np.zeros(len(values), bool)
    at = np.searchsorted(within, values)
    at[at == len(within)] = 0
    return within[at] == values


class Shared:
    """Which of the hashes that documents hold are held by other documents too.

    Hashes are compared by their leading bits (bucket and 32 more), so a few
    foreign ones pass; whoever uses the result must compare contents."""

    def __init__(self, bits: int):
        self.bits = bits

    def question(self, known: np.ndarray, anchor: np.ndarray, probe: np.ndarray):
        """Sorted distinct hashes: shared inside the batch already; anchors of one document; probes."""
        sets = [dict(by_bucket(x, self.bits)) for x in (known, anchor, probe)]
        for bucket in sorted(set().union(*sets)):
            yield bucket, join_parts([pack(np.unique(short(x[s[bucket]], self.bits))) if bucket in s else pack(np.zeros(0, np.uint32))
                                      for x, s in zip((known, anchor, probe), sets, strict=True)])

    @staticmethod
    def answer(bucket, payloads):
        held = [[unpack(p, np.uint32) for p in split_parts(x)] for x in payloads]
        known, anchor, probe = (np.concatenate(x) for x in zip(*held, strict=True))
        anchor, times = np.unique(anchor, return_counts=True)
        probe = np.unique(probe)
        known = np.unique(known)
        shared = np.unique(np.concatenate([known, anchor[(times > 1) | member(anchor, probe) | member(anchor, known)]]))
        out = []
        for own in held:
            own = np.sort(np.concatenate(own))
            own = own[member(own, shared)]
            out.append(pack(own) if len(own) else None)
        return out

    def flags(self, hashes: np.ndarray, answers: dict[int, bytes]) -> np.ndarray:
        """Which hashes are among the answers."""
        parts = [(np.uint64(b) << X.U(32)) | unpack(a, np.uint32).astype(X.U) for b, a in sorted(answers.items())]
        return member(hashes >> X.U(32 - self.bits), np.concatenate(parts) if parts else np.zeros(0, X.U))
