"""Near-duplicate documents by MinHash signatures and a multi-index Hamming join.

A document is the set of its distinct word shingles; equal sets are one class.
A class's signature has ``PLACES`` minimum hashes of 16 bits; the first
``CHUNKS * WIDTH`` are cut into chunks.  If two signatures differ in at most
``2 * CHUNKS - 1`` of those places, some chunk has at most one error
(pigeonhole), so each chunk is indexed once for each place that may be wrong:
keys that leave out one place.  All pairs under that distance share a key; of
the pairs of similarity 0.8 beyond it, all but about 4 in 10 million do too.

Every class is first compared with the member of least document key of each of
its keys: a pair within ``NEAR`` differing places is confirmed on the full
shingle sets.  Classes of keys whose members still lie in different components
get a sharper signature, ``BITS`` one-bit minimum hashes; the members of such a
key are compared in blocks, across components only, each pair under the first
key that it shares, and pairs within ``NEAR_BITS`` are confirmed as well.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.llm import exchange as E
from wattline.llm import text as X
from wattline.llm import tidied
from wattline.llm.components import components

CHUNKS, WIDTH = 11, 5
KEYS = CHUNKS * WIDTH
PLACES = 160
NEAR = 57       # differing places beyond which a candidate is no link: five deviations at similarity 0.8
BITS = 2048     # of the sharper signature; two texts of similarity s differ in (1 - s) / 2 of them
NEAR_BITS = 272  # five deviations over the mean at similarity 0.8
PACK = 8192     # classes in a stored pack
BLOCK = 1024    # members of a key compared at once
SLICE = 2 << 20

_RNG = np.random.default_rng(977)
MULTIPLY = _RNG.integers(1, 2**63, PLACES, dtype=np.int64).astype(X.U) * X.U(2) + X.U(1)
MULTIPLY_BITS = _RNG.integers(1, 2**63, BITS, dtype=np.int64).astype(X.U) * X.U(2) + X.U(1)
KEY = _RNG.integers(1, 2**63, (CHUNKS, WIDTH), dtype=np.int64).astype(X.U) * X.U(2) + X.U(1)

PROFILE = "row int, n_shingles long, cls long, signature binary"


def shingle_sets(buf: np.ndarray, off: np.ndarray, size: int):
    """(shingle hashes, sorted within each row; ends): rows' distinct shingles of ``size`` words,
    lower-cased; a shorter text's whole word sequence is its one shingle."""
    _, _, row, h, _ = X.words(buf, off, lower=True)
    n = len(off) - 1
    count = np.bincount(row, minlength=n)
    pos, gram = X.grams(h, row, size)
    grow = row[pos]
    brief = np.flatnonzero((count > 0) & (count < size))
    if len(brief):
        first = np.cumsum(count) - count
        value = []
        for i in brief.tolist():
            own = h[first[i]:first[i] + count[i]]
            value.append(X.mix(X.rolling(own, len(own)) + X.U(len(own)))[0])
        gram, grow = np.concatenate([gram, np.array(value, X.U)]), np.concatenate([grow, brief])
    order = np.lexsort((gram, grow))
    gram, grow = gram[order], grow[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (grow[1:] != grow[:-1])
    gram, grow = gram[new], grow[new]
    return gram, np.searchsorted(grow, np.arange(n + 1))


def signatures(gram: np.ndarray, ends: np.ndarray, places: int = PLACES) -> np.ndarray:
    """Minimum hashes (rows by places, uint16) of the non-empty rows."""
    start = ends[:-1][np.diff(ends) > 0]
    out = np.empty((len(start), places), np.uint16)
    if len(start):
        for k in range(places):
            least = np.minimum.reduceat(((gram * MULTIPLY[k]) >> X.U(32)).astype(np.uint32), start)
            out[:, k] = X.mix(least.astype(X.U)).astype(np.uint16)
    return out


def bit_signatures(gram: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One-bit minimum hashes (rows by BITS / 8 bytes) of the non-empty rows."""
    start = ends[:-1][np.diff(ends) > 0]
    out = np.empty((len(start), BITS), np.uint8)
    if len(start):
        for k in range(BITS):
            least = np.minimum.reduceat((gram * MULTIPLY_BITS[k]) >> X.U(32), start)
            out[:, k] = (X.mix(least) & X.U(1)).astype(np.uint8)
    return np.packbits(out, axis=1)


def index_keys(sig: np.ndarray) -> np.ndarray:
    """Keys (rows by KEYS): place k's key leaves out the k-th place and holds the rest of its chunk."""
    part = X.mix(sig[:, :KEYS].reshape(-1, CHUNKS, WIDTH).astype(X.U) + X.U(1)) * KEY
    out = part.sum(axis=2, keepdims=True, dtype=X.U) - part
    tag = X.mix(np.arange(1, KEYS + 1, dtype=X.U)).reshape(CHUNKS, WIDTH)
    return X.mix(out ^ tag).reshape(-1, KEYS)


def first_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The first key that each row of index signatures ``b`` shares with ``a``; KEYS if none."""
    wrong = (a[None, :KEYS] != b[:, :KEYS]).reshape(-1, CHUNKS, WIDTH)
    errors = wrong.sum(axis=2)
    chunk = (errors <= 1).argmax(axis=1)
    line = np.arange(len(b))
    place = np.where(errors[line, chunk] == 1, wrong[line, chunk].argmax(axis=1), 0)
    return np.where(errors[line, chunk] <= 1, chunk * WIDTH + place, KEYS)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * |a and b| >= percent * |a or b|, for sorted distinct arrays."""
    both = int(E.member(a, b).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def near_duplicates(docs: DataFrame, key: str = "doc_id", column: str = "text", shingle: int = 4,
                    percent: int = 80) -> DataFrame:
    """Per row: key, n_shingles, component_id (least key reachable by links), kept (has that key).

    Rows link where 100 * shared shingles >= ``percent`` * all shingles of the
    two.  Null or empty texts (no word) have no shingle and no link; their
    component is their own key.  Rows of null key take part as texts; where a
    component has no key at all, component_id is null and all its rows are kept.
    Repeated rows are one class.  Further columns are ignored; an empty table
    gives an empty result."""
    rows, final = _labelled(E.make_batches(docs, key, column), key, shingle, percent)
    out = rows.select(key, "n_shingles", "cls").join(final.select("cls", "component_id"), "cls", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col(key))
    return (out.select(key, "n_shingles", component.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.col("component_id").isNull())))


def one_of_each(docs: DataFrame, key: str = "doc_id", column: str = "text", shingle: int = 4, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component of near-duplicates, all its columns as they were.

    The row of least key stays, null keys after all others; of several rows of
    that key the first as stored, so repeated rows and rows that share a key
    leave one.  Rows without a word are linked with nothing and all stay.  An
    empty table gives an empty result."""
    names = docs.columns
    at = {c: f"c{i}" for i, c in enumerate(names)}
    held = docs.select(*(docs[c].alias(at[c]) for c in names), docs[column].isNull().alias("none"))
    rest = [c for c in names if c != column]
    batches = E.make_batches(held, at[key], at[column], keep=(*(at[c] for c in rest), "none"))
    rows, final = _labelled(batches, key, shingle, percent)
    chosen = (final.select("one.batch_id", "one.row").distinct()
              .unionByName(rows.where("n_shingles = 0").select("batch_id", "row")))
    places = chosen.groupBy("batch_id").agg(F.collect_list(F.struct(F.col("row").alias("bucket"), F.lit(b"").alias("answer"))).alias("answers"))

    def restore(record_batches):
        for batch in E.batches_of(record_batches):
            *kept, none = batch.kept()
            kept = dict(zip(rest, kept, strict=True))
            none = none.to_pylist()
            for a, b in X.slices(batch.off, SLICE):
                pick = [r for r in range(a, b) if r in batch.answers]
                text = [None if none[r] else batch.buf[batch.off[r]:batch.off[r + 1]].tobytes() for r in pick]
                take = pa.array(pick, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(text, pa.binary()).view(pa.string()) if c == column else kept[c].take(take) for c in names], names=names)

    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema])
    return batches.join(places, "batch_id").mapInArrow(tidied(restore), schema)


def _labelled(batches: DataFrame, key: str, shingle: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(rows with their address, n_shingles and class; classes with component_id and ``one``, the
    component's first row by key and address)."""
    def profile(record_batches):
        for batch in E.batches_of(record_batches):
            for a, b in X.slices(batch.off, SLICE):
                yield _profile(batch, a, b, shingle, key)

    kind = T.StructField(key, T.LongType(), True)
    address = T.StructField("batch_id", T.LongType(), True)
    rows = E.stage(batches.mapInArrow(tidied(profile), T.StructType([kind, address, *T.StructType.fromDDL(PROFILE).fields])))
    classes = E.stage(rows.where("n_shingles > 0").groupBy("cls")
                      .agg(F.min(key).alias("least_key"), F.min(F.struct(F.col(key).isNull().alias("keyless"), F.col(key).alias("least"), "batch_id", "row")).alias("at"),
                           F.first("n_shingles").alias("size"), F.first("signature").alias("signature")))
    keyed = _shared_keys(classes)
    heads = (keyed.groupBy("key").agg(F.min(F.struct("least_key", "cls"))["cls"].alias("head"), F.min("cls").alias("lo"), F.max("cls").alias("hi"))
             .where("lo != hi"))
    star = (keyed.join(heads.select("key", "head"), "key").where("cls != head")
            .select(F.col("head").alias("a"), F.col("cls").alias("b")).distinct())
    first = E.stage(_confirm(E.stage(_near(star, classes, percent)), classes, batches, shingle, percent))
    part = components(first)
    parts = classes.join(part, classes["cls"] == part["node"], "left").select("cls", "size", F.coalesce("label", "cls").alias("part"))
    rest = E.stage(_rest(keyed, E.stage(parts), classes, batches, shingle, percent))
    links = first.unionByName(_confirm(rest, classes, batches, shingle, percent))
    part = components(links)
    least = (classes.join(part, classes["cls"] == part["node"], "left")
             .select("cls", "least_key", "at", F.coalesce("label", "cls").alias("part")))
    whole = least.groupBy("part").agg(F.min("least_key").alias("component_id"), F.min("at").alias("one"))
    return rows, least.join(whole, "part").select("cls", "component_id", "one")


def _profile(batch, a, b, shingle, key):
    off = batch.off[a:b + 1] - batch.off[a]
    gram, ends = shingle_sets(batch.buf[batch.off[a]:batch.off[b]], off, shingle)
    size = np.diff(ends)
    held = np.flatnonzero(size)
    sig = signatures(gram, ends)
    cls, signature = np.zeros(b - a, np.int64), [None] * (b - a)
    if len(held):
        start = ends[:-1][held]
        total = np.add.reduceat(X.mix(gram), start)
        other = np.bitwise_xor.reduceat(X.mix(gram ^ X.U(0xA5A5A5A5A5A5A5A5)), start)
        cls[held] = X.mix(total ^ X.mix(other + size[held].astype(X.U))).view(np.int64)
        for i, s in zip(held.tolist(), sig, strict=True):
            signature[i] = s.tobytes()
    return pa.RecordBatch.from_arrays(
        [pa.array(batch.keys[a:b], pa.int64()), pa.array(np.full(b - a, batch.id)), pa.array(np.arange(a, b), pa.int32()),
         pa.array(size.astype(np.int64)), pa.array(cls), pa.array(signature, pa.binary())],
        names=[key, "batch_id", "row", "n_shingles", "cls", "signature"])


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, PLACES)


class _Pack:
    """Stored classes inside a task: cls, least document key and index keys."""

    def __init__(self, row: dict):
        self.id = row["batch_id"]
        self.cls, self.least = np.frombuffer(row["cls"], np.int64).reshape(2, -1)
        self.keys = index_keys(np.frombuffer(row["signature"], np.uint16).reshape(-1, PLACES)).ravel()
        self.answers = {a["bucket"]: a["answer"] for a in row.get("answers") or ()}


def _packs(record_batches):
    for rb in record_batches:
        for i in range(rb.num_rows):
            yield _Pack({n: rb.column(j)[i].as_py() for j, n in enumerate(rb.schema.names)})


def _shared_keys(classes: DataFrame) -> DataFrame:
    """(key, place, cls, least_key) for the keys that several classes have (and a few more)."""
    def store(record_batches):
        serial = TaskContext.get().partitionId() << 32
        for rb in record_batches:
            for a in range(0, rb.num_rows, PACK):
                p = rb.slice(a, PACK)
                cls = np.stack([p.column(c).to_numpy(zero_copy_only=False) for c in (0, 2)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([serial], pa.int64()), pa.array([p.num_rows * KEYS * 8], pa.int64()), pa.array([cls.tobytes()], pa.binary()),
                     pa.array([b"".join(p.column(1).to_pylist())], pa.binary())], names=["batch_id", "n_bytes", "cls", "signature"])
                serial += 1

    packs = E.stage(classes.select("cls", "signature", F.coalesce("least_key", F.lit(E.LAST)).alias("least_key")).mapInArrow(tidied(store), "batch_id long, n_bytes long, cls binary, signature binary"))
    shared = E.Shared(E.bucket_bits(packs))

    def question(pack):
        key, times = np.unique(pack.keys, return_counts=True)
        yield from shared.question(key[times > 1], key[times == 1], np.zeros(0, X.U))

    def give(record_batches):
        for pack in _packs(record_batches):
            hit = np.flatnonzero(shared.flags(pack.keys, pack.answers))
            yield pa.RecordBatch.from_arrays(
                [pa.array(pack.keys[hit].view(np.int64)), pa.array((hit % KEYS).astype(np.int32)), pa.array(pack.cls[hit // KEYS]),
                 pa.array(pack.least[hit // KEYS])], names=["key", "place", "cls", "least_key"])

    return E.stage(E.told(packs, E.ask(packs, question, shared.answer, _packs)).mapInArrow(tidied(give), "key long, place int, cls long, least_key long"))


def _near(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(a, b) of sizes that allow a link, whose signatures differ in at most NEAR places."""
    a, b = (classes.select(F.col("cls").alias(x), F.col("size").alias(f"n{x}"), F.col("signature").alias(f"s{x}")) for x in "ab")

    def run(record_batches):
        for rb in record_batches:
            for i in range(0, rb.num_rows, 4096):
                p = rb.slice(i, 4096)
                ok = pa.array((_matrix(p.column(2)) != _matrix(p.column(3))).sum(axis=1) <= NEAR)
                yield pa.RecordBatch.from_arrays([p.column(0).filter(ok), p.column(1).filter(ok)], names=["a", "b"])

    sized = pairs.join(b, "b").join(a, "a").where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    return sized.select("a", "b", "sa", "sb").mapInArrow(tidied(run), "a long, b long")


def _rest(keyed: DataFrame, parts: DataFrame, classes: DataFrame, batches: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Near pairs of different components among the members of each key that has several."""
    parted = keyed.join(parts, "cls")
    mixed = (parted.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.count("*").alias("n"))
             .where("lo != hi").select("key", F.ceil(F.col("n") / BLOCK).alias("blocks")))
    member = E.stage(parted.join(mixed, "key").select("key", "place", "blocks", "cls", "part", "size"))

    def sharpen(cls, gram, ends):
        index = signatures(gram, ends, KEYS)
        return [cls, pa.array([b.tobytes() for b in bit_signatures(gram, ends)], pa.binary()), pa.array([i.tobytes() for i in index], pa.binary())]

    sharp = E.stage(_fetch(member.select("cls").distinct(), classes, batches, shingle, sharpen, "cls long, bits binary, index binary"))
    spread = (member.withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")))
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
              .select("key", "place", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "cls", "part", "size"))

    def compare(group: pa.Table) -> pa.Table:
        i, j, place = (group[c][0].as_py() for c in ("i", "j", "place"))
        own, cls, part, size = (group[c].to_numpy() for c in ("own", "cls", "part", "size"))
        bits = np.frombuffer(b"".join(group["bits"].to_pylist()), np.uint64).reshape(-1, BITS // 64)
        index = np.frombuffer(b"".join(group["index"].to_pylist()), np.uint16).reshape(-1, KEYS)
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        a, b = [], []
        for x in left.tolist():
            y = right[(part[right] != part[x]) & (100 * np.minimum(size[right], size[x]) >= percent * np.maximum(size[right], size[x]))]
            if i == j:
                y = y[cls[y] > cls[x]]
            y = y[np.bitwise_count(bits[y] ^ bits[x]).sum(axis=1, dtype=np.int64) <= NEAR_BITS]
            if len(y):
                y = y[first_shared(index[x], index[y]) == place]  # under another key this pair has its turn
            a.append(np.full(len(y), cls[x]))
            b.append(cls[y])
        a, b = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (a, b))
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return spread.join(sharp, "cls").groupBy("key", "i", "j").applyInArrow(compare, "a long, b long").distinct()


def _fetch(wanted: DataFrame, classes: DataFrame, batches: DataFrame, shingle: int, make, schema: str) -> DataFrame:
    """What ``make(classes, shingle hashes, ends)`` gives for the wanted classes, from their stored texts."""
    places = (classes.join(wanted, "cls").select("cls", "at.batch_id", "at.row")
              .groupBy("batch_id").agg(F.collect_list(F.struct(F.col("row").alias("bucket"), F.col("cls").alias("answer"))).alias("answers")))
    names = [f.split()[0] for f in schema.split(", ")]

    def fetch(record_batches):
        for batch in E.batches_of(record_batches):
            at = np.array(sorted(batch.answers), np.int64)
            off = np.concatenate([[0], np.cumsum(batch.off[at + 1] - batch.off[at])])
            buf = np.concatenate([batch.buf[batch.off[r]:batch.off[r + 1]] for r in at.tolist()])
            for a, b in X.slices(off, SLICE):
                gram, ends = shingle_sets(buf[off[a]:off[b]], off[a:b + 1] - off[a], shingle)
                cls = pa.array([batch.answers[r] for r in at[a:b].tolist()], pa.int64())
                yield pa.RecordBatch.from_arrays(make(cls, gram, ends), names=names)

    return batches.join(places, "batch_id").mapInArrow(tidied(fetch), schema)


def _confirm(pairs: DataFrame, classes: DataFrame, batches: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""
    def pack(cls, gram, ends):
        return [cls, pa.array([E.pack(gram[x:y]) for x, y in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], pa.binary())]

    wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
    sets = E.stage(_fetch(wanted, classes, batches, shingle, pack, "cls long, members binary"))

    def check(record_batches):
        for rb in record_batches:
            known: dict[int, np.ndarray] = {}
            ok = []
            for a, x, y in zip(rb.column(0).to_pylist(), rb.column(2), rb.column(3), strict=True):
                if a not in known:
                    known = {a: E.unpack(x.as_py(), X.U)}
                ok.append(similar(known[a], E.unpack(y.as_py(), X.U), percent))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([rb.column(0).filter(keep), rb.column(1).filter(keep)], names=["a", "b"])

    full = (pairs.join(sets.select(F.col("cls").alias("b"), F.col("members").alias("sb")), "b")
            .join(sets.select(F.col("cls").alias("a"), F.col("members").alias("sa")), "a").select("a", "b", "sa", "sb"))
    return full.mapInArrow(tidied(check), "a long, b long")
