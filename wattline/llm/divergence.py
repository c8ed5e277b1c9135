"""Divergence of sources from one another, by Arrow compute over partial counts.

Inside ``mapInArrow`` a batch's texts are lower-cased, split at separators,
dictionary-encoded and counted by hash grouping; a task merges its batches'
counts and passes on (lang, source, term) sums.  Those meet by (lang, shard
of terms), where the terms that enough documents hold are kept as columnar
shards: one row for each source, with its terms and counts.  A shard then
lays its kept terms out as a matrix of sources by terms and passes on one
row for each source: how far it lies from every other one over these terms,
and its foremost terms.  The sums of all shards are the divergences.  All
arithmetic is on integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm import shipped, tidy
from wattline.llm import text as X
from wattline.llm.exchange import stage

SEPARATORS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"  # all ASCII but letters
SLICE = 4 << 20     # bytes of text counted at once (one text at least)
MERGE = 1 << 19     # counts gathered before they are merged
HELD = 1 << 20      # merged counts that a task holds before it passes them on
CELLS = 1 << 21     # cells of a matrix of sources by terms

COUNTS = "lang string, source string, term string, n long, df long"
SHARD = "lang string, shard int, source string, terms array<string>, counts array<long>"
FOUND = "lang string, source string, others array<string>, apart array<long>, terms array<string>, gains array<long>"
RANKED = "lang string, source string, part string, item string, value long, rank int"


def count_terms(lang: pa.Array, source: pa.Array, text: pa.Array) -> pa.Table:
    """Occurrences and documents of each (lang, source, term).  The term ''
    stands for the group itself, so that groups without terms are known."""
    groups = pa.table({"lang": lang, "source": source, "doc": pa.array(np.arange(len(text)))})
    pairs = groups.group_by(["lang", "source"], use_threads=False).aggregate([("doc", "list")])
    docs = pairs["doc_list"].combine_chunks()
    group_of = np.empty(len(text), np.int64)
    group_of[docs.flatten().to_numpy()] = pc.list_parent_indices(docs).to_numpy()
    words = pc.split_pattern_regex(pc.ascii_lower(text), pattern=SEPARATORS)
    flat, doc = words.flatten(), pc.list_parent_indices(words)
    real = pc.greater(pc.binary_length(flat), 0)
    coded = flat.filter(real).dictionary_encode()
    counts = pa.table({"doc": doc.filter(real), "term": coded.indices})
    counts = counts.group_by(["doc", "term"], use_threads=False).aggregate([([], "count_all")])
    counts = counts.append_column("group", pa.array(group_of[counts["doc"].to_numpy()]))
    counts = counts.group_by(["group", "term"], use_threads=False).aggregate([("count_all", "sum"), ("count_all", "count")])
    none = pa.array(np.zeros(len(pairs), np.int64))
    return pa.concat_tables([
        pa.table({"lang": pairs["lang"].take(counts["group"]), "source": pairs["source"].take(counts["group"]),
                  "term": coded.dictionary.take(counts["term"]), "n": counts["count_all_sum"], "df": counts["count_all_count"]}),
        pa.table({"lang": pairs["lang"], "source": pairs["source"], "term": pa.array([""] * len(pairs), pa.string()), "n": none, "df": none})])


def merged(tables: list[pa.Table]) -> pa.Table:
    """Sums of several tables of counts."""
    out = pa.concat_tables(tables).group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("df", "sum")])
    return out.rename_columns(["lang", "source", "term", "n", "df"])


def _partial_counts(batches):
    held, rows, old = [], 0, 0
    for batch in batches:
        lang, source, text = (batch.column(i) for i in range(3))
        _, off = X.utf8(text)
        for a, b in X.slices(off, SLICE):
            held.append(count_terms(*(c.slice(a, b - a) for c in (lang, source, text))))
            rows += held[-1].num_rows
            if rows >= old + MERGE:
                held = [merged(held)]
                rows = old = held[0].num_rows
                if rows >= HELD:
                    yield from held[0].to_batches(max_chunksize=1 << 16)
                    held, rows, old = [], 0, 0
    if held:
        yield from merged(held).to_batches(max_chunksize=1 << 16)
    tidy()


def _table(schema: str, columns) -> pa.Table:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64())}
    fields = [f.split() for f in schema.split(", ")]
    return pa.table({name: pa.array(c, kinds[kind]) for (name, kind), c in zip(fields, columns, strict=True)})


def _keep_terms(least: int):
    def run(key, group):
        """One shard of a language: its kept terms and their counts, for each source and (source null) in all."""
        t = group.combine_chunks()
        per_term = t.group_by(["term"], use_threads=False).aggregate([("n", "sum"), ("df", "sum")])
        kept = per_term.filter(pc.greater_equal(per_term["df_sum"], least))
        inside = t.filter(pc.is_in(t["term"], value_set=kept["term"].combine_chunks()))
        rows = inside.group_by(["source"], use_threads=False).aggregate([("term", "list"), ("n", "list")])
        bare = pc.unique(t.filter(pc.equal(t["term"], ""))["source"])
        bare = bare.filter(pc.invert(pc.is_in(bare, value_set=rows["source"].combine_chunks())))
        source = rows["source"].to_pylist() + bare.to_pylist() + [None]
        terms = rows["term_list"].to_pylist() + [[]] * len(bare) + [kept["term"].to_pylist()]
        counts = rows["n_list"].to_pylist() + [[]] * len(bare) + [kept["n_sum"].to_pylist()]
        return _table(SHARD, [[key[0].as_py()] * len(source), [key[1].as_py()] * len(source), source, terms, counts])
    return run


def shares(count: np.ndarray, total: np.ndarray | int, terms: int) -> np.ndarray:
    """1 + floor(10**9 * (count + 5) / (total + 5 * terms)), three digits at a time so that nothing overflows."""
    below = np.asarray(total, np.int64) + 5 * terms
    rest = np.asarray(count, np.int64) + 5
    out, rest = np.divmod(rest, below)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, below)
        out = out * 1000 + digits
    return out + 1


def _compare(top: int, bare_shard: int):
    def run(key, shard, totals):
        """Over one shard, for each source: its distances from the language's others and its foremost terms.
        The shard of the term '' also names the others, in order."""
        lang, number = key[0].as_py(), key[1].as_py()
        n_of = dict(zip(totals["name"].to_pylist(), totals["total"].to_pylist(), strict=True))
        terms_in_all = max(totals["kept"].to_pylist(), default=0)
        names = sorted((s for s in n_of if s is not None), key=str.encode)
        place = {s: i for i, s in enumerate(names)}
        rows = shard.to_pydict()
        whole = rows["source"].index(None) if None in rows["source"] else -1
        vocabulary = rows["terms"][whole] if whole >= 0 else []
        if not vocabulary and number != bare_shard:
            return _table(FOUND, [[]] * 6)
        column = {t: i for i, t in enumerate(vocabulary)}
        where = [(place[s], np.fromiter(map(column.__getitem__, t), np.int64, len(t)), np.array(c, np.int64))
                 for s, t, c in zip(rows["source"], rows["terms"], rows["counts"], strict=True) if s is not None and t]
        total = np.array([n_of[s] for s in names], np.int64)
        apart = np.zeros((len(names), len(names)), np.int64)
        best = [[] for _ in names]
        width = max(1, CELLS // max(1, len(names)))
        for a in range(0, len(vocabulary), width):
            b = min(a + width, len(vocabulary))
            count = np.zeros((len(names), b - a), np.int64)
            for i, at, c in where:
                here = (at >= a) & (at < b)
                count[i, at[here] - a] = c[here]
            p = shares(count, total[:, None], terms_in_all)
            q = shares(np.array(rows["counts"][whole][a:b], np.int64), n_of[None], terms_in_all)
            for i in range(len(names)):
                apart[i] += np.abs(p - p[i]).sum(axis=1)
                gain = np.where(count[i] > 0, p[i] - q, 0)
                up = np.flatnonzero(gain > 0)
                if len(up) > top:  # ties of the last place stay, the rank decides between them
                    up = up[gain[up] >= np.partition(gain[up], len(up) - top)[len(up) - top]]
                best[i] = foremost(best[i] + [(int(gain[j]), vocabulary[a + j]) for j in up.tolist()], top)
        others = [names if number == bare_shard else None] * len(names)
        return _table(FOUND, [[lang] * len(names), names, others, apart.tolist(), [[t for _, t in f] for f in best], [[v for v, _ in f] for f in best]])
    return run


def foremost(found: list[tuple[int, str]], most: int | None = None) -> list[tuple[int, str]]:
    """The highest values, ties by the item's bytes."""
    return sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]


def _rank(top: int):
    def run(key, group):
        """A source's rows of all shards, added up and ranked."""
        lang, source = key[0].as_py(), key[1].as_py()
        others = next(o for o in group["others"].to_pylist() if o is not None)
        apart = group["apart"].combine_chunks().flatten().to_numpy().reshape(-1, len(others)).sum(axis=0).tolist()
        pairs = foremost([(v, o) for v, o in zip(apart, others, strict=True) if o != source])
        gains, terms = (group[c].combine_chunks().flatten().to_pylist() for c in ("gains", "terms"))
        terms = foremost(list(zip(gains, terms, strict=True)), top)
        n, m = len(pairs), len(terms)
        value, item = zip(*pairs, *terms, strict=True) if n + m else ((), ())
        return _table(RANKED, [[lang] * (n + m), [source] * (n + m), ["pair"] * n + ["term"] * m, item, value, [*range(1, n + 1), *range(1, m + 1)]])
    return run


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = 30,
          top: int = 50, shards: int | None = None) -> DataFrame:
    """lang, source, part, item, value, rank.

    Part ``pair``: each other source of the language, by how far the two
    distributions over the language's kept terms (those of ``least``
    documents at least) lie apart; all ranks.  Part ``term``: the ``top``
    kept terms that the source holds more of than its language does.

    Null text, lang and source count as ''.  A group without terms has the
    smoothed shares of zero counts; a language without kept terms gives
    pairs of value 0; one with a single source gives no pairs.  Repeated rows
    count each, ties go by the item's bytes, an empty table gives no rows.
    Further columns are ignored, whatever their names.  ``shards`` (by
    default the session's shuffle partitions) parts the terms."""
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    given = shipped(docs).select(*(F.coalesce(docs[c].cast("string"), F.lit("")).alias(n)
                                   for c, n in ((lang, "lang"), (source, "source"), (text, "text"))))
    shard_of = lambda c: F.pmod(F.xxhash64(c), F.lit(shards)).cast("int")
    counts = given.mapInArrow(_partial_counts, COUNTS).withColumn("shard", shard_of(F.col("term"))).repartition("lang", "shard")
    # on the same shuffle: a shard's task sees each (source, term) once, however many tasks have counted it
    counts = counts.groupBy("lang", "shard", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    kept = stage(counts.groupBy("lang", "shard").applyInArrow(_keep_terms(least), SHARD))
    totals = kept.groupBy("lang", "source").agg(
        F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)).alias("total"),
        F.sum(F.when(F.col("source").isNull(), F.size("terms")).otherwise(0)).cast("long").alias("kept"))
    totals = totals.select(F.col("lang").alias("of"), F.col("source").alias("name"), "total", "kept",
                           F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("at"))
    bare_shard = spark.range(1).select(shard_of(F.lit("")).alias("s")).first()["s"]
    found = kept.groupBy("lang", "shard").cogroup(totals.groupBy("of", "at")).applyInArrow(_compare(top, bare_shard), FOUND)
    return found.groupBy("lang", "source").applyInArrow(_rank(top), RANKED)
