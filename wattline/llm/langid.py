"""Language identification by compression.

Each language gets a zstandard raw-content dictionary made of sample text.  A
text is compressed once with each dictionary and gets the language whose
output is smallest; a narrow margin between the two smallest is a rejection.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.llm import shipped, tidied

PIECE = 1024     # bytes compressed at once: the dictionary counts on each piece, so long texts are judged evenly
OTHER = re.compile(r"[\W\d_]+")


def letters_only(text: str) -> bytes:
    """Lower-case letters, everything between them one space."""
    return OTHER.sub(" ", text.lower()).strip().encode()


def held_out(key: str = "doc_id", folds: int = 3) -> F.Column:
    return F.coalesce(F.crc32(F.col(key).cast("string")) % folds == 1, F.lit(False))


def fit(docs: DataFrame, key: str = "doc_id", column: str = "text", label: str = "lang",
        samples: int = 256, dictionary_bytes: int = 112_640) -> dict[str, bytes]:
    """A dictionary for each label from a bounded sample of labelled rows; the most frequent label first.

    Sample: rows fall into ``samples`` buckets by a hash of the key; of each
    label and bucket the row with the smallest hash is taken, so at most
    ``samples`` rows a label are read by the driver, each cut to
    ``dictionary_bytes // 16`` characters.  Rows with null text or label take no part;
    repeated rows count once; no labelled rows give an empty dictionary set."""
    known = docs.where(F.col(label).isNotNull() & F.col(column).isNotNull() & (F.length(F.trim(column)) > 0))
    keyed = known.select(F.col(label).alias("lang"), F.xxhash64(F.col(key).cast("string"), F.lit(7)).alias("h"),
                         F.substring(column, 1, dictionary_bytes // 16).alias("text"))
    keyed = keyed.withColumn("bucket", F.pmod(F.shiftrightunsigned("h", 8), F.lit(samples)))
    least = keyed.groupBy("lang", "bucket").agg(F.min("h").alias("h"))
    counts = {r["lang"]: r["n"] for r in known.groupBy(F.col(label).alias("lang")).agg(F.count("*").alias("n")).collect()}
    chosen = [r["h"] for r in least.collect()]
    rows = keyed.where(F.col("h").isin(chosen)).dropDuplicates(["lang", "h"]).collect() if chosen else []
    out: dict[str, list[bytes]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["h"])):
        out.setdefault(r["lang"], []).append(letters_only(r["text"]))
    return {lang: _blend(out[lang], dictionary_bytes) for lang in sorted(out, key=lambda x: (-counts[x], x))}


def _blend(texts: list[bytes], room: int) -> bytes:
    """An equal share of each text, joined to at most ``room`` bytes."""
    parts, left = [], room
    for i, t in enumerate(sorted(texts, key=len)):
        share = left // (len(texts) - i)
        cut = t[:share]
        parts.append(cut)
        left -= len(cut)
    return b"\n".join(parts)[:room]


class Classifier:
    """Compressors for a set of dictionaries; used inside tasks."""

    def __init__(self, dictionaries: dict[str, bytes], margin: float = 0.01, level: int = 9):
        self.margin = margin
        self.langs = list(dictionaries)
        self.coders = []
        for lang in self.langs:
            d = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            self.coders.append(zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_checksum=False))

    def sizes(self, data: bytes) -> list[int]:
        pieces = [data[i:i + PIECE] for i in range(0, len(data), PIECE)] or [b""]
        return [sum(len(c.compress(p)) for p in pieces) for c in self.coders]

    def predict(self, data: bytes) -> tuple[str, float, bool]:
        """(label, margin, accepted): margin is 1 - smallest / second smallest; ties go to the more frequent label."""
        if not self.coders:
            return "und", 0.0, False
        sizes = self.sizes(data)
        order = np.argsort(sizes, kind="stable")
        second = sizes[order[1]] if len(order) > 1 else len(data) + 16
        margin = max(0.0, 1.0 - sizes[order[0]] / max(second, 1))
        return self.langs[order[0]], margin, margin >= self.margin


def classify(docs: DataFrame, dictionaries: dict[str, bytes], key: str = "doc_id", column: str = "text",
             margin: float = 0.01, keep: tuple[str, ...] = ()) -> DataFrame:
    """``key``, ``keep``, lang_pred, score (margin, 0 to 1), accepted.

    ``und`` with score 0 and not accepted: null text, no letter, or no
    dictionary.  A margin below ``margin`` is not accepted, at any length of text, nor is a tie.
    Whole texts are compressed; null keys, repeated rows and further columns do no harm; an
    empty table gives an empty result."""
    names = [key, *keep]

    def run(batches):
        model = Classifier(dictionaries, margin)
        for batch in batches:
            text, letters = batch.column(len(names)), batch.column(len(names) + 1).to_pylist()
            got = [model.predict(letters_only(text[i].as_py())) if ok else ("und", 0.0, False) for i, ok in enumerate(letters)]
            lang, score, accepted = zip(*got, strict=True) if got else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(names))]
                + [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(accepted, pa.bool_())],
                names=[*names, "lang_pred", "score", "accepted"])

    fields = [T.StructField(docs.schema[c].name, docs.schema[c].dataType, True) for c in names]
    schema = T.StructType([*fields, *T.StructType.fromDDL("lang_pred string, score double, accepted boolean").fields])
    letter = F.coalesce(F.col(column).rlike(r"\p{L}"), F.lit(False)).alias("_letter")
    return shipped(docs).select(*names, F.col(column).alias("_text"), letter).mapInArrow(tidied(run), schema)
