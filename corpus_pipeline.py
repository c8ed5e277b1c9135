"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir), works on every row of ``docs`` and
returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm import langid, neardup, packing, quality, suffix
from wattline.llm.exchange import stage
from wattline.session import prepare_session


def _rest(docs: DataFrame) -> tuple[str, ...]:
    return tuple(c for c in docs.columns if c != "doc_id")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    judged = quality.repetition_rules(docs.withColumnsRenamed({c: f"d_{c}" for c in _rest(docs)}), column="d_text",
                                      keep=tuple(f"d_{c}" for c in _rest(docs)))
    return _documents(judged.where("kept"), docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a sufficient margin."""
    model = langid.fit(docs.where(~langid.held_out()))
    told = langid.classify(docs.withColumnsRenamed({c: f"d_{c}" for c in _rest(docs)}), model, column="d_text",
                           keep=tuple(f"d_{c}" for c in _rest(docs)))
    return _documents(told.where("accepted"), docs)


def _documents(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select("doc_id", *(F.col(f"d_{c}").alias(c) for c in _rest(docs))).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each group of near-duplicates (five-word shingles, 0.8), one row each."""
    return neardup.one_of_each(docs, shingle=5)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 50 bytes that also start in a document of smaller id."""
    keep = tuple(c for c in _rest(docs) if c not in ("text", "n_chars"))
    cut = suffix.remove_repeats(docs, keep=keep, as_text=True)
    out = cut.withColumn("text", F.col("kept"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 tokens, with their ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), remember=False)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("minhash_near_dedup", near_dedup),
    ("suffix_array_dedup", suffix_dedup),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again."""
    prepare_session(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
