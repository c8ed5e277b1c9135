"""Registered queries of the subpackage: ``opN_<name>`` over whole tables."""

from __future__ import annotations

import string
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm import (
    bytebpe, covertree, divergence, html, langid, lm, neardup, packing, quality, segment, substrings, suffix, whitening,
)
from wattline.session import prepare_session

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare_session(spark)
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op1_lm_scoring(spark, sf_dir):
    """log10 probability of every document under a bigram model of four fifths of them."""
    return lm.score(table(spark, sf_dir, "documents"))


@register
def op2_minhash_neardup(spark, sf_dir):
    """Components of documents whose sets of four-word shingles are similar to 0.8 or more."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), shingle=4)


@register
def op3_html_extraction(spark, sf_dir):
    """Main text of every page."""
    return html.extract(table(spark, sf_dir, "pages"))


@register
def op4_suffix_array_dedup(spark, sf_dir):
    """Strings of 50 bytes that also start in a document with a smaller id are removed."""
    out = suffix.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


@register
def op5_exact_topk(spark, sf_dir):
    """The 20 highest inner products of every twentieth vector."""
    return covertree.top_inner_products(table(spark, sf_dir, "embeddings"))


@register
def op6_quality_rules(spark, sf_dir):
    """Repetition figures and verdict of every document."""
    out = quality.repetition_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@register
def op7_language_id(spark, sf_dir):
    """Language of every document, learnt from two thirds of the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    held = langid.held_out()
    model = langid.fit(docs.where(~held))
    out = langid.classify(docs.withColumn("held_out", held), model, keep=("held_out",))
    return out.select("doc_id", "held_out", "lang_pred", "score", "accepted")


@register
def op8_sampled_segmentation(spark, sf_dir):
    """Two sampled segmentations of every document, without replacement, and whether they spell its text."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    out = segment.sample_segmentations(table(spark, sf_dir, "documents"), model)
    return out.select("doc_id", "sample", "n_pieces", F.crc32("ids").alias("ids_crc32"), "log_prob", "perturbed", "log_inclusion",
                      F.length("spelt").cast("long").alias("n_chars"), F.sha2("spelt", 256).alias("spelt_sha256"))


@register
def op9_substring_dedup(spark, sf_dir):
    """Passages of 50 words that also start in a document with a smaller id are removed."""
    out = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@register
def op10_packing(spark, sf_dir):
    """Every document packed into sequences of at most 4096 tokens."""
    out = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@register
def op11_source_divergence(spark, sf_dir):
    """Divergence of every language's sources, pair by pair and by their foremost terms."""
    return divergence.audit(table(spark, sf_dir, "documents"))


_UPPER, _LOWER = string.ascii_uppercase, string.ascii_lowercase
_P = "1 + (1000000000::hugeint * (coalesce({c}, 0) + 5)) // (coalesce({n}, 0) + 5 * v)"
ORACLES["op11_source_divergence"] = f"""
with d as (select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text from documents),
w as (select id, lang, source, translate(unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')), '{_UPPER}', '{_LOWER}') as term from d),
kept as (select lang, term from (select distinct id, lang, term from w) group by lang, term having count(*) >= 30),
size as (select lang, count(*) as v from kept group by lang),
groups as (select distinct lang, source from d),
counts as (select lang, source, term, count(*) as c from w semi join kept using (lang, term) group by lang, source, term),
totals as (select lang, source, sum(c) as n from counts group by lang, source),
shares as (select g.lang, g.source, k.term, coalesce(c.c, 0) as c, {_P.format(c="c.c", n="t.n")} as p
  from groups g join kept k using (lang) join size using (lang) left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term
  left join totals t on t.lang = g.lang and t.source = g.source),
whole as (select lang, term, {_P.format(c="c", n="n")} as q from (select lang, term, sum(c) as c from counts group by lang, term)
  join (select lang, sum(c) as n from counts group by lang) using (lang) join size using (lang)),
pairs as (select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value from shares a join shares b
  on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
found as (select a.lang, a.source, 'pair' as part, b.source as item, cast(coalesce(p.value, 0) as bigint) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source
  union all select lang, source, 'term', term, cast(p - q as bigint) from shares join whole using (lang, term) where c > 0 and p > q)
select lang, source, part, item, value, cast(rank as integer) as rank from
  (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from found) where part = 'pair' or rank <= 50"""


@register
def op12_byte_bpe(spark, sf_dir):
    """Digests of every document's ids and of the bytes that they decode to."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bytebpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    out = bytebpe.decode(encoded, ranks)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


@register
def op13_embedding_whitening(spark, sf_dir):
    """The four leading whitened components of every embedding."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
