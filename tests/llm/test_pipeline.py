"""The corpus pipeline, stage by stage, against brute force."""

import random

import corpus_pipeline as P
from llm.cases import corpus, edited, text
from llm.test_dedup import brute_bytes, brute_components
from llm.test_text import brute_quality

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_take_effect(frame, spark, tmp_path):
    rows = [(i, t) for i, (_, t) in enumerate(corpus(seed=21)) if len(t or "") < 60000]
    docs = frame(rows, extra=False).repartition(3)
    names = [n for n, _ in P.STAGES]
    assert names == ["quality_rules", "language_id", "minhash_near_dedup", "suffix_array_dedup", "packing"]
    frames = {}
    for name, function in P.STAGES:
        out = function(spark, docs, str(tmp_path))
        if name != names[-1]:
            assert out.columns == COLUMNS
        path = str(tmp_path / name)
        out.write.parquet(path)
        docs = frames[name] = spark.read.parquet(path)
    kept = [r["doc_id"] for r in frames["quality_rules"].collect()]
    assert set(kept) <= {k for k, t in rows if not brute_quality(t)[5]} and len(kept) > 60
    told = sorted((r["doc_id"], r["text"]) for r in frames["language_id"].collect())
    assert {k for k, _ in told} <= set(kept)
    single = sorted((r["doc_id"], r["text"]) for r in frames["minhash_near_dedup"].collect())
    want = [k for k, _, _, keep in brute_components(told, 5) if keep]
    assert [k for k, _ in single] == sorted(want)
    cut = {r["doc_id"]: r for r in frames["suffix_array_dedup"].collect()}
    for k, _, _, _, left in brute_bytes(single):
        assert cut[k]["text"] == left.decode("utf-8", "ignore") and cut[k]["n_chars"] == len(cut[k]["text"])
    assert {r["doc_id"] for r in frames["packing"].select("doc_id").distinct().collect()} == set(cut)


def test_run_equals_the_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, function in P.STAGES:
        function(spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    pick = lambda df: sorted((r["doc_id"], r["start"], r["length"], bytes(r["ids"])) for r in df.collect())
    whole, parts = pick(P.run(spark, sf)), pick(docs)
    assert {r[0] for r in whole} == {r[0] for r in parts}
    assert sum(r[2] for r in whole) == sum(r[2] for r in parts)


def test_empty_documents(frame, spark, tmp_path):
    docs = frame([(1, "x")], extra=False).where("false")
    for _, function in P.STAGES:
        out = function(spark, docs, str(tmp_path))
        assert out.count() == 0
        docs = out if "text" in out.columns else docs


def test_one_row_of_each_group_stays(frame, spark, tmp_path):
    rng = random.Random(8)
    one, two, keyless = (text(rng, 90) for _ in range(3))
    docs = frame([(5, one), (5, one), (7, one), (6, two), (6, edited(rng, two, 0.002)), (9, one + " end"), (5, keyless), (None, keyless),
                  (None, two), (None, None), (None, None), (3, ""), (3, ""), (8, "few"), (8, "few")]).repartition(3)
    got = P.near_dedup(spark, docs, str(tmp_path))
    assert got.schema.names == docs.schema.names
    assert sorted(map(tuple, got.select("doc_id", "n_chars", "lang", "bucket").collect()), key=str) == sorted(
        [(5, len(one), "en", "x"), (5, len(keyless), "en", "x"), (3, 0, "en", "x"), (3, 0, "en", "x"), (8, 3, "en", "x"),
         (None, None, "en", "x"), (None, None, "en", "x"),
         *((6, r["n_chars"], "en", "x") for r in got.where("doc_id = 6").collect())], key=str)
    assert got.where("doc_id = 6").count() == 1 and {r["text"] for r in got.where("n_chars is null").collect()} == {None}


def test_rows_of_null_keys_pass(frame, spark, tmp_path):
    docs = frame([(None, None), (None, "")], extra=False)
    for _, function in P.STAGES[2:4]:
        docs = function(spark, docs, str(tmp_path))
        assert docs.count() == 2
