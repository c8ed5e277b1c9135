import pytest


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    """The folder that stage tables are written to in tests."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


@pytest.fixture
def frame(spark):
    """Documents with the hard cases: (doc_id, text, lang, source, n_chars) and a clashing column."""
    def make(rows, extra=True):
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        rows = [(i, t, "en" if lang is None else lang, f"src{(i or 0) % 3}", None if t is None else len(t))
                for i, t, lang in ((r + (None,))[:3] for r in rows)]
        df = spark.createDataFrame(rows, schema)
        if extra:
            df = df.selectExpr("*", "'x' as bucket", "1 as kept", "2 as n_words", "3 as batch_id", "4 as answers", "'y' as ids")
        return df
    return make
