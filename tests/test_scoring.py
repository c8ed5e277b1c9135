"""Streamed scores equal batch scores, whatever is delivered again."""

import datetime as dt
import glob
import os

import pytest

from wattline.operators import forecasting as FC
from wattline.operators.persist import load_model, save_model
from wattline.streaming.scoring import read_scores, score, start_scoring

T0 = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("kind", ["bins", "linear"])
def test_replayed_batch_is_written_once(spark, tmp_path, kind):
    rows = [(p, T0 + dt.timedelta(hours=i), float(i % 24 + ord(p)), float(i)) for p in "ab" for i in range(200)] + [("new", T0, 1.0, None)]
    df = spark.createDataFrame(rows, "plant_name string, timestamp timestamp_ntz, y_true double, x double")
    model, source, out, progress = (str(tmp_path / n) for n in ("model", "source", "out", "progress"))
    history = df.where("plant_name <> 'new'")
    if kind == "bins":
        save_model(model, {"bins": FC.fit_quantile_bins(FC.add_month_hour(history))}, meta={"kind": kind, "keys": ["plant_name", "month", "hour"]})
    else:
        from wattline.operators import learners as L
        save_model(model, {"weights": L.fit_linear(history, ["plant_name"], "y_true", ["x"])}, meta={"kind": kind, "keys": ["plant_name"], "features": ["x"]})
    df.repartition(5).write.parquet(source)

    def run():
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(source)
        start_scoring(stream, model, out, progress).awaitTermination()

    def scores():
        return sorted(map(str, read_scores(spark, out).drop("batch_id").collect()))

    run()
    tables, _, meta = load_model(spark, model)
    want = score(df, tables, meta)
    columns = read_scores(spark, out).drop("batch_id").columns
    assert scores() == sorted(map(str, want.select(*columns).collect())) and len(scores()) == 401
    # the last batch was written, but its commit is lost: it comes again
    last = max(glob.glob(progress + "/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    assert int(os.path.basename(last)) >= 2
    os.remove(last)
    os.remove(os.path.join(os.path.dirname(last), f".{os.path.basename(last)}.crc"))
    before = scores()
    run()
    assert scores() == before
    # later arrivals make batches of their own
    spark.createDataFrame([("a", T0 + dt.timedelta(hours=900), 5.0, 900.0)], df.schema).write.mode("append").parquet(source)
    run()
    assert len(scores()) == 402


def test_unknown_kind(spark):
    with pytest.raises(ValueError):
        score(spark.range(1), {}, {"kind": "net"})
