import tempfile

from pyspark.sql import functions as F

from wattline.operators import forecasting as FC
from wattline.operators.persist import load_model, save_model


def test_roundtrip_tables_and_pipeline(spark):
    rows = [(float(h % 24), float(h % 24) * 2.0 + 1.0) for h in range(200)]
    df = spark.createDataFrame(rows, "hour double, y_true double")
    model = FC.fit_gbt(df, ["hour"], max_iter=5)
    bins = spark.createDataFrame([("p", 1, 2, 0.0, 1.0, 2.0)], "plant_name string, month int, hour int, P10 double, P50 double, P90 double")
    d = tempfile.mkdtemp(prefix="wl-model-")
    save_model(d, {"bins": bins}, model, {"kind": "quantile_bins+gbt"})
    tables, pipe, meta = load_model(spark, d)
    assert meta["kind"] == "quantile_bins+gbt" and tables["bins"].count() == 1
    a = FC.gbt_predict(model, df, ["hour"]).agg(F.sum("P50")).first()[0]
    b = FC.gbt_predict(pipe, df, ["hour"]).agg(F.sum("P50")).first()[0]
    assert abs(a - b) < 1e-9
