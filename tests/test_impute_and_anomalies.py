import pytest
from pyspark.sql import functions as F

from towerlens.operators.anomalies import anomalous_keys, anomaly_counts
from towerlens.operators.impute import fill_by_day_type


def test_fill(spark, rows):
    data = [
        (1, "2002-03-01", 1.0, None), (1, "2002-03-04", 3.0, None), (1, "2002-03-05", None, None),
        (1, "2002-03-02", 9.0, None), (1, "2002-03-03", None, 4.0),
        (2, "2002-03-01", None, None), (3, "2002-03-01", 6.0, 1.0), (3, "2002-03-02", None, None),
        (None, "2002-03-01", None, 2.0),
    ]
    df = spark.createDataFrame(data, "cell int, d string, v double, w double").withColumn(
        "d", F.col("d").cast("date")
    )
    filled = fill_by_day_type(df, "cell", "d", ["v", "w"])
    assert filled.columns == df.columns
    got = {(r.cell, str(r.d)): (r.v, r.w) for r in filled.collect()}
    assert got[1, "2002-03-05"] == (2.0, 4.0)  # w: no working day is known, so any day
    assert got[1, "2002-03-03"] == (9.0, 4.0)
    assert got[2, "2002-03-01"] == (None, None)
    assert got[3, "2002-03-02"] == (6.0, 1.0)
    assert got[None, "2002-03-01"] == (None, 2.0)
    assert len(got) == len(data)


def test_anomalies(spark, rows):
    data = [(cell, float(cell % 2), 1.0, None) for cell in range(20) for _ in range(3)]
    data += [(99, 50.0, 1.0, 5.0), (None, 1e9, 1e9, None)]
    df = spark.createDataFrame(data, "cell int, a double, b double, c double")
    found = anomalous_keys(df, "cell", ["a", "b", "c"], 3.0)
    assert rows(found.select("cell", "METRIC", "VALUE")) == [(99, "a", 50.0)]
    assert found.first().Z == pytest.approx(4.47, abs=0.01)
    assert rows(anomaly_counts(found, "cell").select("cell", "N_METRICS")) == [(99, 1)]
    assert anomaly_counts(found, "cell", at_least=2).count() == 0
