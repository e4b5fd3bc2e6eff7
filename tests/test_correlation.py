import numpy as np
import pandas as pd
import pytest

from towerlens.operators.correlation import correlation_matrix


def matrix(df, columns, narrow):
    found = correlation_matrix(df, columns, narrow).collect()
    assert len(found) == len(columns) ** 2
    return {(r.X, r.Y): r.CORR for r in found}


@pytest.mark.parametrize("narrow", [0, 99])
def test_toy_rows(spark, narrow):
    data = [(1.0, 2.0, 1.0, None), (2.0, None, 1.0, None), (3.0, 6.0, 1.0, 5.0), (None, 8.0, 1.0, None)]
    df = spark.createDataFrame(data, "a double, b double, c double, d double")
    got = matrix(df, ["a", "b", "c", "d"], narrow)
    assert got["a", "b"] == pytest.approx(1) and got["a", "a"] == pytest.approx(1)
    for pair in [("a", "c"), ("c", "c"), ("a", "d"), ("d", "d"), ("c", "d")]:
        assert got[pair] is None


@pytest.mark.parametrize("narrow", [0, 99])
@pytest.mark.parametrize("partitions", [1, 7])
def test_against_pandas(spark, narrow, partitions):
    rng = np.random.default_rng(5)
    frame = pd.DataFrame(rng.normal(size=(3000, 5)), columns=list("abcde"))
    frame["b"] = frame["a"] * 2 + rng.normal(size=3000) * 0.1
    frame["c"] = 1e7 + frame["a"] + frame["c"]  # a large common offset
    frame["d"] = np.sort(frame["d"])  # every task sees another range
    frame["e"] = 0.1  # constant, not exact in binary
    frame["f"] = np.where(frame["a"] > 0, 0.3, frame["b"])  # constant beside some columns
    frame = frame.mask(rng.random(frame.shape) < 0.2)
    frame["g"] = frame["c"].where(frame["a"] > 0)
    columns = list(frame.columns)
    df = spark.createDataFrame(frame).repartition(partitions)
    # Taking the offset away changes no correlation and spares pandas the rounding.
    got, wanted = matrix(df, columns, narrow), frame.assign(c=frame["c"] - 1e7, g=frame["g"] - 1e7).corr()
    for x in columns:
        for y in columns:
            if np.isnan(wanted.loc[x, y]):
                assert got[x, y] is None, (x, y)
            else:
                assert got[x, y] == pytest.approx(wanted.loc[x, y], abs=1e-8), (x, y)


@pytest.mark.parametrize("narrow", [0, 99])
def test_no_rows(spark, narrow):
    df = spark.createDataFrame([], "a double, b double").repartition(2)
    assert set(matrix(df, ["a", "b"], narrow).values()) == {None}


@pytest.mark.parametrize("narrow", [0, 99])
@pytest.mark.parametrize("partitions", [1, 5])
def test_infinities_spoil_their_pairs_only(spark, narrow, partitions):
    rng = np.random.default_rng(9)
    frame = pd.DataFrame(rng.normal(size=(500, 4)), columns=list("abcd"))
    frame.loc[7, "b"], frame.loc[200, "c"] = np.inf, -np.inf
    frame.loc[7, "d"] = np.nan
    got = matrix(spark.createDataFrame(frame).repartition(partitions), list("abcd"), narrow)
    for x in "abcd":
        for y in "abcd":
            known = frame[[x, y]].dropna().to_numpy()
            if np.isinf(known).any():
                assert got[x, y] is None, (x, y)
            else:
                assert got[x, y] == pytest.approx(np.corrcoef(known[:, 0], known[:, 1])[0, 1], abs=1e-9)
