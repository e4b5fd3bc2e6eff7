"""Joint distances and components against numpy on whole rows."""

import numpy as np
import pytest

from towerlens.operators import joint
from towerlens.operators.correlation import pair_covariances


@pytest.fixture
def mixed():
    chance = np.random.default_rng(6)
    x = chance.standard_normal((400, 6)) @ chance.standard_normal((6, 6)) + 1e6
    x[:, 5] = 3.0
    return x


def framed(spark, x, missing=False):
    rows = [(n, *[None if missing and (n * 7 + i) % 11 == 0 else float(v) for i, v in enumerate(row)]) for n, row in enumerate(x)]
    return spark.createDataFrame(rows, "id int, " + ", ".join(f"c{i} double" for i in range(x.shape[1]))).repartition(5)


COLUMNS = [f"c{i}" for i in range(6)]


def test_pair_covariances(spark, mixed):
    rows = framed(spark, mixed, True).collect()
    table = np.array([[np.nan if row[c] is None else row[c] for c in COLUMNS] for row in rows])
    for row in pair_covariances(framed(spark, mixed, True), COLUMNS).collect():
        both = table[:, [int(row.X[1]), int(row.Y[1])]]
        both = both[~np.isnan(both).any(1)]
        off = both - both.mean(0)
        assert row.N == len(both) and np.allclose([row.MEAN_X, row.MEAN_Y], both.mean(0), rtol=1e-12)
        assert np.allclose([row.XX, row.YY, row.XY], [(off[:, 0] ** 2).sum(), (off[:, 1] ** 2).sum(), (off[:, 0] * off[:, 1]).sum()], atol=1e-5)


@pytest.mark.parametrize("shrinkage", [0.0, 0.3])
def test_distances(spark, mixed, shrinkage):
    found = {row.id: row for row in joint.joint_distances(framed(spark, mixed), "id", COLUMNS, shrinkage).collect()}
    x = mixed[:, :5]
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    r = (1 - shrinkage) * np.corrcoef(x.T) + shrinkage * np.eye(5)
    wanted = np.sqrt(np.einsum("ni,ij,nj->n", z, np.linalg.inv(r), z))
    assert np.allclose([found[n].DISTANCE for n in range(400)], wanted, rtol=1e-4)
    assert {row.N_KNOWN for row in found.values()} == {5}
    if not shrinkage:
        # Squared distances add up to columns x (rows - 1).
        assert abs(sum(row.DISTANCE**2 for row in found.values()) / (5 * 399) - 1) < 1e-4


def test_a_joint_anomaly_need_not_show_in_a_single_column(spark):
    chance = np.random.default_rng(1)
    x = np.repeat(chance.standard_normal((500, 1)), 2, axis=1) + 0.05 * chance.standard_normal((500, 2))
    x[0] = [1.0, -1.0]
    found = joint.joint_anomalies(framed(spark, x), "id", ["c0", "c1"], 3.0, 0.01).collect()
    assert [row.id for row in found] == [0] and (abs(x[0] / x.std(0)) < 1.5).all()


def test_missing_values_and_columns_that_say_nothing(spark):
    rows = [(1, 1.0, None, 5.0), (2, 2.0, None, 5.0), (3, None, None, 5.0), (4, 4.0, None, None), (None, 9.0, 9.0, 9.0)]
    df = spark.createDataFrame(rows, "id int, c0 double, c1 double, c2 double")
    found = {row.id: row for row in joint.joint_distances(df, "id", ["c0", "c1", "c2"]).collect()}
    assert set(found) == {1, 2, 3, 4} and found[3].DISTANCE is None and found[3].N_KNOWN == 0
    assert found[1].DISTANCE > found[2].DISTANCE
    assert joint.joint_anomalies(df.limit(0), "id", ["c0"], 1.0).count() == 0


def test_components(spark, mixed):
    df = framed(spark, mixed)
    found = joint.components(df, COLUMNS)
    assert found.moments.columns == COLUMNS[:5] and abs(found.variances.sum() - 5) < 1e-9
    assert np.allclose(found.variances, np.sort(np.linalg.eigvalsh(np.corrcoef(mixed[:, :5].T)))[::-1], atol=1e-5)
    assert (found.weights.sum(0) > 0).all()
    rows = joint.component_scores(df, ["id"], found, 5).collect()
    scores = np.array([row[1:] for row in rows])
    assert np.allclose(np.cov(scores.T), np.diag(found.variances), atol=1e-4)
    shares = joint.explained_variance(df, found).collect()
    assert [row.COMPONENT for row in shares] == [1, 2, 3, 4, 5] and abs(shares[-1].CUMULATED - 1) < 1e-9
