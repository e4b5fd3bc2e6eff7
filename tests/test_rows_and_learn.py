import random

import numpy as np
import pytest

from towerlens.operators import learn, rows as r
from towerlens.operators.score import roc_auc


def test_first_rows(spark):
    df = spark.createDataFrame([(3,), (None,), (1,), (2,)], "a int")
    assert [x.a for x in r.first_rows(df, ["a"], 2).collect()] == [1, 2]


def test_random_rows(spark):
    df = spark.range(1000)
    sample = {x.id for x in r.random_rows(df, ["id"], 100).collect()}
    again = {x.id for x in r.random_rows(df.repartition(7), ["id"], 100).collect()}
    other = {x.id for x in r.random_rows(df, ["id"], 100, seed=1).collect()}
    assert len(sample) == 100 and sample == again and sample != other


def test_sorted_by_columns(spark):
    data = [(None, 1), (2, 1), (1, None), (1, 5)]
    df = spark.createDataFrame(data, "a int, b int").repartition(3)
    assert [tuple(x) for x in r.sorted_by_columns(df, ["a", "b"]).collect()] == [
        (1, 5), (1, None), (2, 1), (None, 1)
    ]


def test_principal_components(spark):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(300, 3))
    data[:, 1] = data[:, 0] + 0.1 * data[:, 1]
    df = spark.createDataFrame([(i, *map(float, row)) for i, row in enumerate(data)], "id int, a double, b double, c double")
    got = learn.principal_components(df, ["id"], ["a", "b", "c"], 2).orderBy("id").collect()
    scaled = (data - data.mean(axis=0)) / data.std(axis=0, ddof=1)
    wanted = scaled @ np.linalg.svd(scaled, full_matrices=False)[2].T
    for place in range(2):
        column = np.array([row[place + 1] for row in got])
        assert np.allclose(np.abs(column), np.abs(wanted[:, place]), atol=1e-6)


def test_similar_keys(spark):
    rng = random.Random(2)
    data = [
        (cell, (cell % 2) * 100 + rng.random(), None if rng.random() < 0.2 else (cell % 2) * -50 + rng.random())
        for cell in range(30)
        for _ in range(4)
    ]
    df = spark.createDataFrame(data, "cell int, a double, b double")
    clusters = {row.cell: row.CLUSTER for row in learn.similar_keys(df, "cell", ["a", "b"], 2).collect()}
    assert len(clusters) == 30 and len(set(clusters.values())) == 2
    for kind in range(2):
        assert len({clusters[cell] for cell in range(30) if cell % 2 == kind}) == 1


def test_outcome_scores(spark):
    rng = random.Random(3)
    data = [(i, i % 2, (i % 2) + rng.gauss(0, 0.5), rng.random()) for i in range(400)]
    df = spark.createDataFrame(data, "k int, y int, a double, b double")
    scored = learn.outcome_scores(df, "k", "y", ["a", "b"])
    assert scored.columns == ["k", "y", "SCORE"] and scored.count() == 400
    assert 0.85 < roc_auc(scored, "SCORE", "y").first().AUC <= 1
    new = df.drop("y").limit(5)
    others = learn.outcome_scores(df, "k", "y", ["a", "b"], to_score=new)
    assert others.columns == ["k", "SCORE"] and others.count() == 5
    assert others.where("SCORE between 0 and 1").count() == 5


def test_numbered(spark):
    df = spark.range(1000, numPartitions=7).orderBy("id")
    assert [(x.id, x.PLACE) for x in r.numbered(df).orderBy("PLACE").collect()] == [(i, i + 1) for i in range(1000)]
    assert r.numbered(df.limit(0)).count() == 0


def test_columns_without_values_are_left_out(spark):
    data = [(i, i % 2, float(i % 2) + i / 1000, None) for i in range(100)]
    df = spark.createDataFrame(data, "k int, y int, a double, b double")
    assert learn.known_columns(df, ["a", "b"]) == ["a"]
    assert learn.principal_components(df, ["k"], ["a", "b"], 1).count() == 100
    assert {x.CLUSTER for x in learn.similar_keys(df, "k", ["a", "b"], 2).collect()} == {0, 1}
    assert learn.outcome_scores(df, "k", "y", ["a", "b"]).count() == 100
