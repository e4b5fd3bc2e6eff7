"""Days without rows, and models over folds."""

import datetime

import numpy as np
import pytest

from towerlens.operators import calendar, folds


def test_gaps(spark):
    rows = [(1, "01.01", 5.0), (1, "02.01", None), (1, "05.01", 1.0), (1, "05.01", None), (1, "06.01", None), (1, "08.01", None)]
    rows += [(2, "28.02", 1.0), (2, "02.03", 1.0), (3, "31.12", None), (4, "30.02", 1.0), (None, "01.01", 1.0), (5, None, 1.0)]
    df = spark.createDataFrame(rows, "cell int, day string, value double")
    days = {(r.cell, r.DATE.strftime("%d.%m")): (r.N_ROWS, r.N_KNOWN) for r in calendar.metric_days(df, "cell", "day", "value").collect()}
    assert len(days) == 8 + 3 + 1
    assert days[1, "03.01"] == (0, 0) and days[1, "05.01"] == (2, 1) and days[2, "01.03"] == (0, 0)
    found = sorted(
        (r.cell, r.FIRST.strftime("%d.%m"), r.LAST.strftime("%d.%m"), r.N_DAYS, r.N_ABSENT)
        for r in calendar.metric_gaps(df, "cell", "day", "value").collect()
    )
    assert found == [(1, "02.01", "04.01", 3, 2), (1, "06.01", "08.01", 3, 1), (2, "01.03", "01.03", 1, 1), (3, "31.12", "31.12", 1, 0)]
    assert calendar.metric_gaps(df.limit(0), "cell", "day", "value").count() == 0
    assert isinstance(calendar.metric_days(df, "cell", "day", "value").first().DATE, datetime.date)


def logistic(x, y, ridge):
    """Plain Newton steps on whole arrays."""
    x = np.column_stack([np.ones(len(x)), x])
    w, penalty = np.zeros(x.shape[1]), ridge * np.diag([0.0] + [1.0] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        w = w + np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (y - p) - penalty @ w)
    return w


@pytest.fixture
def answers(spark):
    chance = np.random.default_rng(3)
    x = chance.standard_normal((600, 3))
    y = (chance.random(600) < 1 / (1 + np.exp(-(x @ [1.5, -1.0, 0.0] + 0.3)))).astype(int)
    rows = [(n, int(v), *[None if (n + i) % 50 == 0 else float(c) for i, c in enumerate(row)], 7.0) for n, (row, v) in enumerate(zip(x, y))]
    rows += [(600, None, 1.0, 1.0, 1.0, 7.0)]
    return spark.createDataFrame(rows, "id int, y int, a double, b double, c double, same double").repartition(4)


def test_every_row_is_scored_by_a_model_of_the_others(answers):
    model = folds.fitted(answers, "id", "y", ["a", "b", "c", "same"], folds=4, ridge=2.0)
    assert model.columns == ["a", "b", "c"] and 2 < model.steps < 12
    known = sorted(folds.in_folds(answers, "id", 4).collect())
    fold = np.array([row.FOLD for row in known])
    x = np.array([[(0.0 if row[c] is None else (row[c] - m) / d) for c, m, d in zip(model.columns, model.mean, model.deviation)] for row in known])
    found = {row.id: row for row in folds.out_of_fold_scores(answers, "id", "y", model).collect()}
    assert len(found) == 601 and 0 < found[600].SCORE < 1
    for number in range(4):
        seen = (fold != number) & np.array([row.y is not None for row in known])
        weights = logistic(x[seen], np.array([row.y for row in known if row.y is not None and row.FOLD != number]), 2.0)
        assert np.allclose(model.weights[number], weights, atol=1e-6)
        own = np.flatnonzero(fold == number)
        wanted = 1 / (1 + np.exp(-(weights[0] + x[own] @ weights[1:])))
        assert np.allclose([found[known[n].id].SCORE for n in own], wanted, atol=1e-6)


def test_folds_depend_on_the_key_alone(answers):
    once = {row.id: row.FOLD for row in folds.in_folds(answers, "id").collect()}
    assert {row.id: row.FOLD for row in folds.in_folds(answers.repartition(9), "id").collect()} == once
    assert set(once.values()) == {0, 1, 2, 3, 4}
