import os
import random

import pytest
from pyspark.sql import functions as F

from towerlens import fixed
from towerlens.operators import score as s
from towerlens.sources.delimited import write_scores


def by_pairs(data):
    """AUC by comparing every positive with every negative."""
    positive = [x for x, y in data if y == 1]
    negative = [x for x, y in data if y == 0]
    wins = sum((p > n) + (p == n) / 2 for p in positive for n in negative)
    pairs = len(positive) * len(negative)
    return wins / pairs if pairs else None


def test_toy_rows(spark):
    data = [(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1), (0.4, 1), (None, 1), (0.5, None)]
    df = spark.createDataFrame(data, "x double, y int")
    assert tuple(s.roc_auc(df, "x", "y").first()) == (3, 2, 0.75)


@pytest.mark.parametrize("distinct", [3, 5000])
def test_against_all_pairs(spark, distinct):
    rng = random.Random(distinct)
    data = [(rng.randrange(distinct) / 7 + (i % 3 == 0) * rng.random(), int(i % 3 == 0)) for i in range(1500)]
    data += [(0.5, i % 2) for i in range(750)]  # one heavy score
    df = spark.createDataFrame(data, "x double, y int").repartition(5)
    assert s.roc_auc(df, "x", "y").first().AUC == pytest.approx(by_pairs(data), abs=1e-12)
    halves = df.withColumn("h", F.when(F.col("x") <= 0.5, "low").otherwise("high"))
    got = {r.h: r.AUC for r in s.roc_auc(halves, "x", "y", ["h"]).collect()}
    for half, keep in (("low", lambda x: x <= 0.5), ("high", lambda x: x > 0.5)):
        wanted = by_pairs([(x, y) for x, y in data if keep(x)])
        assert got[half] == (wanted if wanted is None else pytest.approx(wanted, abs=1e-12))


def test_one_class_has_no_auc(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "x double, y int")
    assert s.roc_auc(df, "x", "y").first().AUC is None


def test_scoring_split(spark):
    df = s.with_scoring_split(spark.range(5221).withColumnRenamed("id", "k"), "k")
    n = {r.SCORING: r["count"] for r in df.groupBy("SCORING").count().collect()}
    assert n["preliminary"] + n["final"] == 5221
    assert abs(n["preliminary"] / 5221 - fixed.PRELIMINARY_PERCENT / 100) < 0.03


def test_scores_are_written_in_the_wanted_order(spark, tmp_path):
    wanted = spark.createDataFrame([(7, 1), (11, 2), (3, 3), (5, 4)], "k long, place int").repartition(3)
    scores = spark.createDataFrame([(3, 0.25), (5, 0.5), (7, 0.75), (9, 0.1)], "k long, score double")
    ordered = s.scores_in_order(wanted, scores, "k", "place", "score")
    assert [r.k for r in ordered.collect()] == [7, 11, 3, 5]
    path = str(tmp_path / "scores")
    write_scores(ordered, "score", path)
    parts = sorted(name for name in os.listdir(path) if name.endswith(".txt"))
    assert "".join(open(f"{path}/{p}").read() for p in parts).split("\n") == ["0.75", "", "0.25", "0.5", ""]
