"""Quantile and distinct sketches against exact values."""

import math
import random

import pytest
from pyspark.sql import functions as F

from towerlens.operators import fences, sketches

OWN = {"x": ["A", "B"], "y": ["B", "C"]}


@pytest.fixture
def values(spark):
    chance = random.Random(4)
    rows = []
    for n in range(3000):
        known = [chance.gauss(0, 1) if chance.random() < 0.9 else None for _ in range(3)]
        rows.append((chance.choice(["x", "y", "z", None]), n % 9, n, *known))
    rows.append(("x", 0, 3000, math.nan, 50.0, None))
    return rows, spark.createDataFrame(rows, "g string, day int, id int, A double, B double, C double")


def exact(rows, group, place, rank):
    known = sorted(row[place] for row in rows if row[0] == group and row[place] is not None and row[place] == row[place])
    return known[math.ceil(rank * len(known)) - 1], known


def test_few_values_are_exact(values):
    rows, df = values
    stored = fences.quantile_sketches(df, ["g", "day"], ["A", "B", "C"], 4096)
    found = fences.fences(fences.merged_sketches(stored, ["g"], ["A", "B", "C"]), "g", OWN).collect()
    assert {(row.g, row.METRIC) for row in found} == {("x", "A"), ("x", "B"), ("y", "B"), ("y", "C")}
    for row in found:
        place = 3 + "ABC".index(row.METRIC)
        (q1, known), (q3, _) = exact(rows, row.g, place, 0.25), exact(rows, row.g, place, 0.75)
        assert (row.N, row.Q1, row.Q3) == (len(known), q1, q3)
        assert row.LOWER == q1 - 1.5 * (q3 - q1) and row.UPPER == q3 + 1.5 * (q3 - q1)


def test_ranks_are_within_the_bound(spark):
    df = spark.range(200_000).select(F.lit("x").alias("g"), (F.col("id") % 31).alias("day"), F.hash("id").cast("double").alias("A"))
    stored = fences.quantile_sketches(df, ["g", "day"], ["A"])
    row = fences.fences(fences.merged_sketches(stored, ["g"], ["A"]), "g", {"x": ["A"]}).first()
    ranks = df.agg(*[F.avg((F.col("A") <= row[name]).cast("int")) for name in ("Q1", "Q3")]).first()
    assert abs(ranks[0] - 0.25) < 2.3 / fences.ACCURACY and abs(ranks[1] - 0.75) < 2.3 / fences.ACCURACY
    # A merged sketch doesn't grow with the rows.
    assert max(len(r.A) for r in stored.collect()) < 40_000


def test_outside(values):
    rows, df = values
    found = fences.fences(fences.quantile_sketches(df, ["g"], ["A", "B", "C"], 4096), "g", OWN)
    limits = {(row.g, row.METRIC): (row.LOWER, row.UPPER) for row in found.collect()}
    wanted = set()
    for row in rows:
        for name in OWN.get(row[0], ()):
            value = row[3 + "ABC".index(name)]
            low, high = limits[row[0], name]
            if value is not None and (value < low or value > high):
                wanted.add((row[2], row[0], name, value))
    outside = fences.outside_fences(df, ["id"], "g", found, OWN)
    assert {(r.id, r.g, r.METRIC, r.VALUE) for r in outside.collect()} == wanted and (3000, "x", "B", 50.0) in wanted


def test_distinct_sketches_unite(spark):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 2 == 0, "x").otherwise("y").alias("g"), (F.col("id") % 12).alias("day"),
        (F.col("id") % 20_000).cast("double").alias("A"), F.when(F.col("id") % 5 > 0, F.concat(F.lit("t"), F.col("id") % 300)).alias("B"),
        F.lit(None).cast("int").alias("C"),
    )
    stored = sketches.distinct_sketches(df, ["g", "day"], ["A", "B", "C"])
    by_group = sketches.united(stored, ["g"], ["A", "B", "C"])
    found = {(r.g, r.METRIC): r.N_DISTINCT for r in sketches.estimated(by_group, "g", OWN).collect()}
    assert abs(found["x", "A"] - 10_000) < 0.026 * 10_000 and found["y", "C"] == 0
    exact_b = df.where("g = 'y'").select("B").where("B is not null").distinct().count()
    assert abs(found["y", "B"] - exact_b) <= 0.026 * exact_b
    # The union of days is the sketch of one pass.
    whole = sketches.estimated(sketches.distinct_sketches(df, ["g"], ["A", "B", "C"]), "g", OWN).collect()
    assert {(r.g, r.METRIC): r.N_DISTINCT for r in whole} == found


def test_empty_tables(values):
    none = values[1].limit(0)
    assert fences.fences(fences.quantile_sketches(none, ["g"], ["A"]), "g", {"x": ["A"]}).count() == 0
    assert sketches.estimated(sketches.distinct_sketches(none, ["g"], ["A"]), "g", {"x": ["A"]}).count() == 0
