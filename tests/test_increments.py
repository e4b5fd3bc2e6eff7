"""Partial states against the whole history."""

import random

import pytest
from pyspark.sql import functions as F

from towerlens import fixed
from towerlens.functions.columns import short_date
from towerlens.operators import increments, layers
from towerlens.operators.mart import subject_summary


@pytest.fixture
def history(spark):
    chance = random.Random(8)
    rows = []
    for _ in range(800):
        start = chance.choice([f"{chance.randint(1, 28):02}.{chance.randint(1, 12):02} {chance.randint(0, 23):02}", None]) if chance.random() < 0.1 else f"0{chance.randint(1, 5)}.03 {chance.randint(0, 23):02}"
        rows.append((chance.choice([1, 2, 3, None]) if chance.random() < 0.7 else 1, chance.randint(1, 9), start, chance.choice([None, 1.5, 2.0, 0.25])))
    sessions = spark.createDataFrame(rows, "SK_ID int, CELL_LAC_ID int, START_TIME string, DATA_VOL_MB double")
    cells = spark.createDataFrame([(n, "234"[n % 3] + "G" if n < 8 else None) for n in range(1, 10)], "CELL_LAC_ID int, GEN string")
    return sessions, cells


def test_bitmaps_equal_distinct_counts(history, rows):
    found = increments.traffic_by_layer_bitmaps(*history)
    wanted = layers.traffic_by_layer(*history)
    assert found.columns == wanted.columns and found.dtypes == wanted.dtypes
    assert rows(found) == rows(wanted)


def test_one_shuffle_fewer(history):
    def shuffles(df):
        return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count("Exchange hashpartitioning")

    assert shuffles(increments.traffic_by_layer_bitmaps(*history)) == shuffles(layers.traffic_by_layer(*history)) - 1


def test_batches_merge_to_the_whole(spark, history, rows, tmp_path):
    """Days whose sessions came in two batches, and a batch that is written twice."""
    sessions, cells = history
    path = str(tmp_path / "states")
    part = F.pmod(F.hash(*sessions.columns), F.lit(3))
    for batch in (0, 1, 2, 1):
        increments.add_batch(increments.daily_states(sessions.where(part == batch), cells), path, f"b{batch}")
    found = increments.traffic_of_states(increments.stored_states(spark, path))
    assert rows(found) == rows(layers.traffic_by_layer(sessions, cells))


def test_old_sessions_are_not_read_again(spark, history, tmp_path):
    sessions, cells = history
    old, new, path = str(tmp_path / "old"), str(tmp_path / "new"), str(tmp_path / "states")
    late = F.coalesce(F.col("START_TIME") >= "04", F.lit(True))
    sessions.where(~late).write.parquet(old)
    sessions.where(late).write.parquet(new)
    increments.add_batch(increments.daily_states(spark.read.parquet(old), cells), path, "old")
    increments.add_batch(increments.daily_states(spark.read.parquet(new), cells), path, "new")
    files = increments.traffic_of_states(increments.stored_states(spark, path)).inputFiles()
    assert files and not any(old in name or new in name for name in files)


def test_snapshot_states_merge_to_the_summary(spark, rows):
    chance = random.Random(5)
    data = [
        (chance.choice([1, 2, None]), f"{chance.randint(1, 31):02}.0{chance.randint(1, 3)}.16", chance.choice([None, 1.0, 2.5]), chance.choice(["2G", "4G", None, "?"]), n)
        for n in range(200)
    ]
    df = spark.createDataFrame(data, "SK_ID int, SNAP_DATE string, REVENUE double, PHONE_GEN string, SNAP_ID long")
    day, tie = short_date(F.col("SNAP_DATE")), F.col("SNAP_ID")
    month = F.trunc(short_date(F.col("SNAP_DATE")), "month")
    parts = [df.where(F.pmod("SNAP_ID", F.lit(2)) == n) for n in (0, 1)]
    states = [increments.snapshot_states(part, "SK_ID", "REVENUE", "PHONE_GEN", fixed.LAYERS, month, day, tie) for part in parts]
    found = increments.summary_of_states(states[0].unionByName(states[1]), "SK_ID", "PHONE_GEN", fixed.LAYERS)
    assert rows(found) == rows(subject_summary(df, "SK_ID", "REVENUE", "PHONE_GEN", fixed.LAYERS, day, tie))
