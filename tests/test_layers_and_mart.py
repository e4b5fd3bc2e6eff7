import random

import pytest
from pyspark.sql import functions as F

from towerlens import fixed
from towerlens.functions.columns import short_date
from towerlens.operators import labels, layers, mart


@pytest.fixture
def assignment(spark):
    return spark.createDataFrame(
        [(10, "2G"), (11, "3G"), (12, "4G"), (13, None)], "CELL_LAC_ID long, GEN string"
    )


@pytest.fixture
def sessions(spark):
    data = [
        (1, 10, "01.03 10", 5.0), (1, 10, "01.03 10", 5.0), (1, 10, "01.03 11", None),
        (1, 10, "02.03 10", 1.0), (1, 12, "02.03 10", 7.0), (1, 12, None, 3.0),
        (2, 99, "01.03 10", 5.0), (2, None, "01.03 10", 5.0), (2, 13, "01.03 10", 5.0),
        (3, 11, "01.03 10", None), (None, 11, "01.03 10", 1.0),
    ]
    random.Random(2).shuffle(data)
    return spark.createDataFrame(
        data, "SK_ID long, CELL_LAC_ID long, START_TIME string, DATA_VOL_MB double"
    )


def test_traffic(sessions, assignment, rows):
    traffic = layers.traffic_by_layer(sessions, assignment)
    assert traffic.columns[1:] == [
        f"{name}_{layer}" for name in ("DATA_VOL", "CNT_DAYS", "CNT_HOURS") for layer in fixed.LAYERS
    ]
    # Subject 2 has sessions on unknown cells only; an all-null volume is 0.
    assert rows(traffic) == [(1, 11.0, 0.0, 10.0, 2, 0, 1, 3, 0, 1), (3, 0.0, 0.0, 0.0, 0, 1, 0, 0, 1, 0)]


def test_traffic_equals_a_pivot_of_distinct_counts(spark, assignment, rows):
    rng = random.Random(4)
    data = [
        (rng.choice([1, 1, 1, rng.randrange(30)]), rng.choice([10, 11, 12, 40]),
         f"{rng.randrange(1, 9):02}.03 {rng.randrange(24):02}", float(rng.randrange(50)))
        for _ in range(3000)
    ]
    sessions = spark.createDataFrame(
        data, "SK_ID long, CELL_LAC_ID long, START_TIME string, DATA_VOL_MB double"
    )
    pivot = (
        sessions.join(assignment, "CELL_LAC_ID")
        .groupBy("SK_ID")
        .pivot("GEN", fixed.LAYERS)
        .agg(
            F.sum("DATA_VOL_MB").alias("DATA_VOL"),
            F.countDistinct(F.substring("START_TIME", 1, 5)).alias("CNT_DAYS"),
            F.countDistinct("START_TIME").alias("CNT_HOURS"),
        )
        .fillna(0)
    )
    traffic = layers.traffic_by_layer(sessions, assignment)
    wanted = pivot.select(
        "SK_ID", *[f"{name.split('_')[-1]}_{name.rsplit('_', 1)[0]}" for name in traffic.columns[1:]]
    )
    assert rows(traffic) == rows(wanted)


@pytest.fixture
def features(spark):
    data = [
        (1, "01.12.01", "4G", 1.0), (1, "01.03.02", "3G", None), (1, "01.04.02", None, 3.0),
        (2, "01.01.02", None, None), (3, "01.12.99", "2G", 1.0), (3, "01.01.02", "4G", 1.0),
        (None, "01.01.02", "4G", 1.0),
    ]
    random.Random(5).shuffle(data)
    return spark.createDataFrame(data, "SK_ID long, SNAP_DATE string, PHONE_GEN string, REVENUE double")


def summary_of(features):
    day = short_date(F.col("SNAP_DATE"))
    return mart.subject_summary(features, "SK_ID", "REVENUE", "PHONE_GEN", fixed.LAYERS, day)


def test_summary(features, rows):
    assert rows(summary_of(features)) == [(1, 3, 2.0, "3G"), (2, 1, None, None), (3, 2, 1.0, "4G")]


def test_wrong_layer_share(sessions, assignment, features, rows):
    traffic = layers.traffic_by_layer(sessions, assignment)
    share = layers.wrong_layer_share(traffic, summary_of(features))
    assert rows(share) == [(1, "3G", 11.0, 11.0 / 21.0), (3, "4G", 0.0, None)]


def test_mart_and_comparison(spark, sessions, assignment, features, rows):
    answers = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, 1)], "SK_ID long, CSI int")
    traffic = layers.traffic_by_layer(sessions, assignment)
    joined = mart.feature_mart(answers, summary_of(features), traffic, "SK_ID")
    assert rows(joined.select("SK_ID", "CSI", "CNT_MONTHS")) == [(1, 1, 3), (3, 0, 2)]
    assert rows(mart.compare_by_outcome(joined, "CSI", "CNT_HOURS_2G")) == [(0, 0.0, 1), (1, 3.0, 1)]
    only_4g = mart.compare_by_outcome(joined, "CSI", "CNT_HOURS_2G", F.col("PHONE_GEN") == "4G")
    assert rows(only_4g) == [(0, 0.0, 1)]


def test_only_in_first(sessions, spark, rows):
    voice = spark.createDataFrame([(1,), (7,), (7,), (None,)], "SK_ID long")
    assert rows(layers.only_in_first(voice, sessions, "SK_ID")) == [(7,)]


def test_mean_by_code(spark, rows):
    features = spark.createDataFrame(
        [(1, 1), (1, 1), (2, 2), (3, None), (4, 3), (5, 1), (None, 1)], "s long, code int"
    )
    usage = spark.createDataFrame(
        [(1, 2.0), (1, None), (1, 4.0), (2, 9.0), (3, 50.0), (4, None), (None, 7.0)], "s long, mb double"
    )
    means = labels.mean_by_code(features, usage, ["s"], "code", "mb")
    plain = features.join(usage, "s").where("code is not null").groupBy("code").agg(F.avg("mb"))
    assert rows(means.select("code", "MEAN")) == rows(plain)
    assert rows(labels.label_codes_by_metric(means, "code", fixed.LAYERS).select("code", "LABEL")) == [
        (1, "2G"), (2, "3G"), (3, None)
    ]
    per_subject = labels.mean_per_subject_by_code(features, usage, "s", "code", "mb")
    assert rows(per_subject) == [(1, 6.0, 1), (2, 9.0, 1), (3, 0.0, 1)]


def test_labels(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,), (None,)], "code int")
    labelled = labels.with_label(df, "code", fixed.DEVICE_LAYER, "PHONE_GEN")
    assert rows(labelled) == [(1, "3G"), (2, "4G"), (3, "2G"), (4, None), (None, None)]


def test_more_codes_than_labels(spark, rows):
    data = [(1, 5.0), (2, 1.0), (3, 3.0), (4, 9.0), (5, None), (None, 2.0)]
    means = spark.createDataFrame(data, "code int, MEAN double")
    labelled = labels.label_codes_by_metric(means, "code", fixed.LAYERS).select("code", "LABEL")
    assert dict(rows(labelled)) == {2: "2G", None: "3G", 3: "4G", 1: None, 4: None, 5: None}
    applied = labels.with_derived_label(means.select("code"), labelled, "code", "GEN")
    assert dict(rows(applied)) == {2: "2G", None: None, 3: "4G", 1: None, 4: None, 5: None}


def test_last_label_of_a_day(spark, rows):
    data = [(1, "01.02.02", "2G", 5), (1, "01.02.02", "4G", 3), (2, "01.02.02", "3G", 1), (2, "01.02.02", "2G", 1), (3, None, "2G", 1)]
    df = spark.createDataFrame(data, "s long, d string, label string, n long")
    day = short_date(F.col("d"))
    by_tie = mart.subject_summary(df, "s", "n", "label", fixed.LAYERS, day, F.col("n"))
    assert rows(by_tie.select("s", "label")) == [(1, "2G"), (2, "3G"), (3, None)]
    by_label = mart.subject_summary(df, "s", "n", "label", fixed.LAYERS, day)
    assert rows(by_label.select("s", "label")) == [(1, "4G"), (2, "3G"), (3, None)]
    plan = by_tie._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
