import os
import random

import pytest
from pyspark.sql import functions as F

from towerlens.operators.lookups import lookup_join, salted_join, size_of
from towerlens.sources.workspace import forget_written, shared_folder, written, written_in_buckets


@pytest.fixture
def tables(spark):
    """A third of the rows on one key, a sixth without a key, many copies."""
    rng = random.Random(3)
    keys = [7] * 1000 + [None] * 500 + [rng.randrange(200) for _ in range(1500)]
    facts = spark.createDataFrame([(k, rng.randrange(4)) for k in keys], "k long, v long")
    lookup = spark.createDataFrame(
        [(k, f"label{k % 3}") for k in range(0, 300, 2)] + [(7, "hot")], "k long, label string"
    )
    return facts.repartition(6), lookup


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_every_way_of_joining_gives_the_same_rows(tables, rows, how):
    facts, lookup = tables
    plain = rows(facts.join(lookup, "k", how))
    assert rows(salted_join(facts, lookup, ["k"], how)) == plain
    assert rows(lookup_join(facts, lookup, ["k"], how)) == plain
    assert rows(lookup_join(facts, lookup, ["k"], how, broadcast_bytes=0)) == plain


def test_several_keys(tables, rows):
    facts, lookup = tables
    both = lookup.withColumn("v", F.lit(1).cast("long"))
    assert rows(salted_join(facts, both, ["k", "v"], "left")) == rows(
        facts.join(both, ["k", "v"], "left")
    )


TYPES = [("int", "long"), ("long", "int"), ("string", "long"), ("decimal(10,0)", "long"), ("double", "int")]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("types", TYPES)
def test_keys_of_other_types_match_as_in_a_plain_join(tables, rows, how, types):
    facts, lookup = tables
    facts = facts.withColumn("k", F.col("k").cast(types[0]))
    lookup = lookup.withColumn("k", F.col("k").cast(types[1]))
    plain, salted = facts.join(lookup, ["k"], how), salted_join(facts, lookup, ["k"], how)
    assert rows(salted) == rows(plain) and salted.dtypes == plain.dtypes
    assert rows(lookup_join(facts, lookup, ["k"], how, broadcast_bytes=0)) == rows(plain)


def test_many_heavy_keys_are_spread(spark):
    facts = spark.range(0, 64_000, numPartitions=4).select((F.col("id") % 64).alias("k"), "id")
    lookup = spark.range(64).select(F.col("id").alias("k"), F.lit("x").alias("label"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "200"}
    previous = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = salted_join(facts, lookup, ["k"]).withColumn("p", F.spark_partition_id())
        sizes = [row["count"] for row in joined.groupBy("p").count().collect()]
    finally:
        for name, value in previous.items():
            spark.conf.set(name, value)
    assert sum(sizes) == 64_000 and max(sizes) < 2 * 64_000 / 200


def test_size_counts_bytes(spark):
    short = spark.range(100).select("id", F.lit("x").alias("t"))
    long = spark.range(100).select("id", F.repeat(F.lit("x"), 10_000).alias("t"))
    assert size_of(short) < 10_000 < 1_000_000 < size_of(long)
    assert size_of(short.limit(0)) == 0


def test_no_rows(tables, rows):
    facts, lookup = tables
    assert rows(salted_join(facts.where("false"), lookup, ["k"], "left")) == []


def test_heavy_key_is_spread(spark, tables):
    facts, lookup = tables
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        many = facts.withColumn("id", F.monotonically_increasing_id())
        joined = salted_join(many, lookup, ["k"], "left").withColumn("p", F.spark_partition_id())
        largest = [
            joined.where(where).groupBy("p").count().agg(F.max("count")).first()[0]
            for where in ("k = 7", "k is null")
        ]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert largest[0] < 450 and largest[1] < 250


def test_small_lookup_is_broadcast_and_large_one_is_not(tables):
    facts, lookup = tables
    small = lookup_join(facts, lookup, ["k"])._jdf.queryExecution().toString()
    large = lookup_join(facts, lookup, ["k"], broadcast_bytes=10)._jdf.queryExecution().toString()
    assert "strategy=broadcast" in small
    assert "strategy=broadcast" not in large and "_salt" in large


def test_folder_without_a_setting():
    settings = {"spark.checkpoint.dir": "", "spark.master": "local[2]"}
    fake = type("Session", (), {"conf": settings})
    folder = shared_folder(fake)
    assert folder == shared_folder(fake) and "towerlens-" in folder
    settings["spark.master"] = "yarn"
    with pytest.raises(ValueError):
        shared_folder(fake)


def test_written_tables_lie_in_the_shared_folder(spark, tables, rows):
    _, lookup = tables
    copy = written(lookup, "copy")
    assert rows(copy) == rows(lookup)
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert all(shared_folder(spark) in path for path in copy.inputFiles())


def test_written_tables_are_forgotten(spark, tables):
    copy = written(tables[1], "copy")
    path = copy.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path)
    assert forget_written(spark) >= 1 and not os.path.exists(path)
    assert forget_written(spark) == 0


def test_bucketed_tables_are_forgotten(spark):
    table = written_in_buckets(spark.range(10).toDF("k"), "some-rows", 4, "k")
    assert table.count() == 10 and any(t.name.startswith("some_rows_") for t in spark.catalog.listTables())
    assert forget_written(spark) >= 1
    assert not any(t.name.startswith("some_rows_") for t in spark.catalog.listTables())
