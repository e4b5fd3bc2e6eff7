import pytest
from pyspark.sql import functions as F

from towerlens.operators import profile as p


@pytest.fixture
def df(spark):
    data = [(1, 0.0, None, "x"), (2, 5.0, 1.0, "y"), (2, 10.0, None, None), (None, 20.0, None, "x"),
            (3, 20.0, 1.0, "x")]
    return spark.createDataFrame(data, "code int, v double, w double, t string")


def test_table_profile(df, rows):
    assert rows(p.table_profile(df)) == [
        (0, "code", "int", 4), (1, "v", "double", 5), (2, "w", "double", 2), (3, "t", "string", 4)
    ]


def test_missing(df):
    assert [tuple(r) for r in p.missing_profile(df, ["code", "v", "w"]).collect()] == [
        ("w", 0.6), ("code", 0.2), ("v", 0.0)
    ]
    assert p.prune_missing(df, df.columns, max_share=0.5).columns == ["code", "v", "t"]
    assert p.prune_missing(df, df.columns, drop=["t"]).columns == ["code", "v", "w"]


def test_cardinality(df):
    counts = [("w", 1), ("t", 2), ("code", 3), ("v", 4)]
    assert [tuple(r) for r in p.cardinality_profile(df, df.columns).collect()] == counts
    approximate = p.cardinality_profile(df, df.columns, approximate=True)
    assert [tuple(r) for r in approximate.collect()] == counts
    assert p.prune_low_cardinality(df, df.columns, min_distinct=3).columns == ["code", "v"]
    assert p.prune_low_cardinality(df, df.columns, drop=["v"]).columns == ["code", "w", "t"]


def test_cardinality_of_an_empty_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "a double")
    assert [tuple(r) for r in p.cardinality_profile(df, ["a"]).collect()] == [("a", 0)]


def test_frequency(df):
    with_null = [(1, 1), (2, 2), (3, 1), (None, 1)]
    assert [tuple(r) for r in p.value_frequency(df, "code").collect()] == with_null
    without = [tuple(r) for r in p.value_frequency(df, "code", keep_null=False).collect()]
    assert without == with_null[:3]


def test_histogram(df, spark):
    bins = p.equal_width_histogram(df, "v", 20)
    filled = {r.BIN: r.N for r in bins.where("N > 0").collect()}
    assert filled == {1: 1, 6: 1, 11: 1, 20: 2}
    assert bins.count() == 20 and bins.agg(F.sum("N")).first()[0] == 5
    edges = bins.agg(F.min("LOWER"), F.max("UPPER")).first()
    assert tuple(edges) == (0.0, 20.0)
    same = spark.createDataFrame([(4.0,), (4.0,)], "v double")
    constant = p.equal_width_histogram(same, "v", 20)
    assert [tuple(r) for r in constant.where("N > 0").select("BIN", "N").collect()] == [(11, 2)]
    assert p.equal_width_histogram(same.where("false"), "v", 20).count() == 0


def test_items_per_subject(spark, rows):
    df = spark.createDataFrame(
        [(1, 10), (1, 10), (1, 11), (2, 10), (3, None), (None, 5)], "s int, i int"
    )
    assert rows(p.items_per_subject(df, "s", "i")) == [(1, 2), (2, 1), (3, 0)]
    by_count = p.items_per_subject_histogram(df, "s", "i", 2)
    assert [r.N for r in by_count.collect()] == [1, 2]
    by_frequency = p.items_per_subject_histogram(df, "s", "i", 2, of_frequencies=True)
    assert sum(r.N for r in by_frequency.collect()) == 3


def test_null_patterns(df):
    patterns = p.null_patterns(df, {"a": ["code", "w"], "b": ["t"]})
    assert [tuple(r) for r in patterns.collect()] == [(1, 1, 3), (1, 0, 1), (0, 1, 1)]


def test_presence_flags(df, rows):
    assert rows(p.presence_flags(df, ["v"], ["w"]).where("v = 5.0")) == [(5.0, 1)]


@pytest.mark.parametrize("approximate", [False, True])
def test_an_empty_table_has_no_values(df, approximate):
    columns = df.columns[:2]
    profile = p.cardinality_profile(df.limit(0), columns, approximate)
    assert {tuple(r) for r in profile.collect()} == {(c, 0) for c in columns}
    assert set(columns).isdisjoint(p.prune_low_cardinality(df.limit(0), columns, min_distinct=1).columns)


def test_profiles_of_groups_equal_those_of_their_rows(spark):
    data = [("x", 1, 1.0, None), ("x", 1, 2.0, None), ("y", None, 3.0, "t"), ("y", 2, 3.0, "u"), ("z", 9, 9.0, "v"), (None, 1, 1.0, "w")]
    df = spark.createDataFrame(data, "g string, a int, b double, c string")
    own = {"x": ["a", "c"], "y": ["a", "b", "c"], "empty": ["b"]}
    missing = {(r.g, r.METRIC): r.SHARE for r in p.group_missing_profile(df, "g", own).collect()}
    values = {(r.g, r.METRIC): r.N_DISTINCT for r in p.group_cardinality_profile(df, "g", own).collect()}
    assert set(missing) == set(values) == {(g, c) for g, columns in own.items() for c in columns}
    for group in ("x", "y"):
        rows = df.where(df.g == group)
        assert {c: missing[group, c] for c in own[group]} == {r.METRIC: r.SHARE for r in p.missing_profile(rows, own[group]).collect()}
        assert {c: values[group, c] for c in own[group]} == {r.METRIC: r.N_DISTINCT for r in p.cardinality_profile(rows, own[group]).collect()}
    assert missing["empty", "b"] is None and values["empty", "b"] == 0
