import pytest

from towerlens.sources import delimited as d

TYPES = {"SK_ID": "bigint", "REVENUE": "double", "CODE": "int", "T": "string"}


@pytest.fixture
def path(tmp_path):
    file = tmp_path / "first.csv"
    file.write_text(
        "SK_ID;T;REVENUE;CODE;OTHER\n1;01.03;99,93;2,0;x\n2;NA;;3;\n3;02.03;junk;x;null\n4;02.03;-1e3;1;y\n"
    )
    return str(file)


def test_typed_scan(spark, path, rows):
    df = d.read_typed(spark, path, TYPES)
    assert dict(df.dtypes) == {**TYPES, "OTHER": "string"}
    assert rows(df) == [
        (1, "01.03", 99.93, 2, "x"), (2, None, None, 3, None), (3, "02.03", None, None, None),
        (4, "02.03", -1000.0, 1, "y"),
    ]


def test_scan_reads_only_the_columns_asked_for(spark, path):
    plan = d.read_typed(spark, path, TYPES).select("REVENUE")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<REVENUE:string>" in plan


def test_parse_failures(spark, path, rows):
    failures = d.parse_failures(d.read_raw(spark, path), TYPES)
    assert dict(rows(failures)) == {"SK_ID": 0, "REVENUE": 1, "CODE": 1, "T": 0}


def test_preview(spark, path):
    assert d.preview(spark, path, 2).count() == 2
    assert d.preview(spark, path).columns == ["SK_ID", "T", "REVENUE", "CODE", "OTHER"]


def test_train_and_test_with_other_columns(spark, path, tmp_path, rows):
    test = tmp_path / "second.csv"
    test.write_text("REVENUE;SK_ID\n5,5;9\n")
    both = d.read_train_test(spark, path, str(test), TYPES)
    assert rows(both.where("SPLIT = 'test'").select("SK_ID", "REVENUE", "T")) == [(9, 5.5, None)]
    assert both.count() == 5


def test_round_trip(spark, tmp_path, rows):
    df = spark.createDataFrame(
        [(1, 0.1, "a"), (2, None, None), (3, 1.5e10, "b;c"), (4, 1e-7, "d")],
        "SK_ID long, REVENUE double, T string",
    )
    out = str(tmp_path / "out")
    d.write_delimited(df, out)
    assert rows(d.read_typed(spark, out, TYPES)) == rows(df)


def test_position_keeps_the_order_of_the_lines(spark, tmp_path):
    file = tmp_path / "lines.csv"
    ids = [(i * 7919) % 20011 for i in range(20000)]
    file.write_text("SK_ID\n" + "".join(f"{i}\n" for i in ids))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        df = d.with_position(d.read_raw(spark, str(file)))
        assert df.rdd.getNumPartitions() > 3
        shuffled = df.repartition(5, "SK_ID").orderBy("POSITION")
        assert [int(r.SK_ID) for r in shuffled.collect()] == ids
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_damaged_lines(spark, tmp_path):
    good, bad = tmp_path / "in" / "good", tmp_path / "in" / "bad"
    good.mkdir(parents=True)
    bad.mkdir()
    (good / "part-0.csv").write_text('A;B;C\n1;2;3\n"x;y";2;3\n;;\n')
    (bad / "part-0.csv").write_text("A;B;C\n1;2\n1;2;3;4\n1;2;3\n")
    (bad / "part-1.csv").write_text('A;C;B\n1;"2;3\n4;5;6\n"a;b";1\n')
    (bad / "part-2.csv").write_text("")
    found = {row.FOLDER: tuple(row)[1:] for row in d.line_damage(spark, str(tmp_path / "in"), ["A", "B", "C"]).collect()}
    # lines, damaged, few, many, quotes, blank, other headers
    assert found == {"good": (3, 0, 0, 0, 0, 1, 0), "bad": (6, 4, 2, 1, 1, 0, 1)}


def test_parts_go_by_their_number(spark, tmp_path):
    for number, text in ((99999, "a"), (100000, "b"), (7, "c")):
        (tmp_path / f"part-{number:05}-x.csv").write_text(f"V\n{text}\n")
    lines = d.with_position(d.read_raw(spark, str(tmp_path)))
    assert [row.V for row in lines.orderBy("POSITION").collect()] == ["c", "a", "b"]


def test_preview_is_no_sort(spark, tmp_path):
    spark.range(50).selectExpr("id AS A", "id AS B").write.option("sep", ";").option("header", True).csv(str(tmp_path / "t"))
    shown = d.preview(spark, str(tmp_path / "t"), 4)
    plan = shown._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan and "CollectLimit" in plan
    assert shown.count() == 4 and shown.columns == ["A", "B"]
