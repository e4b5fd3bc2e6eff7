import datetime

import pytest

from towerlens.operators import usage as u


@pytest.fixture
def usage(spark):
    data = [(1, 10, 5.0, 1.0), (1, 10, 5.0, 1.0), (1, 11, 10.0, 9.0), (1, 12, -4.0, 3.0),
            (1, 13, 1.0, None), (2, 10, None, 2.0), (2, 11, 0.0, 0.0), (None, 11, 3.0, 3.0),
            (3, 12, 2.0, 1.0)]
    return spark.createDataFrame(data, "s int, c int, mb double, min double")


def test_top_cells(usage, rows):
    # 10 and 11 tie at 10.0: the smaller id comes first. Only positive values count.
    assert rows(u.top_cells(usage, "s", "c", "mb", 2)) == [
        (1, 10, 10.0, 1), (1, 11, 10.0, 2), (3, 12, 2.0, 1)
    ]
    assert [tuple(r) for r in u.top_cells(usage, "s", "c", "mb", 2, only=1).collect()] == [
        (1, 10, 10.0), (1, 11, 10.0)
    ]


def test_top_cells_keeps_few_rows_of_a_subject_before_the_shuffle(usage):
    plan = u.top_cells(usage, "s", "c", "mb", 30)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_rank_disagreement(usage, rows):
    got = rows(u.rank_disagreement(usage, "s", "c", ("mb", "min"), 2))
    # subject 1: by mb 10, 11; by min 11, 12. Subject 2 has no positive mb.
    assert got == [(1, 2, 2, 1, 1.0, 1, 0), (2, 0, 1, 0, None, None, None), (3, 1, 1, 1, 0.0, 0, 1)]


def test_cell_presence(spark, rows):
    data = [(1, 10, "01.03 10"), (1, 10, "01.03 11"), (1, 10, "02.03 10"), (1, 11, "02.03 12"),
            (1, 11, "05.03 12"), (2, 10, None), (None, 10, "01.03 10")]
    sessions = spark.createDataFrame(data, "s int, c int, t string")
    got = rows(u.cell_presence(sessions, "s", "c", "t").select("s", "c", "N_DAYS", "ACTIVE_DAYS"))
    assert got == [(1, 10, 2, 3), (1, 11, 2, 3)]


def test_metric_history(spark):
    data = [(1, "15.04", 1.0), (1, "02.05", 2.0), (1, "30.01", None), (2, "01.01", 3.0)]
    df = spark.createDataFrame(data, "cell int, d string, v double")
    history = [tuple(r) for r in u.metric_history(df, "cell", "d", "v", only=1).collect()]
    assert history == [
        (1, datetime.date(2002, 1, 30), None),
        (1, datetime.date(2002, 4, 15), 1.0),
        (1, datetime.date(2002, 5, 2), 2.0),
    ]
    assert [r.cell for r in u.metric_history(df, "cell", "d", "v").collect()] == [1, 1, 1, 2]
    assert u.missing_rows(df, "v", ["d"]).collect()[0].d == "30.01"
