import random

import pytest

from towerlens.operators import coverage as c

GROUPS = {"2G": ["a1", "a2"], "3G": ["b1", "b2"], "4G": ["c1"]}
SCHEMA = "cell long, day string, a1 double, a2 double, b1 double, b2 double, c1 double"


def cell_rows(cell, a, b, c_):
    """Rows in which a1, b1, c1 are filled as often as asked for."""
    n = max(a, b, c_, 1)
    return [
        (cell, f"{i:02}.01", *[1.0 if i < k else None for k in (a,)], None,
         1.0 if i < b else None, None, 1.0 if i < c_ else None)
        for i in range(n)
    ]


@pytest.fixture
def kpi(spark):
    scores = {1: (0, 0, 0), 2: (1, 5, 5), 3: (0, 2, 1), 4: (3, 3, 0), 5: (0, 0, 2), 6: (4, 0, 0)}
    data = [row for cell, score in scores.items() for row in cell_rows(cell, *score)]
    data.append((None, "01.01", 1.0, 1.0, 1.0, 1.0, 1.0))
    random.Random(1).shuffle(data)
    return spark.createDataFrame(data, SCHEMA)


def test_assignment(kpi, rows):
    assigned = [(1, "2G"), (2, "3G"), (3, "3G"), (4, "2G"), (5, "4G"), (6, "2G")]
    assert rows(c.assign_group_by_coverage(kpi, "cell", GROUPS)) == assigned
    left_out = c.assign_group_by_coverage(kpi, "cell", GROUPS, empty_as_first=False)
    assert rows(left_out)[0] == (1, None)


def test_score_is_the_best_column_not_the_sum(spark, rows):
    df = spark.createDataFrame(
        [(1, "d", 1.0, 1.0, 1.0, None, None), (1, "e", None, None, 1.0, None, None)], SCHEMA
    )
    assert rows(c.coverage_scores(df, "cell", GROUPS)) == [(1, 1, 2, 0)]
    assert rows(c.assign_group_by_coverage(df, "cell", GROUPS)) == [(1, "3G")]


def test_conflicts(kpi, rows):
    conflicts = [(2, 1, 5, 5, 3), (3, 0, 2, 1, 2), (4, 3, 3, 0, 2)]
    assert rows(c.coverage_conflicts(kpi, "cell", GROUPS)) == conflicts
    with_gaps = [(1, 0, 0, 0, 0), *conflicts]
    assert rows(c.coverage_conflicts(kpi, "cell", GROUPS, include_uncovered=True)) == with_gaps
    scores = c.coverage_scores(kpi, "cell", GROUPS)
    assert rows(c.shared_keys(scores, "cell", list(GROUPS))) == [(2,), (3,), (4,)]


def test_split_is_disjoint_and_whole(kpi, rows):
    assignment = c.assign_group_by_coverage(kpi, "cell", GROUPS)
    tables = c.split_by_group(kpi, assignment, "cell", GROUPS, ["day", "cell"])
    assert tables["2G"].columns == ["day", "cell", "a1", "a2"]
    assert tables["4G"].columns == ["day", "cell", "c1"]
    cells = [{cell for (cell,) in rows(t.select("cell"))} for t in tables.values()]
    assert cells == [{1, 4, 6}, {2, 3}, {5}]
    assert sum(t.count() for t in tables.values()) == kpi.where("cell is not null").count()


def test_rows_of_keys_and_long_form(kpi, rows):
    conflicts = c.coverage_conflicts(kpi, "cell", GROUPS)
    assert {r[0] for r in rows(c.rows_of_keys(kpi, conflicts, "cell").select("cell"))} == {2, 3, 4}
    assert rows(c.long_form(conflicts, "cell", ["2G", "4G"]))[:2] == [(2, "2G", 1), (2, "4G", 5)]
