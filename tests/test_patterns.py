"""Null patterns against plain counts of rows."""

import random
from collections import Counter

import pytest

from towerlens.operators import patterns


@pytest.fixture
def table(spark):
    """Rows over 130 columns, more than one number holds; columns 62, 63, 64 are at the seams."""
    chance = random.Random(2)
    names = [f"c{n}" for n in range(130)]
    kinds = [[1 if chance.random() < 0.5 or n in seam else None for n in range(130)] for seam in ([62], [63], [64], [0, 129])]
    rows = [(chance.choice(["a", None, "b"]), *chance.choice(kinds)) for _ in range(300)]
    return names, rows, spark.createDataFrame(rows, "g string, " + ", ".join(f"{name} int" for name in names))


def filled(names, row):
    return ",".join(name for name, value in zip(names, row) if value is not None)


def test_patterns_over_many_columns(table):
    names, rows, df = table
    wanted = Counter(filled(names, row[1:]) for row in rows)
    found = patterns.null_pattern_columns(df, names).collect()
    assert {row.FILLED: row.N for row in found} == wanted
    assert all(row.N_FILLED == len(row.FILLED.split(",")) and row.SHARE == row.N / 300 for row in found)


def test_patterns_by_group_with_a_null_group(table):
    names, rows, df = table
    wanted = Counter((row[0], filled(names[:70], row[1:71])) for row in rows)
    found = patterns.null_pattern_columns(df, names[:70], ["g"]).collect()
    assert {(row.g, row.FILLED): row.N for row in found} == wanted
    sizes = Counter(row[0] for row in rows)
    assert all(abs(row.SHARE - row.N / sizes[row.g]) < 1e-12 for row in found)


def test_each_group_has_its_own_columns(table):
    names, rows, df = table
    own = {"a": names[:3] + names[61:66], "b": names[2:5] + names[120:]}
    found = patterns.patterns_by_group(df, "g", own).collect()
    wanted = Counter()
    for group, *values in rows:
        if group in own:
            has = [name for name, value in zip(names, values) if value is not None and name in own[group]]
            wanted[group, ",".join(has)] += 1
    assert {(row.g, row.FILLED): row.N for row in found} == wanted


def test_sketches_of_parts_merge_to_the_counts(table):
    names, rows, df = table
    stored = patterns.pattern_sketches(df, names[:60], "g")
    assert stored.count() == 3 and dict(stored.dtypes)["N"] == "bigint"
    wanted = Counter(filled(names[:60], row[1:61]) for row in rows)
    found = patterns.frequent_patterns(stored, names[:60], 50).collect()
    assert {row.FILLED: row.N for row in found} == wanted
    assert patterns.frequent_patterns(stored, names[:60], 1).count() == 1


def test_missing_together(table):
    names, rows, df = table
    few = names[60:66]
    found = {(row.X, row.Y): row for row in patterns.missing_together(df, few).collect()}
    assert len(found) == 15
    for (x, y), row in found.items():
        i, j = names.index(x) + 1, names.index(y) + 1
        no_x, no_y = sum(r[i] is None for r in rows), sum(r[j] is None for r in rows)
        both = sum(r[i] is None and r[j] is None for r in rows)
        assert (row.MISSING_X, row.MISSING_Y, row.MISSING_BOTH) == (no_x, no_y, both)
        either = no_x + no_y - both
        assert row.OVERLAP == (both / either if either else None)


def test_empty_table(table):
    names, _, df = table
    none = df.limit(0)
    assert patterns.null_pattern_columns(none, names).count() == 0
    assert patterns.frequent_patterns(patterns.pattern_sketches(none, names[:5], "g"), names[:5], 3).count() == 0
