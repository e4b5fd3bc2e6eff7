"""Every query against its SQL counterpart; those without one against their own meaning."""

import os

import compare
import pytest

import __spark_entry__ as contract
from towerlens.operators.usage import metric_history
from towerlens.plans import analyses
from towerlens.plans.oracles import ORACLES
from towerlens.plans.queries import QUERIES
from towerlens.sources import standins

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# Each has a form with a known answer that has SQL.
WITHOUT_SQL = {
    "kpi_components", "kpi_components_3g", "kpi_components_4g", "cell_clusters", "outcome_scores", "outcome_auc",
    "out_of_fold_scores", "out_of_fold_auc", "joint_anomalies", "kpi_fences", "distinct_counts_sketched",
}
# An empty result is one, too.
MAY_BE_EMPTY = {"joint_anomalies"}


@pytest.fixture(scope="module")
def database():
    connection = compare.database(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_sql_or_a_test_of_its_own():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL
    assert set(ORACLES) <= set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, database, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "Python" not in plan and ("InArrow" in plan) == name.startswith(("correlation", "component_checks"))
    got = compare.rows_of(df)
    wanted = compare.expected(database, ORACLES[name])
    assert sorted(got.columns) == sorted(wanted.columns)
    assert compare.canonical(got) == compare.canonical(wanted)


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0 or name in MAY_BE_EMPTY


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["CSI", "MEAN", "N"]
    assert result.count() == 2


def test_only_needed_columns_are_read(spark, tmp_path):
    path = str(tmp_path / "kpi")
    standins.cell_kpi(spark, SF_DIR).write.parquet(path)
    plan = plan_of(analyses.cell_layers(spark.read.parquet(path)))
    assert "CSSR_2G" in plan and "CELL_AVAILABILITY" not in plan and "T_DATE" not in plan
    one_cell = analyses.CELL + " = 5"
    plan = plan_of(spark.read.parquet(path).where(one_cell).select("T_DATE"))
    assert "EqualTo(CELL_LAC_ID,5)" in plan


def test_one_subscriber(spark, rows):
    usage = standins.consumption(spark, SF_DIR)
    every = analyses.important_cells(usage, "SUM_DATA_MB")
    one = analyses.important_cells(usage, "SUM_DATA_MB", subscriber=7)
    cells = ["SK_ID", "CELL_LAC_ID"]
    assert rows(one.select(cells)) == rows(every.where("SK_ID = 7").select(cells))


def test_one_cell(spark):
    kpi = standins.cell_kpi(spark, SF_DIR)
    history = metric_history(kpi, "CELL_LAC_ID", "T_DATE", "DL_VOLUME_LTE", only=5)
    dates = [row.DATE for row in history.collect() if row.DATE]
    assert len(dates) > 100 and dates == sorted(dates)


@pytest.mark.parametrize(
    ("name", "table", "scans"),
    [
        ("missing_share", "lineitem", 1),
        ("channel_missing_share", "lineitem", 1),
        ("conflict_rows", "lineitem", 1),
        ("rank_disagreement", "lineitem", 1),
        ("cell_presence", "events", 0),
    ],
)
def test_tables_are_scanned_once(spark, name, table, scans):
    """What is looked up or counted twice was written before."""
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count(f"{table}.parquet") == scans


def test_no_sort_for_the_last_known_value(spark):
    assert "SortAggregate" not in plan_of(QUERIES["subject_summary"](spark, SF_DIR))
