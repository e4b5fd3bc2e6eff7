import datetime

import pytest
from pyspark.sql import functions as F

from towerlens import fixed
from towerlens.functions.columns import comma_double, comma_text
from towerlens.plans.analyses import cell_layers
from towerlens.plans.queries import KPI_TYPES
from towerlens.sources import delimited, standins

# The JVM interprets methods of more bytes.
COMPILED = 8000


@pytest.fixture
def largest_method(spark):
    """Bytes of the largest method that Spark generates for a plan."""

    def largest(df):
        stages = df._jdf.queryExecution().debug().codegenToSeq()
        return max(stages.apply(place)._3().maxMethodCodeSize() for place in range(stages.size()))

    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield largest
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)


@pytest.fixture
def kpi(spark, tmp_path):
    day = datetime.datetime(2002, 3, 1)
    rows = [(1, 7, 1, 10.5, 99.25, 0.5, 0.25, "A", "F", day), (2, 8, 6, 11.0, 99.75, 0.0, 0.5, "R", "O", day)]
    names = "l_orderkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate"
    spark.createDataFrame(rows, names.split()).write.parquet(f"{tmp_path}/lineitem.parquet")
    return standins.cell_kpi(spark, str(tmp_path)).select(*KPI_TYPES)


def test_reading_a_wide_table_is_compiled(spark, kpi, tmp_path, largest_method, rows):
    path = f"{tmp_path}/kpi-csv"
    delimited.write_delimited(kpi, path)
    read = delimited.read_typed(spark, path, KPI_TYPES)
    assert rows(read) == rows(kpi)
    layers = cell_layers(read)
    assert largest_method(layers) < COMPILED
    assert rows(layers) == [(7, "2G"), (8, "4G")]


def test_writing_a_wide_table_is_compiled(kpi, largest_method):
    texts = kpi.select(*[comma_text(F.col(name)).alias(name) for name in fixed.KPI_COLUMNS])
    assert largest_method(texts) < COMPILED


@pytest.mark.parametrize(
    "text, number",
    [("INF", float("inf")), ("-Infinity", float("-inf")), ("+nan", None), ("-NaN", None), ("1,5F ", None), ("1D", None),
     ("0x1p3", 8.0), ("1,5\t", 1.5), (",5", 0.5), ("5,", 5.0), ("1,e1", 10.0), ("inf,", None), ("1e400", float("inf"))],
)
def test_odd_numbers(spark, text, number):
    assert spark.createDataFrame([(text,)], "v string").select(comma_double(F.col("v"))).first()[0] == number
