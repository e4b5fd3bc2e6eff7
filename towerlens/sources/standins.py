"""The analytic tables, derived from the provided star-schema Parquet files.

The provided data has no telecom tables, so each one is a projection of a provided table. The KPI
columns are produced by one rule (``kpi_expression``) written in SQL that Spark and other engines
read alike.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from towerlens import fixed

FLAG_OF_LAYER = {"2G": "A", "3G": "N", "4G": "R"}
BASE_MEASURES = ["l_discount", "l_tax", "l_quantity", "l_extendedprice"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kpi_expression(layer: str, position: int) -> str:
    """SQL for the KPI column at ``position`` in the layer's list, null wherever it is not reported."""
    measure = BASE_MEASURES[position % 4]
    weight = position // 4
    if weight:
        measure = f"{measure} + {weight} * {BASE_MEASURES[(position + 1) % 4]}"
    if position == 0:
        reported = "l_linestatus = 'F'"
    else:
        reported = f"l_returnflag = '{FLAG_OF_LAYER[layer]}' AND l_linenumber % {1 + position % 3} = 0"
    return f"CASE WHEN {reported} THEN {measure} END"


def kpi_select_list() -> list[str]:
    return [
        f"{kpi_expression(layer, position)} AS {column}"
        for layer, columns in fixed.KPI_BY_LAYER.items()
        for position, column in enumerate(columns)
    ]


def cell_kpi(spark: SparkSession, sf_dir: str, cell: str = "l_suppkey") -> DataFrame:
    """Cell x day KPI history; ROW_ID tells apart rows of the same cell and day.

    ``cell="l_orderkey"`` makes small cells, many of them with gaps, ties and no coverage at all.
    """
    return table(spark, sf_dir, "lineitem").selectExpr(
        "date_format(l_shipdate, 'dd.MM') AS T_DATE",
        "CAST(l_shipdate AS DATE) AS KPI_DATE",
        f"{cell} AS CELL_LAC_ID",
        "l_orderkey * 10 + l_linenumber AS ROW_ID",
        *kpi_select_list(),
    )


def channel_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second KPI table on the same cells, with its own columns."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey AS CELL_LAC_ID",
        "CASE WHEN l_linenumber > 1 THEN l_quantity END AS CHANNEL_LOAD",
        "CASE WHEN l_linestatus = 'O' THEN l_tax END AS CHANNEL_LOSS",
        "CASE WHEN l_discount > 0 THEN l_extendedprice END AS CHANNEL_VOLUME",
    )


def data_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscriber x cell x start hour data sessions."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("SK_ID"),
        (F.get_json_object("props", "$.k").try_cast("bigint") + 5).alias("CELL_LAC_ID"),
        F.date_format("ts", "dd.MM HH").alias("START_TIME"),
        F.col("value").alias("DATA_VOL_MB"),
    )


def voice_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscriber x cell x start hour calls."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("SK_ID"),
        F.col("l_suppkey").alias("CELL_LAC_ID"),
        F.date_format("l_shipdate", "dd.MM HH").alias("START_TIME"),
        F.col("l_quantity").alias("VOICE_MIN"),
    )


def subscriber_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscriber x monthly snapshot; SNAP_ID breaks ties between snapshots of one day."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("SK_ID"),
        F.date_format("o_orderdate", "dd.MM.yy").alias("SNAP_DATE"),
        F.trunc(F.col("o_orderdate").cast("date"), "month").alias("MONTH"),
        F.expr(
            "CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN"
            " CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 WHEN 'P' THEN 3 END END"
        ).alias("INTERNET_TYPE_ID"),
        F.col("o_totalprice").alias("REVENUE"),
        F.col("o_orderkey").alias("SNAP_ID"),
    )


def consumption(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscriber x cell x month voice minutes, data volume and data minutes."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("SK_ID"),
        F.col("l_suppkey").alias("CELL_LAC_ID"),
        F.date_format("l_shipdate", "'01.'MM").alias("MON"),
        F.trunc(F.col("l_shipdate").cast("date"), "month").alias("MONTH"),
        F.col("l_quantity").alias("SUM_MINUTES"),
        F.col("l_extendedprice").alias("SUM_DATA_MB"),
        (F.col("l_quantity") * F.col("l_discount")).alias("SUM_DATA_MIN"),
    )


def survey_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscriber and survey answer, 1 = dissatisfied."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("SK_ID"), (F.col("c_acctbal") < 0).cast("int").alias("CSI")
    )


def scored_subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscriber, a score in [0, 1], the true answer, and the place in the order to be kept."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("SK_ID"),
        (F.floor(F.col("c_acctbal") / 100) / 1000).alias("SCORE"),
        (F.col("c_mktsegment") == "BUILDING").cast("int").alias("CSI"),
        (-F.col("c_custkey")).alias("POSITION"),
    )
