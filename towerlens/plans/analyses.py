"""The four analyses: cell layers, phone layers, important cells, exposure to the wrong layer."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from towerlens import fixed
from towerlens.functions.columns import short_date
from towerlens.operators.coverage import assign_group_by_coverage, split_by_group
from towerlens.operators.labels import label_codes_by_metric, mean_by_code, with_derived_label, with_label
from towerlens.operators.layers import traffic_by_layer
from towerlens.operators.mart import compare_by_outcome, feature_mart, subject_summary
from towerlens.operators.profile import prune_low_cardinality, prune_missing
from towerlens.operators.usage import top_cells

CELL = "CELL_LAC_ID"
SUBSCRIBER = "SK_ID"
CELL_ROW = ["T_DATE", "CELL_LAC_ID"]


def cell_layers(kpi: DataFrame) -> DataFrame:
    """Network layer of every cell, by the KPI columns it fills."""
    return assign_group_by_coverage(kpi, CELL, fixed.SCORED_BY_LAYER)


def kpi_by_layer(kpi: DataFrame, id_columns: Sequence[str] = CELL_ROW) -> dict[str, DataFrame]:
    """The KPI table split into one table per layer, availability included again."""
    return split_by_group(kpi, cell_layers(kpi), CELL, fixed.KPI_BY_LAYER, id_columns)


def pruned_by_layer(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The layer tables without the columns known to be mostly missing or to have few values."""
    three = prune_missing(tables["3G"], fixed.KPI_3G, drop=fixed.MOSTLY_MISSING_3G)
    four = prune_missing(tables["4G"], fixed.KPI_4G, drop=fixed.MOSTLY_MISSING_4G)
    kept = [c for c in four.columns if c in fixed.KPI_4G]
    return {
        "2G": tables["2G"],
        "3G": three,
        "4G": prune_low_cardinality(four, kept, drop=fixed.FEW_VALUES_4G),
    }


def with_snapshot_month(features: DataFrame) -> DataFrame:
    """Features with MONTH, the first day of the month of their snapshot; as it is where it's there already."""
    if "MONTH" in features.columns:
        return features
    return features.withColumn("MONTH", F.trunc(short_date(F.col("SNAP_DATE")), "month"))


def last_month(features: DataFrame) -> DataFrame:
    """The features of the last month there is."""
    features = with_snapshot_month(features)
    return features.where(F.col("MONTH") == features.agg(F.max("MONTH")).scalar())


def last_month_means(features: DataFrame, usage: DataFrame) -> DataFrame:
    """Mean data volume per device code in the last month of the features."""
    same_month = F.col("MONTH") == features.agg(F.max("MONTH")).scalar()
    return mean_by_code(
        last_month(features),
        usage.where(same_month),
        [SUBSCRIBER],
        "INTERNET_TYPE_ID",
        "SUM_DATA_MB",
    )


def means_of_same_month(features: DataFrame, usage: DataFrame) -> DataFrame:
    """Mean data volume per device code over rows of one subscriber and month of the year.

    It needs the columns of the files only: the month is that of SNAP_DATE and that of MON, which has no year.
    """
    snapshot = F.month(short_date(F.col("SNAP_DATE")))
    return mean_by_code(
        features.withColumn("MONTH_NO", snapshot),
        usage.withColumn("MONTH_NO", F.substring("MON", 4, 2).try_cast("int")),
        [SUBSCRIBER, "MONTH_NO"],
        "INTERNET_TYPE_ID",
        "SUM_DATA_MB",
    )


def last_full_month_means(features: DataFrame, usage: DataFrame) -> DataFrame:
    """Mean data volume per device code in the last month in which every code has known traffic."""
    joined = [SUBSCRIBER, "MONTH"]
    holders = features.where("INTERNET_TYPE_ID IS NOT NULL").select(*joined, "INTERNET_TYPE_ID").distinct()
    used = usage.where("SUM_DATA_MB IS NOT NULL").select(*joined).distinct()
    codes = holders.join(used, joined).select("MONTH", "INTERNET_TYPE_ID").distinct()
    full = codes.groupBy("MONTH").agg(F.count("*").alias("n"))
    month = full.where(F.col("n") == codes.agg(F.countDistinct("INTERNET_TYPE_ID")).scalar()).agg(F.max("MONTH")).scalar()
    return mean_by_code(
        features.where(F.col("MONTH") == month), usage.where(F.col("MONTH") == month), [SUBSCRIBER], "INTERNET_TYPE_ID", "SUM_DATA_MB"
    )


def device_labels(means: DataFrame) -> DataFrame:
    """Device codes labelled with layers, slowest first."""
    return label_codes_by_metric(means, "INTERNET_TYPE_ID", fixed.LAYERS)


def with_derived_phone_layer(features: DataFrame, labelled: DataFrame) -> DataFrame:
    """Features with the layer found for their device code by its traffic."""
    return with_derived_label(features, labelled, "INTERNET_TYPE_ID", "PHONE_GEN")


def with_phone_layer(features: DataFrame) -> DataFrame:
    """Features with the layer the subscriber's device supports."""
    return with_label(features, "INTERNET_TYPE_ID", fixed.DEVICE_LAYER, "PHONE_GEN")


def important_cells(
    usage: DataFrame, measure: str, k: int = fixed.TOP_CELLS, subscriber: int | None = None
) -> DataFrame:
    """A subscriber's most important cells by minutes, megabytes or session time."""
    return top_cells(usage, SUBSCRIBER, CELL, measure, k, subscriber)


def subscriber_summary(features: DataFrame, tie: str | None = "SNAP_ID") -> DataFrame:
    """Months seen, mean revenue and last known phone layer per subscriber.

    Snapshots of one day are told apart by ``tie`` if the table has that column; what is equal still goes to
    the faster layer.
    """
    return subject_summary(
        with_phone_layer(features),
        SUBSCRIBER,
        "REVENUE",
        "PHONE_GEN",
        fixed.LAYERS,
        short_date(F.col("SNAP_DATE")),
        F.col(tie) if tie in features.columns else None,
    )


def exposure_mart(
    kpi: DataFrame, sessions: DataFrame, features: DataFrame, answers: DataFrame
) -> DataFrame:
    """One row per surveyed subscriber with data sessions: answer, summary, traffic by layer."""
    traffic = traffic_by_layer(sessions, cell_layers(kpi))
    return feature_mart(answers, subscriber_summary(features), traffic, SUBSCRIBER)


def layer_exposure_by_outcome(mart: DataFrame) -> DataFrame:
    """Mean hours in 2G of subscribers with a 4G phone, by survey answer."""
    return compare_by_outcome(mart, "CSI", "CNT_HOURS_2G", F.col("PHONE_GEN") == "4G")
