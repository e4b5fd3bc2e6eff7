"""Keys whose measurements are far from those of the others."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from towerlens.operators.coverage import long_form


def anomalous_keys(
    df: DataFrame, key: str, metrics: Sequence[str], threshold: float = 3.0
) -> DataFrame:
    """Keys whose mean of a metric lies more than ``threshold`` standard deviations from the mean of
    all keys, one row per key and metric."""
    means = (
        df.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.avg(m).alias(m) for m in metrics])
    )
    values = long_form(means, key, metrics).where(F.col("VALUE").isNotNull())
    usual = values.groupBy("METRIC").agg(
        F.avg("VALUE").alias("mean"), F.stddev_pop("VALUE").alias("deviation")
    )
    # One row per metric: its size is that of the column list.
    return (
        values.join(F.broadcast(usual), "METRIC")
        .withColumn("Z", F.try_divide(F.col("VALUE") - F.col("mean"), F.col("deviation")))
        .where(F.abs("Z") > threshold)
        .select(key, "METRIC", "VALUE", "Z")
    )


def anomaly_counts(anomalies: DataFrame, key: str, at_least: int = 1) -> DataFrame:
    """Keys with anomalies in at least so many metrics."""
    return (
        anomalies.groupBy(key)
        .agg(F.count("*").alias("N_METRICS"), F.max(F.abs("Z")).alias("MAX_Z"))
        .where(F.col("N_METRICS") >= at_least)
    )
