"""What an opaque code means, judged by the traffic behind it."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from towerlens.functions.columns import code_label


def _known(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def mean_by_code(
    features: DataFrame, usage: DataFrame, on: Sequence[str], code: str, metric: str
) -> DataFrame:
    """Mean of ``metric`` per code over the joined rows.

    Both sides are brought down to one row per join key first (a multiplicity on one, sum and count
    on the other), so no join key is heavy and the joined rows are never produced.
    """
    on = list(on)
    holders = _known(features, [*on, code]).groupBy(*on, code).agg(F.count("*").alias("times"))
    used = usage.groupBy(*on).agg(F.sum(metric).alias("total"), F.count(metric).alias("known"))
    return (
        holders.join(used, on)
        .groupBy(code)
        .agg(
            F.try_divide(
                F.sum(F.col("times") * F.col("total")), F.sum(F.col("times") * F.col("known"))
            ).alias("MEAN"),
            F.sum(F.col("times") * F.col("known")).alias("N"),
        )
        .orderBy(code)
    )


def mean_per_subject_by_code(
    features: DataFrame, usage: DataFrame, subject: str, code: str, metric: str
) -> DataFrame:
    """Mean over subjects of their summed ``metric``, by the codes a subject has had."""
    holders = _known(features, [subject, code]).select(subject, code).distinct()
    used = usage.groupBy(subject).agg(F.coalesce(F.sum(metric), F.lit(0.0)).alias("total"))
    return (
        holders.join(used, subject)
        .groupBy(code)
        .agg(F.avg("total").alias("MEAN"), F.count("*").alias("N_SUBJECTS"))
        .orderBy(code)
    )


def label_codes_by_metric(means: DataFrame, code: str, labels: Sequence[str]) -> DataFrame:
    """All codes; in ascending order of their mean they get the labels in the given order.

    Codes beyond the labels and codes without a mean have none.
    """
    lowest = means.where(F.col("MEAN").isNotNull()).orderBy("MEAN", code).limit(len(labels))
    # Not more rows than labels reach this window, and the broadcast.
    place = F.row_number().over(Window.orderBy("MEAN", code))
    names = F.array(*[F.lit(label) for label in labels])
    labelled = lowest.select(F.col(code).alias("labelled_code"), F.get(names, place - 1).alias("LABEL"))
    same = F.col(code).eqNullSafe(F.col("labelled_code"))
    return means.join(F.broadcast(labelled), same, "left").drop("labelled_code")


def with_derived_label(df: DataFrame, labelled: DataFrame, code: str, label: str) -> DataFrame:
    """Adds the label that ``label_codes_by_metric`` found for each row's code, null for codes without one."""
    known = labelled.where(F.col("LABEL").isNotNull()).select(F.col(code).alias("labelled_code"), F.col("LABEL").alias(label))
    # One row per label.
    return df.join(F.broadcast(known), F.col(code) == F.col("labelled_code"), "left").drop("labelled_code")


def with_label(df: DataFrame, code: str, labels: Mapping, label: str) -> DataFrame:
    """Adds the label of each row's code, null for codes without one."""
    return df.withColumn(label, code_label(F.col(code), labels))
