"""One row per subscriber, and its comparison by survey answer."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def subject_summary(
    features: DataFrame,
    subject: str,
    amount: str,
    label: str,
    labels: Sequence[str],
    day: Column,
    tie: Column | None = None,
) -> DataFrame:
    """Per subject: row count, mean amount (nulls skipped), last known label.

    The last label is that of the latest ``day``, of equal days that of the largest ``tie`` (a whole number from
    0, if given), and of equal ones the last in the order of ``labels``; other labels count as unknown, and so
    do rows without a day. Day, tie and place in ``labels`` are packed into one number, so that its maximum is a
    hash aggregate that is combined before the shuffle.
    """
    since = F.date_diff(day, F.lit("0001-01-01").cast("date")).cast("decimal(7,0)")
    later = F.coalesce(tie, F.lit(0)).cast("decimal(19,0)") if tie is not None else F.lit(0).cast("decimal(19,0)")
    place = F.array_position(F.array(*[F.lit(name) for name in labels]), F.col(label))
    packed = (since * F.lit("1" + 19 * "0").cast("decimal(20,0)") + later) * F.lit(1000).cast("decimal(4,0)") + place
    packed = F.when(place > 0, packed.cast("decimal(38,0)"))
    summary = (
        features.where(F.col(subject).isNotNull())
        .groupBy(subject)
        .agg(F.count("*").alias("CNT_MONTHS"), F.avg(amount).alias("AVG_REVENUE"), F.max(packed).alias("last"))
    )
    names = F.array(*[F.lit(name) for name in labels])
    last = F.get(names, (F.col("last") % 1000).cast("int") - 1).alias(label)
    return summary.select(subject, "CNT_MONTHS", "AVG_REVENUE", last)


def feature_mart(
    answers: DataFrame, summary: DataFrame, traffic: DataFrame, subject: str
) -> DataFrame:
    """Subjects found in all three tables, one row each."""
    return answers.join(summary, subject).join(traffic, subject)


def compare_by_outcome(
    mart: DataFrame, outcome: str, metric: str, where: Column | None = None
) -> DataFrame:
    """Mean of a metric per outcome, over the rows that meet a condition."""
    rows = mart if where is None else mart.where(where)
    return (
        rows.where(F.col(outcome).isNotNull())
        .groupBy(outcome)
        .agg(F.avg(metric).alias("MEAN"), F.count("*").alias("N"))
        .orderBy(outcome)
    )
