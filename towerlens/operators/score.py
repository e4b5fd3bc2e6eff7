"""Judging and delivering scores."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from towerlens import fixed
from towerlens.functions.columns import number_array, percent_slot, range_number
from towerlens.sources.workspace import written

# Ranges of scores for each shuffle partition.
RANGES = 4


def roc_auc(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve, exact, ties counted half; per group if ``by`` names columns.

    Equal scores are merged first. The merged scores are cut at approximate quantiles into ranges, as
    many as suit the shuffle partitions: the running count of negatives is a sum over lower ranges plus a
    window within each range, so no task has to hold all scores. The cuts only balance the work. The
    merged scores are written once, as the cuts, the sums and the windows all read them.
    """
    by = list(by)
    merged = (
        df.dropna(subset=[score, label, *by])
        .select(*by, F.col(score).cast("double").alias("score"), F.col(label).alias("label"))
        .groupBy(*by, "score")
        .agg(
            F.sum((F.col("label") == 1).cast("bigint")).alias("positive"),
            F.sum((F.col("label") == 0).cast("bigint")).alias("negative"),
        )
    )
    merged = written(merged, "merged-scores")
    parts = RANGES * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = number_array([place / parts for place in range(1, parts)], "double")
    cuts = merged.agg(F.percentile_approx("score", shares, 10 * parts).alias("cuts")).first().cuts
    ranged = merged.withColumn("range", range_number(F.col("score"), sorted(set(cuts or [])), "double"))
    ranges = ranged.groupBy(*by, "range").agg(F.sum("negative").alias("negative"))
    # One row per range and group.
    before = Window.partitionBy(*by).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select(
        *by, "range", F.coalesce(F.sum("negative").over(before), F.lit(0)).alias("offset")
    )
    within = (
        Window.partitionBy(*by, "range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    )
    below = F.col("offset") + F.coalesce(F.col("inside"), F.lit(0)) + F.col("negative") / 2
    return (
        ranged.withColumn("inside", F.sum("negative").over(within))
        .join(offsets, [*by, "range"])
        .groupBy(*by)
        .agg(
            F.sum("positive").alias("N_POSITIVE"),
            F.sum("negative").alias("N_NEGATIVE"),
            F.try_divide(
                F.sum(F.col("positive") * below),
                F.sum("positive").cast("double") * F.sum("negative").cast("double"),
            ).alias("AUC"),
        )
    )


def with_scoring_split(
    df: DataFrame, key: str, percent: int = fixed.PRELIMINARY_PERCENT
) -> DataFrame:
    """Marks rows as preliminary or final, by the key alone."""
    preliminary = percent_slot(F.col(key)) < percent
    return df.withColumn(
        "SCORING", F.when(preliminary, F.lit("preliminary")).otherwise(F.lit("final"))
    )


def scores_in_order(
    wanted: DataFrame, scores: DataFrame, key: str, position: str, score: str
) -> DataFrame:
    """A score for every wanted row, in the order its position column gives."""
    return (
        wanted.select(key, position)
        .join(scores.select(key, score), key, "left")
        .orderBy(position)
        .select(position, key, score)
    )
