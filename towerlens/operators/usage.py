"""Which cells matter to a subscriber, and how a cell's measurements run over time."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from towerlens.functions.columns import date_of, day_of
from towerlens.operators.lookups import lookup_join
from towerlens.operators.rows import sorted_by_columns
from towerlens.sources.workspace import written


def top_cells(
    df: DataFrame, subject: str, item: str, measure: str, k: int, only: int | str | None = None
) -> DataFrame:
    """Per subject, the ``k`` items with the largest sum of the positive values of ``measure``.

    The sum is taken before ranking, and Spark keeps the best ``k`` of each subject in every task
    before it shuffles them, so a heavy subject sends few rows. ``only`` asks for one subject.
    """
    rows = df if only is None else df.where(F.col(subject) == only)
    totals = (
        rows.where((F.col(measure) > 0) & F.col(subject).isNotNull() & F.col(item).isNotNull())
        .groupBy(subject, item)
        .agg(F.sum(measure).alias("TOTAL"))
    )
    if only is not None:
        return totals.orderBy(F.desc("TOTAL"), item).limit(k)
    rank = F.row_number().over(Window.partitionBy(subject).orderBy(F.desc("TOTAL"), item))
    return totals.withColumn("PLACE", rank).where(F.col("PLACE") <= k)


def _place(subject: str, item: str, total: str) -> Column:
    """Place of an item among its subject's by ``total``, null where it has none."""
    order = Window.partitionBy(subject).orderBy(F.desc_nulls_last(total), item)
    return F.when(F.col(total).isNotNull(), F.row_number().over(order))


def rank_disagreement(
    df: DataFrame, subject: str, item: str, measures: tuple[str, str], k: int
) -> DataFrame:
    """Per subject, how far its top items by one measure differ from those by another.

    Both rankings are over the same totals, which are one row per subject and item.
    """
    one, other = (F.sum(F.when(F.col(measure) > 0, F.col(measure))) for measure in measures)
    totals = (
        df.where(F.col(subject).isNotNull() & F.col(item).isNotNull())
        .groupBy(subject, item)
        .agg(one.alias("one"), other.alias("other"))
    )
    places = totals.select(
        subject, *[_place(subject, item, total).alias(name) for total, name in (("one", "first"), ("other", "second"))]
    )
    places = places.select(
        subject, *[F.when(F.col(name) <= k, F.col(name)).alias(name) for name in ("first", "second")]
    ).where("first IS NOT NULL OR second IS NOT NULL")
    gap = F.abs(F.col("first") - F.col("second"))
    return places.groupBy(subject).agg(
        F.count("first").alias("N_FIRST"),
        F.count("second").alias("N_SECOND"),
        F.count(gap).alias("N_COMMON"),
        F.avg(gap).alias("MEAN_GAP"),
        F.max(gap).alias("MAX_GAP"),
        F.max(F.when(F.col("first") == 1, F.coalesce((F.col("second") == 1).cast("int"), F.lit(0))))
        .alias("SAME_TOP"),
    )


def cell_presence(sessions: DataFrame, subject: str, item: str, start: str) -> DataFrame:
    """Days a subject was seen on each item, and their share in the subject's active days.

    The distinct days are written once, as both counts read them.
    """
    days = written(
        sessions.dropna(subset=[subject, item, start])
        .select(subject, item, day_of(F.col(start)).alias("day"))
        .distinct(),
        "days",
    )
    per_item = days.groupBy(subject, item).agg(F.count("*").alias("N_DAYS"))
    active = (
        days.select(subject, "day").distinct().groupBy(subject).agg(F.count("*").alias("ACTIVE_DAYS"))
    )
    return lookup_join(per_item, active, [subject], "inner").withColumn(
        "SHARE", F.col("N_DAYS") / F.col("ACTIVE_DAYS")
    )


def missing_rows(df: DataFrame, metric: str, columns: Sequence[str]) -> DataFrame:
    """Rows in which ``metric`` is missing."""
    return df.where(F.col(metric).isNull()).select(*columns)


def metric_history(
    df: DataFrame, key: str, day: str, metric: str, only: int | None = None
) -> DataFrame:
    """A measurement in date order, nulls kept, for every key or for one of them."""
    rows = df if only is None else df.where(F.col(key) == only)
    dated = rows.select(key, date_of(F.col(day)).alias("DATE"), metric)
    return sorted_by_columns(dated, [key, "DATE", metric])
