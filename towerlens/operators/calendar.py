"""Histories with the days on which nothing was reported."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from towerlens.functions.columns import date_of
from towerlens.sources.workspace import written


def reported_days(df: DataFrame, key: str, day: str, metric: str) -> DataFrame:
    """``(key, DATE, N_ROWS, N_KNOWN)`` of the days a key has rows on; rows without a key or a day are left out."""
    dated = df.select(F.col(key), date_of(F.col(day)).alias("DATE"), F.col(metric).alias("_value"))
    dated = dated.where(F.col(key).isNotNull() & F.col("DATE").isNotNull())
    return dated.groupBy(key, "DATE").agg(F.count("*").alias("N_ROWS"), F.count("_value").alias("N_KNOWN"))


def every_day(days: DataFrame, key: str) -> DataFrame:
    """``days`` with the absent ones between a key's first and last day, as days of no rows.

    Each key's range is a sequence of days; those it has rows on are taken out by an anti-join. ``days`` is read
    several times, so it should be a table.
    """
    ranges = days.groupBy(key).agg(F.min("DATE").alias("first"), F.max("DATE").alias("last"))
    spine = ranges.select(key, F.explode(F.sequence("first", "last")).alias("DATE"))
    absent = spine.join(days, [key, "DATE"], "left_anti")
    return days.unionByName(absent.withColumns({"N_ROWS": F.lit(0).cast("bigint"), "N_KNOWN": F.lit(0).cast("bigint")}))


def metric_days(df: DataFrame, key: str, day: str, metric: str) -> DataFrame:
    """``(key, DATE, N_ROWS, N_KNOWN)`` for every day between a key's first and last, absent ones with 0."""
    return every_day(written(reported_days(df, key, day, metric), "days"), key)


def metric_gaps(df: DataFrame, key: str, day: str, metric: str) -> DataFrame:
    """Runs of days without a known value: ``(key, FIRST, LAST, N_DAYS, N_ABSENT)``; N_ABSENT have no row at all.

    Days of one run have the same distance to their place among the key's days without a value. Such days are one
    row each, so a window holds no more than a key's calendar.
    """
    without = metric_days(df, key, day, metric).where("N_KNOWN = 0")
    place = F.row_number().over(Window.partitionBy(key).orderBy("DATE"))
    runs = without.withColumn("run", F.date_sub("DATE", place))
    return runs.groupBy(key, "run").agg(
        F.min("DATE").alias("FIRST"),
        F.max("DATE").alias("LAST"),
        F.count("*").alias("N_DAYS"),
        F.count(F.when(F.col("N_ROWS") == 0, 1)).alias("N_ABSENT"),
    ).drop("run")
