"""Places of rows within groups, in a stated order, without gathering a group in one task."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from towerlens.sources.workspace import written


def placed(rows: DataFrame, group: str, order: Sequence[Column], place: str = "place", size: str = "size") -> DataFrame:
    """Adds the place of every row in its group, from 0, and the number of rows of that group.

    Rows are dealt out by ranges of group and order, and sorted there, so a group spans as many ranges as its rows need.
    Each range counts its rows of each group, and these counts, one row for each, are added up over the ranges
    before. Rows that agree in all of ``order`` are spread by the partition they come from. Nulls are a group of
    their own. ``rows`` is read twice, so it should be a table.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.asc_nulls_first(group), *order, F.asc("_from")]
    dealt = rows.withColumn("_from", F.spark_partition_id()).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    dealt = dealt.drop("_from").withColumn("_range", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id())
    dealt = written(dealt, "dealt")
    counts = dealt.groupBy(F.col(group).alias("_group"), F.col("_range").alias("_of")).agg(
        F.min("_at").alias("_first"), F.count("*").alias("_n")
    )
    before = F.sum("_n").over(Window.partitionBy("_group").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1))
    counts = written(
        counts.select(
            "_group",
            "_of",
            (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"),
            F.sum("_n").over(Window.partitionBy("_group")).alias(size),
        ),
        "counts",
    )
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_of"))
    return dealt.join(counts, same).select(*rows.columns, (F.col("_at") + F.col("_shift")).alias(place), size)
