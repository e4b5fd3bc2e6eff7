"""Looking at some rows of a table."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from towerlens.sources.workspace import written


def first_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first rows in a stated order."""
    return df.orderBy(*[F.asc_nulls_last(c) for c in order]).limit(n)


def random_rows(df: DataFrame, key: Sequence[str], n: int, seed: int = 0) -> DataFrame:
    """A random sample of exactly ``n`` rows, the same on every run: those whose key and seed hash
    lowest. Every task keeps only its own lowest ``n``."""
    ticket = F.md5(F.concat_ws("|", *key, F.lit(str(seed))).cast("binary"))
    return df.orderBy(ticket, *key).limit(n)


def numbered(df: DataFrame, place: str = "PLACE") -> DataFrame:
    """Adds the place of every row, from 1, in the order the table has.

    The rows are written with their place in their task; the tasks' sizes, one row each, give the rest.
    """
    task = F.shiftright(F.monotonically_increasing_id(), 33)
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = written(df.withColumn("_task", task).withColumn("_inside", inside), "numbered")
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("_task").agg(F.count("*").alias("_size"))
    offsets = sizes.select("_task", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(offsets), "_task").select(
        *df.columns, (F.col("_before") + F.col("_inside") + 1).alias(place)
    )


def sorted_by_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sorted by many columns, missing values last.

    Rows that agree in all of them are spread by the partition they come from, as a sort would
    otherwise put all of them into one task.
    """
    return (
        df.withColumn("_from", F.spark_partition_id())
        .orderBy(*[F.asc_nulls_last(c) for c in columns], "_from")
        .drop("_from")
    )
