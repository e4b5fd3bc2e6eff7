"""Filling gaps in a key's history from its other days."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from towerlens.functions.columns import is_weekend
from towerlens.operators.lookups import lookup_join


def fill_by_day_type(df: DataFrame, key: str, date: str, metrics: Sequence[str]) -> DataFrame:
    """Missing values become the key's mean on the same type of day (working day or weekend), else its
    mean on all days; they stay null where the key has no value at all.

    Sums and counts by key and type of day are plain aggregates, combined before the shuffle; the means of a key are
    put together from them and joined back, so a heavy key is never gathered in one window.
    """
    metrics = list(metrics)
    rows = df.withColumn("_weekend", is_weekend(F.col(date)))
    sums = (
        rows.where(F.col(key).isNotNull())
        .groupBy(key, "_weekend")
        .agg(*[f(F.col(m)).alias(f"{name}{i}") for i, m in enumerate(metrics) for name, f in (("s", F.sum), ("n", F.count))])
    )
    parts = F.struct(
        "_weekend",
        F.array(*[F.col(f"s{i}").cast("double") for i in range(len(metrics))]).alias("s"),
        F.array(*[F.col(f"n{i}") for i in range(len(metrics))]).alias("n"),
    )
    # Three rows for a key at most: working days, weekends, and days without a date.
    days = sums.select(key, parts.alias("part")).groupBy(key).agg(F.collect_list("part").alias("parts"))

    def means(found: Column) -> Column:
        total = [
            F.aggregate(
                found,
                F.array_repeat(zero, len(metrics)),
                lambda so_far, part: F.zip_with(so_far, part[name], lambda a, b: a + F.coalesce(b, zero)),
            )
            for name, zero in (("s", F.lit(0.0)), ("n", F.lit(0).cast("bigint")))
        ]
        return F.zip_with(total[0], total[1].cast("array<double>"), lambda a, b: F.try_divide(a, b))

    kinds = {"w0": F.filter("parts", lambda part: ~part["_weekend"]), "w1": F.filter("parts", lambda part: part["_weekend"])}
    usual = days.select(key, means(F.col("parts")).alias("any"), *[means(found).alias(name) for name, found in kinds.items()])
    usual = usual.select(key, *[F.zip_with(name, "any", lambda a, b: F.coalesce(a, b)).alias(f"_{name}") for name in ("w0", "w1", "any")])
    joined = lookup_join(rows, usual, [key], "left")
    joined = joined.withColumn("_usual", F.when(F.col("_weekend"), F.col("_w1")).when(~F.col("_weekend"), F.col("_w0")).otherwise(F.col("_any")))
    places = {metric: place for place, metric in enumerate(metrics)}
    return joined.select(
        *[F.coalesce(name, F.get("_usual", F.lit(places[name]))).alias(name) if name in places else F.col(name) for name in df.columns]
    )
