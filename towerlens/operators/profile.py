"""Column profiles: types, missing values, distinct values, frequencies, histograms."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from towerlens.functions.columns import bin_number
from towerlens.sources.workspace import written


def table_profile(df: DataFrame) -> DataFrame:
    """Position, type and non-null count of every column, from one pass."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    facts = {name: (place, dtype) for place, (name, dtype) in enumerate(df.dtypes)}
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(place).alias("POSITION"),
                        F.lit(name).alias("METRIC"),
                        F.lit(dtype).alias("DTYPE"),
                        F.col(name).alias("NON_NULL"),
                    )
                    for name, (place, dtype) in facts.items()
                ]
            )
        )
    )


def missing_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of missing values per column, largest first."""
    shares = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in columns])
    return shares.unpivot([], list(columns), "METRIC", "SHARE").orderBy(
        F.desc_nulls_last("SHARE"), "METRIC"
    )


def prune_missing(
    df: DataFrame,
    columns: Sequence[str],
    max_share: float | None = None,
    drop: Sequence[str] | None = None,
) -> DataFrame:
    """Without the given columns, or without those missing in more than ``max_share`` of the rows."""
    if drop is None:
        weak = missing_profile(df, columns).where(F.col("SHARE") > max_share)
        drop = [row.METRIC for row in weak.collect()]  # at most one row per column
    return df.drop(*drop)


def cardinality_profile(
    df: DataFrame, columns: Sequence[str], approximate: bool = False
) -> DataFrame:
    """Distinct non-null values per column, smallest first; 0 for every column of an empty table.

    The exact count goes over pairs of column number and value. Several distinct counts in one
    aggregate would instead shuffle whole rows once per column.
    """
    columns = list(columns)
    if approximate:
        counts = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
        profile = counts.unpivot([], columns, "METRIC", "N_DISTINCT")
    else:
        group = df.select(F.lit(0).alias("group"), *columns)
        profile = group_cardinality_profile(group, "group", {0: columns}).drop("group")
    return profile.orderBy("N_DISTINCT", "METRIC")


def _every_metric(df: DataFrame, group: str, columns: Mapping) -> DataFrame:
    """One row per group and column."""
    named = [(label, name) for label, names in columns.items() for name in names]
    return df.sparkSession.createDataFrame(named, f"{group} {dict(df.dtypes)[group]}, METRIC string")


def group_missing_profile(df: DataFrame, group: str, columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """Share of missing values of each group's own columns, from one pass; null for a group without rows."""
    every = list(dict.fromkeys(name for names in columns.values() for name in names))
    known = df.where(F.col(group).isin(list(columns)))
    counts = known.groupBy(group).agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in every])
    shares = counts.unpivot([group, "_rows"], every, "METRIC", "_known")
    shares = shares.select(group, "METRIC", (1 - F.col("_known") / F.col("_rows")).alias("SHARE"))
    # A row for each of the given groups and columns.
    return _every_metric(df, group, columns).join(F.broadcast(shares), [group, "METRIC"], "left")


def group_cardinality_profile(df: DataFrame, group: str, columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """Distinct non-null values of each group's own columns, from one pass; 0 for a group without rows.

    Each row yields (group, column number, value) for its group's columns only. Values of unlike types go
    through passes of their own.
    """
    df = df.where(F.col(group).isin(list(columns)))
    types = dict(df.dtypes)
    every = list(dict.fromkeys(name for names in columns.values() for name in names))
    found = None
    for dtype in dict.fromkeys(types[name] for name in every):
        pairs = None
        for label, names in columns.items():
            own = [F.struct(F.lit(every.index(n)).alias("place"), F.col(n).alias("value")) for n in names if types[n] == dtype]
            if own:
                pairs = F.when(F.col(group) == label, F.array(*own)) if pairs is None else pairs.when(F.col(group) == label, F.array(*own))
        part = (
            df.select(group, F.explode(pairs).alias("pair"))
            .select(group, "pair.place", "pair.value")
            .groupBy(group, "place", "value")
            .agg(F.lit(1).alias("once"))
            .groupBy(group, "place")
            .agg(F.count("value").alias("N_DISTINCT"))
            .select(group, F.get(F.array(*map(F.lit, every)), "place").alias("METRIC"), "N_DISTINCT")
        )
        found = part if found is None else found.unionByName(part)
    known = _every_metric(df, group, columns).join(F.broadcast(found), [group, "METRIC"], "left")
    return known.select(group, "METRIC", F.coalesce("N_DISTINCT", F.lit(0)).cast("bigint").alias("N_DISTINCT"))


def prune_low_cardinality(
    df: DataFrame,
    columns: Sequence[str],
    min_distinct: int | None = None,
    drop: Sequence[str] | None = None,
) -> DataFrame:
    """Without the given columns, or without those of fewer than ``min_distinct`` values."""
    if drop is None:
        weak = cardinality_profile(df, columns).where(F.col("N_DISTINCT") < min_distinct)
        drop = [row.METRIC for row in weak.collect()]  # at most one row per column
    return df.drop(*drop)


def value_frequency(df: DataFrame, column: str, keep_null: bool = True) -> DataFrame:
    """Rows per value in value order; null is a value of its own, in last place, or left out."""
    rows = df if keep_null else df.where(F.col(column).isNotNull())
    return rows.groupBy(column).agg(F.count("*").alias("N")).orderBy(F.asc_nulls_last(column))


def equal_width_histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """All bins between the smallest and the largest value with their edges and row counts.

    Where all values are equal, the bins span half a unit to both sides of it.
    """
    values = df.select(F.col(column).cast("double").alias("x")).where(F.col("x").isNotNull())
    differ = F.min("x") < F.max("x")
    bounds = values.agg(
        F.struct(
            F.when(differ, F.min("x")).otherwise(F.min("x") - 0.5).alias("lo"),
            F.when(differ, F.max("x")).otherwise(F.max("x") + 0.5).alias("hi"),
        )
    ).scalar()
    counted = (
        values.withColumn("bounds", bounds)
        .groupBy(bin_number(F.col("x"), F.col("bounds.lo"), F.col("bounds.hi"), bins).alias("BIN"))
        .agg(F.count("*").alias("N"))
    )
    width = (F.col("bounds.hi") - F.col("bounds.lo")) / bins
    edges = (
        df.sparkSession.range(1, bins + 1, numPartitions=1)
        .select(F.col("id").cast("int").alias("BIN"), bounds.alias("bounds"))
        .where(F.col("bounds.lo").isNotNull())
        .select(
            "BIN",
            (F.col("bounds.lo") + (F.col("BIN") - 1) * width).alias("LOWER"),
            (F.col("bounds.lo") + F.col("BIN") * width).alias("UPPER"),
        )
    )
    return (
        edges.join(counted, "BIN", "left")
        .withColumn("N", F.coalesce("N", F.lit(0)).cast("bigint"))
        .orderBy("BIN")
    )


def items_per_subject(df: DataFrame, subject: str, item: str) -> DataFrame:
    """Distinct items per subject."""
    return (
        df.where(F.col(subject).isNotNull())
        .groupBy(subject)
        .agg(F.countDistinct(item).alias("N_ITEMS"))
    )


def items_per_subject_histogram(
    df: DataFrame, subject: str, item: str, bins: int, of_frequencies: bool = False
) -> DataFrame:
    """Histogram of how many items a subject has.

    ``of_frequencies`` takes it over how often each count occurs instead of over the counts. The
    counts are written once, as their range and their bins are both needed.
    """
    counts = written(items_per_subject(df, subject, item), "items-per-subject")
    if of_frequencies:
        return equal_width_histogram(value_frequency(counts, "N_ITEMS", False), "N", bins)
    return equal_width_histogram(counts, "N_ITEMS", bins)


def null_patterns(df: DataFrame, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """Which groups of columns are filled together: rows per combination of filled groups."""
    flags = [
        F.coalesce(*[F.when(F.col(c).isNotNull(), 1) for c in columns], F.lit(0)).alias(f"HAS_{name}")
        for name, columns in groups.items()
    ]
    names = [f"HAS_{name}" for name in groups]
    return (
        df.select(*flags).groupBy(*names).agg(F.count("*").alias("N")).orderBy(*map(F.desc, names))
    )


def presence_flags(df: DataFrame, id_columns: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """For every column, 1 where it holds a value and 0 where it does not."""
    flags = [F.col(c).isNotNull().cast("int").alias(f"HAS_{c}") for c in columns]
    return df.select(*id_columns, *flags)
