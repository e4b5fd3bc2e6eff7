"""Usual ranges of measurements, from quantile sketches that can be stored and merged."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from towerlens.sources.workspace import written

# Accuracy of a sketch: the rank of a quantile is off by about 2.3 / ACCURACY of the values, with 99 % certainty (0.6 per
# cent at 400); up to ACCURACY values it is exact.
ACCURACY = 400
SPREADS = 1.5


def _known(name: str) -> Column:
    value = F.col(f"`{name}`").cast("double")
    return F.when(value.isNotNull() & ~F.isnan(value), value)


def quantile_sketches(df: DataFrame, by: Sequence[str], columns: Sequence[str], accuracy: int = ACCURACY) -> DataFrame:
    """One sketch of every column for each group of ``by``, from one pass: ``(by, columns)``, each sketch as binary.

    To be stored, for instance a day at a time, and merged over any groups later. A sketch takes a few kilobytes
    whatever the number of rows; missing values aren't in it.
    """
    sketches = [F.kll_sketch_agg_double(_known(name), F.lit(accuracy)).alias(name) for name in columns]
    return df.groupBy(*by).agg(*sketches)


def merged_sketches(sketches: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Sketches of fewer groups."""
    return sketches.groupBy(*by).agg(*[F.kll_merge_agg_double(f"`{name}`").alias(name) for name in columns])


def fences(sketches: DataFrame, group: str, columns: Mapping[str, Sequence[str]], spreads: float = SPREADS) -> DataFrame:
    """``(group, METRIC, N, Q1, Q3, LOWER, UPPER)`` of each group's own columns from its sketches.

    The fences lie ``spreads`` interquartile ranges outside the quartiles. A column without values has none.
    """
    every = list(dict.fromkeys(name for names in columns.values() for name in names))
    rows = []
    for name in every:
        own = F.col(group).isin([label for label, names in columns.items() if name in names])
        rows.append(F.when(own, F.struct(F.lit(name).alias("METRIC"), F.col(f"`{name}`").alias("sketch"))))
    long = sketches.select(group, F.explode(F.array_compact(F.array(*rows))).alias("one")).select(group, "one.*")
    long = long.withColumn("N", F.kll_sketch_get_n_double("sketch")).where(F.col("N") > 0)
    quartiles = [F.kll_sketch_get_quantile_double("sketch", F.lit(rank)).alias(name) for rank, name in ((0.25, "Q1"), (0.75, "Q3"))]
    spread = spreads * (F.col("Q3") - F.col("Q1"))
    return long.select(group, "METRIC", "N", *quartiles).select("*", (F.col("Q1") - spread).alias("LOWER"), (F.col("Q3") + spread).alias("UPPER"))


def outside_fences(df: DataFrame, id_columns: Sequence[str], group: str, found: DataFrame, columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """The values beyond their group's fences: ``(ids, group, METRIC, VALUE, LOWER, UPPER)``.

    The fences are a row for each group and column, and so are carried along as one array a group; a row of ``df`` is
    only taken apart if one of its values is outside.
    """
    table = written(found.select(group, "METRIC", "LOWER", "UPPER"), "fences")
    limits = table.groupBy(group).agg(F.map_from_entries(F.collect_list(F.struct("METRIC", F.struct("LOWER", "UPPER")))).alias("_limits"))
    limits = limits.withColumnRenamed(group, "_group")
    # As many rows as groups of fixed columns, each with a limit for each of them.
    rows = df.join(F.broadcast(limits), F.col(group) == F.col("_group"))
    every = list(dict.fromkeys(name for names in columns.values() for name in names))
    beyond = []
    for name in every:
        limit, value = F.col("_limits")[name], _known(name)
        beyond.append(
            F.when(
                (value < limit["LOWER"]) | (value > limit["UPPER"]),
                F.struct(F.lit(name).alias("METRIC"), value.alias("VALUE"), limit["LOWER"].alias("LOWER"), limit["UPPER"].alias("UPPER")),
            )
        )
    rows = rows.select(*id_columns, group, F.explode(F.array_compact(F.array(*beyond))).alias("one"))
    return rows.select(*id_columns, group, "one.*")
