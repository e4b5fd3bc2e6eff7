"""Distinct counts from sketches that can be stored and united."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Base-2 logarithm of a sketch's registers: a standard error of 0.83 / 2^(LG_K / 2), here 0.65 per cent.
LG_K = 14


def distinct_sketches(df: DataFrame, by: Sequence[str], columns: Sequence[str], lg_k: int = LG_K) -> DataFrame:
    """One sketch of every column's values for each group of ``by``, from one pass: ``(by, columns)``, as binary.

    To be stored, for instance by layer and day. Values are sketched by their hash, so any type will do; nulls
    aren't in it.
    """
    values = [F.when(F.col(f"`{name}`").isNotNull(), F.xxhash64(F.col(f"`{name}`"))) for name in columns]
    return df.groupBy(*by).agg(*[F.hll_sketch_agg(value, lg_k).alias(name) for value, name in zip(values, columns)])


def united(sketches: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Sketches of fewer groups, each the union of theirs."""
    return sketches.groupBy(*by).agg(*[F.hll_union_agg(f"`{name}`", False).alias(name) for name in columns])


def estimated(sketches: DataFrame, group: str, columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """``(group, METRIC, N_DISTINCT)`` of each group's own columns, from its sketches."""
    every = list(dict.fromkeys(name for names in columns.values() for name in names))
    rows = []
    for name in every:
        own = F.col(group).isin([label for label, names in columns.items() if name in names])
        count = F.coalesce(F.hll_sketch_estimate(f"`{name}`"), F.lit(0))
        rows.append(F.when(own, F.struct(F.lit(name).alias("METRIC"), count.alias("N_DISTINCT"))))
    return sketches.select(group, F.inline(F.array_compact(F.array(*rows))))
