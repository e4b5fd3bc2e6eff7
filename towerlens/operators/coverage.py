"""Which group of columns a key belongs to, judged by which of them are filled."""

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from towerlens.functions.columns import first_largest, largest
from towerlens.operators.lookups import BROADCAST_BYTES, lookup_join

Groups = Mapping[str, Sequence[str]]


def coverage_counts(df: DataFrame, key: str, groups: Groups) -> DataFrame:
    """Non-null count of every grouped column per key."""
    columns = [column for group in groups.values() for column in group]
    return (
        df.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.count(c).alias(c) for c in columns])
    )


def coverage_scores(df: DataFrame, key: str, groups: Groups) -> DataFrame:
    """Per key and group, the count of the group's best filled column."""
    scores = [
        largest([F.col(column) for column in columns]).alias(label)
        for label, columns in groups.items()
    ]
    return coverage_counts(df, key, groups).select(key, *scores)


def assign_group_by_coverage(
    df: DataFrame, key: str, groups: Groups, label: str = "GEN", empty_as_first: bool = True
) -> DataFrame:
    """One row per key with the label of its best covered group."""
    scores = {name: F.col(name) for name in groups}
    chosen = first_largest(scores, empty_as_first).alias(label)
    return coverage_scores(df, key, groups).select(key, chosen)


def coverage_conflicts(
    df: DataFrame, key: str, groups: Groups, include_uncovered: bool = False
) -> DataFrame:
    """Keys covered by two or more groups (and, on request, by none) with all their scores."""
    covered = sum(((F.col(name) > 0).cast("int") for name in groups), F.lit(0))
    scores = coverage_scores(df, key, groups).withColumn("N_GROUPS", covered)
    conflict = F.col("N_GROUPS") >= 2
    return scores.where(conflict | (F.col("N_GROUPS") == 0) if include_uncovered else conflict)


def conflict_counts(df: DataFrame, key: str, groups: Groups) -> DataFrame:
    """The non-null counts of keys covered by two or more groups, from one aggregate."""
    covered = [
        (largest([F.col(column) for column in columns]) > 0).cast("int") for columns in groups.values()
    ]
    return coverage_counts(df, key, groups).where(sum(covered, F.lit(0)) >= 2)


def covered_keys(scores: DataFrame, key: str, label: str) -> DataFrame:
    """Keys with any coverage in a group."""
    return scores.where(F.col(label) > 0).select(key)


def shared_keys(scores: DataFrame, key: str, labels: Sequence[str]) -> DataFrame:
    """Keys found in two or more of the groups: the union of the pairwise intersections."""
    shared = None
    for one, other in combinations(labels, 2):
        pair = covered_keys(scores, key, one).intersect(covered_keys(scores, key, other))
        shared = pair if shared is None else shared.union(pair)
    return shared.distinct()


def rows_of_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in a key set."""
    return lookup_join(df, keys.select(key), [key], "left_semi")


def split_by_group(
    df: DataFrame,
    assignment: DataFrame,
    key: str,
    groups: Groups,
    id_columns: Sequence[str],
    label: str = "GEN",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> dict[str, DataFrame]:
    """Per group, the rows of its keys with the id columns and that group's columns only."""
    placed = lookup_join(df, assignment.select(key, label), [key], "inner", broadcast_bytes)
    return {
        name: placed.where(F.col(label) == name).select(*id_columns, *columns)
        for name, columns in groups.items()
    }


def long_form(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Wide key rows turned into one row per key and column."""
    return df.unpivot([key], list(columns), "METRIC", "VALUE")
