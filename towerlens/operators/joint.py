"""Several columns taken together: covariances, joint anomalies, components."""

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from towerlens.functions.columns import number_array
from towerlens.operators.correlation import pair_covariances
from towerlens.sources.workspace import written


@dataclass(frozen=True)
class Moments:
    """Means, spreads and correlations of columns that vary."""

    columns: list[str]
    mean: np.ndarray
    deviation: np.ndarray
    correlation: np.ndarray


def moments(df: DataFrame, columns: Sequence[str]) -> Moments:
    """Moments of the columns that vary, pairwise over the rows where both are known.

    They come from one pass with one row for each pair from every task; the driver gets a row for each pair of columns.
    """
    columns = list(columns)
    found = {(row.X, row.Y): row for row in pair_covariances(df, columns).collect()}
    own = {name: found[name, name] for name in columns if (name, name) in found}
    kept = [name for name in columns if name in own and own[name].N > 1 and own[name].XX and own[name].XX > 0]
    mean = np.array([own[name].MEAN_X for name in kept])
    deviation = np.array([np.sqrt(own[name].XX / (own[name].N - 1)) for name in kept])
    correlation = np.eye(len(kept))
    for i, x in enumerate(kept):
        for j in range(i):
            row = found.get((x, kept[j])) or found.get((kept[j], x))
            spread = np.sqrt(row.XX * row.YY) if row and row.XX and row.YY else 0.0
            correlation[i, j] = correlation[j, i] = np.clip(row.XY / spread, -1, 1) if spread > 0 else 0.0
    return Moments(kept, mean, deviation, correlation)


def _standard(known: Moments) -> Column:
    """The row's columns in standard units, as one array; a missing value counts as the mean."""
    return F.array(
        *[
            F.coalesce((F.col(f"`{name}`") - float(mean)) / float(deviation), F.lit(0.0))
            for name, mean, deviation in zip(known.columns, known.mean, known.deviation)
        ]
    )


def _products(vector: str, matrix: np.ndarray) -> list[Column]:
    """The inner products of an array column with the rows of a matrix."""
    return [
        F.aggregate(F.zip_with(vector, number_array(row.tolist(), "double"), lambda a, b: a * b), F.lit(0.0), lambda total, one: total + one)
        for row in matrix
    ]


def joint_distances(df: DataFrame, key: str, columns: Sequence[str], shrinkage: float = 0.1) -> DataFrame:
    """``(key, N_KNOWN, DISTANCE)``: the Mahalanobis distance of every key's means from the mean of all keys.

    The correlations are drawn towards none by ``shrinkage``, so that their matrix can be inverted whatever the columns; it
    is as large as the list of columns, and inverted on the driver. A missing mean counts as the usual one. Columns
    that don't vary are left out; keys without any known value have no distance.
    """
    means = df.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.avg(c).alias(c) for c in columns])
    means = written(means, "key-means")
    known = moments(means, columns)
    n_known = sum((F.col(f"`{name}`").isNotNull().cast("int") for name in known.columns), F.lit(0))
    if not known.columns:
        return means.select(key, n_known.alias("N_KNOWN"), F.lit(None).cast("double").alias("DISTANCE"))
    drawn = (1 - shrinkage) * known.correlation + shrinkage * np.eye(len(known.columns))
    values, vectors = np.linalg.eigh(drawn)
    # The roots of the inverse; pairwise correlations may leave a value that isn't positive.
    whitening = (vectors / np.sqrt(np.maximum(values, 1e-9))).T
    rows = means.select(key, n_known.alias("N_KNOWN"), _standard(known).alias("_standard"))
    squares = [part * part for part in _products("_standard", whitening)]
    distance = F.sqrt(sum(squares[1:], squares[0]))
    return rows.select(key, "N_KNOWN", F.when(F.col("N_KNOWN") > 0, distance).alias("DISTANCE"))


def joint_anomalies(df: DataFrame, key: str, columns: Sequence[str], threshold: float, shrinkage: float = 0.1) -> DataFrame:
    """Keys whose distance per root of known columns is above ``threshold``; near 1 is usual."""
    rows = joint_distances(df, key, columns, shrinkage)
    return rows.withColumn("PER_COLUMN", F.col("DISTANCE") / F.sqrt("N_KNOWN")).where(F.col("PER_COLUMN") > threshold)


@dataclass(frozen=True)
class Components:
    """Principal components of standardised columns, the most telling first."""

    moments: Moments
    variances: np.ndarray
    weights: np.ndarray


def components(df: DataFrame, columns: Sequence[str]) -> Components:
    """All components of the columns of ``df`` that vary, from their correlations alone.

    Each points to where its weights add up to more than 0, or where they add up to nothing to where the first is
    positive, so the sign isn't left to chance.
    """
    known = moments(df, columns)
    values, vectors = np.linalg.eigh(known.correlation)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    for weight in vectors.T:
        total = weight.sum()
        if (total if abs(total) > 1e-9 else weight[abs(weight) > 1e-9][0]) < 0:
            weight *= -1
    return Components(known, values, vectors)


def component_scores(df: DataFrame, id_columns: Sequence[str], found: Components, k: int) -> DataFrame:
    """Every row's coordinates PC1 to PCk; a missing value counts as the mean."""
    rows = df.select(*id_columns, _standard(found.moments).alias("_standard"))
    coordinates = _products("_standard", found.weights.T[:k])
    return rows.select(*id_columns, *[value.alias(f"PC{place}") for place, value in enumerate(coordinates, 1)])


def explained_variance(df: DataFrame, found: Components) -> DataFrame:
    """``(COMPONENT, VARIANCE, SHARE, CUMULATED)``, one row for each component."""
    whole, rows, upto = float(found.variances.sum()) or 1.0, [], 0.0
    for place, value in enumerate(found.variances.tolist(), 1):
        upto += value
        rows.append((place, value, value / whole, upto / whole))
    return df.sparkSession.createDataFrame(rows, "COMPONENT int, VARIANCE double, SHARE double, CUMULATED double")
