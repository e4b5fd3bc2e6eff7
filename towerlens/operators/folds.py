"""Logistic models over folds: every row is scored by a model that hasn't seen it."""

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from towerlens.functions.columns import number_array, percent_slot
from towerlens.sources.workspace import written

FOLDS = 5
# Newton steps end when no weight moves by more, or after so many.
CLOSE, STEPS = 1e-8, 30


@dataclass(frozen=True)
class Model:
    """Weights of each fold's model, the constant first, and what columns are measured in."""

    columns: list[str]
    mean: list[float]
    deviation: list[float]
    weights: np.ndarray
    steps: int


def in_folds(df: DataFrame, key: str, folds: int = FOLDS) -> DataFrame:
    """Adds FOLD, from 0, by the key alone."""
    return df.withColumn("FOLD", F.pmod(percent_slot(F.col(key)), F.lit(folds)))


def _scale(rows: DataFrame, columns: Sequence[str]) -> tuple[list[str], list[float], list[float]]:
    """Columns that vary, with mean and deviation; a row for the whole table comes to the driver."""
    facts = rows.agg(*[F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("deviation")).alias(c) for c in columns]).first()
    kept = [c for c in columns if facts[c].deviation]
    return kept, [facts[c].mean for c in kept], [facts[c].deviation for c in kept]


def _inputs(model: Model):
    """A row's columns in standard units behind a 1; a missing value counts as the mean."""
    units = [
        F.coalesce((F.col(f"`{name}`") - mean) / deviation, F.lit(0.0))
        for name, mean, deviation in zip(model.columns, model.mean, model.deviation)
    ]
    return F.array(F.lit(1.0), *units)


def _step_sums(weights: np.ndarray):
    """Rows ``(FOLD, label, inputs)`` to what a Newton step of each fold's model adds up: gradient and Gram matrix."""
    folds, width = weights.shape

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((folds, width + width * width))
        for batch in batches:
            fold, label = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            inputs = batch.column(2).flatten().to_numpy().reshape(-1, width)
            for model in range(folds):
                seen = fold != model
                x = inputs[seen]
                rate = 1 / (1 + np.exp(-np.clip(x @ weights[model], -500, 500)))
                sums[model, :width] += x.T @ (label[seen] - rate)
                sums[model, width:] += ((x * (rate * (1 - rate))[:, None]).T @ x).ravel()
        place = np.tile(np.arange(sums.shape[1]), folds)
        model = np.repeat(np.arange(folds), sums.shape[1])
        columns = [pa.array(model, pa.int32()), pa.array(place, pa.int32()), pa.array(sums.ravel())]
        yield pa.RecordBatch.from_arrays(columns, ["model", "place", "value"])

    return summed


def fitted(
    rows: DataFrame, key: str, outcome: str, columns: Sequence[str], folds: int = FOLDS, ridge: float = 1.0, steps: int = STEPS
) -> Model:
    """A logistic model for each fold, fitted on the rows of all others by Newton's method.

    Every step is one pass over ``rows``, which should be a table: each task adds up the Gram matrices of all folds, and
    the sums over tasks, as many numbers as the models have pairs of columns, come to the driver. ``ridge`` is the
    penalty of half the squared weights but the constant. Rows without an outcome aren't learned from.
    """
    columns, mean, deviation = _scale(rows, columns)
    model = Model(columns, mean, deviation, np.zeros((folds, len(columns) + 1)), 0)
    known = in_folds(rows.where(F.col(outcome).isNotNull()), key, folds)
    known = written(known.select("FOLD", F.col(outcome).cast("double").alias("label"), _inputs(model).alias("inputs")), "inputs")
    width = len(columns) + 1
    penalty = ridge * np.diag([0.0] + [1.0] * (width - 1))
    weights = model.weights
    for step in range(1, steps + 1):
        sums = known.mapInArrow(_step_sums(weights), "model int, place int, value double")
        found = np.zeros((folds, width + width * width))
        for row in sums.groupBy("model", "place").agg(F.sum("value").alias("value")).collect():
            found[row.model, row.place] = row.value
        moved = np.zeros_like(weights)
        for fold in range(folds):
            gradient = found[fold, :width] - penalty @ weights[fold]
            matrix = found[fold, width:].reshape(width, width) + penalty
            moved[fold] = np.linalg.lstsq(matrix, gradient, rcond=None)[0]
        weights = weights + moved
        model = Model(columns, mean, deviation, weights, step)
        if np.abs(moved).max() < CLOSE:
            break
    return model


def out_of_fold_scores(rows: DataFrame, key: str, outcome: str, model: Model) -> DataFrame:
    """``(key, outcome, FOLD, SCORE)``: every row scored by the model of its fold, which hasn't seen it."""
    folds = len(model.weights)
    weights = F.array(*[number_array(weight.tolist(), "double") for weight in model.weights])
    scored = in_folds(rows, key, folds).select(key, outcome, "FOLD", _inputs(model).alias("_inputs"), F.get(weights, F.col("FOLD")).alias("_weights"))
    total = F.aggregate(F.zip_with("_inputs", "_weights", lambda a, b: a * b), F.lit(0.0), lambda so_far, one: so_far + one)
    return scored.select(key, outcome, "FOLD", (1 / (1 + F.exp(-total))).alias("SCORE"))
