"""Pearson correlation of every pair of columns over the rows where both are known."""

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from towerlens.functions.columns import without_nan

# Up to this many columns the pairs fit into one built-in aggregate; beyond it, the generated code
# of hundreds of aggregates costs more than the rows.
NARROW = 4
MOMENTS = ["n", "mx", "my", "xx", "yy", "xy", "xlo", "xhi", "ylo", "yhi"]
# A pair whose spread is this small against its size may be constant, which rounding would hide.
SUSPECT = 1e-9


def correlation_matrix(df: DataFrame, columns: Sequence[str], narrow: int = NARROW) -> DataFrame:
    """Every ordered pair (X, Y) with CORR, null where either column does not vary or holds an infinity."""
    columns = list(columns)
    rows = df.select(*[without_nan(F.col(c).cast("double")).alias(c) for c in columns])
    pairs = _built_in(rows, columns) if len(columns) <= narrow else _by_matrix(rows, columns)
    both_ways = F.array(
        F.struct(F.col("X"), F.col("Y"), F.col("CORR")),
        F.struct(F.col("Y").alias("X"), F.col("X").alias("Y"), F.col("CORR")),
    )
    one_way = F.array(F.struct(F.col("X"), F.col("Y"), F.col("CORR")))
    mirrored = F.when(F.col("X") == F.col("Y"), one_way).otherwise(both_ways)
    return pairs.select(F.inline(mirrored)).orderBy("X", "Y")


def _bounded(correlation: Column) -> Column:
    within = F.greatest(F.least(correlation, F.lit(1.0)), F.lit(-1.0))
    # least and greatest skip nulls and rank NaN, which an infinite value leaves, above all numbers
    return F.when(correlation.isNotNull() & ~F.isnan(correlation), within)


def _built_in(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    aggregates = []
    for place, x in enumerate(columns):
        for y in columns[place:]:
            both = F.col(x).isNotNull() & F.col(y).isNotNull()
            x_known, y_known = F.when(both, F.col(x)), F.when(both, F.col(y))
            varies = (F.min(x_known) < F.max(x_known)) & (F.min(y_known) < F.max(y_known))
            spread = F.stddev_pop(x_known) * F.stddev_pop(y_known)
            value = F.when(varies, F.try_divide(F.covar_pop(x_known, y_known), spread))
            aggregates.append(
                F.struct(F.lit(x).alias("X"), F.lit(y).alias("Y"), _bounded(value).alias("CORR"))
            )
    return rows.agg(F.array(*aggregates).alias("pairs")).select(F.inline("pairs"))


def _by_matrix(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One pass over the rows: each task turns its rows into one row per pair with matrix products,
    and these are merged by pair.

    A task reports means and squared deviations, not raw sums of squares, and the merge works on
    differences to one task's mean, so a large common offset costs no digits.
    """
    total, n = _merged(rows, columns), F.col("n")
    sx, sy = F.col("sx"), F.col("sy")
    x_spread = F.col("xx") - F.try_divide(sx * sx, n)
    y_spread = F.col("yy") - F.try_divide(sy * sy, n)
    together = F.col("xy") - F.try_divide(sx * sy, n)
    x_varies = (F.col("xlo") < F.col("xhi")) & (x_spread > 0)
    y_varies = (F.col("ylo") < F.col("yhi")) & (y_spread > 0)
    value = F.try_divide(together, F.sqrt(x_spread) * F.sqrt(y_spread))
    names = F.array(*[F.lit(c) for c in columns])
    return total.select(
        F.get(names, F.col("i")).alias("X"),
        F.get(names, F.col("j")).alias("Y"),
        _bounded(F.when(x_varies & y_varies, value)).alias("CORR"),
    )


def _merged(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The moments of every pair ``(i, j)`` of columns over all tasks, about one task's means ``mx`` and ``my``."""
    pair = ["i", "j"]
    schema = "i int, j int, " + ", ".join(f"{name} double" for name in MOMENTS)
    parts = rows.mapInArrow(_pair_moments(len(columns)), schema).union(_no_rows(rows, len(columns)))
    # One row per task and pair reaches these windows.
    same_pair = Window.partitionBy(*pair)
    n = F.col("n")
    about = {name: F.min(F.when(n > 0, F.col(mean))).over(same_pair) for name, mean in (("ax", "mx"), ("ay", "my"))}
    return (
        parts.withColumns(about)
        .withColumns({"dx": F.col("mx") - F.col("ax"), "dy": F.col("my") - F.col("ay")})
        .groupBy(*pair)
        .agg(
            F.sum("n").alias("n"),
            F.min("ax").alias("ax"),
            F.min("ay").alias("ay"),
            F.sum(n * F.col("dx")).alias("sx"),
            F.sum(n * F.col("dy")).alias("sy"),
            F.sum(F.col("xx") + n * F.col("dx") * F.col("dx")).alias("xx"),
            F.sum(F.col("yy") + n * F.col("dy") * F.col("dy")).alias("yy"),
            F.sum(F.col("xy") + n * F.col("dx") * F.col("dy")).alias("xy"),
            *[F.min(name).alias(name) for name in ("xlo", "ylo")],
            *[F.max(name).alias(name) for name in ("xhi", "yhi")],
        )
    )


def pair_covariances(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(X, Y, N, MEAN_X, MEAN_Y, XX, YY, XY)`` of every pair, X not after Y, over the rows where both are known.

    XX, YY and XY are sums of squares and products about the means; XY is null if either column is infinite there.
    """
    columns = list(columns)
    rows = df.select(*[without_nan(F.col(f"`{c}`").cast("double")).alias(f"c{place}") for place, c in enumerate(columns)])
    n, names = F.col("n"), F.array(*[F.lit(c) for c in columns])
    total = _merged(rows, columns)

    def about(square: str, one: str, other: str) -> Column:
        value = F.col(square) - F.try_divide(F.col(one) * F.col(other), n)
        return without_nan(value)

    return total.select(
        F.get(names, F.col("i")).alias("X"),
        F.get(names, F.col("j")).alias("Y"),
        n.cast("bigint").alias("N"),
        (F.col("ax") + F.try_divide(F.col("sx"), n)).alias("MEAN_X"),
        (F.col("ay") + F.try_divide(F.col("sy"), n)).alias("MEAN_Y"),
        about("xx", "sx", "sx").alias("XX"),
        about("yy", "sy", "sy").alias("YY"),
        about("xy", "sx", "sy").alias("XY"),
    )


def _no_rows(df: DataFrame, width: int) -> DataFrame:
    """What a task without rows reports, so that every pair is there."""
    place = F.col("id")
    moments = {"xlo": np.inf, "xhi": -np.inf, "ylo": np.inf, "yhi": -np.inf}
    return (
        df.sparkSession.range(width * width, numPartitions=1)
        .select(F.floor(place / width).cast("int").alias("i"), (place % width).cast("int").alias("j"))
        .where("i <= j")
        .select("i", "j", *[F.lit(float(moments.get(name, 0))).alias(name) for name in MOMENTS])
    )


def _pair_moments(width: int):
    """The function each task runs. Its helper is inside it, so that it travels to the tasks whole
    and they need no copy of this package."""

    def ranges(x, known, n, s, q):
        # Smallest and largest value of column i where column j is known, looked up only where the
        # sums leave room for a constant; infinite, that is varying, elsewhere.
        low = np.where(n > 0, -np.inf, np.inf)
        high = -low
        spread = q - np.divide(s * s, n, out=np.zeros_like(s), where=n > 0)
        for i, j in zip(*np.nonzero((n > 0) & (spread <= SUSPECT * q))):
            seen = x[known[:, i] & known[:, j], i]
            low[i, j], high[i, j] = seen.min(), seen.max()
        return low, high

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, q, p = np.zeros((4, width, width))
        low, high = np.full((2, width, width), np.inf)
        high = -high
        offset, spoiled = np.full(width, np.nan), np.zeros((width, width), bool)
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            known, finite = ~np.isnan(x), np.isfinite(x)
            # The first finite value of a column is its offset in this task.
            for i in np.nonzero(np.isnan(offset) & finite.any(axis=0))[0]:
                offset[i] = x[finite[:, i].argmax(), i]
            filled, present = np.where(finite, x - offset, 0.0), known.astype(float)
            # An infinity spoils its pairs with the columns known in that row, and no others.
            unbounded = (known & ~finite).astype(float)
            spoiled |= (unbounded.T @ present + present.T @ unbounded) > 0
            batch_n = present.T @ present
            batch_s = filled.T @ present  # [i, j]: sum of column i where column j is known
            batch_q = (filled * filled).T @ present
            batch_low, batch_high = ranges(x, known, batch_n, batch_s, batch_q)
            n, s, q, p = n + batch_n, s + batch_s, q + batch_q, p + filled.T @ filled
            low, high = np.minimum(low, batch_low), np.maximum(high, batch_high)
        mean = np.divide(s, n, out=np.zeros_like(s), where=n > 0)
        offset = np.nan_to_num(offset)
        spread, together = q - s * mean, np.where(spoiled, np.nan, p - s * mean.T)
        i, j = np.triu_indices(width)
        values = [
            n[i, j], mean[i, j] + offset[i], mean[j, i] + offset[j],
            spread[i, j], spread[j, i], together[i, j],
            low[i, j], high[i, j], low[j, i], high[j, i],
        ]
        places = [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32))]
        yield pa.RecordBatch.from_arrays(
            places + [pa.array(v) for v in values], names=["i", "j", *MOMENTS]
        )

    return moments
