"""A subscriber's history as partial states that are written once and merged, never counted anew."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from towerlens import fixed
from towerlens.functions.columns import day_of
from towerlens.operators.lookups import BROADCAST_BYTES, lookup_join

# The bit of a start time whose hour can't be read.
NO_HOUR = 24


def daily_states(
    sessions: DataFrame,
    assignment: DataFrame,
    subject: str = "SK_ID",
    cell: str = "CELL_LAC_ID",
    start: str = "START_TIME",
    volume: str = "DATA_VOL_MB",
    layers: Sequence[str] = fixed.LAYERS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(subject, DAY, VOLUME_x, HOURS_x)``: per subject, day and layer ``x`` the volume and the hours as a bitmap.

    Start times are ``DD.MM HH``, so a day's hours are 24 bits of one number, combined by a hash aggregate before and
    after the shuffle. Sessions on cells without a layer are left out.
    """
    rows = sessions.select(subject, cell, start, volume).where(F.col(subject).isNotNull())
    known = assignment.where(F.col("GEN").isin(list(layers))).select(cell, "GEN")
    placed = lookup_join(rows, known, [cell], "inner", broadcast_bytes)
    hour = F.substring(start, 7, 2).try_cast("int")
    hour = F.when(F.col(start).isNotNull(), F.when(hour.between(0, 23), hour).otherwise(F.lit(NO_HOUR)))
    placed = placed.withColumn("_hour", hour).withColumn("_bit", F.expr("shiftleft(1, _hour)"))
    return placed.groupBy(subject, day_of(F.col(start)).alias("DAY")).agg(
        *[F.sum(F.when(F.col("GEN") == layer, F.col(volume))).alias(f"VOLUME_{layer}") for layer in layers],
        *[F.bit_or(F.when(F.col("GEN") == layer, F.col("_bit"))).alias(f"HOURS_{layer}") for layer in layers],
    )


def traffic_of_states(
    states: DataFrame, subject: str = "SK_ID", layers: Sequence[str] = fixed.LAYERS, volume_name: str = "DATA_VOL"
) -> DataFrame:
    """Per subject and layer: summed volume, distinct days, distinct start times, from one state for each day."""

    def bits(layer: str) -> Column:
        return F.bit_count(F.coalesce(f"HOURS_{layer}", F.lit(0)))

    measures = [
        (volume_name, lambda layer: F.coalesce(F.sum(f"VOLUME_{layer}"), F.lit(0.0))),
        ("CNT_DAYS", lambda layer: F.count(F.when(bits(layer) > 0, F.col("DAY")))),
        ("CNT_HOURS", lambda layer: F.sum(bits(layer)).cast("bigint")),
    ]
    return states.groupBy(subject).agg(*[measure(layer).alias(f"{name}_{layer}") for name, measure in measures for layer in layers])


def traffic_by_layer_bitmaps(sessions: DataFrame, assignment: DataFrame, **names) -> DataFrame:
    """What ``layers.traffic_by_layer`` gives, with one shuffle fewer: by day, then by subject."""
    layers = names.get("layers", fixed.LAYERS)
    states = daily_states(sessions, assignment, **names)
    return traffic_of_states(states, names.get("subject", "SK_ID"), layers)


def add_batch(states: DataFrame, path: str, batch: str) -> None:
    """Writes the states of one batch of sessions beside those of earlier ones; written again, it takes its own place."""
    states.write.mode("overwrite").parquet(f"{path.rstrip('/')}/BATCH={batch}")


def stored_states(
    spark: SparkSession, path: str, subject: str = "SK_ID", layers: Sequence[str] = fixed.LAYERS
) -> DataFrame:
    """One state for each subject and day over all batches; a day whose sessions came in several is put together."""
    rows = spark.read.parquet(path)
    return rows.groupBy(subject, "DAY").agg(
        *[F.sum(f"VOLUME_{layer}").alias(f"VOLUME_{layer}") for layer in layers],
        *[F.bit_or(f"HOURS_{layer}").alias(f"HOURS_{layer}") for layer in layers],
    )


def snapshot_states(
    features: DataFrame, subject: str, amount: str, label: str, labels: Sequence[str], month: Column, day: Column, tie: Column
) -> DataFrame:
    """``(subject, MONTH, N, SUM, N_AMOUNT, LAST)``: per subject and month the rows, the sum and number of known amounts,
    and the last known label.

    Day, tie (a whole number from 0) and place in ``labels`` are packed into one number, so the last label is a maximum
    that can be taken again over months.
    """
    since = F.date_diff(day, F.lit("0001-01-01").cast("date")).cast("decimal(7,0)")
    place = F.array_position(F.array(*[F.lit(name) for name in labels]), F.col(label))
    packed = (since * F.lit("1" + 19 * "0").cast("decimal(20,0)") + tie.cast("decimal(19,0)")) * F.lit(1000).cast("decimal(4,0)") + place
    return features.where(F.col(subject).isNotNull()).groupBy(subject, month.alias("MONTH")).agg(
        F.count("*").alias("N"),
        F.sum(amount).alias("SUM"),
        F.count(amount).alias("N_AMOUNT"),
        F.max(F.when(place > 0, packed.cast("decimal(38,0)"))).alias("LAST"),
    )


def summary_of_states(states: DataFrame, subject: str, label: str, labels: Sequence[str]) -> DataFrame:
    """Per subject: row count, mean amount, last known label, from its monthly states."""
    merged = states.groupBy(subject).agg(F.sum("N").alias("N"), F.sum("SUM").alias("SUM"), F.sum("N_AMOUNT").alias("N_AMOUNT"), F.max("LAST").alias("LAST"))
    names = F.array(*[F.lit(name) for name in labels])
    return merged.select(
        subject,
        F.col("N").alias("CNT_MONTHS"),
        F.try_divide("SUM", "N_AMOUNT").alias("AVG_REVENUE"),
        F.get(names, (F.col("LAST") % 1000).cast("int") - 1).alias(label),
    )
