"""Traffic of a subscriber by the network layer of the cells it went through."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from towerlens import fixed
from towerlens.functions.columns import day_of
from towerlens.operators.lookups import BROADCAST_BYTES, lookup_join


def traffic_by_layer(
    sessions: DataFrame,
    assignment: DataFrame,
    subject: str = "SK_ID",
    cell: str = "CELL_LAC_ID",
    start: str = "START_TIME",
    volume: str = "DATA_VOL_MB",
    layers: Sequence[str] = fixed.LAYERS,
    volume_name: str = "DATA_VOL",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Per subject and layer: summed volume, distinct days, distinct start times.

    Sessions on cells without a layer are left out, and so are subjects with no other session. As a
    start time lies in one day, the rows shrink in steps (start time, day, subject): no distinct
    aggregate widens them, and a heavy subject is spread until it is down to its days.
    """
    rows = sessions.select(subject, cell, start, volume).where(F.col(subject).isNotNull())
    known = assignment.where(F.col("GEN").isin(list(layers))).select(cell, "GEN")
    placed = lookup_join(rows, known, [cell], "inner", broadcast_bytes)
    by_start = placed.groupBy(subject, "GEN", start).agg(F.sum(volume).alias("volume"))
    by_day = by_start.groupBy(subject, "GEN", day_of(F.col(start)).alias("day")).agg(
        F.sum("volume").alias("volume"), F.count(start).alias("starts")
    )
    measures = [
        (volume_name, lambda mine: F.coalesce(F.sum(F.when(mine, F.col("volume"))), F.lit(0.0))),
        ("CNT_DAYS", lambda mine: F.count(F.when(mine, F.col("day")))),
        ("CNT_HOURS", lambda mine: F.coalesce(F.sum(F.when(mine, F.col("starts"))), F.lit(0))),
    ]
    return by_day.groupBy(subject).agg(
        *[
            measure(F.col("GEN") == layer).alias(f"{name}_{layer}")
            for name, measure in measures
            for layer in layers
        ]
    )


def wrong_layer_share(
    traffic: DataFrame,
    summary: DataFrame,
    subject: str = "SK_ID",
    phone: str = "PHONE_GEN",
    measure: str = "DATA_VOL",
    layers: Sequence[str] = fixed.LAYERS,
) -> DataFrame:
    """Share of a subject's traffic on layers below what its phone supports.

    Subjects without a known phone are left out; the share is null where there is no traffic.
    """
    amounts = [F.col(f"{measure}_{layer}") for layer in layers]
    below = F.coalesce(
        *[
            F.when(F.col(phone) == layer, sum(amounts[:place], F.lit(0.0)))
            for place, layer in enumerate(layers)
        ]
    )
    return (
        traffic.join(summary.where(F.col(phone).isin(list(layers))).select(subject, phone), subject)
        .withColumn("BELOW", below)
        .select(
            subject,
            phone,
            "BELOW",
            F.try_divide(F.col("BELOW"), sum(amounts, F.lit(0.0))).alias("SHARE"),
        )
    )


def only_in_first(first: DataFrame, second: DataFrame, subject: str) -> DataFrame:
    """Subjects seen in the first table and never in the second."""
    known = F.col(subject).isNotNull()
    return (
        first.where(known)
        .select(subject)
        .distinct()
        .join(second.where(known).select(subject).distinct(), subject, "left_anti")
    )
