"""Joins of a large table with a table of one row per key."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from towerlens.sources.workspace import written

# A lookup of up to this many bytes is broadcast: the sizes of its values and what a row costs in a hash table.
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 32
# The sketch of frequent keys follows so many at once for each shuffle partition, and so many at least. A sketch of m keys finds
# every key that holds more than about 3.5 / m of the rows, so one that overfills a partition can't hide.
SKETCHED_KEYS = 10_000
SKETCHED_PER_PARTITION = 8
# The most that Spark's sketch takes.
MOST_SKETCHED = 1_000_000


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``rows`` with a lookup of known size: broadcast if it is small, salted otherwise.

    The lookup is written once, so its size is counted rather than estimated and the work behind it
    is not repeated by a plan that reads it several times. Both ways match the same rows.
    """
    table = written(lookup, "lookup")
    if size_of(table) <= broadcast_bytes:
        return rows.join(F.broadcast(table), list(on), how)
    return salted_join(rows, table, on, how)


def size_of(df: DataFrame) -> int:
    """Bytes that the rows take in memory, about: eight for a number, more for texts and nested values."""
    plain = ("tinyint", "smallint", "int", "bigint", "float", "double", "date", "boolean")
    wide = [name for name, dtype in df.dtypes if not dtype.startswith(("timestamp", "decimal", *plain))]
    texts = [F.coalesce(F.octet_length(F.col(f"`{name}`").cast("string")), F.lit(0)) for name in wide]
    fixed = ROW_BYTES + 16 * len(df.columns)
    return df.agg(F.coalesce(F.sum(sum(texts, F.lit(fixed)).cast("bigint")), F.lit(0))).first()[0]


def _common(rows: DataFrame, lookup: DataFrame, on: Sequence[str]) -> list[str]:
    """The types to which Spark brings the keys of both sides when it compares them."""
    pairs = [(dict(rows.dtypes)[name], dict(lookup.dtypes)[name]) for name in on]
    nothing = rows.sparkSession.range(0).select(
        *[F.coalesce(F.lit(None).cast(a), F.lit(None).cast(b)).alias(f"k{i}") for i, (a, b) in enumerate(pairs)]
    )
    return [dtype for _, dtype in nothing.dtypes]


def hot_keys(rows: DataFrame, key_hash: Column, partitions: int) -> list[int]:
    """Hashes of the keys that hold more than one partition's share of the rows, at most ``partitions`` of them.

    They are found once, by a frequent-items sketch of every task merged on the way. Its size follows the number of
    partitions, up to 125,000 of them; beyond, a key of less than about 3.5 in a million rows isn't spread.
    """
    sketched = min(max(SKETCHED_KEYS, SKETCHED_PER_PARTITION * partitions), MOST_SKETCHED)
    kept = min(partitions, sketched // 2)
    top = F.expr(f"approx_top_k(key_hash, {kept}, {sketched})")
    found = rows.select(key_hash.alias("key_hash")).agg(F.count("*").alias("n"), top.alias("top")).first()
    return [item["item"] for item in found["top"] or [] if item["count"] * partitions > found["n"]]


def salted_join(rows: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join (inner, left, left_semi or left_anti) that spreads the heaviest keys of ``rows``
    over all shuffle partitions.

    Keys of both sides are brought to one type first, as an equi-join does, and told apart by the hash of that
    value. Only keys that would overfill a partition are salted, and only their lookup rows are repeated, once
    per salt. Which keys these are decides where a row goes, never whether it matches.
    """
    on = list(on)
    keys = [f"_key{place}" for place in range(len(on))]
    types = _common(rows, lookup, on)
    key_values = {key: F.col(name).cast(dtype) for key, name, dtype in zip(keys, on, types)}
    keyed_rows = rows.withColumns(key_values)
    keyed_lookup = lookup.withColumns(key_values).drop(*on)
    salts = max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    key_hash = F.xxhash64(*keys)
    hot = hot_keys(keyed_rows, key_hash, salts)
    is_hot = key_hash.isin(hot) if hot else F.lit(False)
    # Row content spreads distinct rows, the partition number spreads copies of one row. Both are the
    # same when a lost task is run again.
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *rows.columns), F.lit(salts)).cast("int")
    every_salt = F.sequence(F.lit(0), F.lit(salts - 1))
    salted_rows = keyed_rows.withColumn("_salt", F.when(is_hot, spread).otherwise(F.lit(0)))
    salted_lookup = keyed_lookup.withColumn("_salt", F.explode(F.when(is_hot, every_salt).otherwise(F.array(F.lit(0)))))
    joined = salted_rows.join(salted_lookup, [*keys, "_salt"], how).drop(*keys, "_salt")
    return joined.select(*on, *[name for name in joined.columns if name not in on])
