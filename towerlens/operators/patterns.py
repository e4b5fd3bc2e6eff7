"""Which columns are missing together, column by column."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from towerlens.sources.workspace import written

# Columns whose flags share one number; its sign stays out of it.
WORD = 63
# Patterns that a sketch follows at a time.
TRACKED = 1000


def packed_flags(columns: Sequence[str]) -> list[Column]:
    """A row's flags, 1 for a value, packed into whole numbers: column ``i`` is bit ``i % WORD`` of number ``i // WORD``."""
    words = []
    for at in range(0, len(columns), WORD):
        bits = [
            F.when(F.col(f"`{name}`").isNotNull(), F.lit(1 << place)).otherwise(0).cast("bigint")
            for place, name in enumerate(columns[at : at + WORD])
        ]
        word = bits[0]
        for bit in bits[1:]:
            word = word.bitwiseOR(bit)
        words.append(word)
    return words


def named(columns: Sequence[str], words: Sequence[Column]) -> Column:
    """The names of the columns that hold a value, in their order, from packed flags."""
    has = [
        F.when(words[place // WORD].bitwiseAND(F.lit(1 << place % WORD).cast("bigint")) != 0, F.lit(name))
        for place, name in enumerate(columns)
    ]
    return F.array_compact(F.array(*has))


def null_pattern_columns(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows of every combination of filled columns (per group, if ``by`` names columns): FILLED, N_FILLED, N, SHARE.

    A row's flags are one number for each 63 columns, so the aggregate has a short key whatever the number of
    columns; names are put back after it, once a pattern. There are as many rows as patterns in the data.
    """
    by = list(by)
    flags = [word.alias(f"_flags{place}") for place, word in enumerate(packed_flags(columns))]
    names = [f"_flags{place}" for place in range(len(flags))]
    counted = df.select(*by, *flags).groupBy(*by, *names).agg(F.count("*").alias("N"))
    whole = counted.groupBy(*by).agg(F.sum("N").alias("_all"))
    if by:
        same = [F.col(f"`{name}`").eqNullSafe(F.col(f"_{name}")) for name in by]
        whole = whole.select(*[F.col(f"`{name}`").alias(f"_{name}") for name in by], "_all")
        counted = counted.join(whole, same)
    else:
        counted = counted.withColumn("_all", whole.scalar())
    filled = named(columns, [F.col(name) for name in names])
    return counted.select(*by, F.array_join(filled, ",").alias("FILLED"), F.size(filled).alias("N_FILLED"), "N", (F.col("N") / F.col("_all")).alias("SHARE"))


def pattern_sketches(df: DataFrame, columns: Sequence[str], part: str, tracked: int = TRACKED) -> DataFrame:
    """A frequent-items sketch of the patterns of every ``part`` (a day, a file), to be stored: ``(part, N, SKETCH)``.

    A sketch follows up to ``tracked`` patterns, whatever their number, so a part costs a bounded number of bytes.
    Up to 63 columns.
    """
    (word,) = packed_flags(columns)
    return df.select(F.col(part), word.alias("_flags")).groupBy(part).agg(
        F.count("*").alias("N"), F.expr(f"approx_top_k_accumulate(_flags, {tracked})").alias("SKETCH")
    )


def frequent_patterns(sketches: DataFrame, columns: Sequence[str], k: int, tracked: int = TRACKED) -> DataFrame:
    """The ``k`` most frequent patterns over all parts, from their merged sketches: FILLED, N_FILLED, N.

    Counts are exact where the parts have no more than three quarters of ``tracked`` patterns together; a count is too
    high by 3.5 / ``tracked`` of all rows at most otherwise. Of equal counts the smaller pattern comes first.
    """
    # Grouped, as there is nothing to combine without a part.
    found = sketches.groupBy(F.lit("").alias("every")).agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(SKETCH, {tracked}), {k})").alias("top"))
    found = found.select(F.explode("top").alias("one")).select(F.col("one.item").alias("_flags"), F.col("one.count").alias("N"))
    filled = named(columns, [F.col("_flags")])
    return found.select(F.array_join(filled, ",").alias("FILLED"), F.size(filled).alias("N_FILLED"), "N")


def missing_together(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """For every pair of columns, X before Y: rows that miss X, Y, both, and their overlap BOTH / (X or Y).

    It reads the patterns, not the rows, which are far fewer.
    """
    flags = [word.alias(f"_flags{place}") for place, word in enumerate(packed_flags(columns))]
    names = [f"_flags{place}" for place in range(len(flags))]
    patterns = written(df.select(*flags).groupBy(*names).agg(F.count("*").alias("N")), "patterns")

    def gone(place: int) -> Column:
        return F.col(names[place // WORD]).bitwiseAND(F.lit(1 << place % WORD).cast("bigint")) == 0

    pairs = F.array(
        *[
            F.struct(F.lit(x).alias("X"), F.lit(y).alias("Y"), gone(i).alias("no_x"), gone(j).alias("no_y"))
            for i, x in enumerate(columns)
            for j, y in enumerate(columns)
            if i < j
        ]
    )
    rows = patterns.select("N", F.explode(pairs).alias("pair")).select("N", "pair.*")
    counts = rows.groupBy("X", "Y").agg(
        F.coalesce(F.sum(F.when(F.col("no_x"), F.col("N"))), F.lit(0)).alias("MISSING_X"),
        F.coalesce(F.sum(F.when(F.col("no_y"), F.col("N"))), F.lit(0)).alias("MISSING_Y"),
        F.coalesce(F.sum(F.when(F.col("no_x") & F.col("no_y"), F.col("N"))), F.lit(0)).alias("MISSING_BOTH"),
    )
    either = F.col("MISSING_X") + F.col("MISSING_Y") - F.col("MISSING_BOTH")
    return counts.withColumn("OVERLAP", F.try_divide("MISSING_BOTH", either))


def patterns_by_group(df: DataFrame, group: str, columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """The patterns of each group's own columns, all groups in one pass: group, FILLED, N_FILLED, N.

    All columns are packed once; a group's own are cut out of the numbers by a mask.
    """
    every = list(dict.fromkeys(name for names in columns.values() for name in names))
    names = [f"_flags{place}" for place in range(-(-len(every) // WORD))]
    masks = {label: [0] * len(names) for label in columns}
    for label, own in columns.items():
        for name in own:
            place = every.index(name)
            masks[label][place // WORD] |= 1 << place % WORD
    flags = []
    for number, word in enumerate(packed_flags(every)):
        mask = F.coalesce(*[F.when(F.col(group) == label, F.lit(parts[number]).cast("bigint")) for label, parts in masks.items()])
        flags.append(word.bitwiseAND(mask).alias(names[number]))
    rows = df.where(F.col(group).isin(list(columns))).select(group, *flags).groupBy(group, *names).agg(F.count("*").alias("N"))
    filled = named(every, [F.col(name) for name in names])
    return rows.select(group, F.array_join(filled, ",").alias("FILLED"), F.size(filled).alias("N_FILLED"), "N")
