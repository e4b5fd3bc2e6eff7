"""Document fingerprints by one-permutation MinHash, in built-in functions only.

Defined results: a null text is an empty text; a text of fewer words than a shingle, or none, is one shingle;
equal texts have equal fingerprints, and their likeness is 1; an empty table gives no rows; documents of equal
ids follow one another in the order of their texts, null ids come first. Only the id and text columns are read.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from towerlens.functions.columns import number_array, range_number

SPACE = " \t\n\x0b\x0c\r"
SHINGLE = 5
# Bins, a power of two, and the low-order bits that are stored of each bin's least hash.
BIN_BITS = 7
BINS = 1 << BIN_BITS
STORED = 8
SEED = 7919
STEPS = 8
# Ranges of ids a shuffle partition, so that their sizes even out.
RANGES = 4


def _words(text: str) -> Column:
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def with_fingerprint(rows: DataFrame, text: str, name: str) -> DataFrame:
    """Adds the bins of the column ``text`` as ``name``, an array of BINS small numbers.

    Every shingle is hashed once. The upper bits of a hash, signed as it is, name its bin, so sorted hashes stand bin by bin with
    the least one first. An empty bin takes the value of a filled one by optimal densification: it walks over
    random bins of its own, the same for all documents, to the first that is filled. After STEPS steps, as
    in texts of few shingles, the filled bin that comes first in a random order of its own ends the walk.

    Each step is a column of its own, as the optimizer would otherwise evaluate the long ones several times.
    """
    names = {step: f"_{name}_{step}" for step in ("words", "hashes", "filled", "map")}
    words, hashes, filled, by_bin = names.values()
    count = F.greatest(F.size(words) - (SHINGLE - 1), F.lit(1))
    shingles = F.transform(F.sequence(F.lit(1), count), lambda at: F.xxhash64(F.slice(words, at, SHINGLE)))

    def bin_of(value: Column) -> Column:
        return F.shiftright(value, 64 - BIN_BITS).cast("int") + BINS // 2

    def leads(value: Column, at: Column) -> Column:
        return (at == 0) | (bin_of(F.get(hashes, at - 1)) != bin_of(value))

    def low(value: Column) -> Column:
        return value.bitwiseAND(F.lit((1 << STORED) - 1)).cast("smallint")

    found = F.transform(F.filter(hashes, leads), lambda value: F.struct(bin_of(value).alias("bin"), low(value).alias("low")))
    rows = rows.withColumn(words, _words(text)).withColumn(hashes, F.sort_array(shingles)).withColumn(filled, found)
    rows = rows.withColumn(by_bin, F.when(F.size(filled) < BINS, F.map_from_entries(filled)))

    def borrowed(own: Column) -> Column:
        lookups = [F.xxhash64(F.lit(SEED), F.lit(step), own) for step in range(STEPS)]
        steps = [F.try_element_at(F.col(by_bin), F.pmod(lookup, F.lit(BINS)).cast("int")) for lookup in lookups]
        rest = F.transform(filled, lambda one: F.struct(F.xxhash64(F.lit(SEED), one["bin"], own), one["low"].alias("low")))
        return F.coalesce(F.try_element_at(F.col(by_bin), own), *steps, F.array_min(rest)["low"])

    bins = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), borrowed)
    full = F.transform(filled, lambda one: one["low"])
    return rows.withColumn(name, F.when(F.col(by_bin).isNull(), full).otherwise(bins)).drop(*names.values())


def packed(bins: str) -> Column:
    """The stored bits of all bins as hex digits."""
    return F.lower(F.array_join(F.transform(bins, lambda value: F.lpad(F.hex(value), STORED // 4, "0")), ""))


def likeness(a: str, b: str) -> Column:
    """Estimated Jaccard similarity of two fingerprints, corrected for equal low-order bits of unequal hashes."""
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)) / F.lit(float(BINS))
    chance = 2.0**-STORED
    return F.greatest((equal - chance) / (1 - chance), F.lit(0.0))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fingerprint)`` of every document, the fingerprint as hex digits."""
    rows = docs.select(F.col(id_col).alias(id_col), F.coalesce(text_col, F.lit("")).alias("_text"))
    return with_fingerprint(rows, "_text", "_bins").select(id_col, packed("_bins").alias("fingerprint"))


def _dealt(rows: DataFrame, id_col: str) -> DataFrame:
    """Deals ``rows`` out by ranges of their id so that every row meets its successor.

    Adds ``_range``, ``_lap`` and ``_lent``: each range also gets the first rows of the next one, the last range
    those of the first, a lap later. Ranges lie between approximate quantiles of the ids; these and the first
    id of each range, a few numbers per shuffle partition, are all that comes to the driver.
    """
    spark = rows.sparkSession
    parts = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = number_array([part / parts for part in range(1, parts)], "double")
    cuts = rows.agg(F.percentile_approx(F.col(id_col).cast("long"), shares, F.lit(10 * parts)).alias("cuts")).first()["cuts"]
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    ranged = rows.withColumn("_range", range_number(key, sorted({cut - 1 for cut in cuts or []}), "bigint"))
    firsts = ranged.groupBy("_range").agg(F.min(key).alias("first")).orderBy("_range").collect()
    lent = [(row["first"], firsts[i - 1]["_range"], int(i == 0)) for i, row in enumerate(firsts)]
    to = spark.createDataFrame(lent, "_first long, _to int, _to_lap int")
    own = F.struct(F.col("_range").alias("_range"), F.lit(0).alias("_lap"), F.lit(False).alias("_lent"))
    other = F.struct(F.col("_to").alias("_range"), F.col("_to_lap").alias("_lap"), F.lit(True).alias("_lent"))
    rows = ranged.join(F.broadcast(to), key == F.col("_first"), "left")
    places = F.when(F.col("_first").isNull(), F.array(own)).otherwise(F.array(own, other))
    return rows.withColumn("_at", F.explode(places))


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are.

    The edited text has the last half of the code points replaced by the first as many of the next document in
    ascending order of ids, a number; the first follows the last. Returns ``(id, n_chars, edited, fingerprint,
    edited_fingerprint, near_edited, near_next)``.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text"))
    rows = with_fingerprint(_dealt(rows, "_id").select("_id", "_text", "_at.*"), "_text", "_bins")
    order = Window.partitionBy("_range").orderBy("_lap", F.asc_nulls_first("_id"), "_text")
    rows = rows.select("*", F.lead("_text").over(order).alias("_next"), F.lead("_bins").over(order).alias("_next_bins"))
    half = F.floor(F.char_length("_text") / 2).cast("int")
    first = F.substring("_text", F.lit(1), F.char_length("_text") - half)
    rows = rows.where("not _lent").withColumn("edited", F.concat(first, F.substring("_next", F.lit(1), half)))
    return with_fingerprint(rows, "edited", "_edited_bins").select(
        F.col("_id").alias(id_col),
        F.char_length("_text").cast("long").alias("n_chars"),
        "edited",
        packed("_bins").alias("fingerprint"),
        packed("_edited_bins").alias("edited_fingerprint"),
        likeness("_bins", "_edited_bins").alias("near_edited"),
        likeness("_bins", "_next_bins").alias("near_next"),
    )
