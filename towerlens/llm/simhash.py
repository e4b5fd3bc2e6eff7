"""Near-duplicate documents by SimHash fingerprints and multi-index hashing.

Defined results: a null text is an empty text; an empty text, or one of white space only, has fingerprint
zero; fewer words than a shingle make one shingle; repeated rows each get their row; a null id never names
a component while another id can; an empty table gives no rows. Only the id and text columns are read, so
further columns cannot clash.
"""

import re
from collections.abc import Iterator
from itertools import accumulate, combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from towerlens.llm.components import components
from towerlens.sources.workspace import written

BITS = 64
SEED = 42
# Bytes of a text whose shingles are hashed together; bounds the memory a very long text takes.
BLOCK = 1 << 18
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
# A segment value held by more distinct fingerprints than this is searched over whole fingerprints instead.
DENSE = 64


def _parts(text: bytes) -> Iterator[bytes]:
    """The text in parts of about BLOCK bytes that end between words."""
    at = 0
    while at < len(text):
        space = _SPACE.search(text, at + BLOCK)
        end = space.start() if space else len(text)
        yield text[at:end]
        at = end


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """SimHash of lower-cased word shingles, as a signed 64-bit number."""
    counts, total, words = np.zeros(BITS, np.int64), 0, []
    for part in _parts(text):
        # The last words of the part before start the first shingles of this one.
        words = words[len(words) - shingle + 1 :] if len(words) >= shingle else words
        words += part.lower().split()
        total += _add(counts, words, shingle) if len(words) >= shingle else 0
    if not total and words:
        total = _add(counts, words, len(words))
    ones = np.packbits(2 * counts > total, bitorder="little")
    return int(ones.view("<i8")[0]) if total else 0


def _add(counts: np.ndarray, words: list[bytes], shingle: int) -> int:
    """Adds the bits of all shingles of ``words`` to ``counts``, and returns how many there are."""
    line = b" ".join(words)
    ends = list(accumulate(len(word) + 1 for word in words))
    pieces = [line[a : b - 1] for a, b in zip([0, *ends], ends[shingle - 1 :])]
    hashes = np.fromiter(map(xxh64_intdigest, pieces, repeat(SEED)), "<u8", len(pieces))
    counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int32)
    return len(pieces)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, key, check, text)`` of every row; ``key`` and ``check`` are hashes of the id and the text."""
    text = F.coalesce(text_col, F.lit(""))
    return docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(id_col, text).alias("key"),
        F.xxhash64(text, id_col).alias("check"),
        text.cast("binary").alias("text"),
    )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(id, key, check, fingerprint)`` of every row; ``key`` and ``check`` are hashes of the id and the text."""
    slim = keyed(docs, id_col, text_col)
    schema = f"id {dict(slim.dtypes)['id']}, key long, check long, fingerprint long"

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([fingerprint(text.as_py(), shingle) for text in batch.column(3)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], found], ["id", "key", "check", "fingerprint"])

    return slim.mapInArrow(hashed, schema)


def _ball(width: int, radius: int) -> list[int]:
    """Every mask of up to ``radius`` bits among ``width``."""
    return [sum(1 << bit for bit in bits) for size in range(radius + 1) for bits in combinations(range(width), size)]


def _long(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _masks(width: int, radius: int) -> Column:
    return F.array(*[F.lit(_long(mask)).cast("long") for mask in _ball(width, radius)])


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _lookups(segment: int, own: Column, masks: Column) -> Column:
    """The values around ``own`` to look up in the table of ``segment``."""
    upward = F.filter(masks, lambda mask: own.bitwiseAND(mask).bitwiseAND(-mask) == 0)
    return F.transform(
        upward,
        lambda mask: F.struct(
            F.lit(segment).alias("segment"), own.bitwiseXOR(mask).alias("value"), (mask == 0).alias("same")
        ),
    )


def links(prints: DataFrame, max_distance: int = 2, segments: int = 2, dense: int = DENSE) -> DataFrame:
    """Links ``(a, b)`` that join distinct ``fingerprint`` values at up to ``max_distance`` differing bits.

    Multi-index hashing: fingerprints are cut into segments, and the radii of the segments add up to
    ``max_distance - segments + 1``, so that any two near fingerprints are within the radius in one of them.
    Each fingerprint looks up the ball around its value in the segment's table and full distances are
    verified. Of two values that differ, the one whose lowest differing bit is 0 does the lookup, so a pair is
    met from one side only.

    A table entry of more than ``dense`` fingerprints, as a large group of near copies makes, isn't fetched.
    All fingerprints in it or looking it up go through balls over the whole fingerprint instead: two are within
    an even distance just when their balls of half that radius meet. A point lies in as many balls as a ball has
    points, so the groups are bounded, and linking each to its least fingerprint keeps the components.
    """
    radius = max_distance - segments + 1
    if not 0 <= max_distance <= 4 or radius < 0 or segments < 2:
        raise ValueError("max_distance must be from segments - 1 to 4, and segments 2 or more")
    width = -(-BITS // segments)
    table, probes = [], []
    for k in range(segments):
        at, size = k * width, min(width, BITS - k * width)
        own = F.shiftrightunsigned("fingerprint", at).bitwiseAND(F.lit(_long((1 << size) - 1)).cast("long"))
        masks = _masks(size, radius // segments + (k < radius % segments))
        table.append(F.struct(F.lit(k).alias("segment"), own.alias("value")))
        probes.append(_lookups(k, own, masks))
    entries = prints.select(F.col("fingerprint").alias("b"), F.explode(F.array(*table)).alias("t")).select("b", "t.*")
    sizes = entries.groupBy("segment", "value").agg(F.count("*").alias("size"))
    entries = written(entries.join(sizes, ["segment", "value"]), "segments")
    crowded = entries.where(F.col("size") > dense)
    marks = crowded.select("segment", "value").distinct().withColumn("b", F.lit(None).cast("long"))
    lookups = prints.select(F.col("fingerprint").alias("a"), F.explode(F.concat(*probes)).alias("p")).select("a", "p.*")
    table_rows = entries.where(F.col("size") <= dense).select("segment", "value", "b").unionByName(marks)
    met = lookups.join(table_rows, ["segment", "value"])
    met = met.where(F.col("b").isNull() | (_distance("a", "b") <= max_distance) & (~F.col("same") | (F.col("a") < F.col("b"))))
    met = written(met.select("a", "b"), "met")
    whole = met.where("b is null").select("a").union(crowded.select("b")).distinct()
    return met.where("b is not null").union(_meeting(whole, max_distance)).distinct()


def _meeting(prints: DataFrame, max_distance: int) -> DataFrame:
    """Links among ``prints`` by the points that the balls around whole fingerprints share."""
    masks = _masks(BITS, -(-max_distance // 2))
    points = prints.toDF("a").select("a", F.explode(F.transform(masks, lambda mask: F.col("a").bitwiseXOR(mask))).alias("point"))
    groups = points.groupBy("point").agg(F.collect_list("a").alias("near")).where(F.size("near") > 1)
    if max_distance % 2 == 0:
        hubs = groups.select(F.array_min("near").alias("a"), F.explode("near").alias("b"))
        return hubs.where("a <> b")
    pairs = groups.select("near", F.explode("near").alias("a")).select("a", F.explode("near").alias("b"))
    return pairs.where("a < b").where(_distance("a", "b") <= max_distance)


def _labelled(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_distance: int, segments: int) -> DataFrame:
    rows = written(fingerprints(docs, id_col, text_col, shingle), "simhash")
    prints = written(rows.groupBy("fingerprint").agg(F.min("id").alias("first_id")), "prints")
    found = components(links(prints.select("fingerprint"), max_distance, segments))
    labels = prints.join(found, prints["fingerprint"] == found["node"], "left").select(
        "fingerprint", "first_id", F.coalesce("component", "fingerprint").alias("component")
    )
    # Written, as the rows of a frequent component are split only in joins of plain exchanges.
    labels = written(labels, "labels")
    firsts = written(labels.groupBy("component").agg(F.min("first_id").alias("component_id")), "firsts")
    return rows.join(labels.join(firsts, "component").drop("first_id"), "fingerprint")


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    max_distance: int = 2,
    segments: int = 2,
) -> DataFrame:
    """One row per document: its id, ``fingerprint`` as 16 hex digits, and ``component_id``, the least id that
    is reachable over links of up to ``max_distance`` differing bits."""
    rows = _labelled(docs, id_col, text_col, shingle, max_distance, segments)
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return rows.select(F.col("id").alias(id_col), digits.alias("fingerprint"), "component_id")


def one_of_each(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    max_distance: int = 2,
    segments: int = 2,
) -> DataFrame:
    """The rows of ``docs`` without near duplicates: one row of each group stays, with all its columns.

    It is the row of the least id; a null id comes after all others. Of several rows with that id, and of
    repeated rows, one stays.
    """
    return first_of_each(docs, _labelled(docs, id_col, text_col, shingle, max_distance, segments), id_col, text_col)


def first_of_each(docs: DataFrame, rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The row of ``docs`` whose id is ``component_id``, of each ``component`` of the labelled ``rows``."""
    first = rows.where(F.col("id").eqNullSafe(F.col("component_id"))).groupBy("component")
    kept = written(first.agg(F.min(F.struct("key", "check")).alias("kept")).select("kept.*"), "kept")
    text = F.coalesce(text_col, F.lit(""))
    keyed = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"),
        F.xxhash64(id_col, text).alias("key"),
        F.xxhash64(text, id_col).alias("check"),
    )
    place = F.row_number().over(Window.partitionBy("key", "check").orderBy("key"))
    keyed = keyed.join(kept, ["key", "check"], "left_semi").withColumn("place", place)
    return keyed.where("place = 1").select("row.*")
