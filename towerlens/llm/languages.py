"""Language identification by nearest centroids of TF-IDF n-gram vectors.

Defined results: a null text, or one without a letter, is ``und`` with score 0, and so is every text where nothing
could be learned; rows without a language are predicted but not learned from; equal similarities go to
the language that sorts first; repeated rows each get their row; an empty table gives no rows. Only the
text and, in learning, the language are read; ``predicted`` carries the caller's columns in a struct.
"""

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from towerlens.sources.workspace import written

UNKNOWN = "und"
# Hashed n-grams of letters, up to three, with one space between words.
DIMENSIONS = 1 << 13
LONGEST = 3
# Characters whose n-grams are counted together; bounds the memory that a long text takes.
BLOCK = 1 << 18
# Clusters per language, and the documents per language that they are fitted on. Document frequencies are
# taken from all documents that may be learned from.
CLUSTERS = 4
SAMPLE = 500
# Slices of a language's texts, by hash, that are put in order separately before the least of all are taken.
SLICES = 64
ROUNDS = 12
# A text farther from its centroid than the fitted documents' mean distance and so many deviations is rejected.
DEVIATIONS = 4.0
_FACTORS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


def letters() -> np.ndarray:
    """Says of every code point whether it is a letter."""
    return np.fromiter((chr(point).isalpha() for point in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def counts(text: str, is_letter: np.ndarray) -> np.ndarray | None:
    """How often each hashed n-gram occurs; nothing if there is no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    real = is_letter[points]
    if not real.any():
        return None
    before = np.concatenate([[False], real[:-1]])
    points = np.concatenate([[32], np.where(real, points, 32)[real | before], [32]]).astype(np.uint32)
    total = np.zeros(DIMENSIONS, np.int64)
    for at in range(0, len(points), BLOCK):
        part = points[at : at + BLOCK + LONGEST - 1]
        hashed = np.zeros(len(part), np.uint32)
        for n in range(1, LONGEST + 1):
            hashed = (hashed[: len(part) - n + 1] + part[n - 1 :]) * np.uint32(_FACTORS[n - 1])
            hashed ^= hashed >> np.uint32(15)
            total += np.bincount(hashed[:BLOCK] >> np.uint32(3) & np.uint32(DIMENSIONS - 1), minlength=DIMENSIONS)
    return total


@dataclass
class Model:
    """``weights`` are the inverse document frequencies; ``centroids`` has one row per cluster, ``names`` its language
    and ``limits`` the distance up to which a text belongs to it."""

    weights: np.ndarray
    names: list[str]
    centroids: np.ndarray
    limits: np.ndarray


def vector(found: np.ndarray, weights: np.ndarray) -> np.ndarray:
    scaled = np.log1p(found).astype(np.float32) * weights
    return scaled / np.linalg.norm(scaled)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one task's documents, how many have each n-gram; at -1, how many there are."""
    is_letter, total, docs = letters(), np.zeros(DIMENSIONS, np.int64), 0
    for batch in batches:
        for text in batch.column(0).to_pylist():
            found = counts(text, is_letter)
            if found is not None:
                total += found > 0
                docs += 1
    seen = np.flatnonzero(total)
    columns = [np.concatenate([[-1], seen]), np.concatenate([[docs], total[seen]])]
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["gram", "n"])


def _clustered(weights: np.ndarray, clusters: int):
    """One language's sample to its centroids, by spherical k-means from far-apart starts."""

    def clustered(table: pa.Table) -> pa.Table:
        is_letter = letters()
        rows = sorted(zip(table["key"].to_pylist(), table["text"].to_pylist()))
        found = [one for _, text in rows if (one := counts(text, is_letter)) is not None]
        names = ["lang", "cluster", "centroid", "limit"]
        types = [pa.string(), pa.int32(), pa.binary(), pa.float64()]
        if not found:
            return pa.table([pa.array([], kind) for kind in types], names)
        points = np.stack([vector(one, weights) for one in found])
        centers = points.mean(0, keepdims=True)
        centers /= np.linalg.norm(centers)
        while len(centers) < min(clusters, len(points)):
            farthest = (points @ centers.T).max(1).argmin()
            centers = np.concatenate([centers, points[farthest : farthest + 1]])
        for _ in range(ROUNDS):
            nearest = (points @ centers.T).argmax(1)
            for number in np.unique(nearest):
                middle = points[nearest == number].mean(0)
                centers[number] = middle / np.linalg.norm(middle)
        nearest = (points @ centers.T).argmax(1)
        distances = 1 - (points * centers[nearest]).sum(1)
        limit = float(distances.mean() + DEVIATIONS * distances.std())
        columns = [
            [table["lang"][0].as_py()] * len(centers),
            range(len(centers)),
            [center.astype("<f4").tobytes() for center in centers],
            [limit] * len(centers),
        ]
        return pa.table([pa.array(list(c), kind) for c, kind in zip(columns, types)], names)

    return clustered


def learned(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, clusters: int = CLUSTERS
) -> Model:
    """Weights from all of ``docs`` and centroids from up to ``sample`` documents of each language.

    The sample is the distinct texts of least hash. What comes to the driver is one number per hashed n-gram and
    ``clusters`` vectors per language.
    """
    text = F.coalesce(text_col, F.lit("")).alias("text")
    rows = docs.select(text, F.col(lang_col).cast("string").alias("lang")).where(F.col("lang").isNotNull())
    sums = rows.select("text").mapInArrow(_frequencies, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    found = {row["gram"]: row["n"] for row in sums.collect()}
    n_docs = found.pop(-1, 0)
    seen = np.zeros(DIMENSIONS)
    seen[list(found)] = list(found.values())
    weights = (np.log((1 + n_docs) / (1 + seen)) + 1).astype(np.float32)

    keyed = rows.withColumn("key", F.xxhash64("text"))
    # Copies are gone before places are given; each slice of a language finds its own least hashes first.
    distinct = keyed.select("lang", "key").distinct().withColumn("slice", F.pmod("key", F.lit(SLICES)))
    own = F.row_number().over(Window.partitionBy("lang", "slice").orderBy("key"))
    low = distinct.withColumn("own", own).where(F.col("own") <= sample).select("lang", "key")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("key"))
    least = low.withColumn("place", place).where(F.col("place") <= sample)
    least = written(least.select("lang", "key"), "sample")
    chosen = keyed.join(least, ["lang", "key"], "left_semi").dropDuplicates(["lang", "key"])
    schema = "lang string, cluster int, centroid binary, limit double"
    centers = chosen.groupBy("lang").applyInArrow(_clustered(weights, clusters), schema)
    centers = sorted(centers.collect(), key=lambda row: (row["lang"], row["cluster"]))
    stacked = np.stack([np.frombuffer(row["centroid"], "<f4") for row in centers]) if centers else np.zeros((0, DIMENSIONS), np.float32)
    return Model(weights, [row["lang"] for row in centers], stacked, np.array([row["limit"] for row in centers]))


def predicted(docs: DataFrame, model: Model, carried: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``carried`` with ``lang_pred``, ``score`` (cosine of the nearest centroid, 0 to 1) and ``rejected``,
    which says that the text is too far from it, as a text in another language is."""
    rows = docs.select(
        F.struct(F.lit(0), *[F.col(f"`{name}`") for name in carried]).alias("row"), F.coalesce(text_col, F.lit("")).alias("text")
    )
    kind = dict(rows.dtypes)["row"]

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_letter = letters()
        for batch in batches:
            names, scores, rejected = [], [], []
            for text in batch.column(1):
                found = counts(text.as_py(), is_letter)
                if found is None or not model.names:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    rejected.append(True)
                    continue
                cosines = model.centroids @ vector(found, model.weights)
                best = int(cosines.argmax())
                names.append(model.names[best])
                scores.append(min(max(float(cosines[best]), 0.0), 1.0))
                rejected.append(bool(1 - cosines[best] > model.limits[best]))
            columns = [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "lang_pred", "score", "rejected"])

    rows = rows.mapInArrow(nearest, f"row {kind}, lang_pred string, score double, rejected boolean")
    return rows.select(*[F.col("row")[name].alias(name) for name in carried], "lang_pred", "score", "rejected")
