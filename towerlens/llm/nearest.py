"""Nearest vectors by inner product, from randomly rotated one-bit codes with error bounds.

Every vector is indexed: what is left of it after its nearest centroid is rotated at random, and the signs of that
residual, packed, are its code. With four scalars a vector, the packed bits give an unbiased estimate of its inner
product with any query and a bound of the error. In each shard the vectors that look nearest are scored exactly; all
whose upper bound reaches the k-th best of these scores are reranked by exact inner products, so a vector is lost
only if a bound of SPREADS standard deviations fails.

The queries meet the index in blocks: each shard holds a bounded number of vectors and reads all queries, in
batches, once. Per query and shard k rows at most come back.

Defined results: vectors that are null, zero or hold a null or a component that isn't finite take no part, nor do
rows without an id and vectors of another length than the most frequent one (the shortest of those); a query's
candidates are all rows with other ids; equal queries are one; of equal scores the smaller id is nearer; repeated
rows are candidates each; an empty table gives no rows. Only the id and vector columns are read.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from towerlens.sources.workspace import written

K = 20
SEED = 42
# Centroids, and the vectors they are fitted on: a sample by hash of so many bytes as doubles, at most.
CENTROIDS, ROUNDS = 32, 8
SAMPLE_BYTES = 4 << 20
# Vectors of a shard that are scored first, for each wanted one, and the standard deviations an estimate's bounds lie at.
FIRST = 2
SPREADS = 3.0
# Shards of the index: so many at least, of so many bytes of vectors at most, as doubles.
SHARDS = 16
SHARD_BYTES = 64 << 20
# Estimates that are made at a time.
AT_ONCE = 1 << 20


@dataclass(frozen=True)
class Frame:
    """What all codes share: the length of vectors, the rotation, the centroids, the number of shards."""

    dim: int
    rotation: np.ndarray
    centroids: np.ndarray
    shards: int


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(id, vector)`` of the rows that take part."""
    vector = F.col(vector_col)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col(id_col).isNotNull() & vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0))
    return rows.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector"))


def centroids(sample: np.ndarray) -> np.ndarray:
    """Centroids of a sample by k-means, from distinct vectors spread over it."""
    distinct = np.unique(sample, axis=0)
    chance = np.random.default_rng(SEED)
    found = distinct[chance.permutation(len(distinct))[:CENTROIDS]]
    for _ in range(ROUNDS):
        nearest = np.argmin((found * found).sum(1) - 2 * sample @ found.T, axis=1)
        sizes = np.bincount(nearest, minlength=len(found))
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, sample)
        found = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], found)
    return found


def frame(rows: DataFrame) -> Frame | None:
    """The common frame for rows ``(id, vector)``; none if there are no rows."""
    lengths = rows.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.desc("n"), "dim").first()
    if most is None:
        return None
    dim, n = most
    size = max(CENTROIDS, SAMPLE_BYTES // (8 * dim))
    ticket = F.xxhash64("id", F.lit(SEED))
    drawn = rows.where(F.size("vector") == dim).where(F.pmod(ticket, F.lit(1 << 30)) < math.ceil(min(1, 2 * size / n) * (1 << 30)))
    drawn = drawn.orderBy(ticket, "id", "vector").limit(size).select(F.col("vector").cast("array<double>").alias("vector")).toArrow()
    sample = np.array(drawn["vector"].to_pylist(), np.float64).reshape(-1, dim)
    rotation, _ = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, dim)))
    return Frame(dim, rotation, centroids(sample) if len(sample) else np.zeros((1, dim)), max(SHARDS, -(-n * 8 * dim // SHARD_BYTES)))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def encode(vectors: np.ndarray, shape: Frame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(centroid, code, scalars)`` of every vector; the scalars are the length of the residual, the inner products
    of its direction and of the centroid with the code's vector, and that of residual and centroid."""
    middles = shape.centroids
    nearest = np.argmin((middles * middles).sum(1) - 2 * vectors @ middles.T, axis=1)
    rest = vectors - middles[nearest]
    length = np.sqrt((rest * rest).sum(1))
    turned = (rest / np.where(length > 0, length, 1)[:, None]) @ shape.rotation
    up = turned > 0
    signs = np.where(up, 1.0, -1.0) / math.sqrt(shape.dim)
    own = np.where(length > 0, (turned * signs).sum(1), 1.0)
    middle = ((middles @ shape.rotation)[nearest] * signs).sum(1)
    return nearest, np.packbits(up, axis=1), np.stack([length, own, middle, (rest * middles[nearest]).sum(1)], 1)


def index(rows: DataFrame, shape: Frame) -> DataFrame:
    """``(shard, id, vector, centroid, code, scalars)`` of all ``rows`` ``(id, vector)`` of the frame's length, written once."""
    kind = dict(rows.dtypes)["vector"]
    shard = F.pmod(F.xxhash64("id", F.lit(SEED + 1)), F.lit(shape.shards)).cast("int").alias("shard")
    rows = rows.where(F.size("vector") == shape.dim).select(shard, "id", "vector")

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nearest, codes, scalars = encode(_matrix(batch.column(2), shape.dim), shape)
            columns = [
                pa.array(nearest, pa.int32()),
                pa.array([code.tobytes() for code in codes], pa.binary()),
                pa.ListArray.from_arrays(pa.array(np.arange(len(codes) + 1, dtype=np.int32) * 4), pa.array(scalars.ravel())),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], ["shard", "id", "vector", "centroid", "code", "scalars"])

    schema = f"shard int, id long, vector {kind}, centroid int, code binary, scalars array<double>"
    return written(rows.mapInArrow(coded, schema), "index")


class _Shard:
    """The vectors of one shard, by id, and their codes."""

    def __init__(self, parts: list[pa.RecordBatch], shape: Frame) -> None:
        table = pa.Table.from_batches(parts).sort_by("id").combine_chunks()
        column = {name: table[name].chunk(0) for name in table.column_names}
        self.shape, self.ids = shape, column["id"].to_numpy()
        self.vectors = _matrix(column["vector"], shape.dim)
        self.centroid = column["centroid"].to_numpy()
        packed = np.frombuffer(b"".join(column["code"].to_pylist()), np.uint8).reshape(len(self.ids), -1)
        bits = np.unpackbits(packed, axis=1, count=shape.dim)
        self.signs = (bits.T.astype(np.float32) * 2 - 1) / np.float32(math.sqrt(shape.dim))
        length, own, middle, base = _matrix(column["scalars"], 4).T
        self.scale = (length / own).astype(np.float32)
        self.base = (base - length / own * middle).astype(np.float32)
        spread = np.sqrt(np.maximum(1 - own**2, 0)) / own / math.sqrt(max(shape.dim - 1, 1))
        # A little more for the single precision of the estimate.
        self.error = (length * (SPREADS * spread + 1e-5)).astype(np.float32)

    def estimates(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated inner products of all queries with all vectors, and how far off they may be."""
        middles = self.shape.centroids
        near = queries @ middles.T
        away = np.sqrt(np.maximum((queries * queries).sum(1)[:, None] - 2 * near + (middles * middles).sum(1), 0))
        found = (queries @ self.shape.rotation).astype(np.float32) @ self.signs
        found *= self.scale
        found += self.base
        found += near.astype(np.float32)[:, self.centroid]
        error = away.astype(np.float32)[:, self.centroid]
        error *= self.error
        # And for what rounding does to large numbers.
        error += np.float32(1e-6) * np.abs(found)
        return found, error

    def scores(self, queries: np.ndarray, query: np.ndarray, vector: np.ndarray) -> np.ndarray:
        """Inner products of pairs, in double precision."""
        out, step = np.empty(len(query)), max(1, AT_ONCE // self.shape.dim)
        for at in range(0, len(query), step):
            part = slice(at, at + step)
            out[part] = np.einsum("ij,ij->i", queries[query[part]], self.vectors[vector[part]])
        return out

    def nearest(self, ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows ``(query, vector, score)`` of the ``k`` nearest vectors of every query that aren't its own."""
        found, error = self.estimates(queries)
        first, last = np.searchsorted(self.ids, ids, "left"), np.searchsorted(self.ids, ids, "right")
        for query in np.flatnonzero(last > first):
            found[query, first[query] : last[query]] = -np.inf
        size, n = len(self.ids), FIRST * k
        chosen, least = found > -np.inf, np.full(len(ids), -np.inf)
        if size > n:
            best = np.argpartition(found, size - n, axis=1)[:, size - n :]
            query = np.repeat(np.arange(len(ids)), n)
            scores = self.scores(queries, query, best.ravel())
            scores[~chosen[query, best.ravel()]] = -np.inf
            reached = np.partition(scores.reshape(-1, n), n - k, axis=1)[:, n - k]
            # What a sum in another order may differ by.
            least = reached - 1e-9 * np.abs(reached)
            chosen &= found + error >= least.astype(np.float32)[:, None]
        query, vector = np.divmod(np.flatnonzero(chosen), size)
        kept = self.scores(queries, query, vector) >= least[query]
        query, vector = query[kept], vector[kept]
        score = np.zeros(len(query))
        for component in range(self.shape.dim):
            # One by one, so that the sum doesn't depend on what is computed together.
            score += queries[query, component] * self.vectors[vector, component]
        order = np.lexsort((self.ids[vector], -score, query))
        query, vector, score = query[order], vector[order], score[order]
        kept = np.arange(len(query)) - np.searchsorted(query, query) < k
        return query[kept], vector[kept], score[kept]


def _search(shape: Frame, k: int):
    """Rows sorted by shard, vectors before queries, to the nearest vectors of every query in every shard."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, pa.RecordBatch]]:
        for batch in batches:
            shard, asked = batch.column("shard").to_numpy(), batch.column("asked").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((shard[1:] != shard[:-1]) | (asked[1:] != asked[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(shard)]):
                if b > a:
                    yield shard[a], asked[a], batch.slice(a, b - a)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts, shard = None, [], None
        for number, asked, batch in runs(batches):
            if number != current:
                current, parts, shard = number, [], None
            if not asked:
                parts.append(batch)
                continue
            if not parts:
                continue
            shard = shard or _Shard(parts, shape)
            ids, keys = batch.column("id").to_numpy(), batch.column("key").to_numpy()
            queries = _matrix(batch.column("vector"), shape.dim)
            step = max(1, AT_ONCE // len(shard.ids))
            for at in range(0, len(ids), step):
                query, vector, score = shard.nearest(ids[at : at + step], queries[at : at + step], k)
                columns = [keys[at + query], ids[at + query], shard.ids[vector], score]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "query_id", "vec_id", "score"])

    return found


def nearest(vectors: DataFrame, queries: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest other vectors of each row for which ``queries`` holds.

    ``queries`` is a condition on the column ``id``.
    """
    rows = written(usable(vectors, id_col, vector_col), "vectors")
    shape = frame(rows)
    if shape is None:
        return rows.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score"))
    coded = index(rows, shape)
    shards = F.explode(F.sequence(F.lit(0), F.lit(shape.shards - 1))).alias("shard")
    asked = coded.where(queries).withColumn("key", F.xxhash64("id", "vector")).dropDuplicates(["id", "vector"])
    asked = asked.select(shards, F.lit(True).alias("asked"), "key", "id", "vector")
    stream = coded.withColumn("asked", F.lit(False)).unionByName(asked, allowMissingColumns=True)
    stream = stream.repartition(shape.shards, "shard").sortWithinPartitions("shard", "asked")
    met = stream.mapInArrow(_search(shape, k), "key long, query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")).cast("int").alias("rank")
    return met.select("query_id", rank, "vec_id", "score").where(F.col("rank") <= k)


ORACLE = f"""
WITH rows AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), fit AS (
  SELECT * FROM rows WHERE len(v) = (SELECT len(v) FROM rows GROUP BY len(v) ORDER BY count(*) DESC, len(v) LIMIT 1)
), scores AS (
  SELECT q.vec_id AS query_id, q.v AS asked, r.vec_id, list_inner_product(q.v, r.v) AS score
  FROM (SELECT DISTINCT * FROM fit WHERE vec_id % 20 = 0) q JOIN fit r ON r.vec_id <> q.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id, asked ORDER BY score DESC, vec_id) AS rank FROM scores
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= {K}
"""
