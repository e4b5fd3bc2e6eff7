"""Nearest vectors against all inner products."""

import math
import random
from functools import reduce
from operator import add

import compare
import numpy as np
import pytest
from pyspark.sql import functions as F

from towerlens.llm import nearest

NAMES = "vec_id long, embedding array<float>"


def brute(rows, k=20):
    kept = [(name, v) for name, v in rows if name is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    sizes = [len(v) for _, v in kept]
    dim = min(set(sizes), key=lambda size: (-sizes.count(size), size)) if sizes else 0
    kept = [(name, np.float32(v).astype(float)) for name, v in kept if len(v) == dim]
    out, seen = [], set()
    for name, v in kept:
        if name % 20 or (name, v.tobytes()) in seen:
            continue
        seen.add((name, v.tobytes()))
        scores = sorted((-reduce(add, [float(a * b) for a, b in zip(v, w)], 0.0), other) for other, w in kept if other != name)
        out += [(name, rank, other, -score) for rank, (score, other) in enumerate(scores[:k], 1)]
    return sorted(out)


def test_odd_vectors(spark):
    chance = random.Random(3)
    rows = [(n, [chance.gauss(0, 1) for _ in range(12)]) for n in range(300)]
    # Ties, a vector that a third of the rows share, repeated rows, and rows that take no part.
    rows += [(n, rows[7][1]) for n in range(400, 560)] + [rows[20], rows[20], (40, rows[3][1])]
    rows += [(600, None), (601, []), (602, [0.0] * 12), (603, [math.nan] * 12), (604, [1.0, None] * 6), (605, [math.inf] * 12)]
    rows += [(620, [1.0] * 11), (640, [9.0] * 13), (None, [5.0] * 12), (-20, [1.0] * 12)]
    found = nearest.nearest(spark.createDataFrame(rows, NAMES), F.col("id") % 20 == 0)
    assert [f"{name} {kind}" for name, kind in found.dtypes] == ["query_id bigint", "rank int", "vec_id bigint", "score double"]
    assert sorted(map(tuple, found.collect())) == brute(rows)


def test_few_rows_and_empty_tables(spark):
    rows = [(0, [1.0, 2.0]), (1, [3.0, -1.0]), (20, [-0.5, 0.25])]
    assert sorted(map(tuple, nearest.nearest(spark.createDataFrame(rows, NAMES), F.col("id") % 20 == 0).collect())) == brute(rows)
    for empty in ([], [(0, None)], [(0, [1.0])]):
        found = nearest.nearest(spark.createDataFrame(empty, NAMES), F.col("id") % 20 == 0)
        assert found.collect() == [] and found.columns == ["query_id", "rank", "vec_id", "score"]
    clashing = spark.createDataFrame([(0, [1.0], 1, 2, 3), (1, [2.0], 1, 2, 3)], NAMES + ", id int, shard int, code int")
    assert nearest.nearest(clashing, F.col("id") % 20 == 0).collect()[0].vec_id == 1


def clustered(n, dim, seed):
    chance = np.random.default_rng(seed)
    middles = chance.standard_normal((8, dim))
    found = middles[chance.integers(0, 8, n)] + 0.6 * chance.standard_normal((n, dim))
    return found / np.sqrt((found * found).sum(1))[:, None]


@pytest.mark.parametrize("dim", [17, 64, 200])
def test_bounds_hold_and_spare_most_vectors(dim):
    vectors = clustered(4000, dim, dim)
    rotation, _ = np.linalg.qr(np.random.default_rng(1).standard_normal((dim, dim)))
    shape = nearest.Frame(dim, rotation, nearest.centroids(vectors[:2000]), 1)
    which, codes, scalars = nearest.encode(vectors, shape)
    assert codes.shape == (4000, -(-dim // 8))
    import pyarrow as pa

    columns = [pa.array(range(4000)), pa.array(vectors.tolist()), pa.array(which, pa.int32()), pa.array([c.tobytes() for c in codes]), pa.array(scalars.tolist())]
    shard = nearest._Shard([pa.RecordBatch.from_arrays(columns, ["id", "vector", "centroid", "code", "scalars"])], shape)
    found, error = shard.estimates(vectors[:100])
    exact = vectors[:100] @ vectors.T
    assert (abs(found - exact) <= error).mean() > 0.997
    # The estimate isn't biased.
    assert abs((found - exact).mean()) < 0.003
    chosen = found + error >= np.sort(exact, axis=1)[:, -21, None]
    assert chosen.mean() < 0.5


def test_recall(spark):
    vectors = clustered(6000, 64, 9)
    rows = [(n, [float(x) for x in v]) for n, v in enumerate(np.float32(vectors))]
    found = {}
    for row in nearest.nearest(spark.createDataFrame(rows, NAMES), F.col("id") % 20 == 0).collect():
        found.setdefault(row.query_id, set()).add(row.vec_id)
    exact = np.float32(vectors).astype(float)
    hits = 0
    for query, ids in found.items():
        scores = exact @ exact[query]
        scores[query] = -np.inf
        hits += len(ids & set(np.argsort(-scores)[:20].tolist()))
    assert len(found) == 300 and hits >= 0.99 * 20 * 300


def test_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = nearest.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 20 == 0)
    wanted = compare.expected(compare.database(sf_dir), nearest.ORACLE)
    assert compare.rows_of(found).sort_values(["query_id", "rank"]).values.tolist() == wanted[list(found.columns)].sort_values(["query_id", "rank"]).values.tolist()
