"""Manifests against a plain Merkle tree."""

import random
from collections import defaultdict
from hashlib import sha256

import compare
import pytest
from pyspark.sql import functions as F

from towerlens.llm import manifest
from towerlens.llm.queries import MANIFEST, op13_manifest

NAMES = "doc_id long, text string, lang string, source string, n_chars long"


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    fields = ["-" if row[name] is None else f"{len(str(row[name]).encode())}:{row[name]}" for name in MANIFEST]
    return digest(*fields)


def grown(nodes):
    """The top of a tree, and for every leaf the siblings to its left and right, level by level."""
    paths, under = [[] for _ in nodes], [[place] for place in range(len(nodes))]
    while len(nodes) > 1:
        upper, below = [], []
        for at in range(0, len(nodes), 3):
            run = nodes[at : at + 3]
            for own in range(len(run)):
                for place in under[at + own]:
                    paths[place].append(("".join(run[:own]), "".join(run[own + 1 :])))
            upper.append(digest(*run))
            below.append(sum(under[at : at + 3], []))
        nodes, under = upper, below
    return nodes[0], paths


def brute(rows):
    sources = defaultdict(list)
    for row in rows:
        sources[row["source"]].append((row["doc_id"] is not None, row["doc_id"] or 0, leaf(row), row["doc_id"]))
    names = sorted(sources, key=lambda name: (name is not None, (name or "").encode()))
    trees = {name: grown([one[2] for one in sorted(sources[name], key=lambda one: one[:3])]) for name in names}
    root, upper = grown([trees[name][0] for name in names])
    out = []
    for name, above in zip(names, upper):
        top, paths = trees[name]
        for one, path in zip(sorted(sources[name], key=lambda one: one[:3]), paths):
            out.append((one[3], one[2], top, root, digest(*[left + right for left, right in path + above])))
    return out


def found(docs):
    rows = manifest.manifest(docs, MANIFEST, {"id": F.col("doc_id"), "own": manifest.leaf([F.col(name) for name in MANIFEST])})
    hexed = [manifest.hexed(name) for name in ("leaf", "subroot", "root")]
    intact = manifest.folded(F.col("own"), "path") == F.col("root")
    return [tuple(row) for row in rows.select("id", *hexed, manifest.proof("path"), intact).collect()]


def dicts(rows):
    return [dict(zip(["doc_id", "text", "lang", "source", "n_chars"], row)) for row in rows]


def key(row):
    return tuple((value is not None, value if value is not None else 0) for value in row)


@pytest.mark.parametrize("n_sources", [1, 2, 5, 11])
def test_equals_a_plain_tree(spark, odd_texts, n_sources):
    chance = random.Random(n_sources)
    rows = []
    for number in range(n_sources):
        for place in range(chance.choice([1, 2, 3, 4, 9, 10, 27, 28, 40])):
            name = [None, "", "é", "Z", "a", "😀"][number] if number < 6 else f"s{number}"
            rows.append((chance.randint(-50, 99) if chance.random() < 0.9 else None, chance.choice(odd_texts), chance.choice([None, "", "en"]), name, chance.choice([None, 5])))
    rows += rows[:3]
    got = found(spark.createDataFrame(rows, NAMES))
    assert all(row[-1] for row in got)
    assert sorted([row[:-1] for row in got], key=key) == sorted(brute(dicts(rows)), key=key)


def test_one_large_source(spark):
    rows = [(n, f"text {n}", "en", "hot" if n % 50 else f"s{n}", n) for n in range(1500)]
    got = found(spark.createDataFrame(rows, NAMES).repartition(6))
    assert sorted([row[:-1] for row in got]) == sorted(brute(dicts(rows))) and all(row[-1] for row in got)


def test_nulls_and_lengths_are_told_apart(spark):
    rows = [(1, None, "", "s", None), (1, "", None, "s", None), (1, "-", "", "s", None), (11, "1:-", "", "s", None), (1, "1", "1:-", "s", None)]
    leaves = {row[1] for row in found(spark.createDataFrame(rows, NAMES))}
    assert len(leaves) == len(rows)


def test_tampering_shows(spark, tmp_path):
    texts = ["a\nb", "no line end", None, "\n"]
    rows = [(n, texts[n % 4], "en", f"s{n % 3}", 3) for n in range(60)] + [(None, "a\nb", None, None, None)]
    spark.createDataFrame(rows, NAMES).write.parquet(str(tmp_path / "documents.parquet"))
    from zlib import crc32

    for row in op13_manifest(spark, str(tmp_path)).collect():
        lost = row.doc_id is not None and crc32(str(row.doc_id).encode()) % 2 == 0 and "\n" in (texts[row.doc_id % 4] or "")
        assert row.verified == (not lost) == (row.folded_root == row.root)


def test_empty_tables_and_clashing_columns(spark):
    assert found(spark.createDataFrame([], NAMES)) == []
    rows = [(n, "t", "en", "s", 1, n, "x", "y", 0) for n in range(5)]
    docs = spark.createDataFrame(rows, NAMES + ", place long, tree string, slot0 string, size int")
    carried = {name: F.col(name) for name in ("place", "tree", "slot0", "size")}
    got = manifest.manifest(docs, MANIFEST, carried)
    assert got.columns == [*carried, "leaf", "subroot", "root", "path"]
    assert sorted(r.place for r in got.collect()) == list(range(5))


def test_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    wanted = compare.expected(compare.database(sf_dir), manifest.ORACLE)
    assert compare.canonical(compare.rows_of(op13_manifest(spark, sf_dir))) == compare.canonical(wanted) and len(wanted)
