"""Near-duplicate groups against all pairs."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from towerlens.llm import simhash
from towerlens.llm.components import components


def brute_print(text, shingle=3):
    lowered = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, distance):
    parent = {name: name for name in prints}

    def root(name):
        while parent[name] != name:
            name = parent[name]
        return name

    names = sorted(prints)
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                a_root, b_root = sorted((root(a), root(b)))
                parent[b_root] = a_root
    return {name: root(name) for name in names}


def test_groups_equal_all_pairs(documents, odd_texts, prose):
    near = [text.replace("w1 ", "w2 ", 1) for text in prose[:30]]
    texts = odd_texts + prose + near
    prints = {place: brute_print(text) for place, text in enumerate(texts)}
    groups = brute_groups(prints, 2)
    found = simhash.near_groups(documents(texts)).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in found} == {
        (place, f"{prints[place]:016x}", groups[place]) for place in prints
    }
    assert len(found) == len(texts)


@pytest.mark.parametrize(("distance", "dense"), [(1, 3), (2, 0), (2, 3), (2, 64), (3, 0), (4, 64)])
def test_links_find_every_near_pair(spark, distance, dense):
    chance = random.Random(distance)
    centers = [chance.getrandbits(64) for _ in range(6)]
    prints = {chance.getrandbits(64) for _ in range(60)} | {0, (1 << 64) - 1, 1 << 63}
    for center in centers:
        for _ in range(25):
            prints.add(center ^ sum(1 << b for b in chance.sample(range(64), chance.randint(0, 5))))
    signed = [value - (1 << 64) if value >> 63 else value for value in prints]
    table = spark.createDataFrame([(value,) for value in signed], "fingerprint long")
    found = simhash.links(table, distance, 2, dense)
    assert found.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > distance).count() == 0
    expected = brute_groups({value: value % (1 << 64) for value in signed}, distance)
    grouped = {row.node: row.component for row in components(found).collect()}
    assert {value: grouped.get(value, value) for value in signed} == expected


def test_one_of_each_keeps_every_column(spark):
    rows = [(3, "a b c d", "k"), (1, "a b c d", "l"), (1, "a b c d", "l"), (2, "other words stay here", None), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    found = simhash.one_of_each(docs)
    assert found.columns == docs.columns
    assert sorted(map(tuple, found.collect()), key=str) == sorted([rows[1], rows[3], rows[4]], key=str)


def test_null_ids(spark):
    docs = spark.createDataFrame([(None, "same text of words"), (7, "same text of words"), (None, "x")], "doc_id long, text string")
    found = sorted(((r.doc_id, r.component_id) for r in simhash.near_groups(docs).collect()), key=str)
    assert found == [(7, 7), (None, 7), (None, None)]


def test_empty_table(documents):
    assert simhash.near_groups(documents([])).count() == 0
    assert simhash.one_of_each(documents([])).count() == 0


def test_chains_and_loops_of_links(spark):
    links = spark.createDataFrame([(n, n + 1) for n in range(200)] + [(5, 5), (None, 3), (500, 501), (501, 500)], "a long, b long")
    found = {row.node: row.component for row in components(links).collect()}
    assert found == {n: 0 for n in range(201)} | {500: 500, 501: 500}
    assert components(links.limit(0)).count() == 0
