"""Phrases against plain counts of all n-grams."""

import random
import re
from collections import Counter, defaultdict

import compare
import pytest
from pyspark.sql import functions as F

from towerlens.llm import collocations


def brute(rows, top=2000, longest=3, least=10):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for n in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, found in counts.items():
        candidates = {phrase: a for phrase, a in found.items() if len(phrase) >= 2 and a >= least}
        gone = {
            longer[i : i + n]
            for longer, f in candidates.items()
            for n in range(2, len(longer))
            for i in range(len(longer) - n + 1)
            if 100 * f >= 50 * found[longer[i : i + n]]
        }
        scored = []
        for phrase, a in candidates.items():
            if phrase not in gone:
                cuts = [(1_000_000 * a * a // (found[phrase[:k]] * found[phrase[k:]]), k) for k in range(1, len(phrase))]
                score, k = min(cuts)
                scored.append((-score, -a, " ".join(phrase).encode(), found[phrase[:k]], found[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


@pytest.fixture
def talk():
    """Texts over few words with common phrases, so that parts of phrases are explained, scores tie, and streams branch."""
    chance = random.Random(11)
    words = ["New", "york", "city", "é", "\x01", "x\x01", "a", "The", "of", "日本", "don't", "\xa0b"]
    phrases = ["new york city", "of the", "x y z", "a b", "\x01 q"]
    texts = []
    for _ in range(400):
        said = [chance.choice(words + phrases) for _ in range(chance.randint(0, 25))]
        texts.append("".join(part + chance.choice([" ", " ", " ", "\t", ". ", "\n", "!", "  "]) for part in said))
    return [(chance.choice(["en", "de", None, "und"]), text) for text in texts] + [("en", None), ("xx", ""), ("yy", "only these"), (None, ". , ;")]


@pytest.mark.parametrize("block", [1, 300, 8 << 20])
def test_equals_plain_counts(spark, talk, monkeypatch, block):
    monkeypatch.setattr(collocations, "BLOCK_BYTES", block)
    docs = spark.createDataFrame(talk, "lang string, text string")
    found = collocations.top_phrases(docs)
    assert [f"{name} {kind}" for name, kind in found.dtypes] == [
        "lang string", "rank bigint", "phrase string", "a bigint", "l bigint", "r bigint", "n bigint", "score bigint",
    ]
    wanted = brute(talk)
    assert sorted(map(tuple, found.collect())) == wanted and len(wanted) > 40


def test_longer_phrases_and_top(spark, talk):
    docs = spark.createDataFrame(talk, "lang string, text string")
    found = collocations.top_phrases(docs, top=5, longest=5, least=2)
    assert sorted(map(tuple, found.collect())) == brute(talk, 5, 5, 2)


def test_parts_stand_beside_phrases_across_ranges(spark):
    """One first word has nearly all phrases, so most ranges begin amid its extensions."""
    rows = [("en", [], 0, 999), ("en", ["a"], 1, 500), ("en", ["b"], 1, 77)]
    rows += [("en", ["a", f"w{i:04}"], 2, 100 + i) for i in range(600)] + [("en", ["a", "w0300", f"x{i}"], 3, 50) for i in range(400)]
    stream = spark.createDataFrame(rows, "lang string, words array<string>, n int, f long")
    found = collocations.with_parts(stream, F.col("words"), "left")
    known = {tuple(words): f for _, words, _, f in rows}
    for row in found.collect():
        assert row.left == [known[tuple(row.words[:k])] for k in range(row.n)]
    ranges = spark.conf.get("spark.sql.shuffle.partitions")
    assert found.count() == len(rows) and int(ranges) > 1


def test_scores_pass_64_bits(spark, monkeypatch):
    """Counts of a few thousand million, as the streams of a large corpus have them."""
    big = 4_000_000_007
    rows = [("en", [], 0, 5 * big), ("en", ["a"], 1, big + 5), ("en", ["b"], 1, big + 9), ("en", ["a", "b"], 2, big)]
    stream = spark.createDataFrame(rows, "lang string, words array<string>, n int, f long")
    monkeypatch.setattr(collocations, "counts", lambda *_: stream)
    (row,) = collocations.scored(spark.createDataFrame([("", "")], "lang string, text string")).collect()
    assert (row.a, row.l, row.r, row.n) == (big, big + 5, big + 9, 5 * big)
    assert row.score == 1_000_000 * big * big // ((big + 5) * (big + 9))


def test_empty_tables_and_other_columns(spark):
    names = "lang string, text string, phrase int, f int, n int, key int, range int"
    assert collocations.top_phrases(spark.createDataFrame([], names)).count() == 0
    docs = spark.createDataFrame([("en", "go on " * 12, 1, 2, 3, 4, 5)] * 2, names)
    assert sorted(map(tuple, collocations.top_phrases(docs).collect())) == brute([("en", "go on " * 12)] * 2)


def test_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    found = collocations.top_phrases(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    wanted = compare.expected(compare.database(sf_dir), collocations.ORACLE)
    assert compare.canonical(compare.rows_of(found)) == compare.canonical(wanted) and len(wanted)
