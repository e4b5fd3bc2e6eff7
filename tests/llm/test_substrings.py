"""Repeated passages against a count of all windows."""

import hashlib
import random
from collections import Counter

from towerlens.llm import substrings

W = substrings.WINDOW


def words_of(text):
    return [w.decode() for w in (text or "").encode().split()]


def brute(texts, window=W):
    texts = [words_of(text) for text in texts]
    seen = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    for place, words in enumerate(texts):
        gone = {
            i + step
            for i in range(len(words) - window + 1)
            if seen[tuple(words[i : i + window])] > 1
            for step in range(window)
        }
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        yield place, len(words), len(gone), kept


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def check(documents, texts, window=W):
    found = substrings.removals(documents(texts), window=window).collect()
    expected = [(place, n, gone, digest(kept)) for place, n, gone, kept in brute(texts, window)]
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found) == expected


def test_shared_passages(documents, odd_texts, prose):
    check(documents, odd_texts + prose)


def test_other_windows(documents, prose):
    check(documents, prose, 8)
    check(documents, prose, 1)


def test_periodic_texts(documents):
    check(documents, ["x " * 100, "x " * (W + 1), "x " * W, "x y " * 60, "y x " * 60, "a b c " * 12, "p q " * 20])


def test_passage_at_every_boundary(documents):
    passage = [f"p{n}" for n in range(60)]
    texts = [" ".join([f"a{n}_{i}" for i in range(n % 40)] + passage[n % 7 :] + [f"b{n}_{i}" for i in range(n % 19)]) for n in range(60)]
    check(documents, texts)


def test_cleaned_leaves_clean_texts_as_they_are(spark):
    same = " ".join(f"s{n}" for n in range(50))
    rows = [(1, f"own  words\n{same}", 5), (2, f"{same} tail", 6), (3, "two  spaces\nand lines", 7), (4, None, 8), (4, None, 8)]
    docs = spark.createDataFrame(rows, "key long, text string, n_words long")
    found = substrings.cleaned(docs)
    assert found.columns == docs.columns
    expected = [(1, "own words", 5), (2, "tail", 6), *rows[2:]]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)


def test_empty_table(documents):
    assert substrings.removals(documents([])).count() == 0
    assert substrings.cleaned(documents([])).count() == 0


def test_factors_and_literals_give_every_text(documents, odd_texts, prose):
    """Each text put together again from its literals and the words of its references."""
    chance = random.Random(12)
    page = " ".join(f"r{chance.getrandbits(12)}" for _ in range(400))
    halves = [page[:1500], page[900:], f"{page[200:1400]} between {page[100:900]}"]
    docs = documents(odd_texts + prose + halves + [page, "x " * 200])
    texts = {row.key: words_of(row.text) for row in docs.select("text", *substrings._keys("text")).collect()}
    n_factors, longest = 0, 0
    for row in substrings.parsed(docs).collect():
        own, rebuilt, done = texts[row.key], [], 0
        for factor in row.factors:
            assert done <= factor.start < factor.end <= row.n_words
            copied = texts[factor.reference][factor.place : factor.place + factor.end - factor.start]
            rebuilt += own[done : factor.start] + copied
            done = factor.end
            longest = max(longest, len(copied))
        assert rebuilt + own[done:] == own
        assert sum(factor.end - factor.start for factor in row.factors) == row.n_removed
        n_factors += len(row.factors)
    # Factors go on over many blocks of one reference.
    assert n_factors > 100 and longest >= 150


def test_parse_takes_what_reaches_farthest():
    spans = [(2, 6, 7, 20), (0, 4, 5, 10), (3, 9, 5, 13), (9, 12, 5, 19), (20, 30, 1, 0), (21, 25, 1, 1)]
    assert substrings.parse(spans, 28) == [(0, 12, 5, 10), (20, 28, 1, 0)]
    assert substrings.parse([(0, 4, 5, 10), (2, 9, 6, 0)], 9) == [(0, 4, 5, 10), (4, 9, 6, 2)]
    assert substrings.parse([], 5) == []
