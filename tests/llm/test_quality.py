"""Quality rules against a plain count per text and sorted values per group."""

import re
from collections import Counter

import compare
import pytest
from pyspark.sql import functions as F

from towerlens.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = {i + d for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for d in range(8)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    n = len(words)
    return (
        n,
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(repeated),
        n < 20 or 100 * len(repeated) > 30 * n,
    )


def test_counts(documents, odd_texts, prose):
    texts = odd_texts + prose + ["a\nb\na\n\n \nb \nb", "x y " * 30, "one two three four five six seven eight " * 2 + "nine " * 9]
    found = sorted(map(tuple, quality.verdicts(documents(texts)).collect()))
    assert [row[:7] for row in found] == [(place, *brute(text)) for place, text in enumerate(texts)]
    assert not any(row[6] and row[7] for row in found)


def test_thresholds_follow_language_and_source(spark):
    def text(n, symbols):
        return " ".join(f"w{n}x{i}" + "%" * (i < symbols) for i in range(40))

    rows = [(n, text(n, 0), "en", "plain") for n in range(150)] + [(n, text(n, 40), "en", "plain") for n in range(150, 155)]
    # A source where symbols are usual, one too small to judge itself, and groups of nulls.
    rows += [(n, text(n, 30 + n % 10), "en", "marks") for n in range(200, 350)]
    rows += [(n, text(n, 30), "de", "small") for n in range(400, 403)] + [(n, text(n, 0), None, None) for n in range(500, 503)]
    found = {r.doc_id: r.kept for r in quality.verdicts(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(found[n] for n in range(150)) and not any(found[n] for n in range(150, 155))
    assert all(found[n] for n in range(200, 350)) and all(found[n] for n in range(500, 503))
    assert len(found) == len(rows)


def test_no_switch_between_sizes(spark):
    """The verdicts on a source of symbols don't flip as it grows from 99 to 100 documents, nor by any one document."""

    def rows(n):
        plain = [(place, " ".join(f"w{place}x{i}" for i in range(40)), "en", "plain") for place in range(300)]
        return plain + [(1000 + place, " ".join(f"w{place}x{i}" + "%" * (i < 20) for i in range(40)), "en", "marks") for place in range(n)]

    cuts, kept = [], []
    for n in (1, 10, 99, 100, 101, 400):
        docs = spark.createDataFrame(rows(n), "doc_id long, text string, lang string, source string")
        kept.append({r.kept for r in quality.verdicts(docs).where("doc_id >= 1000").collect()})
        measured = quality._measured(docs.select(F.struct("doc_id").alias("row"), "lang", "source", "text"))
        cuts.append(quality.thresholds(measured).where("source = 'marks'").first().cut.symbols)
    # A lone document is judged like its language; a source of many by itself; 99 and 100 documents alike.
    assert kept[0] == {False} and kept[-1] == {True} and kept[2] == kept[3] == kept[4] and len(kept[2]) == 1
    assert cuts[2] == cuts[3] == cuts[4]


def test_sketches_are_bounded_and_merge(spark):
    rows = spark.range(0, 100_000).selectExpr("id % 3 as g", "id as v")
    fine = quality.sketch(rows, ["g"], "v")
    assert fine.where("g = 0").count() < 32 + 16 * 13
    whole = {r.bucket: r.n for r in quality.sketch(rows, [], "v").collect()}
    assert {r.bucket: r.n for r in quality.merged(fine, []).collect()} == whole
    assert all(bucket <= value < bucket * 17 / 16 + 1 for value in range(2000) for bucket in [max(b for b in whole if b <= value)])


def test_good_rows_keep_their_columns(spark, documents):
    same = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, same, "en", "s", 9, 8), (1, same, "en", "s", 9, 8), (2, "few", None, None, 1, 2), (None, None, None, None, None, None)],
                                 "doc_id long, text string, lang string, source string, n_words long, kept long")
    found = quality.good(docs)
    assert found.columns == docs.columns
    assert [tuple(r) for r in found.collect()] == [(1, same, "en", "s", 9, 8)] * 2
    assert quality.good(documents([])).count() == 0 and quality.verdicts(documents([])).count() == 0


def test_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    df = quality.verdicts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    wanted = compare.expected(compare.database(sf_dir), quality.ORACLE)
    assert compare.canonical(compare.rows_of(df)) == compare.canonical(wanted)


@pytest.mark.parametrize("name", ["verdicts", "good"])
def test_no_python_in_tasks(spark, documents, prose, name):
    plan = getattr(quality, name)(documents(prose))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
