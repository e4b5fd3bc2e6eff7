"""The stages one by one, and the whole."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from towerlens.llm import mixing, quality, simhash, substrings
from towerlens.llm.queries import MIX_LEVELS_SQL
from towerlens.sources.workspace import written

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF_DIR), name)
        kept.append(docs)
    return kept


def test_every_stage_returns_documents(results):
    for before, after in zip(results, results[1:-1]):
        assert after.columns == before.columns and [f.dataType for f in after.schema] == [f.dataType for f in before.schema]


def test_decisions_take_effect(results):
    docs, good, single, cut, mix, ids = results
    verdicts = {r.doc_id for r in quality.verdicts(docs).where("kept").collect()}
    assert {r.doc_id for r in good.collect()} == verdicts
    groups = simhash.near_groups(good).collect()
    assert {r.doc_id for r in single.collect()} == {r.component_id for r in groups}
    removed = {r.doc_id: r for r in substrings.removals(single).collect()}
    texts = {r.doc_id: r.text for r in single.collect()}
    for row in cut.collect():
        assert row.n_chars == len(row.text)
        n = len(row.text.encode().split())
        assert n == removed[row.doc_id].n_words - removed[row.doc_id].n_removed
        assert removed[row.doc_id].n_removed or row.text == texts[row.doc_id]
    kept = sorted(r.doc_id for r in mix.collect())
    assert kept == sorted(r.doc_id for r in ids.collect()) and set(kept) <= set(texts)
    decoded = {r.doc_id: r.decoded for r in ids.collect()}
    assert all(decoded[r.doc_id] == r.text for r in mix.collect())
    assert set(MIX_LEVELS_SQL) == {"domain", "lang", "source"} and mixing.BUCKET


def test_near_copies_meet_the_stage_rule_in_all_pairs(results):
    """Brute force over all pairs of fingerprints of the stage's own input."""
    prints = {r.id: r.fingerprint & (2**64 - 1) for r in simhash.fingerprints(results[1]).collect()}
    group = {name: name for name in prints}

    def root(name):
        while group[name] != name:
            name = group[name]
        return name

    names = sorted(prints)
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                low, high = sorted((root(a), root(b)))
                group[high] = low
    assert {r.doc_id for r in results[2].collect()} == {name for name in names if root(name) == name}


WITHOUT_PACKAGE = """
import sys
sys.path.insert(0, {repo!r})
import corpus_pipeline
from pyspark.sql import SparkSession
builder = SparkSession.builder.master("local[4]").config("spark.checkpoint.dir", {shared!r}).config("spark.ui.enabled", "false")
spark = builder.config("spark.sql.shuffle.partitions", "4").config("spark.ui.showConsoleProgress", "false").getOrCreate()
def found(rows):
    import importlib.util
    yield importlib.util.find_spec("towerlens") is not None
assert spark.sparkContext.parallelize([0], 1).mapPartitions(found).collect() == [False]
print("ROWS", corpus_pipeline.run(spark, {sf_dir!r}).count())
"""


def test_workers_need_no_package(tmp_path, results):
    """The whole pipeline in a session whose workers cannot import this library."""
    repo = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    script = tmp_path / "run.py"
    script.write_text(WITHOUT_PACKAGE.format(repo=repo, shared=str(tmp_path / "shared"), sf_dir=SF_DIR))
    env = {name: value for name, value in os.environ.items() if name != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert f"ROWS {results[-1].count()}" in done.stdout, done.stderr[-3000:]


def test_stages_take_odd_tables(spark, odd_texts):
    own = " ".join(f"word{n}" for n in range(60))
    texts = [*odd_texts, own, own, own + " and more", None]
    rows = [(n if n % 5 else None, text, "en" if n % 2 else None, "s" if n % 3 else None, None, "r", n, "k") for n, text in enumerate(texts)]
    names = "doc_id long, text string, lang string, source string, n_chars long, row string, place int, key string"
    docs = spark.createDataFrame(rows, names)
    for table in (docs, docs.limit(0)):
        for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
            after = written(stage(spark, table, SF_DIR), name)
            assert after.count() <= 2 * table.count()
            if number < len(corpus_pipeline.STAGES) - 1:
                assert after.columns == docs.columns


def test_run_gives_the_last_stage(spark, results):
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(str, rows.collect())) == sorted(map(str, results[-1].collect()))


def test_registered():
    names = set(contract.queries())
    assert "pipeline" in names
    assert [sum(name.startswith(f"op{n}_") for name in names) for n in range(1, 14)] == [1] * 13
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
