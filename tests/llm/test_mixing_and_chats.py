"""Mixing and chats against SQL and against small cases worked out by hand."""

import compare
import pytest
from pyspark.sql import functions as F

from towerlens.llm import chats, mixing, substrings
from towerlens.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ["op2_substrings", "op5_chats", "op6_mixing"])
def test_equals_sql(spark, name):
    wanted = compare.expected(compare.database(SF_DIR), ORACLES[name])
    found = compare.rows_of(QUERIES[name](spark, SF_DIR))
    assert sorted(found.columns) == sorted(wanted.columns)
    assert compare.canonical(found) == compare.canonical(wanted)


def test_shortages_go_to_siblings_first(spark):
    leaves = [("a", "x", "1", 100), ("a", "x", "2", 1000), ("a", "y", "1", 10), ("b", "x", "1", 5000), (None, "x", "1", 0)]
    supplies = spark.createDataFrame([(*leaf, 1) for leaf in leaves], "d string, l string, s string, supply long, n_docs long")
    found = mixing.budgets(supplies, ["d", "l", "s"], {"d": {"a": 1, "b": 1}}, (1000, 6110), 1)
    assert sorted(((r.d, r.l, r.s, r.budget) for r in found.collect()), key=str) == [
        # 500 for a: y has 10 of its 250, so x gets 490; of that 1 has 100 of its 245, and 2 gets 390.
        ("a", "x", "1", 100), ("a", "x", "2", 390), ("a", "y", "1", 10), ("b", "x", "1", 500), (None, "x", "1", 0),
    ]
    everything = mixing.budgets(supplies, ["d", "l", "s"], {}, (9, 1), 2)
    assert sorted(r.budget for r in everything.collect()) == [0, 20, 200, 2000, 10000]


def test_weights_of_zero_have_no_budget(spark):
    leaves = [("a", "x", 100), ("a", "y", 50), ("b", "x", 300), ("b", "z", 10)]
    supplies = spark.createDataFrame([(*leaf, 1) for leaf in leaves], "d string, l string, supply long, n_docs long")

    def found(weights):
        return {(r.d, r.l): r.budget for r in mixing.budgets(supplies, ["d", "l"], weights, (1, 2), 1).collect()}

    # Half of 460 tokens: what x may not take goes to its siblings first, then to those of their parent.
    assert found({"l": {"x": 0}}) == {("a", "x"): 0, ("a", "y"): 50, ("b", "x"): 0, ("b", "z"): 10}
    assert found({"d": {"a": 0}}) == {("a", "x"): 0, ("a", "y"): 0, ("b", "x"): 220, ("b", "z"): 10}
    assert set(found({"d": {"a": 0, "b": 0}}).values()) == {0}


def test_epochs_and_prefixes(documents, monkeypatch):
    docs = documents([f"{'w ' * (1 + n % 5)}" for n in range(200)] + [None, ""])
    levels = {"lang": F.col("lang")}

    def chosen(share, epochs, **options):
        rows = mixing.mixed(docs, levels, {}, share, epochs, 7, **options)
        return sorted((r.doc_id, r.epoch, r.n_tokens) for r in rows.select("row.doc_id", "epoch", "n_tokens").collect())

    some = chosen((1, 2), 1)
    assert 290 < sum(row[2] for row in some) <= 300 and {row[1] for row in some} == {0}
    twice = chosen((7, 4), 2)
    assert len({row[0] for row in twice if row[1] == 0}) == 202 and sum(row[2] for row in twice) <= 1050
    monkeypatch.setattr(mixing, "BUCKET", 2)
    assert chosen((1, 2), 1) == some and chosen((7, 4), 2) == twice


def test_mixing_odd_tables(spark, documents):
    assert mixing.mixed(documents([]), {"lang": F.col("lang")}, {}, (1, 2), 1, 0).count() == 0
    docs = spark.createDataFrame([(None, "a b", None, 1), (None, "a b", None, 1), (5, None, "x", 2)], "doc_id long, text string, lang string, leaf long")
    rows = mixing.mixed(docs, {"lang": F.col("lang")}, {}, (1, 1), 1, 0).select("row.*")
    assert rows.columns == docs.columns and rows.count() == 3


def test_snapshots_collapse(spark):
    def turns(name, said):
        return [(name, place, "user" if place % 2 == 0 else "assistant", text) for place, text in enumerate(said)]

    rows = turns(1, ["hi", "hello"]) + turns(2, ["hi", "hello", "more"]) + turns(3, ["hi", "hello", "more"]) + turns(4, ["hi", "other"])
    rows += turns(5, ["hi"]) + turns(6, ["hello"]) + turns(None, ["null id"]) + [(7, None, None, None), (7, None, None, None), (8, 1, "", "")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: (r.n_turns, r.n_copies, r.text) for r in chats.rendered(table).collect()}
    assert {name: row[:2] for name, row in found.items()} == {2: (3, 2), 4: (2, 1), 6: (1, 1), None: (1, 1), 7: (2, 1), 8: (1, 1)}
    assert found[4][2] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nother<|im_end|>\n"
    assert found[7][2] == "<|im_start|>\n<|im_end|>\n" * 2
    assert chats.rendered(table.limit(0)).count() == 0


def test_sql_of_repeated_passages_names_the_same_window():
    assert f"p + {substrings.WINDOW}" in ORACLES["op2_substrings"]
