"""Token counts and SentencePiece ids against the libraries, text by text."""

import hashlib

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from towerlens.llm import blocks, pieces, token_counts

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture
def texts(odd_texts, prose):
    return odd_texts + prose[:40] + ["   three   spaces ", "▁▁a", "a" * 5000, "�\u0000​", "\r\n\r\n"]


@pytest.fixture(params=[1 << 25, 500])
def small_blocks(request, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", request.param)


def test_counts_equal_the_library(documents, texts, small_blocks):
    tokenizer = Tokenizer.from_file(WORDS)
    found = token_counts.over_limit(token_counts.token_counts(documents(texts), WORDS), 100).collect()
    expected = []
    for place, text in enumerate(texts):
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        expected.append((place, len((text or "").encode()), n, n > 100))
    assert sorted((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in found) == expected


def test_ids_equal_the_library(documents, texts, small_blocks):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = pieces.encoded(documents(texts), PIECES)
    found = sorted((r.doc_id, list(r.ids), r.decoded) for r in rows.collect())
    ids = [model.encode(text or "") for text in texts]
    assert found == [(place, one, model.decode(one)) for place, one in enumerate(ids)]
    digests = rows.select("doc_id", *pieces.digests()).collect()
    assert {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in digests} == {
        (
            place,
            len(one),
            hashlib.sha256(",".join(map(str, one)).encode()).hexdigest(),
            hashlib.sha256(model.decode(one).encode()).hexdigest(),
        )
        for place, one in enumerate(ids)
    }


def test_repeated_and_null_ids_and_empty_tables(spark, documents):
    docs = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b"), (1, "c")], "name string, text string")
    docs = docs.selectExpr("cast(name as long) as doc_id", "text", "'x' as ids", "1 as n_tokens")
    assert sorted((str(r.doc_id), r.n_tokens) for r in token_counts.token_counts(docs, WORDS).collect()) == [
        ("1", 1), ("1", 2), ("1", 2), ("None", 2)
    ]
    assert sorted((str(r.doc_id), r.decoded) for r in pieces.encoded(docs, PIECES).collect()) == [
        ("1", "a b"), ("1", "a b"), ("1", "c"), ("None", "a b")
    ]
    assert token_counts.token_counts(documents([]), WORDS).count() == 0
    assert pieces.encoded(documents([]), PIECES).count() == 0


def test_tokenizers_that_keep_white_space_are_refused(documents):
    token_counts.check_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    with pytest.raises(ValueError, match="white space"):
        token_counts.token_counts(documents(["a b"]), public_tokenizers.path("byte_bpe_50k.json"))


def test_groups_do_not_grow_with_the_number_of_blocks(documents, monkeypatch):
    """Many small blocks: pieces are looked at as a stream of slices, in batches, and none is gathered over all blocks."""
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 50)
    texts = [f"word{n % 7} more words {n}" for n in range(300)]
    seen = blocks.looked_up(
        blocks.blocks(documents(texts), "doc_id", "text", bytes.split, in_order=False),
        lambda pieces: {"n": pa.array([len(pieces)] * len(pieces), pa.uint32())},
        "n binary",
    )
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "FlatMapGroups" not in plan
    assert seen.select("in_block").distinct().count() > 50
