"""Token counts per document, from one count per distinct piece of text.

Defined results: a null text is an empty text with no tokens; repeated rows each get their row, whatever their
id; an empty table gives no rows. Only the id and text columns are read.
"""

import os
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from towerlens.llm.blocks import blocks, by_place, looked_up, ranks, unpacked


def check_tokenizer(path: str) -> None:
    """Refuses a tokenizer that doesn't drop ASCII white space, so that tokens of neighbouring words depend on each other."""
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()

    def ids(text: str) -> list[int]:
        return model.encode(text, add_special_tokens=False).ids

    words = ["a", "Word", "don't", "12", "é", "!?", "日本", "_x_"]
    spaces = [" ", "\t", "\n", "\x0b", "\x0c", "\r", "  "]
    apart = all(ids(a + space + b) == ids(a) + ids(b) for a in words for b in words for space in spaces)
    if not apart or any(ids(space + word + space) != ids(word) for word in words for space in spaces):
        raise ValueError("the tokenizer's tokens aren't bounded by white space")


def _counter(path: str) -> Callable[[list[str]], dict[str, pa.Array]]:
    """Pieces to numbers of tokens, by the tokenizer in ``path``, which a task loads once."""
    loaded = []

    def counted(pieces: list[str]) -> dict[str, pa.Array]:
        if not loaded:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            loaded.append(Tokenizer.from_file(path))
            loaded[0].no_truncation()
            loaded[0].no_padding()
        found = loaded[0].encode_batch_fast(pieces, add_special_tokens=False)
        return {"n_tokens": pa.array([len(one.ids) for one in found], pa.uint32())}

    return counted


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_tokens)`` of every document, as the tokenizer file gives them without added tokens.

    ``tokenizer`` must drop white space, so that no token crosses it (``check_tokenizer``): then the tokens of a text are those of its
    pieces between ASCII white space. Each distinct piece of the corpus is tokenized once, its number of tokens is
    joined to the dictionaries of the blocks, and a document's count is the sum over its piece frequencies.
    """
    check_tokenizer(tokenizer)
    table = blocks(docs, id_col, text_col, bytes.split, in_order=False)
    numbers = looked_up(table, _counter(tokenizer), "n_tokens binary")
    kind = dict(docs.select(id_col).dtypes)[id_col]

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        tokens = by_place(right, "n_tokens")[ranks(row["slices"])].astype(np.int64)
        per_piece = tokens[unpacked(row["places"])] * unpacked(row["counts"])
        before = np.concatenate([[0], np.cumsum(per_piece)])
        ends = np.cumsum(row["sizes"], dtype=np.int64)
        ids = pa.array(row["ids"], left.schema.field("ids").type.value_type)
        return pa.table([ids, row["n_bytes"], before[ends] - before[ends - row["sizes"]]], ["id", "n_bytes", "n_tokens"])

    left = table.where("slice < 0").select("block", "ids", "n_bytes", "sizes", "slices", "places", "counts")
    rows = left.groupBy("block").cogroup(numbers.groupBy("in_block"))
    rows = rows.applyInArrow(summed, f"id {kind}, n_bytes long, n_tokens long")
    return rows.withColumnRenamed("id", id_col)


def over_limit(counts: DataFrame, limit: int) -> DataFrame:
    """Says which documents have more than ``limit`` tokens."""
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
