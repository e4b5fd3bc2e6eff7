"""SentencePiece encoding and decoding from a table of distinct marked chunks.

Defined results: a null text is an empty text and has no ids; a text of spaces only has the pieces of its spaces;
repeated rows each get their row, whatever their id; an empty table gives no rows. Only the id and text
columns are read.
"""

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from towerlens.llm.blocks import blocks, by_place, looked_up, ranks, unpacked, unpacked_texts

MARK = "▁"
# Chunks of text that are put together at a time.
PART = 1 << 17
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")


def chunks(text: bytes) -> list[str]:
    """The text with a mark in front and for every space, cut before each run of marks."""
    return _CHUNK.findall(MARK + text.decode().replace(" ", MARK)) if text else []


def check_model(path: str) -> None:
    """Refuses a model whose pieces may cross a mark, or which changes text before it is cut."""
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    model = SentencePieceProcessor(model_file=path)
    spec = sentencepiece_model_pb2.ModelProto.FromString(model.serialized_model_proto())
    rules = spec.normalizer_spec
    plain = rules.add_dummy_prefix and rules.escape_whitespaces and not rules.remove_extra_whitespaces
    crossing = any(MARK in piece.piece.lstrip(MARK) for piece in spec.pieces)
    if crossing or not plain or rules.precompiled_charsmap or spec.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("the model's pieces aren't bounded by white space marks")


def _segmenter(path: str) -> Callable[[list[str]], dict[str, pa.Array]]:
    """Chunks to ids and to the code points of the text they decode to, where it is another.

    A task loads the model once.
    """
    loaded = []

    def segmented(pieces: list[str]) -> dict[str, pa.Array]:
        if not loaded:
            from sentencepiece import SentencePieceProcessor

            loaded.append(SentencePieceProcessor(model_file=path))
        model = loaded[0]
        alone = [model.piece_to_id(MARK)]
        # The library puts the first mark back itself, but not before an empty text.
        rests = [chunk[1:] for chunk in pieces]
        ids = [found or alone for found in model.encode(rests, num_threads=1)]
        texts = model.decode(ids, num_threads=1)
        other = [[] if text == rest.replace(MARK, " ") else [1, *map(ord, text)] for text, rest in zip(texts, rests)]
        kind = pa.list_(pa.uint32())
        return {"ids": pa.array(ids, kind), "other": pa.array(other, kind)}

    return segmented


def _joined(left: pa.Table, right: pa.Table) -> pa.Table:
    """The documents of one block with their ids and decoded texts."""
    slices = sorted(zip(left["slice"].to_pylist(), left["pieces"].to_pylist()))
    row = left.filter(pc.less(left["slice"], 0)).to_pylist()[0]
    decoded = [" " + piece[1:].replace(MARK, " ") for number, texts in slices if number >= 0 for piece in unpacked_texts(texts).to_pylist()]
    values, lengths = by_place(right, "ids"), by_place(right, "ids_sizes").astype(np.int64)
    others, widths = by_place(right, "other"), by_place(right, "other_sizes").astype(np.int64)
    for place, end in zip(np.flatnonzero(widths), np.cumsum(widths)[widths > 0]):
        decoded[place] = " " + "".join(map(chr, others[end - widths[place] + 1 : end].tolist()))
    firsts = np.cumsum(lengths) - lengths
    places, rank, ids = unpacked(row["places"]), ranks(row["slices"]), pa.array(row["ids"], left.schema.field("ids").type.value_type)
    ends = np.cumsum(row["sizes"], dtype=np.int64)
    batches, done = [], 0
    while done < len(ids):
        # Some documents at a time, so that arrays stay small next to the block.
        start = ends[done - 1] if done else 0
        upto = max(done + 1, int(np.searchsorted(ends, start + PART)))
        here = rank[places[start : ends[upto - 1]]]
        sizes = lengths[here]
        inside = np.cumsum(sizes)
        flat = values[np.arange(sizes.sum()) + np.repeat(firsts[here] - inside + sizes, sizes)].astype(np.int32)
        cuts = np.concatenate([[0], ends[done:upto] - start])
        offsets = np.concatenate([[0], inside])[cuts].astype(np.int32)
        listed = here.tolist()
        texts = ["".join([decoded[place] for place in listed[a:b]])[1:] for a, b in zip(cuts, cuts[1:])]
        columns = [ids[done:upto], pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(texts, pa.string())]
        batches.append(pa.RecordBatch.from_arrays(columns, ["id", "ids", "decoded"]))
        done = upto
    return pa.Table.from_batches(batches)


def encoded(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids, decoded)`` of every document: the model's ids without begin and end, and the text they decode to.

    Pieces of ``model`` must not cross a white space mark (``check_model``). Then a text falls into chunks, each a
    run of marks and what follows, that are segmented on their own: each distinct chunk of the corpus once, by the
    library. Ids are joined to the dictionaries of the blocks and put in order by position. A chunk starts with
    a mark, so neither byte runs nor the dropped first space cross chunks in decoding either.
    """
    check_model(model)
    table = blocks(docs, id_col, text_col, chunks, in_order=True)
    schema = "ids_sizes binary, ids binary, other_sizes binary, other binary"
    known = looked_up(table, _segmenter(model), schema)
    kind = dict(docs.select(id_col).dtypes)[id_col]
    left = table.select("block", "slice", "pieces", "ids", "sizes", "slices", "places")
    rows = left.groupBy("block").cogroup(known.groupBy("in_block"))
    rows = rows.applyInArrow(_joined, f"id {kind}, ids array<int>, decoded string")
    return rows.withColumnRenamed("id", id_col)


def digests() -> list[Column]:
    """Number of ids and digests of ids and text, from the columns of ``encoded``."""
    return [
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    ]
