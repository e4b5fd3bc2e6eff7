"""Documents cut into pieces of text, kept as blocks with a dictionary of pieces each.

A block holds some megabytes of text: every distinct piece once, and per document the places of its pieces in
that dictionary. Only the dictionaries meet over the whole corpus, a small part of the text: each is dealt out by
the hash of its pieces into slices, so that equal pieces of all blocks come together, and what is found goes back
to the blocks. A slice is read as a stream of rows, one from each block, and looked at a batch at a time, so no task
holds more than a batch of slices, or the slices of one block, whatever the number of blocks.
"""

import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from towerlens.sources.workspace import written_in_buckets

# Bytes of text in one block; a longer text is a block of its own.
BLOCK_BYTES = 32 << 20
# Slices of a dictionary, so many for each shuffle partition.
SLICES = 4


def packed(numbers: list[np.ndarray]) -> bytes:
    """Whole numbers as compressed planes of bytes; small ones, as of frequent pieces, take little room."""
    whole = np.concatenate([np.zeros(0, "<u4"), *numbers]).astype("<u4")
    return zlib.compress(whole.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def packed_texts(texts: list[bytes]) -> bytes:
    """Texts as one compressed run of bytes behind their lengths."""
    sizes = np.array([len(texts), *map(len, texts)], "<u4")
    return zlib.compress(sizes.tobytes() + b"".join(texts), 1)


def unpacked_texts(data: bytes) -> pa.StringArray:
    raw = zlib.decompress(data)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    ends = np.cumsum(np.frombuffer(raw, "<u4", n, 4), dtype=np.int32)
    offsets = np.concatenate([np.zeros(1, np.int32), ends])
    return pa.StringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(raw[4 * (n + 1) :]))


class _Block:
    """Pieces are numbered as they come, so frequent ones get small numbers."""

    def __init__(self) -> None:
        self.index: defaultdict[bytes | str, int] = defaultdict(count().__next__)
        self.ids, self.n_bytes, self.sizes, self.places, self.counts = [], [], [], [], []

    def add(self, name: pa.Scalar, text: bytes, pieces: list, in_order: bool) -> None:
        found = pieces if in_order else Counter(pieces)
        self.ids.append(name.as_py())
        self.n_bytes.append(len(text))
        self.sizes.append(len(found))
        self.places.append(np.fromiter(map(self.index.__getitem__, found), np.uint32, len(found)))
        if not in_order:
            self.counts.append(np.fromiter(found.values(), np.uint32, len(found)))

    def rows(self, number: int, n_slices: int, schema: pa.Schema) -> pa.RecordBatch:
        """One row of documents, which also says in what slice each piece is, and a row for each slice."""
        pieces = [piece if isinstance(piece, bytes) else piece.encode() for piece in self.index]
        slices = np.fromiter(map(zlib.crc32, pieces), np.uint32, len(pieces)) % np.uint32(n_slices)
        order = np.argsort(slices, kind="stable")
        kinds, firsts = np.unique(slices[order], return_index=True)
        ends = [*firsts[1:].tolist(), len(pieces)]
        texts = [packed_texts([pieces[place] for place in order[a:b].tolist()]) for a, b in zip(firsts.tolist(), ends)]
        docs = [self.ids, self.n_bytes, self.sizes, packed([slices]), packed(self.places), packed(self.counts)]
        columns = [
            pa.array([number] * (len(kinds) + 1), pa.int64()),
            pa.array([-1, *kinds.tolist()], pa.int32()),
            pa.array([None, *texts], pa.binary()),
            *[pa.array([value, *[None] * len(kinds)], kind) for value, kind in zip(docs, schema.types[3:])],
        ]
        return pa.RecordBatch.from_arrays(columns, schema=schema)


def blocks(docs: DataFrame, id_col: str, text_col: str, cut: Callable[[bytes], list], in_order: bool) -> DataFrame:
    """``docs`` as a table of blocks, bucketed by ``block`` in the shared folder.

    ``cut`` makes a text into pieces, bytes or strings. With ``in_order``, ``places`` names the piece at each
    position of each document; otherwise it names each distinct piece once and ``counts`` says how often it occurs.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).cast("binary").alias("text"))
    kind = dict(slim.dtypes)["id"]
    schema = (
        f"block long, slice int, pieces binary, ids array<{kind}>, n_bytes array<long>, sizes array<int>,"
        " slices binary, places binary, counts binary"
    )
    id_type = slim.select("id").limit(0).toArrow().schema.field("id").type
    arrow = pa.schema(
        [
            ("block", pa.int64()),
            ("slice", pa.int32()),
            ("pieces", pa.binary()),
            ("ids", pa.list_(id_type)),
            ("n_bytes", pa.list_(pa.int64())),
            ("sizes", pa.list_(pa.int32())),
            ("slices", pa.binary()),
            ("places", pa.binary()),
            ("counts", pa.binary()),
        ]
    )
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size, block = TaskContext.get().partitionId() << 32, 0, _Block()
        for batch in batches:
            for name, value in zip(batch.column(0), batch.column(1)):
                text = value.as_py()
                if size and size + len(text) > BLOCK_BYTES:
                    yield block.rows(number, SLICES * buckets, arrow)
                    number, size, block = number + 1, 0, _Block()
                block.add(name, text, cut(text), in_order)
                size += len(text) + 1
        if size:
            yield block.rows(number, SLICES * buckets, arrow)

    return written_in_buckets(slim.mapInArrow(made, schema), "blocks", buckets, "block")


def looked_up(table: DataFrame, find: Callable[[list[str]], dict[str, pa.Array]], schema: str) -> DataFrame:
    """``find`` applied to every distinct piece; ``(in_block, slice)`` with a packed column for each result.

    ``find`` returns columns of whole numbers, one for each piece; a column of lists comes back as two, sizes and
    values. Rows of one slice, by the hash of the pieces, follow each other, and a piece is looked at once for all blocks
    in a batch of Spark's (ten thousand rows by default).
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [unpacked_texts(data.as_py()) for data in batch.column("pieces")]
            if not texts:
                continue
            coded = pa.concat_arrays(texts).dictionary_encode()
            results = find(coded.dictionary.to_pylist())
            ends = np.cumsum([len(one) for one in texts])
            columns = {"in_block": batch.column("block"), "slice": batch.column("slice")}
            for name, values in results.items():
                whole = values.take(coded.indices)
                parts = [whole.slice(a, b - a) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
                if pa.types.is_list(values.type):
                    sizes = [packed([np.diff(part.offsets.to_numpy())]) for part in parts]
                    columns[f"{name}_sizes"] = pa.array(sizes, pa.binary())
                    parts = [part.flatten() for part in parts]
                columns[name] = pa.array([packed([part.to_numpy()]) for part in parts], pa.binary())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    pieces = table.where("slice >= 0").select("block", "slice", "pieces")
    return pieces.repartition("slice").sortWithinPartitions("slice").mapInArrow(found, f"in_block long, slice int, {schema}")


def by_place(group: pa.Table, name: str) -> np.ndarray:
    """A packed result column of one block, slice after slice."""
    order = np.argsort(group["slice"].to_numpy(), kind="stable").tolist()
    return np.concatenate([np.zeros(0, np.uint32), *[unpacked(group[name][place].as_py()) for place in order]])


def ranks(slices: bytes) -> np.ndarray:
    """Where the pieces of a block, as they are numbered, stand when slices follow one another."""
    order = np.argsort(unpacked(slices), kind="stable")
    places = np.zeros(len(order), np.int64)
    places[order] = np.arange(len(order))
    return places
