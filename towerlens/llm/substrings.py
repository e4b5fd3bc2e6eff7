"""Repeated passages by relative Lempel-Ziv parsing against an index of reference blocks.

A window is so many consecutive words of one document; every word is removed that a window covers whose words also
start anywhere else, in the same document or another. The corpus is its own reference:

1. Each window has an anchor, its first k-gram of least hash, so equal windows have equal anchors at equal offsets.
   An anchor with the words around it that its windows can reach is a reference block. Blocks are indexed by
   the hashes of anchor and block.
2. Where a block stands elsewhere too, its words can be copied from a reference: the text of least key that has it. A
   block is as long as a window or longer, so all of it is a repeated span.
3. At the boundaries of such blocks a window may be repeated although its block isn't. Such windows can only
   belong to an anchor that occurs with several different blocks; these are looked up one by one, by a
   128-bit hash. A block that occurs several times offers its windows once. A window has a reference likewise.
4. Each text is parsed from left to right: a factor begins at the first word that can be copied, takes the span that
   reaches farthest, and goes on as long as the next span continues the same place of the same reference. Words in
   no factor are literals. The words of factors are what is repeated.

All counts are combined before they are shuffled, and no group of equal anchors, blocks or windows is ever
gathered. Equal texts are parsed once and weighted by their number.

Defined results: a null text has no words; a text shorter than a window loses none; an empty table gives no
rows; repeated rows each get their row. Only the id and text columns are read, and ``cleaned`` carries the
others in a struct, so any names are fine.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from towerlens.sources.workspace import written, written_in_buckets

WINDOW = 35
BASE = 0x9E3779B97F4A7C15 | 1
OTHER_BASE = 0xD6E8FEB86659FD93 | 1
SINGLE, OFFERED, FACTOR = 0, 1, 2


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    """The powers of an odd number modulo 2^64."""
    powers = np.full(n + 1, base, np.uint64)
    powers[0] = 1
    return powers.cumprod()


class Hashes:
    """Polynomial hashes of all runs of words of one document."""

    def __init__(self, words: list[bytes], base: int = BASE) -> None:
        hashes = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))
        self.back = _powers(pow(base, -1, 1 << 64), len(words))
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(hashes * _powers(base, len(words))[:-1], out=self.sums[1:])

    def runs(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[ends] - self.sums[starts]) * self.back[starts])


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of ``width``, by doubling."""
    least, have = values, 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[: len(least) - step], least[step:])
        have += step
    return least


def anchors(hashes: Hashes, n_words: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchor of every window, and the hashes of all k-grams."""
    k = window // 2 + 1
    grams = np.arange(n_words - k + 1)
    values = hashes.runs(grams, grams + k)
    width = window - k + 1
    least = _sliding_min(values, width)
    # The first k-gram that has the least hash: the least position among those that do.
    starts = np.arange(len(least))
    first = np.full(len(least), n_words)
    for step in reversed(range(width)):
        at = starts + step
        first = np.where(values[at] == least, at, first)
    return first, values


def _around(at: np.ndarray, n_words: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last word of the block of an anchor."""
    k = window // 2 + 1
    return np.maximum(at - (window - k), 0), np.minimum(at + window, n_words)


def _blocks(window: int):
    """Texts to the reference blocks around their anchors."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[] for _ in range(5)]
            sizes = []
            for text in batch.column(3):
                words = text.as_py().split()
                if len(words) < window:
                    sizes.append(0)
                    continue
                hashes = Hashes(words)
                first, values = anchors(hashes, len(words), window)
                at = np.unique(first)
                begin, end = _around(at, len(words), window)
                whole = hashes.runs(begin, end) + _mixed((at - begin).astype(np.uint64))
                sizes.append(len(at))
                for column, part in zip(out, (at.astype(np.int32), values[at], whole)):
                    column.append(part)
            repeat = np.repeat(np.arange(len(sizes)), sizes)
            columns = [batch.column(i).take(pa.array(repeat)) for i in range(3)]
            at = np.concatenate([np.zeros(0, np.int32), *out[0]])
            hashed = [np.concatenate([np.zeros(0, np.uint64), *part]).view(np.int64) for part in out[1:3]]
            names = ["key", "check", "copies", "at", "anchor", "block"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(at), *map(pa.array, hashed)], names)

    return found


def _boundary_windows(window: int):
    """The windows to look up: those of anchors that occur with several blocks."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, starts, weights, hashed = [], [], [], ([], [])
            for row in batch.to_pylist():
                words = row["text"].split()
                hashes, others = Hashes(words), Hashes(words, OTHER_BASE)
                first, _ = anchors(hashes, len(words), window)
                status = np.full(len(words), -1, np.int8)
                status[row["at"]] = row["status"]
                start = np.flatnonzero(status[first] >= 0)
                keys.append((row["key"], row["check"], len(start)))
                starts.append(start)
                weights.append(status[first[start]].astype(np.int64) + 1)
                for column, of in zip(hashed, (hashes, others)):
                    column.append(of.runs(start, start + window).view(np.int64))
            if keys:
                n = [key[2] for key in keys]
                columns = [np.repeat(np.array([key[i] for key in keys], np.int64), n) for i in (0, 1)]
                columns += [np.concatenate(part) for part in (starts, weights, *hashed)]
                names = ["key", "check", "start", "weight", "window", "other"]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return found


def parse(spans: Iterable[tuple[int, int, int, int]], n_words: int) -> list[tuple[int, int, int, int]]:
    """Factors ``(start, end, reference, place)`` of a text from left to right, by spans of the same form that can be copied.

    A span says that its words stand in the text ``reference`` from ``place`` on. Of the spans that hold the first word
    that isn't parsed yet the one that reaches farthest is taken.
    """
    waiting = sorted(spans)
    found: list[tuple[int, int, int, int]] = []
    at, done = 0, 0
    while at < len(waiting):
        first = max(done, waiting[at][0])
        best = None
        while at < len(waiting) and waiting[at][0] <= first:
            if best is None or waiting[at][1] > best[1]:
                best = waiting[at]
            at += 1
        start, end, reference, place = best[0], min(best[1], n_words), best[2], best[3]
        if end <= first:
            continue
        place += first - start
        last = found[-1] if found else None
        if last and last[1] == first and last[2] == reference and last[3] + first - last[0] == place:
            found[-1] = (last[0], end, reference, last[3])
        else:
            found.append((first, end, reference, place))
        done = end
    return found


def _kept(as_it_was: bool):
    """Texts and their spans to factors and the words that stay; with ``as_it_was``, a text that loses none isn't touched."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("reference", pa.int64()), ("place", pa.int32())]))
    names = ["start", "end", "reference", "place"]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, check, text, *lists in zip(*(column.to_pylist() for column in batch.columns)):
                words = text.split()
                factors = parse(zip(*lists), len(words)) if lists[0] else []
                left, done, removed = [], 0, 0
                for start, end, _, _ in factors:
                    left += words[done:start]
                    removed += end - start
                    done = end
                if removed or not as_it_was:
                    text = b" ".join(left + words[done:])
                rows.append((key, check, len(words), removed, text.decode(), [dict(zip(names, one)) for one in factors]))
            columns = list(zip(*rows)) or [()] * 6
            types = [pa.int64()] * 4 + [pa.string(), kind]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["key", "check", "n_words", "n_removed", "kept", "factors"]
            )

    return found


def _keys(text_col: str) -> list:
    text = F.coalesce(text_col, F.lit(""))
    return [F.xxhash64(text).alias("key"), F.xxhash64(F.md5(text.cast("binary"))).alias("check")]


def _texts(docs: DataFrame, text_col: str) -> DataFrame:
    """Distinct texts with their number, bucketed by key so that later joins leave them where they are."""
    spark = docs.sparkSession
    text = F.coalesce(text_col, F.lit("")).alias("text")
    rows = docs.select(*_keys(text_col), text).groupBy("key", "check")
    rows = rows.agg(F.count("*").alias("copies"), F.first("text").cast("binary").alias("text"))
    return written_in_buckets(rows, "texts", int(spark.conf.get("spark.sql.shuffle.partitions")), "key", "check")


def parsed(docs: DataFrame, text_col: str = "text", window: int = WINDOW, as_it_was: bool = False) -> DataFrame:
    """``(key, check, n_words, n_removed, kept, factors)`` of every distinct text; ``kept`` has its words that stay.

    A factor is ``(start, end, reference, place)``: words of the text, and where they stand in the text of the key
    ``reference``, which may be the text itself where it is the reference of others.
    """
    texts = _texts(docs, text_col)
    schema = "key long, check long, copies long, at int, anchor long, block long"
    index = texts.select("key", "check", "copies", "text").mapInArrow(_blocks(window), schema)
    groups = index.groupBy("anchor").agg(
        F.sum("copies").alias("n"),
        F.min("block").alias("least"),
        F.max("block").alias("most"),
        F.min("key").alias("reference"),
        F.min_by("at", "key").alias("place"),
    )
    groups = groups.where("n > 1").select("anchor", (F.col("least") != F.col("most")).alias("several"), "reference", "place")
    # Written, as the rows of a frequent key are split only in joins of plain exchanges.
    repeated = written(index.join(written(groups, "anchors"), "anchor"), "repeated")

    # Anchors with several blocks: those that occur twice can be copied as well, and one place offers their windows.
    several = repeated.where("several").drop("reference", "place")
    place = F.xxhash64("key", "check", "at")
    alike = several.groupBy("anchor", "block").agg(
        F.sum("copies").alias("n"), F.min(place).alias("offering"), F.min("key").alias("reference"), F.min_by("at", "key").alias("place")
    )
    several = several.join(written(alike, "alike"), ["anchor", "block"])
    status = (
        F.when(F.col("n") == 1, SINGLE).when(F.col("offering") == place, OFFERED).otherwise(FACTOR).alias("status")
    )
    several = written(several.select("key", "check", "at", status, "reference", "place"), "several")
    asked = several.where(F.col("status") != FACTOR).groupBy("key", "check")
    asked = asked.agg(F.collect_list("at").alias("at"), F.collect_list("status").alias("status"))
    asked = texts.select("key", "check", "text").join(asked, ["key", "check"])
    schema = "key long, check long, start long, weight long, window long, other long"
    windows = written(asked.mapInArrow(_boundary_windows(window), schema), "windows")
    again = windows.groupBy("window", "other").agg(
        F.sum("weight").alias("n"), F.min("key").alias("reference"), F.min_by("start", "key").alias("place")
    )
    again = again.where("n > 1").drop("n")
    matched = windows.where("weight = 1").join(written(again, "again"), ["window", "other"])

    k = window // 2 + 1
    blocks = repeated.where("not several").select("key", "check", "at", "reference", "place")
    blocks = blocks.union(several.where(F.col("status") != SINGLE).select("key", "check", "at", "reference", "place"))
    before = F.least(F.col("at"), F.lit(window - k))
    spans = blocks.select(
        "key", "check", (F.col("at") - before).alias("start"), (F.col("at") + window).alias("end"), "reference", (F.col("place") - before).alias("place")
    )
    of_windows = [F.col("start").cast("int"), (F.col("start") + window).cast("int"), F.col("reference"), F.col("place").cast("int")]
    spans = spans.union(matched.select("key", "check", *of_windows)).groupBy("key", "check")
    # The lists of one aggregate are in the same order.
    spans = spans.agg(*[F.collect_list(name).alias(name) for name in ("start", "end", "reference", "place")])
    rows = texts.select("key", "check", "text").join(spans, ["key", "check"], "left")
    schema = "key long, check long, n_words long, n_removed long, kept string, "
    return rows.mapInArrow(_kept(as_it_was), schema + "factors array<struct<start: int, end: int, reference: long, place: int>>")


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document: its id, ``n_words``, ``n_removed`` and ``kept_sha256``, the digest of the words that
    stay, joined by one space."""
    rows = parsed(docs, text_col, window).drop("factors")
    rows = rows.select("key", "check", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
    names = docs.select(F.col(id_col).alias(id_col), *_keys(text_col))
    return names.join(rows, ["key", "check"]).drop("key", "check")


def cleaned(docs: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """All rows and columns of ``docs`` with repeated passages cut out of the text.

    A text that loses words is returned as the others, joined by one space; it may be empty. Other texts stay as they
    are, nulls too.
    """
    rows = parsed(docs, text_col, window, as_it_was=True).select("key", "check", "kept")
    others = [F.col(f"`{name}`") for name in docs.columns if name != text_col]
    slim = docs.select(*_keys(text_col), F.col(text_col).isNull().alias("missing"), F.struct(F.lit(0), *others).alias("row"))
    joined = slim.join(rows, ["key", "check"])
    text = F.when(~F.col("missing"), F.col("kept")).alias(text_col)
    return joined.select(*[text if name == text_col else F.col("row")[name].alias(name) for name in docs.columns])


ORACLE = rf"""
WITH rows AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT k, p, array_to_string(words[p:p + {WINDOW - 1}], ' ') AS w
  FROM (SELECT k, words, unnest(range(1, len(words) - {WINDOW - 2})) AS p FROM rows WHERE len(words) >= {WINDOW})
), again AS (
  SELECT k, p FROM (SELECT k, p, count(*) OVER (PARTITION BY w) AS n FROM windows) WHERE n > 1
), gone AS (
  SELECT DISTINCT k, unnest(range(p, p + {WINDOW})) AS p FROM again
), left_over AS (
  SELECT r.k, count(g.p) AS n_removed, coalesce(string_agg(r.word, ' ' ORDER BY r.p) FILTER (g.p IS NULL), '') AS kept
  FROM (SELECT k, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM rows) r
  LEFT JOIN gone g ON g.k = r.k AND g.p = r.p GROUP BY r.k
)
SELECT doc_id, len(words) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM rows LEFT JOIN left_over USING (k)
"""
