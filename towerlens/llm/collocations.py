"""Phrases whose words occur together more often than apart, from sorted streams of n-gram counts.

Texts are cut into pieces at punctuation and line ends, and pieces into words; n-grams stay within a piece.

1. Tasks count the n-grams of blocks of text; equal ones are added up, and rare ones go. What is left is a stream of
   ``(lang, words, f)`` with one entry of no words for each language, whose count is that of all its words.
2. The stream is put in suffix order (words from last to first) by ranges. There, every phrase follows its own
   suffixes, so one pass in lockstep with the counts of the suffixes gives the right parts of all its cuts. The same
   in prefix order gives the left parts. Nothing is looked up by hash: a pass keeps the latest count of each length.
   A range that starts amid a phrase's extensions takes those counts from the ranges before it, one row each.
3. Beside a phrase now stand the counts of all its parts. Scores are exact, in decimals of 38 digits. A longer
   phrase names the parts without its first or last word that it explains, which are two at most on either side.
4. Ranks come from ranges in the order of the result, so no language is gathered in one task.

Defined results: a null text is an empty text; a null language counts as ``und``; only ASCII letters are lower-cased; ties
go by count, then phrase in the order of UTF-8 bytes; repeated rows count as often as they stand there; an empty
table gives no rows. Only the two named columns are read. A text is one row, and so is assumed to fit a task.
"""

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from towerlens.llm.places import placed
from towerlens.sources.workspace import written

LONGEST, LEAST = 3, 10
# A candidate goes if a longer one has at least this share of its count, per cent.
EXPLAINED = 50
TOP = 2000
SCALE = 1_000_000
# Bytes of text whose n-grams are counted together.
BLOCK_BYTES = 8 << 20
# Rows that a task hands back at a time.
BATCH = 1 << 16
# Between a word and its number of times; no word holds it.
TIMES = "\t"
BREAK = b"."
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + BREAK * 9)


class _Block:
    """Texts of one language as numbers of words; 0 stands between pieces."""

    def __init__(self) -> None:
        self.index: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.parts, self.size = [], 0
        self.index[BREAK]

    def add(self, text: bytes) -> None:
        words = text.translate(_PLAIN).replace(BREAK, b" . ").split()
        words.append(BREAK)
        self.parts.append(np.fromiter(map(self.index.__getitem__, words), np.int32, len(words)))
        self.size += len(text) + 1

    def counted(self, longest: int) -> Iterator[tuple[pa.Array, np.ndarray, pa.Array | None]]:
        """Distinct n-grams of fewer than ``longest`` words, joined by spaces, and how often each occurs.

        The longest n-grams stand beside the one that they extend, as the words that follow it; a number of times
        other than one is behind the word.
        """
        words = np.concatenate(self.parts).astype(np.int64)
        names = pa.array(list(self.index), pa.binary()).cast(pa.string())
        yield pa.array([""], pa.string()), np.array([np.count_nonzero(words)]), None
        kinds = len(names)
        # The number of the n-gram that starts at each place, or -1; for single words, one less than the word's.
        starts, grams, found = words - 1, names[1:], np.bincount(words, minlength=kinds)[1:]
        for n in range(2, longest + 1):
            starts, ends = starts[:-1], words[len(words) - len(starts) + 1 :]
            whole = np.flatnonzero((starts >= 0) & (ends > 0))
            distinct, number, times = np.unique(starts[whole] * kinds + ends[whole], return_inverse=True, return_counts=True)
            first, last = distinct // kinds, names.take(pa.array(distinct % kinds))
            if n == longest:
                often = pc.binary_join_element_wise(last, pa.array(times).cast(pa.string()), TIMES)
                last = pc.if_else(pa.array(times > 1), often, last)
                cuts = np.searchsorted(first, np.arange(len(grams) + 1)).astype(np.int32)
                yield grams, found, pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts), last), " ")
                return
            yield grams, found, None
            grams, found = pc.binary_join_element_wise(grams.take(pa.array(first)), last, " "), times
            starts = np.full(len(starts), -1)
            starts[whole] = number.ravel()


def _count(longest: int):
    """Texts to the n-grams of blocks and their counts."""

    def rows(blocks: dict[str, _Block]) -> Iterator[pa.RecordBatch]:
        for lang, block in blocks.items():
            for grams, found, further in block.counted(longest):
                langs = pa.repeat(pa.scalar(lang, pa.string()), len(grams))
                further = pa.nulls(len(grams), pa.string()) if further is None else further
                batch = pa.RecordBatch.from_arrays([langs, grams, pa.array(found, pa.int64()), further], ["lang", "phrase", "f", "further"])
                for at in range(0, len(grams), BATCH):
                    yield batch.slice(at, BATCH)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, size = defaultdict(_Block), 0
        for batch in batches:
            for lang, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = value.as_py()
                blocks[lang].add(text)
                size += len(text) + 1
                if size >= BLOCK_BYTES:
                    yield from rows(blocks)
                    blocks, size = defaultdict(_Block), 0
        yield from rows(blocks)

    return counted


def counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(lang, words, n, f)``: n-grams of up to ``longest`` words that occur ``least`` times or more in a language.

    An entry of no words has the number of all words of its language. Blocks of text count their own n-grams, so a
    phrase has one row for each block. As none is more frequent than its first words, the longest n-grams travel with
    those, in the same shuffle, and are only taken apart where these are frequent enough.
    """
    if longest < 2:
        raise ValueError("phrases have two words or more")
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(text_col, F.lit("")).cast("binary").alias("text"))
    found = texts.mapInArrow(_count(longest), "lang string, phrase string, f long, further string")
    every = F.sum("f").over(Window.partitionBy("lang", "phrase"))
    found = found.withColumn("every", every).where((F.col("every") >= least) | (F.col("phrase") == ""))

    def extension(one: Column) -> Column:
        times = F.coalesce(F.get(F.split(one, TIMES), F.lit(1)).try_cast("bigint"), F.lit(1))
        return F.struct(F.substring_index(one, TIMES, 1).alias("word"), times.alias("f"))

    further = F.when(F.col("further") != "", F.transform(F.split("further", " "), extension))
    own = F.array(F.struct(F.lit("").alias("word"), F.col("f").alias("f")))
    found = found.select("lang", "phrase", F.inline(F.concat(own, F.coalesce(further, F.array().cast("array<struct<word:string,f:bigint>>")))))
    found = found.groupBy("lang", "phrase", "word").agg(F.sum("f").alias("f")).where((F.col("f") >= least) | (F.col("phrase") == ""))
    words = F.when(F.col("phrase") == "", F.array().cast("array<string>")).otherwise(F.split("phrase", " "))
    words = F.when(F.col("word") == "", words).otherwise(F.array_append(words, F.col("word")))
    return found.select("lang", words.alias("words"), "f").select("lang", "words", F.size("words").alias("n"), "f")


def _latest(depths: int):
    """One pass over a sorted range: beside every entry the latest count of each smaller number of words before it.

    Where the range has none yet, it is -1. ``at`` is the place in the range.
    """

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        latest, done = np.full(depths, -1, np.int64), 0
        for batch in batches:
            n, f = batch.column("n").to_numpy(), batch.column("f").to_numpy()
            before = np.empty((len(n), depths), np.int64)
            for depth in range(depths):
                known = np.concatenate([latest[depth : depth + 1], f])
                places = np.maximum.accumulate(np.where(n == depth, np.arange(1, len(n) + 1), 0))
                before[:, depth] = known[places]
            if len(n):
                latest = before[-1].copy()
            offsets = pa.array(np.arange(len(n) + 1, dtype=np.int32) * depths)
            lists = pa.ListArray.from_arrays(offsets, pa.array(before.ravel()))
            at = pa.array(np.arange(done, done + len(n)))
            done += len(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, at], [*batch.schema.names, "parts", "at"])

    return passed


def with_parts(stream: DataFrame, key: Column, name: str, longest: int = LONGEST) -> DataFrame:
    """``stream`` ``(lang, words, n, f, ...)`` with ``name``: the counts of the phrase's first words in the order of ``key``.

    ``key`` is the array of words in prefix or in suffix order; ``name[k]`` is the count of its first ``k`` words, for
    ``k`` below ``n``. In the order of (lang, key) they are the latest of ``k`` words before the phrase.
    """
    columns = stream.columns
    parts = int(stream.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = stream.withColumn("key", key).repartitionByRange(parts, "lang", "key").sortWithinPartitions("lang", "key").drop("key")
    kinds = ", ".join(f"`{field}` {kind}" for field, kind in rows.dtypes)
    rows = rows.mapInArrow(_latest(longest), f"{kinds}, parts array<long>, at long")
    rows = written(rows.withColumn("range", F.spark_partition_id()), "stream")

    last = [F.max_by("f", F.when(F.col("n") == depth, F.col("at"))).alias(f"d{depth}") for depth in range(longest)]
    latest, carried = [None] * longest, []
    # One row for each range.
    for number, *ends in sorted(map(tuple, rows.groupBy("range").agg(*last).collect())):
        carried.append((number, list(latest)))
        latest = [latest[depth] if end is None else end for depth, end in enumerate(ends)]
    carried = stream.sparkSession.createDataFrame(carried, "_range int, before array<long>")
    rows = rows.join(F.broadcast(carried), F.col("range") == F.col("_range"))
    filled = F.zip_with("parts", "before", lambda own, before: F.when(own >= 0, own).otherwise(before))
    return rows.select(*columns, F.slice(filled, 1, F.col("n")).alias(name))


def _wide(value: Column) -> Column:
    return value.cast("decimal(19,0)")


def scored(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(lang, words, a, l, r, n, score)`` of every phrase of 2 to ``longest`` words that no longer one explains.

    ``a`` is the phrase's count, ``l`` and ``r`` those of its parts at the cut of least score, ``n`` that of all words.
    """
    stream = written(counts(docs, longest, least, text_col, lang_col), "counts")
    stream = with_parts(stream, F.reverse("words"), "right", longest)
    stream = written(with_parts(stream, F.col("words"), "left", longest), "phrases")

    def cut(k: Column) -> Column:
        left, right = F.get("left", k), F.get("right", F.col("n") - k)
        whole = F.lit(SCALE).cast("decimal(7,0)") * _wide(F.col("f")) * _wide(F.col("f"))
        score = F.call_function("div", whole, _wide(left) * _wide(right))
        return F.struct(score.alias("score"), k.alias("k"), left.alias("l"), right.alias("r"))

    phrases = stream.where("n >= 2")
    found = phrases.withColumn("best", F.array_min(F.transform(F.sequence(F.lit(1), F.col("n") - 1), cut)))
    explained = [
        F.when(100 * F.col("f") >= EXPLAINED * F.get(side, F.col("n") - 1), F.slice("words", start, F.col("n") - 1))
        for side, start in (("left", 1), ("right", 2))
    ]
    parts = phrases.where("n >= 3").select("lang", F.explode(F.array_compact(F.array(*explained))).alias("words")).distinct()
    found = found.join(parts, ["lang", "words"], "left_anti")
    return found.select("lang", "words", F.col("f").alias("a"), "best.l", "best.r", F.col("left")[0].alias("n"), F.col("best.score").cast("long").alias("score"))


def top_phrases(
    docs: DataFrame, top: int = TOP, longest: int = LONGEST, least: int = LEAST, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)`` of each language's first ``top`` phrases."""
    rows = scored(docs, longest, least, text_col, lang_col).withColumn("phrase", F.array_join("words", " "))
    rows = written(rows.select("lang", "phrase", "a", "l", "r", "n", "score"), "scored")
    ranked = placed(rows, "lang", [F.desc("score"), F.desc("a"), F.asc("phrase")]).where(F.col("place") < top)
    return ranked.select("lang", (F.col("place") + 1).cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS k, coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), pieces AS (
  SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS words FROM texts
), grams AS (
  {" UNION ALL ".join(f"SELECT lang, {n} AS n, array_to_string(words[p:p + {n - 1}], ' ') AS phrase FROM (SELECT lang, words, unnest(range(1, len(words) - {n - 2})) AS p FROM pieces)" for n in range(1, LONGEST + 1))}
), counts AS MATERIALIZED (
  SELECT lang, n, phrase, count(*)::HUGEINT AS f FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, sum(f) AS n FROM counts WHERE n = 1 GROUP BY lang
), candidates AS MATERIALIZED (
  SELECT *, string_split(phrase, ' ') AS words FROM counts WHERE n >= 2 AND f >= {LEAST}
), cuts AS MATERIALIZED (
  SELECT lang, phrase, f, k, array_to_string(words[1:k], ' ') AS left_part, array_to_string(words[k + 1:], ' ') AS right_part
  FROM (SELECT *, unnest(range(1, n)) AS k FROM candidates)
), best AS (
  SELECT c.lang, c.phrase, c.f AS a, k, l.f AS l, r.f AS r, {SCALE} * c.f * c.f // (l.f * r.f) AS score
  FROM cuts c
  JOIN counts l ON l.lang = c.lang AND l.phrase = left_part
  JOIN counts r ON r.lang = c.lang AND r.phrase = right_part
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1
), inside AS MATERIALIZED (
  SELECT DISTINCT lang, n, f, array_to_string(words[p:p + size - 1], ' ') AS part FROM (
    SELECT *, unnest(range(1, (n - size + 2)::BIGINT)) AS p FROM (SELECT *, unnest(range(2, n)) AS size FROM candidates WHERE n >= 3))
), explained AS (
  SELECT DISTINCT c.lang, c.phrase FROM candidates c JOIN inside x ON x.lang = c.lang AND x.part = c.phrase
  WHERE 100 * x.f >= {EXPLAINED} * c.f
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
  FROM best b ANTI JOIN explained e ON e.lang = b.lang AND e.phrase = b.phrase
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, t.n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN totals t USING (lang) WHERE rank <= {TOP}
"""
