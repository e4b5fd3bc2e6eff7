"""Quality rules with thresholds that adapt to each language and source, in built-in functions only.

Defined results: a null text is an empty text, which fails the base rules; null languages and sources are
groups of their own; rows are judged one by one, so repeated rows get the same verdict each; an empty table
gives no rows. The caller's columns travel in one struct, so any names are fine.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from towerlens.sources.workspace import written

SPACE = " \t\n\x0b\x0c\r"
WINDOW = 8
# Base rules: fewest words, and the most words in repeated windows, per cent.
LEAST_WORDS = 20
MOST_REPEATED = 30
# The sketch of a language counts in those of its groups as much as so many documents; that of all in those of languages.
PRIOR_DOCS = 100
# Spreads above the third quartile that are still accepted.
SPREADS = 3
# Measures, each a whole number, and the least spread assumed for each.
MEASURES = {
    "symbols": 15,  # per 1000 characters of words
    "shouts": 50,  # runs of capitals per 1000 words
    "repeated_lines": 150,  # per 1000 lines
    "word_length": 20,  # tenths of a character
}
# Sketch buckets keep so many leading bits of a value: an error of 1 in 16 at most.
BITS = 5


def _measured(rows: DataFrame) -> DataFrame:
    """Adds counts to ``rows`` ``(row, lang, source, text)`` and drops the text.

    Each step is a column of its own, as the optimizer would otherwise evaluate the long ones several times.
    """
    trimmed = F.btrim("text", F.lit(SPACE))
    rows = rows.withColumn("words", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+")))
    rows = rows.select(
        "row",
        "lang",
        "source",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit(r"\p{Lu}{2,}")).cast("long").alias("n_shouts"),
        F.filter(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "").alias("lines"),
    )
    count = F.size("words") - (WINDOW - 1)
    hashes = F.transform(F.sequence(F.lit(1), count), lambda at: F.xxhash64(F.slice("words", at, WINDOW)))
    rows = rows.withColumn("windows", F.when(count > 0, hashes).otherwise(F.array().cast("array<bigint>")))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    found = F.sort_array(F.transform("windows", lambda window, at: F.struct(window.alias("window"), at.alias("at"))))
    rows = rows.withColumn("found", F.when(repeats, found))

    def met_again(item: Column, at: Column) -> Column:
        same = [F.get("found", at + step)["window"] == item["window"] for step in (-1, 1)]
        return F.coalesce(same[0], F.lit(False)) | F.coalesce(same[1], F.lit(False))

    starts = F.sort_array(F.transform(F.filter("found", met_again), lambda item: item["at"]))
    rows = rows.withColumn("starts", F.when(F.col("found").isNotNull(), starts))
    covered = F.transform(
        "starts", lambda start, at: F.least(F.lit(WINDOW), F.coalesce(F.get("starts", at + 1) - start, F.lit(WINDOW)))
    )
    rows = rows.select(
        "row",
        "lang",
        "source",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_shouts",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.aggregate(covered, F.lit(0), lambda total, one: total + one), F.lit(0)).cast("long").alias("n_repeat_words"),
    )
    return rows.withColumn(
        "base_failed",
        (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")),
    )


def _measures() -> list[Column]:
    """The measures of one row, in the order of MEASURES."""
    rate = "try_divide({0} * {1}, {2})"
    sums = {
        "symbols": rate.format(1000, "n_symbols", "word_chars"),
        "shouts": rate.format(1000, "n_shouts", "n_words"),
        "repeated_lines": rate.format(1000, "n_dup_lines", "n_lines"),
        "word_length": rate.format(10, "word_chars", "n_words"),
    }
    return [F.coalesce(F.floor(F.expr(sums[name])), F.lit(0)).cast("long").alias(name) for name in MEASURES]


def sketch(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Quantile sketch of ``value`` (a whole number from 0) per group: ``(keys, bucket, n)``.

    Buckets keep the leading bits of a value, so each group has a bounded number of them, and two sketches are
    merged by adding up ``n``.
    """
    dropped = F.greatest(F.length(F.bin(value)) - BITS, F.lit(0))
    bucket = F.expr(f"shiftleft(shiftright({value}, _dropped), _dropped)")
    return rows.withColumn("_dropped", dropped).groupBy(*keys, bucket.alias("bucket")).agg(F.count("*").alias("n"))


def merged(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches with fewer keys."""
    return sketches.groupBy(*keys, "bucket").agg(F.sum("n").alias("n"))


def _wide(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("decimal(38,0)")


def _with_prior(sketches: DataFrame, prior: DataFrame, keys: list[str], above: list[str]) -> DataFrame:
    """Sketches to which those of the group above are added as if they were PRIOR_DOCS documents: ``(keys, measure, bucket, n)``.

    ``prior`` has the same columns with the keys ``above``, some of ``keys``. As whole numbers: each count times the size
    of the sketch above, plus PRIOR_DOCS times the count above. There are as many sums as groups and buckets.
    """
    renamed = prior.select(*[F.col(name).alias(f"_{name}") for name in [*above, "measure", "bucket"]], F.col("n").alias("_n"))
    sizes = renamed.groupBy(*[f"_{name}" for name in [*above, "measure"]]).agg(F.sum("_n").alias("_all"))

    def same(other: DataFrame) -> Column:
        matched = F.col("measure") == other["_measure"]
        for name in above:
            matched = matched & F.col(name).eqNullSafe(other[f"_{name}"])
        return matched

    own = sketches.join(sizes, same(sizes)).select(*keys, "measure", "bucket", (_wide("n") * _wide("_all")).cast("decimal(38,0)").alias("n"))
    groups = sketches.select(*keys, "measure").distinct()
    added = groups.join(renamed, same(renamed)).select(
        *keys, "measure", F.col("_bucket").alias("bucket"), (F.lit(PRIOR_DOCS) * _wide("_n")).cast("decimal(38,0)").alias("n")
    )
    return own.union(added).groupBy(*keys, "measure", "bucket").agg(F.sum("n").cast("decimal(38,0)").alias("n"))


def _cuts(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Per group and as a column for each measure the greatest accepted value."""
    group = Window.partitionBy(*keys, "measure")
    upto, total = F.sum("n").over(group.orderBy("bucket")), F.sum("n").over(group)
    ranked = sketches.withColumn("upto", _wide(upto)).withColumn("total", _wide(total))
    quartiles = ranked.groupBy(*keys, "measure").agg(
        F.min(F.when(4 * F.col("upto") >= F.col("total"), F.col("bucket"))).alias("q1"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("total"), F.col("bucket"))).alias("q3"),
    )
    least = F.create_map(*[F.lit(item) for pair in MEASURES.items() for item in pair])[F.col("measure")]
    cut = F.col("q3") + SPREADS * F.greatest(F.col("q3") - F.col("q1"), least)
    return quartiles.groupBy(*keys).agg(*[F.max(F.when(F.col("measure") == name, cut)).alias(name) for name in MEASURES])


def thresholds(measured: DataFrame) -> DataFrame:
    """The greatest accepted value of each measure per ``lang`` and ``source``, over documents that pass the base rules.

    To a group's sketch that of its language is added with the weight of PRIOR_DOCS documents, and to that of the
    language likewise that of all. So a small group is judged much like its language and a large one by itself, and
    no single document switches from one to the other.
    """
    named = [F.struct(F.lit(name).alias("measure"), value.alias("value")) for name, value in zip(MEASURES, _measures())]
    values = measured.where(~F.col("base_failed")).select("lang", "source", F.explode(F.array(*named)).alias("m"))
    values = values.select("lang", "source", "m.measure", "m.value")
    fine = written(sketch(values, ["lang", "source", "measure"], "value"), "sketches")
    languages = merged(fine, ["lang", "measure"])
    languages = written(_with_prior(languages, merged(languages, ["measure"]), ["lang"], []), "sketches")
    rows = _cuts(_with_prior(fine, languages, ["lang", "source"], ["lang"]), ["lang", "source"])
    return rows.select("lang", "source", F.struct(*MEASURES).alias("cut"))


def _judged(docs: DataFrame, carried: list[str], text_col: str, lang_col: str, source_col: str) -> DataFrame:
    rows = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in carried]).alias("row"),
        F.col(lang_col).alias("lang"),
        F.col(source_col).alias("source"),
        F.coalesce(text_col, F.lit("")).alias("text"),
    )
    rows = written(_measured(rows), "measured")
    cuts = written(thresholds(rows), "thresholds").toDF("_lang", "_source", "cut")
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    within = [value <= F.col("cut")[name] for name, value in zip(MEASURES, _measures())]
    verdict = within[0]
    for one in within[1:]:
        verdict = verdict & one
    return rows.join(cuts, same, "left").withColumn("kept", ~F.col("base_failed") & F.coalesce(verdict, F.lit(False)))


def verdicts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """One row per document: its id, the counts, ``base_failed`` and ``kept``."""
    return _judged(docs, [id_col], text_col, lang_col, source_col).select(
        F.col("row")[id_col].alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    return _judged(docs, docs.columns, text_col, lang_col, source_col).where("kept").select("row.*")


WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLE = rf"""
WITH rows AS (
  SELECT row_number() OVER () AS k, doc_id, lang, source, coalesce(text, '') AS text, {WORDS_SQL} AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT k, p, array_to_string(words[p:p + {WINDOW - 1}], ' ') AS w
  FROM (SELECT k, words, unnest(range(1, len(words) - {WINDOW - 2})) AS p FROM rows WHERE len(words) >= {WINDOW})
), again AS (
  SELECT k, p FROM (SELECT k, p, count(*) OVER (PARTITION BY k, w) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT k, count(DISTINCT p + d) AS n FROM (SELECT k, p, unnest(range(0, {WINDOW})) AS d FROM again) GROUP BY k
), counted AS (
  SELECT r.*, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
    len(regexp_extract_all(text, '\p{{Lu}}{{2,}}')) AS n_shouts,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM rows r LEFT JOIN covered c USING (k)
), measured AS (
  SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
    coalesce(1000 * n_symbols // nullif(word_chars, 0), 0) AS symbols,
    coalesce(1000 * n_shouts // nullif(n_words, 0), 0) AS shouts,
    coalesce(1000 * n_dup_lines // nullif(n_lines, 0), 0) AS repeated_lines,
    coalesce(10 * word_chars // nullif(n_words, 0), 0) AS word_length
  FROM counted
), long AS (
  UNPIVOT (SELECT k, lang, source, symbols, shouts, repeated_lines, word_length FROM measured WHERE NOT base_failed)
  ON symbols, shouts, repeated_lines, word_length INTO NAME measure VALUE v
), bucketed AS (
  SELECT lang, source, measure, (v >> d) << d AS b
  FROM (SELECT *, greatest(length(ltrim(bin(v), '0')) - {BITS}, 0) AS d FROM long)
), own AS (
  SELECT lang, source, measure, b, count(*)::HUGEINT AS n FROM bucketed GROUP BY ALL
), every AS (
  SELECT measure, b, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY measure) AS total FROM own GROUP BY measure, b
), languages AS (
  SELECT lang, measure, b, sum(n) AS n FROM (
    SELECT lang, o.measure, o.b, n * total AS n FROM own o JOIN (SELECT DISTINCT measure, total FROM every) t USING (measure)
    UNION ALL SELECT lang, measure, e.b, {PRIOR_DOCS} * e.n FROM (SELECT DISTINCT lang, measure FROM own) JOIN every e USING (measure)
  ) GROUP BY ALL
), sizes AS (
  SELECT lang, measure, sum(n) AS total FROM languages GROUP BY ALL
), mixed AS (
  SELECT lang, source, measure, b, sum(n) AS n FROM (
    SELECT o.lang, source, o.measure, b, n * total AS n FROM own o
    JOIN sizes t ON t.measure = o.measure AND t.lang IS NOT DISTINCT FROM o.lang
    UNION ALL SELECT g.lang, source, g.measure, b, {PRIOR_DOCS} * n FROM (SELECT DISTINCT lang, source, measure FROM own) g
    JOIN languages l ON l.measure = g.measure AND l.lang IS NOT DISTINCT FROM g.lang
  ) GROUP BY ALL
), ranked AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, source, measure ORDER BY b) AS upto,
    sum(n) OVER (PARTITION BY lang, source, measure) AS total FROM mixed
), quartiles AS (
  SELECT lang, source, measure, min(b) FILTER (4 * upto >= total) AS q1, min(b) FILTER (4 * upto >= 3 * total) AS q3
  FROM ranked GROUP BY ALL
), chosen AS (
  SELECT *, q3 + {SPREADS} * greatest(q3 - q1, CASE measure {" ".join(f"WHEN '{k}' THEN {v}" for k, v in MEASURES.items())} END) AS cut
  FROM quartiles
), over AS (
  SELECT DISTINCT k FROM long n JOIN chosen c
  ON c.measure = n.measure AND c.lang IS NOT DISTINCT FROM n.lang AND c.source IS NOT DISTINCT FROM n.source
  WHERE n.v > c.cut
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND k NOT IN (SELECT k FROM over) AS kept
FROM measured
"""
