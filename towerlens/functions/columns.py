"""Expressions for one row."""

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from towerlens import fixed

# Texts that a delimited file uses for a missing value.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def known_text(column: Column) -> Column:
    """Trimmed text, null for the texts that stand for a missing value."""
    text = F.trim(column)
    return F.when(~text.isin(MISSING_TEXTS), text)


def comma_double(column: Column) -> Column:
    """Number from text with a decimal comma; anything else becomes null, never NaN.

    The comma is replaced in an array of one: Spark compiles a projection with such a function column by column. The
    columns of a wide table would else be one method, too large for the JVM to compile, which then interprets it.
    """
    with_point = F.transform(F.array(column), lambda text: F.replace(text, F.lit(","), F.lit(".")))
    text = F.lower(F.trim(F.get(with_point, F.lit(0))))
    # The JVM also reads "1d" and "1f" as numbers; in a data file these are junk.
    suffixed = text.endswith("d") | (text.endswith("f") & ~text.endswith("inf"))
    return without_nan(F.when(~suffixed, text).try_cast("double"))


def comma_long(column: Column) -> Column:
    """Whole number from text, also when written with a decimal comma (``2,0``)."""
    as_double = comma_double(column)
    whole = F.when(as_double == F.floor(as_double), as_double).try_cast("bigint")
    return F.coalesce(F.trim(column).try_cast("bigint"), whole)


def number_array(numbers: Sequence[float], dtype: str) -> Column:
    """A constant array of many numbers, as one literal."""
    return F.from_json(F.lit(json.dumps(list(numbers))), f"array<{dtype}>")


def range_number(value: Column, cuts: Sequence[float], dtype: str) -> Column:
    """How many of the ascending ``cuts`` lie below ``value``, found in two steps of about their root."""
    cuts = list(cuts)
    step = max(1, round(len(cuts) ** 0.5))

    def below(found: Column) -> Column:
        return F.size(F.filter(found, lambda cut: cut < value))

    coarse = F.greatest(below(number_array(cuts[::step], dtype)) - 1, F.lit(0)) * step
    return coarse + below(F.slice(number_array(cuts, dtype), coarse + 1, step))


def comma_text(column: Column) -> Column:
    """Number written with a decimal comma."""
    return F.replace(column.cast("string"), F.lit("."), F.lit(","))


def without_nan(column: Column) -> Column:
    """NaN counts as a value in Spark aggregates; here it means missing."""
    return F.nanvl(column, F.lit(None).cast("double"))


def day_of(start_time: Column) -> Column:
    """The ``DD.MM`` a start time begins with."""
    return F.substring(start_time, 1, 5)


def short_date(text: Column) -> Column:
    """Date from ``DD.MM.YY`` text; null where there is no such day.

    Spark reads every two-digit year as 20YY, so the usual century rule is applied first.
    """
    year = F.substring(text, 7, 2)
    century = F.when(year >= fixed.FIRST_YEAR_OF_1900S, "19").otherwise("20")
    return F.try_to_date(F.concat(F.substring(text, 1, 6), century, year), "dd.MM.yyyy")


def date_of(day: Column, year_suffix: str = fixed.YEAR_SUFFIX) -> Column:
    """Date from ``DD.MM`` text and a fixed year; null where there is no such day."""
    return short_date(F.concat(day.cast("string"), F.lit(year_suffix)))


def is_weekend(date: Column) -> Column:
    return F.weekday(date) >= 5


def largest(columns: Sequence[Column]) -> Column:
    """Row-wise maximum that skips nulls, for any number of columns."""
    return F.greatest(*columns) if len(columns) > 1 else columns[0]


def first_largest(scores: Mapping[str, Column], empty_as_first: bool = True) -> Column:
    """Label of the largest score. Ties go to the first label, and so do rows without any positive
    score unless ``empty_as_first`` is off, which leaves them null."""
    top = largest(list(scores.values()))
    label = F.coalesce(*[F.when(score == top, F.lit(name)) for name, score in scores.items()])
    return label if empty_as_first else F.when(top > 0, label)


def code_label(code: Column, labels: Mapping) -> Column:
    """Label of a code; unmapped codes stay null."""
    return F.coalesce(*[F.when(code == value, F.lit(label)) for value, label in labels.items()])


def bin_number(value: Column, low: Column, high: Column, bins: int) -> Column:
    """1-based equal-width bin; the last bin includes its upper edge."""
    return F.least(F.width_bucket(value, low, high, F.lit(bins)), F.lit(bins)).cast("int")


def percent_slot(key: Column) -> Column:
    """Number 0..99 fixed by the key alone, the same on every run and engine."""
    digest = F.md5(key.cast("string").cast("binary"))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100).cast("int")
