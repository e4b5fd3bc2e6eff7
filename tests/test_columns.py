import datetime

import pytest
from pyspark.sql import functions as F

from towerlens.functions import columns as c


def evaluated(spark, column, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(column(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "text, number",
    [("99,93", 99.93), ("5", 5.0), (" -1,5e3 ", -1500.0), ("", None), (None, None), ("NA", None),
     ("NaN", None), ("x", None), ("12d", None), ("12f", None), ("1,2,3", None), ("1.25", 1.25)],
)
def test_comma_double(spark, text, number):
    assert evaluated(spark, c.comma_double, text) == number


@pytest.mark.parametrize(
    "text, number",
    [("9007199254740993", 9007199254740993), ("2,0", 2), ("2,5", None), ("x", None), ("", None)],
)
def test_comma_long(spark, text, number):
    assert evaluated(spark, c.comma_long, text) == number


@pytest.mark.parametrize("text, kept", [("NA", None), ("null", None), (" a ", "a"), ("", None)])
def test_known_text(spark, text, kept):
    assert evaluated(spark, c.known_text, text) == kept


def test_comma_text(spark):
    assert evaluated(spark, c.comma_text, 99.93, "double") == "99,93"


@pytest.mark.parametrize(
    "text, date",
    [("01.03.02", datetime.date(2002, 3, 1)), ("01.12.95", datetime.date(1995, 12, 1)),
     ("29.02.02", None), ("junk", None), (None, None)],
)
def test_short_date(spark, text, date):
    assert evaluated(spark, c.short_date, text) == date


def test_date_of_day(spark):
    assert evaluated(spark, c.date_of, "15.04") == datetime.date(2002, 4, 15)
    assert evaluated(spark, c.date_of, None) is None
    assert evaluated(spark, c.day_of, "15.04 13:05") == "15.04"


def test_weekend(spark):
    days = {"2002-05-03": False, "2002-05-04": True, "2002-05-05": True, "2002-05-06": False}
    for day, weekend in days.items():
        assert evaluated(spark, lambda v: c.is_weekend(v.cast("date")), day) is weekend


@pytest.mark.parametrize(
    "scores, label", [((0, 0, 0), "2G"), ((1, 5, 5), "3G"), ((0, 2, 1), "3G"), ((3, 3, 0), "2G")]
)
def test_first_largest(spark, scores, label):
    df = spark.createDataFrame([scores], "a long, b long, c long")
    named = {"2G": F.col("a"), "3G": F.col("b"), "4G": F.col("c")}
    assert df.select(c.first_largest(named)).first()[0] == label
    without_default = df.select(c.first_largest(named, empty_as_first=False)).first()[0]
    assert without_default == (label if any(scores) else None)


def test_code_label(spark):
    labels = {1: "3G", 2: "4G", 3: "2G"}
    got = [evaluated(spark, lambda v: c.code_label(v, labels), v, "int") for v in (1, 2, 3, 9, None)]
    assert got == ["3G", "4G", "2G", None, None]


def test_percent_slot_is_even(spark):
    slots = spark.range(20_000).select(c.percent_slot(F.col("id")).alias("s"))
    below = slots.where("s < 40").count()
    assert slots.where("s < 0 or s > 99").count() == 0
    assert abs(below / 20_000 - 0.4) < 0.02
