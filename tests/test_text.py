import pytest

from cohortlens.functions.text import na_to_null, to_number


@pytest.mark.parametrize("raw,expected", [
    ("12", 12.0), (" 7.5 ", 7.5), ("-3", -3.0), ("1e3", 1000.0), (".5", 0.5),
    ("5d", None), ("5f", None), ("Less than 1 year", None), ("More than 50 years", None),
    ("", None), (None, None), ("12abc", None),
])
def test_to_number(spark, raw, expected):
    got = spark.createDataFrame([(raw,)], "s string").select(to_number("s").alias("x")).collect()[0].x
    assert got == expected


@pytest.mark.parametrize("raw,expected", [
    ("NA", None), ("", None), ("N/A", None), ("null", None), ("nan", None), ("None", None),
    ("Python", "Python"), ("NA;Go", "NA;Go"), (" NA", " NA"),
])
def test_na_to_null(spark, raw, expected):
    got = spark.createDataFrame([(raw,)], "s string").select(na_to_null("s").alias("x")).collect()[0].x
    assert got == expected
