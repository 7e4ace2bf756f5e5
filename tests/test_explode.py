"""Splitting of multi-value answers, against Python's own split and strip."""

from collections import Counter

import pytest

from cohortlens.operators.explode import explode_multival

ANSWERS = ["one", "one;two;three", " padded ;\ttabbed;last ", "a;;a", ";", "", "x|y;z", "no.sep|here", " wide ;k", None]


@pytest.mark.parametrize("sep", [";", "|", ".", "||", "\\E"])
def test_tokens(spark, sep):
    rows = [(2021 + i % 5, i, a) for i, a in enumerate(ANSWERS + [f"p{sep}q{sep}{sep} r"])]
    df = spark.createDataFrame(rows, "survey_year int, response_id long, answer string")
    got = explode_multival(df, "answer", "token", sep)
    assert got.columns == ["survey_year", "response_id", "token"]
    expected = Counter((y, i, t.strip()) for y, i, a in rows if a is not None for t in a.split(sep))
    assert Counter(tuple(r) for r in got.collect()) == expected


def test_no_rows(spark):
    df = spark.createDataFrame([], "survey_year int, response_id long, answer string")
    assert explode_multival(df, "answer", "token").count() == 0
