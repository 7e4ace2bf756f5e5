"""Property test: the cleaning rules against a plain-Python statement of the same
first-match semantics, on generated labels mixing the patterns' fragments."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from cohortlens.operators.cleaning import education_clean, employment_clean, remote_clean

FRAGMENTS = ["remote", "Remote", "HYBRID", "hybrid", "person", "In-Person", "your choice", "Flexible",
             "student", "Full-time", "full time", "part-time", "Part Time", "self-employed", "freelance",
             "contractor", "Independent", "not employed", "Retired", "Employed", "primary", "Secondary",
             "associate", "Bachelor", "master", "doctoral", "PhD", "Doctor", "professional",
             "some college", "without earning", "Something else", "no", " ", ", ", "x"]

labels = st.one_of(st.none(), st.lists(st.sampled_from(FRAGMENTS), min_size=1, max_size=4).map("".join))


def _has(s, *subs):
    low = s.lower()
    return any(x.lower() in low for x in subs)


def py_remote(s):
    if s is None:
        return None
    if _has(s, "remote") and not _has(s, "hybrid"):
        return "Remote"
    if _has(s, "hybrid", "your choice", "flexible"):
        return "Hybrid"
    if _has(s, "person") and not _has(s, "hybrid"):
        return "In-person"
    return None


def py_employment(s):
    if s is None:
        return "Other"
    if _has(s, "student"):
        return "Student"
    if _has(s, "full-time", "full time") or s == "Employed":
        return "Employed FT"
    if _has(s, "part-time", "part time"):
        return "Employed PT"
    if _has(s, "self-employed", "freelance", "contractor", "independent"):
        return "Self-employed"
    if _has(s, "not employed", "retired"):
        return "Not employed"
    return "Other"


def py_education(s):
    if s is None:
        return None
    if _has(s, "primary", "secondary") or s.lower() == "something else":
        return "No formal degree"
    for subs, label in ((("associate",), "Associate degree"), (("bachelor",), "Bachelor's degree"),
                        (("master",), "Master's degree"), (("doctoral", "phd", "doctor"), "PhD or higher"),
                        (("professional",), "Professional degree"),
                        (("some college", "without earning"), "Some college")):
        if _has(s, *subs):
            return label
    return None


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(labels, min_size=1, max_size=40))
def test_rules_match_python_semantics(spark, values):
    schema = T.StructType([T.StructField("s", T.StringType())])
    df = spark.createDataFrame([(v,) for v in values], schema)
    rows = df.select("s", remote_clean("s").alias("r"), employment_clean("s").alias("e"),
                     education_clean("s").alias("d")).collect()
    for row in rows:
        assert row.r == py_remote(row.s), row.s
        assert row.e == py_employment(row.s), row.s
        assert row.d == py_education(row.s), row.s
