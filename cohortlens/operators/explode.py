"""Multi-value answer columns -> long tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.rules import strip_unicode


def explode_multival(df: DataFrame, src_col: str, out_col: str, sep: str = ";") -> DataFrame:
    """(survey_year, response_id, out_col): one row per token between ``sep`` (plain text).

    Rows whose source is NULL are dropped; tokens are stripped of surrounding whitespace;
    empty tokens and repeats are kept (callers filter blanks where a query needs it).
    The frame is pruned to the three columns before the Generate, so the fan-out carries
    no unused columns.
    """
    return (
        df.select("survey_year", "response_id", src_col)
        .where(F.col(src_col).isNotNull())
        .select("survey_year", "response_id", F.explode(F.split(F.col(src_col), re.escape(sep), -1)).alias("_tok"))
        .select("survey_year", "response_id", strip_unicode("_tok").alias(out_col))
    )
