"""Text-to-value guards used at the CSV edge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The tokens a default pandas CSV read turns into a missing value.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# A plain decimal / scientific number, optionally signed and space-padded, or infinity.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_SPECIAL = r"^\s*[+-]?(?i)(inf|infinity)\s*$"


def na_to_null(col: str | Column, tokens=NA_TOKENS) -> Column:
    """NULL when the whole cell is a missing-value token, else the cell unchanged."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isin(*tokens), F.lit(None).cast("string")).otherwise(c)


def na_tokens_sql(tokens=NA_TOKENS) -> str:
    return ", ".join("'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'" for t in tokens)


def na_to_null_all(df: DataFrame, tokens=NA_TOKENS) -> DataFrame:
    """``na_to_null`` on every column, built as one SQL projection (a single call to the
    JVM however wide the file is)."""
    toks = na_tokens_sql(tokens)
    return df.selectExpr(*[
        f"CASE WHEN `{c}` IN ({toks}) THEN NULL ELSE `{c}` END AS `{c}`" for c in df.columns])


def to_number(col: str | Column) -> Column:
    """Parse text to double; anything that is not a whole number literal, NaN too, becomes NULL.

    Spark's own cast also accepts suffixes such as ``5d`` / ``5f``; the guard rejects
    those so only numbers parse."""
    c = F.col(col) if isinstance(col, str) else col
    s = c.cast("string")
    ok = s.rlike(_NUMBER) | s.rlike(_SPECIAL)
    return F.when(ok, F.trim(s).try_cast("double"))
