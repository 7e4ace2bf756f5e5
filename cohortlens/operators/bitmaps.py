"""Distinct counts kept as bitmaps, so that they can be stored, merged and counted again.

An id is one bit of a bitmap; a group's ids fall into as many bitmaps of 32,768 bits as their
range needs.  Bitmaps of the same group and range are merged by OR, so counts over more rows, or
over several groups together, need the bitmaps only and not the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_bitmaps(df: DataFrame, group: Sequence[str], entity: str, bucket: str = "bucket", bits: str = "bits",
                     given: bool = False) -> DataFrame:
    """(group, bucket, bits): the whole-number ids of each group.  NULL ids set no bit, but their
    group has a row.  Spark builds the bitmaps before it shuffles; ``given``: the rows have their
    bucket as a column, and if they are dealt by it, nothing is shuffled."""
    return df.groupBy(*group, F.col(bucket) if given else F.bitmap_bucket_number(entity).alias(bucket)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(entity)).alias(bits))


def distinct_counts(bitmaps: DataFrame, group: Sequence[str], name: str, bucket: str = "bucket", bits: str = "bits",
                    when: Column | None = None) -> DataFrame:
    """(group, name): how many ids the bitmaps of each group hold together; ``group`` may be any
    of the columns that the bitmaps were built by."""
    kept = bitmaps if when is None else bitmaps.where(when)
    merged = kept.groupBy(*group, bucket).agg(F.bitmap_count(F.bitmap_or_agg(bits)).alias("_n"))
    return merged.groupBy(*group).agg(F.sum("_n").alias(name))
