"""Written intermediate tables.

A small result that the plan of a larger step depends on is written under
``spark.checkpoint.dir``, which driver and executors share: its size is then known to the
optimizer, a lost executor costs a reread, and what is dealt by sampled ranges is read back
as it was dealt.  The file system deletes the tables when the driver ends.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from cohortlens.session import checkpoint_root, remove_at_exit


def staged(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/cohortlens-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    remove_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)
