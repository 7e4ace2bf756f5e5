"""Intermediate tables in the shared folder.

Intermediates are Parquet tables under ``spark.checkpoint.dir`` (shared by driver and
executors), so a lost executor costs a reread, not a recomputation.  The file system deletes
them when the driver ends.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from cohortlens.session import checkpoint_root, remove_at_exit


def staged(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/llm-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    remove_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(table: DataFrame) -> None:
    """Delete the files of a table that ``staged`` gave and nothing reads any more."""
    spark = table.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
