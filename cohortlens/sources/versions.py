"""Versions of a group of tables, published together.

A group lives under one folder: ``<root>/<table>/version=<version>/`` holds a table's files and
``<root>/_published/<version>`` says that a version of every table is complete.  The newest
published version is in force.  Publishing creates one empty file, which file systems and object
stores do as a whole, so no rename is needed and no reader sees half of it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession


def folder(root: str, table: str, version: str) -> str:
    return f"{root}/{table}/version={version}"


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    p, fs = _path(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def published(spark: SparkSession, root: str) -> list[str]:
    """Complete versions, oldest first."""
    return [n for n in _names(spark, f"{root}/_published") if not n.startswith((".", "_"))]


def current(spark: SparkSession, root: str) -> str:
    """The version in force."""
    found = published(spark, root)
    if not found:
        raise FileNotFoundError(f"no published tables under {root}")
    return found[-1]


def new(spark: SparkSession, root: str) -> str:
    """A name for the next version; writers at the same time get different ones."""
    found = published(spark, root)
    number = int(found[-1].split("-")[0]) + 1 if found else 1
    return f"{number:08d}-{uuid.uuid4().hex[:8]}"


def note(spark: SparkSession, path: str, text: str) -> None:
    """Leave a short note beside the files of a folder; readers of the files do not see it."""
    p, fs = _path(spark, f"{path}/_note_{text}")
    fs.create(p, True).close()


def notes(spark: SparkSession, path: str) -> list[str]:
    return [n.removeprefix("_note_") for n in _names(spark, path) if n.startswith("_note_")]


def publish(spark: SparkSession, root: str, version: str, tables: Sequence[str], keep: int = 2) -> None:
    """Put a version in force, then delete the files of versions older than the ``keep`` last."""
    p, fs = _path(spark, f"{root}/_published/{version}")
    fs.create(p, False).close()
    done = published(spark, root)
    if len(done) <= keep:
        return
    oldest = done[-keep]
    for n in done[:-keep]:  # first the notice, so that no reader starts on a version being deleted
        p, fs = _path(spark, f"{root}/_published/{n}")
        fs.delete(p, False)
    for table in tables:
        for name in _names(spark, f"{root}/{table}"):
            # versions that a failed refresh left behind go with the old ones
            if name.startswith("version=") and name.removeprefix("version=") < oldest:
                p, fs = _path(spark, f"{root}/{table}/{name}")
                fs.delete(p, True)
