"""Python tasks over Arrow batches, with this package made importable on the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

import cohortlens

_ROOT = Path(cohortlens.__file__).resolve().parent


def ship(spark: SparkSession) -> None:
    """Send the package to the executors unless their PYTHONPATH (the driver's) has it."""
    context = spark.sparkContext
    if str(_ROOT.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(context, "_cohortlens", 0):
        return
    archive = Path(tempfile.mkdtemp(prefix="cohortlens-")) / "cohortlens_package.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in _ROOT.rglob("*.py"):
            z.write(f, f.relative_to(_ROOT.parent))
    context.addPyFile(str(archive))
    context._cohortlens = 1


def arrow_map(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str | StructType) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def arrow_groups(df: DataFrame, keys: list[str], run: Callable[[pa.Table], Iterator[pa.RecordBatch]],
                 schema: str, batch_rows: int = 1) -> DataFrame:
    """``run`` on tables of whole groups of ``keys``: each table ends with the group that brings
    it to ``batch_rows`` rows.

    Groups are dealt by key and sorted, so a task streams them; the caller bounds the size of
    a group.  Far cheaper than one Python call and Arrow stream for each group.
    """
    import pyarrow.compute as pc

    def split(batches):
        rest: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            cut = None
            for c in range(len(keys)):
                col = batch.column(c)
                new = pc.not_equal(col.slice(1), col.slice(0, batch.num_rows - 1))
                cut = new if cut is None else pc.or_(cut, new)
            edges = [0, *(i + 1 for i in pc.indices_nonzero(cut).to_pylist()), batch.num_rows]
            new = bool(rest) and any(
                rest[-1].column(c)[-1].as_py() != batch.column(c)[0].as_py() for c in range(len(keys)))
            from_, size_before = 0, size
            for i, j in zip(edges[:-1], edges[1:], strict=True):
                if (i or new) and size_before + i - from_ >= batch_rows:
                    if i > from_:
                        rest.append(batch.slice(from_, i - from_))
                    if rest:
                        yield from run(pa.Table.from_batches(rest).combine_chunks())
                    rest, from_, size_before = [], i, 0
            rest.append(batch.slice(from_))
            size = size_before + batch.num_rows - from_
        if rest:
            yield from run(pa.Table.from_batches(rest).combine_chunks())

    rest = [c for c in df.columns if c not in keys]
    return arrow_map(df.select(*keys, *rest).repartition(*keys).sortWithinPartitions(*keys), split, schema)
