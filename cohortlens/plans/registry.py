"""Named jobs: ``QUERIES[name](spark, sf_dir) -> DataFrame`` and their DuckDB oracles.

Every job reads the table store built from the driver tables in ``sf_dir`` (the
ingest step runs once per application and folder).  Thresholds are passed where the
sf0.01 panel is too small for the published defaults (FIXTURES.md, F4); the functions
keep the published values as their defaults.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortlens.sources.store import store

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def _load():
    """Import the job modules (each registers its entries)."""
    from cohortlens.plans import jobs  # noqa: F401


__all__ = ["QUERIES", "ORACLES", "register", "store"]
