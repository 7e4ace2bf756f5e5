"""The table store: the ingest step's outputs written once as parquet, then read by
every audit and trend job.

Tables (all partitioned by ``survey_year``, so year predicates prune directories):
  responses       27 canonical columns, one row per respondent-year   } projections of
  responses_clean the cleaning view materialised (so predicates on     } one written
                  derived columns such as ``employment_clean`` reach   } ``panel`` table
                  the parquet reader)
  lang_exploded   (survey_year, response_id, language)
  db_exploded     (survey_year, response_id, database)
  lang_usage      (survey_year, language, kind, bucket, bits): respondents as bitmaps

Tables go under the session's checkpoint folder (``spark.checkpoint.dir``), which on a
cluster is shared storage; a refresh writes a new version of all tables and publishes it at
once, so a retried job is idempotent, and reading them back cuts the lineage to the source
tables.  All are packed with zstd.
"""

from __future__ import annotations

import hashlib
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cohortlens.operators.cleaning import CLEAN_COLUMNS, with_derived
from cohortlens.operators.explode import explode_multival
from cohortlens.plans.trends import language_usage
from cohortlens.schema import RESPONSE_COLUMNS, responses_schema
from cohortlens.session import checkpoint_root, remove_at_exit
from cohortlens.sources import versions
from cohortlens.sources.panel import survey_panel

_lock = threading.Lock()
_built: dict[tuple[str, str], str] = {}
_frames: dict[tuple[str, str], DataFrame] = {}
_derived: set[tuple[str, str]] = set()

EXPLODED_COLUMNS = {
    "lang_exploded": ("survey_year", "response_id", "language"),
    "db_exploded": ("survey_year", "response_id", "database"),
}
#: The tables that are derived from the written panel.
LONG_TABLES = (*EXPLODED_COLUMNS, "lang_usage")
PACKED = "zstd"


def _schema(spark: SparkSession, folder: str) -> T.StructType:
    """The columns of a written table; stated, so that a table without rows has them too."""
    if folder == "panel":
        return with_derived(spark.createDataFrame([], responses_schema())).schema
    if folder == "lang_usage":
        return T.StructType.fromDDL("survey_year int, language string, kind string, bucket bigint, bits binary")
    return T.StructType.fromDDL(f"survey_year int, response_id bigint, {EXPLODED_COLUMNS[folder][-1]} string")


def table_columns(name: str) -> tuple[str, ...]:
    if name == "responses":
        return RESPONSE_COLUMNS
    if name == "responses_clean":
        return CLEAN_COLUMNS
    if name == "lang_usage":
        return ("survey_year", "language", "kind", "bucket", "bits")
    return EXPLODED_COLUMNS[name]


def write_tables(responses: DataFrame, out_dir: str, dealt: bool = False) -> dict[str, tuple[str, ...]]:
    """Full-refresh write of the ingest outputs derived from a ``responses`` frame.

    ``panel`` holds every raw column plus the nine derived ones, written once, bucketed and
    sorted by respondent, so that readers join and group by respondent without a shuffle (as many
    buckets as the session has shuffle partitions); ``responses`` and ``responses_clean`` are column projections of it
    (parquet reads only the projected columns), so the raw rows are not stored twice.  The long
    tables are derived from the written copy, so the source plan runs once, and ``lang_usage``
    keeps the distinct respondents of each language for the adoption jobs.  ``dealt``: the rows
    come from a join by respondent, so they lie in the session's shuffle partitions already.

    All tables are written under a new version and published together by one new file, whose
    creation the file system does at once: a reader sees the old tables or the new ones, never a
    mix, and a refresh that fails leaves the old ones in force.  The version before stays for
    readers still at work; older ones are deleted.  Returns each table's column order."""
    spark = responses.sparkSession
    root = out_dir.rstrip("/")
    version = versions.new(spark, root)
    _save_buckets(responses, versions.folder(root, "panel", version), dealt)
    for name in LONG_TABLES:
        _save_long(spark, root, name, version)
    versions.publish(spark, root, version, ("panel", *LONG_TABLES))
    return {n: table_columns(n) for n in ("responses", "responses_clean", *EXPLODED_COLUMNS)}


def _save_long(spark: SparkSession, root: str, name: str, version: str) -> None:
    """One of the ``LONG_TABLES``, derived from the version's written panel."""
    stored = _read(spark, root, "panel", version)
    if name == "lang_usage":
        long = language_usage(stored)
    else:  # as scanned: at most a file for each scan task and year
        long = explode_multival(stored, {"lang_exploded": "lang_worked", "db_exploded": "db_worked"}[name], EXPLODED_COLUMNS[name][-1])
    # over what an attempt that failed may have left
    long.write.mode("overwrite").option("compression", PACKED).partitionBy("survey_year").parquet(versions.folder(root, name, version))


def _save_buckets(responses: DataFrame, folder: str, dealt: bool) -> None:
    """The panel (``responses`` with its derived columns, made where they are written) as Parquet, by year and respondent bucket.  Only catalog tables have buckets, so
    the folder is written through a catalog name that is dropped again; the files stay, with a
    note of the number of buckets."""
    spark = responses.sparkSession
    name, buckets = f"cohortlens_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    if not dealt or first not in (None, str(buckets)):
        # rebalanced by respondent: a task's rows are one bucket, or a share of a large one
        responses = responses.hint("rebalance", buckets, "response_id")
    (with_derived(responses).write.format("parquet").partitionBy("survey_year").bucketBy(buckets, "response_id").sortBy("response_id")
     .option("compression", PACKED).option("path", folder).saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")
    versions.note(spark, folder, f"buckets_{buckets}")


def _read(spark: SparkSession, root: str, folder: str, version: str) -> DataFrame:
    return spark.read.schema(_schema(spark, folder)).parquet(versions.folder(root, folder, version))


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One of the tables from a folder written by ``write_tables``, in the version now
    published."""
    folder = "panel" if name in ("responses", "responses_clean") else name
    root = root.rstrip("/")
    version = versions.current(spark, root)
    key = (spark.sparkContext.applicationId, versions.folder(root, folder, version))
    with _lock:
        if key not in _frames:  # a version's files never change: list them once
            _frames[key] = _read(spark, root, folder, version)
    return _frames[key].select(*table_columns(name))


def read_buckets(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``responses`` or ``responses_clean`` as ``read_table`` gives it, with its buckets known to
    the optimizer.  Buckets need a catalog name, one for each version of the panel; a catalog that
    outlives the session keeps it until it is dropped."""
    root, columns = root.rstrip("/"), table_columns(name)
    folder = versions.folder(root, "panel", versions.current(spark, root))
    (buckets,) = (n.split("_")[1] for n in versions.notes(spark, folder) if n.startswith("buckets_"))
    name = "cohortlens_" + hashlib.sha1(folder.encode()).hexdigest()[:16]
    if not spark.catalog.tableExists(name):
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _schema(spark, "panel"))
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING parquet PARTITIONED BY (survey_year) "
                  f"CLUSTERED BY (response_id) SORTED BY (response_id) INTO {buckets} BUCKETS LOCATION '{folder}'")
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name).select(*columns)


class PanelStore:
    """Handle on the written tables for one driver-table folder: the panel, built once per app, and
    the long tables, each derived from it when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        key = (spark.sparkContext.applicationId, self.sf_dir)
        with _lock:
            root = _built.get(key)
            if root is None:
                digest = hashlib.sha1(self.sf_dir.encode()).hexdigest()[:12]
                root = f"{checkpoint_root(spark).rstrip('/')}/cohortlens-tables/{spark.sparkContext.applicationId}/{digest}"
                version = versions.new(spark, root)
                _save_buckets(survey_panel(spark, self.sf_dir), versions.folder(root, "panel", version), dealt=True)
                versions.publish(spark, root, version, ("panel", *LONG_TABLES))
                remove_at_exit(spark, root)
                _built[key] = root
        self.root = root

    def _derive(self, *names: str) -> None:
        with _lock:
            for name in names:
                if (self.root, name) not in _derived:
                    _save_long(self.spark, self.root, name, versions.current(self.spark, self.root))
                    _derived.add((self.root, name))

    def table(self, name: str) -> DataFrame:
        if name in LONG_TABLES:
            self._derive(name)
        return read_table(self.spark, self.root, name)

    def responses(self) -> DataFrame:
        return self.table("responses")

    def clean(self) -> DataFrame:
        return self.table("responses_clean")

    def bucketed(self, name: str) -> DataFrame:
        return read_buckets(self.spark, self.root, name)

    def lang_exploded(self) -> DataFrame:
        return self.table("lang_exploded")

    def db_exploded(self) -> DataFrame:
        return self.table("db_exploded")

    def lang_usage(self) -> DataFrame:
        return self.table("lang_usage")

    def register_views(self) -> list[str]:
        self._derive(*EXPLODED_COLUMNS)
        return register_views(self.spark, self.root)


def register_views(spark: SparkSession, root: str) -> list[str]:
    """Register the four tables of a folder written by ``write_tables`` as temp views under their
    own names, so SQL text (``spark.sql``) can read them like database tables."""
    names = ["responses", "responses_clean", *EXPLODED_COLUMNS]
    for name in names:
        read_table(spark, root, name).createOrReplaceTempView(name)
    return names


def store(spark: SparkSession, sf_dir: str) -> PanelStore:
    return PanelStore(spark, sf_dir)
