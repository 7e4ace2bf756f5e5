"""Yearly wide survey CSVs: read, harmonise to the canonical schema, union, coerce.

The survey publishes one CSV per year whose columns come and go.  ``read_year`` scans
one file as text (header row, quoted newlines, doubled quotes), ``harmonise`` selects
and renames the mapped columns (NULL where the year lacks one), ``union_years`` stacks
the years by name and ``coerce_numeric`` parses the numeric answers.  Missing-value
tokens become NULL at the scan, as a default pandas read would do.

All years' files are read together, in splits, also where a quoted answer holds line breaks: the
quotes of each split are counted once a session, a running count over a file's splits says
whether a split begins inside a quoted answer, and the task that reads a split puts its lines
together to records.  Only pieces of records that cross a split's border are shuffled.  Each part
file is parsed by its own header line, so parts may order their columns differently.  Parts may be
packed (gzip): a packed part is one split.

``write_year_files`` goes the other way: it renders a canonical table in each year's
file layout (used to exercise the real-file path on data derived from the driver
tables, and to hand the panel to tools that expect the published files).
"""

from __future__ import annotations

import csv as pycsv
import hashlib
import re
import threading
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.functions.text import na_tokens_sql, to_number
from cohortlens.schema import (
    COLUMN_MAP, NUMERIC_COLUMNS, YEARS, canonical_type, responses_schema, source_columns,
)
from cohortlens.session import checkpoint_root, remove_at_exit
from cohortlens.sources.staging import staged

# The published files' name pattern, and how they spell out-of-range
# experience answers.
FILE_TEMPLATE = "survey_results_public_{year}.csv"
LESS_THAN_ONE = "Less than 1 year"
MORE_THAN_FIFTY = "More than 50 years"
EXPERIENCE_TEXT_COLUMNS = ("years_code", "years_code_pro")
#: Rows of a packed part file.
PACKED_ROWS = 50_000

_lock = threading.Lock()

CSV_PARSE_OPTIONS = {"quote": '"', "escape": '"'}
FILE_YEAR = re.compile(FILE_TEMPLATE.format(year=r"(\d{4})").replace(".csv", r"\.csv"))


def year_path(data_dir: str, year: int) -> str:
    return f"{data_dir.rstrip('/')}/{FILE_TEMPLATE.format(year=year)}"


def _first_lines(spark: SparkSession, path: str) -> dict[str, str]:
    """The first line of each data file under ``path``, by file, read through the Hadoop
    FileSystem API (no Spark job)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    root = fs.makeQualified(root)
    files = [root]
    if fs.getFileStatus(root).isDirectory():
        files = sorted((st.getPath() for st in fs.listStatus(root)
                        if st.isFile() and not st.getPath().getName().startswith(("_", "."))), key=lambda q: q.getName())
    found = {}
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration())
    for f in files:
        codec, stream = codecs.getCodec(f), fs.open(f)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
        try:
            line = reader.readLine()
        finally:
            reader.close()
        if line is not None:
            found[f.toString()] = line
    return found


def headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The column names of each non-empty data file under ``path``."""
    found = {f: next(pycsv.reader([line.lstrip("\ufeff")])) for f, line in _first_lines(spark, path).items()}
    if not found:
        raise ValueError(f"empty survey file: {path}")
    return found


def header_columns(spark: SparkSession, path: str) -> list[str]:
    """All column names of the files under ``path``, in the order they first occur."""
    return list(dict.fromkeys(c for names in headers(spark, path).values() for c in names))


def discover(spark: SparkSession, data_dir: str) -> tuple[int, ...]:
    """The years of the survey files in ``data_dir``, from their names."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(data_dir)
    listed = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(root)
    names = (FILE_YEAR.fullmatch(st.getPath().getName()) for st in listed)
    return tuple(sorted(int(m[1]) for m in names if m))


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(value, file, block): the physical lines of the files and the split each lies in."""
    return spark.read.option("lineSep", "\n").text(paths).selectExpr(
        "value", "_metadata.file_path as file", "_metadata.file_block_start as block")


class Splits:
    """Where a file set's splits begin, and which of them begin or end within a quoted answer.

    A split is summarised by its number of quotes, counted in one light scan; a running count over
    a file's splits carries the state on.  The summary has a number and a bit for each split, as
    many as Spark's own list of splits, and is kept for the session: files that have not changed
    are counted once, and every later read of them is one scan."""

    def __init__(self, spark: SparkSession, paths: list[str]):
        split = ["file", "block"]
        quotes = _lines(spark, paths).selectExpr(*split, """length(value) - length(replace(value, '"', '')) as quotes""")
        rows = quotes.groupBy(*split).agg(F.sum("quotes").alias("n")).toArrow().sort_by([("file", "ascending"), ("block", "ascending")])
        self.blocks: dict[str, np.ndarray] = {}
        self.open: dict[str, np.ndarray] = {}
        files = rows.column("file").combine_chunks().dictionary_encode() if len(rows) else pa.array([], pa.string()).dictionary_encode()
        block, n = rows.column("block").to_numpy(), rows.column("n").to_numpy()
        number = np.asarray(files.indices)
        for i, file in enumerate(files.dictionary.to_pylist()):
            own = number == i
            self.blocks[file] = block[own]
            # one more than splits: the state at the end of the file
            self.open[file] = np.r_[0, np.cumsum(n[own]) % 2].astype(np.int8)

    @property
    def crossed(self) -> bool:
        """Whether a quoted answer lies across a border."""
        return any(o[1:].any() for o in self.open.values())


_states: dict[tuple, Splits] = {}


def _splits(spark: SparkSession, paths: list[str]) -> Splits:
    """The splits of the files as they are now and as the session would deal them now."""
    jvm = spark.sparkContext._jvm
    seen = []
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        st = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p)
        seen.append((path, st.getLen(), st.getModificationTime()))
    conf = [spark.conf.get(f"spark.sql.files.{c}", None) for c in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum")]
    key = (spark.sparkContext.applicationId, spark.sparkContext.defaultParallelism, *conf, *seen)
    with _lock:
        found = _states.get(key)
    if found is None:
        found = Splits(spark, paths)
        with _lock:
            _states[key] = found
    return found


def _put_together(layouts: dict[str, int], splits: Splits, whole: bool):
    """Lines of splits to records: those that lie within one split, or (``whole`` false) the
    pieces of the others, at most two a split.  A file's first record, its header, is left out."""
    blocks_of, open_at = splits.blocks, splits.open

    def run(batches):
        import pyarrow.compute as pc

        split, inside, header, mine = None, 0, False, None
        pending: list[pa.Array] = []  # the lines of the record that has not ended
        begun = True  # whether it began in this split
        idle = False  # whether the split has no piece to give out
        out: list[tuple] = []

        def joined(arrays):
            return "\n".join(x for a in arrays for x in a.to_pylist())

        def end(last: bool):
            """The pending record ends, or its split does (``last``)."""
            nonlocal header, pending, begun
            unfinished = last and inside
            if pending:
                if whole and begun and not unfinished and not header:
                    out.append(([mine], pa.array([joined(pending)])))
                elif not whole and (unfinished or not begun):
                    out.append((*split, mine, begun, header, joined(pending)))
                header = False
            pending, begun = [], True

        def emit():
            nonlocal out
            if whole:
                for kinds, texts in out:
                    yield pa.RecordBatch.from_arrays([pa.array(kinds * len(texts), pa.int32()), texts.cast(pa.string())], ["layout", "text"])
            elif out:
                kinds = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                                 ["file", "block", "layout", "begun", "header", "text"])
            out = []

        for batch in batches:
            if not batch.num_rows:
                continue
            files, blocks = batch.column(1), batch.column(2).to_numpy()
            moved = np.flatnonzero(blocks[1:] != blocks[:-1]) + 1
            if len(blocks) > 1:
                other = pc.not_equal(files.slice(1), files.slice(0, len(files) - 1)).to_numpy(zero_copy_only=False)
                moved = np.union1d(moved, np.flatnonzero(other) + 1)
            for i, j in zip([0, *moved.tolist()], [*moved.tolist(), batch.num_rows], strict=True):
                here = (files[i].as_py(), int(blocks[i]))
                if here != split:
                    end(True)
                    known = blocks_of.get(here[0], blocks[:0])
                    at = int(np.searchsorted(known, here[1]))
                    if at == len(known) or known[at] != here[1]:
                        raise RuntimeError(f"the files, or how they are split, changed since their quotes were counted: {here}")
                    state = int(open_at[here[0]][at])
                    split, inside, header, begun, mine = here, state, here[1] == 0, not state, layouts[here[0]]
                    idle = not whole and not state and not open_at[here[0]][at + 1]
                if idle:
                    continue
                lines = batch.column(0).slice(i, j - i)
                quotes = pc.count_substring(lines, '"').to_numpy()
                before = (inside + np.cumsum(quotes) - quotes) % 2
                starts = np.flatnonzero(before == 0)
                inside = int((inside + quotes.sum()) % 2)
                if not len(starts):
                    pending.append(lines)
                    continue
                if starts[0]:
                    pending.append(lines.slice(0, starts[0]))
                end(False)
                skip = int(header and len(starts) > 1)
                if skip:
                    header = False
                if whole and len(starts) > 1 + skip:
                    first, last = int(starts[skip]), int(starts[-1])
                    if last - first == len(starts) - 1 - skip:
                        texts = lines.slice(first, last - first)
                    else:
                        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(starts[skip:].astype(np.int32)), lines), "\n")
                    out.append(([mine], texts))
                pending, begun = [lines.slice(int(starts[-1]))], True
            yield from emit()
        end(True)
        yield from emit()

    return run


def records(spark: SparkSession, layouts: dict[str, int]) -> DataFrame:
    """(layout, text): the records of CSV files without their headers; line breaks inside quotes
    stay in the text.  ``layouts`` numbers each file's layout.

    Records within a split are put together by the task that reads it: one scan of the text, and no
    line is shuffled.  Where records cross a border, a second scan gives out their pieces, at most
    two a split, and only those are shuffled."""
    paths = list(layouts)
    splits = _splits(spark, paths)
    found = _lines(spark, paths).mapInArrow(_put_together(layouts, splits, True), "layout int, text string")
    if splits.crossed:
        pieces = _lines(spark, paths).mapInArrow(
            _put_together(layouts, splits, False), "file string, block long, layout int, begun boolean, header boolean, text string")
        upto = Window.partitionBy("file").orderBy("block", "begun").rowsBetween(Window.unboundedPreceding, 0)
        crossing = pieces.withColumn("record", F.sum(F.col("begun").cast("int")).over(upto)).groupBy("file", "layout", "record").agg(
            F.max("header").alias("header"), F.array_sort(F.collect_list(F.struct("block", "begun", "text"))).alias("parts"))
        text = F.array_join(F.transform("parts", lambda x: x["text"]), "\n")
        found = found.unionByName(crossing.where("not header").select("layout", text.alias("text")))
    return found.selectExpr("layout", r"regexp_replace(text, '\\r$', '') as text").where("text <> ''")


def _scan(spark: SparkSession, data_dir: str, years) -> DataFrame:
    """Every year's file (or folder of part files) in one scan: ``survey_year`` and all source
    columns as text, missing-value tokens as NULL; a column that a part lacks is NULL there."""
    numbered: dict[tuple[int, tuple[str, ...]], int] = {}
    layouts: dict[str, int] = {}
    for year in years:
        for file, names in headers(spark, year_path(data_dir, year)).items():
            layouts[file] = numbered.setdefault((year, tuple(names)), len(numbered))
    rows = records(spark, layouts)
    options = "map(" + ", ".join(f"'{k}', '{v}'" for k, v in CSV_PARSE_OPTIONS.items()) + ")"
    parsed, homes = [], {}
    for (_, names), i in numbered.items():
        fields = ", ".join(f"`{n}` STRING" for n in names).replace("\\", "\\\\").replace("'", "\\'")
        parsed.append(f"case when layout = {i} then from_csv(text, '{fields}', {options}) end as _c{i}")
        for n in names:
            homes.setdefault(n, []).append(f"_c{i}.`{n}`")
    years_of = ", ".join(str(y) for y, _ in numbered)
    wide = rows.selectExpr(f"element_at(array({years_of}), layout + 1) as _year", *parsed)
    text = wide.selectExpr("_year", *[f"coalesce({', '.join(cs)}) as `{n}`" for n, cs in homes.items()])
    toks = na_tokens_sql()
    return text.selectExpr("cast(_year as int) as survey_year", *[
        f"CASE WHEN `{n}` IN ({toks}) THEN NULL ELSE `{n}` END AS `{n}`" for n in homes])


def read_year(spark: SparkSession, data_dir: str, year: int) -> DataFrame:
    """One year's file (or folder of part files), every column as text, missing-value tokens as
    NULL; a column that a part lacks is NULL there."""
    return _scan(spark, data_dir, (year,)).drop("survey_year")


def scan_years(spark: SparkSession, data_dir: str, years=YEARS) -> DataFrame:
    """Every year's file as scanned (text, source column names), tagged with its year and
    stacked by name; a column absent from a year's file is NULL for that year."""
    return _scan(spark, data_dir, years)


def harmonise(raw: DataFrame, year: int, column_map: dict = COLUMN_MAP) -> DataFrame:
    """``survey_year`` + every canonical column: the year's source column renamed, or a
    typed NULL when the map has no source for the year or the file lacks it.  Extra
    source columns are dropped."""
    present = set(raw.columns)
    cols: list[Column] = [F.lit(year).cast("int").alias("survey_year")]
    for canon, by_year in column_map.items():
        src = by_year.get(year)
        if src and src in present:
            cols.append(F.col(f"`{src}`").alias(canon))
        else:
            cols.append(F.lit(None).cast("string").alias(canon))
    return raw.select(*cols)


def harmonise_years(raw: DataFrame, years=YEARS, column_map: dict = COLUMN_MAP) -> DataFrame:
    """``harmonise`` of rows of several years at once: ``survey_year`` and every canonical column
    from the source column of the row's year."""
    present = set(raw.columns)
    cols = ["survey_year"]
    for canon, by_year in column_map.items():
        sources: dict[str, list[int]] = {}
        for y in years:
            if by_year.get(y) in present:
                sources.setdefault(by_year[y], []).append(y)
        each = [f"case when survey_year in ({', '.join(map(str, ys))}) then `{src}` end" for src, ys in sources.items()]
        cols.append(f"coalesce({', '.join([*each, 'cast(null as string)'])}) as `{canon}`")
    return raw.selectExpr(*cols)


def union_years(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name (no de-duplication)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def coerce_numeric(df: DataFrame, columns=NUMERIC_COLUMNS) -> DataFrame:
    """Numeric answers to double (unparsable text -> NULL); key to bigint; text kept."""
    out = []
    for f in responses_schema().fields:
        if f.name not in df.columns:
            continue
        c = F.col(f.name)
        if f.name in columns:
            c = to_number(c)
        elif f.name == "response_id":
            c = to_number(c).cast("long")
        elif f.name != "survey_year":
            c = c.cast(canonical_type(f.name))
        out.append(c.alias(f.name))
    return df.select(*out)


def ingest(spark: SparkSession, data_dir: str, years=YEARS) -> DataFrame:
    """The canonical ``responses`` table from the yearly files (lazy)."""
    return coerce_numeric(harmonise_years(scan_years(spark, data_dir, years), years))


def _survey_text(canon: str, c: Column) -> Column:
    if canon in EXPERIENCE_TEXT_COLUMNS:
        return F.when(c == 0, F.lit(LESS_THAN_ONE)).when(c > 50, F.lit(MORE_THAN_FIFTY)).otherwise(
            c.cast("string"))
    if canon in NUMERIC_COLUMNS or canon == "response_id":
        return c.cast("string")
    return c


def year_file_frame(responses: DataFrame, year: int) -> DataFrame:
    """``year``'s rows in that year's file layout: source column names, survey text for
    experience answers, plus a free-text column the map does not know."""
    rows = responses.where(F.col("survey_year") == year)
    cols = [_survey_text(canon, F.col(canon)).alias(src) for canon, src in source_columns(year)]
    note = F.concat(F.lit('Answered "all" questions\nsecond line, id '), F.col("response_id").cast("string"))
    return rows.select(*cols, note.alias("SurveyNotes"))


def write_year_files(responses: DataFrame, out_dir: str, years=YEARS, packed: bool = False) -> None:
    """One CSV folder per year (header, NULL as ``NA``, quotes doubled).  ``packed``: parts are
    packed with gzip; one task reads such a part, so it holds at most ``PACKED_ROWS`` rows."""
    options = {"compression": "gzip", "maxRecordsPerFile": PACKED_ROWS} if packed else {}
    for y in years:
        (year_file_frame(responses, y).write.mode("overwrite").options(**options)
         .option("header", "true").option("nullValue", "NA").option("quote", '"').option("escape", '"')
         .csv(year_path(out_dir, y)))


_files: dict[tuple[str, str], str] = {}


def survey_files(spark: SparkSession, sf_dir: str) -> str:
    """Folder holding the yearly files rendered from the driver-table panel (once per app)."""
    from cohortlens.sources.store import store

    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _lock:
        path = _files.get(key)
        if path is None:
            digest = hashlib.sha1(key[1].encode()).hexdigest()[:12]
            path = f"{checkpoint_root(spark).rstrip('/')}/cohortlens-files/{key[0]}/{digest}"
            write_year_files(store(spark, sf_dir).responses(), path, packed=True)
            remove_at_exit(spark, path)
            _files[key] = path
    return path


def schema_profile(spark: SparkSession, data_dir: str, years=None, sample_rows: int = 5,
                   samples: int = 2) -> DataFrame:
    """One row per (year, source column): the file's column count, non-NULL cells over
    all rows, and up to ``samples`` non-NULL values among the ``sample_rows`` rows with
    the smallest response id ('ALL NULL' when none).  ``years``: those of the files found.

    One pass over the parsed rows: each task counts the cells and keeps its ``sample_rows`` first
    rows of each year (ties by the cells), and the tasks' few rows are merged in two steps."""
    years = years or discover(spark, data_dir)
    layouts = {y: header_columns(spark, year_path(data_dir, y)) for y in years}
    raw = scan_years(spark, data_dir, years)
    cols = [c for c in raw.columns if c != "survey_year"]
    row = "struct<late:boolean,rid:double,cells:array<string>>"
    tasks = staged(raw.select("survey_year", to_number(F.col("ResponseId")).alias("_rid"), *[f"`{c}`" for c in cols]).mapInArrow(
        _profiled(sample_rows), f"survey_year int, counts array<long>, firsts array<{row}>"), "profile")
    merged = F.slice(F.array_sort(F.flatten(F.collect_list("firsts"))), 1, sample_rows)
    firsts = tasks.groupBy("survey_year", F.pmod(F.xxhash64("firsts"), F.lit(MERGE_GROUPS))).agg(
        merged.alias("firsts")).groupBy("survey_year").agg(merged.alias("firsts"))
    counts = tasks.select("survey_year", F.posexplode("counts").alias("at", "n")).groupBy("survey_year", "at").agg(
        F.sum("n").alias("non_null"))
    # keep each year's own columns (the scan fills the others with NULL); the layout
    # table has one row per header column, a bound known from the headers themselves
    present = spark.createDataFrame(
        [(y, c, len(cs), cols.index(c)) for y, cs in layouts.items() for c in cs],
        "survey_year int, column_name string, n_columns int, at int")
    found = counts.join(F.broadcast(present), ["survey_year", "at"]).join(firsts, "survey_year")
    vals = F.filter(F.transform("firsts", lambda r: F.get(r["cells"], F.col("at"))), lambda v: v.isNotNull())
    return found.select(
        "survey_year", "n_columns", "column_name", "non_null",
        F.when(F.size(vals) == 0, F.lit("ALL NULL")).otherwise(
            F.array_join(F.slice(vals, 1, samples), " | ")).alias("sample_values"),
    )


#: Groups that the tasks' first rows are merged in before the last merge.
MERGE_GROUPS = 64


def _profiled(sample_rows: int):
    """Per task and year: non-NULL cells by column, and the first rows by response id."""
    def run(batches):
        import pyarrow.compute as pc

        counts: dict[int, np.ndarray] = {}
        firsts: dict[int, pa.Table] = {}
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for year in pc.unique(batch.column(0)).to_pylist():
                own = table.filter(pc.equal(table.column(0), year))
                n = np.array([len(own) - c.null_count for c in own.columns[2:]])
                counts[year] = counts.get(year, 0) + n
                both = pa.concat_tables([firsts[year], own]) if year in firsts else own
                order = [(str(i), "ascending") for i in range(1, both.num_columns)]
                numbered = both.rename_columns([str(i) for i in range(both.num_columns)])
                firsts[year] = both.take(pc.select_k_unstable(numbered, min(sample_rows, len(both)), order))
        for year, kept in firsts.items():
            rows = [{"late": r[1] is None, "rid": r[1], "cells": list(r[2:])} for r in
                    zip(*[c.to_pylist() for c in kept.columns], strict=True)]
            kind = pa.list_(pa.struct([("late", pa.bool_()), ("rid", pa.float64()), ("cells", pa.list_(pa.string()))]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([year], pa.int32()), pa.array([counts[year].tolist()], pa.list_(pa.int64())), pa.array([rows], kind)],
                ["survey_year", "counts", "firsts"])

    return run
