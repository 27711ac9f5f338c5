"""Stacking crawled CSV folders by column name, and CSV / typed-table sinks.

The notebook reads every ``**/*.csv`` file as text, concatenates them by
column *name* (missing columns become NaN), drops duplicate rows, cuts an id
out of a URL column and writes one CSV.  On Spark:

1. ``csv_headers`` -- one pass over the files as text keeps the first line of
   each file (``_metadata`` gives the file and the split start; a partial
   ``min_by`` per file means one record per file crosses the shuffle).  Only
   files whose first line leaves a quote open are read again, whole, for the
   lines that follow.  With ``header=`` given there is no such pass: every
   file must then have exactly that header, which the scan checks;
2. files are grouped by header; each group is one CSV scan with
   ``header=True`` (inside a group, position and name agree), and the groups
   are stacked with ``unionByName(allowMissingColumns=True)``.  A single scan
   over files with different headers would map columns by position -- wrong;
3. a row with fewer fields than its header is filled up with NULL, as pandas
   does; one with more is an error that names the file.  The scan has one
   column more than the header to see them;
4. pandas' missing-value tokens become NULL with one ``CASE`` per column;
5. ``dropDuplicates()`` over all columns: partial aggregation on the map side
   collapses copies before the shuffle, so a row copied into a third of all
   files still sends at most one record per task;
6. ``extract_url_id`` derives the id column; the sink writes a folder of
   CSV parts with pandas-compatible quoting (no single-file coalesce).

Only a per-header summary reaches the driver when all files share one header;
with mixed headers the (file, header) pairs do -- the driver's file index
holds every path anyway.
"""

from __future__ import annotations

import csv
import io
import re
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import PANDAS_NA_TOKENS
from ..functions.exprs import extract_url_id
from ..names import fresh

# Reader options giving pandas.read_csv(dtype="object") parsing: header row,
# doubled quotes, newlines inside quotes, spaces kept, nothing inferred.
READ_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "inferSchema": "false",
    "mode": "FAILFAST",
    "encoding": "UTF-8",
}

# Writer options giving pandas.to_csv(index=False) bytes: NULL and '' both as
# an empty field, doubled quotes, spaces kept.
WRITE_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "encoding": "UTF-8",
}


class NoCsvFilesError(ValueError):
    pass


def _file_options(recursive: bool, glob: str) -> dict[str, str]:
    return {"recursiveFileLookup": str(recursive).lower(), "pathGlobFilter": glob}


def csv_headers(spark: SparkSession, paths: str | Sequence[str], glob: str = "*.csv",
                recursive: bool = True) -> DataFrame:
    """``(file_path, header)``: the first line of every matching file."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    text = spark.read.options(**_file_options(recursive, glob)).text(paths).where("value <> ''")
    first_split = text.where(F.col("_metadata.file_block_start") == 0).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("value"),
        F.monotonically_increasing_id().alias("pos"),
    )
    return first_split.groupBy("file_path").agg(F.min_by("value", "pos").alias("header"))


# A record up to its end: quoted parts may hold line breaks.
FIRST_RECORD = r"""^\s*?((?:[^"\r\n]|"(?:[^"]|"")*")+)"""


def _plain_path(url: str) -> str:
    """A file's path for a reader, from its URL: no percent codes, and its own wildcard characters escaped."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", unquote(url))


def _whole_headers(spark: SparkSession, heads: DataFrame) -> DataFrame:
    """``heads`` with the whole first record of the files whose first line ends inside quotes."""
    quotes = F.octet_length("header") - F.octet_length(F.replace("header", F.lit('"'), F.lit("")))
    cut = heads.where(quotes % 2 == 1).select("file_path").collect()  # headers with line breaks are rare
    if not cut:
        return heads
    texts = spark.read.text([_plain_path(r["file_path"]) for r in cut], wholetext=True)
    record = F.regexp_extract(F.ltrim(F.col("value")), FIRST_RECORD, 1)
    whole = texts.select(F.col("_metadata.file_path").alias("file_path"), record.alias("whole"))
    return heads.join(whole, "file_path", "left").select("file_path", F.coalesce("whole", "header").alias("header"))


def parse_header(line: str) -> list[str]:
    """Column names of one header line (quoted names allowed).

    As pandas does, a column without a name is ``Unnamed: <position>`` and a
    repeated name gets ``.1``, ``.2``, ...
    """
    line = line.lstrip("\ufeff")
    names: list[str] = []
    for i, name in enumerate(next(csv.reader(io.StringIO(line)))):
        first = name = name or f"Unnamed: {i}"
        n = 0
        while name in names:
            n += 1
            name = f"{first}.{n}"
        names.append(name)
    return names


def header_groups(spark: SparkSession, paths, glob: str = "*.csv",
                  recursive: bool = True) -> list[tuple[list[str], list[str] | None]]:
    """``[(column names, file paths)]``, one entry per distinct header, in path order.

    Only a per-header summary is collected first.  With a single header --
    the usual crawl -- the file list is ``None`` and the group is read from the
    root folders, so no per-file list is built at all.  With mixed headers the
    ``(file, header)`` pairs are collected in one job from the persisted
    one-row-per-file table (no per-group ``collect_list`` in one task).
    """
    lines = csv_headers(spark, paths, glob, recursive).persist()
    heads = _whole_headers(spark, lines).persist()
    try:
        summary = heads.groupBy("header").agg(F.min("file_path").alias("first")).collect()
        if len(summary) <= 1:
            return [(parse_header(r["header"]), None) for r in summary]
        by_header: dict[str, list[str]] = {}
        for r in heads.collect():   # (file, header) pairs; the file index holds the paths anyway
            by_header.setdefault(r["header"], []).append(_plain_path(r["file_path"]))
    finally:
        heads.unpersist()
        lines.unpersist()
    groups = [(parse_header(h), sorted(files)) for h, files in by_header.items()]
    groups.sort(key=lambda g: g[1][0])
    return groups


def null_tokens(df: DataFrame, tokens: Sequence[str] = PANDAS_NA_TOKENS) -> DataFrame:
    """Every string column: value in ``tokens`` -> NULL (pandas' na_values)."""
    tokens = list(tokens)
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            c = F.when(~c.isin(tokens), c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _padded(reader, names: Sequence[str], load) -> DataFrame:
    """Rows of text by position: short ones are filled up with NULL, a long one is an error."""
    extra = fresh(names, "_extra")
    fields = [T.StructField(n, T.StringType(), True) for n in (*names, extra)]
    rows = load(reader.option("mode", "PERMISSIVE").schema(T.StructType(fields)))
    error = F.concat(F.lit("a row has more fields than its header: "), F.col("_metadata.file_path"))
    return rows.where(F.when(F.col(extra).isNotNull(), F.raise_error(error)).isNull()).drop(extra)


def read_csv_stack(spark: SparkSession, paths, glob: str = "*.csv", recursive: bool = True,
                   na_tokens: Sequence[str] | None = PANDAS_NA_TOKENS,
                   header: Sequence[str] | None = None) -> DataFrame:
    """All matching files stacked by column name, as text (no dedup).

    ``header`` says that every file has just these columns in this order: the files are then read once,
    and one with another header fails the read.
    """
    roots = [paths] if isinstance(paths, str) else list(paths)
    options = _file_options(recursive, glob)
    if header is not None:
        fields = [T.StructField(n, T.StringType(), True) for n in header]
        reader = spark.read.options(**READ_OPTIONS, **options).option("enforceSchema", "false").schema(T.StructType(fields))
        stacked = reader.csv(roots)
        return stacked if na_tokens is None else null_tokens(stacked, na_tokens)
    groups = header_groups(spark, paths, glob, recursive)
    if not groups:
        raise NoCsvFilesError(f"no files matching {glob!r} under {paths!r}")
    stacked = None
    for names, files in groups:
        reader = spark.read.options(**READ_OPTIONS)
        if files is None:   # one header everywhere: read the roots as listed
            part = _padded(reader.options(**options), names, lambda r: r.csv(roots))
        else:
            part = _padded(reader, names, lambda r, files=files: r.csv(files))
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
    if na_tokens is not None:
        stacked = null_tokens(stacked, na_tokens)
    return stacked


def stack_csv(spark: SparkSession, paths, url_col: str | None = None, id_col: str | None = None,
              glob: str = "*.csv", recursive: bool = True,
              na_tokens: Sequence[str] | None = PANDAS_NA_TOKENS, dedup: bool = True,
              header: Sequence[str] | None = None) -> DataFrame:
    """Read, stack by name, drop duplicate rows and derive ``id_col`` from ``url_col``."""
    df = read_csv_stack(spark, paths, glob, recursive, na_tokens, header)
    if dedup:
        df = df.dropDuplicates()
    if url_col is not None and id_col is not None:
        df = df.withColumn(id_col, extract_url_id(url_col))
    return df


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A folder of CSV parts whose bytes follow pandas ``to_csv(index=False)``."""
    df.write.mode(mode).options(**WRITE_OPTIONS).csv(path)


def read_typed(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """Load a stacked CSV folder into ``schema`` (no inference), columns matched by name.

    The parts of a stacked folder share one header, which is taken from one of them and checked on all:
    there is no pass over the files before the scan.  Bad values fail the read.  ``multi_line=False`` is
    for data without line breaks inside quotes, whose files Spark can then split.  The result has the
    schema's column order.
    """
    types = {f.name: f.dataType for f in schema.fields}
    options = READ_OPTIONS | {"multiLine": str(multi_line).lower(), "enforceSchema": "false", "pathGlobFilter": "*.csv"}
    names = spark.read.options(**options).csv(path).columns
    fields = [T.StructField(n, types.get(n, T.StringType()), True) for n in names]
    df = spark.read.options(**options).schema(T.StructType(fields)).csv(path)
    return df.select(*[F.col(f"`{f.name}`") if f.name in names
                       else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def _hadoop_path(spark: SparkSession, path: str):
    """``(path, its file system)``."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _swap(spark: SparkSession, staged: str, path: str) -> None:
    """The folder ``staged`` takes the place of ``path``, whose old content goes only after that."""
    new, files = _hadoop_path(spark, staged)
    old, _ = _hadoop_path(spark, path)
    aside = old.suffix(f"-replaced-{uuid.uuid4().hex[:12]}")
    had = files.exists(old)
    if had and not files.rename(old, aside):
        raise OSError(f"cannot move {path} aside")
    if not files.rename(new, old):
        if had:
            files.rename(aside, old)
        raise OSError(f"cannot move {staged} to {path}")
    if had:
        files.delete(aside, True)


def write_table(df: DataFrame, path: str | None = None, table: str | None = None,
                mode: str = "overwrite") -> None:
    """CREATE OR REPLACE: Parquet at ``path`` or a managed table ``table``.

    A replacement is written beside the old table and takes its place when it is complete: a write that
    fails leaves the old one as it was, and a job may read the table that it replaces.  The swap is two
    renames, which readers of a path can fall between.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex[:12]
    if table is not None and mode == "overwrite" and spark.catalog.tableExists(table):
        staged = f"{table}_staged_{mark}"
        try:
            df.write.format("parquet").saveAsTable(staged)
        except Exception:
            spark.sql(f"drop table if exists {staged}")
            raise
        spark.sql(f"drop table {table}")
        spark.sql(f"alter table {staged} rename to {table}")
    elif table is not None:
        df.write.mode(mode).format("parquet").saveAsTable(table)
    elif path is not None and mode == "overwrite":
        staged = f"{path.rstrip('/')}-staged-{mark}"
        try:
            df.write.parquet(staged)
        except Exception:
            at, files = _hadoop_path(spark, staged)
            files.delete(at, True)
            raise
        _swap(spark, staged, path)
    elif path is not None:
        df.write.mode(mode).parquet(path)
    else:
        raise ValueError("give a path or a table name")


def preview(df: DataFrame, n: int = 5, order_by: Sequence[str] | Column | None = None) -> DataFrame:
    """``head()``: the first ``n`` rows, in a repeatable order when ``order_by`` is given."""
    if order_by is not None:
        df = df.orderBy(*([order_by] if isinstance(order_by, (str, Column)) else order_by))
    return df.limit(n)
