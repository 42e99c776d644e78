"""Raw text ingest (S1-S4, S8): CSV exports loaded with every column as text.

The header names the columns and nothing is inferred: typing is the job of
the staging models, where a bad value raises instead of being guessed.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# fixed values: the reference's raw tables and the file each is exported to
RAW_FILES = {
    "accounts": "accounts.csv",
    "members": "members.csv",
    "plans": "plans.csv",
    "subscriptions": "subscriptions.csv",
    "workouts": "workouts.csv",
    "orders": "orders.csv",
    "support_tickets": "support_tickets.csv",
    "campaigns": "campaigns.csv",
    "account_acquisition": "account_acquisition.csv",
}


def text_schema(columns: Sequence[str]) -> StructType:
    """All-text schema for the given column names."""
    return StructType([StructField(c, StringType(), True) for c in columns])


def read_text_csv(spark: SparkSession, paths: str | Sequence[str], multi_line: bool = False,
                  schema: StructType | None = None) -> DataFrame:
    """S1 + S2: one or more CSV exports of the same shape as one all-text table.

    UTF-8, comma separated, ``"`` quotes with ``""`` as the escaped quote.  An
    unquoted blank reads as null and a quoted blank as ``''`` (the staging
    casts treat both as missing).  Malformed rows fail the read (FAILFAST).
    ``multi_line`` is needed only when quoted values contain line breaks; it
    makes each file a single split, so it is off by default.

    Columns are matched by name.  Files of several paths are read per
    distinct header, and their rows are aligned; a file that lacks a column
    another one has is refused.  Which file has which header is found by one
    job over all files (:func:`header_census`), however many there are.  With
    ``schema`` the header of every file must be that schema, in its order; a
    file with another header fails the read.
    """
    reader = (spark.read.option("header", True).option("inferSchema", False)
              .option("encoding", "UTF-8").option("quote", '"').option("escape", '"')
              .option("multiLine", multi_line).option("mode", "FAILFAST"))
    if schema is not None:
        return reader.schema(schema).option("enforceSchema", False).csv(list(paths) if not isinstance(paths, str) else paths)
    files = [f for path in ([paths] if isinstance(paths, str) else paths) for f in _files(spark, path)]
    headers: dict[tuple[str, ...], list[str]] = {}
    for same in header_census(spark, files).values():
        # files with one first line have one header; Spark's own reader parses it
        headers.setdefault(tuple(reader.csv(same[0]).columns), []).extend(same)
    first, *others = headers or {(): [paths]}
    for other in others:
        if set(other) != set(first):
            raise ValueError(f"{headers[other][0]} has columns {list(other)}, {headers[first][0]} has {list(first)}")
    out = None
    for header, same in headers.items():
        # the header is checked file by file when it is read
        part = reader.schema(text_schema(header)).option("enforceSchema", False).csv(same)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else reader.csv(paths)


def header_census(spark: SparkSession, files: Sequence[str]) -> dict[str | None, list[str]]:
    """Files by their first line (None: no line), found by one Spark job.

    Every file is one task, which stops after the first line.  What reaches
    the driver is one row per file, like the list of files itself.
    """
    if len(files) < 2:
        return {None: list(files)} if files else {}
    alone = {"spark.sql.files.maxPartitionBytes": str(1 << 60), "spark.sql.files.openCostInBytes": str(1 << 60)}
    before = {k: spark.conf.get(k, None) for k in alone}
    try:
        for k, v in alone.items():
            spark.conf.set(k, v)
        lines = spark.read.text(list(files)).select(F.col("_metadata.file_path").alias("file"), "value")
        got = lines.mapInArrow(_first_row, "file string, value string").collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    first = {_plain(r["file"]): r["value"] for r in got}
    out: dict[str | None, list[str]] = {}
    for f in files:
        out.setdefault(first.get(_plain(f)), []).append(f)
    return out


def _first_row(batches: Iterator) -> Iterator:
    for batch in batches:
        if batch.num_rows:
            yield batch.slice(0, 1)
            return


def _plain(path: str) -> str:
    """One spelling of a file's address, whether it comes from a listing or from a scan."""
    return unquote(path).replace("file:///", "file:/")


def _files(spark: SparkSession, path: str) -> list[str]:
    """The files that a path, folder or glob stands for (names only, listed by Spark's file system)."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = []
    for status in system.globStatus(at) or []:
        inner = system.listStatus(status.getPath()) if status.isDirectory() else [status]
        found += [s.getPath().toString() for s in inner if s.isFile() and not s.getPath().getName().startswith(("_", "."))]
    return found or [path]


@dataclass
class LoadResult:
    tables: dict[str, DataFrame]
    skipped: dict[str, str]


def load_registry(spark: SparkSession, directory: str, files: Mapping[str, str] = RAW_FILES,
                  multi_line: bool = False) -> LoadResult:
    """S3 + S4: every registered table from ``directory``; a missing file is
    reported as skipped instead of failing the whole load."""
    tables, skipped = {}, {}
    for name, file in files.items():
        path = f"{directory.rstrip('/')}/{file}"
        try:
            tables[name] = read_text_csv(spark, path, multi_line=multi_line)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e) and "Path does not exist" not in str(e):
                raise
            skipped[name] = path
    return LoadResult(tables, skipped)


def named_table(spark: SparkSession, name: str, namespace: str | None = None) -> DataFrame:
    """A table or view by name."""
    return spark.table(f"{namespace}.{name}" if namespace else name)
