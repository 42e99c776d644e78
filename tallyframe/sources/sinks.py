"""Sinks (S5-S7, S9-S11): full-refresh tables with a load report, views,
namespaces and fixed-order CSV exports.

A full refresh writes the rows as a new version beside the live one and then
moves a pointer, so readers see the old table or the new one, never half of
either, and a job that dies leaves the old one live.  Each table is its own
commit unit, as in the reference's loader, and rerunning a load is safe.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def create_namespace(spark: SparkSession, name: str) -> None:
    """S7."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register a relation as a (temporary) view and return it."""
    df.createOrReplaceTempView(name)
    return df


POINTER = "_CURRENT"


def full_refresh(df: DataFrame, name: str, namespace: str | None = None, path: str | None = None,
                 fmt: str = "parquet", keep_versions: int = 2) -> int:
    """S5 + S10 + S6: replace the target table and return its row count.

    The rows go to a new folder ``<location>/v-<id>``; its name then replaces
    the one in ``<location>/_CURRENT`` by a rename, and ``name`` is redefined
    over it in the catalog.  Until the rename, both still stand for the
    version before.  The newest ``keep_versions`` versions stay, so a reader
    of the version before can finish; older ones are removed.  ``location``
    is ``path``, or a folder of the warehouse.

    The count is an ``Observation`` collected while the rows are written, so
    the data is not read a second time.
    """
    spark = df.sparkSession
    location = (path or _warehouse_folder(spark, name, namespace)).rstrip("/")
    version = f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    obs = Observation(f"load_{name}_{version}")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.format(fmt).save(f"{location}/{version}")
    rows = int(obs.get["rows"])
    _point(spark, location, version)
    table = f"`{namespace}`.`{name}`" if namespace else f"`{name}`"
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType not in ("VIEW", "TEMPORARY"):
        spark.sql(f"DROP TABLE {table}")                    # of a load before tables had versions
    where = f"{location}/{version}".replace("`", "``")
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {fmt}.`{where}`")
    _forget(spark, location, keep_versions)
    return rows


def live_version(spark: SparkSession, location: str) -> str:
    """The folder that holds the live version of a refreshed table (for readers without the catalog)."""
    jvm, fs, at = _file_system(spark, f"{location.rstrip('/')}/{POINTER}")
    stream = fs.open(at)
    try:
        name = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return f"{location.rstrip('/')}/{name}"


def _warehouse_folder(spark: SparkSession, name: str, namespace: str | None) -> str:
    database = spark.sql(f"DESCRIBE DATABASE `{namespace or spark.catalog.currentDatabase()}`").filter("info_name = 'Location'").first()
    return f"{database['info_value'].rstrip('/')}/versions/{name}"


def _file_system(spark: SparkSession, path: str):
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def _point(spark: SparkSession, location: str, version: str) -> None:
    """Replace the pointer file in one rename."""
    jvm, fs, new = _file_system(spark, f"{location}/.{version}.pointer")
    out = fs.create(new, True)
    try:
        out.write(bytearray(version, "utf-8"))
    finally:
        out.close()
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), fs.getConf())
    context.rename(fs.makeQualified(new), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(f"{location}/{POINTER}")), overwrite)


def _forget(spark: SparkSession, location: str, keep: int) -> None:
    """Remove what is older than the newest ``keep`` finished versions (up to the live one), unfinished ones included."""
    jvm, fs, at = _file_system(spark, location)
    path = jvm.org.apache.hadoop.fs.Path
    live = live_version(spark, location).rsplit("/", 1)[1]
    found = sorted(s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory() and s.getPath().getName().startswith("v-"))
    done = [v for v in found if v <= live and fs.exists(path(f"{location}/{v}/_SUCCESS"))]
    oldest = done[-max(1, keep):][0] if done else live
    for version in found:
        if version < oldest:
            fs.delete(path(f"{location}/{version}"), True)


def load_all(spark: SparkSession, tables: Mapping[str, DataFrame], namespace: str,
             base_path: str | None = None, skipped: Mapping[str, str] | None = None) -> DataFrame:
    """S3 + S4 + S5 + S6: full refresh of every table.

    Returns the load report (table_name, status, rows): ``loaded`` with the
    row count observed while writing, or ``skipped`` (rows null) for inputs
    the registry load did not find.
    """
    create_namespace(spark, namespace)
    report = []
    for name, df in tables.items():
        path = f"{base_path.rstrip('/')}/{name}" if base_path else None
        report.append((name, "loaded", full_refresh(df, name, namespace, path)))
    for name in (skipped or {}):
        report.append((name, "skipped", None))
    return spark.createDataFrame(report, "table_name string, status string, rows bigint")


def write_csv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """CSV export with a header and a fixed column order."""
    df.select(*columns).write.mode("overwrite").option("header", True).option("quote", '"') \
        .option("escape", '"').csv(path)
