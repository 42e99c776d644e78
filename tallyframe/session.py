"""Spark session helpers.

On a cluster the session comes from the platform; these helpers only build a
local session for tests and the bench, and resolve the checkpoint folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tallyframe", driver_memory: str = "8g",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A local session configured the way the library expects a cluster to be.

    AQE is on so that small dimension sides become broadcasts only after
    their runtime size is measured, and skewed shuffle partitions are split.
    ANSI mode stays on so a bad cast fails instead of turning into a null.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; only when it is unset in local
    mode (tests) do we create a scratch folder of our own.  On a cluster an
    unset folder is an error, and so is one that cannot be written or that
    the executors do not see (:func:`check_shared`, once per session and folder).
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        if not _in_one_process(spark):
            check_shared(spark, configured)
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not _in_one_process(spark):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder; a machine-local folder "
                           "does not survive the loss of an executor")
    path = tempfile.mkdtemp(prefix="tallyframe-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def _in_one_process(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


_CHECKED: set[tuple[str, str]] = set()
PROBES = 8


def check_shared(spark: SparkSession, folder: str) -> None:
    """Refuse a checkpoint folder that executors do not share with the driver.

    The driver writes a few small files there and one job reads them back,
    each in a task of its own; a folder on the driver's own disk fails.
    """
    key = (spark.sparkContext.applicationId, folder)
    if key in _CHECKED:
        return
    jvm = spark._jvm
    probe = f"{folder.rstrip('/')}/tallyframe-probe-{uuid.uuid4().hex}"
    at = jvm.org.apache.hadoop.fs.Path(probe)
    system = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    try:
        for i in range(PROBES):
            out = system.create(jvm.org.apache.hadoop.fs.Path(f"{probe}/{i}"), True)
            out.write(bytearray(b"seen"))
            out.close()
        seen = spark.sparkContext.textFile(probe, PROBES)._jrdd.count()
    except Exception as e:
        raise RuntimeError(f"spark.checkpoint.dir {folder} is not a folder that the driver and all executors share") from e
    finally:
        system.delete(at, True)
    if seen != PROBES:
        raise RuntimeError(f"executors do not see what the driver writes to spark.checkpoint.dir {folder}")
    _CHECKED.add(key)


# Settings for a large cluster, applied only where the session leaves them
# unset.  The initial shuffle partition count is high so that AQE can
# coalesce small stages down while big stages stay at ~64-128 MB per task;
# skew joins are split; file splits stay at 128 MB.
SCALE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.ansi.enabled": "true",
}


def configure_for_scale(spark: SparkSession, overrides: dict[str, str] | None = None) -> dict[str, str]:
    """Apply :data:`SCALE_DEFAULTS` (plus ``overrides``) to settings the session has not set.

    Returns the settings that were changed.
    """
    wanted = {**SCALE_DEFAULTS, **(overrides or {})}
    changed = {}
    for k, v in wanted.items():
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)
            changed[k] = v
    return changed
