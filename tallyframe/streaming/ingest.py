"""Incremental raw load: the text ingest of :mod:`tallyframe.sources.text`
run as a Structured Streaming file source.

The reference reloads everything on each run.  When exports arrive as new
files in a folder, the same load can be run incrementally: each file is read
exactly once (tracked in the checkpoint), rows are appended to a parquet
table, and ``availableNow`` processes whatever has arrived and then stops, so
it can be scheduled like a batch job.  Columns stay text; staging is applied
downstream exactly as for a batch load.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..session import ensure_checkpoint_dir
from ..sources.text import text_schema


def ingest_new_files(spark: SparkSession, source_dir: str, columns: Sequence[str], target_path: str,
                     name: str, checkpoint: str | None = None, wait: bool = True) -> StreamingQuery:
    """Append the rows of CSV files not seen before to ``target_path``.

    The checkpoint lives under the session's shared ``spark.checkpoint.dir``
    unless one is given, so a restarted job (or a lost executor) resumes
    without reading a file twice.
    """
    if checkpoint is None:
        checkpoint = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ingest-{name}"
    stream = (spark.readStream.schema(text_schema(columns)).option("header", True)
              .option("quote", '"').option("escape", '"').option("mode", "FAILFAST")
              .option("enforceSchema", False)   # a file with another header fails instead of being read by position
              .csv(source_dir))
    query = (stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
             .outputMode("append").trigger(availableNow=True).start(target_path))
    if wait:
        query.awaitTermination()
    return query
