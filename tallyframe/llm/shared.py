"""Tables kept in the cluster's shared folder between the jobs of one operator."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tallyframe.session import ensure_checkpoint_dir


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back.

    Later jobs read the files, whichever executors are lost meanwhile, and
    the rows they see are fixed.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tallyframe-llm/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
