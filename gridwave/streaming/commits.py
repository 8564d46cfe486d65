"""Micro-batches written as folders ``batch=<id>`` that appear whole or not at all.

A batch is written under a hidden name and then renamed.  A batch that is run
again after a failure finds its folder and leaves it, so a killed run neither
loses nor repeats rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from gridwave.session import path_exists, publish

BATCH = "batch"


def commit_batch(df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = (),
                 max_rows: int = 0) -> None:
    """Write ``df`` as batch ``batch_id`` of the table at ``path``, once; a part file
    of it holds at most ``max_rows``, or any number."""
    spark = df.sparkSession
    final = f"{path}/{BATCH}={batch_id}"
    if path_exists(spark, final):
        return
    hidden = f"{path}/_run-{batch_id}-{uuid.uuid4().hex[:8]}"
    df.write.partitionBy(*partition_by).option("maxRecordsPerFile", str(max_rows)).parquet(hidden)
    publish(spark, hidden, final)


def batches(spark: SparkSession, path: str) -> list[int]:
    """Ids of the finished batches, in order."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith(f"{BATCH}="))
