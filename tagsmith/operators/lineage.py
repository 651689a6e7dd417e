"""Materialising intermediate results that several jobs read."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the session's checkpoint folder (the shared
    folder named by ``spark.checkpoint.dir`` on a cluster), so repeated reads
    use one materialised copy that survives a lost executor.  Without a
    folder a cluster session raises; a local one gets a scratch folder.

    The input is cached for the duration of the checkpoint: writing a
    reliable checkpoint runs a second job over the data, which would otherwise
    recompute the whole plan.  The cache is released in any case."""
    from tagsmith.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return cached.checkpoint(eager=True)
    finally:
        cached.unpersist()


def work_path(spark: SparkSession, name: str) -> str:
    """A new path for a written table in the shared checkpoint folder."""
    from tagsmith.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
