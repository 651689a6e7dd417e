"""Profile and model storage.

The profile is written as a new immutable version folder per run (never an
in-place overwrite of the version being read), so a lost executor or a failed
job leaves the previous version intact and a retried task rewrites its own
files.  Models are saved with Spark ML's writer as versions behind a commit.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tagsmith.sources.commits import ConcurrentCommit, commits, publish, read_commit


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in its file system.  Any failure to tell (no
    permission, no connection) is raised."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(conf).exists(p))


def is_committed(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds the marker that the commit protocol writes
    after all data files of a job are in place."""
    return path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def write_profile(df: DataFrame, base_path: str, version: str, key: str = "userId",
                  buckets: int | None = None) -> str:
    """Write one profile version under ``<base_path>/version=<version>``.

    A committed version is never replaced (it may be read by other jobs); a
    version left half-written by a failed run is rewritten.  With ``buckets``
    the rows are hash-partitioned by ``key`` first, so each file holds a
    disjoint key range.
    """
    path = f"{base_path.rstrip('/')}/version={version}"
    if is_committed(df.sparkSession, path):
        raise FileExistsError(f"profile version {version} already exists at {path}")
    out = df.repartition(buckets, key) if buckets else df
    out.write.mode("overwrite").parquet(path)
    return path


def read_profile(spark: SparkSession, base_path: str, version: str) -> DataFrame:
    return spark.read.parquet(f"{base_path.rstrip('/')}/version={version}")


class ForeignModel(ValueError):
    """The stored model was trained for something else."""


def save_model(model, base: str, expect: dict | None = None, record: dict | None = None, version: int | None = None) -> int:
    """Publish ``model`` as the next version of the model store at ``base``.

    The model is written whole to a folder of its own and then named by a
    commit, so readers see the old model or the new one, never a part, and a
    writer that fails leaves the store as it was.  ``expect`` is what the model
    is for (columns, number of clusters, ...), ``record`` what it was trained
    on.  Raises ``ConcurrentCommit`` if another writer took the version."""
    spark, base = SparkSession.active(), base.rstrip("/")
    known = commits(spark, base)
    folder = f"models/{uuid.uuid4().hex}"
    model.write().save(f"{base}/{folder}")
    number = (known[-1] + 1 if known else 0) if version is None else version
    return publish(spark, base, {"folder": folder, "expect": expect or {}, "record": record or {}}, number)


def load_model(base: str, model_cls, expect: dict | None = None, version: int | None = None):
    """The newest (or the given) published model, None if there is none.
    Raises ``ForeignModel`` if it was saved with other values of ``expect``."""
    spark, base = SparkSession.active(), base.rstrip("/")
    found = read_commit(spark, base, version)
    if found is None:
        return None
    other = {k: found["expect"].get(k) for k, v in (expect or {}).items() if found["expect"].get(k) != v}
    if other:
        raise ForeignModel(f"the model at {base} is for {other}, not {({k: expect[k] for k in other})}")
    return model_cls.load(f"{base}/{found['folder']}")


def load_or_train(path: str, model_cls, train, expect: dict | None = None, record=None):
    """The published model of the store at ``path`` (see ``save_model``); if
    there is none, call ``train()`` and publish its result, or, when another
    trainer was faster, use that one's.  A plain model folder at ``path``
    itself, whole, is loaded as it is.  ``record()`` tells what was trained
    on."""
    spark = SparkSession.active()
    found = load_model(path, model_cls, expect)
    if found is not None:
        return found
    if is_committed(spark, f"{path.rstrip('/')}/metadata"):
        return model_cls.load(path)
    model = train()
    try:
        save_model(model, path, expect, record() if record else None, version=0)
    except ConcurrentCommit:
        return load_model(path, model_cls, expect)
    return model


# --- bucketed profile tables: the daily upsert does not shuffle the old profile ---

def write_profile_table(df: DataFrame, table: str, path: str, key: str = "userId",
                        buckets: int = 64) -> str:
    """Save a profile version as a table bucketed and sorted by ``key`` at
    ``path``.  A later full outer join on ``key`` reads it already
    hash-partitioned, so only the other side is shuffled.  An existing table
    is never replaced."""
    if df.sparkSession.catalog.tableExists(table):
        raise FileExistsError(f"profile table {table} already exists")
    (df.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(table))
    return table


def attach_profile_table(spark: SparkSession, table: str, path: str, ddl_columns: str,
                         key: str = "userId", buckets: int = 64) -> DataFrame:
    """Register a bucketed profile folder written earlier (e.g. by another
    session) under ``table`` with its bucketing spec, and return it."""
    if not spark.catalog.tableExists(table):
        spark.sql(f"CREATE TABLE {table} ({ddl_columns}) USING parquet "
                  f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {int(buckets)} BUCKETS "
                  f"LOCATION '{path}'")
    return spark.table(table)
