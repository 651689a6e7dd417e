"""A profile store with delta upserts: copy-on-write per key bucket.

Users are dealt to a fixed number of buckets by a hash of their key.  A
version is a commit (see ``commits``) that names, for every bucket, the folder
holding its rows.  An upsert reads and rewrites only the buckets that the
delta touches; all other buckets of the new version are the same files as
before.  Older versions stay readable, and a look-up of some keys reads only
their buckets.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagsmith.operators.joins import has_at_most
from tagsmith.operators.lineage import cut_lineage
from tagsmith.operators.profile import profile_upsert
from tagsmith.sources.commits import publish, read_commit

BUCKET = "_bucket"
# a commit names every bucket, so their number is bounded
MAX_BUCKETS = 100_000


def bucket_of(key: str, buckets: int):
    """Bucket number of a key, stable over sessions."""
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def _one_row_per_key(df: DataFrame, key: str) -> DataFrame:
    """Rows without a key are left out; of several rows of a key each column
    keeps its largest non-null value."""
    cells = [F.max(c).alias(c) for c in df.columns if c != key]
    rows = df.where(F.col(key).isNotNull())
    return rows.groupBy(key).agg(*cells).select(*df.columns) if cells else rows.distinct()


def _write(rows: DataFrame, base: str, key: str, touched: int) -> str:
    """Write rows that carry ``BUCKET``, one file a bucket; returns the new
    folder's name, relative to the store."""
    folder = f"data/{uuid.uuid4().hex}"
    rows.repartition(max(1, touched), BUCKET).sortWithinPartitions(BUCKET, key) \
        .write.partitionBy(BUCKET).parquet(f"{base.rstrip('/')}/{folder}")
    return folder


def _touched(rows: DataFrame) -> list[int]:
    return sorted(r[0] for r in rows.select(BUCKET).distinct().collect())  # at most one row per bucket


def create_store(df: DataFrame, base: str, key: str = "userId", buckets: int = 64) -> int:
    """Version 0: ``df`` with one row per key (see ``_one_row_per_key``)."""
    if not 1 <= buckets <= MAX_BUCKETS:
        raise ValueError(f"buckets must be 1..{MAX_BUCKETS}")
    spark = df.sparkSession
    rows = cut_lineage(_one_row_per_key(df, key).withColumn(BUCKET, bucket_of(key, buckets)))
    held = _touched(rows)
    folder = _write(rows, base, key, len(held)) if held else None
    content = {"key": key, "buckets": buckets, "schema": df.schema.json(), "folders": {str(b): folder for b in held}}
    return publish(spark, base, content, 0)


def _state(spark: SparkSession, base: str, version: int | None) -> dict:
    state = read_commit(spark, base, version)
    if state is None:
        raise FileNotFoundError(f"no committed version {'' if version is None else version} in {base}")
    return state


def _schema(state: dict) -> T.StructType:
    import json
    return T.StructType.fromJson(json.loads(state["schema"]))


def bucket_paths(spark: SparkSession, base: str, version: int | None = None) -> dict[int, str]:
    """The folder of each bucket that holds rows."""
    return {int(b): f"{base.rstrip('/')}/{f}/{BUCKET}={b}" for b, f in _state(spark, base, version)["folders"].items()}


def read_store(spark: SparkSession, base: str, version: int | None = None, only: list[int] | None = None) -> DataFrame:
    """The profile at ``version`` (default: the newest), or some of its
    buckets.  Columns added after a bucket was written are null there."""
    state = _state(spark, base, version)
    paths = [p for b, p in bucket_paths(spark, base, state["version"]).items() if only is None or b in set(only)]
    schema = _schema(state)
    if not paths:
        nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
        return spark.range(0).select(*nulls)
    return spark.read.schema(schema).parquet(*paths)


def look_up(spark: SparkSession, base: str, keys: DataFrame, version: int | None = None, max_keys: int = 1_000_000) -> DataFrame:
    """Profile rows of the keys in ``keys`` (one column of the key's name).
    Only the buckets of those keys are read.  Beyond ``max_keys`` keys the
    join shuffles; a null or unknown key finds nothing."""
    state = _state(spark, base, version)
    key, n = state["key"], state["buckets"]
    wanted = cut_lineage(keys.select(F.col(key).cast(_schema(state)[key].dataType)).where(F.col(key).isNotNull()).distinct())
    buckets = _touched(wanted.select(bucket_of(key, n).alias(BUCKET)))
    rows = read_store(spark, base, state["version"], only=buckets)
    return rows.join(F.broadcast(wanted) if has_at_most(wanted, max_keys) else wanted, key, "left_semi")


def upsert_store(delta: DataFrame, base: str) -> int:
    """A new version with ``delta`` merged cell by cell (see
    ``profile_upsert``): a non-null new value replaces the old one, new users
    and new columns are added, everything else is kept.  Returns the version;
    an empty delta publishes nothing.

    Raises ``ConcurrentCommit`` if another writer published meanwhile; then
    nothing has changed and the call can be repeated."""
    spark = delta.sparkSession
    state = _state(spark, base, None)
    key, n, schema = state["key"], state["buckets"], _schema(state)
    for f in delta.schema.fields:
        if f.name in schema.names and schema[f.name].dataType != f.dataType:
            raise TypeError(f"column {f.name} is {schema[f.name].dataType.simpleString()} in the store, {f.dataType.simpleString()} in the delta")
    new = cut_lineage(_one_row_per_key(delta, key))
    touched = _touched(new.select(bucket_of(key, n).alias(BUCKET)))
    if not touched:
        return state["version"]
    merged = profile_upsert(read_store(spark, base, state["version"], only=touched), new, key)
    fields = list(schema.fields) + [f for f in delta.schema.fields if f.name not in schema.names]
    folder = _write(merged.select(*[f.name for f in fields]).withColumn(BUCKET, bucket_of(key, n)), base, key, len(touched))
    content = {"key": key, "buckets": n, "schema": T.StructType(fields).json(),
               "folders": {**state["folders"], **{str(b): folder for b in touched}}}
    return publish(spark, base, content, state["version"] + 1)
