"""Helpers shared by the corpus operators."""

from __future__ import annotations

import itertools
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# words are runs of anything but space, tab, LF, VT, FF, CR, after A-Z -> a-z
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors (once per application), whose
    Python need not have it installed."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="tagsmith-zip-"), f"{os.path.basename(top)}.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, names in os.walk(top):
                for n in names:
                    if n.endswith(".py"):
                        full = os.path.join(folder, n)
                        z.write(full, os.path.relpath(full, os.path.dirname(top)))
        spark.sparkContext.addPyFile(path)
        _shipped.add(app)


def work_dir(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables: the one the cluster
    names in ``spark.checkpoint.dir``.  Only a local session without that
    setting gets a scratch folder; on a cluster a missing setting raises."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tagsmith-llm-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/") + "/tagsmith-llm"


def table_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stash(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: later
    jobs start from the files, also after executors are lost.  The files stay
    until the owner of the shared folder empties it."""
    spark = df.sparkSession
    path = table_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    return next(c for c in itertools.chain([f"__{stem}"], (f"__{stem}_{i}" for i in itertools.count()))
                if c.lower() not in taken)


def map_batches(df: DataFrame, fn: Callable[[pa.Table], pa.Table | None], schema: T.StructType,
                rows: int = 1024) -> DataFrame:
    """``mapInArrow`` over slices of at most ``rows`` rows, so that a task
    holds the Python copies of few texts at once.  ``fn`` must hold no state."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, rows):
                out = fn(pa.Table.from_batches([batch.slice(i, rows)]))
                if out is not None and out.num_rows:
                    yield from out.to_batches()
    return df.mapInArrow(run, schema)


def add_columns(df: DataFrame, on: list[str], fn: Callable[..., list[pa.Array]], new: T.StructType,
                rows: int = 1024) -> DataFrame:
    """``df`` with the columns of ``new`` appended (or replaced in place when
    the name exists); ``fn`` maps the arrays of the columns ``on`` to the
    arrays of the new columns."""
    kept = [f for f in df.schema.fields if f.name not in new.names]
    schema = T.StructType(kept + list(new.fields))
    order = [f.name for f in df.schema.fields] + [n for n in new.names if n not in df.columns]

    def run(t: pa.Table) -> pa.Table:
        made = fn(*(t.column(c).combine_chunks() for c in on))
        return pa.table([t.column(f.name) for f in kept] + list(made), names=schema.names)
    # Arrow matches by position; duplicate names are refused by Spark itself
    return map_batches(df, run, schema, rows).select(*[F.col(f"`{c}`") for c in order])


def arrow_batches(df: DataFrame) -> Iterator[pa.RecordBatch]:
    """Rows of a bounded result, packed by the executors into one binary row
    per slice so that the driver never holds them as Python objects."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, b.schema) as w:
                w.write_batch(b)
            yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["raw"])
    for row in df.mapInArrow(run, "raw binary").toLocalIterator():
        yield from pa.ipc.open_stream(row.raw)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words ``[^\\x20\\x09-\\x0D]+`` as UTF-8 bytes."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(LOWER).split()


def remainder(col, modulus: int):
    """crc32 of the id's decimal text, modulo ``modulus`` (null for a null id)."""
    return F.crc32(col.cast("string").cast("binary")) % F.lit(modulus)


class Links:
    """Union-find over positions 0..n-1 fed with arrays of links; holds n
    labels only, whatever the number of links."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, u: np.ndarray, v: np.ndarray) -> None:
        lab = self.label
        while len(u):
            a, b = lab[u], lab[v]
            on = a != b
            if not on.any():
                return
            u, v, a, b = u[on], v[on], a[on], b[on]
            np.minimum.at(lab, np.maximum(a, b), np.minimum(a, b))
            while True:  # point every label at its root
                up = lab[lab]
                if (up == lab).all():
                    break
                lab[:] = up


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of the links (a, b): one row (node, component),
    the component named by its smallest node, for every node with a link.

    Alternates the large-star and small-star steps of Kiveris et al. (2014):
    each step joins a table of links with its per-node minimum.  The minima
    are written first: a join of two plainly shuffled tables is one whose
    skewed partitions AQE can split, so a hub is never one task's group.  Each
    round is written to the shared folder."""
    e = stash(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
              .where("u <> v").distinct(), "links")
    facts = None
    while True:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stash(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "lowest")
        large = stash(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "links")
        low = stash(large.groupBy("u").agg(F.min("v").alias("m")), "lowest")
        small = large.join(low, "u")
        e = stash(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                  .union(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == facts:
            break
        facts = now
    # a fixed point is a forest of stars: each node once, linked to its minimum
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
