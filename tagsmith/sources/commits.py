"""Commit pointers: numbered small files that name what is current.

A version is published by moving a finished text file to ``<base>/_commits/
<number>`` with a rename that fails if the number is taken, so readers see a
whole version or none and of two writers one loses.  Data written by a failed
or losing writer is never named by a commit and so never read.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class ConcurrentCommit(RuntimeError):
    """Another writer has published the version first."""


def _fs(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(conf)


def commits(spark: SparkSession, base: str) -> list[int]:
    """The published versions, ascending."""
    _, folder, fs = _fs(spark, f"{base.rstrip('/')}/_commits")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n) for n in names if n.isdigit())


def read_commit(spark: SparkSession, base: str, version: int | None = None) -> dict | None:
    """What version ``version`` (default: the newest) says, with its number
    under ``version``; None if nothing is published."""
    known = commits(spark, base)
    if not known or (version is not None and version not in known):
        return None
    number = known[-1] if version is None else version
    jvm, path, fs = _fs(spark, f"{base.rstrip('/')}/_commits/{number:012d}")
    stream = fs.open(path)
    try:
        text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return {**json.loads(text), "version": number}


def publish(spark: SparkSession, base: str, content: dict, version: int) -> int:
    """Make ``content`` version ``version``; raises ``ConcurrentCommit`` if
    that version exists."""
    base = base.rstrip("/")
    jvm, draft, fs = _fs(spark, f"{base}/_commits/_draft-{uuid.uuid4().hex}")
    _, final, _ = _fs(spark, f"{base}/_commits/{version:012d}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(json.dumps(content).encode("utf-8")))
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    rename = jvm.java.lang.reflect.Array.newInstance(jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
    try:
        if final.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(final):
            raise ConcurrentCommit(f"version {version} of {base} exists")
        context.rename(draft, final, rename)
    except ConcurrentCommit:
        fs.delete(draft, False)
        raise
    except Exception as exc:  # noqa: BLE001 - the file system's own class
        fs.delete(draft, False)
        if "FileAlreadyExists" in str(exc):
            raise ConcurrentCommit(f"version {version} of {base} exists") from exc
        raise
    return version
