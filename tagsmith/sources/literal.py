"""Small literal tables (tag catalogue, dimensions, centre ranks) as inline
``VALUES`` relations: planned as a LocalTableScan, evaluated in the JVM with
no Python worker, and with exact size statistics for the broadcast checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(v)


def local_frame(spark: SparkSession, rows, schema: str) -> DataFrame:
    """``rows`` (tuples) with a ``"name type, ..."`` schema as a VALUES table."""
    fields = [f.strip().split() for f in schema.split(",")]
    names = [f[0] for f in fields]
    casts = ", ".join(f"CAST({n} AS {t}) AS {n}" for n, t in fields)
    if not rows:
        nulls = ", ".join(f"CAST(NULL AS {t}) AS {n}" for n, t in fields)
        return spark.sql(f"SELECT {nulls}").limit(0)
    body = ", ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT {casts} FROM VALUES {body} AS t({', '.join(names)})")
