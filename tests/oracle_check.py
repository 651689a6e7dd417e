"""Compare every registered query with its DuckDB oracle (the driver's
correctness gate, reproduced locally): row count, column names/types, and an
order-insensitive hash of the values.

    python tests/oracle_check.py [sf_dir] [name ...] [--plain] [--pandas] [--round]

Floats are compared exactly unless ``--round`` is given.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import json
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Spark simple type -> DuckDB type name, for the schema comparison
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE", "float": "FLOAT"}

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


ROUND_FLOATS = "--round" in sys.argv  # default: floats must match bit for bit


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) if ROUND_FLOATS else repr(v)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v else "nan"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return [norm(x) for x in v]
    if hasattr(v, "tolist"):
        return norm(v.tolist())
    return v


def frame_rows(pdf):
    """Rows of a pandas frame as plain Python values (NaN/NaT -> None)."""
    import pandas as pd
    out = []
    for rec in pdf.itertuples(index=False, name=None):
        row = []
        for v in rec:
            if v is None or (not isinstance(v, (list, tuple)) and not hasattr(v, "__len__") and pd.isna(v)):
                row.append(None)
            elif hasattr(v, "item") and not hasattr(v, "__len__"):
                row.append(v.item())
            elif isinstance(v, pd.Timestamp):
                row.append(v.to_pydatetime())
            else:
                row.append(v)
        out.append(tuple(row))
    return out


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(json.dumps([norm(r[i]) for i in order], default=str) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    plain = "--plain" in args
    via_pandas = "--pandas" in args
    names = [a for a in args if not a.startswith(("/", "--"))]
    import duckdb
    from tagsmith.session import build_session
    import __spark_entry__ as E
    if plain:  # a session like the driver's: no tuning, no scratch folders
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[*]")
                 .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    else:
        spark = build_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, oracles = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir)
            srows = frame_rows(sdf.toPandas()) if via_pandas else [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
            stypes = [f.dataType.simpleString() for f in sdf.schema.fields]
        except Exception as exc:  # noqa: BLE001
            bad += 1
            print(f"FAIL {name}: spark error {type(exc).__name__}: {str(exc)[:400]}")
            continue
        el = time.time() - t0
        if name not in oracles:
            print(f"rows {name}: {len(srows)} rows (no oracle) {el:.1f}s")
            continue
        try:
            res = con.execute(oracles[name])
            ocols = [d[0] for d in res.description]
            orows = frame_rows(res.df()) if via_pandas else res.fetchall()
            otypes = [str(d[1]) for d in res.description]
        except Exception as exc:  # noqa: BLE001
            bad += 1
            print(f"FAIL {name}: duckdb error {str(exc)[:400]}")
            continue
        ok_cols = sorted(scols) == sorted(ocols)
        ok_n = len(srows) == len(orows)
        ok_h = ok_cols and digest(srows, scols) == digest(orows, ocols)
        stype = dict(zip(scols, (SPARK_TO_DUCK.get(t, t) for t in stypes)))
        ok_t = ok_cols and all(stype[c] == t for c, t in zip(ocols, otypes))
        status = "ok  " if (ok_cols and ok_n and ok_h and ok_t) else "FAIL"
        if status != "ok  ":
            bad += 1
        print(f"{status} {name}: rows {len(srows)}/{len(orows)} cols={ok_cols} types={ok_t} hash={ok_h} {el:.1f}s"
              + ("" if ok_cols else f" spark={scols} duck={ocols}")
              + f" types spark={stypes} duck={otypes}" * (status != "ok  "))
    print(f"{bad} failing")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
