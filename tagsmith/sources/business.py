"""Rule-driven business scan.

A level-4 tag carries its data source as rule text, e.g.::

    inType=parquet
    table=customer
    selectFieldNames=c_custkey,c_mktsegment
    whereCondition=o_orderdate#month#6
    filterConditions=o_orderstatus[NE]P,o_totalprice[GE]1000

The scan is a stock Spark reader plus ``select`` and ``where``; Catalyst pushes
the projection and the comparisons into the Parquet scan.
"""

from __future__ import annotations

import functools
import operator
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagsmith.functions.dates import window_bounds

# fixed values: comparison codes accepted in a condition, case-insensitive
_OPS = {
    "eq": operator.eq, "ne": operator.ne, "gt": operator.gt,
    "lt": operator.lt, "ge": operator.ge, "le": operator.le,
}
_COND = re.compile(r"^\s*([^\[\]]+?)\s*\[(\w+)\]\s*(.*?)\s*$")

FILE_FORMATS = ("parquet", "orc", "csv", "json")
REQUIRED_KEYS = ("inType", "selectFieldNames")


def parse_condition(text: str) -> tuple[str, str, str]:
    """``field[OP]value`` -> (field, op, value); the value is the text after
    the bracket (the whole remainder), the op one of EQ NE GT LT GE LE."""
    m = _COND.match(text or "")
    if not m:
        raise ValueError(f"malformed condition {text!r}; expected field[OP]value")
    field, op, value = m.group(1), m.group(2).lower(), m.group(3)
    if op not in _OPS:
        raise ValueError(f"unknown comparison {m.group(2)!r} in {text!r}")
    return field, op, value


def _typed_literal(df: DataFrame, field: str, value: str) -> Column:
    dtype = df.schema[field].dataType
    if isinstance(dtype, T.StringType):
        return F.lit(value)
    return F.lit(value).cast(dtype)


def condition_filter(df: DataFrame, conditions, keep_missing: bool = False) -> DataFrame:
    """AND of ``field[OP]value`` conditions.  ``conditions`` is a list or a
    comma separated string; each value is cast to its column's type so the
    comparison is pushed to the Parquet reader unchanged.

    Comparisons follow the column type: typed columns compare by value,
    text columns compare as text (byte order, like the wide-column store's
    filters), so cast numeric text first if a numeric order is meant.
    A null field fails a comparison (SQL semantics).  ``keep_missing=True``
    lets rows with a null field pass that condition instead, as a wide-column
    store's single-column filter does for rows without the column."""
    if isinstance(conditions, str):
        conditions = [c for c in conditions.split(",") if c.strip()]
    preds = []
    for text in conditions:
        field, op, value = parse_condition(text)
        pred = _OPS[op](F.col(field), _typed_literal(df, field, value))
        preds.append(pred | F.col(field).isNull() if keep_missing else pred)
    return df.where(functools.reduce(operator.and_, preds)) if preds else df


def _window_predicate(df: DataFrame, spec: str, as_of) -> Column:
    parts = [p.strip() for p in spec.split("#")]
    if len(parts) != 3:
        raise ValueError(f"malformed window {spec!r}; expected field#unit#amount")
    field, unit, amount = parts
    lo, hi = window_bounds(int(amount), unit, as_of)
    dtype = df.schema[field].dataType
    col = F.col(field)
    if isinstance(dtype, T.DateType):
        return (col >= F.lit(lo)) & (col <= F.lit(hi))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        upper = hi.fromordinal(hi.toordinal() + 1)
        return (col >= F.lit(lo.isoformat()).cast(dtype)) & (col < F.lit(upper.isoformat()).cast(dtype))
    d = F.to_date(col)
    return (d >= F.lit(lo)) & (d <= F.lit(hi))


def rolling_window(df: DataFrame, spec: str, as_of) -> DataFrame:
    """``field#unit#amount`` (unit day / month=30 d / year=365 d): keep rows
    whose date is in ``[as_of-1-amount*unit, as_of-1]``.  Date and timestamp
    columns are compared directly with typed literals (pushed down)."""
    return df.where(_window_predicate(df, spec, as_of))


def rolling_windows(df: DataFrame, specs: list[str], as_of, label_col: str = "window") -> DataFrame:
    """Several rolling windows in one scan: the OR of the windows is pushed
    to the reader, and each row is emitted once per window it falls in, with
    ``label_col`` = the window's ``field#unit#amount``."""
    preds = [("#".join(p.strip() for p in spec.split("#")), _window_predicate(df, spec, as_of)) for spec in specs]
    hits = F.array(*[F.when(p, F.lit(label)) for label, p in preds])
    any_hit = functools.reduce(operator.or_, [p for _, p in preds])
    return (df.where(any_hit).select(F.explode(F.array_compact(hits)).alias(label_col), *df.columns))


def scan_options(rule_text: str) -> dict[str, str]:
    """Level-4 rule text -> options dict, validating the required keys."""
    opts = {}
    for line in (rule_text or "").replace("\r", "").split("\n"):
        if not line.strip():
            continue
        if "=" not in line:
            raise ValueError(f"malformed rule line {line!r}; expected key=value")
        k, v = line.split("=", 1)
        opts[k.strip()] = v.strip()
    missing = [k for k in REQUIRED_KEYS if not opts.get(k)]
    if missing:
        raise ValueError(f"rule is missing {missing}")
    return opts


def business_scan(spark: SparkSession, options: dict[str, str], base_dir: str | None = None,
                  as_of=None) -> DataFrame:
    """Load the business data a level-4 rule describes.

    ``inType`` is a stock format (parquet / orc / csv / json) read from
    ``path`` or ``<base_dir>/<table>.<inType>``, or ``table`` for a catalog
    table.  Any other type is an error.
    """
    in_type = options["inType"].lower()
    if in_type in FILE_FORMATS:
        path = options.get("path")
        if not path:
            if not options.get("table") or base_dir is None:
                raise ValueError("file source needs path, or table plus base_dir")
            path = f"{base_dir.rstrip('/')}/{options['table']}.{in_type}"
        reader = spark.read.format(in_type)
        if in_type == "csv":
            reader = reader.option("header", options.get("header", "true"))
        df = reader.load(path)
    elif in_type == "table":
        df = spark.table(options["table"])
    else:
        raise ValueError(f"unsupported inType {options['inType']!r}")
    fields = [f.strip() for f in options["selectFieldNames"].split(",") if f.strip()]
    if options.get("filterConditions"):
        df = condition_filter(df, options["filterConditions"])
    if options.get("whereCondition"):
        if as_of is None:
            raise ValueError("whereCondition needs an as_of date")
        df = rolling_window(df, options["whereCondition"], as_of)
    return df.select(*fields)
