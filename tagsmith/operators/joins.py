"""Joins against small sides, with the size checked before broadcasting.

``broadcast()`` is only applied after a measurement proves the side small in
rows and in bytes.  The measurement is one partially aggregated count and sum:
each task sends two numbers, whatever the side's size.  Beyond the bound the
join is a normal shuffle join, which AQE may still turn into a broadcast from
measured sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A broadcast side is shipped to every executor: bound rows and bytes.
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 64 << 20


def row_bytes(df: DataFrame):
    """Estimated bytes of a row as an expression: the length of text, binary
    and nested values (as text), 8 for any other value."""
    fixed, varying = 0, []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            varying.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            varying.append(F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)))
        fixed += 8
    out = F.lit(fixed).cast("long")
    for v in varying:
        out = out + v
    return out


def is_literal(df: DataFrame) -> bool:
    """Whether the optimised plan of ``df`` is nothing but rows that it holds
    itself."""
    return df._jdf.queryExecution().optimizedPlan().nodeName() == "LocalRelation"


def has_at_most(df: DataFrame, max_rows: int, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes.
    Rows that the plan holds as literals (an inline rule table) are measured
    there, without a job."""
    if is_literal(df):
        sizes = df.select(row_bytes(df).alias("bytes")).collect()
        return len(sizes) <= max_rows and sum(r["bytes"] for r in sizes) <= max_bytes
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_rows: int = DEFAULT_BROADCAST_ROWS, bound_from: DataFrame | None = None) -> DataFrame:
    """``big.join(small)``; ``small`` is broadcast only when proven small.
    ``how`` must keep ``big`` on the streamed side (inner, left, semi, anti).

    ``bound_from`` is a frame that holds at least ``small``'s rows and values
    (e.g. the rule rows that ``small`` de-duplicates); measuring it is cheaper
    when it needs no shuffle."""
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti", "semi", "anti"):
        raise ValueError(f"join_small cannot broadcast the right side of a {how!r} join")
    if has_at_most(small if bound_from is None else bound_from, max_rows):
        small = F.broadcast(small)
    return big.join(small, on, how)


# A nested-loop range join costs (rows x ranges) comparisons; keep it for
# band tables of CASE-chain size only.
MAX_LOOP_RANGES = 64


def range_join(big: DataFrame, value: str, ranges: DataFrame, start: str = "start",
               end: str = "end", how: str = "inner", max_loop_ranges: int = MAX_LOOP_RANGES,
               max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Rows of ``big`` joined to every range with ``start <= value <= end``.

    * up to ``max_loop_ranges`` ranges (age / recency bands): broadcast
      nested-loop join, a handful of comparisons per row, no shuffle;
    * more ranges: an exact equi-join on value buckets whose width is the
      *average* range span.  A range is copied into every bucket it touches
      (about three copies per range in total), each value probes only its own
      bucket, and one very wide range cannot pull all values into a single
      hot bucket.  The bucketed range table is broadcast (hash join, ``big``
      not shuffled) when proven to hold at most ``max_rows`` rows, else both
      sides are shuffled on the bucket (AQE splits skewed buckets).
    """
    cond = (F.col(value) >= F.col(start)) & (F.col(value) <= F.col(end))
    if has_at_most(ranges, max_loop_ranges):
        return big.join(F.broadcast(ranges), cond, how)
    stats = ranges.agg(F.avg(F.col(end) - F.col(start) + 1).alias("w")).first()
    width = max(int(stats["w"] or 1), 1)
    rb = ranges.withColumn(
        "_bucket", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))))
    if has_at_most(rb, max_rows):
        rb = F.broadcast(rb)
    vb = big.withColumn("_bucket", F.floor(F.col(value) / width))
    joined = vb.join(rb, (vb["_bucket"] == rb["_bucket"]) & cond, how)
    return joined.drop("_bucket")
