"""The wide user profile: one row per user, one column per tag."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile_wide(results: list[DataFrame], key: str = "userId") -> DataFrame:
    """Merge per-tag results ``(key, tag)`` (at most one row per key each)
    into one row per key.  All results are stacked and grouped once, so N
    tags cost one shuffle, not N joins.

    Rows of different results never share a map partition, so a map-side
    partial aggregate cannot shrink anything; hash-partitioning by key first
    lets a single sort feed both aggregate phases (string maxima are sort
    aggregates).  A key has at most N rows, so no partition can be skewed."""
    if not results:
        raise ValueError("no tag results to merge")
    stacked = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), results)
    tag_cols = [c for c in stacked.columns if c != key]
    return stacked.repartition(key).groupBy(key).agg(*[F.max(c).alias(c) for c in tag_cols])


def profile_upsert(old: DataFrame, new: DataFrame, key: str = "userId") -> DataFrame:
    """Cell-level upsert: a non-null new value replaces the old one; every
    other column and every user not in ``new`` is kept; new users are added.
    Keys are unique on both sides, so the full outer join cannot fan out."""
    o, n = old.alias("o"), new.alias("n")
    cols = list(dict.fromkeys([c for c in old.columns if c != key] + [c for c in new.columns if c != key]))
    joined = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    out = [F.coalesce(F.col(f"n.{key}"), F.col(f"o.{key}")).alias(key)]
    for c in cols:
        if c in new.columns and c in old.columns:
            out.append(F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c))
        elif c in new.columns:
            out.append(F.col(f"n.{c}").alias(c))
        else:
            out.append(F.col(f"o.{c}").alias(c))
    return joined.select(*out)
