"""Match tags: a user's field value equals a level-5 rule -> that tag.

The rules are a small DataFrame joined with a checked broadcast; there is no
driver-side map and no UDF, so the lookup is a BroadcastHashJoin inside
whole-stage codegen and the user table is never shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagsmith.operators.joins import join_small

ON_MISS = ("drop", "null", "error")


def distinct_rules(rules: DataFrame) -> DataFrame:
    """One name per rule value: duplicate rules keep the lowest tag id."""
    cols = rules.columns
    if "id" in cols:
        return rules.groupBy("rule").agg(F.min_by("name", "id").alias("name"))
    return rules.groupBy("rule").agg(F.min("name").alias("name"))


def match_tag(df: DataFrame, id_col: str, field: str, rules: DataFrame, tag_col: str,
              on_miss: str = "drop", user_col: str = "userId") -> DataFrame:
    """``(user_col, tag_col)`` for each row of ``df``.

    ``on_miss`` decides a value no rule covers (and a null value):
    ``drop`` the row (inner join), keep it with a ``null`` tag (left join), or
    raise an ``error`` when the row is evaluated.
    """
    if on_miss not in ON_MISS:
        raise ValueError(f"on_miss must be one of {ON_MISS}")
    r = distinct_rules(rules).select(F.col("rule").alias("_rule"), F.col("name").alias(tag_col))
    base = df.select(F.col(id_col).alias(user_col), F.col(field).cast("string").alias("_value"))
    how = "inner" if on_miss == "drop" else "left"
    # de-duplicated rules never outnumber the rule rows: count those
    out = join_small(base, r, base["_value"] == r["_rule"], how, bound_from=rules)
    tag = F.col(tag_col)
    if on_miss == "error":
        tag = F.when(tag.isNull(), F.raise_error(
            F.concat(F.lit("no rule matches value "), F.coalesce(F.col("_value"), F.lit("NULL"))))
        ).otherwise(tag).alias(tag_col)
    return out.select(user_col, tag.alias(tag_col))


def unmatched_values(df: DataFrame, field: str, rules: DataFrame) -> DataFrame:
    """``(value, rows)``: field values no rule covers, with their row counts
    (nulls included as a null value)."""
    r = distinct_rules(rules).select(F.col("rule").alias("_rule"))
    base = df.select(F.col(field).cast("string").alias("value"))
    missing = join_small(base, r, base["value"] == r["_rule"], "left_anti", bound_from=rules)
    return missing.groupBy("value").agg(F.count(F.lit(1)).alias("rows"))


def match_tags(df: DataFrame, id_col: str, specs, user_col: str = "userId", bands=()) -> DataFrame:
    """Several match (and band) tags over the same table in one pass.

    ``specs`` is a list of ``(field, rules, tag_col)``; each is a left join
    against its (checked, broadcast) rules.  ``bands`` is a list of
    ``(value, rules, tag_col)`` with ``value`` a column name or expression
    (e.g. a birthday as ``yyyyMMdd``) matched against ``lo-hi`` rules by a left
    range join.  The table is scanned once and never shuffled; a value no
    rule covers leaves that tag null, and rows with no tag at all are left
    out — the same cells each tag's own operator gives."""
    import functools
    import operator

    from tagsmith.operators.bands import range_rules
    from tagsmith.operators.joins import range_join

    specs, bands = list(specs), list(bands)
    if not specs and not bands:
        raise ValueError("no tags given")
    out = df.select(F.col(id_col).alias(user_col),
                    *[F.col(field).cast("string").alias(f"_v{i}") for i, (field, _, _) in enumerate(specs)],
                    *[(F.col(v) if isinstance(v, str) else v).alias(f"_b{j}") for j, (v, _, _) in enumerate(bands)])
    for i, (_, rules, tag_col) in enumerate(specs):
        r = distinct_rules(rules).select(F.col("rule").alias(f"_r{i}"), F.col("name").alias(tag_col))
        out = join_small(out, r, out[f"_v{i}"] == r[f"_r{i}"], "left", bound_from=rules).drop(f"_r{i}")
    for j, (_, rules, tag_col) in enumerate(bands):
        rr = range_rules(rules).select(F.col("name").alias(tag_col), F.col("start").alias(f"_s{j}"),
                                       F.col("end").alias(f"_e{j}"))
        out = range_join(out, f"_b{j}", rr, f"_s{j}", f"_e{j}", how="left")
    tag_cols = [t for _, _, t in specs] + [t for _, _, t in bands]
    any_tag = functools.reduce(operator.or_, [F.col(t).isNotNull() for t in tag_cols])
    return out.where(any_tag).select(user_col, *tag_cols)
