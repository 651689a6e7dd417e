"""The run-a-tag template: catalogue -> rule -> business scan -> tagger.

    result = run_tag(spark, tags, 356, base_dir, as_of,
                     lambda biz, rules: pay_type_tag(biz, "o_custkey", "o_orderpriority", rules))

Failures propagate (nothing is swallowed); the caller decides whether to
upsert the result into the profile.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tagsmith.plans.catalog import attribute_rules, business_rule
from tagsmith.sources.business import business_scan, scan_options

Tagger = Callable[[DataFrame, DataFrame], DataFrame]


def run_tag(spark: SparkSession, tags: DataFrame, tag_id: int, base_dir: str, tagger: Tagger,
            as_of=None) -> DataFrame:
    options = scan_options(business_rule(tags, tag_id))
    business = business_scan(spark, options, base_dir, as_of)
    rules = attribute_rules(tags, tag_id)
    return tagger(business, rules)


def run_and_save(spark: SparkSession, tags: DataFrame, tag_id: int, base_dir: str, tagger: Tagger,
                 profile_base: str, version: str, previous: str | None = None, as_of=None,
                 key: str = "userId", buckets: int | None = None) -> str:
    """The whole template: run one tag, upsert it into the previous profile
    version (if any) and write the result as a new version folder.  Returns
    the new version's path; the previous version is never modified."""
    from tagsmith.operators.profile import profile_upsert
    from tagsmith.sources.store import read_profile, write_profile

    result = run_tag(spark, tags, tag_id, base_dir, tagger, as_of)
    merged = profile_upsert(read_profile(spark, profile_base, previous), result, key) if previous else result
    return write_profile(merged, profile_base, version, key, buckets)


def upsert_profile_table(new: DataFrame, old_table: str, new_table: str, path: str,
                         key: str = "userId", buckets: int = 64) -> str:
    """Cell-level upsert of ``new`` into the bucketed ``old_table``, saved as
    the bucketed ``new_table`` (the next run's old profile)."""
    from tagsmith.operators.profile import profile_upsert
    from tagsmith.sources.store import write_profile_table
    merged = profile_upsert(new.sparkSession.table(old_table), new, key)
    return write_profile_table(merged, new_table, path, key, buckets)
