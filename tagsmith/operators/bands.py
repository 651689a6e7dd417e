"""Band tags: a value falls inside an inclusive ``lo-hi`` rule range."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagsmith.functions.dates import before_as_of, compact_date, compact_text_date, days_since
from tagsmith.functions.rules import is_range_rule, range_end, range_start
from tagsmith.operators.joins import range_join


def range_rules(rules: DataFrame) -> DataFrame:
    """Level-5 ``lo-hi`` rules -> ``(name, start, end)``.  Anything that is
    not a range (``-1``, ``abc``) can never match and is left out."""
    return (rules.where(is_range_rule("rule"))
            .select("name", range_start("rule").alias("start"), range_end("rule").alias("end")))


def band_tag(df: DataFrame, id_col: str, value_col: str, rules: DataFrame, tag_col: str,
             user_col: str = "userId") -> DataFrame:
    """``(user_col, tag_col)`` for rows whose value lies in a rule range;
    rows in no range get no tag (the reference's inner theta join)."""
    base = df.select(F.col(id_col).alias(user_col), F.col(value_col).alias("_v"))
    joined = range_join(base, "_v", range_rules(rules))
    return joined.select(user_col, F.col("name").alias(tag_col))


def age_band_tag(users: DataFrame, id_col: str, birthday_col: str, rules: DataFrame,
                 tag_col: str = "agerange", user_col: str = "userId") -> DataFrame:
    """Birthday (date, timestamp or ``yyyy-MM-dd`` text) -> ``yyyyMMdd`` int,
    then a band such as ``19800101-19891231``."""
    dtype = users.schema[birthday_col].dataType.typeName()
    born = compact_text_date(birthday_col) if dtype == "string" else compact_date(birthday_col)
    return band_tag(users.select(id_col, born.alias("_born")), id_col, "_born", rules, tag_col, user_col)


def last_activity(df: DataFrame, id_col: str, ts_col: str, as_of, user_col: str = "userId",
                  days_col: str = "days") -> DataFrame:
    """``(user_col, days)``: calendar days from the latest ``ts`` before
    ``as_of`` to ``as_of``.  Rows at or after ``as_of`` are ignored."""
    src = before_as_of(df, ts_col, as_of)
    last = src.groupBy(F.col(id_col).alias(user_col)).agg(F.max(ts_col).alias("_last"))
    return last.select(user_col, days_since("_last", as_of).alias(days_col))


def consume_cycle_tag(orders: DataFrame, id_col: str, ts_col: str, rules: DataFrame, as_of,
                      tag_col: str = "consumercycle", user_col: str = "userId") -> DataFrame:
    """Days since the last order, banded (``0-7``, ``8-14`` ... ``151-180``);
    a user beyond the last band gets no tag."""
    days = last_activity(orders, id_col, ts_col, as_of, user_col, "_days")
    return band_tag(days, user_col, "_days", rules, tag_col, user_col)


def order_span(orders: DataFrame, id_col: str, ts_col: str, as_of, user_col: str = "userId") -> DataFrame:
    """``(userId, first, days)`` in one pass over the orders: the first order
    ever (``first``) and the days from the last order before the clock to the
    clock (``days``; null when every order is at or after it).  Feeds both
    the age-band stand-in and the consumption cycle without a second scan."""
    from tagsmith.functions.dates import is_before_clock, with_event_time
    o = with_event_time(orders, ts_col)
    before = is_before_clock(o, ts_col, as_of)
    span = o.groupBy(F.col(id_col).alias(user_col)).agg(
        F.min(ts_col).alias("first"), F.max(F.when(before, F.col(ts_col))).alias("_last"))
    return span.select(user_col, "first", days_since("_last", as_of).alias("days"))


def cycle_and_age_tags(orders: DataFrame, id_col: str, ts_col: str, cycle_rules: DataFrame,
                       age_rules: DataFrame, as_of, user_col: str = "userId",
                       cycle_col: str = "consumercycle", age_col: str = "agerange") -> DataFrame:
    """``(userId, consumercycle, agerange)`` from one ``order_span`` pass:
    both band lookups are left joins on the same per-user row, so the orders
    are read and shuffled once.  Users with neither tag are left out."""
    span = order_span(orders, id_col, ts_col, as_of, user_col).withColumn("_born", compact_date("first"))
    cyc = range_rules(cycle_rules).select(F.col("name").alias(cycle_col), F.col("start").alias("_cs"),
                                          F.col("end").alias("_ce"))
    age = range_rules(age_rules).select(F.col("name").alias(age_col), F.col("start").alias("_as"),
                                        F.col("end").alias("_ae"))
    out = range_join(span, "days", cyc, "_cs", "_ce", how="left")
    out = range_join(out, "_born", age, "_as", "_ae", how="left")
    return (out.where(F.col(cycle_col).isNotNull() | F.col(age_col).isNotNull())
            .select(user_col, cycle_col, age_col))
