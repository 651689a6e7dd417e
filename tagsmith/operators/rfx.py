"""RFM (orders) and RFE (visit logs) metrics, scores and derived tags."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagsmith.functions.dates import as_date, before_as_of, clock, days_since
from tagsmith.functions.scores import RFE_BANDS, RFM_BANDS, Bands
from tagsmith.operators.joins import join_small
from tagsmith.operators.lineage import cut_lineage


AMOUNT = "decimal(20,2)"  # of one order; sums have decimal(30,2)


def amount(df: DataFrame, col: str):
    """The amount as a decimal; null for text that is no number and for
    values beyond the decimal's range."""
    from pyspark.sql import types as T
    c = F.col(col)
    if isinstance(df.schema[col].dataType, T.StringType):
        c = F.trim(c)
    return c.try_cast(AMOUNT)


def malformed_amounts(orders: DataFrame, amount_col: str) -> DataFrame:
    """One row: orders whose amount is present but malformed (left out of
    every sum), and orders without an amount."""
    return orders.agg(F.count_if(F.col(amount_col).isNotNull() & amount(orders, amount_col).isNull()).alias("malformed"),
                      F.count_if(F.col(amount_col).isNull()).alias("missing"))


def rfm_metrics(orders: DataFrame, id_col: str, order_col: str, amount_col: str, ts_col: str,
                as_of, lookback_days: int | None = None, user_col: str = "userId") -> DataFrame:
    """``(userId, recency, frequency, monetary)``.

    recency = days from the last order to ``as_of``; frequency = orders;
    monetary = sum of the well-formed amounts as ``decimal(30,2)`` (null if
    there is none; see ``malformed_amounts``).  One partially aggregated
    shuffle on the user key.  ``lookback_days`` optionally limits the orders
    to the last n days before ``as_of``.
    """
    src = before_as_of(orders, ts_col, as_of)
    if lookback_days is not None:
        lo = as_date(as_of).toordinal() - int(lookback_days)
        src = src.where(F.to_date(ts_col) >= F.lit(as_date(as_of).fromordinal(lo)))
    agg = src.groupBy(F.col(id_col).alias(user_col)).agg(
        F.max(ts_col).alias("_last"),
        F.count(order_col).alias("frequency"),
        F.sum(amount(src, amount_col)).alias("monetary"),
    )
    return agg.select(user_col, days_since("_last", as_of).alias("recency"), "frequency", "monetary")


def rfe_metrics(logs: DataFrame, id_col: str, url_col: str, ts_col: str, as_of,
                user_col: str = "userId") -> DataFrame:
    """``(userId, recency, frequency, engagements)``: days since the last
    visit, visits (page views) and distinct pages.  The count distinct is
    planned as a two-level aggregate — by (user, page), then by user — so a
    user with many visits is spread over its pages before the user shuffle."""
    src = before_as_of(logs, ts_col, as_of)
    agg = src.groupBy(F.col(id_col).alias(user_col)).agg(
        F.max(ts_col).alias("_last"),
        F.count(url_col).alias("frequency"),
        F.countDistinct(url_col).alias("engagements"),
    )
    return agg.select(user_col, days_since("_last", as_of).alias("recency"), "frequency", "engagements")


def score(metrics: DataFrame, bands: dict[str, Bands], suffix: str = "_score",
          keep: list[str] | None = None) -> DataFrame:
    """Adds ``<x>_score`` for each banded metric; score columns are named by
    the metric's first letter (``r_score``, ``f_score``, ``m_score``, ...)."""
    keep = keep if keep is not None else metrics.columns
    scored = [b.expr(m).alias(f"{m[0]}{suffix}") for m, b in bands.items()]
    return metrics.select(*keep, *scored)


def rfm_scores(metrics: DataFrame, bands: dict[str, Bands] | None = None) -> DataFrame:
    return score(metrics, bands or RFM_BANDS)


def rfe_scores(metrics: DataFrame, bands: dict[str, Bands] | None = None) -> DataFrame:
    return score(metrics, bands or RFE_BANDS)


# fixed values: the reference's RFM weighting R:F:M = 0.25:0.25:0.5
RFM_WEIGHTS = {"r_score": 0.25, "f_score": 0.25, "m_score": 0.5}


def weighted_score(scores: DataFrame, weights: dict[str, float] | None = None,
                   out: str = "value", id_col: str = "userId") -> DataFrame:
    """``(userId, value)`` with value = sum(weight * score)."""
    weights = weights or RFM_WEIGHTS
    total = None
    for c, w in weights.items():
        term = F.col(c) * F.lit(float(w))
        total = term if total is None else total + term
    return scores.select(id_col, total.alias(out))


def value_ranks(values: DataFrame, top_share: float = 0.2, value_col: str = "value", id_col: str = "userId") -> DataFrame:
    """``(userId, value, rank, is_top)``: the users ranked by value (highest
    first, equal values share a rank), and whether a user belongs to the best
    ``top_share`` of the users.  A null value has no rank.

    The rank comes from the range-partitioned histogram of the values (see
    ``ranks``): rank = 1 + users with a higher value, for scores of a few
    values and for continuous totals alike."""
    from tagsmith.operators.ranks import rank_by
    ranked = rank_by(values.select(id_col, value_col), value_col, out="rank", total_out="_total")
    best = F.col("rank") <= F.ceil(F.lit(float(top_share)) * F.col("_total"))
    return ranked.select(id_col, value_col, "rank", F.coalesce(best, F.lit(False)).alias("is_top"))


def value_per_cluster(assigned: DataFrame, value, pred_col: str = "prediction", weight_col: str | None = None) -> DataFrame:
    """Per cluster: users, mean and total value (``value`` is an expression
    or a column); ``weight_col`` for a score histogram."""
    w = F.lit(1) if weight_col is None else F.col(weight_col)
    v = F.col(value) if isinstance(value, str) else value
    got = assigned.groupBy(pred_col).agg(F.sum(w.cast("long")).alias("users"), F.sum(v * w).alias("total_value"))
    return got.select(pred_col, "users", (F.col("total_value") / F.col("users")).alias("mean_value"), "total_value")


def lifecycle_tag(logs: DataFrame, id_col: str, url_col: str, ts_col: str, as_of,
                  user_col: str = "userId", tag_col: str = "lifecycle",
                  active_days: int = 2, returning_days: int = 3, gap_days: int = 7,
                  new_days: int = 3, inactive_days: int = 7) -> DataFrame:
    """Six-class lifecycle from visits before ``as_of``.

    d = days since the last visit.  loyal: at least 2 visits in the 24 hours
    before the clock, all on different pages; new: first visit within
    ``new_days``; returning: d <= ``returning_days`` with some gap between
    consecutive visits longer than ``gap_days``; active: d <= ``active_days``;
    inactive: d <= ``inactive_days``; else lost.

    Visits are bucketed by whole days before the clock (bucket 0 = the last
    24 hours, their first instant included; for a midnight clock these are
    calendar days), reduced to one
    row per (user, bucket, page) and then per (user, bucket) before the
    ``lag`` window, so the window sees at most one row per active day of a
    user however many visits the user has.
    """
    src = before_as_of(logs, ts_col, as_of).select(
        F.col(id_col).alias(user_col), F.col(url_col).alias("_url"), F.col(ts_col).alias("_ts"))
    now = F.lit(clock(as_of).isoformat(sep=" ")).cast(src.schema["_ts"].dataType)
    # bucket 0 holds clock - 1 day <= visit < clock
    bucket = F.floor((F.timestamp_diff("MICROSECOND", F.col("_ts"), now) - 1) / 86_400_000_000)
    per_page = (src.groupBy(user_col, bucket.alias("_b"), "_url")
                .agg(F.count(F.lit(1)).alias("_n"), F.min("_ts").alias("_lo"), F.max("_ts").alias("_hi")))
    per_day = (per_page.groupBy(user_col, "_b")
               .agg(F.sum("_n").alias("_visits"), F.count(F.lit(1)).alias("_pages"),
                    F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi")))
    w = Window.partitionBy(user_col).orderBy(F.col("_b").desc())
    gap = F.col("_lo") - F.lag("_hi").over(w)
    with_gap = per_day.withColumn("_long_gap", gap > F.expr(f"INTERVAL {int(gap_days)} DAYS"))
    last = F.col("_b") == 0
    per_user = with_gap.groupBy(user_col).agg(
        F.max("_hi").alias("_last"), F.min("_lo").alias("_first"),
        F.max(F.col("_long_gap").cast("int")).alias("_gap"),
        F.sum(F.when(last, F.col("_visits")).otherwise(0)).alias("_lv"),
        F.sum(F.when(last, F.col("_pages")).otherwise(0)).alias("_lp"),
    )
    d = days_since("_last", as_of)
    first = days_since("_first", as_of)
    tag = (F.when((F.col("_lv") >= 2) & (F.col("_lv") == F.col("_lp")), "loyal")
           .when(first <= new_days, "new")
           .when((d <= returning_days) & (F.coalesce(F.col("_gap"), F.lit(0)) == 1), "returning")
           .when(d <= active_days, "active")
           .when(d <= inactive_days, "inactive")
           .otherwise("lost"))
    return per_user.select(user_col, tag.alias(tag_col))


def order_facts(orders: DataFrame, id_col: str, order_col: str, amount_col: str, ts_col: str, as_of,
                user_col: str = "userId") -> DataFrame:
    """``(userId, first, recency, frequency, monetary)`` in one pass over
    the orders: the first order ever, and the RFM metrics over the orders
    before the clock (``recency`` null, ``frequency`` 0 for a user whose
    orders are all at or after it).  One aggregation then feeds the RFM
    segments, the consumption cycle (its day count is the recency) and a
    first-order age band."""
    from tagsmith.functions.dates import is_before_clock, with_event_time
    o = with_event_time(orders, ts_col)
    before = is_before_clock(o, ts_col, as_of)
    agg = o.groupBy(F.col(id_col).alias(user_col)).agg(
        F.min(ts_col).alias("first"),
        F.max(F.when(before, F.col(ts_col))).alias("_last"),
        F.count(F.when(before, F.col(order_col))).alias("frequency"),
        F.sum(F.when(before, amount(o, amount_col))).alias("monetary"),
    )
    return agg.select(user_col, "first", days_since("_last", as_of).alias("recency"), "frequency", "monetary")
