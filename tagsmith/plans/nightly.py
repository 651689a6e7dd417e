"""The full profile from business tables in the reference's field names.

``nightly_profile`` runs every standard tag of the catalogue on the users,
orders, visit-log and order-line tables and merges them into one row per
user.  Column names default to the reference's stores (all-string columns,
order finish time as epoch seconds), so its tables can be used unchanged.
It only composes the operators; scheduling stays outside.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagsmith.functions.dates import before_as_of, compact_date, compact_text_date
from tagsmith.operators import bands as B
from tagsmith.operators import rfx as X
from tagsmith.operators import segment as S
from tagsmith.operators import shopper as U
from tagsmith.operators import stats as ST
from tagsmith.operators.lineage import cut_lineage
from tagsmith.operators.match import match_tags
from tagsmith.operators.profile import profile_wide
from tagsmith.plans.catalog import attribute_rules


@dataclass(frozen=True)
class Fields:
    """Column names of the business tables (defaults: the reference's)."""
    user_id: str = "id"
    match_fields: dict = field(default_factory=lambda: {
        318: ("gender", "gender"), 321: ("job", "job"), 328: ("politicalface", "political"),
        332: ("nationality", "nationality")})
    birthday: str | None = "birthday"
    member_id: str = "memberid"
    order_sn: str = "ordersn"
    amount: str = "orderamount"
    finish_time: str = "finishtime"
    payment: str = "paymentcode"
    log_user: str = "global_user_id"
    log_url: str = "loc_url"
    log_time: str = "log_time"
    line_order: str = "cordersn"
    color: str = "ogcolor"
    product: str = "producttype"


def nightly_profile(tags: DataFrame, users: DataFrame, orders: DataFrame, logs: DataFrame | None, goods: DataFrame | None,
                    colors: DataFrame | None, products: DataFrame | None, as_of, female_colors=(), female_products=(),
                    fields: Fields = Fields(), rfm_bands=None, rfe_bands=None, lookback_days: int | None = None) -> DataFrame:
    """One row per user with every standard tag: the match tags, age band,
    consumption cycle, payment, customer value (RFM), activity (RFE),
    lifecycle and shopping gender.  Inputs that are ``None`` skip their
    tags, and so do a ``birthday`` of ``None`` and match fields left out of
    ``fields``; a named column that is missing raises.

    Every tag sees the orders before ``as_of`` only.  ``lookback_days`` limits
    the orders behind value, payment and shopping gender to those days."""
    f = fields
    rules = lambda tag_id: attribute_rules(tags, tag_id)
    results = []
    missing = [c for c in [*(col for col, _ in f.match_fields.values()), f.birthday] if c and c not in users.columns]
    if missing:
        raise ValueError(f"the users table lacks {missing}; leave them out of fields to skip their tags")
    present = [(col, rules(tid), tag) for tid, (col, tag) in f.match_fields.items()]
    bands = []
    if f.birthday:
        dtype = users.schema[f.birthday].dataType.typeName()
        born = compact_text_date(f.birthday) if dtype == "string" else compact_date(f.birthday)
        bands.append((born, rules(338), "agerange"))
    if present or bands:  # every users-table tag from one scan
        results.append(match_tags(users, f.user_id, present, bands=bands))
    past = before_as_of(orders, f.finish_time, as_of)
    recent = past if lookback_days is None else U.recent_orders(orders, f.finish_time, as_of, lookback_days)
    # without a look-back one aggregation of the orders per user feeds both the
    # RFM segments and the consumption cycle (its recency is the cycle's day count)
    metrics = cut_lineage(X.rfm_metrics(orders, f.member_id, f.order_sn, f.amount, f.finish_time, as_of))
    results.append(B.band_tag(metrics, "userId", "recency", rules(347), "consumercycle"))
    results.append(ST.pay_type_tag(recent, f.member_id, f.payment, rules(356)))
    if lookback_days is not None:
        metrics = X.rfm_metrics(orders, f.member_id, f.order_sn, f.amount, f.finish_time, as_of, lookback_days)
    rfm = X.rfm_scores(metrics, rfm_bands)
    results.append(S.segment_by_kmeans(rfm, ["r_score", "f_score", "m_score"], rules(361), "rfm"))
    if logs is not None:
        rfe = X.rfe_scores(X.rfe_metrics(logs, f.log_user, f.log_url, f.log_time, as_of), rfe_bands)
        results.append(S.segment_by_kmeans(rfe, ["r_score", "f_score", "e_score"], rules(367), "rfe"))
        results.append(X.lifecycle_tag(logs, f.log_user, f.log_url, f.log_time, as_of))
    if goods is not None and colors is not None and products is not None:
        lines = U.seed_labels(U.encode_dims(goods, colors, products, f.color, f.product),
                              female_colors, female_products, f.color, f.product)
        results.append(U.usg_tag(lines, recent, rules(380), f.line_order, f.order_sn, f.member_id,
                                 [f.line_order, f.color, f.product]))
    return profile_wide([r.withColumn("userId", F.col("userId").cast("string")) for r in results])
