"""Hot keys: a user (or order) may hold a third of all rows.  In every
aggregating tag query each shuffle must move pre-aggregated rows — a partial
aggregate or a per-group limit sits directly under every Exchange — so a hot
key reaches the reducer as a handful of rows, never as its raw rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from plan_util import exchange_children, plan_text

AGGREGATING = ["pay_type", "consume_cycle", "age_band", "rfm_metrics", "rfe_metrics", "rfe_lifecycle",
               "value_counts", "top_n_per_group", "usg_vote", "unmatched_values",
               "classification_metrics", "wssse", "cluster_profile"]
PRE_AGG = {"HashAggregate", "SortAggregate", "WindowGroupLimit", "ObjectHashAggregate"}


@pytest.mark.parametrize("name", AGGREGATING)
def test_shuffles_carry_partial_aggregates(spark, name):
    plan = plan_text(E.queries()[name](spark, SF_SMALL))
    kids = exchange_children(plan)
    assert kids, f"{name}: expected at least one shuffle"
    raw = [k for k in kids if k not in PRE_AGG and k != "Sort"]
    # a Sort under an Exchange only appears below a partial sort-aggregate
    assert not raw, f"{name}: raw rows shuffled under {raw}"


def test_profile_merge_shuffles_per_user_results_once(spark):
    """The merge's own shuffle moves the stacked tag results, each already
    one row per user (so a user has at most one row per tag); every shuffle
    below it is a pre-aggregated one."""
    plan = plan_text(E.queries()["profile_wide"](spark, SF_SMALL))
    kids = exchange_children(plan)
    assert kids.count("Union") == 1
    assert all(k in PRE_AGG or k in ("Sort", "Union") for k in kids), kids
    tree = plan.split("\n\n(1)")[0]
    assert tree.count("Sort (") >= 1 and "REPARTITION_BY_COL" in plan


def test_hot_user_gets_same_answer(spark, tags):
    """One user with a third of the orders: favourite value, RFM and votes
    still agree with a brute-force computation."""
    from tagsmith.operators.rfx import rfm_metrics
    from tagsmith.operators.stats import favourite_value
    rows = []
    for i in range(3000):
        user = 0 if i % 3 == 0 else i % 97 + 1
        pay = ["a", "b", "c"][(i * 7) % 3] if user else ("a" if i % 2 else "b")
        rows.append((user, f"o{i}", float(i % 50), dt.datetime(2020, 1, 1) + dt.timedelta(days=i % 300), pay))
    df = spark.createDataFrame(rows, "u long, sn string, amt double, t timestamp_ntz, pay string")
    fav = {r.userId: (r.pay, r.cnt) for r in favourite_value(df, "u", "pay").collect()}
    from collections import Counter
    for user in (0, 1, 50):
        c = Counter(p for (u, _, _, _, p) in rows if u == user)
        best = sorted(c.items(), key=lambda kv: (-kv[1], kv[0]))[0]
        assert fav[user] == best
    m = {r.userId: r.frequency for r in rfm_metrics(df, "u", "sn", "amt", "t", "2021-01-01").collect()}
    assert m[0] == 1000 and sum(m.values()) == 3000
