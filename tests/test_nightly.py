"""The full profile on tables in the reference's own format: every column a
string, order finish time as epoch seconds, log time as text."""

import datetime as dt
import random

from tagsmith.plans.catalog import ALL_TAGS
from tagsmith.plans.nightly import nightly_profile
from tagsmith.sources.literal import local_frame

# the reference's payment rules (the shared fixture maps them to test-table codes)
PAYMENT_RULES = [(357, "alipay", "alipay", 5, 356), (358, "wxpay", "wxpay", 5, 356),
                 (359, "chinapay", "chinapay", 5, 356), (360, "cod", "cod", 5, 356)]


def test_nightly_profile_on_reference_format(spark):
    rnd = random.Random(5)
    rows = [r for r in ALL_TAGS if r[4] != 356] + PAYMENT_RULES
    tags = local_frame(spark, rows, "id long, name string, rule string, level int, pid long")
    users = spark.createDataFrame(
        [(str(i), str(1 + i % 2), str(1 + i % 6), str(1 + i % 3), str(1 + i % 5),
          f"{1950 + i % 60}-0{1 + i % 9}-1{i % 10}") for i in range(40)],
        "id string, gender string, job string, politicalface string, nationality string, birthday string")
    now = dt.datetime(2024, 6, 1, tzinfo=dt.timezone.utc)
    orders = spark.createDataFrame(
        [(str(i % 40), f"sn{i}", f"{rnd.randint(100, 90000)}.{rnd.randint(10, 99)}",
          str(int((now - dt.timedelta(days=rnd.randint(1, 200), hours=rnd.randint(0, 23))).timestamp())),
          rnd.choice(["alipay", "wxpay", "chinapay", "cod"])) for i in range(400)],
        "memberid string, ordersn string, orderamount string, finishtime string, paymentcode string")
    logs = spark.createDataFrame(
        [(str(i % 40), f"/p/{rnd.randint(1, 30)}",
          (dt.datetime(2024, 6, 1) - dt.timedelta(days=rnd.randint(0, 90), minutes=rnd.randint(1, 900)))
          .strftime("%Y-%m-%d %H:%M:%S")) for i in range(900)],
        "global_user_id string, loc_url string, log_time string")
    goods = spark.createDataFrame(
        [(f"sn{rnd.randint(0, 399)}", rnd.choice(["pink", "white", "black", "blue"]),
          rnd.choice(["blender", "drill", "steamer", "tv"])) for _ in range(800)],
        "cordersn string, ogcolor string, producttype string")
    colors = local_frame(spark, [(1, "pink"), (2, "white"), (3, "black"), (4, "blue")], "id int, name string")
    products = local_frame(spark, [(1, "blender"), (2, "drill"), (3, "steamer"), (4, "tv")], "id int, name string")

    profile = nightly_profile(tags, users, orders, logs, goods, colors, products, "2024-06-01",
                              female_colors=["pink", "white"], female_products=["blender", "steamer"])
    from plan_util import plan_text
    plan = plan_text(profile)
    for bad in ("CartesianProduct", "PythonUDF", "ArrowEvalPython", "BatchEvalPython"):
        assert bad not in plan
    rows = profile.collect()
    assert len(rows) == 40 and len({r.userId for r in rows}) == 40
    assert set(profile.columns) == {"userId", "gender", "job", "political", "nationality", "agerange",
                                    "consumercycle", "payment", "rfm", "rfe", "lifecycle", "usg"}
    by = {r.userId: r for r in rows}
    assert by["0"].gender == "male" and by["1"].gender == "female"          # codes: 1 = male, 2 = female
    assert {r.payment for r in rows} <= {"alipay", "wxpay", "chinapay", "cod"}
    names = {n for (_i, n, _r, lvl, p) in ALL_TAGS if lvl == 5 and p in (361, 367, 380)}
    assert {r.rfm for r in rows} | {r.rfe for r in rows} | {r.usg for r in rows} <= names
    assert all(r.rfm for r in rows) and all(r.usg for r in rows)
    assert {r.lifecycle for r in rows} <= {"loyal", "new", "returning", "active", "inactive", "lost"}
    # the cycle from the shared RFM pass equals the stand-alone operator
    from tagsmith.operators.bands import consume_cycle_tag
    from tagsmith.plans.catalog import attribute_rules
    alone = {r.userId: r.consumercycle for r in
             consume_cycle_tag(orders, "memberid", "finishtime", attribute_rules(tags, 347), "2024-06-01").collect()}
    assert {u: by[u].consumercycle for u in by if by[u].consumercycle} == alone

    # a run at an earlier clock: every tag sees the orders before it only
    import pytest
    early = {r.userId: r for r in nightly_profile(tags, users, orders, None, None, None, None, "2024-03-01", lookback_days=60).collect()}
    lo, hi = (int(dt.datetime(2024, m, d, tzinfo=dt.timezone.utc).timestamp()) for m, d in ((1, 1), (3, 1)))
    paid = {r.memberid for r in orders.collect() if lo <= int(r.finishtime) < hi}
    assert {u for u, r in early.items() if r.payment} == paid == {u for u, r in early.items() if r.rfm}
    with pytest.raises(ValueError, match="job"):
        nightly_profile(tags, users.drop("job"), orders, None, None, None, None, "2024-06-01")


def test_full_profile_holds_the_untrained_one(spark):
    from tagsmith.plans.queries import QUERIES
    full, part = (QUERIES[n](spark, "/root/testdata/sf0.001") for n in ("profile_full", "profile_full_untrained"))
    full = full.select(part.columns)
    assert full.exceptAll(part).isEmpty() and part.exceptAll(full).isEmpty()
