import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tagsmith.functions.scores import RFE_BANDS, RFM_BANDS, Bands
from tagsmith.operators.rfx import (
    lifecycle_tag, rfe_metrics, rfm_metrics, rfm_scores, weighted_score,
)
from tagsmith.operators.segment import (
    assemble, center_ranks, fit_kmeans, nearest_center, score_histogram, segment_by_kmeans, wssse,
)
from tagsmith.plans.catalog import attribute_rules

AS_OF = dt.date(2020, 1, 31)


def test_rfm_metrics_hand_rows(spark):
    rows = [(1, "a", 10.005, dt.datetime(2020, 1, 30, 8)), (1, "b", 20.0, dt.datetime(2020, 1, 20)),
            (2, "c", 5.5, dt.datetime(2019, 12, 31)), (2, "d", 1.0, dt.datetime(2020, 2, 5))]
    o = spark.createDataFrame(rows, "m long, sn string, amt double, t timestamp_ntz")
    got = {r.userId: (r.recency, r.frequency, r.monetary) for r in rfm_metrics(o, "m", "sn", "amt", "t", AS_OF).collect()}
    assert got == {1: (1, 2, Decimal("30.01")), 2: (31, 1, Decimal("5.50"))}
    look = rfm_metrics(o, "m", "sn", "amt", "t", AS_OF, lookback_days=5).collect()
    assert [(r.userId, r.frequency) for r in look] == [(1, 1)]


def test_default_rfm_bands_close_the_gaps(spark):
    df = spark.createDataFrame([(0, 49, Decimal("49999.50")), (16, 200, Decimal("150000.00")),
                                (3, 50, Decimal("200000.00"))],
                               "recency int, frequency long, monetary decimal(20,2)")
    got = [(r.r_score, r.f_score, r.m_score) for r in rfm_scores(df.withColumn("userId", F.lit(1))).collect()]
    assert got == [(5.0, 1.0, 2.0), (1.0, 5.0, 4.0), (5.0, 2.0, 5.0)]


def test_bands_sql_matches_expr():
    b = Bands((1, 2), (3, 2, 1), strict=True)
    assert "WHEN x < 1 THEN CAST(3.0 AS DOUBLE)" in b.sql("x")
    with pytest.raises(ValueError):
        Bands((2, 1), (1, 2, 3))
    with pytest.raises(ValueError):
        Bands((1,), (1,))
    assert set(RFE_BANDS) == {"recency", "frequency", "engagements"} and set(RFM_BANDS) == {"recency", "frequency", "monetary"}


def test_weighted_score(spark):
    df = spark.createDataFrame([(1, 1.0, 4.0, 4.0), (2, 4.0, 1.0, 4.0)], "userId long, r_score double, f_score double, m_score double")
    assert {r.userId: r.value for r in weighted_score(df).collect()} == {1: 3.25, 2: 3.25}


def test_rfe_metrics_count_distinct(spark):
    rows = [(1, "/a", dt.datetime(2020, 1, 29)), (1, "/a", dt.datetime(2020, 1, 30)),
            (1, "/b", dt.datetime(2020, 1, 30)), (1, "/z", dt.datetime(2020, 2, 1))]
    df = spark.createDataFrame(rows, "u long, url string, t timestamp_ntz")
    r = rfe_metrics(df, "u", "url", "t", AS_OF).first()
    assert (r.recency, r.frequency, r.engagements) == (1, 3, 2)


def test_lifecycle_all_classes(spark):
    d = lambda day, h=12: dt.datetime(2020, 1, day, h)
    rows = [
        # loyal: two visits on the last day (Jan 30), different pages
        (1, "/a", d(1)), (1, "/a", d(30, 9)), (1, "/b", d(30, 10)),
        # not loyal (same page twice on the last day), no long gap -> active
        (2, "/a", d(27)), (2, "/a", d(30, 9)), (2, "/a", d(30, 10)),
        # new: first visit within 3 days
        (3, "/a", d(28)),
        # returning: last visit 3 days ago, earlier 10-day gap
        (4, "/a", d(2)), (4, "/a", d(18)), (4, "/b", d(28)),
        # inactive: last visit 3 days ago, no long gap
        (5, "/a", d(22)), (5, "/a", d(26)), (5, "/a", d(28)),
        # lost: last visit 10 days ago
        (6, "/a", d(5)), (6, "/a", d(21)),
        # rows at / after as_of are ignored
        (6, "/a", dt.datetime(2020, 1, 31, 1)),
    ]
    logs = spark.createDataFrame(rows, "u long, url string, t timestamp_ntz")
    got = {r.userId: r.lifecycle for r in lifecycle_tag(logs, "u", "url", "t", AS_OF).collect()}
    assert got == {1: "loyal", 2: "active", 3: "new", 4: "returning", 5: "inactive", 6: "lost"}


def test_center_ranks_ties_keep_lower_index():
    assert center_ranks([(1, 1), (3, 3), (2, 2), (3, 3)]) == [(1, 0), (3, 1), (2, 2), (0, 3)]


def test_nearest_center_ties_and_wssse(spark):
    df = spark.createDataFrame([(1, 2.0, 2.0), (2, 0.0, 0.0), (3, 4.0, 4.0)], "u long, a double, b double")
    centers = [(1, 1), (3, 3)]
    got = {r.u: r.prediction for r in nearest_center(df, ["a", "b"], centers).collect()}
    assert got == {1: 0, 2: 0, 3: 1}
    w = wssse(df, ["a", "b"], centers).first()
    assert (w.wssse, w.points) == (2.0 + 2.0 + 2.0, 3)


@pytest.fixture(scope="module")
def scores(spark):
    import random
    rnd = random.Random(7)
    rows = [(i, float(rnd.randint(1, 5)), float(rnd.randint(1, 5)), float(rnd.randint(1, 5))) for i in range(3000)]
    return spark.createDataFrame(rows, "userId long, r_score double, f_score double, m_score double")


def test_weighted_histogram_cost_equals_per_user_cost(spark, scores):
    cols = ["r_score", "f_score", "m_score"]
    hist = score_histogram(scores, cols)
    assert hist.count() <= 125 and hist.agg(F.sum("n")).first()[0] == 3000
    model, trials = fit_kmeans(assemble(hist, cols).cache(), 5)
    assert [t[1] for t in trials] == [5, 10, 20]
    assert model.summary.trainingCost == pytest.approx(min(t[0] for t in trials))
    centers = [tuple(map(float, c)) for c in model.clusterCenters()]
    per_user = wssse(scores, cols, centers).first().wssse
    assert per_user == pytest.approx(model.summary.trainingCost, rel=1e-9)


def test_segment_invariants(spark, tags, scores):
    cols = ["r_score", "f_score", "m_score"]
    rules = attribute_rules(tags, 361)
    seg = segment_by_kmeans(scores, cols, rules, "rfm")
    got = seg.collect()
    assert len(got) == 3000 and len({r.userId for r in got}) == 3000
    names = {r.name for r in rules.collect()}
    assert {r.rfm for r in got} <= names and len({r.rfm for r in got}) == 5
    plan = seg._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_segment_needs_rules(spark, scores):
    rules = spark.createDataFrame([(1, "only", "0")], "id long, name string, rule string")
    with pytest.raises(ValueError):
        segment_by_kmeans(scores, ["r_score", "f_score", "m_score"], rules, "x")


def test_rfm_and_cycle_on_epoch_text(spark, tags):
    """The reference's order store keeps finish time as epoch seconds in text."""
    from tagsmith.operators.bands import consume_cycle_tag
    e = lambda y, m, d: str(int(dt.datetime(y, m, d, 12, tzinfo=dt.timezone.utc).timestamp()))
    rows = [("1", "a", "2479.45", e(2020, 1, 28)), ("1", "b", "20.55", e(2020, 1, 2)),
            ("2", "c", "5.5", e(2019, 9, 1)), ("2", "d", "1.0", "not a time")]
    o = spark.createDataFrame(rows, "memberid string, ordersn string, orderamount string, finishtime string")
    got = {r.userId: (r.recency, r.frequency, r.monetary) for r in
           rfm_metrics(o, "memberid", "ordersn", "orderamount", "finishtime", AS_OF).collect()}
    assert got == {"1": (3, 2, Decimal("2500.00")), "2": (152, 1, Decimal("5.50"))}
    cyc = {r.userId: r.consumercycle for r in
           consume_cycle_tag(o, "memberid", "finishtime", attribute_rules(tags, 347), AS_OF).collect()}
    assert cyc == {"1": "last 7 days", "2": "last half year"}


def test_lifecycle_last_24h_with_timestamp_clock(spark):
    now = dt.datetime(2020, 1, 31, 6, 0)
    rows = [(1, "/a", dt.datetime(2020, 1, 30, 23, 0)), (1, "/a", dt.datetime(2020, 1, 31, 1, 0)),  # same page twice
            (1, "/x", dt.datetime(2020, 1, 10)),
            (2, "/a", dt.datetime(2020, 1, 30, 23, 0)), (2, "/b", dt.datetime(2020, 1, 31, 1, 0)),
            (2, "/x", dt.datetime(2020, 1, 10))]
    logs = spark.createDataFrame(rows, "u long, url string, t timestamp_ntz")
    got = {r.userId: r.lifecycle for r in lifecycle_tag(logs, "u", "url", "t", now).collect()}
    assert got == {1: "returning", 2: "loyal"}


def test_segment_with_fewer_distinct_vectors_than_k(spark, tags):
    """Two distinct score vectors, five tags: KMeans finds two centres, and
    the ranks that exist are named."""
    rows = [(i, 5.0, 1.0, 2.0) if i % 3 else (i, 1.0, 1.0, 1.0) for i in range(30)]
    scores = spark.createDataFrame(rows, "userId long, r_score double, f_score double, m_score double")
    got = {r.userId: r.rfm for r in segment_by_kmeans(scores, ["r_score", "f_score", "m_score"],
                                                       attribute_rules(tags, 361), "rfm").collect()}
    assert len(got) == 30
    assert {got[i] for i in range(30) if i % 3} == {"high value"}
    assert {got[i] for i in range(30) if not i % 3} == {"upper-middle value"}


@pytest.mark.parametrize("scale", [False, True])
def test_saved_model_gives_a_vector_the_same_tag_every_day(spark, tags, scores, tmp_path, scale):
    cols, rules, path = ["r_score", "f_score", "m_score"], attribute_rules(tags, 361), f"{tmp_path}/m{scale}"
    args = dict(score_cols=cols, rules=rules, tag_col="rfm", model_path=path, scale=scale)
    first = {r.userId: r.rfm for r in segment_by_kmeans(scores, **args).collect()}
    vec = {r.userId: (r.r_score, r.f_score, r.m_score) for r in scores.collect()}
    tag_of = {vec[u]: t for u, t in first.items()}
    some = sorted(tag_of)[10:13]  # another day: three vectors only
    day = spark.createDataFrame([(i, *v) for i, v in enumerate(some)], scores.schema)
    assert {r.userId: r.rfm for r in segment_by_kmeans(day, **args).collect()} == {i: tag_of[v] for i, v in enumerate(some)}


def test_users_with_a_null_score_stay(spark, tags, scores):
    cols = ["r_score", "f_score", "m_score"]
    more = scores.union(spark.createDataFrame([(9001, None, 1.0, 1.0)], scores.schema))
    got = {r.userId: r.rfm for r in segment_by_kmeans(more, cols, attribute_rules(tags, 361), "rfm").collect()}
    assert len(got) == 3001 and got[9001] is None and all(t for u, t in got.items() if u != 9001)
    only = spark.createDataFrame([(1, None, None, None)], scores.schema)
    assert [tuple(r) for r in segment_by_kmeans(only, cols, attribute_rules(tags, 361), "rfm").collect()] == [(1, None)]


def test_lifecycle_visit_exactly_a_day_ago(spark):
    now = dt.datetime(2020, 1, 31)
    rows = [(1, "/a", dt.datetime(2020, 1, 30)), (1, "/b", dt.datetime(2020, 1, 30, 12)), (1, "/x", dt.datetime(2020, 1, 2)),
            (2, "/a", dt.datetime(2020, 1, 29, 23, 59, 59, 999999)), (2, "/b", dt.datetime(2020, 1, 30, 12)), (2, "/x", dt.datetime(2020, 1, 2))]
    logs = spark.createDataFrame(rows, "u long, url string, t timestamp_ntz")
    got = {r.userId: r.lifecycle for r in lifecycle_tag(logs, "u", "url", "t", now).collect()}
    assert got == {1: "loyal", 2: "returning"}


def test_malformed_and_large_amounts(spark):
    from tagsmith.operators.rfx import malformed_amounts
    rows = [(1, "a", "abc"), (1, "b", " 2.50 "), (1, "c", None), (2, "d", "100000000"), (2, "e", "1e5"), (3, "f", "")]
    o = spark.createDataFrame([(*r, dt.datetime(2020, 1, 1)) for r in rows], "u long, o string, m string, t timestamp_ntz")
    got = {r.userId: (r.frequency, r.monetary) for r in rfm_metrics(o, "u", "o", "m", "t", AS_OF).collect()}
    assert got == {1: (3, Decimal("2.50")), 2: (2, Decimal("100100000.00")), 3: (1, None)}
    assert tuple(malformed_amounts(o, "m").first()) == (2, 1)


def test_value_ranks_and_clusters(spark):
    from tagsmith.operators.rfx import value_per_cluster, value_ranks
    v = spark.createDataFrame([(1, 5.0), (2, 4.0), (3, 5.0), (4, 1.0), (5, None)], "userId long, value double")
    got = {r.userId: (r.rank, r.is_top) for r in value_ranks(v, top_share=0.5).collect()}
    assert got == {1: (1, True), 3: (1, True), 2: (3, False), 4: (4, False), 5: (None, False)}
    a = spark.createDataFrame([(0, 2.0, 3), (0, 4.0, 1), (1, 1.0, 2)], "prediction int, value double, n long")
    assert {r.prediction: (r.users, r.mean_value, r.total_value) for r in value_per_cluster(a, "value", weight_col="n").collect()} \
        == {0: (4, 2.5, 10.0), 1: (2, 1.0, 2.0)}


def test_segment_per_user_training_matches_invariants(spark, tags, scores):
    cols = ["r_score", "f_score", "m_score"]
    seg = segment_by_kmeans(scores, cols, attribute_rules(tags, 361), "rfm", weighted=False).collect()
    assert len(seg) == 3000 and len({r.rfm for r in seg}) == 5
    # users with the same score vector always share a tag
    vec = {r.userId: (r.r_score, r.f_score, r.m_score) for r in scores.collect()}
    by_vec = {}
    for r in seg:
        by_vec.setdefault(vec[r.userId], set()).add(r.rfm)
    assert all(len(v) == 1 for v in by_vec.values())


def test_segment_with_minmax_scaled_features(spark, tags, scores):
    cols = ["r_score", "f_score", "m_score"]
    seg = segment_by_kmeans(scores, cols, attribute_rules(tags, 361), "rfm", scale=True).collect()
    assert len(seg) == 3000 and len({r.rfm for r in seg}) == 5


def test_order_facts_metrics_equal_rfm_metrics(spark):
    from tagsmith.operators.rfx import order_facts
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    for clock in ("2001-08-02", "1999-01-01", dt.datetime(1999, 1, 1, 12, 0)):
        facts = order_facts(o, "o_custkey", "o_orderkey", "o_totalprice", "o_orderdate", clock)
        got = sorted(tuple(r) for r in facts.where("recency IS NOT NULL")
                     .select("userId", "recency", "frequency", "monetary").collect())
        expect = sorted(tuple(r) for r in
                        rfm_metrics(o, "o_custkey", "o_orderkey", "o_totalprice", "o_orderdate", clock).collect())
        assert got == expect and len(expect) > 0
    firsts = {r.userId: r.first for r in order_facts(o, "o_custkey", "o_orderkey", "o_totalprice",
                                                     "o_orderdate", "1999-01-01").collect()}
    assert firsts == {r.o_custkey: r.f for r in o.groupBy("o_custkey").agg(F.min("o_orderdate").alias("f")).collect()}


def test_order_facts_on_epoch_text_equal_rfm_metrics(spark):
    from tagsmith.operators.rfx import order_facts
    e = lambda y, m, d: str(int(dt.datetime(y, m, d, 12, tzinfo=dt.timezone.utc).timestamp()))
    rows = [("1", "a", "2479.45", e(2020, 1, 28)), ("1", "b", "20.55", e(2020, 1, 2)),
            ("2", "c", "5.5", e(2019, 9, 1)), ("2", "d", "1.0", "not a time"), ("3", "e", "9.9", e(2020, 3, 1))]
    o = spark.createDataFrame(rows, "memberid string, ordersn string, orderamount string, finishtime string")
    facts = {r.userId: (r.recency, r.frequency, r.monetary) for r in
             order_facts(o, "memberid", "ordersn", "orderamount", "finishtime", AS_OF).collect()}
    rfm = {r.userId: (r.recency, r.frequency, r.monetary) for r in
           rfm_metrics(o, "memberid", "ordersn", "orderamount", "finishtime", AS_OF).collect()}
    assert {u: v for u, v in facts.items() if v[0] is not None} == rfm
    assert facts["3"] == (None, 0, None)  # only a future order
