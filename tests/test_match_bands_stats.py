import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.errors import PySparkException

from plan_util import plan_text
from tagsmith.operators.bands import age_band_tag, band_tag, consume_cycle_tag
from tagsmith.operators.joins import range_join
from tagsmith.operators.match import match_tag, unmatched_values
from tagsmith.operators.stats import favourite_value, pay_type_tag, top_n_per_group, value_counts
from tagsmith.plans.catalog import attribute_rules


@pytest.fixture
def users(spark):
    return spark.createDataFrame(
        [("1", "1"), ("2", "2"), ("3", "9"), ("4", None)], "id string, gender string")


def test_match_drop_null_error(spark, tags, users):
    rules = attribute_rules(tags, 318)
    drop = {r.userId: r.gender for r in match_tag(users, "id", "gender", rules, "gender").collect()}
    assert drop == {"1": "male", "2": "female"}
    keep = {r.userId: r.gender for r in match_tag(users, "id", "gender", rules, "gender", on_miss="null").collect()}
    assert keep == {"1": "male", "2": "female", "3": None, "4": None}
    with pytest.raises(Exception):
        match_tag(users, "id", "gender", rules, "gender", on_miss="error").collect()
    with pytest.raises(ValueError):
        match_tag(users, "id", "gender", rules, "gender", on_miss="skip")


def test_duplicate_rule_keeps_lowest_id(spark, users):
    rules = spark.createDataFrame([(20, "b", "1"), (10, "a", "1")], "id long, name string, rule string")
    got = match_tag(users, "id", "gender", rules, "t").collect()
    assert [(r.userId, r.t) for r in got] == [("1", "a")]


def test_match_is_broadcast_no_shuffle_of_users(spark, tags, users):
    plan = plan_text(match_tag(users, "id", "gender", attribute_rules(tags, 318), "g"))
    assert "BroadcastHashJoin" in plan and "PythonUDF" not in plan


def test_unmatched_values_counts_nulls(spark, tags, users):
    got = {r.value: r.rows for r in unmatched_values(users, "gender", attribute_rules(tags, 318)).collect()}
    assert got == {"9": 1, None: 1}


def test_band_edges_and_malformed_rules(spark):
    rules = spark.createDataFrame([(1, "a", "0-7"), (2, "b", "8-14"), (3, "junk", "abc"), (4, "cls", "-1")],
                                  "id long, name string, rule string")
    vals = spark.createDataFrame([(1, 0), (2, 7), (3, 8), (4, 14), (5, 15), (6, None), (7, -1)], "u int, v int")
    got = {r.userId: r.t for r in band_tag(vals, "u", "v", rules, "t").collect()}
    assert got == {1: "a", 2: "a", 3: "b", 4: "b"}


def test_range_join_bucketed_fallback_matches_broadcast(spark):
    ranges = spark.createDataFrame([("a", 0, 7), ("b", 8, 14), ("c", 15, 30), ("w", 100, 1000)],
                                   "name string, start long, end long")
    vals = spark.range(0, 1200).withColumnRenamed("id", "v")
    loop = sorted((r.v, r.name) for r in range_join(vals, "v", ranges).collect())
    hashed = range_join(vals, "v", ranges, max_loop_ranges=1)
    shuffled = range_join(vals, "v", ranges, max_loop_ranges=1, max_rows=1)
    assert loop == sorted((r.v, r.name) for r in hashed.collect()) == \
        sorted((r.v, r.name) for r in shuffled.collect())
    assert len(loop) == 31 + 901
    assert "BroadcastNestedLoopJoin" in plan_text(range_join(vals, "v", ranges))
    assert "BroadcastHashJoin" in plan_text(hashed)


def test_age_band_from_text_birthday(spark, tags):
    users = spark.createDataFrame([(99, "1982-01-11"), (1, "1959-12-31"), (2, "1960-01-01"), (3, "bad")],
                                  "id long, birthday string")
    got = {r.userId: r.agerange for r in age_band_tag(users, "id", "birthday", attribute_rules(tags, 338)).collect()}
    assert got == {99: "80s", 1: "50s", 2: "60s"}


def test_consume_cycle_recency_edges(spark, tags):
    as_of = dt.date(2020, 7, 1)
    rows = [(1, dt.datetime(2020, 7, 1, 0, 0)),      # at as_of: ignored -> previous order counts
            (1, dt.datetime(2020, 6, 30, 12, 0)),     # 1 day
            (2, dt.datetime(2020, 7, 1, 9, 0)),       # only a future order -> no row
            (3, dt.datetime(2020, 1, 3, 0, 0)),       # 180 days -> last band
            (4, dt.datetime(2020, 1, 2, 0, 0))]       # 181 days -> no tag
    orders = spark.createDataFrame(rows, "m long, t timestamp_ntz")
    got = {r.userId: r.consumercycle for r in
           consume_cycle_tag(orders, "m", "t", attribute_rules(tags, 347), as_of).collect()}
    assert got == {1: "last 7 days", 3: "last half year"}


def test_favourite_value_tie_goes_to_smallest(spark):
    rows = [(1, "wxpay"), (1, "alipay"), (1, "wxpay"), (1, "alipay"), (2, "cod"), (2, "cod"), (2, "alipay")]
    df = spark.createDataFrame(rows, "m long, p string")
    got = {(r.userId, r.p, r.cnt) for r in favourite_value(df, "m", "p").collect()}
    assert got == {(1, "alipay", 2), (2, "cod", 2)}


def test_pay_type_tag_and_empty_input(spark, tags):
    df = spark.createDataFrame([(1, "2-HIGH"), (1, "2-HIGH"), (1, "1-URGENT"), (2, "5-LOW")], "m long, p string")
    got = {r.userId: r.payment for r in pay_type_tag(df, "m", "p", attribute_rules(tags, 356)).collect()}
    assert got == {1: "wxpay"}
    empty = spark.createDataFrame([], "m long, p string")
    assert pay_type_tag(empty, "m", "p", attribute_rules(tags, 356)).count() == 0


def test_top_n_and_window_group_limit(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(1, 5.0, 1), (1, 9.0, 2), (1, 9.0, 3), (1, 1.0, 4), (2, 3.0, 5)],
                               "g long, v double, k long")
    top = top_n_per_group(df, ["g"], [F.col("v").desc(), F.col("k")], 2, rank_col="rank")
    assert sorted((r.g, r.k, r["rank"]) for r in top.collect()) == [(1, 2, 1), (1, 3, 2), (2, 5, 1)]
    assert "WindowGroupLimit" in plan_text(top)


def test_value_counts_single_shuffle(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", "x")], "c1 string, c2 string")
    got = {(r.column, r.value, r["count"]) for r in value_counts(df, ["c1", "c2"]).collect()}
    assert got == {("c1", "a", 2), ("c1", "b", 1), ("c2", "x", 2), ("c2", None, 1)}


def test_recency_zero_with_a_timestamp_clock(spark, tags):
    """A timestamp clock behaves like the reference's ``now``: an order earlier
    the same day has recency 0; a later one is in the future and ignored."""
    orders = spark.createDataFrame([(1, dt.datetime(2020, 7, 1, 8, 0)), (2, dt.datetime(2020, 7, 1, 18, 0)),
                                    (2, dt.datetime(2020, 6, 20, 9, 0))], "m long, t timestamp_ntz")
    now = dt.datetime(2020, 7, 1, 12, 0)
    got = {r.userId: r.consumercycle for r in
           consume_cycle_tag(orders, "m", "t", attribute_rules(tags, 347), now).collect()}
    assert got == {1: "last 7 days", 2: "last 2 weeks"}
    from tagsmith.operators.bands import last_activity
    days = {r.userId: r.days for r in last_activity(orders, "m", "t", now).collect()}
    assert days == {1: 0, 2: 11}


def test_cycle_and_age_in_one_pass_equal_separate_tags(spark, tags):
    from tagsmith.operators.bands import cycle_and_age_tags
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    as_of = "2001-08-02"
    cyc_rules, age_rules = attribute_rules(tags, 347), attribute_rules(tags, 338)
    both = {r.userId: (r.consumercycle, r.agerange) for r in
            cycle_and_age_tags(o, "o_custkey", "o_orderdate", cyc_rules, age_rules, as_of).collect()}
    cyc = {r.userId: r.consumercycle for r in consume_cycle_tag(o, "o_custkey", "o_orderdate", cyc_rules, as_of).collect()}
    born = o.groupBy("o_custkey").agg(F.min("o_orderdate").alias("b"))
    age = {r.userId: r.agerange for r in age_band_tag(born, "o_custkey", "b", age_rules).collect()}
    users = set(cyc) | set(age)
    assert both == {u: (cyc.get(u), age.get(u)) for u in users}
    assert plan_text(cycle_and_age_tags(o, "o_custkey", "o_orderdate", cyc_rules, age_rules, as_of)) \
        .split("\n\n(1)")[0].count("Scan parquet") == 1


def test_match_tags_one_pass_equals_separate(spark, tags):
    from tagsmith.operators.match import match_tags
    users = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    seg_rules, nat_rules = attribute_rules(tags, 390), attribute_rules(tags, 332)
    both = {r.userId: (r.segment, r.nationality) for r in match_tags(
        users, "c_custkey", [("c_mktsegment", seg_rules, "segment"), ("c_nationkey", nat_rules, "nationality")]
    ).collect()}
    seg = {r.userId: r.segment for r in match_tag(users, "c_custkey", "c_mktsegment", seg_rules, "segment").collect()}
    nat = {r.userId: r.nationality for r in
           match_tag(users, "c_custkey", "c_nationkey", nat_rules, "nationality").collect()}
    assert both == {u: (seg.get(u), nat.get(u)) for u in set(seg) | set(nat)}
    tree = plan_text(match_tags(users, "c_custkey", [("c_mktsegment", seg_rules, "segment"),
                                                     ("c_nationkey", nat_rules, "nationality")])).split("\n\n(1)")[0]
    assert tree.count("Scan parquet") == 1 and tree.count("BroadcastHashJoin") == 2


def test_match_tags_with_a_band_equals_separate(spark, tags):
    from tagsmith.functions.dates import compact_text_date
    from tagsmith.operators.match import match_tags
    users = spark.createDataFrame([("1", "1", "1982-01-11"), ("2", "9", "1959-12-31"), ("3", "9", "bad"),
                                   ("4", None, "2001-05-05")], "id string, gender string, birthday string")
    got = {r.userId: (r.gender, r.agerange) for r in match_tags(
        users, "id", [("gender", attribute_rules(tags, 318), "gender")],
        bands=[(compact_text_date("birthday"), attribute_rules(tags, 338), "agerange")]).collect()}
    assert got == {"1": ("male", "80s"), "2": (None, "50s"), "4": (None, "00s")}
