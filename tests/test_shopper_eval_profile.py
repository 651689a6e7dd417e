import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tagsmith.operators.evaluate import (
    classification_metrics, hash_split, l2_normalize, label_index, minmax_scale,
)
from tagsmith.operators.profile import profile_upsert, profile_wide
from tagsmith.operators.shopper import encode_dims, gender_votes, seed_labels, vote_tag
from tagsmith.plans.catalog import attribute_rules


def test_encode_dims_default_and_duplicates(spark):
    goods = spark.createDataFrame([("o1", "red", "PROMO"), ("o2", "pink", "PROMO"), ("o3", "blue", None)],
                                  "cordersn string, ogcolor string, producttype string")
    colors = spark.createDataFrame([(2, "red"), (1, "red"), (3, "blue")], "id int, name string")
    products = spark.createDataFrame([(4, "PROMO")], "id int, name string")
    got = {r.cordersn: (r.color, r.product) for r in encode_dims(goods, colors, products).collect()}
    assert got == {"o1": (1, 4), "o2": (0, 4), "o3": (3, 0)}


def test_seed_labels(spark):
    goods = spark.createDataFrame([("red", "X"), ("blue", "PROMO"), ("blue", "X"), (None, None)],
                                  "ogcolor string, producttype string")
    got = [r.label for r in seed_labels(goods, ["red"], ["PROMO"]).collect()]
    assert got == [1, 1, 0, 0]


def test_votes_exact_threshold_and_orphan_line(spark, tags):
    # user 1: 3 of 5 lines male (exactly 60 %) -> male; user 2: 1 of 2 -> neutral;
    # user 3: all female; the line of order 99 has no order -> dropped
    lines = spark.createDataFrame([(10, 0), (10, 0), (11, 0), (11, 1), (11, 1), (20, 0), (20, 1),
                                   (30, 1), (99, 0)], "ok long, cls int")
    orders = spark.createDataFrame([(10, 1), (11, 1), (20, 2), (30, 3)], "ok long, u long")
    votes = gender_votes(lines, orders, "ok", "ok", "u", "cls")
    got = {r.userId: (r.total, r.male, r.female) for r in votes.collect()}
    assert got == {1: (5, 3, 2), 2: (2, 1, 1), 3: (1, 0, 1)}
    tagged = {r.userId: r.usg for r in vote_tag(votes, attribute_rules(tags, 380)).collect()}
    assert tagged == {1: "male", 2: "neutral", 3: "female"}


@pytest.mark.parametrize("method", ["xxhash64", "md5"])
def test_hash_split_deterministic(spark, method):
    df = spark.range(0, 2000)
    a = {r.id: r.is_train for r in hash_split(df, ["id"], method=method).collect()}
    b = {r.id: r.is_train for r in hash_split(df.repartition(7), ["id"], method=method).collect()}
    assert a == b and 0.75 < sum(a.values()) / len(a) < 0.85
    with pytest.raises(ValueError):
        hash_split(df, ["id"], method="crc")


def test_classification_metrics_match_spark_ml(spark):
    rows = [(0.0, 0.0)] * 5 + [(0.0, 1.0)] * 2 + [(1.0, 1.0)] * 4 + [(1.0, 2.0)] + [(2.0, 0.0)] * 3
    df = spark.createDataFrame(rows, "label double, prediction double")
    ours = classification_metrics(df).first()
    for ours_name, ml_name in [("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"),
                               ("weighted_recall", "weightedRecall"), ("f1", "f1")]:
        ml = MulticlassClassificationEvaluator(metricName=ml_name).evaluate(df)
        assert ours[ours_name] == pytest.approx(ml, abs=1e-12), ours_name


def test_label_index_ties_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "s string")
    got = {r.s: r.label_idx for r in label_index(df, "s").collect()}
    assert got == {"c": 0.0, "a": 1.0, "b": 2.0}


def test_minmax_constant_column_and_l2(spark):
    df = spark.createDataFrame([(1, 0.0, 5.0), (2, 10.0, 5.0), (3, 5.0, 5.0)], "k long, x double, y double")
    got = {r.k: list(r.scaled) for r in minmax_scale(df, ["x", "y"]).collect()}
    assert got == {1: [0.0, 0.5], 2: [1.0, 0.5], 3: [0.5, 0.5]}
    v = spark.createDataFrame([(1, [3.0, 4.0])], "k long, e array<double>")
    assert l2_normalize(v, "e").first().normalized == pytest.approx([0.6, 0.8])


def test_profile_upsert_cells(spark):
    old = spark.createDataFrame([(1, "male", "alipay"), (2, "female", "cod")], "userId long, gender string, payment string")
    new = spark.createDataFrame([(1, "wxpay", "80s"), (2, None, "90s"), (3, "cod", None)],
                                "userId long, payment string, agerange string")
    got = {r.userId: (r.gender, r.payment, r.agerange) for r in profile_upsert(old, new).collect()}
    assert got == {1: ("male", "wxpay", "80s"), 2: ("female", "cod", "90s"), 3: (None, "cod", None)}


def test_profile_wide_one_row_per_user(spark):
    a = spark.createDataFrame([(1, "male"), (2, "female")], "userId long, gender string")
    b = spark.createDataFrame([(2, "cod"), (3, "alipay")], "userId long, payment string")
    got = {r.userId: (r.gender, r.payment) for r in profile_wide([a, b]).collect()}
    assert got == {1: ("male", None), 2: ("female", "cod"), 3: (None, "alipay")}
    with pytest.raises(ValueError):
        profile_wide([])


def test_classifier_demo_on_columns(spark):
    """Numeric columns + string class, as in the demo's CSV input."""
    from tagsmith.operators.evaluate import classify
    rows = [(float(i % 7), float(i % 5), "a" if i % 2 else "b", i) for i in range(200)]
    df = spark.createDataFrame(rows, "x double, y double, category string, k long")
    pred, metrics = classify(df, ["x", "y"], "category", ["k"])
    assert pred.count() == 200 and set(metrics) == {"accuracy", "f1", "weightedPrecision", "weightedRecall"}
    assert 0.0 <= metrics["accuracy"] <= 1.0


def test_votes_over_a_lookback_window(spark, tags):
    import datetime as dt
    from tagsmith.operators.shopper import recent_orders
    lines = spark.createDataFrame([(10, 0), (11, 1), (11, 1)], "ok long, cls int")
    orders = spark.createDataFrame([(10, 1, dt.datetime(2020, 6, 1)), (11, 1, dt.datetime(2019, 6, 1))],
                                   "ok long, u long, d timestamp_ntz")
    every = {r.userId: (r.total, r.male) for r in gender_votes(lines, orders, "ok", "ok", "u", "cls").collect()}
    recent = recent_orders(orders, "d", dt.date(2020, 7, 1), 180)
    half_year = {r.userId: (r.total, r.male) for r in gender_votes(lines, recent, "ok", "ok", "u", "cls").collect()}
    assert every == {1: (3, 1)} and half_year == {1: (1, 1)}


def test_usg_tag_degenerate_inputs(spark, tags):
    from tagsmith.operators.shopper import usg_tag
    orders = spark.createDataFrame([(1, 10), (2, 20)], "ok long, u long")
    schema = "ok long, ln int, color int, product int, label int"
    one_class = spark.createDataFrame([(1, 1, 1, 2, 0), (2, 1, 2, 3, 0), (2, 2, 1, 2, 0)], schema)
    got = {r.userId: r.usg for r in usg_tag(one_class, orders, attribute_rules(tags, 380), "ok", "ok", "u",
                                            ["ok", "ln"]).collect()}
    assert got == {10: "male", 20: "male"}
    empty = usg_tag(spark.createDataFrame([], schema), orders, attribute_rules(tags, 380), "ok", "ok", "u",
                    ["ok", "ln"])
    assert empty.count() == 0 and empty.columns == ["userId", "usg"]


def test_tune_classifier_picks_a_grid_point(spark):
    from tagsmith.operators.evaluate import prepare_features, tune_classifier
    rows = [(float(i % 7), float((i * 3) % 5), "a" if (i % 7) > 3 else "b") for i in range(300)]
    df = spark.createDataFrame(rows, "x double, y double, category string")
    best = tune_classifier(df, ["x", "y"], "category", reg_params=(0.0, 0.3), elastic_net_params=(0.0,))
    lr = best.stages[-1]
    assert lr.getRegParam() in (0.0, 0.3)
    assert best.transform(prepare_features(df, ["x", "y"])[0]).count() == 300


def test_usg_tag_writes_no_lines(spark, tags, monkeypatch):
    """Only the histogram (a few rows) is materialised."""
    from tagsmith.operators import lineage, shopper
    from tagsmith.plans import standins as SI
    seen = []
    real = lineage.cut_lineage
    monkeypatch.setattr(shopper, "cut_lineage", lambda df: seen.append(df.count()) or real(df))
    d = "/root/testdata/sf0.001"
    orders = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", "o_custkey")
    got = shopper.usg_tag(SI.noisy_goods(spark, d), orders, attribute_rules(tags, 380), "l_orderkey", "o_orderkey", "o_custkey",
                          ["l_orderkey", "l_linenumber"], method="md5")
    assert got.count() > 0 and seen and max(seen) <= 8 * 7 * 4


def test_label_index_nulls_and_bound(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b"), (4, None)], "id long, c string")
    assert {r.id: r.label_idx for r in label_index(df, "c").collect()} == {1: 0.0, 2: 1.0, 3: 0.0}
    assert {r.id: r.label_idx for r in label_index(df, "c", nulls="keep").collect()} == {1: 0.0, 2: 1.0, 3: 0.0, 4: None}
    many = spark.range(150_000).selectExpr("concat('v', id) AS c").unionByName(spark.sql("SELECT 'v7' AS c"))  # any number of labels
    index = label_index(many, "c")
    assert index.where("c = 'v7'").select("label_idx").distinct().collect()[0][0] == 0.0
    assert index.agg(F.count_distinct("label_idx"), F.max("label_idx")).first() == (150_000, 149_999.0)


def test_classifier_scores_a_class_seen_only_in_the_held_out_part(spark):
    from tagsmith.operators.evaluate import classify, hash_split
    rows = [(float(i % 7), float(i % 5), "a" if i % 2 else "b", i) for i in range(200)]
    df = spark.createDataFrame(rows, "x double, y double, category string, k long")
    out = hash_split(df, ["k"]).where("not is_train").select("k").limit(1).first().k
    df = df.withColumn("category", F.when(F.col("k") == out, "rare").otherwise(F.col("category")))
    pred, metrics = classify(df, ["x", "y"], "category", ["k"])
    assert pred.where(f"k = {out}").first().label_idx == 2.0 and pred.count() == 200 and 0 <= metrics["accuracy"] < 1


