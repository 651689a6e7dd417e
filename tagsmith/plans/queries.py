"""Registered queries over the test tables, and their SQL oracles.

Each query is ``(spark, sf_dir) -> DataFrame`` and reads whole tables.  Every
query with an SQL form has an independent DuckDB statement in ``ORACLES``
with the same column names and types.  KMeans and regression results depend
on training; each has a companion query that reports invariants of the result
(or its untrained columns) and is checked against SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagsmith.functions.dates import before_as_of
from tagsmith.functions.scores import Bands
from tagsmith.operators import bands as B
from tagsmith.operators import evaluate as E
from tagsmith.operators import profile as PR
from tagsmith.operators import rfx as X
from tagsmith.operators import segment as S
from tagsmith.operators import shopper as U
from tagsmith.operators import stats as ST
from tagsmith.operators.joins import range_join
from tagsmith.operators.lineage import cut_lineage, work_path
from tagsmith.operators.match import match_tag, match_tags, unmatched_values
from tagsmith.plans import standins as SI
from tagsmith.plans.catalog import attribute_rules, catalog, tag_lookup
from tagsmith.plans.run import run_and_save, run_tag
from tagsmith.plans.state_queries import STATE_QUERIES
from tagsmith.sources.business import business_scan, condition_filter, rolling_windows, scan_options
from tagsmith.sources.catalog_source import read_catalog, read_dimension
from tagsmith.sources.files import read_csv
from tagsmith.sources.store import read_profile
from tagsmith.sources.tables import load_table

Query = Callable[[SparkSession, str], DataFrame]

OAS = SI.ORDERS_AS_OF.isoformat()   # 2001-08-02
EAS = SI.EVENTS_AS_OF.isoformat()   # 2024-01-31

# Score bands for the test data.  The reference's bands give every test user
# the same F and M score (1-25 orders per customer; 49-86 visits per user), so
# the queries pass bands cut at the measured quintiles instead.
TEST_RFM_BANDS = {
    "recency": Bands((54, 123, 220, 390), (5, 4, 3, 2, 1)),
    "frequency": Bands((7, 9, 11, 13), (1, 2, 3, 4, 5)),
    "monetary": Bands((1710000, 2230000, 2670000, 3250000), (1, 2, 3, 4, 5)),
}
TEST_RFE_BANDS = {
    "recency": Bands((1, 2, 3, 5), (5, 4, 3, 2, 1)),
    "frequency": Bands((59, 64, 69, 74), (1, 2, 3, 4, 5)),
    "engagements": Bands((55, 60, 64, 69), (1, 2, 3, 4, 5)),
}
# Given centres for the deterministic KMeans sub-steps (index = cluster id).
FIXED_CENTERS = [(5, 5, 5), (4, 3, 4), (3, 3, 3), (2, 3, 2), (1, 1, 1)]
RFM_COLS = ["r_score", "f_score", "m_score"]
RFE_COLS = ["r_score", "f_score", "e_score"]
WINDOWS = ["o_orderdate#day#30", "o_orderdate#month#6", "o_orderdate#year#1"]
CONDITIONS = ["o_orderstatus[NE]P", "o_totalprice[GE]50000", "o_totalprice[le]450000",
              "o_orderdate[GT]1996-01-01", "o_orderdate[LT]2001-01-01", "o_orderpriority[EQ]1-URGENT"]
SCAN_RULE = ("inType=parquet\ntable=orders\nselectFieldNames=o_orderkey,o_custkey,o_orderpriority\n"
             "whereCondition=o_orderdate#month#6\nfilterConditions=o_orderstatus[NE]P")
OLD_AS_OF = "2000-01-01"
PRICE_BANDS = 300
SOURCE_KEYS = ("inType", "table", "path", "whereCondition", "filterConditions")


def _tags(spark):
    return catalog(spark)


# ---------------------------------------------------------------- scans
def q_condition_filter(spark, d):
    o = load_table(spark, d, "orders")
    return condition_filter(o, CONDITIONS).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


def q_rolling_window(spark, d):
    o = load_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    return rolling_windows(o, WINDOWS, OAS)


def q_business_scan(spark, d):
    return business_scan(spark, scan_options(SCAN_RULE), d, OAS)


# ---------------------------------------------------------------- match
def q_match_inner(spark, d):
    return run_tag(spark, _tags(spark), 390, d,
                   lambda biz, rules: match_tag(biz, "c_custkey", "c_mktsegment", rules, "segment"))


def q_match_left(spark, d):
    return run_tag(spark, _tags(spark), 332, d,
                   lambda biz, rules: match_tag(biz, "c_custkey", "c_nationkey", rules, "nationality",
                                                on_miss="null"))


def q_match_multi(spark, d):
    """Segment and nationality tags in one pass over the users table."""
    tags = _tags(spark)
    return match_tags(SI.users(spark, d), "c_custkey",
                      [("c_mktsegment", attribute_rules(tags, 390), "segment"),
                       ("c_nationkey", attribute_rules(tags, 332), "nationality")])


def q_unmatched_values(spark, d):
    return unmatched_values(SI.users(spark, d), "c_nationkey", attribute_rules(_tags(spark), 332))


# ---------------------------------------------------------------- statistics
def q_age_band(spark, d):
    """Stand-in birthday: each customer's first order date."""
    def tagger(biz, rules):
        born = biz.groupBy("o_custkey").agg(F.min("o_orderdate").alias("birthday"))
        return B.age_band_tag(born, "o_custkey", "birthday", rules)
    return run_tag(spark, _tags(spark), 338, d, tagger)


def q_consume_cycle(spark, d):
    return run_tag(spark, _tags(spark), 347, d,
                   lambda biz, rules: B.consume_cycle_tag(biz, "o_custkey", "o_orderdate", rules, OAS), OAS)


def q_order_span(spark, d):
    """First order ever and days since the last order before the clock,
    per customer, in one pass (feeds the age band and the cycle)."""
    return B.order_span(SI.orders(spark, d), "o_custkey", "o_orderdate", OAS)


def q_pay_type(spark, d):
    o = before_as_of(SI.orders(spark, d), "o_orderdate", OAS)
    return ST.pay_type_tag(o, "o_custkey", "o_orderpriority", attribute_rules(_tags(spark), 356))


def q_tag_lookup(spark, d):
    """The payment tag and its children (one lookup, distinct, ordered by
    level and id) with the number of users holding each; the level-4 row
    counts every tagged user (the rollup's grand total)."""
    tags = _tags(spark)
    result = run_tag(spark, tags, 356, d,
                     lambda biz, rules: ST.pay_type_tag(biz, "o_custkey", "o_orderpriority", rules))
    per_tag = result.groupBy("payment").agg(F.count(F.lit(1)).alias("n"))
    counts = per_tag.rollup("payment").agg(F.sum("n").alias("users"), F.grouping("payment").alias("_total"))
    counts = counts.select(F.when(F.col("_total") == 1, F.lit("#all")).otherwise(F.col("payment")).alias("_key"),
                           "users")
    looked_up = tag_lookup(tags, 356)
    keyed = looked_up.withColumn("_key", F.when(F.col("level") == 4, F.lit("#all")).otherwise(F.col("name")))
    return (keyed.join(counts, "_key", "left")
            .select("id", "name", "rule", "level", F.coalesce(F.col("users"), F.lit(0)).alias("users"))
            .orderBy("level", "id"))


def q_range_rules(spark, d):
    """Consumption-cycle rules parsed into bands, with the users in each."""
    tags = _tags(spark)
    bands = B.range_rules(attribute_rules(tags, 347))
    tagged = B.consume_cycle_tag(SI.orders(spark, d), "o_custkey", "o_orderdate", attribute_rules(tags, 347), OAS)
    per_band = tagged.groupBy(F.col("consumercycle").alias("name")).agg(F.count(F.lit(1)).alias("users"))
    return bands.join(per_band, "name", "left").select(
        "name", "start", "end", F.coalesce(F.col("users"), F.lit(0)).alias("users"))


def q_rule_options(spark, d):
    """Every business tag's rule parsed into (key, value) rows, with the
    number of rows its source holds.  The rules are parsed in the JVM; rules
    that read the same rows (table and conditions) share one count, all in
    one job."""
    from functools import reduce
    from tagsmith.functions.rules import rule_options
    tags = _tags(spark)
    business = tags.where((F.col("level") == 4) & F.col("rule").isNotNull())
    options = rule_options("rule")
    source = F.concat_ws("|", *(F.coalesce(options[k], F.lit("")) for k in SOURCE_KEYS))
    pairs = business.select("id", source.alias("source"), F.explode(options).alias("key", "value"))
    # one row per source, of which there are as many as business tables
    one = business.groupBy(source.alias("source")).agg(F.min("rule").alias("rule")).collect()
    counts = [business_scan(spark, scan_options(r.rule), d).agg(F.count(F.lit(1)).alias("rows"))
              .select(F.lit(r.source).alias("source"), "rows") for r in one]
    return pairs.join(reduce(lambda a, b: a.unionByName(b), counts), "source").drop("source")


def q_top_n_per_group(spark, d):
    o = load_table(spark, d, "orders", ["o_custkey", "o_orderkey", "o_totalprice"])
    top = ST.top_n_per_group(o, ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 3,
                             rank_col="rank")
    return top.withColumn("rank", F.col("rank").cast("int"))


def q_value_counts(spark, d):
    o = load_table(spark, d, "orders", ["o_orderstatus", "o_orderpriority"])
    return ST.value_counts(o, ["o_orderstatus", "o_orderpriority"])


# ---------------------------------------------------------------- RFM / RFE
def _rfm_metrics(spark, d):
    """RFM metrics; the exact decimal(20,2) sum is exposed as double so the
    comparison does not depend on how an engine hands decimals to clients."""
    m = X.rfm_metrics(SI.orders(spark, d), "o_custkey", "o_orderkey", "o_totalprice", "o_orderdate", OAS)
    return m.withColumn("monetary", F.col("monetary").cast("double"))


def _rfm_scores(spark, d):
    return X.rfm_scores(_rfm_metrics(spark, d), TEST_RFM_BANDS)


def q_rfm_text(spark, d):
    """RFM metrics over all-text orders, some of them malformed."""
    m = X.rfm_metrics(SI.text_orders(spark, d), "memberid", "ordersn", "orderamount", "finishtime", OAS)
    return m.withColumn("monetary", F.col("monetary").cast("double"))


def q_malformed_amounts(spark, d):
    return X.malformed_amounts(SI.text_orders(spark, d), "orderamount")


def q_rfm_value_ranks(spark, d):
    """Users ranked by weighted value, and the best fifth of them."""
    return X.value_ranks(X.weighted_score(_rfm_scores(spark, d)), top_share=0.2)


def q_rfe_activity_ranks(spark, d):
    """Users ranked by their activity (equal weights of the RFE scores)."""
    return X.value_ranks(X.weighted_score(_rfe_scores(spark, d), {c: 1.0 for c in RFE_COLS}, "activity"),
                         top_share=0.1, value_col="activity")


def q_rfm_value_per_cluster(spark, d):
    hist = S.score_histogram(_rfm_scores(spark, d), RFM_COLS)
    value = sum((F.col(c) * F.lit(w) for c, w in X.RFM_WEIGHTS.items()), F.lit(0.0))
    got = X.value_per_cluster(S.nearest_center(hist, RFM_COLS, FIXED_CENTERS), value, weight_col="n")
    return got.select("prediction", "users", F.round("mean_value", 6).alias("mean_value"),
                      F.round("total_value", 6).alias("total_value"))


def _rfe_metrics(spark, d):
    return X.rfe_metrics(SI.logs(spark, d), "user_id", "loc_url", "ts", EAS)


def _rfe_scores(spark, d):
    return X.rfe_scores(_rfe_metrics(spark, d), TEST_RFE_BANDS)


def q_rfm_metrics(spark, d):
    return _rfm_metrics(spark, d)


def q_rfm_scores(spark, d):
    return _rfm_scores(spark, d)


def q_rfm_weighted(spark, d):
    return X.weighted_score(_rfm_scores(spark, d))


def q_rfm_default_scores(spark, d):
    return X.rfm_scores(_rfm_metrics(spark, d))


def q_rfe_metrics(spark, d):
    return _rfe_metrics(spark, d)


def q_rfe_scores(spark, d):
    return _rfe_scores(spark, d)


def q_rfe_default_scores(spark, d):
    return X.rfe_scores(_rfe_metrics(spark, d))


def q_rfe_lifecycle(spark, d):
    return X.lifecycle_tag(SI.logs(spark, d), "user_id", "loc_url", "ts", EAS)


# ---------------------------------------------------------------- KMeans steps
def q_nearest_center(spark, d):
    return S.nearest_center(_rfm_scores(spark, d), RFM_COLS, FIXED_CENTERS).select("userId", "prediction")


def _rfm_assigned_vectors(spark, d):
    """The distinct score vectors (a few hundred at most) with their users and
    nearest fixed centre."""
    hist = S.score_histogram(_rfm_scores(spark, d), RFM_COLS)
    return S.nearest_center(hist, RFM_COLS, FIXED_CENTERS)


def q_wssse(spark, d):
    return S.wssse(S.score_histogram(_rfm_scores(spark, d), RFM_COLS), RFM_COLS, FIXED_CENTERS, weight_col="n")


def q_center_rank_tags(spark, d):
    centers = S.update_centers(_rfm_assigned_vectors(spark, d), RFM_COLS, weight_col="n")
    ranked = S.rank_centers(centers, RFM_COLS, attribute_rules(_tags(spark), 361))
    return ranked.select("prediction", F.round("center_sum", 6).alias("center_sum"),
                         F.col("rank").cast("int").alias("rank"), "points", "tag")


def q_cluster_profile(spark, d):
    return S.cluster_profile(_rfm_assigned_vectors(spark, d), RFM_COLS, weight_col="n")


def q_rfm_segments_report(spark, d):
    return S.segment_report(_rfm_scores(spark, d), RFM_COLS, attribute_rules(_tags(spark), 361))


def q_rfe_segments_report(spark, d):
    return S.segment_report(_rfe_scores(spark, d), RFE_COLS, attribute_rules(_tags(spark), 367))


def q_rfm_segments(spark, d):
    def tagger(biz, rules):
        metrics = X.rfm_metrics(biz, "o_custkey", "o_orderkey", "o_totalprice", "o_orderdate", OAS)
        return S.segment_by_kmeans(X.rfm_scores(metrics, TEST_RFM_BANDS), RFM_COLS, rules, "rfm")
    return run_tag(spark, _tags(spark), 361, d, tagger)


def q_rfe_segments(spark, d):
    def tagger(biz, rules):
        logs = biz.select("user_id", "ts", F.concat("event_type", "props").alias("loc_url"))
        metrics = X.rfe_metrics(logs, "user_id", "loc_url", "ts", EAS)
        return S.segment_by_kmeans(X.rfe_scores(metrics, TEST_RFE_BANDS), RFE_COLS, rules, "rfe")
    return run_tag(spark, _tags(spark), 367, d, tagger)


def q_kmeans_trials(spark, d):
    """The reference's three trials over the users' scores: their number, and
    whether the chosen model has the lowest cost and its cost is the users'
    within-set error."""
    scores = _rfm_scores(spark, d)
    hist = cut_lineage(S.score_histogram(scores, RFM_COLS))
    model, trials = S.fit_kmeans(S.feature_stages(RFM_COLS, False).fit(hist).transform(hist.coalesce(1)), 5)
    cost, centers = model.summary.trainingCost, [tuple(map(float, c)) for c in model.clusterCenters()]
    w = S.wssse(scores, RFM_COLS, centers)
    return w.select(F.col("points").alias("users"), F.lit(len(trials)).cast("long").alias("trials"),
                    F.lit(cost <= min(t[0] for t in trials)).alias("lowest"),
                    (F.abs(F.col("wssse") - cost) <= 1e-6 * cost).alias("cost_matches"))


# ---------------------------------------------------------------- stores: written, read back, checked
def q_catalog_scan(spark, d):
    """A match tag run from a catalogue file."""
    path = work_path(spark, "catalogue")
    _tags(spark).write.parquet(path)
    return run_tag(spark, read_catalog(spark, "parquet", path=path), 390, d,
                   lambda biz, rules: match_tag(biz, "c_custkey", "c_mktsegment", rules, "segment"))


def q_dimension_scan(spark, d):
    """Order lines encoded with dimension tables read from files."""
    colors, products = SI.dims(spark)
    read = []
    for name, frame in (("colors", colors), ("products", products)):
        path = work_path(spark, name)
        frame.write.json(path)
        read.append(read_dimension(spark, "json", path=path))
    p = U.encode_dims(SI.parts(spark, d), *read).select("p_partkey", "color", "product")
    li = load_table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey"])
    return li.join(p, li["l_partkey"] == p["p_partkey"]).select("l_orderkey", "l_linenumber", "color", "product")


def q_csv_scan(spark, d):
    """The users as CSV text, read with a schema."""
    path = work_path(spark, "users-csv")
    users = SI.users(spark, d)
    users.write.option("header", "true").csv(path)
    return read_csv(spark, path, users.schema, header=True)


def q_profile_store(spark, d):
    """Two tags run and saved as profile versions, the second merged into
    the first; the second version read back."""
    base, tags = work_path(spark, "profile"), _tags(spark)
    run_and_save(spark, tags, 390, d, lambda b, r: match_tag(b, "c_custkey", "c_mktsegment", r, "segment"), base, "1")
    run_and_save(spark, tags, 356, d, lambda b, r: ST.pay_type_tag(b, "o_custkey", "o_orderpriority", r), base, "2",
                 previous="1")
    return read_profile(spark, base, "2").select("userId", "segment", "payment")


def q_model_store(spark, d):
    """Segments by a model that is trained and saved, then by the saved one:
    users, users with a tag, and users whose tag differs."""
    path, scores, rules = work_path(spark, "model"), cut_lineage(_rfm_scores(spark, d)), attribute_rules(_tags(spark), 361)
    first = S.segment_by_kmeans(scores, RFM_COLS, rules, "a", model_path=path, scale=True)
    again = S.segment_by_kmeans(scores, RFM_COLS, rules, "b", model_path=path, scale=True)
    return first.join(again, "userId").agg(
        F.count(F.lit(1)).alias("users"), F.count("a").alias("tagged"),
        F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("differing"))


def q_price_bands(spark, d):
    """Orders per price band, with more bands than a nested loop should
    compare (the bucketed range join)."""
    bands = spark.range(PRICE_BANDS).select(F.col("id").alias("band"), (F.col("id") * 2500).alias("start"),
                                            (F.col("id") * 2500 + 2499).alias("end"))
    o = load_table(spark, d, "orders", ["o_totalprice"]).select(F.floor("o_totalprice").alias("price"))
    return range_join(o, "price", bands).groupBy("band").agg(F.count(F.lit(1)).alias("orders"))


def q_top_customers(spark, d):
    """The ten customers with the highest order total."""
    o = load_table(spark, d, "orders", ["o_custkey", "o_totalprice"])
    total = F.sum(F.col("o_totalprice").cast("decimal(20,2)")).cast("double")
    return o.groupBy(F.col("o_custkey").alias("userId")).agg(total.alias("total")).orderBy(F.desc("total"), "userId").limit(10)


# ---------------------------------------------------------------- feature stages
def q_minmax_scale(spark, d):
    cols = ["recency", "frequency", "monetary"]
    scaled = E.minmax_scale(cut_lineage(_rfm_metrics(spark, d)), cols)
    return scaled.select("userId", *[F.round(F.col("scaled")[i], 6).alias(f"{c}_scaled")
                                     for i, c in enumerate(cols)])


def q_l2_normalize(spark, d):
    e = load_table(spark, d, "embeddings", ["vec_id", "embedding"])
    n = E.l2_normalize(e, "embedding")
    return n.select("vec_id", F.posexplode("normalized").alias("dim", "value")) \
        .select("vec_id", "dim", F.round("value", 6).alias("value"))


def q_label_index(spark, d):
    u = load_table(spark, d, "customer", ["c_custkey", "c_mktsegment"])
    return E.label_index(u, "c_mktsegment").select(F.col("c_custkey").alias("userId"), "c_mktsegment", "label_idx")


# ---------------------------------------------------------------- shopping gender
def _usg_lines(spark, d):
    return SI.goods(spark, d)


def q_encode_dims(spark, d):
    return _usg_lines(spark, d).select("l_orderkey", "l_linenumber", "color", "product")


def q_seed_labels(spark, d):
    return _usg_lines(spark, d).select("l_orderkey", "l_linenumber", "label")


def q_usg_join(spark, d):
    o = load_table(spark, d, "orders", ["o_orderkey", "o_custkey"])
    lines = _usg_lines(spark, d)
    return lines.join(o, lines["l_orderkey"] == o["o_orderkey"]).select(
        F.col("o_custkey").alias("userId"), "l_orderkey", "l_linenumber", "color", "product", "label")


def _seed_votes(spark, d):
    o = load_table(spark, d, "orders", ["o_orderkey", "o_custkey"])
    return U.gender_votes(_usg_lines(spark, d), o, "l_orderkey", "o_orderkey", "o_custkey", "label")


def q_usg_vote(spark, d):
    return U.vote_tag(_seed_votes(spark, d), attribute_rules(_tags(spark), 380), keep_counts=True)


def q_usg_vote_recent(spark, d):
    """Votes over the orders of the last half year only (180 days)."""
    o = U.recent_orders(load_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate"]),
                        "o_orderdate", OAS, 180)
    votes = U.gender_votes(_usg_lines(spark, d), o, "l_orderkey", "o_orderkey", "o_custkey", "label")
    return U.vote_tag(votes, attribute_rules(_tags(spark), 380), keep_counts=True)


def q_hash_split(spark, d):
    o = load_table(spark, d, "orders", ["o_orderkey"])
    return E.hash_split(o, ["o_orderkey"], method="md5")


def q_classification_metrics(spark, d):
    """Per order line: the seed label against the user's voted class.

    One pass over the lines: (user, label) counts, the user's class from the
    same counts, then the confusion matrix (label, class)."""
    o = load_table(spark, d, "orders", ["o_orderkey", "o_custkey"])
    lines = _usg_lines(spark, d)
    per_order = lines.groupBy("l_orderkey", "label").agg(F.count(F.lit(1)).alias("n"))
    per_user = (per_order.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
                .groupBy(F.col("o_custkey").alias("userId"), "label").agg(F.sum("n").alias("n")))
    w = Window.partitionBy("userId")
    cls = per_user.withColumn("total", F.sum("n").over(w)) \
        .withColumn("male", F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).over(w)) \
        .withColumn("female", F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).over(w)) \
        .withColumn("p", U.vote_class())
    cm = cls.groupBy(F.col("label").alias("l"), "p").agg(F.sum("n").alias("n"))
    m = E.confusion_metrics(cm)
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])


SPLIT_KEYS = ["l_orderkey", "l_linenumber"]


def q_usg_tree(spark, d):
    """Shopping gender by the tree, trained on noisy seed labels."""
    o = load_table(spark, d, "orders", ["o_orderkey", "o_custkey"])
    return U.usg_tag(SI.noisy_goods(spark, d), o, attribute_rules(_tags(spark), 380),
                     "l_orderkey", "o_orderkey", "o_custkey", SPLIT_KEYS, method="md5", keep_counts=True)


def q_logreg_classify(spark, d):
    e = E.hash_split(load_table(spark, d, "embeddings", ["vec_id", "embedding", "label"]), ["vec_id"], method="md5")
    model, _ = E.train_classifier(e.where("is_train"), "embedding", "label")
    scored = model.transform(E.prepare_features(e, "embedding")[0])
    return scored.select("vec_id", "label", "label_idx", F.col("prediction").alias("predicted_index"),
                         "is_train")


def q_logreg_metrics(spark, d):
    """Held-out metrics of the classifier demo (confusion-matrix aggregate)."""
    scored = q_logreg_classify(spark, d).where(~F.col("is_train"))
    # label_idx comes from the pipeline's own StringIndexer (fitted on training rows)
    return E.classification_metrics(scored, "label_idx", "predicted_index")


def q_logreg_report(spark, d):
    """Facts about the classifier's output that SQL knows too: rows, training
    rows, the training class of each index (its rank by frequency) and how
    many rows have a prediction outside the classes."""
    scored = q_logreg_classify(spark, d)
    per = scored.groupBy("label", "label_idx").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("is_train").alias("train_rows"),
        F.sum(F.when(F.col("predicted_index").between(0, 9), 0).otherwise(1)).alias("outside"))
    return per.select("label", "label_idx", "rows", "train_rows", "outside")


def q_usg_tree_metrics(spark, d):
    m = U.tree_holdout_metrics(SI.noisy_goods(spark, d), SPLIT_KEYS, method="md5")
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])


# ---------------------------------------------------------------- profile
def _profile(spark, d, as_of, with_segment=True):
    tags = _tags(spark)
    o = SI.orders(spark, d)
    pay = ST.pay_type_tag(o.where(F.col("o_orderdate") < F.lit(as_of).cast("timestamp_ntz")),
                          "o_custkey", "o_orderpriority", attribute_rules(tags, 356))
    if with_segment:
        # consumption cycle and first-order age band from one pass over orders
        dated = B.cycle_and_age_tags(o, "o_custkey", "o_orderdate", attribute_rules(tags, 347),
                                     attribute_rules(tags, 338), as_of)
        segment = match_tag(SI.users(spark, d), "c_custkey", "c_mktsegment", attribute_rules(tags, 390), "segment")
        return PR.profile_wide([pay, dated, segment])
    cycle = B.consume_cycle_tag(o, "o_custkey", "o_orderdate", attribute_rules(tags, 347), as_of)
    return PR.profile_wide([pay, cycle])


def _full_profile(spark, d, trained: bool):
    """One row per user of every tag on the stand-ins, or of the tags alone
    that need no trained model."""
    tags = _tags(spark)
    # the match tags on the users table in one scan
    matched = match_tags(SI.users(spark, d), "c_custkey",
                         [("c_mktsegment", attribute_rules(tags, 390), "segment"),
                          ("c_nationkey", attribute_rules(tags, 332), "nationality")])
    # one aggregation of the orders feeds the RFM segments, the cycle and the age band
    facts = cut_lineage(X.order_facts(SI.orders(spark, d), "o_custkey", "o_orderkey", "o_totalprice",
                                      "o_orderdate", OAS))
    metrics = facts.where(F.col("recency").isNotNull()).select("userId", "recency", "frequency", "monetary")
    cycle = B.band_tag(metrics, "userId", "recency", attribute_rules(tags, 347), "consumercycle")
    age = B.age_band_tag(facts, "userId", "first", attribute_rules(tags, 338))
    parts = [matched, cycle, age, q_pay_type(spark, d), q_rfe_lifecycle(spark, d)]
    if trained:
        parts += [S.segment_by_kmeans(X.rfm_scores(metrics, TEST_RFM_BANDS), RFM_COLS, attribute_rules(tags, 361), "rfm"),
                  q_rfe_segments(spark, d), q_usg_tree(spark, d).select("userId", "usg")]
    return PR.profile_wide(parts)


def q_profile_full(spark, d):
    """Every tag pipeline on the stand-ins, merged into one row per user:
    segment, nationality, consumption cycle and age band, payment, lifecycle,
    RFM and RFE segments and shopping gender."""
    return _full_profile(spark, d, trained=True)


def q_profile_full_untrained(spark, d):
    """The same merge without the tags of trained models, checked against SQL."""
    return _full_profile(spark, d, trained=False).select("userId", "segment", "nationality", "consumercycle", "agerange", "payment",
                                                          "lifecycle")


def q_profile_wide(spark, d):
    return _profile(spark, d, OAS)


def q_profile_upsert(spark, d):
    old = _profile(spark, d, OLD_AS_OF)
    new = _profile(spark, d, OAS, with_segment=False)
    return PR.profile_upsert(old, new)


QUERIES: dict[str, Query] = {
    "condition_filter": q_condition_filter,
    "rolling_window": q_rolling_window,
    "business_scan": q_business_scan,
    "match_inner": q_match_inner,
    "match_left": q_match_left,
    "match_multi": q_match_multi,
    "unmatched_values": q_unmatched_values,
    "age_band": q_age_band,
    "consume_cycle": q_consume_cycle,
    "order_span": q_order_span,
    "pay_type": q_pay_type,
    "tag_lookup": q_tag_lookup,
    "rule_options": q_rule_options,
    "range_rules": q_range_rules,
    "top_n_per_group": q_top_n_per_group,
    "value_counts": q_value_counts,
    "rfm_metrics": q_rfm_metrics,
    "rfm_scores": q_rfm_scores,
    "rfm_default_scores": q_rfm_default_scores,
    "rfm_weighted": q_rfm_weighted,
    "rfm_text": q_rfm_text,
    "malformed_amounts": q_malformed_amounts,
    "rfm_value_ranks": q_rfm_value_ranks,
    "rfe_activity_ranks": q_rfe_activity_ranks,
    "rfm_value_per_cluster": q_rfm_value_per_cluster,
    "rfe_metrics": q_rfe_metrics,
    "rfe_scores": q_rfe_scores,
    "rfe_default_scores": q_rfe_default_scores,
    "rfe_lifecycle": q_rfe_lifecycle,
    "nearest_center": q_nearest_center,
    "wssse": q_wssse,
    "center_rank_tags": q_center_rank_tags,
    "cluster_profile": q_cluster_profile,
    "rfm_segments": q_rfm_segments,
    "rfe_segments": q_rfe_segments,
    "rfm_segments_report": q_rfm_segments_report,
    "rfe_segments_report": q_rfe_segments_report,
    "kmeans_trials": q_kmeans_trials,
    "catalog_scan": q_catalog_scan,
    "dimension_scan": q_dimension_scan,
    "csv_scan": q_csv_scan,
    "profile_store": q_profile_store,
    "model_store": q_model_store,
    "price_bands": q_price_bands,
    "top_customers": q_top_customers,
    "minmax_scale": q_minmax_scale,
    "l2_normalize": q_l2_normalize,
    "label_index": q_label_index,
    "encode_dims": q_encode_dims,
    "seed_labels": q_seed_labels,
    "usg_join": q_usg_join,
    "usg_vote": q_usg_vote,
    "usg_vote_recent": q_usg_vote_recent,
    "hash_split": q_hash_split,
    "classification_metrics": q_classification_metrics,
    "usg_tree": q_usg_tree,
    "logreg_classify": q_logreg_classify,
    "logreg_metrics": q_logreg_metrics,
    "logreg_report": q_logreg_report,
    "usg_tree_metrics": q_usg_tree_metrics,
    "profile_wide": q_profile_wide,
    "profile_full": q_profile_full,
    "profile_full_untrained": q_profile_full_untrained,
    "profile_upsert": q_profile_upsert,
    **STATE_QUERIES,
}
