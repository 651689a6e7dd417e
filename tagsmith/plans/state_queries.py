"""Registered queries of the parts that keep state, order all rows or prove a
model: delta upserts, daily refresh, sketches, fitted bands, total order,
heavy hitters and model certificates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tagsmith.operators import certify as C
from tagsmith.operators import daily as D
from tagsmith.operators import evaluate as E
from tagsmith.operators import lloyd as L
from tagsmith.operators import ranks as R
from tagsmith.operators import rfx as X
from tagsmith.operators import segment as S
from tagsmith.operators import shopper as U
from tagsmith.operators import stats as ST
from tagsmith.operators import tune as T
from tagsmith.operators.lineage import cut_lineage, work_path
from tagsmith.operators.match import match_tag
from tagsmith.plans import standins as SI
from tagsmith.plans.catalog import attribute_rules, catalog
from tagsmith.sources import bucket_store as BS
from tagsmith.sources.literal import local_frame
from tagsmith.sources.tables import load_table

OAS = SI.ORDERS_AS_OF.isoformat()
EAS = SI.EVENTS_AS_OF.isoformat()
# the daily refresh: a window of 90 days, started 4 days before the clock's eve
LOOKBACK, REFRESHES = 90, 4
PAGE_WINDOW = 14
QUINTILES = (0.2, 0.4, 0.6, 0.8)
RFM_UP = {"recency": False, "frequency": True, "monetary": True}
RFE_UP = {"recency": False, "frequency": True, "engagements": True}
TOP_PARTS = 20
# users whose key ends in 7 get new tags in the delta, and as many users are new
DELTA_KEYS = "c_custkey % 10 = 7"


def _store_with_delta(spark, d) -> str:
    """The profile of segments in a bucket store, then a delta of payment tags
    and changed segments."""
    base, tags = work_path(spark, "bucket-store"), catalog(spark)
    users = SI.users(spark, d)
    BS.create_store(match_tag(users, "c_custkey", "c_mktsegment", attribute_rules(tags, 390), "segment"), base, buckets=32)
    changed = users.where(DELTA_KEYS)
    moved = changed.select(F.col("c_custkey").alias("userId"), F.lit("moved").alias("segment"))
    paid = ST.pay_type_tag(SI.orders(spark, d).where("o_custkey % 10 = 7"), "o_custkey", "o_orderpriority", attribute_rules(tags, 356))
    added = changed.select((-F.col("c_custkey")).alias("userId"), F.lit("added").alias("segment"))
    delta = moved.join(paid, "userId", "left").unionByName(added.withColumn("payment", F.lit(None).cast("string")))
    BS.upsert_store(delta, base)
    return base


def q_delta_upsert(spark, d):
    """The newest version after a delta was merged bucket by bucket."""
    return BS.read_store(spark, _store_with_delta(spark, d)).select("userId", "segment", "payment")


def q_keyed_look_up(spark, d):
    """The profile rows of the customers with an order above 480,000, read
    from their buckets alone."""
    o = load_table(spark, d, "orders", ["o_custkey", "o_totalprice"])
    keys = o.where(F.col("o_totalprice") > 480000).select(F.col("o_custkey").alias("userId"))
    return BS.look_up(spark, _store_with_delta(spark, d), keys).select("userId", "segment", "payment")


def q_rfm_daily_state(spark, d):
    """RFM metrics of the last 90 days from a state refreshed four times, a
    day at a time."""
    store, orders = D.DailyStore(spark, work_path(spark, "daily-orders")), SI.orders(spark, d)
    cols = ("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    eve = SI.ORDERS_AS_OF - dt.timedelta(days=1)
    D.start_state(store, orders, eve - dt.timedelta(days=REFRESHES), LOOKBACK, *cols)
    for i in range(REFRESHES - 1, -1, -1):
        D.advance_state(store, orders, eve - dt.timedelta(days=i), LOOKBACK, *cols)
    return D.state_metrics(store, eve).withColumn("monetary", F.col("monetary").cast("double"))


def q_rfe_page_sketch(spark, d):
    """Visits and distinct pages of the last 14 days from daily sketches,
    beside the exact number of pages: whether the estimate is within four
    standard errors (and one page) of it."""
    store, logs = D.DailyStore(spark, work_path(spark, "daily-pages")), SI.logs(spark, d)
    cols = ("user_id", "loc_url", "ts")
    eve = SI.EVENTS_AS_OF - dt.timedelta(days=1)
    D.start_pages(store, logs, eve - dt.timedelta(days=PAGE_WINDOW + 2), eve - dt.timedelta(days=2), *cols)
    for i in (1, 0):
        D.add_page_day(store, logs, eve - dt.timedelta(days=i), *cols)
    estimate = D.page_metrics(store, eve, PAGE_WINDOW)
    window = D.rows_of_days(logs, "ts", eve - dt.timedelta(days=PAGE_WINDOW - 1), eve)
    exact = window.groupBy(F.col("user_id").alias("userId")).agg(F.count_distinct("loc_url").alias("pages"))
    error = F.abs(F.col("engagements") - F.col("pages"))
    return estimate.join(exact, "userId").select(
        "userId", "recency", "frequency", "pages", (error <= 4 * 1.04 / 2 ** (D.SKETCH_BITS / 2) * F.col("pages") + 1).alias("within"))


def _rfm_metrics(spark, d):
    m = X.rfm_metrics(SI.orders(spark, d), "o_custkey", "o_orderkey", "o_totalprice", "o_orderdate", OAS)
    return m.withColumn("monetary", F.col("monetary").cast("double"))


def q_rfm_fitted_scores(spark, d):
    """RFM scores with bands cut at the data's own quintiles."""
    m = cut_lineage(_rfm_metrics(spark, d))
    return X.rfm_scores(m, R.fit_bands(m, RFM_UP))


def q_rfe_fitted_scores(spark, d):
    """RFE scores with bands cut at the data's own quintiles."""
    m = cut_lineage(X.rfe_metrics(SI.logs(spark, d), "user_id", "loc_url", "ts", EAS))
    return X.rfe_scores(m, R.fit_bands(m, RFE_UP))


def q_order_quantiles(spark, d):
    """Exact quantiles of the order totals, a value per order nearly."""
    o = load_table(spark, d, "orders", ["o_totalprice"])
    shares = [i / 20 for i in range(1, 20)]
    cuts = R.quantiles(o, "o_totalprice", shares)
    held = local_frame(spark, list(zip(shares, cuts)), "share double, cut double")
    below = o.join(F.broadcast(held), F.col("o_totalprice") <= F.col("cut"))  # 19 rows
    return below.groupBy("share", "cut").agg(F.count(F.lit(1)).alias("orders"))


def q_spend_ranks(spark, d):
    """Users ranked by their total spend, a continuous value, and the best
    tenth of them."""
    return X.value_ranks(_rfm_metrics(spark, d).select("userId", "monetary"), top_share=0.1, value_col="monetary")


def q_ordered_users(spark, d):
    """The position of every user in the order by segment, balance (highest
    first) and key."""
    u = load_table(spark, d, "customer", ["c_custkey", "c_mktsegment", "c_acctbal"])
    return R.number_rows(u, [F.col("c_mktsegment").asc(), F.col("c_acctbal").desc(), F.col("c_custkey").asc()])


def q_heavy_parts(spark, d):
    """The parts with the most order lines, found from a bounded summary."""
    return R.top_values(load_table(spark, d, "lineitem", ["l_partkey"]), "l_partkey", TOP_PARTS)


# the reference's penalty, under which the best model is a constant, and a lighter one
LOGREG_SETTINGS = {"reference": {}, "light": {"regParam": 0.01, "elasticNetParam": 0.5}}
TUNED = [{"regParam": 0.3, "elasticNetParam": 0.8}, {"regParam": 0.01, "elasticNetParam": 0.5}]
FOLDS = 3
SPLIT_KEYS = ["l_orderkey", "l_linenumber"]
SEGMENTS, LLOYD_STEPS = 5, 20


def _embeddings(spark, d):
    return load_table(spark, d, "embeddings", ["vec_id", "embedding", "label"])


def q_logreg_certificate(spark, d):
    """The classifier trained to convergence under two penalties: whether
    every coefficient and intercept satisfies the optimality condition, and
    whether the model beats the best constant prediction."""
    train = E.hash_split(_embeddings(spark, d), ["vec_id"], method="md5").where("is_train")
    out = None
    for name, params in LOGREG_SETTINGS.items():
        model, data = E.train_classifier(train, "embedding", "label", {**params, "maxIter": 500, "tol": 1e-10})
        ready = cut_lineage(model.transform(data).select("label_idx", "features"))
        worst, last = C.logistic_residuals(ready, model.stages[-1]).agg(F.max("residual"), F.max("feature")).first()
        row = C.log_loss(ready, model.stages[-1]).select(
            F.lit(name).alias("setting"), "rows", "classes", F.lit(last + 1).cast("int").alias("features"),
            F.round("constant_loss", 6).alias("constant_loss"), F.lit(worst <= 1e-5).alias("optimal"),
            (F.col("log_loss") < F.col("constant_loss") - 0.01).alias("beats_constant"))
        out = row if out is None else out.unionByName(row)
    return out


def q_tree_certificate(spark, d):
    """The inner nodes of the shopping-gender tree with the weight that
    reaches them, the gain of the chosen split, and whether no split has more."""
    model, indexer, _, hist = U.train_gender_tree(SI.noisy_goods(spark, d), SPLIT_KEYS, evaluate=False, method="md5")
    got = C.split_certificate(indexer.transform(hist.where("is_train")), C.tree_splits(model), 2)
    return got.select("node", "rows", F.round("gain", 6).alias("gain"), (F.abs(F.col("gain") - F.col("best_gain")) <= 1e-9).alias("best"))


def q_kmeans_centers(spark, d):
    """The customer-value centres from data-driven seeds, in seed order, and
    the residual of one more step."""
    cols = ["r_score", "f_score", "m_score"]
    m = cut_lineage(_rfm_metrics(spark, d))
    hist = cut_lineage(S.score_histogram(X.rfm_scores(m, R.fit_bands(m, RFM_UP)), cols))
    centers, _ = L.fit_lloyd(hist, cols, SEGMENTS, LLOYD_STEPS)
    residual = L.lloyd_residual(hist, cols, centers)
    held = local_frame(spark, [(i, *c) for i, c in enumerate(centers)], "prediction int, r double, f double, m double")
    users = S.nearest_center(hist, cols, centers).groupBy("prediction").agg(F.sum("n").alias("users"))
    return held.join(users, "prediction").withColumn("fixed", F.lit(residual == 0.0))


def q_tuning_folds(spark, d):
    """Held-out rows of each candidate, fold and label index, from the
    candidates' confusion matrices, and whether the chosen candidate is one
    that no other exceeds in accuracy over the same rows."""
    confusions = T.fold_confusions(_embeddings(spark, d), "embedding", "label", ["vec_id"], TUNED, FOLDS)
    best, _ = T.best_candidate(confusions, TUNED)
    hits = {r.candidate: r.hits for r in confusions.groupBy("candidate").agg(
        F.sum(F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(0)).alias("hits")).collect()}  # a row per candidate
    return confusions.groupBy("candidate", "fold", "l").agg(F.sum("n").alias("rows")).withColumn(
        "best_chosen", F.lit(hits[TUNED.index(best)] == max(hits.values())))


STATE_QUERIES = {
    "delta_upsert": q_delta_upsert,
    "keyed_look_up": q_keyed_look_up,
    "rfm_daily_state": q_rfm_daily_state,
    "rfe_page_sketch": q_rfe_page_sketch,
    "rfm_fitted_scores": q_rfm_fitted_scores,
    "rfe_fitted_scores": q_rfe_fitted_scores,
    "order_quantiles": q_order_quantiles,
    "spend_ranks": q_spend_ranks,
    "ordered_users": q_ordered_users,
    "heavy_parts": q_heavy_parts,
    "logreg_certificate": q_logreg_certificate,
    "tree_certificate": q_tree_certificate,
    "kmeans_centers": q_kmeans_centers,
    "tuning_folds": q_tuning_folds,
}
