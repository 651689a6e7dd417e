"""Delta upserts, daily state, total order, heavy hitters, the model store and
model certificates: brute force, edge rows, files touched and plans."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from plan_util import plan_text
from tagsmith.operators.lineage import cut_lineage

DAY = dt.date(2024, 3, 1)


# ---- bucket store --------------------------------------------------------

@pytest.fixture()
def store(spark, tmp_path):
    from tagsmith.sources.bucket_store import create_store
    base = str(tmp_path / "profile")
    df = spark.range(500).selectExpr("id AS userId", "concat('s', id % 5) AS seg").unionByName(
        spark.sql("SELECT CAST(NULL AS BIGINT) AS userId, 'lost' AS seg UNION ALL SELECT 3L, 's9'"))
    assert create_store(df, base, buckets=16) == 0
    return base


def test_delta_upsert_rewrites_touched_buckets_only(spark, store):
    from tagsmith.sources.bucket_store import bucket_paths, read_store, upsert_store
    before = bucket_paths(spark, store)
    files = {b: sorted(spark.read.parquet(p).inputFiles()) for b, p in before.items()}
    delta = spark.createDataFrame([(3, None, "card"), (7, "new", None), (9000, "n", "cash"), (7, "old", "x"), (None, "z", "z")],
                                  "userId long, seg string, pay string")
    assert upsert_store(delta, store) == 1
    after = bucket_paths(spark, store)
    changed = [b for b in after if after[b] != before.get(b)]
    assert 1 <= len(changed) <= 3
    assert all(sorted(spark.read.parquet(after[b]).inputFiles()) == files[b] for b in after if b not in changed)
    got = {r.userId: (r.seg, r.pay) for r in read_store(spark, store).collect()}
    want = {i: (f"s{i % 5}", None) for i in range(500)} | {3: ("s9", "card"), 7: ("old", "x"), 9000: ("n", "cash")}
    assert got == want
    assert read_store(spark, store, version=0).columns == ["userId", "seg"] and read_store(spark, store, version=0).count() == 500
    assert upsert_store(delta.limit(0), store) == 1  # nothing to publish
    with pytest.raises(TypeError):
        upsert_store(spark.sql("SELECT 1L AS userId, 2 AS seg"), store)


def test_a_failed_or_losing_upsert_changes_nothing(spark, store, monkeypatch):
    from tagsmith.sources import bucket_store
    from tagsmith.sources.commits import ConcurrentCommit, commits, publish
    delta = spark.sql("SELECT 3L AS userId, 'x' AS seg")

    def broken(*args):
        raise OSError("disk")
    with monkeypatch.context() as m:
        m.setattr(bucket_store, "publish", broken)
        with pytest.raises(OSError):
            bucket_store.upsert_store(delta, store)
    assert commits(spark, store) == [0]
    with monkeypatch.context() as m:  # another writer publishes version 1 first
        def late(spark_, base, content, version):
            publish(spark_, base, bucket_store._state(spark_, base, None) | {"folders": content["folders"]}, version)
            return publish(spark_, base, content, version)
        m.setattr(bucket_store, "publish", late)
        with pytest.raises(ConcurrentCommit):
            bucket_store.upsert_store(delta, store)
    assert commits(spark, store) == [0, 1]


def test_look_up_reads_the_buckets_of_the_keys(spark, store):
    from tagsmith.sources.bucket_store import bucket_paths, look_up
    keys = spark.createDataFrame([(3,), (4,), (3,), (None,), (99999,)], "userId long")
    got = look_up(spark, store, keys)
    assert sorted(map(tuple, got.collect())) == [(3, "s9"), (4, "s4")]
    assert len(got.inputFiles()) <= 3 < len(bucket_paths(spark, store))
    assert look_up(spark, store, keys.limit(0)).collect() == []


def test_bucketed_table_prunes_buckets_for_a_key_list(spark, tmp_path):
    from tagsmith.sources.store import write_profile_table
    write_profile_table(spark.range(2000).selectExpr("id AS userId", "id % 3 AS seg"), "looked_up", str(tmp_path / "t"), buckets=32)
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # so that the plan names the buckets
    try:
        some = spark.table("looked_up").where(F.col("userId").isin([5, 6, 1234]))
        plan = plan_text(some)
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 3 out of 32" in plan or "SelectedBucketsCount: 2 out of 32" in plan
    assert sorted(r.userId for r in some.collect()) == [5, 6, 1234]
    spark.sql("DROP TABLE looked_up")


# ---- daily state ---------------------------------------------------------

ORDER_COLS = ("u", "sn", "amt", "t")


def made_orders(spark, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(1200):
        user = 0 if i % 3 == 0 else rng.choice([None, *range(1, 60)])
        when = dt.datetime(2024, 2, 1) + dt.timedelta(minutes=rng.randrange(45 * 1440))
        rows.append((user, rng.choice([f"o{i}", f"o{i}", None]), rng.choice(["12.50", "0.1", "n/a", None, "7"]), None if i % 50 == 0 else when))
    rows += [(77, "a", "5", dt.datetime(2024, 2, 21, 0, 0)), (78, "b", "5", dt.datetime(2024, 2, 20, 23, 59, 59)), (79, "c", "x", dt.datetime(2024, 3, 5))]
    return spark.createDataFrame(rows, "u long, sn string, amt string, t timestamp_ntz")


def test_daily_state_equals_recomputation(spark, tmp_path):
    from tagsmith.operators import daily as D
    from tagsmith.operators.rfx import rfm_metrics
    orders, back = cut_lineage(made_orders(spark)), 12
    store = D.DailyStore(spark, str(tmp_path / "daily"))
    D.start_state(store, orders, DAY, back, *ORDER_COLS)
    D.start_state(store, orders, DAY, back, *ORDER_COLS)  # once is enough
    for i in range(1, 6):
        day = DAY + dt.timedelta(days=i)
        D.advance_state(store, orders, day, back, *ORDER_COLS)
        D.advance_state(store, orders.limit(0), day, back, *ORDER_COLS)  # repeating a day changes nothing
        got = D.state_metrics(store, day)
        want = rfm_metrics(orders, *ORDER_COLS, day + dt.timedelta(days=1), lookback_days=back)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), day
    with pytest.raises(FileNotFoundError):
        D.advance_state(store, orders, DAY + dt.timedelta(days=9), back, *ORDER_COLS)


def test_a_refresh_reads_only_the_new_day(spark, tmp_path):
    from tagsmith.operators import daily as D
    path = str(tmp_path / "orders")
    made_orders(spark).write.parquet(path)
    part = D.order_partials(spark.read.parquet(path), *ORDER_COLS, DAY, DAY)
    plan = plan_text(part)
    assert "GreaterThanOrEqual(t,2024-03-01T00:00)" in plan and "LessThan(t,2024-03-02T00:00)" in plan
    store = D.DailyStore(spark, str(tmp_path / "daily"))
    orders = spark.read.parquet(path)
    D.start_state(store, orders, DAY, 5, *ORDER_COLS)
    next_day = DAY + dt.timedelta(days=1)
    only_new = orders.where(F.to_date("t") == F.lit(next_day))  # history is gone
    D.advance_state(store, only_new, next_day, 5, *ORDER_COLS)
    from tagsmith.operators.rfx import rfm_metrics
    want = rfm_metrics(orders, *ORDER_COLS, next_day + dt.timedelta(days=1), lookback_days=5)
    assert sorted(map(str, D.state_metrics(store, next_day).collect())) == sorted(map(str, want.collect()))


def test_a_half_written_state_is_written_again(spark, tmp_path):
    import os
    from tagsmith.operators import daily as D
    store = D.DailyStore(spark, str(tmp_path / "daily"))
    D.start_state(store, made_orders(spark), DAY, 5, *ORDER_COLS)
    whole = D.state_metrics(store, DAY).count()
    os.remove(store.path("state", DAY) + "/_SUCCESS")
    assert not store.has("state", DAY)
    D.start_state(store, made_orders(spark), DAY, 5, *ORDER_COLS)
    assert D.state_metrics(store, DAY).count() == whole


def test_page_sketches_stay_within_their_bound(spark, tmp_path):
    from tagsmith.operators import daily as D
    rng = random.Random(2)
    rows = [(u, f"p{rng.randrange(n)}", dt.datetime(2024, 3, 1) + dt.timedelta(minutes=rng.randrange(6 * 1440)))
            for u, n in ((1, 5), (2, 400), (3, 20000)) for _ in range(3 * n)]
    rows += [(4, None, dt.datetime(2024, 3, 6)), (5, "p", None)]
    logs = spark.createDataFrame(rows, "u long, url string, t timestamp_ntz")
    store = D.DailyStore(spark, str(tmp_path / "pages"))
    D.start_pages(store, logs, dt.date(2024, 2, 28), dt.date(2024, 3, 4), "u", "url", "t")
    for d in (5, 6):
        D.add_page_day(store, logs, dt.date(2024, 3, d), "u", "url", "t")
    got = {r.userId: r for r in D.page_metrics(store, dt.date(2024, 3, 6), 4).collect()}
    seen, visits = defaultdict(set), Counter()
    for u, url, t in rows:
        if t and t >= dt.datetime(2024, 3, 3) and url:
            seen[u].add(url)
            visits[u] += 1
    assert set(got) == {1, 2, 3, 4} and got[4].engagements == 0
    for u in (1, 2, 3):
        assert got[u].frequency == visits[u]
        assert abs(got[u].engagements - len(seen[u])) <= 4 * 1.04 / 2 ** (D.SKETCH_BITS / 2) * len(seen[u])
    with pytest.raises(FileNotFoundError):
        D.page_metrics(store, dt.date(2024, 3, 8), 4)


# ---- total order ---------------------------------------------------------

def test_ranks_and_positions(spark):
    from tagsmith.operators.ranks import number_rows, rank_by
    rng = random.Random(0)
    rows = [(i, 5.0 if i % 3 == 0 else rng.choice([None, float("inf"), rng.random(), float(rng.randrange(9))])) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, v double").repartition(7)
    values = sorted((v for _, v in rows if v is not None), reverse=True)
    got = {r.id: (r.rank, r.n) for r in rank_by(df, "v", total_out="n").collect()}
    assert got == {i: (values.index(v) + 1 if v is not None else None, len(values)) for i, v in rows}
    placed = [r.id for r in number_rows(df, [F.col("v").asc_nulls_last(), F.col("id").desc()]).orderBy("position").collect()]
    assert placed == [i for i, v in sorted(rows, key=lambda r: (r[1] is None, r[1] or 0.0, -r[0]))]
    assert rank_by(df.limit(0), "v").collect() == []


def test_no_window_over_all_rows(spark):
    from tagsmith.operators.ranks import rank_by, running_total, value_counts_of
    from tagsmith.operators.rfx import value_ranks
    df = spark.range(5000).selectExpr("id AS userId", "rand(3) AS value")
    placed, total = running_total(value_counts_of(df, ["value"]), [F.col("value").desc()])
    assert total == 5000
    for frame in (placed, rank_by(df, "value"), value_ranks(df)):
        assert "SinglePartition" not in plan_text(frame)


@pytest.mark.parametrize("shares", [[0.2, 0.4, 0.6, 0.8], [0.01, 0.5, 1.0]])
def test_quantiles_are_exact(spark, shares):
    import duckdb
    from tagsmith.operators.ranks import quantiles
    rng = random.Random(len(shares))
    for n in (1, 5, 10, 333):
        values = [rng.choice([1.5, 1.5, rng.random() * 100]) for _ in range(n)] + [None]
        df = spark.createDataFrame([(v,) for v in values], "v double")
        con = duckdb.connect()
        con.execute("CREATE TABLE t (v DOUBLE)")
        con.executemany("INSERT INTO t VALUES (?)", [(v,) for v in values])
        want = con.execute("SELECT " + ", ".join(f"quantile_disc(v, {q})" for q in shares) + " FROM t").fetchall()[0]
        assert quantiles(df, "v", shares) == list(want)
    assert quantiles(df.limit(0), "v", shares) == [None] * len(shares)


def test_fitted_bands(spark):
    from tagsmith.operators.ranks import fit_bands
    df = spark.createDataFrame([(i, 1.0 if i < 70 else float(i), None) for i in range(100)], "r long, f double, m double")
    bands = fit_bands(df, {"r": False, "f": True, "m": True})
    assert bands["r"].uppers == (19, 39, 59, 79) and bands["r"].scores == (5, 4, 3, 2, 1)
    assert bands["f"].uppers == (1.0, 79.0) and bands["f"].scores == (1, 4, 5)  # equal cuts are one
    assert bands["m"].uppers == ()


def test_top_values_are_exact(spark):
    from tagsmith.operators.ranks import top_values
    rng = random.Random(9)
    values = [rng.randrange(3000) if rng.random() < .5 else int(rng.paretovariate(.6)) for _ in range(9000)] + [None] * 4000
    df = spark.createDataFrame([(v,) for v in values], "v long")
    want = sorted(Counter(v for v in values if v is not None).items(), key=lambda x: (-x[1], x[0]))
    for k, slots in ((1, 16), (10, 64), (10, 65536), (50, 7)):
        assert [tuple(r) for r in top_values(df, "v", k, slots).collect()] == want[:k]
    assert [tuple(r) for r in top_values(df.where("v < 2"), "v", 10).collect()] == [w for w in want if w[0] < 2]
    assert top_values(df.limit(0), "v", 3).collect() == []


# ---- model store ---------------------------------------------------------

def a_model(spark, k=2):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(spark.range(20).selectExpr("CAST(id AS DOUBLE) AS x"))
    return KMeans(k=k, seed=1).fit(df)


def test_model_store(spark, tmp_path):
    from pyspark.ml.clustering import KMeansModel
    from tagsmith.sources.store import ForeignModel, load_model, load_or_train, save_model
    base = str(tmp_path / "models")

    class Broken:
        def write(self):
            model = a_model(spark)

            class Writer:
                def save(self, path):
                    model.write().save(path)
                    raise OSError("lost after the files were written")
            return Writer()
    with pytest.raises(OSError):
        load_or_train(base, KMeansModel, Broken, {"k": 2})
    assert load_model(base, KMeansModel) is None  # half-written: never used
    first = load_or_train(base, KMeansModel, lambda: a_model(spark), {"k": 2}, lambda: {"rows": 20})
    again = load_or_train(base, KMeansModel, lambda: pytest.fail("trained twice"), {"k": 2})
    assert [c.tolist() for c in first.clusterCenters()] == [c.tolist() for c in again.clusterCenters()]
    with pytest.raises(ForeignModel):
        load_or_train(base, KMeansModel, lambda: a_model(spark, 3), {"k": 3})
    assert save_model(a_model(spark, 3), base, {"k": 3}) == 1
    assert len(load_model(base, KMeansModel, {"k": 3}).clusterCenters()) == 3
    assert len(load_model(base, KMeansModel, version=0).clusterCenters()) == 2


def test_the_faster_trainer_wins(spark, tmp_path):
    from pyspark.ml.clustering import KMeansModel
    from tagsmith.sources.store import load_or_train, save_model
    base = str(tmp_path / "models")

    def train():
        save_model(a_model(spark, 3), base)  # meanwhile another trainer publishes
        return a_model(spark, 2)
    assert len(load_or_train(base, KMeansModel, train).clusterCenters()) == 3


# ---- certificates --------------------------------------------------------

def labelled(spark, classes, n=300):
    rng = random.Random(classes)
    rows = [(i % classes, [rng.gauss(i % classes, 1.0), rng.gauss(0, 1), 3.0, rng.gauss(-(i % classes), 2.0)]) for i in range(n)]
    return spark.createDataFrame(rows, "label int, x array<double>")


@pytest.mark.parametrize("classes", [2, 4])
def test_logistic_certificate(spark, classes):
    from tagsmith.operators.certify import log_loss, logistic_residuals
    from tagsmith.operators.evaluate import train_classifier
    df = labelled(spark, classes)

    def worst(model, data):
        ready = model.transform(data).select("label_idx", "features")
        return logistic_residuals(ready, model.stages[-1]).agg(F.max("residual")).first()[0], log_loss(ready, model.stages[-1]).first()
    good, data = train_classifier(df, "x", "label", {"regParam": 0.02, "elasticNetParam": 0.5, "maxIter": 500, "tol": 1e-10})
    residual, loss = worst(good, data)
    assert residual < 1e-5 and loss.log_loss < loss.constant_loss and loss.classes == classes
    early, data = train_classifier(df, "x", "label", {"regParam": 0.02, "elasticNetParam": 0.5, "maxIter": 1, "tol": 1e-10})
    assert worst(early, data)[0] > 1e-3  # not converged
    constant, data = train_classifier(df, "x", "label", {"regParam": 50.0, "elasticNetParam": 1.0, "maxIter": 500, "tol": 1e-10})
    constant.stages[-1]._set(regParam=0.02, elasticNetParam=0.5)  # a constant prediction is wrong for this penalty
    assert worst(constant, data)[0] > 1e-2


def test_lloyd_does_not_depend_on_partitions(spark):
    from tagsmith.operators.lloyd import fit_lloyd, lloyd_residual, seed_centers
    rng = random.Random(8)
    rows = sorted({(rng.randrange(1, 6) / 4, float(rng.randrange(1, 6)), float(rng.randrange(1, 6))) for _ in range(110)})
    hist = spark.createDataFrame([(*r, rng.randrange(1, 900)) for r in rows], "r double, f double, m double, n long")
    cols = ["r", "f", "m"]
    found = [fit_lloyd(cut_lineage(hist.repartition(p)), cols, 5, 60) for p in (1, 8)]
    assert found[0] == found[1]
    centers, steps = found[0]
    assert steps < 60 and lloyd_residual(hist, cols, centers) == 0.0
    assert lloyd_residual(hist, cols, [(c[0] + 0.1, *c[1:]) for c in centers]) > 0.0
    assert lloyd_residual(hist, cols, [(1.0, 1.0, 1.0)] * 5) > 0.0
    few = hist.limit(2)
    assert len(seed_centers(few, cols, 5)) == 2  # no more centres than vectors
    assert fit_lloyd(hist.limit(0), cols, 3) == ([], 0)


def test_tree_certificate_turns_red_for_a_worse_tree(spark):
    from tagsmith.operators.certify import split_certificate, tree_splits
    from tagsmith.operators.shopper import fit_gender_tree
    rng = random.Random(4)
    rows = [(c, p, lab, True, rng.randrange(1, 200)) for c in range(6) for p in range(5) for lab in (0, 1)]
    hist = spark.createDataFrame(rows, "color int, product int, label int, is_train boolean, n long")
    model, indexer, _, held = fit_gender_tree(hist, evaluate=False)
    splits = tree_splits(model)
    feats = indexer.transform(held)
    got = {r.node: r for r in split_certificate(feats, splits, 2, order="count").collect()}
    assert len(got) == len(splits) > 3 and got[1].rows == sum(r[4] for r in rows)
    assert all(abs(r.gain - r.best_gain) < 1e-9 for r in got.values())
    best = {r.node: r.best_gain for r in split_certificate(feats, splits, 2).collect()}
    assert all(best[n] >= r.best_gain - 1e-12 for n, r in got.items())

    def brute(cells):  # the root's best gain over all subsets of each feature's categories
        gini = lambda n, k: 2 * k / n * (1 - k / n)
        total, ones = sum(c[4] for c in cells), sum(c[4] for c in cells if c[2])
        found = 0.0
        for f, size in ((0, 6), (1, 5)):
            for mask in range(1, 2 ** size - 1):
                left = [c for c in cells if mask >> c[f] & 1]
                n, k = sum(c[4] for c in left), sum(c[4] for c in left if c[2])
                found = max(found, gini(total, ones) - n / total * gini(n, k) - (total - n) / total * gini(total - n, ones - k))
        return found
    assert best[1] == pytest.approx(brute(rows), abs=1e-12)
    splits[0]["gain"] *= 0.9  # a root that states another gain
    worse = {r.node: r for r in split_certificate(feats, splits, 2, order="count").collect()}
    assert worse[1].best_gain - worse[1].gain > 1e-4
    splits[0]["left"] = [0.0, 1.0]  # another root split: the nodes below no longer fit
    wrong = {r.node: r for r in split_certificate(feats, splits, 2, order="count").collect()}
    assert any(abs(r.gain - r.best_gain) > 1e-6 for n, r in wrong.items() if n != 1)


def test_folds_with_a_class_met_only_in_validation(spark):
    from tagsmith.operators.tune import best_candidate, fold_confusions, fold_metrics, grid, hash_folds
    df = labelled(spark, 3, 240).withColumn("k", F.monotonically_increasing_id()).withColumn(
        "label", F.when(F.col("k") == F.lit(0), 9).otherwise(F.col("label")))
    candidates = grid((0.01, 50.0), (1.0,))
    confusions = fold_confusions(df, "x", "label", ["k"], candidates, folds=3)
    rows = {(r.candidate, r.fold): r.rows for r in fold_metrics(confusions).collect()}
    sizes = {r.fold: r["count"] for r in hash_folds(df, ["k"], 3).groupBy("fold").count().collect()}
    assert rows == {(c, f): n for c in (0, 1) for f, n in sizes.items()}
    rare = confusions.where("l = 3.0").collect()
    assert len(rare) == 2 and all(r.p != 3.0 for r in rare)  # counted, and missed
    best, found = best_candidate(confusions, candidates)
    assert best == candidates[0] and found[0]["accuracy"] > found[1]["accuracy"]
