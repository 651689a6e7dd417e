import tempfile

import pytest
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.sql import functions as F

from tagsmith.operators.match import match_tag
from tagsmith.operators.segment import assemble
from tagsmith.operators.stats import pay_type_tag
from tagsmith.plans.catalog import ALL_TAGS, attribute_rules
from tagsmith.plans.run import run_and_save
from tagsmith.sources.catalog_source import read_catalog, read_dimension
from tagsmith.sources.files import read_csv
from tagsmith.sources.store import load_or_train, read_profile
from conftest import SF_SMALL


def _scratch():
    return tempfile.mkdtemp(prefix="tagsmith-test-")


def test_catalog_and_dimension_from_files(spark):
    d = _scratch()
    spark.createDataFrame([(t[0], t[1], t[2], t[3], t[4]) for t in ALL_TAGS],
                          "id int, name string, rule string, level string, pid int") \
        .write.parquet(f"{d}/tags")
    tags = read_catalog(spark, "parquet", path=f"{d}/tags")
    assert dict(tags.dtypes) == {"id": "bigint", "name": "string", "rule": "string", "level": "int", "pid": "bigint"}
    assert attribute_rules(tags, 356).count() == 4
    spark.createDataFrame([("1", "red"), ("2", "blue")], "cid string, cname string").write.parquet(f"{d}/colors")
    dim = read_dimension(spark, "parquet", path=f"{d}/colors", id_col="cid", name_col="cname")
    assert sorted(dim.collect()) == [(1, "red"), (2, "blue")]


def test_read_csv_explicit_schema(spark):
    d = _scratch()
    with open(f"{d}/iris.csv", "w") as f:
        f.write("5.1,3.5,1.4,0.2,setosa\n6.2,2.9,4.3,1.3,versicolor\nbad,row\n")
    schema = "sepal_length double, sepal_width double, petal_length double, petal_width double, category string"
    df = read_csv(spark, f"{d}/iris.csv", schema)
    rows = df.collect()
    assert len(rows) == 3 and rows[0].category == "setosa" and rows[2].sepal_length is None


def test_run_and_save_versions(spark, tags):
    base = _scratch() + "/profile"
    v1 = run_and_save(spark, tags, 390, SF_SMALL,
                      lambda b, r: match_tag(b, "c_custkey", "c_mktsegment", r, "segment"), base, "1")
    v2 = run_and_save(spark, tags, 356, SF_SMALL,
                      lambda b, r: pay_type_tag(b, "o_custkey", "o_orderpriority", r), base, "2", previous="1")
    p1, p2 = read_profile(spark, base, "1"), read_profile(spark, base, "2")
    assert v1.endswith("version=1") and v2.endswith("version=2")
    assert p1.columns == ["userId", "segment"] and set(p2.columns) == {"userId", "segment", "payment"}
    # the upsert keeps every old user and their segment
    assert p2.where(F.col("segment").isNotNull()).count() == p1.count()
    assert p2.select("userId").distinct().count() == p2.count()
    with pytest.raises(Exception):  # a version is never overwritten
        run_and_save(spark, tags, 390, SF_SMALL,
                     lambda b, r: match_tag(b, "c_custkey", "c_mktsegment", r, "segment"), base, "1")


def test_load_or_train(spark):
    path = _scratch() + "/km"
    df = assemble(spark.createDataFrame([(float(i % 5), float(i % 3)) for i in range(50)], "a double, b double"),
                  ["a", "b"])
    calls = []

    def train():
        calls.append(1)
        return KMeans(k=2, seed=1).fit(df)

    m1 = load_or_train(path, KMeansModel, train)
    m2 = load_or_train(path, KMeansModel, train)
    assert len(calls) == 1
    assert [list(c) for c in m1.clusterCenters()] == [list(c) for c in m2.clusterCenters()]


def test_half_written_version_is_rewritten(spark):
    import os
    base = _scratch() + "/profile"
    os.makedirs(f"{base}/version=7/_temporary/0")  # what a job killed mid-write leaves
    from tagsmith.sources.store import write_profile
    df = spark.createDataFrame([(1, "a")], "userId long, t string")
    write_profile(df, base, "7", buckets=2)
    assert read_profile(spark, base, "7").count() == 1
    with pytest.raises(FileExistsError):
        write_profile(df, base, "7")


def test_a_failing_check_does_not_overwrite(spark, monkeypatch):
    from tagsmith.sources import store
    base = _scratch() + "/profile"
    store.write_profile(spark.createDataFrame([(1, "a")], "userId long, t string"), base, "1")

    def denied(*_):
        raise PermissionError("no access")
    monkeypatch.setattr(store, "path_exists", denied)
    with pytest.raises(PermissionError):
        store.write_profile(spark.createDataFrame([(2, "b")], "userId long, t string"), base, "1")
    assert [tuple(r) for r in read_profile(spark, base, "1").collect()] == [(1, "a")]


def test_data_without_the_commit_marker_is_not_committed(spark):
    import os
    from tagsmith.sources.store import is_committed, write_profile
    base = _scratch() + "/profile"
    path = write_profile(spark.createDataFrame([(1, "a")], "userId long, t string"), base, "1")
    assert is_committed(spark, path)
    os.remove(f"{path}/_SUCCESS")
    assert not is_committed(spark, path) and not is_committed(spark, f"{base}/none")


def test_bucketed_profile_upsert_shuffles_only_new_side(spark):
    from plan_util import exchange_children, plan_text
    from tagsmith.operators.profile import profile_upsert
    from tagsmith.plans.run import upsert_profile_table
    from tagsmith.sources.store import attach_profile_table, write_profile_table
    d = _scratch()
    old = spark.range(0, 2000).selectExpr("id AS userId", "CAST(id % 7 AS STRING) AS a", "CAST(id % 5 AS STRING) AS b")
    write_profile_table(old, "tp_v1", f"{d}/v1", buckets=8)
    new = spark.range(1000, 3000).selectExpr("id AS userId", "CAST(id % 3 AS STRING) AS b")
    plan = plan_text(profile_upsert(spark.table("tp_v1"), new))
    assert len(exchange_children(plan)) == 1  # only the new tag result moves
    upsert_profile_table(new, "tp_v1", "tp_v2", f"{d}/v2", buckets=8)
    v2 = spark.table("tp_v2")
    assert v2.count() == 3000
    row = v2.where("userId = 1500").first()
    assert (row.a, row.b) == (str(1500 % 7), str(1500 % 3))
    with pytest.raises(FileExistsError):
        write_profile_table(old, "tp_v1", f"{d}/v1b", buckets=8)
    again = attach_profile_table(spark, "tp_v2_copy", f"{d}/v2", "userId BIGINT, a STRING, b STRING", buckets=8)
    assert again.count() == 3000
    assert len(exchange_children(plan_text(profile_upsert(again, new)))) == 1


def test_readme_usage_flow(spark):
    """The README's usage example, on local files: catalogue from storage,
    a rule-driven match tag, payment and RFM tags on epoch-text orders, and a
    bucketed profile upsert."""
    import datetime as dt
    from tagsmith.operators import (match_tag, pay_type_tag, profile_wide, rfm_metrics, rfm_scores,
                                    segment_by_kmeans)
    from tagsmith.plans.catalog import ALL_TAGS
    from tagsmith.plans.run import run_tag
    from tagsmith.sources import load_table
    from tagsmith.plans.run import upsert_profile_table
    d = _scratch()
    users = spark.createDataFrame([(str(i), str(1 + i % 3)) for i in range(60)], "id string, gender string")
    users.write.parquet(f"{d}/users")
    rows = [r if r[0] != 318 else (318, "gender", f"inType=parquet\npath={d}/users\nselectFieldNames=id,gender", 4, 314)
            for r in ALL_TAGS]
    spark.createDataFrame(rows, "id long, name string, rule string, level int, pid long").write.parquet(f"{d}/tags")
    tags = read_catalog(spark, "parquet", path=f"{d}/tags")
    epoch = lambda day: str(int(dt.datetime(2024, 5, day, tzinfo=dt.timezone.utc).timestamp()))
    orders = spark.createDataFrame(
        [(str(i % 60), f"o{i}", f"{(i * 37) % 5000}.50", epoch(1 + i % 28), ["alipay", "wxpay", "cod"][i % 3])
         for i in range(600)], "memberid string, ordersn string, orderamount string, finishtime string, "
                               "paymentcode string")
    orders.write.parquet(f"{d}/orders.parquet")
    orders = load_table(spark, d, "orders", ["memberid", "ordersn", "orderamount", "finishtime", "paymentcode"])

    gender = run_tag(spark, tags, 318, base_dir=None,
                     tagger=lambda u, rules: match_tag(u, "id", "gender", rules, "gender"))
    payment = pay_type_tag(orders, "memberid", "paymentcode", attribute_rules(tags, 356))
    scores = rfm_scores(rfm_metrics(orders, "memberid", "ordersn", "orderamount", "finishtime", "2024-06-01"))
    value = segment_by_kmeans(scores, ["r_score", "f_score", "m_score"], attribute_rules(tags, 361), "rfm")
    spark.createDataFrame([("0", "old")], "userId string, note string") \
        .write.bucketBy(4, "userId").option("path", f"{d}/p0").saveAsTable("readme_profile_0")
    upsert_profile_table(profile_wide([gender, payment, value]), "readme_profile_0", "readme_profile_1",
                         f"{d}/p1", buckets=4)
    p = spark.table("readme_profile_1")
    assert p.count() == 60 and set(p.columns) == {"userId", "note", "gender", "payment", "rfm"}
    assert p.where("userId = '0'").first().note == "old"


def test_jdbc_catalog_lookup_is_pushed_as_a_query():
    from tagsmith.sources.catalog_source import jdbc_catalog_options
    opts = jdbc_catalog_options({"url": "jdbc:x", "dbtable": "tag_catalogue"}, 356)
    assert "dbtable" not in opts and opts["url"] == "jdbc:x"
    assert opts["query"] == "SELECT id, name, rule, level, pid FROM tag_catalogue WHERE id = 356 OR pid = 356"
    assert jdbc_catalog_options({"dbtable": "t"}, None) == {"dbtable": "t"}
