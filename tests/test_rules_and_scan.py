import datetime as dt

import pytest
from pyspark.sql import functions as F

from tagsmith.functions.dates import window_bounds
from tagsmith.functions.rules import range_end, range_start, rule_options
from tagsmith.plans.catalog import attribute_rules, business_rule, tag_lookup
from tagsmith.sources.business import (
    business_scan, condition_filter, parse_condition, rolling_window, scan_options,
)
from conftest import SF_SMALL
from plan_util import plan_text


def test_rule_options_map(spark):
    df = spark.createDataFrame([("inType=parquet\ntable=orders\n\nselectFieldNames=a,b\n",)], "rule string")
    m = df.select(rule_options("rule").alias("m")).first()["m"]
    assert m == {"inType": "parquet", "table": "orders", "selectFieldNames": "a,b"}


def test_range_rules_parse_and_guard(spark):
    df = spark.createDataFrame([("19500101-19591231",), ("0-7",), ("-1",), ("abc",), (" 8 - 14 ",)], "rule string")
    got = [(r.s, r.e) for r in df.select(range_start("rule").alias("s"), range_end("rule").alias("e")).collect()]
    assert got == [(19500101, 19591231), (0, 7), (None, None), (None, None), (8, 14)]


def test_tag_lookup_and_children(spark, tags):
    rows = tag_lookup(tags, 356).collect()
    assert [r.id for r in rows] == [356, 357, 358, 359, 360]
    assert [r.level for r in rows] == [4, 5, 5, 5, 5]
    kids = attribute_rules(tags, 347).orderBy("id").collect()
    assert [k.rule for k in kids][:2] == ["0-7", "8-14"] and len(kids) == 8
    assert "selectFieldNames=o_custkey,o_orderpriority" in business_rule(tags, 356)
    with pytest.raises(ValueError):
        business_rule(tags, 319)


def test_scan_options_validation():
    assert scan_options("inType=parquet\nselectFieldNames=a")["inType"] == "parquet"
    with pytest.raises(ValueError):
        scan_options("inType=parquet\n")
    with pytest.raises(ValueError):
        scan_options("inType=parquet\nselectFieldNames=a\nbroken line")


def test_unknown_source_type_raises(spark):
    with pytest.raises(ValueError):
        business_scan(spark, {"inType": "hbase", "selectFieldNames": "a"}, SF_SMALL)


@pytest.mark.parametrize("text,expect", [
    ("modified[GE]20190601", ("modified", "ge", "20190601")),
    ("a[eq]x", ("a", "eq", "x")),
    (" b [Lt] 5 ", ("b", "lt", "5")),
    ("c[NE]1-URGENT", ("c", "ne", "1-URGENT")),
])
def test_parse_condition(text, expect):
    assert parse_condition(text) == expect


@pytest.mark.parametrize("bad", ["nobrackets", "a[XX]1", "[GE]1"])
def test_parse_condition_rejects(bad):
    with pytest.raises(ValueError):
        parse_condition(bad)


def test_condition_filter_all_ops_and_pushdown(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    conds = ["o_orderstatus[NE]P", "o_totalprice[GE]50000", "o_totalprice[le]450000",
             "o_orderdate[GT]1996-01-01", "o_orderdate[LT]2001-01-01", "o_orderpriority[EQ]1-URGENT"]
    got = condition_filter(o, conds)
    expect = o.where((F.col("o_orderstatus") != "P") & (F.col("o_totalprice") >= 50000)
                     & (F.col("o_totalprice") <= 450000)
                     & (F.col("o_orderdate") > F.lit("1996-01-01").cast("timestamp_ntz"))
                     & (F.col("o_orderdate") < F.lit("2001-01-01").cast("timestamp_ntz"))
                     & (F.col("o_orderpriority") == "1-URGENT"))
    assert sorted(got.collect()) == sorted(expect.collect())
    plan = plan_text(got)
    assert "PushedFilters: [" in plan and "GreaterThanOrEqual(o_totalprice,50000.0)" in plan


def test_window_bounds_units():
    as_of = dt.date(2001, 8, 2)
    assert window_bounds(30, "day", as_of) == (dt.date(2001, 7, 2), dt.date(2001, 8, 1))
    assert window_bounds(6, "month", as_of) == (dt.date(2001, 2, 2), dt.date(2001, 8, 1))
    assert window_bounds(1, "year", as_of) == (dt.date(2000, 8, 1), dt.date(2001, 8, 1))
    with pytest.raises(ValueError):
        window_bounds(1, "week", as_of)


def test_rolling_window_inclusive_edges(spark):
    rows = [(1, dt.datetime(2001, 7, 1, 23, 59)), (2, dt.datetime(2001, 7, 2, 0, 0)),
            (3, dt.datetime(2001, 8, 1, 23, 59)), (4, dt.datetime(2001, 8, 2, 0, 0))]
    df = spark.createDataFrame(rows, "k int, t timestamp_ntz")
    got = sorted(r.k for r in rolling_window(df, "t#day#30", "2001-08-02").collect())
    assert got == [2, 3]
    text = spark.createDataFrame([(1, "2001-07-01"), (2, "2001-07-02"), (3, "2001-08-01"), (4, "2001-08-02")],
                                 "k int, t string")
    assert sorted(r.k for r in rolling_window(text, "t#day#30", "2001-08-02").collect()) == [2, 3]


def test_business_scan_prunes_columns(spark):
    opts = scan_options("inType=parquet\ntable=orders\nselectFieldNames=o_custkey,o_orderpriority")
    df = business_scan(spark, opts, SF_SMALL)
    assert df.columns == ["o_custkey", "o_orderpriority"]
    plan = plan_text(df)
    assert "ReadSchema: struct<o_custkey:bigint,o_orderpriority:string>" in plan


def test_condition_filter_missing_values(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 1)], "k int, v int")
    assert sorted(r.k for r in condition_filter(df, "v[GE]2").collect()) == [1]
    assert sorted(r.k for r in condition_filter(df, "v[GE]2", keep_missing=True).collect()) == [1, 2]


def test_rolling_windows_single_scan_matches_separate(spark):
    from tagsmith.sources.business import rolling_windows
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_orderdate")
    specs = ["o_orderdate#day#30", "o_orderdate#month#6", "o_orderdate#year#1"]
    one = sorted((r.window, r.o_orderkey) for r in rolling_windows(o, specs, "2001-08-02").collect())
    sep = sorted((s, r.o_orderkey) for s in specs
                 for r in rolling_window(o, s, "2001-08-02").collect())
    assert one == sep and len(one) > 0
    tree = plan_text(rolling_windows(o, specs, "2001-08-02")).split("\n\n(1)")[0]
    assert tree.count("Scan parquet") == 1


@pytest.mark.parametrize("fmt", ["orc", "csv", "json", "table"])
def test_business_scan_every_input_type(spark, fmt):
    """The same rule over every supported source type returns the same rows
    (CSV without a schema gives all-string columns, as the reference's store
    did, and the conditions still apply)."""
    import tempfile
    d = tempfile.mkdtemp(prefix="tagsmith-scan-")
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderpriority")
    rule = "selectFieldNames=o_orderkey,o_orderpriority\nfilterConditions=o_orderpriority[EQ]1-URGENT"
    if fmt == "table":
        o.write.option("path", f"{d}/t").saveAsTable("scan_orders_t")
        rule = "inType=table\ntable=scan_orders_t\n" + rule
    else:
        writer = o.write.option("header", "true") if fmt == "csv" else o.write
        writer.format(fmt).save(f"{d}/orders.{fmt}")
        rule = f"inType={fmt}\ntable=orders\n" + rule
    got = business_scan(spark, scan_options(rule), d)
    expect = o.where("o_orderpriority = '1-URGENT'").select("o_orderkey", "o_orderpriority")
    norm = lambda df: sorted((int(r[0]), r[1]) for r in df.collect())
    assert norm(got) == norm(expect) and len(norm(expect)) > 0


def test_one_rule_parser(spark):
    from tagsmith.sources.business import scan_options
    text = " inType = parquet \r\n\n table=orders\nselectFieldNames=a,b\nwhereCondition=x=y"
    df = spark.createDataFrame([(text,)], "rule string")
    assert df.select(rule_options("rule").alias("m")).first()["m"] == scan_options(text)


def test_window_labels_tell_fields_apart(spark):
    import datetime as dt
    from tagsmith.sources.business import rolling_windows
    df = spark.createDataFrame([(dt.date(2020, 1, 20), dt.date(2019, 1, 1))], "a date, b date")
    assert [r.window for r in rolling_windows(df, ["a#day#30", "b#day#30"], "2020-01-31").collect()] == ["a#day#30"]


def test_size_check_moves_no_rows_to_one_task(spark):
    import contextlib
    import io
    from pyspark.sql import functions as F
    from tagsmith.operators.joins import has_at_most, row_bytes
    df = spark.range(0, 1000, 1, 8).withColumn("t", F.repeat(F.lit("x"), 100))
    assert has_at_most(df, 1000) and not has_at_most(df, 999) and not has_at_most(df, 1000, max_bytes=100_000)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.agg(F.count(F.lit(1)), F.sum(row_bytes(df))).explain()
    assert "Limit" not in buf.getvalue() and "partial_count" in buf.getvalue()


def test_literal_rows_are_measured_without_a_job(spark):
    from tagsmith.operators.joins import has_at_most, is_literal
    rules = spark.sql("select * from values (1, 'x'), (2, repeat('y', 1000)), (3, null) t(id, name)").where("id < 3")
    assert is_literal(rules) and not is_literal(spark.range(3)) and is_literal(rules.limit(0))
    spark.sparkContext.setJobGroup("literal", "literal")
    assert has_at_most(rules, 2) and not has_at_most(rules, 1) and has_at_most(rules.limit(0), 0)
    assert not has_at_most(rules, 2, max_bytes=1000) and has_at_most(rules, 2, max_bytes=2000)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("literal") == []
    assert not has_at_most(spark.range(3), 2)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("literal")) > 0
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
