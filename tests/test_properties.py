"""Property tests: operators against brute-force Python on random inputs.
Each example runs Spark jobs, so the example counts are kept small."""

import os
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tagsmith.functions.scores import Bands
from tagsmith.operators.joins import range_join
from tagsmith.operators.profile import profile_upsert
from tagsmith.operators.stats import favourite_value

SETTINGS = settings(max_examples=int(os.environ.get("PROPERTY_EXAMPLES", "12")), deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

ranges_st = st.lists(st.tuples(st.integers(-50, 200), st.integers(0, 120)), min_size=1, max_size=12)
values_st = st.lists(st.one_of(st.none(), st.integers(-60, 330)), min_size=0, max_size=40)


@SETTINGS
@given(ranges=ranges_st, values=values_st)
def test_range_join_strategies_agree_with_brute_force(spark, ranges, values):
    rng = [(f"r{i}", lo, lo + span) for i, (lo, span) in enumerate(ranges)]
    rdf = spark.createDataFrame(rng, "name string, start long, end long")
    vdf = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "k int, v long")
    expect = sorted((k, n) for k, v in enumerate(values) if v is not None
                    for n, lo, hi in rng if lo <= v <= hi)
    for kw in ({}, {"max_loop_ranges": 0}, {"max_loop_ranges": 0, "max_rows": 0}):
        got = sorted((r.k, r.name) for r in range_join(vdf, "v", rdf, **kw).collect())
        assert got == expect, kw


@SETTINGS
@given(uppers=st.lists(st.integers(-20, 20), min_size=1, max_size=5, unique=True),
       strict=st.booleans(), values=st.lists(st.one_of(st.none(), st.integers(-30, 30)), max_size=20))
def test_bands_match_python(spark, uppers, strict, values):
    uppers = sorted(uppers)
    scores = list(range(len(uppers) + 1, 0, -1))
    b = Bands(tuple(uppers), tuple(scores), strict=strict)

    def py(v):
        if v is None:
            return None
        for ub, s in zip(uppers, scores):
            if (v < ub) if strict else (v <= ub):
                return float(s)
        return float(scores[-1])

    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "k int, v int")
    got = {r.k: r.s for r in df.select("k", b.expr("v").alias("s")).collect()}
    assert got == {i: py(v) for i, v in enumerate(values)}


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 4), st.sampled_from(["a", "b", "c", "d"])), max_size=60))
def test_favourite_value_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "u long, p string")
    got = {(r.userId, r.p, r.cnt) for r in favourite_value(df, "u", "p").collect()}
    expect = set()
    for u in {u for u, _ in rows}:
        c = Counter(p for uu, p in rows if uu == u)
        p, n = sorted(c.items(), key=lambda kv: (-kv[1], kv[0]))[0]
        expect.add((u, p, n))
    assert got == expect


cell = st.one_of(st.none(), st.sampled_from(["x", "y", "z"]))


@SETTINGS
@given(old=st.dictionaries(st.integers(0, 30), st.tuples(cell, cell), max_size=15),
       new=st.dictionaries(st.integers(0, 30), st.tuples(cell, cell), max_size=15))
def test_profile_upsert_matches_dict_merge(spark, old, new):
    o = spark.createDataFrame([(k, a, b) for k, (a, b) in old.items()], "userId long, a string, b string")
    n = spark.createDataFrame([(k, b, c) for k, (b, c) in new.items()], "userId long, b string, c string")
    got = {r.userId: (r.a, r.b, r.c) for r in profile_upsert(o, n).collect()}
    expect = {}
    for k in set(old) | set(new):
        oa, ob = old.get(k, (None, None))
        nb, nc = new.get(k, (None, None))
        expect[k] = (oa, nb if nb is not None else ob, nc)
    assert got == expect


@SETTINGS
@given(visits=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 30 * 24 * 60), st.sampled_from(["/a", "/b", "/c"])),
                       min_size=1, max_size=40),
       clock_minutes=st.sampled_from([0, 7 * 60 + 13, 23 * 60 + 59]))
def test_lifecycle_matches_brute_force(spark, visits, clock_minutes):
    import datetime as dt
    from tagsmith.operators.rfx import lifecycle_tag
    base = dt.datetime(2020, 1, 1)
    now = dt.datetime(2020, 1, 25) + dt.timedelta(minutes=clock_minutes)
    rows = [(u, p, base + dt.timedelta(minutes=m)) for u, m, p in visits]
    df = spark.createDataFrame(rows, "u long, url string, t timestamp_ntz")
    got = {r.userId: r.lifecycle for r in lifecycle_tag(df, "u", "url", "t", now).collect()}

    expect = {}
    for u in {r[0] for r in rows}:
        ts = sorted((t, p) for uu, p, t in rows if uu == u and t < now)
        if not ts:
            continue
        d = (now.date() - ts[-1][0].date()).days
        first = (now.date() - ts[0][0].date()).days
        recent = [p for t, p in ts if t >= now - dt.timedelta(days=1)]
        gap = any(b[0] - a[0] > dt.timedelta(days=7) for a, b in zip(ts, ts[1:]))
        if len(recent) >= 2 and len(recent) == len(set(recent)):
            cls = "loyal"
        elif first <= 3:
            cls = "new"
        elif d <= 3 and gap:
            cls = "returning"
        elif d <= 2:
            cls = "active"
        elif d <= 7:
            cls = "inactive"
        else:
            cls = "lost"
        expect[u] = cls
    assert got == expect


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5)), max_size=50), n=st.integers(1, 4))
def test_top_n_matches_brute_force(spark, rows, n):
    from pyspark.sql import functions as F
    from tagsmith.operators.stats import top_n_per_group
    data = [(g, v, k) for k, (g, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "g long, v long, k long")
    got = sorted((r.g, r.k, r.rk) for r in
                 top_n_per_group(df, ["g"], [F.col("v").desc(), F.col("k")], n, rank_col="rk").collect())
    expect = []
    for g in {g for g, _, _ in data}:
        ordered = sorted((r for r in data if r[0] == g), key=lambda r: (-r[1], r[2]))[:n]
        expect += [(g, k, i + 1) for i, (_, _, k) in enumerate(ordered)]
    assert got == sorted(expect)


@SETTINGS
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.sampled_from("abc")), st.sampled_from(["x", "y"])),
                     max_size=40))
def test_value_counts_matches_counter(spark, rows):
    from tagsmith.operators.stats import value_counts
    df = spark.createDataFrame(rows, "c1 string, c2 string")
    got = {(r.column, r.value, r["count"]) for r in value_counts(df, ["c1", "c2"]).collect()}
    expect = {("c1", v, n) for v, n in Counter(a for a, _ in rows).items()} | \
             {("c2", v, n) for v, n in Counter(b for _, b in rows).items()}
    assert got == expect


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 5)), max_size=60), n=st.integers(1, 4),
       buckets=st.integers(2, 5))
def test_salted_top_n_equals_plain(spark, rows, n, buckets):
    from pyspark.sql import functions as F
    from tagsmith.operators.stats import top_n_per_group
    df = spark.createDataFrame([(g, v, k) for k, (g, v) in enumerate(rows)], "g long, v long, k long")
    order = [F.col("v").desc(), F.col("k")]
    plain = sorted(top_n_per_group(df, ["g"], order, n, rank_col="rk").collect())
    salted = sorted(top_n_per_group(df, ["g"], order, n, rank_col="rk", salt_buckets=buckets).collect())
    assert plain == salted


@SETTINGS
@given(uppers=st.lists(st.integers(-20, 20), min_size=1, max_size=5, unique=True), strict=st.booleans(),
       values=st.lists(st.one_of(st.none(), st.integers(-30, 30)), min_size=1, max_size=20))
def test_band_sql_text_agrees_with_spark_expression(spark, uppers, strict, values):
    """The CASE text the DuckDB oracles use and the Spark expression agree."""
    import duckdb
    uppers = sorted(uppers)
    b = Bands(tuple(uppers), tuple(range(1, len(uppers) + 2)), strict=strict)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "k int, v int")
    got = {r.k: r.s for r in df.select("k", b.expr("v").alias("s")).collect()}
    rows = ", ".join(f"({i}, {'NULL' if v is None else v})" for i, v in enumerate(values))
    duck = dict(duckdb.sql(f"SELECT k, {b.sql('v')} AS s FROM (VALUES {rows}) AS t(k, v)").fetchall())
    assert got == duck
