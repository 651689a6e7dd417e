"""Embeddings, pages, the pipeline and the registered oracles."""

import base64
import hashlib
from collections import Counter

import duckdb
import numpy as np
import pytest

SF = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


def brute(vectors, reach=0.98):
    """n_links and component of every vector by all pairs."""
    unit = []
    for _, e, label in vectors:
        ok = label is not None and e is not None and len(e) and all(c is not None and np.isfinite(c) for c in e) and any(e)
        x = np.array(e, float) / np.abs(np.array(e, float)).max() if ok else None
        unit.append(None if x is None else x / np.linalg.norm(x))
    n = len(vectors)
    near = [[j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None and vectors[i][2] == vectors[j][2]
             and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= reach] for i in range(n)]
    group = list(range(n))
    for _ in range(n):
        new = [min([group[i], *(group[j] for j in near[i])]) for i in range(n)]
        if new == group:
            break
        group = new
    ids = [v[0] for v in vectors]
    least = {g: min((ids[i] for i in range(n) if group[i] == g and ids[i] is not None), default=None) for g in set(group)}
    return [(ids[i], len(near[i]), least[group[i]]) for i in range(n)]


def made_vectors(n=600, dim=16, seed=0):
    rng = np.random.default_rng(seed)
    rows, i = [], 0
    while len(rows) < n:
        x = rng.normal(size=dim)
        for _ in range(int(rng.choice([1, 1, 2, 5, 40]))):
            rows.append((i, (x + rng.normal(size=dim) * 0.1).astype(np.float32).tolist(), int(rng.integers(2)) if rng.random() < .1 else 0))
            i += 1
    return rows


def test_embedding_groups_against_brute_force(spark):
    from tagsmith.llm.vector_dedup import audit_recall, embedding_groups
    rows = made_vectors()
    rows += [(9000 + i, rows[0][1], 0) for i in range(50)]  # exact copies
    rows += [(9100, None, 0), (9101, [0.0] * 16, 0), (9102, [float("nan")] + [1.0] * 15, 0), (9103, [float("inf")] * 16, 0),
             (9104, [], 0), (9105, [None] + [1.0] * 15, 0), (9106, rows[0][1], None), (9107, rows[0][1][:8], 0),
             (9108, [2 * c for c in rows[0][1][:8]], 0), (9109, [3e38] * 16, 0), (9110, [1.0] * 16, 0), (None, rows[1][1], 0)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, node string, copies int")
    want = Counter(brute([(i, None if e is None else [None if c is None else float(np.float32(c)) for c in e], k) for i, e, k in rows]))
    got = embedding_groups(df).cache()
    assert Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in got.collect()) == want
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.collect() if r["vec_id"] is not None)
    assert audit_recall(df.where("vec_id is not null"), got).first()["recall"] >= 0.99
    cut = embedding_groups(df, block=16, overlap=2)  # crowded shards in pieces
    links = {r["vec_id"]: r["n_links"] for r in cut.collect()}
    exact = {i: n for i, n, _ in want}
    assert sum(links.values()) >= 0.99 * sum(exact.values()) and all(links[i] <= n for i, n in exact.items())
    assert embedding_groups(df.limit(0)).count() == 0


def test_robust_prune_keeps_the_nearest():
    from tagsmith.llm.vector_dedup import robust_prune
    x = np.random.default_rng(0).normal(size=(200, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    adj = robust_prune(x, 8, 32, 1.2)
    sim = x @ x.T
    np.fill_diagonal(sim, -2)
    assert (adj[:, 0] == sim.argmax(1)).all() and adj.shape == (200, 8)
    for p in range(200):
        kept = adj[p][adj[p] >= 0]
        for i, c in enumerate(kept):  # no kept neighbour is covered by a nearer one
            assert all(1.44 * (2 - 2 * sim[c, k]) > 2 - 2 * sim[p, c] for k in kept[:i])


PAGES = [(5, "http://a/1", "<p>same</p>"), (3, "http://a/2", "<p>same</p>"), (9, None, "<p>same</p>"), (1, "http://b\r\nWARC-Type: fake", "é中"),
         (2, "u", None), (4, "u", ""), (None, "u", "<p>same</p>"), (6, "u", "WARC/1.1\r\nWARC-Type: x\r\n\r\n" * 3), (6, "u", "WARC/1.1\r\nWARC-Type: x\r\n\r\n" * 3),
         (None, "v", "only null"), (7, "u", "long " * 100000)]


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_warc_round_trip(spark, tmp_path, min_bytes):
    from pyspark.sql import functions as F

    from tagsmith.llm.warc_cas import archive_digest, field, read_archive, record_bytes, write_archive
    df = spark.createDataFrame([(*p, 1) for p in PAGES], "page_id long, url string, html string, payload int")
    path = f"{tmp_path}/a{min_bytes}"
    write_archive(df, path, min_bytes=min_bytes)
    want = Counter()
    for i, _, html in PAGES:
        body = (html or "").encode()
        ids = [j for j, _, h in PAGES if (h or "") == (html or "") and j is not None]
        first = min(ids, default=None)
        resp = len(body) < min_bytes or i == first
        want[i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if resp else "revisit", None if resp else first] += 1
    assert Counter(tuple(r) for r in archive_digest(spark, path).collect()) == want
    assert spark.read.parquet(f"{path}/payloads").count() == len({h or "" for _, _, h in PAGES})  # stored once
    for header, payload, raw, length in read_archive(spark, path).select(
            "header", "payload", record_bytes(F.col("header"), F.col("payload")), field(F.col("header"), "Content-Length")).collect():
        top, block = bytes(raw).split(b"\r\n\r\n", 1)
        assert top.startswith(b"WARC/1.1\r\n") and len(block) == int(length) + 4 and block.endswith(b"\r\n\r\n")
        assert bytes(raw).startswith(bytes(header))
        if b"WARC-Type: response" in top:
            assert block[:-4].split(b"\r\n\r\n", 1)[1] == bytes(payload)


def test_warc_detects_a_changed_payload(spark, tmp_path):
    from tagsmith.llm.warc_cas import archive_digest, write_archive
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    write_archive(df, f"{tmp_path}/a")
    changed = spark.read.parquet(f"{tmp_path}/a/payloads").selectExpr("key", "cast(concat(cast(payload as string), 'x') as binary) payload")
    changed.write.parquet(f"{tmp_path}/b/payloads")
    spark.read.parquet(f"{tmp_path}/a/records").write.parquet(f"{tmp_path}/b/records")
    with pytest.raises(Exception, match="does not match its key"):
        archive_digest(spark, f"{tmp_path}/b").collect()
    write_archive(df.limit(0), f"{tmp_path}/c")
    assert archive_digest(spark, f"{tmp_path}/c").count() == 0


def test_components(spark):
    from tagsmith.llm.common import components
    rng = np.random.default_rng(1)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1100)] + [(5000, i) for i in range(4000, 4400)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    label = {x: x for e in links for x in e}
    for _ in range(400):
        new = dict(label)
        for a, b in links:
            new[a] = new[b] = min(new[a], new[b])
        if new == label:
            break
        label = new
    assert got == {x: c for x, c in label.items() if any(x in e and e[0] != e[1] for e in links)}


def test_oracles_agree(spark):
    from tagsmith.llm.oracles import ORACLES
    from tagsmith.llm.queries import QUERIES
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "conversations"):
        con.execute(f"create view {t} as select * from '{SF_CHECK}/{t}.parquet'")
    for name, sql in ORACLES.items():
        want = con.sql(sql)
        got = QUERIES[name](spark, SF_CHECK)
        assert sorted(got.columns) == sorted(want.columns)
        assert Counter(tuple(r) for r in got.select(*want.columns).collect()) == Counter(want.fetchall()), name


def test_pipeline_against_brute_force(spark):
    """Stage by stage, each held against a plain version over its own input."""
    import corpus_pipeline
    from tagsmith.llm.common import stash
    from tagsmith.llm.decontam import brute_force
    from tagsmith.llm.quality_qda import score_quality
    from tagsmith.llm.simhash_cover import fingerprint
    from tagsmith.llm.surrogates import find
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    tables = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        out = stash(stage(spark, docs, SF), name)
        tables[name] = out
        if name != "packing":
            assert out.columns == columns
            after = {r["doc_id"]: r["text"] for r in out.collect()}
            assert set(after) <= set(before) and after
        if name == "quality":
            assert set(after) == {r["doc_id"] for r in score_quality(docs, labels).where("predicted = 1").collect()}
        elif name == "near_duplicates":
            ids = sorted(before)
            fp = [fingerprint(before[i]) for i in ids]
            group = list(range(len(ids)))
            for i in range(len(ids)):
                for j in range(i):
                    if (fp[i] ^ fp[j]).bit_count() <= 4 and group[i] != group[j]:
                        a, b = sorted((group[i], group[j]))
                        group = [a if g == b else g for g in group]
            assert set(after) == {ids[group.index(g)] for g in set(group)} and all(after[i] == before[i] for i in after)
        elif name == "decontaminate":
            marks = brute_force(list(before.values()), items)
            assert set(after) == {i for i, m in zip(before, marks) if not m[4]}
        elif name == "surrogates":
            assert set(after) == set(before)
            for i, t in before.items():
                assert (after[i] == t) == (not find(t)) and not any(t[a:b] in after[i] for a, b, _, _ in find(t))
        else:
            got = Counter()
            for r in out.collect():
                got[r["doc_id"]] += r["length"]
            assert set(got) == set(before)
            assert {r["doc_id"]: r["doc_tokens"] for r in out.collect()} == dict(got)
        docs = out
    assert Counter(tuple(r) for r in corpus_pipeline.run(spark, SF).select("doc_id", "start", "length", "ids_crc32").collect()) \
        == Counter(tuple(r) for r in docs.select("doc_id", "start", "length", "ids_crc32").collect())


def test_keep_one_with_repeated_ids(spark):
    """One row of every group, whatever the ids: the rows of an id belong to
    the groups of their texts."""
    from tagsmith.llm.simhash_cover import fingerprint, keep_one
    a, b = "alpha beta gamma delta epsilon zeta", "one two three four five six seven"
    assert (fingerprint(a) ^ fingerprint(b)).bit_count() > 4
    rows = [(0, b), (1, a), (1, b), (1, a), (None, a), (None, "quite another text for no id"), (None, "quite another text for no id"),
            (7, None), (8, ""), (9, "  "), (5, b)]
    frame = spark.createDataFrame([(*r, 3, "k", 0) for r in rows], "doc_id long, text string, hash int, class string, __hash long")
    got = keep_one(frame)
    assert got.columns == frame.columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter([(0, b), (1, a), (None, "quite another text for no id"), (7, None)])
    assert keep_one(frame.limit(0)).count() == 0


def test_pipeline_with_edge_rows(spark, tmp_path):
    """Null, empty and long texts, repeated rows and ids, clashing columns:
    every stage but the last keeps the columns and loses no clean document."""
    import corpus_pipeline
    from tagsmith.llm.common import stash
    folder = str(tmp_path / "sf")
    base = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    long_text = " ".join(t for _, t, *_ in base[:80])
    odd = [(90001, None, None, None, None), (90002, "", None, None, 0), (90003, " ", "en", "s", 1), (90004, long_text, "en", "s", len(long_text)),
           (90004, long_text, "en", "s", len(long_text)), (None, base[3][1] + " without an id", "en", "s", 5), base[5], base[5], (base[6][0], base[7][1], "x", "y", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, n_words int, contaminated string, score double, fp long"
    docs = spark.createDataFrame([(*r, -1, "own", 0.5, None) for r in base + odd], schema)
    docs.write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stash(stage(spark, docs, folder), f"edge-{name}")
        if name != "packing":
            assert out.columns == docs.columns, name
            assert {(r.n_words, r.contaminated, r.score, r.fp) for r in out.collect()} == {(-1, "own", 0.5, None)}
            assert out.count() <= docs.count()
        if name == "near_duplicates":
            kept = Counter((r.doc_id, r.text) for r in out.collect())
            assert max(kept.values()) == 1
        docs = out
    assert docs.count() > 0
    empty = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stash(stage(spark, empty, folder), "edge-empty")
        assert empty.count() == 0


def test_registered():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert {f"op{n}_" for n in range(1, 14)} <= {n.split("_")[0] + "_" for n in names} and "pipeline" in names
    assert set(entry.oracle_sql()) <= names


@pytest.mark.parametrize("shape", ["mixed", "group", "hub", "chain", "plane"])
def test_range_search_finds_every_link(shape):
    """The search alone against all pairs, also with groups of more nodes
    within reach than the graph has candidates or columns."""
    from tagsmith.llm.vector_dedup import range_search, robust_prune, with_reverse
    rng = np.random.default_rng(3)
    x = {"mixed": np.concatenate([np.repeat(rng.normal(size=(60, 24)), 3, 0) + rng.normal(size=(180, 24)) * 0.08, rng.normal(size=(80, 24))]),
         "group": rng.normal(size=(1, 24)) + rng.normal(size=(300, 24)) * 0.13,
         "hub": (lambda c: np.concatenate([c, c + rng.normal(size=(150, 24)) * 0.1]))(rng.normal(size=(1, 24))),
         "chain": np.stack([np.cos(np.arange(300) * 0.03), np.sin(np.arange(300) * 0.03)], 1),
         "plane": rng.normal(size=(400, 3))}[shape]
    x /= np.linalg.norm(x, axis=1)[:, None]
    graph = with_reverse(x, robust_prune(x, 6, 12, 1.2, 0.98), 6)
    found = [p for u, v in range_search(x, graph, np.arange(len(x)), 0.98, step=64) for p in zip(u.tolist(), v.tolist())]
    sim = x @ x.T
    np.fill_diagonal(sim, -2)
    assert len(found) == len(set(found)) and set(found) == set(zip(*map(np.ndarray.tolist, np.nonzero(sim >= 0.98))))
    assert found and (graph >= 0).sum() < sim.size / 2  # a graph, not all pairs


def test_links_between_crowded_groups(spark):
    """Two groups of more near-copies than a node has candidates, within reach
    of each other, among vectors far from both."""
    from tagsmith.llm.vector_dedup import embedding_groups
    rng = np.random.default_rng(4)
    a, b = np.linalg.qr(rng.normal(size=(32, 2)))[0].T
    b = 0.985 * a + np.sqrt(1 - 0.985 ** 2) * b
    rows = [(i, (c + rng.normal(size=32) * 0.0015).astype(np.float32).tolist(), 0) for i, c in enumerate([a] * 60 + [b] * 60)]
    rows += [(1000 + i, rng.normal(size=32).astype(np.float32).tolist(), 0) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    want = Counter(brute(rows))
    assert sum(n for _, n, _ in want) == 120 * 119
    for how in ({}, {"block": 32}):
        assert Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in embedding_groups(df, **how).collect()) == want
