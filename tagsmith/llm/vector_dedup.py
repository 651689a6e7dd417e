"""Near-duplicate embeddings over a robust-pruned flat graph.

1. Equal vectors of a label are collapsed to one node with a count.
2. Centroids are fitted on a bounded sample; every node goes to the shards
   (label, centroid) of its ``overlap`` nearest centroids.
3. Each shard builds a flat graph: the nearest candidates of a node, robustly
   pruned (a candidate is dropped if a nearer kept one lies ``alpha`` times
   closer to it than the node does), with the nearest reverse edges.
4. The adjacency lists of a node from its shards are united.
5. Every node of a shard searches the united graph there: greedily from the
   medoids of the shard's parts and its own place, keeping a beam, and
   expanding every node within twice the link range.  What it meets within the
   range, verified by the cosine in double precision, are its links.
6. The search is complete within a shard.  A neighbour within the range is
   dropped only for a kept one nearer to both ends, whatever the degree, so
   from a node to any of its links leads a path whose nodes come ever nearer
   to the link: they lie within the range of it, thus within twice the range
   of the node, and all of them are expanded.
7. A sample of nodes is compared with all vectors.  When links are missing
   (their ends share no shard), the overlap doubles and the search runs again,
   up to all shards, where nothing can be missing.

A shard with more than ``block`` nodes is cut into pieces; each pair of pieces
is searched in a task of its own, which adds the graph's edges between the two
pieces, so no task grows with a crowded shard.  A
task returns counts and a spanning forest, never the pairs themselves; a pair
that shares several shards is counted in the first of them only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagsmith.llm.common import Links, add_columns, components, map_batches, ship, stash


def valid_vectors(column: pa.ListArray, kind: str) -> pa.Array:
    """The vectors' components as bytes; null for a null, empty or zero vector
    and for null or non-finite components."""
    size = np.diff(column.offsets.to_numpy())
    if column.null_count == 0 and column.flatten().null_count == 0 and len(size) and size.min() == size.max() > 0:
        x = column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(size), -1)
        ok = np.isfinite(x).all(1) & x.any(1)
        raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(x.strides[0]), len(x), [None, pa.py_buffer(np.ascontiguousarray(x))])
        return pc.if_else(pa.array(ok), raw.cast(pa.binary()), pa.scalar(None, pa.binary()))
    out = []
    for v in column.to_pylist():
        x = None if v is None or any(c is None for c in v) else np.array(v, kind)
        out.append(None if x is None or not x.any() or not np.isfinite(x).all() else x.tobytes())
    return pa.array(out, pa.binary())


def unit_matrix(column, kind: str) -> np.ndarray:
    """Unit vectors (double) of components stored as bytes."""
    x = np.frombuffer(b"".join(column), kind).reshape(len(column), -1).astype(float)
    x /= np.abs(x).max(1, keepdims=True)  # no overflow in the norm
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def fit_centroids(sample: np.ndarray, k: int, apart: float = 0.0, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Spherical k-means on the sample.  Of centroids closer than ``apart``
    that of the larger cluster stays, so that none divides a group of
    near-duplicates."""
    rng = np.random.default_rng(seed)
    c = sample[rng.choice(len(sample), k, replace=False)]
    for _ in range(rounds):
        at = (sample @ c.T).argmax(1)
        new = np.zeros_like(c)
        np.add.at(new, at, sample)
        size = np.sqrt((new * new).sum(1, keepdims=True))
        c = np.where(size > 1e-12, new / np.maximum(size, 1e-12), c)
    order = np.argsort(-np.bincount((sample @ c.T).argmax(1), minlength=k), kind="stable")
    kept: list[int] = []
    for i in order.tolist():
        if not kept or (np.linalg.norm(c[kept] - c[i], axis=1) >= apart).all():
            kept.append(i)
    return c[kept]


def robust_prune(x: np.ndarray, degree: int, candidates: int, alpha: float, reach: float = 2.0) -> np.ndarray:
    """Adjacency (nodes x kept neighbours, -1: none) of the flat graph over
    unit rows.  Beyond ``reach`` (a cosine) a node has at most ``candidates``
    candidates and ``degree`` neighbours, pruned with ``alpha``.  Within it
    every node is a candidate, dropped only for a kept one that is nearer to
    it than the node is."""
    n = len(x)
    c = min(candidates, n - 1)
    if c <= 0:
        return np.full((n, 1), -1)
    sim = x @ x.T
    np.fill_diagonal(sim, -3)
    linked = (sim >= reach - 1e-6).sum(1)  # the margin covers rounding
    out: list[np.ndarray] = []
    order = np.argsort(linked, kind="stable")
    for i in range(0, n, 256):  # nodes with similar numbers of candidates together
        some = order[i:i + 256]
        out.append(_pruned(sim, some, max(c, int(linked[some].max())), linked[some], c, degree, alpha))
    full = np.full((n, max(o.shape[1] for o in out)), -1)
    for i, o in enumerate(out):
        full[order[i * 256:i * 256 + len(o)], :o.shape[1]] = o
    return full


def _pruned(sim: np.ndarray, some: np.ndarray, width: int, linked: np.ndarray, candidates: int, degree: int, alpha: float) -> np.ndarray:
    """The kept neighbours of the nodes ``some``, nearest first."""
    own_sim = sim[some]
    near = np.argpartition(-own_sim, width - 1, axis=1)[:, :width]
    near = np.take_along_axis(near, np.argsort(-np.take_along_axis(own_sim, near, 1), axis=1, kind="stable"), 1)
    own = 2 - 2 * np.take_along_axis(own_sim, near, 1)  # squared distances
    place = np.arange(width)
    inside = place < linked[:, None]
    alive = inside | (place < candidates)
    factor = np.where(inside, 1.0, alpha * alpha)
    kept, size = np.zeros(alive.shape, bool), np.zeros(len(some), np.int64)
    for s in range(width):
        on = np.flatnonzero(alive[:, s] & (inside[:, s] | (size < degree)))
        if not len(on):
            continue
        kept[on, s] = True
        size[on] += 1
        gap = 2 - 2 * sim[near[on, s][:, None], near[on, s + 1:]]
        alive[on, s + 1:] &= factor[on, s + 1:] * gap + 1e-12 > own[on, s + 1:]
    out = np.full((len(some), max(degree, int(size.max()))), -1)
    r, s = np.nonzero(kept)
    out[r, (np.cumsum(kept, 1) - 1)[r, s]] = near[r, s]
    return out


def with_reverse(x: np.ndarray, adjacency: np.ndarray, degree: int) -> np.ndarray:
    """The graph with the ``degree`` nearest reverse edges of each node added,
    so that a node nobody points at can be found."""
    n, width = adjacency.shape
    p, s = np.nonzero(adjacency >= 0)
    c = adjacency[p, s]
    order = np.lexsort((-np.einsum("ij,ij->i", x[p], x[c]), c))
    p, c = p[order], c[order]
    rank = np.arange(len(c)) - np.searchsorted(c, c)
    out = np.full((n, width + degree), -1)
    out[:, :width] = adjacency
    on = rank < degree
    out[c[on], width + rank[on]] = p[on]
    return out


def medoids(f: np.ndarray, parts: int) -> np.ndarray:
    """The medoid of all rows, and those of ``parts`` runs of the rows ordered
    along the direction that the row farthest from it gives."""
    mean = f.mean(0)
    first = int((f @ mean).argmax())
    along = np.argsort(f @ f[int((f @ f[first]).argmin())], kind="stable")
    runs = [r for r in np.array_split(along, parts) if len(r)]
    return np.unique([first, *(int(r[(f[r] @ f[r].mean(0)).argmax()]) for r in runs)])


def range_search(x: np.ndarray, adjacency: np.ndarray, queries: np.ndarray, reach: float, beam: int = 16,
                 starts: int = 4, step: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, node) pairs with a dot product of at least ``reach`` that the
    range-expanding greedy search finds, in slices.  Rows of ``x`` are unit
    vectors."""
    n = len(x)
    f = x.astype(np.float32)
    edges, degree = adjacency[adjacency >= 0], (adjacency >= 0).sum(1)
    first_edge = np.cumsum(degree) - degree
    first = medoids(f, starts)
    wide = 4 * reach - 3 - 1e-4  # the cosine at twice the distance
    for i in range(0, len(queries), step):
        q = queries[i:i + step]
        sim = np.full((len(q), n), -2, np.float32)
        done = np.zeros((len(q), n), bool)
        sim[:, first] = f[q] @ f[first].T
        sim[np.arange(len(q)), q] = 1
        while True:
            floor = np.partition(sim, n - beam, axis=1)[:, n - beam] if n > beam else np.full(len(q), -1.5)
            go = (sim > -2) & ~done & ((sim >= floor[:, None]) | (sim >= wide))
            r, c = np.nonzero(go)
            if not len(r):
                break
            done |= go
            fresh = np.zeros_like(done)
            ends = np.cumsum(degree[c])
            for j in range(0, int(ends[-1]), 1 << 18):  # edges, wherever a hub's lists begin
                edge = np.arange(j, min(int(ends[-1]), j + (1 << 18)))
                at = np.searchsorted(ends, edge, "right")
                fresh[r[at], edges[first_edge[c[at]] + edge - ends[at] + degree[c[at]]]] = True
            fresh &= sim <= -2
            r, c = np.nonzero(fresh)
            for j in range(0, len(r), 1 << 16):
                a, b = r[j:j + (1 << 16)], c[j:j + (1 << 16)]
                sim[a, b] = np.einsum("ij,ij->i", f[q[a]], f[b])
        r, c = np.nonzero(sim >= reach - 1e-4)
        u, v = q[r], c
        keep = u != v
        u, v = u[keep], v[keep]
        ok = [np.einsum("ij,ij->i", x[u[s:s + 65536]], x[v[s:s + 65536]]) >= reach for s in range(0, len(u), 65536)]
        ok = np.concatenate([np.zeros(0, bool), *ok])
        yield u[ok], v[ok]


def embedding_groups(vectors: DataFrame, reach: float = 0.98, overlap: int = 3, block: int = 2048, degree: int = 16,
                     candidates: int = 48, alpha: float = 1.2, sample: int = 20_000, max_centroids: int = 4096, min_recall: float = 0.9999, audited: int = 500,
                     id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vector: id, n_links (other vectors linked directly),
    component_id (smallest id reachable by links, itself included) and kept
    (id = component_id).

    Vectors link at a cosine of at least ``reach`` when their labels are equal
    and not null.  Null and zero vectors, and those with null or non-finite
    components, link with nothing; vectors of different lengths do not link.
    Repeated rows are vectors of their own.  A row with a null id takes part,
    but names no component (component_id is null if all ids are).  Other
    columns are ignored; an empty table gives no rows.

    The centroids are fitted on at most about ``sample`` vectors; every vector
    is indexed.  While a sample of about ``audited`` nodes shows a recall of
    links below ``min_recall``, the search runs again with twice the overlap."""
    spark = vectors.sparkSession
    ship(spark)

    kind = "<f4" if vectors.schema[vector_col].dataType.elementType.typeName() == "float" else "<f8"
    rows = _vectors(vectors, kind, id_col, vector_col, label_col)
    # equal vectors of a label are one node
    rows = rows.withColumn("node", F.when(F.col("label").isNotNull() & F.col("vec").isNotNull(),
                                          F.xxhash64("label", "vec", F.md5("vec"))))
    nodes = stash(rows.where("node is not null").groupBy("node").agg(
        F.min("id").alias("first"), F.count("*").alias("copies"), F.any_value("label").alias("label"),
        F.any_value("vec").alias("vec")), "nodes")
    n, labels = nodes.agg(F.count("*"), F.approx_count_distinct(F.concat_ws(":", "label", F.octet_length("vec")))).first()
    share = min(1.0, sample / max(n, 1))
    picked = nodes.where(F.pmod(F.xxhash64("node", F.lit(1)), F.lit(1 << 30)) < int(share * (1 << 30))).select("vec").toPandas()["vec"]
    size = picked.map(len)
    width = int(size.mode()[0]) if len(size) else 8  # centroids for the usual length; others share shard 0
    base = unit_matrix(list(picked[size == width]), kind) if len(size) else np.zeros((0, 1))
    k = int(min(max_centroids, max(1, n * overlap // (max(1, labels) * (block // 2))), max(1, len(base) // 8)))
    sent = spark.sparkContext.broadcast(fit_centroids(base, k, 2.5 * np.sqrt(2 - 2 * reach)) if len(base) else np.zeros((1, 1)))

    def search_with(overlap: int) -> tuple[DataFrame, DataFrame]:
        def assign(column: pa.Array) -> list[pa.Array]:
            vec = column.to_pylist()
            usual = np.array([len(v) == width for v in vec])
            own = np.full((len(vec), min(overlap, len(sent.value))), -1)
            if usual.any():
                sim = unit_matrix([v for v, u in zip(vec, usual) if u], kind) @ sent.value.T
                own[usual] = np.sort(np.argpartition(-sim, own.shape[1] - 1, axis=1)[:, :own.shape[1]], 1)
            shards = [o if u else [0] for o, u in zip(own.tolist(), usual)]
            return [pa.array(shards, pa.list_(pa.int32())), pa.array([len(v) for v in vec], pa.int32())]
        new = T.StructType([T.StructField("shards", T.ArrayType(T.IntegerType())), T.StructField("width", T.IntegerType())])
        placed = stash(add_columns(nodes.select("node", "copies", "label", "vec"), ["vec"], assign, new, 4096), "placed")
        dealt = placed.withColumn("shard", F.explode("shards"))
        crowded = dealt.groupBy("label", "width", "shard").count().select(
            "label", "width", "shard", F.ceil(F.col("count") / block).cast("int").alias("pieces"))
        dealt = dealt.join(crowded, ["label", "width", "shard"]).withColumn("piece", F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int"))

        def build(pdf: pd.DataFrame) -> pd.DataFrame:
            node = pdf["node"].to_numpy()
            x = unit_matrix(pdf["vec"], kind)
            adj = with_reverse(x, robust_prune(x, degree, candidates, alpha, reach), degree)
            return pd.DataFrame({"node": node, "near": [node[a[a >= 0]] for a in adj]})
        lists = dealt.select("label", "width", "shard", "piece", "node", "vec").groupBy("label", "width", "shard", "piece") \
            .applyInPandas(build, "node long, near array<long>")
        # overlap * 2 * degree neighbours a node, and the unpruned ones within reach
        united = stash(lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "graph")
        # pieces i <= j of a shard meet in the task (i, j)
        every = F.sequence(F.lit(0), F.col("pieces") - 1)
        tasks = dealt.join(united, "node").withColumn("other", F.explode(every)) \
            .withColumn("i", F.least("piece", "other")).withColumn("j", F.greatest("piece", "other"))

        def search(pdf: pd.DataFrame) -> pd.DataFrame:
            x, node = unit_matrix(pdf["vec"], kind), pdf["node"].to_numpy()
            shard, copies, piece = int(pdf["shard"].iloc[0]), pdf["copies"].to_numpy(), pdf["piece"].to_numpy()
            place = {v: p for p, v in enumerate(node.tolist())}
            near = [[place[v] for v in a.tolist() if v in place] for a in pdf["near"]]
            adj = np.full((len(node), max(1, max(map(len, near)))), -1)
            for r, a in enumerate(near):
                adj[r, :len(a)] = a
            if piece.min() != piece.max():
                adj = np.concatenate([adj, with_reverse(x, robust_prune(x, degree, candidates, alpha, reach), degree)], axis=1)
            links = Links(len(node))
            n_links = np.zeros(len(node), np.int64)
            own = [set(s.tolist()) for s in pdf["shards"]]
            lists, which = np.unique(np.array([",".join(map(str, sorted(t))) for t in own]), return_inverse=True)
            sets = [set(map(int, t.split(","))) for t in lists]
            here = np.array([[min(a & b, default=-1) == shard for b in sets] for a in sets])
            for u, v in range_search(x, adj, np.arange(len(x)), reach):  # both directions of a link: both ends search
                if piece.min() != piece.max():  # pairs within a piece belong to the tasks (i, i)
                    on = piece[u] != piece[v]
                    u, v = u[on], v[on]
                links.add(u, v)
                counted = here[which[u], which[v]]
                np.add.at(n_links, u[counted], copies[v[counted]])
            return pd.DataFrame({"node": node, "n": n_links, "root": node[links.label]})
        found = stash(tasks.select("label", "width", "shard", "i", "j", "piece", "node", "vec", "copies", "shards", "near")
                      .groupBy("label", "width", "shard", "i", "j").applyInPandas(search, "node long, n long, root long"), "found")
        return found, stash(found.groupBy("node").agg(F.sum("n").alias("n")), "counts")

    while True:
        found, counts = search_with(overlap)
        if overlap >= len(sent.value) or _recall(nodes, counts, reach, kind, audited) >= min_recall:
            break
        overlap *= 2  # links between vectors that share no shard are missing
    classes = components(found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    facts = nodes.select("node", "first", "copies").join(counts, "node", "left").join(classes, "node", "left") \
        .withColumn("component", F.coalesce("component", "node"))
    facts = stash(facts, "facts")
    least = stash(facts.groupBy("component").agg(F.min("first").alias("least")), "least")  # both written: a large component is a join side that AQE splits
    facts = facts.join(least, "component").select("node", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "least")
    whole = rows.select("id", "node").join(facts, "node", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"))
    return whole.withColumn("kept", F.col(id_col) == F.col("component_id"))


def _vectors(vectors: DataFrame, kind: str, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, vec): the components as bytes, null where invalid."""
    def run(t: pa.Table) -> pa.Table:
        return pa.table([t.column(0), t.column(1), valid_vectors(t.column(2).combine_chunks(), kind)], names=["id", "label", "vec"])
    src = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("vec"))
    return map_batches(src, run, "id long, label string, vec binary", 4096)


def _recall(nodes: DataFrame, counts: DataFrame, reach: float, kind: str, audited: int) -> float:
    """Share of the links of a sample of nodes (against all nodes) that
    ``counts`` has."""
    share = min(1.0, audited / max(1, nodes.count()))
    some = nodes.where(F.pmod(F.xxhash64("node", F.lit(2)), F.lit(1 << 30)) < int(share * (1 << 30))) \
        .select("node", "label", "vec").toPandas()
    if not len(some):
        return 1.0
    groups = [(key, mine["node"].to_numpy(), unit_matrix(list(mine["vec"]), kind))
              for key, mine in some.groupby(["label", some["vec"].map(len)])]

    def exact(t: pa.Table) -> pa.Table:
        node, label, vec = t.column(0).to_numpy(), np.array(t.column(1).to_pylist(), object), t.column(2).to_pylist()
        copies, size = t.column(3).to_numpy(), np.array([len(v) for v in vec])
        out: dict[int, int] = {}
        for (name, width), own, x in groups:
            on = np.flatnonzero((label == name) & (size == width))
            if len(on):
                y = unit_matrix([vec[i] for i in on], kind)
                u, v = np.nonzero(x @ y.T >= reach - 1e-4)
                ok = (np.einsum("ij,ij->i", x[u], y[v]) >= reach) & (own[u] != node[on[v]])
                for k, c in zip(own[u[ok]].tolist(), copies[on[v[ok]]].tolist()):
                    out[k] = out.get(k, 0) + c
        return pa.table([pa.array(list(out), pa.int64()), pa.array(list(out.values()), pa.int64())], names=["node", "links"])
    truth = map_batches(nodes.select("node", "label", "vec", "copies"), exact, "node long, links long", 4096) \
        .groupBy("node").agg(F.sum("links").alias("links"))
    links, got = truth.join(counts, "node", "left").agg(
        F.coalesce(F.sum("links"), F.lit(0)), F.coalesce(F.sum(F.least("links", F.coalesce("n", F.lit(0)))), F.lit(0))).first()
    return got / links if links else 1.0


def audit_recall(vectors: DataFrame, groups: DataFrame, reach: float = 0.98, queries: int = 500, id_col: str = "vec_id",
                 vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row: links that brute force finds for a bounded sample of about
    ``queries`` vectors (against all rows), links counted in ``groups`` for
    them, and their ratio."""
    kind = "<f4" if vectors.schema[vector_col].dataType.elementType.typeName() == "float" else "<f8"
    rows = _vectors(vectors, kind, id_col, vector_col, label_col).where("label is not null and vec is not null and id is not null")
    share = min(1.0, queries / max(1, rows.count()))
    some = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30))).toPandas()

    def exact(t: pa.Table) -> pa.Table:
        ids, label, vec = (t.column(i).to_pylist() for i in range(3))
        out = np.zeros(len(some), np.int64)
        for key, mine in some.groupby(["label", some["vec"].map(len)]):
            on = [i for i, (v, x) in enumerate(zip(label, vec)) if v == key[0] and len(x) == key[1]]
            if on:
                near = unit_matrix(list(mine["vec"]), kind) @ unit_matrix([vec[i] for i in on], kind).T >= reach
                near &= mine["id"].to_numpy()[:, None] != np.array([ids[i] for i in on])[None]
                out[mine.index.to_numpy()] += near.sum(1)
        return pa.table([pa.array(some["id"].to_numpy()), pa.array(out)], names=[id_col, "n"])
    truth = map_batches(rows, exact, f"{id_col} long, n long", 4096).groupBy(id_col).agg(F.sum("n").alias("n"))
    return truth.join(groups, id_col).agg(F.sum("n").alias("links"), F.sum(F.least("n", "n_links")).alias("found")) \
        .select("links", "found", F.when(F.col("links") > 0, F.col("found") / F.col("links")).otherwise(1.0).alias("recall"))
