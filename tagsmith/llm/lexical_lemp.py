"""Ranked lexical search over norm buckets, in the manner of LEMP.

A document is a vector of integer term impacts over the query vocabulary, a
query a vector of integer term weights; the score is their inner product.
The documents' vectors are ordered by length (Euclidean norm) and stored in
buckets of similar length, the longest first within a bucket.  The longest
buckets are searched first and give every query a threshold, the score of its
k-th best document so far.  Then

* the Cauchy-Schwarz inequality prunes buckets: one whose longest vector times
  the query's length stays below the threshold of every query is not read, and
  inside a bucket a query stops at the first slice that cannot reach it;
* coordinate bounds filter inside a slice: only documents that hold one of the
  query's *focus* coordinates can reach the threshold, and of those only the
  ones whose partial product plus the bound of the other coordinates
  (Cauchy-Schwarz on the rests, or the slice's largest impacts) does;
* survivors are scored again exactly, in 64-bit integers.

Bounds are compared with a relative slack of 1e-9, so rounding drops nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagsmith.llm.common import ship, stash
from tagsmith.llm.decontam import Vocabulary, words  # the terms are the same runs of characters

SLACK = 1 + 1e-9
LEVELS = 8  # length levels per doubling


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Integer impact of a term that occurs ``tf`` times among ``n`` terms."""
    m = 100 - 75 + (75 * n * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Queries:
    """A block of items: distinct terms, and per item its terms with repeats
    counted."""

    def __init__(self, texts: list):
        found = [words(t) for t in texts]
        self.vocabulary = Vocabulary(sorted({w for one in found for w in one}))
        ids = self.vocabulary.ids
        self.terms, self.times = [], []
        for one in found:
            t, n = np.unique(np.array([ids[w] for w in one], np.int64), return_counts=True)
            self.terms.append(t)
            self.times.append(n.astype(np.int64))
        self.size = len(ids)

    def weigh(self, df: dict[int, int], n_docs: int) -> None:
        """Weights of the terms that some document holds; the others and those
        of weight 0 add nothing and go."""
        w = np.zeros(self.size + 1, np.int64)
        for t, n in df.items():
            w[t] = weight(n, n_docs)
        self.weights = []
        for i, (t, n) in enumerate(zip(self.terms, self.times)):
            by = w[t] * n
            order = np.argsort(-by, kind="stable")
            order = order[by[order] > 0]
            self.terms[i] = t[order]
            self.weights.append(by[order])
        self.length = np.array([math.sqrt(float((q.astype(float) ** 2).sum())) for q in self.weights])
        # length of what is left of a query after its first j coordinates
        self.rest = [np.append(np.sqrt(np.cumsum((q.astype(float) ** 2)[::-1])[::-1]), 0.0) for q in self.weights]


class Best:
    """The best ``k`` (score, id) of every query; equal scores by id, null ids
    last."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.k = k
        self.score = [np.zeros(0, np.int64)] * n
        self.id = [np.zeros(0, np.int64)] * n
        self.null = [np.zeros(0, bool)] * n
        self.least = np.maximum(floor, 1)  # a score below is of no use

    def add(self, q: int, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        on = score >= self.least[q]
        if not on.any():
            return
        score, ids, null = (np.concatenate([a[q], b[on]]) for a, b in ((self.score, score), (self.id, ids), (self.null, null)))
        order = np.lexsort((ids, null, -score))[:self.k]
        self.score[q], self.id[q], self.null[q] = score[order], ids[order], null[order]
        if len(order) == self.k:
            self.least[q] = max(self.least[q], score[order[-1]])


class Slice:
    """Some vectors of a bucket: rows by document and postings by term."""

    def __init__(self, start: np.ndarray, terms: np.ndarray, imps: np.ndarray, norms: np.ndarray, size: int):
        self.start, self.terms, self.imps, self.norms = start, terms, imps, norms
        row = np.repeat(np.arange(len(norms)), np.diff(start))
        order = np.argsort(terms, kind="stable")
        self.row, self.by_term = row[order], imps[order]
        self.held, first = np.unique(terms[order], return_index=True)
        self.bound = np.append(first, len(order))
        self.most = np.maximum.reduceat(self.by_term, first) if len(first) else np.zeros(0, np.int64)
        self.place = np.full(size + 1, -1, np.int64)
        self.place[self.held] = np.arange(len(self.held))

    def survivors(self, terms: np.ndarray, weights: np.ndarray, rest: np.ndarray, least: int) -> np.ndarray:
        """Rows that may reach ``least``."""
        at = self.place[terms]
        largest = np.where(at >= 0, weights * self.most[at], 0).astype(float)
        left = np.append(np.cumsum(largest[::-1])[::-1], 0.0)      # most that coordinates j.. can add
        bound = np.minimum(left, rest * self.norms.max()) * SLACK
        focus = int(np.argmax(bound < least))                       # the last bound is 0, so there is one
        part, square = np.zeros(len(self.norms)), np.zeros(len(self.norms))
        for j in range(focus):
            if at[j] >= 0:
                a, b = self.bound[at[j]], self.bound[at[j] + 1]
                imp = self.by_term[a:b].astype(float)
                part[self.row[a:b]] += float(weights[j]) * imp
                square[self.row[a:b]] += imp * imp
        rows = np.flatnonzero(part)
        others = np.sqrt(np.maximum(self.norms[rows] ** 2 * SLACK - square[rows], 0))
        return rows[(part[rows] + np.minimum(left[focus], rest[focus] * others)) * SLACK >= least]

    def score(self, rows: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Exact scores; ``dense`` holds the query's weight of every term."""
        n = self.start[rows + 1] - self.start[rows]
        end = np.cumsum(n)
        at = np.arange(end[-1]) + np.repeat(self.start[rows] - (end - n), n)
        return np.add.reduceat(dense[self.terms[at]] * self.imps[at], end - n)


def _binary(values: np.ndarray, start: np.ndarray) -> pa.Array:
    """One binary value per row from the rows' concatenated numbers."""
    offsets = (start * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(start) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _numbers(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """(concatenated numbers, first of each row) of a binary column."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return np.frombuffer(raw.tobytes(), kind), (offsets - offsets[0]).astype(np.int64) // np.dtype(kind).itemsize


def _vectors(docs: DataFrame, queries, rows: int = 256) -> DataFrame:
    """(id, n, terms, tf) of every document with at least one term: its terms
    of the query vocabulary, ascending."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = queries.value
        for batch in batches:
            for i in range(0, batch.num_rows, rows):
                part = batch.slice(i, rows)
                ids, start = q.vocabulary.encode(part.column(1).to_pylist())
                doc = np.repeat(np.arange(part.num_rows), np.diff(start))
                known = ids > 0
                code, tf = np.unique(doc[known] * (q.size + 1) + ids[known], return_counts=True)
                first = np.searchsorted(code, np.arange(part.num_rows + 1) * (q.size + 1))
                out = pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(start)), _binary((code % (q.size + 1)).astype(np.int32), first),
                     _binary(tf.astype(np.int32), first)], ["id", "n", "terms", "tf"])
                yield out.filter(pa.array(np.diff(start) > 0))
    return docs.mapInArrow(run, "id long, n long, terms binary, tf binary")


def _read(batch: pa.RecordBatch, n_docs: int, n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first entry of each row, terms, impacts, lengths) of a batch of
    (n, terms, tf)."""
    terms, start = _numbers(batch.column(1), np.int32)
    tf, _ = _numbers(batch.column(2), np.int32)
    n = np.repeat(batch.column(0).to_numpy(), np.diff(start))
    imps = impacts(tf.astype(np.int64), n, n_docs, n_terms)
    squares = np.concatenate([[0.0], np.cumsum(imps.astype(float) ** 2)])
    return start, terms, imps, np.sqrt(squares[start[1:]] - squares[start[:-1]])


def _level(norms: np.ndarray) -> np.ndarray:
    """Level of a length (-1: no coordinate)."""
    return np.where(norms > 0, np.floor(LEVELS * np.log2(np.maximum(norms, 1))), -1).astype(np.int64)


def _counts(vectors: DataFrame, n_docs: int, n_terms: int) -> tuple[dict[int, int], dict[int, int]]:
    """(documents per term, vectors per length level); both are bounded by the
    query vocabulary and by the range of a double."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, level = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in batches:
            _, terms, _, norms = _read(b, n_docs, n_terms)
            more = [np.bincount(terms), np.bincount(_level(norms) + 1)]
            df, level = ([np.pad(x, (0, max(0, len(y) - len(x)))) + np.pad(y, (0, max(0, len(x) - len(y))))
                          for x, y in zip((df, level), more)])
        for kind, x in ((0, df), (1, level)):
            at = np.flatnonzero(x)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), kind, np.int32)), pa.array(at), pa.array(x[at])], ["kind", "key", "n"])
    out: tuple[dict, dict] = ({}, {})
    total = vectors.select("n", "terms", "tf").mapInArrow(run, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))
    for kind, key, n in total.toLocalIterator():
        out[kind][key] = n
    return out[0], {k - 1: n for k, n in out[1].items()}


def _buckets(levels: dict[int, int], wanted: int) -> dict[int, int]:
    """Bucket of each level: runs of levels with about 1 / ``wanted`` of the
    vectors each, 0 the longest."""
    total, out, held, bucket = sum(n for lv, n in levels.items() if lv >= 0), {}, 0, 0
    for lv in sorted((lv for lv in levels if lv >= 0), reverse=True):
        out[lv] = bucket
        held += levels[lv]
        if held * wanted >= total:
            bucket, held = bucket + 1, 0
    return out


def _stored(vectors: DataFrame, n_docs: int, n_terms: int, of_level: dict[int, int], per_part: int,
            rows: dict[int, int]) -> DataFrame:
    """The impact vectors in bucket order, the longest first; crowded buckets
    are dealt to several tasks by a hash of the row."""
    lowest, top = min(of_level), max(of_level)
    table = np.array([of_level.get(lv, -1) for lv in range(lowest, top + 1)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b = batch.select(["n", "terms", "tf"])
            start, terms, imps, norms = _read(b, n_docs, n_terms)
            level = _level(norms)
            bucket = np.where(level >= 0, table[np.maximum(level - lowest, 0)], -1)
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(norms), pa.array(bucket.astype(np.int32)), b.column(1),
                 _binary(imps.astype(np.int32), start)], ["id", "norm", "bucket", "terms", "imps"])  # an impact is at most 10^6
            yield out.filter(pa.array(bucket >= 0))
    made = vectors.select("id", "n", "terms", "tf").mapInArrow(run, "id long, norm double, bucket int, terms binary, imps binary")
    pieces = F.element_at(F.create_map(*[F.lit(int(x)) for b, n in rows.items() for x in (b, -(-n // per_part))]), F.col("bucket"))
    dealt = made.withColumn("piece", F.pmod(F.xxhash64("id", "terms", "imps", "norm", F.spark_partition_id(), F.monotonically_increasing_id()), pieces))
    return stash(dealt.repartition("bucket", "piece").sortWithinPartitions("bucket", F.desc("norm")).drop("piece"), "lemp", "zstd")


def _search(buckets: DataFrame, queries, least: np.ndarray, k: int, rows: int) -> DataFrame:
    """(query, id, score): the best ``k`` of each task for every query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = queries.value
        best = Best(len(q.terms), k, least)
        dense = np.zeros(q.size + 1, np.int64)
        for whole in batches:
            for i in range(0, whole.num_rows, rows):
                batch = whole.slice(i, rows)
                norms = batch.column(1).to_numpy()
                alive = np.flatnonzero(q.length * norms.max() * SLACK >= best.least)  # Cauchy-Schwarz
                if not len(alive):
                    continue
                terms, start = _numbers(batch.column(2), np.int32)
                imps, _ = _numbers(batch.column(3), np.int32)
                part = Slice(start, terms, imps.astype(np.int64), norms, q.size)
                null = batch.column(0).is_null().to_numpy(zero_copy_only=False)
                ids = batch.column(0).fill_null(0).to_numpy()
                for one in alive.tolist():
                    found = part.survivors(q.terms[one], q.weights[one], q.rest[one], best.least[one])
                    if len(found):
                        dense[q.terms[one]] = q.weights[one]
                        best.add(one, part.score(found, dense), ids[found], null[found])
                        dense[q.terms[one]] = 0
        for one in range(len(q.terms)):
            n = len(best.score[one])
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, one)), pa.array(best.id[one], mask=best.null[one]), pa.array(best.score[one])], ["query", "id", "score"])
    return buckets.select("id", "norm", "terms", "imps").mapInArrow(run, "query long, id long, score long")


def _top(found: DataFrame, k: int) -> DataFrame:
    place = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple]]:
    """The items on the driver, one block of bounded size at a time."""
    out, size = [], 0
    for item_id, text in items.toLocalIterator():
        n = 64 + 4 * len(text or "")
        if out and size + n > block_bytes:
            yield out
            out, size = [], 0
        out.append((item_id, text))
        size += n
    if out:
        yield out


def lexical_search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
                   item_id_col: str = "item_id", item_text_col: str = "text", block_bytes: int = 4 << 20,
                   buckets: int = 32, first: int = 2, per_part: int = 50_000, slice_rows: int = 2048) -> DataFrame:
    """The ``k`` documents of highest score for every item: ``item_id_col``,
    rank int (from 1), ``id_col`` long, score long.

    Terms are the runs ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+``,
    A-Z lower-cased.  With N documents that hold a term, L terms in all, n in
    one document, df documents holding a term and tf occurrences in one, the
    score sums, over the item's terms with repeats, w * ((10^9 tf) div
    (1000 tf + 8 m)), w = floor(1000 ln((2N+2)/(2df+1))) and
    m = 25 + ((75 n N) div L).  Equal scores go by ascending id.

    ``buckets`` and ``first`` (how many of them give the thresholds) change
    the work only, never the result.  Items go to the tasks in blocks of at
    most ``block_bytes`` (a single longer item is a block); every block is
    compared with all documents.

    Null or empty text has no terms: such documents are never found, such
    items find nothing.  A null document id sorts behind the others of its
    score.  Repeated documents and items count and rank as rows of their own.
    Only documents with a score above 0 are returned, so an item may have
    fewer than ``k`` rows; empty tables give none.  Other columns are ignored."""
    spark = docs.sparkSession
    ship(spark)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = items.schema[item_id_col].dataType
    asked = items.select(F.col(item_id_col), F.col(item_text_col).cast("string"))
    done: list[DataFrame] = []
    for block in _blocks(asked, block_bytes):
        queries = Queries([t for _, t in block])
        vectors = stash(_vectors(src, spark.sparkContext.broadcast(queries)), "lemp-terms", "zstd")
        n_docs, n_terms = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            break
        df, levels = _counts(vectors, n_docs, n_terms)
        if not df:
            continue
        queries.weigh(df, n_docs)
        sent = spark.sparkContext.broadcast(queries)
        of_level = _buckets(levels, buckets)
        if not of_level:  # every impact is 0
            continue
        rows = dict.fromkeys(of_level.values(), 0)
        for lv, b in of_level.items():
            rows[b] += levels[lv]
        stored = _stored(vectors, n_docs, n_terms, of_level, per_part, rows)
        least = np.zeros(len(block), np.int64)
        found = stash(_top(_search(stored.where(F.col("bucket") < first), sent, least, k, slice_rows), k), "lemp-first")
        for q, score in found.where(F.col("rank") == k).select("query", "score").toLocalIterator():
            least[q] = score
        # a bucket's vectors are shorter than the upper end of its longest level
        longest = {b: 2.0 ** ((max(lv for lv in of_level if of_level[lv] == b) + 1) / LEVELS) for b in rows if b >= first}
        kept = [b for b, n in longest.items() if (queries.length * n * SLACK >= np.maximum(least, 1)).any()]
        later = _search(stored.where(F.col("bucket").isin(kept)), sent, least, k, slice_rows)
        best = _top(found.select("query", "id", "score").union(later), k)
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)],
                                      T.StructType([T.StructField("query", T.LongType()), T.StructField("item", id_type)]))
        done.append(stash(best.join(names, "query").select(
            F.col("item").alias(item_id_col), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score"), "lemp-best"))
    if not done:
        return spark.createDataFrame([], T.StructType([T.StructField(item_id_col, id_type), T.StructField("rank", T.IntegerType()),
                                                       T.StructField(id_col, T.LongType()), T.StructField("score", T.LongType())]))
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


def brute_force(docs: list[tuple], items: list[tuple], k: int = 10) -> list[tuple]:
    """(item id, rank, doc id, score) by scoring every pair; for tests."""
    held = [(i, words(t)) for i, t in docs]
    held = [(i, w) for i, w in held if w]
    n_docs, n_terms = len(held), sum(len(w) for _, w in held)
    df: dict = {}
    for _, w in held:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        scores = []
        for i, w in held:
            m = 100 - 75 + (75 * len(w) * n_docs) // n_terms
            s = sum(weight(df[t], n_docs) * ((1_000_000_000 * w.count(t)) // (1000 * w.count(t) + 8 * m)) for t in words(text) if t in df)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores, key=lambda x: x[:3])[:k])]
    return out
