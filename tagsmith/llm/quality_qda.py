"""Document quality by regularised quadratic discriminant analysis.

Transformed statistics of a document (lengths, repetition, character classes)
are modelled by one Gaussian per class.  The class covariances are shrunk
towards the pooled covariance and then towards a multiple of the identity;
their Cholesky factors are computed once and kept with the model.  A score is
the logistic of the difference of the two log densities (Mahalanobis distance
by forward substitution, log-determinant from the factor's diagonal) plus the
log ratio of the class sizes.

A short text's statistics say little, so the standardised statistics are
damped by n / (n + ``DAMPING``), n its number of words, towards the centre.

The sums and cross products of both steps (centre and scale, then the classes)
are additive, so Spark computes them over all labelled training rows, however
many.
"""

from __future__ import annotations

from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagsmith.llm.common import LOWER, fresh, map_batches, remainder, stash

NAMES = ["log_word_length", "richness", "top_word", "repeats", "repeated_pairs", "symbols", "punctuation",
         "digits", "capitals", "bare_tokens", "repeated_lines", "short_words"]
DAMPING = 10.0


def _but(chars: bytes) -> bytes:
    """The ASCII characters ``chars``, for bytes.translate(None, ...)."""
    return bytes(sorted(set(chars)))


PUNCTUATION = _but(b".,;:!?'\"()-")
SYMBOLS = _but(bytes(c for c in range(33, 127) if not chr(c).isalnum()))
SYMBOLS = bytes(c for c in SYMBOLS if c not in PUNCTUATION)
DIGITS, CAPITALS = b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def statistics(text: str | None) -> list[float]:
    """Number of words and the transformed statistics of a whole text (all
    zero without words)."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.translate(LOWER).split()
    n = len(words)
    if not n:
        return [0.0] * (1 + len(NAMES))
    size = len(raw)
    counts = Counter(words)
    rows = [x for x in raw.split(b"\n") if x.strip()]
    share = lambda chars: (size - len(raw.translate(None, chars))) / size
    pairs = len(set(zip(words, words[1:])))
    letters = sum(map(len, words))
    bare = sum(k for w, k in counts.items() if len(w) < 4 and not w.isalnum() and max(w) < 128 and not any(chr(c).isalnum() for c in w))
    return [float(n), np.log(letters / n), np.log1p(len(counts)) / np.log1p(n), np.sqrt(max(counts.values()) / n) if n > 4 else 0.5,
            np.sqrt(sum(map(eq, words, words[1:])) / n), np.sqrt(1 - pairs / (n - 1)) if n > 1 else 0.0,
            np.sqrt(share(SYMBOLS)), np.sqrt(share(PUNCTUATION)), np.sqrt(share(DIGITS)), np.sqrt(share(CAPITALS)),
            np.sqrt(bare / n), np.sqrt(1 - len(set(rows)) / len(rows)),
            np.sqrt(sum(k for w, k in counts.items() if len(w) <= 3) / n)]


class Scale:
    """Centre and spread of the statistics, and the damping of short texts."""

    def __init__(self, n: float, sums: np.ndarray, squares: np.ndarray):
        self.centre = sums / max(n, 1)
        self.spread = np.sqrt(np.maximum(squares / max(n, 1) - self.centre ** 2, 1e-6))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        words = x[:, :1]
        return (x[:, 1:] - self.centre) / self.spread * (words / (words + DAMPING))


class Model:
    """Means, log priors and cached Cholesky factors of the two classes."""

    def __init__(self, scale: Scale, n: np.ndarray, sums: np.ndarray, cross: np.ndarray, to_pooled: float, to_identity: float):
        self.scale = scale
        self.ready = bool((n > 0).all())
        if not self.ready:
            self.share = float((n[1] + 0.5) / (n.sum() + 1))
            return
        self.means = sums / n[:, None]
        within = cross - n[:, None, None] * self.means[:, :, None] * self.means[:, None, :]
        pooled = within.sum(0) / n.sum()
        self.log_prior = np.log(n / n.sum())
        self.factors, self.log_det = [], []
        for k in (0, 1):
            cov = (1 - to_pooled) * within[k] / n[k] + to_pooled * pooled
            cov = (1 - to_identity) * cov + to_identity * max(np.trace(cov) / len(cov), 1e-3) * np.eye(len(cov))
            self.factors.append(np.linalg.cholesky(cov))
            self.log_det.append(2 * np.log(np.diag(self.factors[k])).sum())

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.ready:
            return np.full(len(x), self.share)
        z = self.scale(x)
        d = []
        for k in (0, 1):
            r = _forward(self.factors[k], (z - self.means[k]).T)
            d.append(self.log_prior[k] - 0.5 * (r * r).sum(0) - 0.5 * self.log_det[k])
        return 1 / (1 + np.exp(np.clip(d[0] - d[1], -500, 500)))


def _forward(low: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Solve ``low @ r = b`` for a lower triangular factor."""
    r = np.empty_like(b)
    for i in range(len(low)):
        r[i] = (b[i] - low[i, :i] @ r[:i]) / low[i, i]
    return r


def _sums(joined: DataFrame, size: int, vector) -> list[tuple[int, np.ndarray]]:
    """Per class the sum of ``vector(x)`` (``size`` numbers a row set), added
    up per task first."""
    def run(t: pa.Table) -> pa.Table:
        y, x = t.column(0).to_numpy(), _rows(t.column(1))
        own = np.unique(y)
        return pa.table([pa.array(own.astype(np.int32)), pa.array([vector(x[y == k]).tolist() for k in own], pa.list_(pa.float64()))], names=["y", "s"])
    parts = map_batches(joined, run, "y int, s array<double>", 8192)
    got = parts.groupBy("y").agg(*(F.sum(F.col("s")[i]).alias(f"s{i}") for i in range(size))).collect()
    return [(r[0], np.array(r[1:], float)) for r in got]


def fit(features: DataFrame, labels: DataFrame, to_pooled: float = 0.1, to_identity: float = 0.05) -> Model:
    """The model of all rows of ``features`` (id, x) that have a 0/1 label in
    ``labels`` (id, y)."""
    p = len(NAMES)
    joined = stash(features.join(labels, "id").select(F.col("y").cast("int").alias("y"), "x"), "labelled")
    first = sum((v for _, v in _sums(joined, 1 + 2 * p, lambda x: np.concatenate([[len(x)], x[:, 1:].sum(0), (x[:, 1:] ** 2).sum(0)]))),
                np.zeros(1 + 2 * p))
    scale = Scale(first[0], first[1:1 + p], first[1 + p:])

    def moments(x: np.ndarray) -> np.ndarray:
        z = scale(x)
        return np.concatenate([[len(z)], z.sum(0), (z.T @ z).ravel()])
    n, total, cross = np.zeros(2), np.zeros((2, p)), np.zeros((2, p, p))
    for k, v in _sums(joined, 1 + p + p * p, moments):
        n[k], total[k], cross[k] = v[0], v[1:1 + p], v[1 + p:].reshape(p, p)
    return Model(scale, n, total, cross, to_pooled, to_identity)


def _rows(column) -> np.ndarray:
    return np.array(column.to_pylist(), float).reshape(-1, 1 + len(NAMES))


def label_table(labels: DataFrame, modulus: int, held_out: int, id_col: str, label_col: str) -> DataFrame:
    """(id, y) of the training labels: one row per id (the larger label of
    conflicting ones), null ids and labels other than 0 and 1 left out."""
    return labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")) \
        .where(F.col("id").isNotNull() & F.col("y").isin(0, 1) & (remainder(F.col("id"), modulus) != held_out)) \
        .groupBy("id").agg(F.max("y").alias("y"))


def features_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x): the statistics of every document, written once."""
    def run(t: pa.Table) -> pa.Table:
        return pa.table([t.column(0), pa.array([statistics(x) for x in t.column(1).to_pylist()], pa.list_(pa.float64()))], names=["id", "x"])
    return stash(map_batches(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")),
                             run, "id long, x array<double>", 512), "statistics")


def score_quality(docs: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1, to_pooled: float = 0.1,
                  to_identity: float = 0.05, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality") -> DataFrame:
    """Per document: id, held_out, score (0 to 1, higher: label 1 likelier)
    and predicted (1 if score >= 0.5).

    The model learns from all labelled documents whose crc32 of the id's text
    modulo ``modulus`` is not ``held_out``.  Null and empty texts are scored
    as the centre of the statistics.  With no labelled row of one
    class every score is the smoothed share of class 1.  A null id is no
    held-out one and matches no label.  Repeated rows are scored (and, if
    labelled, learned) each; other columns are ignored; an empty table gives
    no rows."""
    x = features_of(docs, id_col, text_col)
    model = fit(x, label_table(labels, modulus, held_out, id_col, label_col), to_pooled, to_identity)
    scored = map_batches(x, lambda t: _scored(model, t), "id long, score double", 8192)
    return scored.select(F.col("id").alias(id_col),
                         F.coalesce(remainder(F.col("id"), modulus) == held_out, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _scored(model: Model, t: pa.Table) -> pa.Table:
    return pa.table([t.column(0), pa.array(model.score(_rows(t.column(1))))], names=["id", "score"])


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, modulus: int = 3, held_out: int = 1,
                 to_pooled: float = 0.1, to_identity: float = 0.05, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "quality") -> DataFrame:
    """``docs`` without the rows whose score is below ``threshold``; same
    columns, same null rules as :func:`score_quality`.  The decision is made
    row by row from the row's own text."""
    known = stash(label_table(labels, modulus, held_out, id_col, label_col), "labels")
    name = fresh(docs, "id")
    # statistics of the labelled rows alone: the others are scored in one pass below
    taught = docs.select(F.col(id_col).cast("long").alias(name), F.col(text_col).alias("text")).join(known.select(F.col("id").alias(name)), name, "left_semi")
    model = fit(features_of(taught, name, "text"), known, to_pooled, to_identity)
    at = docs.columns.index(text_col)

    def run(t: pa.Table) -> pa.Table:
        stats = np.array([statistics(x) for x in t.column(at).to_pylist()], float).reshape(-1, 1 + len(NAMES))
        return t.filter(pa.array(model.score(stats) >= threshold))
    return map_batches(docs, run, docs.schema, 512)
