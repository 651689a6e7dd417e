"""Packing token sequences into fixed windows by non-negative least squares.

A document is cut into full windows and a rest; a rest shorter than a window
is one piece of its real length.  The plan sees the histogram of these
lengths, which has fewer counts than a window has tokens, whatever the corpus:

1. enumerate shallow combinations of the ``frequent`` commonest lengths that
   fill a window exactly: repeats of one or two lengths, or three different
   ones, at most ``shallow`` pieces;
2. solve ``min |A x - h|, x >= 0`` for the repeat counts x of the combinations
   against the histogram h (Lawson-Hanson);
3. round down, so that no length is overdrawn;
4. pack the residual counts of all lengths greedily: from the largest length
   on, with the largest lengths that still fit, until one or two fill the
   window, as often as the counts allow.

Only what no combination takes forms a stream that is cut at window ends, so
every document is whole but for full windows and those cuts, and the last
sequence alone can have padding.  Spark ranks the pieces of each length (a
count per task and length, a prefix sum over the tasks) and a piece's rank
tells its sequence and offset.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagsmith.llm.common import map_batches, ship, stash
from tagsmith.llm.tokens import encoder


def nnls(a: np.ndarray, b: np.ndarray, steps: int = 1000) -> np.ndarray:
    """Non-negative least squares (Lawson and Hanson's active sets)."""
    n = a.shape[1]
    x, free = np.zeros(n), np.zeros(n, bool)
    tol = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(steps):
        w = a.T @ (b - a @ x)
        w[free] = -np.inf
        if free.all() or w.max(initial=-np.inf) <= tol:
            break
        free[int(w.argmax())] = True
        while True:
            z = np.zeros(n)
            z[free] = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            bad = free & (z <= 0)
            if not bad.any():
                x = z
                break
            ratio = np.where(bad, x / np.maximum(x - z, 1e-300), np.inf)
            x = x + ratio.min() * (z - x)
            free &= x > 1e-12
            x[~free] = 0
    return x


def combinations(lengths: list[int], window: int, shallow: int = 64) -> list[dict[int, int]]:
    """Combinations {length: times} of at most ``shallow`` pieces that fill
    ``window`` exactly: repeats of one or two lengths, or three different
    ones."""
    have = set(lengths)
    out = [{a: window // a} for a in lengths if window % a == 0 and window // a <= shallow]
    for a, b in itertools.combinations(lengths, 2):
        out += [{a: k, b: (window - k * a) // b} for k in range(1, min(shallow, (window - 1) // a) + 1)
                if (window - k * a) % b == 0 and 0 < (window - k * a) // b <= shallow - k]
        c = window - a - b
        if c > max(a, b) and c in have:
            out.append({a: 1, b: 1, c: 1})
    return out


class Plan:
    """Where the r-th piece of each length goes: a window and an offset, or a
    place in the stream of what no exact combination uses."""

    def __init__(self, counts: dict[int, int], window: int, frequent: int = 96, columns: int = 1024):
        self.window = window
        left = np.zeros(window + 1, np.int64)
        for n, c in counts.items():
            left[n] = c
        lengths = np.flatnonzero(left).tolist()
        top = sorted(sorted(lengths, key=lambda n: (-left[n], n))[:frequent])
        found = sorted(combinations(top, window), key=lambda c: (sum(c.values()), sorted(c)))[:columns]
        used: list[tuple[dict[int, int], int]] = []

        def use(combo: dict[int, int], most: int) -> None:
            times = min([most, *(int(left[n]) // k for n, k in combo.items())])
            if times > 0:
                used.append((combo, times))
                for n, k in combo.items():
                    left[n] -= k * times
        if found:
            row = {n: i for i, n in enumerate(top)}
            a = np.zeros((len(top), len(found)))
            for j, c in enumerate(found):
                for n, k in c.items():
                    a[row[n], j] = k
            scale = max(int(left[n]) for n in top)
            x = nnls(a, left[top] / scale) * scale
            for j in np.argsort(-x, kind="stable"):
                use(found[j], int(x[j] + 1e-6))
        for n in reversed(lengths):  # residual: largest first, while a window fills exactly
            while left[n]:
                combo = _fill(left, n, window)
                if combo is None:
                    break
                use(combo, int(left[n]))
        # per length: first rank, first window, pieces per window, offset
        rows: dict[int, list[tuple[int, int, int, int]]] = {n: [] for n in lengths}
        rank, self.windows = dict.fromkeys(lengths, 0), 0
        for combo, times in used:
            offset = 0
            for n in sorted(combo, reverse=True):
                rows[n].append((rank[n], self.windows, combo[n], offset))
                rank[n] += combo[n] * times
                offset += n * combo[n]
            self.windows += times
        self.rows = {n: np.array(r, np.int64).reshape(-1, 4) for n, r in rows.items()}
        self.planned, self.stream_at, self.stream = rank, {}, 0
        for n in reversed(lengths):
            self.stream_at[n] = self.stream
            self.stream += n * int(left[n])

    def place(self, length: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(in a planned window?, window or -1, offset there or stream place)."""
        planned = rank < self.planned[length]
        window, at = np.full(len(rank), -1), np.zeros(len(rank), np.int64)
        if planned.any():
            r, rows = rank[planned], self.rows[length]
            k = np.searchsorted(rows[:, 0], r, "right") - 1
            j = r - rows[k, 0]
            window[planned] = rows[k, 1] + j // rows[k, 2]
            at[planned] = rows[k, 3] + (j % rows[k, 2]) * length
        at[~planned] = self.stream_at[length] + (rank[~planned] - self.planned[length]) * length
        return planned, window, at


def _fill(left: np.ndarray, n: int, window: int, deep: int = 16) -> dict[int, int] | None:
    """A window of a piece of length ``n`` and others of those left, at most
    ``deep``: the largest that fits, until one or two fill what remains."""
    rest, picked, room = left.copy(), [n], window - n
    rest[n] -= 1
    while room and len(picked) < deep:
        if rest[room]:
            return dict(Counter([*picked, room]))
        big = np.arange(room - 1, (room - 1) // 2, -1)
        ok = (rest[big] > 0) & (rest[room - big] > (big == room - big))
        if ok.any():
            b = int(big[ok.argmax()])
            return dict(Counter([*picked, b, room - b]))
        fits = np.flatnonzero(rest[:room])
        if not len(fits):
            return None
        b = int(fits[-1])
        rest[b] -= 1
        picked.append(b)
        room -= b
    return None if room else dict(Counter(picked))


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, unit: int = 64,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of the packed documents: doc_id, start and length (in the
    document's ids), doc_tokens, sequence_id, offset (in the sequence) and ids
    (binary, little-endian uint32).  Sequences hold ``unit * unit`` tokens, all
    full but the last one.  A document has a piece per window it spans and at
    most as many more as the stream cuts it.

    A document is its text's ids and then ``end_id``; null text is empty.
    Every id lies in exactly one piece.  Rows with null or repeated ids are
    packed like any other; other columns are ignored; an empty table gives no
    pieces."""
    size = unit * unit
    ship(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()
    names = ["part", "size", "rank", "doc_id", "start", "doc_tokens", "wide", "raw"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, enc, seen = TaskContext.get().partitionId(), encoder(tokenizer), np.zeros(size + 1, np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                some = batch.slice(i, 256)
                rows = []
                for d, raw in zip(some.column(0).to_pylist(), enc.encode(some.column(1).to_pylist())):
                    ids = np.frombuffer(raw + end, "<u4")
                    wide = int(ids.max()) > 0xFFFF
                    stored = ids if wide else ids.astype("<u2")
                    n = len(ids)
                    for start in range(0, n, size):
                        length = min(size, n - start)
                        rows.append((part, length, int(seen[length]), d, start, n, wide, stored[start:start + length].tobytes()))
                        seen[length] += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(),
                                                                 pa.int64(), pa.bool_(), pa.binary()))], names)
    pieces = stash(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
                   .mapInArrow(cut, "part int, size int, rank long, doc_id long, start long, doc_tokens long, wide boolean, raw binary"),
                   "pieces", compression="zstd")
    # rank over all tasks: one row per task and length
    per_task = pieces.groupBy("part", "size").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    base = stash(per_task.select("part", "size", "n", F.coalesce(before, F.lit(0)).alias("base")), "ranks")
    totals = base.groupBy("size").agg(F.sum("n")).collect()  # at most a row per token of a window
    plan = Plan({k: n for k, n in totals}, size)

    def put(t: pa.Table) -> pa.Table:
        col = {n: t.column(n).to_numpy() for n in ("size", "rank", "base", "start", "doc_tokens")}
        rank, at = col["rank"] + col["base"], np.zeros(len(col["size"]), np.int64)
        for length in np.unique(col["size"]).tolist():
            on = col["size"] == length
            planned, window, place = plan.place(length, rank[on])
            at[on] = np.where(planned, window, plan.windows) * size + place
        doc, wide, raw = (t.column(n).to_pylist() for n in ("doc_id", "wide", "raw"))
        rows = []
        for i, (w, r) in enumerate(zip(wide, raw)):
            ids = np.frombuffer(r, "<u4" if w else "<u2").astype("<u4")
            p, a = int(at[i]), 0
            while a < len(ids):  # a stream piece is cut where a sequence ends
                b = min(len(ids), a + size - (p + a) % size)
                rows.append((doc[i], int(col["start"][i]) + a, b - a, int(col["doc_tokens"][i]), (p + a) // size,
                             (p + a) % size, ids[a:b].tobytes()))
                a = b
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows), [pa.int64()] * 6 + [pa.binary()])],
                        names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])
    return map_batches(pieces.join(base.drop("n"), ["part", "size"]), put,
                       "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary", 4096)


def sequences(pieces: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, n_tokens, ids (binary) and the
    documents and offsets of their pieces.  A sequence is bounded, and so is
    its group."""
    part = F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id", "start"))), lambda x: x)
    got = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), part.alias("p"))
    return got.select("sequence_id", "n_tokens",
                      F.aggregate("p", F.lit("").cast("binary"), lambda s, x: F.concat(s, x["ids"])).alias("ids"),
                      F.col("p.doc_id").alias("doc_ids"), F.col("p.start").alias("starts"), F.col("p.offset").alias("offsets"))
