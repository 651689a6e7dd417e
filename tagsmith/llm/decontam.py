"""Benchmark decontamination by a prefix-filtered set join.

Every benchmark item is cut into windows of ``width`` words (a shorter item is
one window).  A window is a set of shingles (runs of up to ``shingle`` words)
and must be contained whole in a document, so by the prefix principle for
containment 1 a single shingle of it is a necessary prefix.  Shingles are
ordered by rarity, their number of occurrences in all documents, and each
window is indexed under its rarest one.  A document probes the index with its
own shingles; the positional bound places the whole window around the match
and the length bound drops windows that would leave the document; what
remains is compared word for word.

Rarity is counted over all documents in one pass and summed by Spark.  The
index (benchmark-sized) goes to the tasks by broadcast, in slices of at most
``slice_bytes``, as flat arrays: a larger benchmark makes further passes over
the documents, each with one slice, and the marks of the passes are merged per
document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagsmith.llm.common import add_columns, arrow_batches, fresh, map_batches

# words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z -> a-z: digits, a-z and
# every byte of a non-ASCII character; all else separates
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
                   for c in range(256))
ODD = np.uint64(0x9E3779B97F4A7C15)
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def words(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def windows_of(item: list[bytes], width: int) -> list[tuple[bytes, ...]]:
    if not item:
        return []
    return [tuple(item[i:i + width]) for i in range(max(1, len(item) - width + 1))]


def _keys(ids: np.ndarray, size: int) -> np.ndarray:
    """64-bit key of the ``size`` ids from each position on (the last
    positions, which have fewer, are left out).  Keys only select candidates;
    matches are compared id by id."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, np.uint64(size))
    for k in range(size):
        h = (h ^ ids[k:k + n].astype(np.uint64)) * ODD
        h ^= h >> np.uint64(29)
        h *= MIX[k % 2]
        h ^= h >> np.uint64(32)
    return h


class Vocabulary:
    """Ids from 1 for the benchmark's words; 0 for any other word."""

    def __init__(self, known: list[bytes]):
        self.ids = {w: i + 1 for i, w in enumerate(known)}

    def encode(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """The words of all texts as one id array, and where each text starts."""
        get, parts, sizes = self.ids.get, [], []
        for text in texts:
            w = words(text)
            sizes.append(len(w))
            parts.append(np.fromiter(map(get, w, [0] * len(w)), np.int64, len(w)))
        start = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        return (np.concatenate(parts) if parts else np.zeros(0, np.int64)), start


class Windows:
    """Distinct windows of some benchmark items, as places in the items'
    concatenated words, with the items that hold each."""

    def __init__(self, items: list[tuple], width: int, shingle: int):
        found = [(str(item_id), words(text)) for item_id, text in items]
        found = [(i, w) for i, w in found if w]
        self.shingle = shingle
        self.vocabulary = Vocabulary(sorted({x for _, w in found for x in w}))
        self.names, item = np.unique(np.array([i for i, _ in found], object).astype(str), return_inverse=True) if found else (np.array([], str), [])
        ids = self.vocabulary.ids
        n = np.array([len(w) for _, w in found], np.int64)
        start = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
        self.words = np.fromiter((ids[x] for _, w in found for x in w), np.int32, int(start[-1]))
        del found
        own = np.maximum(1, n - width + 1)  # windows of each item
        of = np.repeat(np.arange(len(n)), own)
        at = start[of] + np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
        size = np.minimum(n, width)[of]
        # equal windows become one; windows of equal keys are compared word for word
        key = np.zeros(len(at), np.uint64)
        for m in np.unique(size).tolist():
            on = size == m
            key[on] = _keys(self.words, m)[at[on]] ^ np.uint64(m)
        order = np.lexsort((size, key))
        same = (np.diff(key[order]) == 0) & (np.diff(size[order]) == 0)
        for j in range(width):
            a, b = at[order][:-1], at[order][1:]
            short = j >= size[order][:-1]
            same &= short | (self.words[np.minimum(a + j, len(self.words) - 1)] == self.words[np.minimum(b + j, len(self.words) - 1)])
        group = np.concatenate([[0], np.cumsum(~same)]).astype(np.int64) if len(order) else np.zeros(0, np.int64)
        first = order[np.flatnonzero(np.diff(group, prepend=-1))]
        self.at, self.size = at[first], size[first]
        pairs = np.unique(np.stack([group, np.asarray(item, np.int64)[of[order]]], 1), axis=0) if len(order) else np.zeros((0, 2), np.int64)
        self.item, self.item_start = pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(len(first) + 1))

    def _sizes(self) -> list[int]:
        """Shingle sizes in use: ``shingle``, and the whole of shorter windows."""
        return np.unique(np.minimum(self.size, self.shingle)).tolist()

    def shingles(self, m: int) -> np.ndarray:
        """Sorted distinct keys of the windows' shingles of ``m`` words."""
        on = np.minimum(self.size, self.shingle) == m
        keys = _keys(self.words, m)
        return np.unique(np.concatenate([np.zeros(0, np.uint64), *(keys[(self.at[on] + o)[o + m <= self.size[on]]] for o in range(int(self.size[on].max()) - m + 1))]))

    def count(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """(keys, occurrences in the texts) of the windows' shingles."""
        ids, start = self.vocabulary.encode(texts)
        keys, found = [], []
        for m in self._sizes():
            known = self.known[m]
            k, _ = _positions(ids, start, m, known)
            keys.append(known)
            found.append(np.bincount(k, minlength=len(known)))
        return (np.concatenate(keys), np.concatenate(found)) if keys else (np.zeros(0, np.uint64), np.zeros(0, np.int64))

    def prepare_count(self) -> "Windows":
        self.known = {m: self.shingles(m) for m in self._sizes()}
        return self

    def choose_prefixes(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Keep for each window its rarest shingle (the earliest on a tie);
        ``keys`` are sorted, a key that is missing was not found."""
        self.spot = {}
        of = np.minimum(self.size, self.shingle)
        for m in self._sizes():
            win = np.flatnonzero(of == m)
            all_keys = _keys(self.words, m)
            best, offset, chosen = np.full(len(win), np.iinfo(np.int64).max), np.zeros(len(win), np.int64), np.zeros(len(win), np.uint64)
            for o in range(int(self.size[win].max()) - m + 1):
                fits = o + m <= self.size[win]
                k = all_keys[np.minimum(self.at[win] + o, len(all_keys) - 1)]
                at = np.minimum(np.searchsorted(keys, k), max(0, len(keys) - 1))
                n = np.where(keys[at] == k, counts[at], 0) if len(keys) else np.zeros(len(win), np.int64)
                on = fits & (n < best)
                best[on], offset[on], chosen[on] = n[on], o, k[on]
            # a shingle that no document holds cannot match: its window is dropped
            kept = np.flatnonzero(best > 0)
            kept = kept[np.argsort(chosen[kept], kind="stable")]
            self.spot[m] = (chosen[kept], win[kept], offset[kept])
        self.known = None

    def find(self, texts: list) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[set]]:
        """Per text: number of words, occurrences of windows as (first word,
        end) and the items that occur."""
        ids, start = self.vocabulary.encode(texts)
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        items: list[set] = [set() for _ in texts]
        for m, (spot_key, spot_window, spot_offset) in self.spot.items():
            known, first = np.unique(spot_key, return_index=True)
            last = np.append(first[1:], len(spot_key))
            k, pos = _positions(ids, start, m, known)
            n = last[k] - first[k]
            spot = np.repeat(first[k], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            pos = np.repeat(pos, n)
            win = spot_window[spot]
            begin = pos - spot_offset[spot]        # positional bound
            doc = np.searchsorted(start, pos, "right") - 1
            fits = (begin >= start[doc]) & (begin + self.size[win] <= start[doc + 1])  # length bound
            win, begin, doc = win[fits], begin[fits], doc[fits]
            same = np.ones(len(win), bool)
            for j in range(int(self.size[win].max(initial=0))):        # verify word for word
                inside = j < self.size[win]
                same &= ~inside | (ids[np.minimum(begin + j, len(ids) - 1)] == self.words[np.minimum(self.at[win] + j, len(self.words) - 1)])
            for w, b, d in zip(win[same].tolist(), begin[same].tolist(), doc[same].tolist()):
                b -= int(start[d])
                spans[d].append((b, b + int(self.size[w])))
                items[d].update(self.names[self.item[self.item_start[w]:self.item_start[w + 1]]].tolist())
        return np.diff(start), spans, items


def _positions(ids, start, size: int, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index into ``known``, position) of the ``size``-word runs within one
    text whose key is in the sorted array ``known``."""
    if not len(known) or len(ids) < size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # only runs without a foreign word can match
    bad = np.concatenate([[0], np.cumsum(ids == 0)])
    pos = np.flatnonzero(bad[size:] == bad[:-size])
    pos = pos[start[np.searchsorted(start, pos, "right")] >= pos + size]
    keys = _keys(ids, size)[pos]
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    hit = known[at] == keys
    return at[hit], pos[hit]


def _slices(benchmark: DataFrame, slice_bytes: int, width: int) -> Iterator[list[tuple]]:
    """The benchmark on the driver, one slice of bounded size at a time (a
    single empty one for an empty benchmark).  An item over the bound is cut
    into parts that overlap by ``width`` - 1 words, so that every window of it
    is in one part."""
    out, size = [], 0
    for item_id, text in benchmark.toLocalIterator():
        parts = [text]
        if text and len(text) > slice_bytes:
            w = words(text)
            step = max(1, slice_bytes // 16)
            parts = [b" ".join(w[i:i + step + width - 1]).decode("utf-8", "surrogatepass") for i in range(0, max(1, len(w) - width + 1), step)]
        for part in parts:
            n = 64 + len(part or "")
            if size and size + n > slice_bytes:
                yield out
                out, size = [], 0
            out.append((item_id, part))
            size += n
    yield out


def _found(docs: DataFrame, benchmark: DataFrame, text_col: str, item_id_col: str, item_text_col: str, width: int,
           shingle: int, slice_bytes: int) -> tuple[DataFrame, str, str, str]:
    """``docs`` with three columns of new names: merged spans (flat), item
    ids and number of words."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id_col), F.col(item_text_col).cast("string"))
    out, spans_col, items_col, size_col = docs, fresh(docs, "spans"), fresh(docs, "items"), fresh(docs, "words")
    added = T.StructType([T.StructField(spans_col, T.ArrayType(T.LongType())),
                          T.StructField(items_col, T.ArrayType(T.StringType())), T.StructField(size_col, T.LongType())])
    texts = docs.select(F.col(text_col).cast("string"))
    first = True
    for part in _slices(items, slice_bytes, width):
        index = Windows(part, width, shingle).prepare_count()
        sent = spark.sparkContext.broadcast(index)
        counts = map_batches(texts, lambda t, b=sent: _counted(b.value, t), "key long, n long") \
            .groupBy("key").agg(F.sum("n").alias("n"))
        # at most as many rows as the slice has shingles
        got = [(b.column(0).to_numpy().view(np.uint64), b.column(1).to_numpy()) for b in arrow_batches(counts)]
        keys, n = (np.concatenate([np.zeros(0, kind), *(x[c] for x in got)]) for c, kind in ((0, np.uint64), (1, np.int64)))
        order = np.argsort(keys)
        index.choose_prefixes(keys[order], n[order])
        sent.unpersist()
        probe = spark.sparkContext.broadcast(index)

        def marks(text, *before, b=probe):
            n, spans, found = b.value.find(text.to_pylist())
            spans = [[x for s in one for x in s] for one in spans]
            if before:
                spans = [a + s for a, s in zip(before[0].to_pylist(), spans)]
                found = [set(a) | f for a, f in zip(before[1].to_pylist(), found)]
            return [pa.array([_merged(s) for s in spans], pa.list_(pa.int64())),
                    pa.array([sorted(f) for f in found], pa.list_(pa.string())), pa.array(n)]
        out = add_columns(out, [text_col] + ([] if first else [spans_col, items_col]), marks, added, rows=512)
        first = False
    return out, spans_col, items_col, size_col


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                      item_text_col: str = "text", width: int = 10, shingle: int = 5, slice_bytes: int = 8 << 20) -> DataFrame:
    """The rows of ``docs`` without any occurrence of a benchmark window, all
    their columns as they are (see ``mark_contamination``)."""
    out, spans_col, _, _ = _found(docs, benchmark, text_col, item_id_col, item_text_col, width, shingle, slice_bytes)
    return out.where(F.size(spans_col) <= 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def mark_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                       item_id_col: str = "item_id", item_text_col: str = "text", width: int = 10,
                       shingle: int = 5, slice_bytes: int = 8 << 20) -> DataFrame:
    """``docs`` with the added columns n_words, n_hit, n_items (long),
    items_sha256 (hex of the item ids, sorted as strings, comma-joined),
    contaminated (boolean) and hits (array of [first word, end) spans, merged).

    A word is hit if it lies inside an occurrence of a window.  Null or empty
    text has no words and is clean; items without words have no window; items
    with equal ids count once; a null item id counts as the text ``None``.
    Repeated documents are marked each.  A column of ``docs`` with one of the
    added names is replaced.  An empty benchmark marks nothing.

    A benchmark of any size works; each slice of ``slice_bytes`` costs two
    passes over the documents."""
    out, spans_col, items_col, size_col = _found(docs, benchmark, text_col, item_id_col, item_text_col, width, shingle, slice_bytes)
    spans, ids = F.col(spans_col), F.col(items_col)
    pairs = F.transform(F.sequence(F.lit(0), (F.size(spans) / 2).cast("int") - 1),
                        lambda i: F.array(F.get(spans, 2 * i), F.get(spans, 2 * i + 1)))
    pairs = F.when(F.size(spans) > 0, pairs).otherwise(F.array().cast("array<array<bigint>>"))
    new = {
        "n_words": F.col(size_col),
        "n_hit": F.aggregate(pairs, F.lit(0).cast("long"), lambda s, p: s + p[1] - p[0]),
        "n_items": F.size(ids).cast("long"),
        "items_sha256": F.sha2(F.array_join(ids, ",").cast("binary"), 256),
        "contaminated": F.size(spans) > 0,
        "hits": pairs,
    }
    return out.withColumns(new).drop(spans_col, items_col, size_col)


def _counted(index: Windows, t: pa.Table) -> pa.Table:
    keys, n = index.count(t.column(0).to_pylist())
    keys, n = keys[n > 0], n[n > 0]
    return pa.table([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], names=["key", "n"])


def _merged(flat: list[int]) -> list[int]:
    """Flat [first, end) spans as disjoint ascending ones."""
    out: list[int] = []
    for b, e in sorted(zip(flat[::2], flat[1::2])):
        if out and b <= out[-1]:
            out[-1] = max(out[-1], e)
        else:
            out += [b, e]
    return out


def brute_force(texts: list, items: list[tuple], width: int = 10) -> list[tuple]:
    """(n_words, n_hit, n_items, items_sha256, contaminated) per text, by
    comparing every window with every position; for tests."""
    out = []
    for text in texts:
        w, hit, found = words(text), set(), set()
        for item_id, item in items:
            for win in windows_of(words(item), width):
                for i in range(len(w) - len(win) + 1):
                    if tuple(w[i:i + len(win)]) == win:
                        hit.update(range(i, i + len(win)))
                        found.add(str(item_id))
        joined = ",".join(sorted(found)).encode()
        out.append((len(w), len(hit), len(found), hashlib.sha256(joined).hexdigest(), bool(hit)))
    return out
