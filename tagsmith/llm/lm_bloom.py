"""Language-model scoring from a log-frequency Bloom filter.

N-gram counts are quantised on a logarithmic scale: a count c has the level
``1 + floor(log_base c)`` and the filter holds the pairs (n-gram, 1) up to
(n-gram, level).  A worker finds a count again by probing (n-gram, 1),
(n-gram, 2), ... until a probe fails.  A count is never underestimated; a
false positive raises it by a level.

The filter is blocked twice.  A key's bits all lie in one segment, chosen by
the key, so Spark builds the segments apart (one shuffle of the per-task
counts) and the filter is their concatenation.  The bits of one (n-gram, level)
lie in one 64-bit word of the segment, so a membership probe reads one word.
The filter grows with the corpus: the counts are added up first, and it has
``bits_per_key`` bits for every (n-gram, level) that the corpus holds.

Next to the model score, the additive base score uses exact unigram counts.
The documents' distinct keys go to buckets of segments by a shuffle, and the
levels and counts found there come back to the documents; no task and not the
driver then holds more than a bucket.  Small corpora take the same way, so
disk grows in proportion to the input.  Keys and counts are shuffled as sorted,
compressed runs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagsmith.llm.common import remainder, ship, stash, words_of

WORDS = 1 << 10  # 64-bit words of a segment
BUCKET = 512  # segments that a probe goes to together at most (4 MB)
START, END = (np.uint64(xxhash.xxh64_intdigest(x, 7)) for x in (b"\x01start", b"\x01end"))  # hashed with another seed than words
GOLD = np.uint64(0x9E3779B97F4A7C15)
A, B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (MurmurHash3)."""
    x = (x ^ (x >> np.uint64(33))) * A
    x = (x ^ (x >> np.uint64(33))) * B
    return x ^ (x >> np.uint64(33))


def word_keys(text: str | None) -> np.ndarray:
    w = words_of(text)
    return np.fromiter(map(xxhash.xxh64_intdigest, w), np.uint64, len(w))


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return _mix(before * GOLD + word)


def text_keys(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys of the tokens of all texts, keys of the token before each, first
    token of each text); every text ends with the end token."""
    parts, before, sizes = [], [], []
    end, start = np.array([END]), np.array([START])
    for t in texts:
        w = word_keys(t)
        parts += [w, end]
        before += [start, w]
        sizes.append(len(w) + 1)
    if not texts:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(1, np.int64)
    return np.concatenate(parts), np.concatenate(before), np.concatenate([[0], np.cumsum(sizes)])


class Filter:
    """Blocked Bloom filter of (key, level) pairs over ``segments`` segments."""

    def __init__(self, segments: int, hashes: int, base: float, words: np.ndarray | None = None):
        if not 1 <= hashes <= 6:
            raise ValueError("hashes must be 1..6")
        self.segments, self.hashes, self.base, self.words = segments, hashes, base, words
        self.top = 64  # no count has a higher level
        self.first = 0  # the segment with which ``words`` begins

    def segment(self, keys: np.ndarray) -> np.ndarray:
        """Segments are ranges of the (evenly spread) keys, so sorted keys
        probe the filter from its beginning to its end."""
        return ((keys >> np.uint64(32)) * np.uint64(self.segments) >> np.uint64(32)).astype(np.int64)

    def probe(self, h: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """(word within the segment, bits in it) of a level of the keys whose
        mixed hash is ``h``."""
        m = (h + np.uint64(level * int(GOLD) & (1 << 64) - 1)) * A
        word, m = (m >> np.uint64(54)).astype(np.int64), m >> np.uint64(18)
        bits = np.uint64(1) << (m & np.uint64(63))
        for i in range(1, self.hashes):
            bits |= np.uint64(1) << (m >> np.uint64(6 * i) & np.uint64(63))
        return word, bits

    def put(self, words: np.ndarray, at: np.ndarray, keys: np.ndarray, level: np.ndarray) -> None:
        """Set (key, 1) .. (key, level) in ``words``, where a key's segment
        begins at word ``at``."""
        h = _mix(keys ^ GOLD)
        for lv in range(1, int(level.max(initial=0)) + 1):
            on = level >= lv
            at, h, level = at[on], h[on], level[on]
            word, bits = self.probe(h, lv)
            np.bitwise_or.at(words, at + word, bits)

    def level(self, count: np.ndarray) -> np.ndarray:
        return 1 + np.floor(np.log(np.maximum(count, 1)) / np.log(self.base) + 1e-9).astype(np.int64)

    def count(self, level: np.ndarray) -> np.ndarray:
        """Middle of a level's counts; 0 for level 0."""
        low = np.ceil(self.base ** (level - 1.0) - 1e-9)
        high = np.maximum(low, np.ceil(self.base ** level - 1e-9) - 1)
        return np.where(level > 0, (low + high) / 2, 0.0)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Levels by repeated membership probes (0: not in the filter)."""
        out, alive, level = np.zeros(len(keys), np.int64), np.arange(len(keys)), 1
        at, h = (self.segment(keys) - self.first) * WORDS, _mix(keys ^ GOLD)
        while len(alive) and level <= self.top:
            word, bits = self.probe(h, level)
            on = np.flatnonzero(self.words[at + word] & bits == bits)
            alive, at, h = alive[on], at[on], h[on]
            out[alive] = level
            level += 1
        return out


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    """Which of ``parts`` equal ranges of the keys each key lies in."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _planes(x: np.ndarray) -> bytes:
    """64-bit numbers, byte by byte and compressed; their high zeros take no room."""
    raw = np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(x).to_bytes(8, "little") + (pa.Codec("zstd", 1).compress(raw, asbytes=True) if raw else b"")


def _unplaned(raw, kind: type) -> np.ndarray:
    n = int.from_bytes(memoryview(raw)[:8], "little")
    if not n:
        return np.zeros(0, kind)
    flat = np.frombuffer(pa.Codec("zstd").decompress(memoryview(raw)[8:], 8 * n), np.uint8)
    return np.ascontiguousarray(flat.reshape(8, -1).T).reshape(-1).view(kind)


def _run(keys: np.ndarray) -> bytes:
    """Sorted keys by their differences."""
    return _planes(np.diff(keys, prepend=np.uint64(0)))


def _unrun(raw) -> np.ndarray:
    return np.cumsum(_unplaned(raw, np.uint64), dtype=np.uint64)


def _added(keys: list, n: list) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    key, n = np.concatenate([np.zeros(0, np.uint64), *keys]), np.concatenate([np.zeros(0, np.int64), *n])
    if not len(key):
        return key, n
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(n[order], first)


def _gather(train: DataFrame, parts: int, flush: int = 1 << 21) -> DataFrame:
    """(part, words, n, pairs, pairs_n): runs of the words and pairs of a part
    of the keys with their counts, added up per task before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list] = ([], [])
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            made = []
            for got in held:
                key, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *got]), return_counts=True)
                got.clear()
                made.append((key, n.astype(np.int64), np.searchsorted(_part(key, parts), np.arange(parts + 1))))
            for p in range(0, parts, 64):
                at = [i for i in range(p, min(p + 64, parts)) if any(cut[i] < cut[i + 1] for _, _, cut in made)]
                columns = [pa.array(at, pa.int32())]
                for key, n, cut in made:
                    columns += [pa.array([_run(key[cut[i]:cut[i + 1]]) for i in at], pa.binary()),
                                pa.array([_planes(n[cut[i]:cut[i + 1]]) for i in at], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["part", "words", "n", "pairs", "pairs_n"])
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                word, before, start = text_keys(batch.slice(i, 256).column(0).to_pylist())
                if len(word):
                    held[0].extend([word, np.full(len(start) - 1, START)])  # START counts the texts as a history
                    held[1].append(pair_keys(before, word))
                    size += len(word)
                if size >= flush:
                    yield from out()
                    size = 0
        yield from out()
    return train.mapInArrow(run, "part int, words binary, n binary, pairs binary, pairs_n binary")


def _count(train: DataFrame, parts: int, base: float) -> DataFrame:
    """One row per part of the keys that occur: the runs of its words and
    pairs with their counts, and of them how many tokens, distinct tokens and
    levels there are."""
    filt = Filter(1, 1, base)

    def run(t: pa.Table) -> pa.Table:
        words, n, pairs, pairs_n = ([x.as_buffer() for x in t.column(c)] for c in ("words", "n", "pairs", "pairs_n"))
        words, n = _added([_unrun(x) for x in words], [_unplaned(x, np.int64) for x in n])
        pairs, pairs_n = _added([_unrun(x) for x in pairs], [_unplaned(x, np.int64) for x in pairs_n])
        token = words != START
        return pa.table({"part": t.column("part").slice(0, 1), "words": pa.array([_run(words)], pa.binary()), "n": pa.array([_planes(n)], pa.binary()),
                         "pairs": pa.array([_run(pairs)], pa.binary()), "pairs_n": pa.array([_planes(pairs_n)], pa.binary()),
                         "tokens": pa.array([int(n[token].sum())]), "types": pa.array([int(token.sum())]),
                         "levels": pa.array([int(filt.level(n).sum() + filt.level(pairs_n).sum())])})
    return _gather(train, parts).groupBy("part").applyInArrow(
        run, "part int, words binary, n binary, pairs binary, pairs_n binary, tokens long, types long, levels long")


ROW = "bucket int, step int, seg int, raw binary, parcel long, words binary, pairs binary"  # what meets in a bucket
NAMES = ["bucket", "step", "seg", "raw", "parcel", "words", "pairs"]


def _build(counts: DataFrame, filt: Filter, parts: int, bucket: int) -> DataFrame:
    """The filter's segments (step 0: seg, raw) and the words' exact counts
    (step 1: a run and its counts) by bucket.  Each part of the keys has its
    own whole number of segments; a task holds those of one part."""
    each = filt.segments // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                p = batch.column(0)[r].as_py()
                words, pairs = (_unrun(batch.column(c)[r].as_buffer()) for c in (1, 3))
                n, pairs_n = (_unplaned(batch.column(c)[r].as_buffer(), np.int64) for c in (2, 4))
                bits = np.zeros(each * WORDS, np.uint64)
                for key, count in ((words, n), (pairs, pairs_n)):
                    filt.put(bits, (filt.segment(key) - p * each) * WORDS, key, filt.level(count))
                for i in range(0, each, 64):
                    seg = np.arange(p * each + i, p * each + min(i + 64, each))
                    m = len(seg)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((seg // bucket).astype(np.int32)), pa.array(np.zeros(m, np.int32)), pa.array(seg.astype(np.int32)),
                         pa.array([bits[k * WORDS:(k + 1) * WORDS].tobytes() for k in range(i, i + m)], pa.binary()),
                         pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary()), pa.nulls(m, pa.binary())], NAMES)
                words, n = words[words != START], n[words != START]
                at = filt.segment(words) // bucket
                for b in np.unique(at).tolist():
                    mine = slice(np.searchsorted(at, b), np.searchsorted(at, b, "right"))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([b], pa.int32()), pa.array([1], pa.int32()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64()),
                         pa.array([_run(words[mine])], pa.binary()), pa.array([_planes(n[mine])], pa.binary())], NAMES)
    return counts.select("part", "words", "n", "pairs", "pairs_n").mapInArrow(run, ROW)


def score_documents(docs: DataFrame, held_out_modulus: int = 5, held_out_remainder: int = 1, base: float = 1.5,
                    hashes: int = 4, bits_per_key: int = 8, max_bits: int = 1 << 29, prior: float = 200.0,
                    vocabulary_bytes: int = 192 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, held_out, n_tokens, n_known, train_tokens,
    base_score and score (log10).

    Tokens are the words ``[^\\x20\\x09-\\x0D]+`` after A-Z -> a-z and one end
    token.  The model learns from all documents but those whose crc32 of the
    id's text leaves ``held_out_remainder`` modulo ``held_out_modulus``.
    ``base_score`` sums log10((c + 0.5) / (N + 0.5 (V + 1))) with exact counts.
    ``score`` sums log10 of the Dirichlet-smoothed pair probability
    (c(hw) + prior P(w)) / (c(h) + prior), P(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)),
    all its counts c as the filter has them and c(hw) at most c(h) and c(w).

    ``max_bits`` and ``vocabulary_bytes`` bound the bits of the filter and the
    exact counts that a task holds at once (a segment at least), not what is
    counted; the result does not depend on them.

    Null or empty text is the end token alone.  A null id is no held-out one.
    Repeated rows are learned and scored each; other columns are ignored; an
    empty table gives no rows.  Words are told apart by 64-bit keys."""
    spark = docs.sparkSession
    ship(spark)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
                      F.coalesce(remainder(F.col(id_col), held_out_modulus) == held_out_remainder, F.lit(False)).alias("out"))
    train = src.where("not out").select("text")
    # words and pairs there can be: a text of n separators has at most n + 1
    # words, an end token and a start
    gaps = F.octet_length("text") - F.octet_length(F.translate("text", " \t\n\x0b\x0c\r", ""))
    most = train.agg(F.coalesce(F.sum(2 * (F.coalesce(gaps, F.lit(-1)) + 2) + 1), F.lit(0))).first()[0]
    parts = 1 << max(6, (int(most) >> 20).bit_length())  # at most about a million n-grams each
    counts = stash(_count(train, parts, base), "lm-counts")
    n_all, n_types, levels = counts.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "types", "levels"))).first()
    filt = Filter(parts * max(1, -(-int(bits_per_key * levels) // (64 * WORDS * parts))), hashes, base)
    filt.top = int(filt.level(np.array([n_all]))[0])
    bucket = max(1, min(BUCKET, max_bits // (64 * WORDS), vocabulary_bytes * filt.segments // (16 * max(1, n_types))))
    return _by_shuffle(src, _build(counts, filt, parts, bucket), filt, _Scorer(n_all, n_types, prior), bucket).withColumnRenamed("id", id_col)


OUT = ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
SCHEMA = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


class _Scorer:
    def __init__(self, n_all: int, n_types: int, prior: float):
        self.n_all, self.prior = n_all, prior
        self.total = n_all + 0.5 * (n_types + 1)

    def base(self, n: np.ndarray) -> np.ndarray:
        return np.log10((n + 0.5) / self.total)

    def terms(self, c_word: np.ndarray, c_start: float, c_pair: np.ndarray, start: np.ndarray) -> np.ndarray:
        """log10 P per token; a token's history is the token before it in its text."""
        c_before = np.concatenate([[0.0], c_word[:-1]])
        c_before[start[:-1]] = c_start
        c_pair = np.minimum(c_pair, np.minimum(c_word, c_before))
        return np.log10((c_pair + self.prior * (c_word + 0.5) / self.total) / (c_before + self.prior))


def _table(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts in key order, in 64 bits each."""
    order = np.argsort(key)
    return key[order], n[order]


def _lookup(keys: np.ndarray, n: np.ndarray, own: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(own), np.int64)
    at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
    return np.where(keys[at] == own, n[at], 0).astype(np.int64)


def _parcels(src: DataFrame, rows: int = 4096, text_bytes: int = 4 << 20) -> DataFrame:
    """The documents in parcels of about ``text_bytes``, one row (parcel,
    docs) each, so that a parcel is never divided; ``docs`` is a compressed
    Arrow stream of (id, out, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        held: list = []
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal n, size
            if held:
                ids, texts, outs = zip(*held)
                docs = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(outs, pa.bool_()), pa.array(texts, pa.large_string())],
                                                  ["id", "out", "text"])
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, docs.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                    w.write_batch(docs)
                yield pa.RecordBatch.from_arrays([pa.array([(part << 40) + n]), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                                                 ["parcel", "docs"])
                held.clear()
                n, size = n + 1, 0
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                for one in zip(*(batch.slice(i, 256).column(c).to_pylist() for c in range(3))):
                    held.append(one)
                    size += len(one[1] or "")
                    if len(held) >= rows or size >= text_bytes:
                        yield from out()
        yield from out()
    return stash(src.select("id", "text", "out").mapInArrow(run, "parcel long, docs binary"), "lm-parcels")


def _unpacked(docs) -> list[list]:
    """ids, held-out flags and texts of a parcel."""
    t = pa.ipc.open_stream(docs).read_all()
    return [t.column(i).to_pylist() for i in range(3)]


def _by_shuffle(src: DataFrame, model: DataFrame, filt: Filter, scorer: _Scorer, bucket: int) -> DataFrame:
    """A parcel's distinct keys, sorted, fall into runs, one per bucket of
    segments; each run is sent to its bucket, and what is found there comes
    back to the parcel in the order of the buckets."""
    parcels = _parcels(src)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                word, before, _ = text_keys(_unpacked(batch.column(1)[i].as_buffer())[2])
                sets = [np.unique(np.append(word, START)), np.unique(pair_keys(before, word))]
                at = [filt.segment(k) // bucket for k in sets]
                for b in np.unique(np.concatenate(at)).tolist():
                    words, pairs = (_run(k[np.searchsorted(a, b):np.searchsorted(a, b, "right")]) for k, a in zip(sets, at))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([b], pa.int32()), pa.array([2], pa.int32()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()),
                         batch.column(0).slice(i, 1), pa.array([words]), pa.array([pairs])], NAMES)
    met = parcels.mapInArrow(ask, ROW).union(model).repartition("bucket").sortWithinPartitions("bucket", "step")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, held, counts = -1, filt, [], None
        for batch in batches:
            home, step = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cut = np.flatnonzero((np.diff(home) != 0) | (np.diff(step) != 0)) + 1
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(home)]):
                if a == b:
                    continue
                if home[a] != own:
                    own, held, counts = int(home[a]), [], None
                    part = Filter(filt.segments, filt.hashes, filt.base, np.zeros(bucket * WORDS, np.uint64))
                    part.top, part.first = filt.top, own * bucket
                rows = batch.slice(a, b - a)
                if step[a] == 0:
                    for seg, raw in zip(rows.column(2).to_pylist(), rows.column(3)):
                        at = (seg - part.first) * WORDS
                        part.words[at:at + WORDS] |= np.frombuffer(raw.as_buffer(), np.uint64)
                    continue
                if step[a] == 1:
                    held += [(_unrun(rows.column(5)[i].as_buffer()), _unplaned(rows.column(6)[i].as_buffer(), np.int64)) for i in range(rows.num_rows)]
                    continue
                if counts is None:
                    key = np.concatenate([np.zeros(0, np.uint64), *(k for k, _ in held)])
                    n = np.concatenate([np.zeros(0, np.int64), *(m for _, m in held)])
                    counts, held = _table(key, n), []
                for i in range(rows.num_rows):
                    words, pairs = (_unrun(rows.column(c)[i].as_buffer()) for c in (5, 6))
                    yield pa.RecordBatch.from_arrays(
                        [rows.column(4).slice(i, 1), pa.array([own], pa.int32()), pa.array([_planes(part.find(words))]),
                         pa.array([_planes(_lookup(*counts, words))]), pa.array([_planes(part.find(pairs))])],
                        ["parcel", "bucket", "levels", "counts", "pairs"])
    found = met.mapInArrow(answer, "parcel long, bucket int, levels binary, counts binary, pairs binary")
    back = parcels.withColumn("bucket", F.lit(-1)).unionByName(found, allowMissingColumns=True) \
        .repartition("parcel").sortWithinPartitions("parcel", "bucket") \
        .select("docs", "levels", "counts", "pairs")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, got = None, []

        def out() -> Iterator[pa.RecordBatch]:
            if docs is None:
                return
            ids, outs, texts = _unpacked(docs)
            word, before, start = text_keys(texts)
            del texts
            own = np.unique(np.append(word, START))
            pairs, pair_at = np.unique(pair_keys(before, word), return_inverse=True)
            level, n, pair = (np.concatenate([_unplaned(x[i], np.int64) for x in got]) for i in range(3))
            if len(level) != len(own) or len(pair) != len(pairs):
                raise RuntimeError("a parcel's answers are not whole")
            at = np.searchsorted(own, word)
            n, c_own, c_pair = n[at], filt.count(level), filt.count(pair)[pair_at]
            score = scorer.terms(c_own[at], c_own[np.searchsorted(own, START)], c_pair, start)
            first = start[:-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(outs, pa.bool_()), pa.array(np.diff(start)), pa.array(np.add.reduceat((n > 0).astype(np.int64), first)),
                 pa.array(np.full(len(ids), scorer.n_all)), pa.array(np.add.reduceat(scorer.base(n), first)),
                 pa.array(np.add.reduceat(score, first))], OUT)
        for batch in batches:
            new = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            for i in range(batch.num_rows):
                if new[i]:
                    yield from out()
                    docs, got = pa.py_buffer(batch.column(0)[i].as_py()), []  # unpacked when its answers are there
                else:
                    got.append([batch.column(c)[i].as_py() for c in (1, 2, 3)])
        yield from out()
    return back.mapInArrow(finish, SCHEMA)
