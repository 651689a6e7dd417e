"""SimHash near-duplicates by anchor-point covering.

The 64 fingerprint bits are cut into three blocks (22, 21 and 21 bits).  Two
fingerprints at most ``max_bits`` apart differ by at most
``t = max_bits // 3`` bits in one of the blocks.  The anchors of a block are
the words of a covering code: the perfect Hamming code on its first 15 bits
(covering radius 1) times all values of its other bits.  Every block value has
one *home* anchor within the covering radius.  A fingerprint is replicated to
every anchor within radius plus threshold that can be the home of a value at
most ``t`` bits away, so two fingerprints that agree in a block up to ``t``
bits meet at the home anchor of either one, where all 64 bits are compared.
The search is exact: no link is missed, whatever the data.
"""

from __future__ import annotations

import itertools
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagsmith.llm.common import Links, components, fresh, map_batches, ship, stash, words_of

BLOCKS = ((0, 22), (22, 21), (43, 21))  # (lowest bit, width)
CODE = 15                               # length of the Hamming code
SEED = 42


def fingerprint(text: str | None, width: int = 4) -> int:
    """64-bit SimHash of the ``width``-word shingles (repeats count): a bit is
    set if it is set in over half the shingles' XXH64.  Fewer words: one
    shingle of all; no word (or null): 0."""
    words = words_of(text)
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = (end - size).tolist()
    stop = end[min(width, len(words)) - 1:].tolist()
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, n, 1 << 16):
        h = np.fromiter((digest(joined[s:e], SEED) for s, e in zip(start[i:min(n, i + (1 << 16))], stop[i:i + (1 << 16)])),
                        np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """(id, fp, text_hash): one row per document, fp the fingerprint as a
    signed long, text_hash the XXH64 of the text."""
    def run(t: pa.Table) -> pa.Table:
        fp = np.array([fingerprint(x, width) for x in t.column(1).to_pylist()], np.uint64).view(np.int64)
        return pa.table([t.column(0), pa.array(fp), t.column(2)], names=["id", "fp", "text_hash"])
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(src.withColumn("text_hash", F.xxhash64("text")), run, "id long, fp long, text_hash long", rows=256)


@lru_cache(maxsize=1)
def _syndromes() -> np.ndarray:
    """Hamming syndrome of every 15-bit word: the xor of the (1-based)
    positions of its set bits; 0 for a code word, else the bit to flip."""
    w = np.arange(1 << CODE)
    s = np.zeros(len(w), np.int64)
    for i in range(CODE):
        s ^= np.where(w >> i & 1, i + 1, 0)
    return s


def _home(x: np.ndarray) -> np.ndarray:
    """Home anchor of block values: the first 15 bits decoded, the rest kept."""
    s = _syndromes()[x & (1 << CODE) - 1]
    return np.where(s > 0, x ^ (1 << np.maximum(s - 1, 0)), x)


def anchors(fp: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, home): every anchor that ``fp`` (uint64) is replicated to;
    ``key`` holds block number and code word."""
    rows, keys, homes = [], [], []
    for b, (low, width) in enumerate(BLOCKS):
        x = (fp >> np.uint64(low)).astype(np.int64) & (1 << width) - 1
        own = _home(x)
        found = [(np.arange(len(x)), own)]
        for k in range(1, t + 1):  # homes of the values that differ in k bits
            for bits in itertools.combinations(range(width), k):
                a = _home(x ^ sum(1 << i for i in bits))
                found.append((np.arange(len(x)), a))
        r, a = (np.concatenate(c) for c in zip(*found))
        code = np.unique(r << 24 | a)  # 24 bits hold a block value
        r, a = code >> 24, code & (1 << 24) - 1
        rows.append(r)
        keys.append(a | b << 24)
        homes.append(a == own[r])
    return tuple(np.concatenate(c) for c in (rows, keys, homes))


def _compare(key, fp, home, max_bits: int, links: Links, step: int = 1 << 22) -> None:
    """Compare each home row with the replicas of its key; add what is within
    ``max_bits`` to ``links``.  At most about ``step`` pairs exist at once."""
    order = np.argsort(key, kind="stable")
    key, fp, home = key[order], fp[order], home[order]
    h = np.flatnonzero(home)
    lo, hi = np.searchsorted(key, key[h], "left"), np.searchsorted(key, key[h], "right")
    at = np.concatenate([[0], np.cumsum(hi - lo)])
    i = 0
    while i < len(h):
        j = max(i + 1, int(np.searchsorted(at, at[i] + step, "right")) - 1)
        n = hi[i:j] - lo[i:j]
        left = np.repeat(h[i:j], n)
        right = np.arange(at[j] - at[i]) - np.repeat(at[i:j] - at[i], n) + np.repeat(lo[i:j], n)
        near = np.bitwise_count(fp[left] ^ fp[right]) <= max_bits
        links.add(order[left[near]], order[right[near]])
        i = j


def near_links(distinct: DataFrame, max_bits: int = 4, per_group: int = 100_000, hot: int = 16_384) -> DataFrame:
    """Links (a, b) that connect the rows (rep, fp) whose fingerprints are at
    most ``max_bits`` apart, reduced to a spanning forest per task.

    Anchors are dealt to groups of about ``per_group`` rows.  An anchor with
    more than ``hot`` replicas is cut into pieces; each pair of pieces is
    compared in a group of its own, so no task grows with the anchor."""
    spark = distinct.sparkSession
    t = max_bits // len(BLOCKS)
    ship(spark)

    def spread(tab: pa.Table) -> pa.Table:
        fp = tab.column(1).to_numpy()
        row, key, home = anchors(fp.view(np.uint64), t)
        return pa.table([pa.array(key), tab.column(0).take(pa.array(row)), pa.array(fp[row]), pa.array(home)],
                        names=["key", "rep", "fp", "home"])
    spread_rows = map_batches(distinct.select("rep", "fp"), spread, "key long, rep long, fp long, home boolean", 4096)
    # the anchors are fixed by the code (3 x 2^18 at most), so is this table
    crowded = spread_rows.groupBy("key").count().where(F.col("count") > hot).select(
        "key", F.ceil(F.col("count") / hot).cast("long").alias("pieces"))
    crowded = stash(crowded, "anchors")
    rows = distinct.count()
    groups = max(1, (rows * (1 + 7 + 7) * len(BLOCKS)) // per_group)
    dealt = spread_rows.join(F.broadcast(crowded), "key", "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    piece = F.pmod(F.xxhash64("fp"), F.col("pieces"))
    every = F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)
    # home rows of piece i meet the replicas of every piece j in group (i, j)
    homes = dealt.where("home").select("key", "rep", "fp", F.lit(True).alias("home"), "pieces",
                                       piece.alias("i"), F.explode(every).alias("j"))
    others = dealt.select("key", "rep", "fp", F.lit(False).alias("home"), "pieces",
                          F.explode(every).alias("i"), piece.alias("j"))
    both = homes.union(others).select(
        F.when(F.col("pieces") == 1, F.pmod(F.xxhash64("key"), F.lit(groups)))
        .otherwise(F.lit(groups) + F.xxhash64("key", "i", "j").bitwiseAND(F.lit((1 << 62) - 1))).alias("g"),
        "key", "rep", "fp", "home")

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        rep, fp = pdf["rep"].to_numpy(), pdf["fp"].to_numpy().view(np.uint64)
        nodes, at = np.unique(rep, return_inverse=True)
        found = Links(len(rep))
        first = np.zeros(len(nodes), np.int64)
        first[at] = np.arange(len(at))
        found.add(np.arange(len(at)), first[at])  # the rows of one fingerprint
        _compare(pdf["key"].to_numpy(), fp, pdf["home"].to_numpy(bool), max_bits, found)
        a, b = rep, rep[found.label]
        pairs = np.unique(np.stack([a, b], 1)[a != b], axis=0)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})
    return both.groupBy("g").applyInPandas(links, "a long, b long")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   width: int = 4, max_bits: int = 4) -> DataFrame:
    """One row per document: ``id_col``, fingerprint (16 hex digits),
    component_id, the smallest id reachable over links of at most
    ``max_bits`` differing bits, class, a name of the component that exists
    without ids too, and text_hash.

    Equal fingerprints are collapsed before the search and attached again by
    a join, so a group of copies costs one fingerprint.  Null text counts as
    no words (fingerprint zero, linked like any other).  Rows with a null id
    are fingerprinted and join their group's component, but name none: a
    component of null ids only has a null component_id.  Repeated ids give
    one row each.  Other columns are ignored; an empty table gives no rows."""
    if not 0 <= max_bits < 64:
        raise ValueError("max_bits must be 0..63")
    fps = stash(fingerprints(docs, id_col, text_col, width), "fingerprints")
    reps = stash(fps.groupBy("fp").agg(F.min("id").alias("first")).select(
        "fp", "first", F.xxhash64("fp").alias("rep")), "classes")
    # rep: the fingerprint hashed, a node name that exists for null ids as well
    classes = components(near_links(reps, max_bits))
    rep_of = reps.join(classes, reps["rep"] == classes["node"], "left").select(
        "fp", "first", F.coalesce("component", "rep").alias("root"))
    rep_of = stash(rep_of, "roots")
    least = stash(rep_of.groupBy("root").agg(F.min("first").alias("component_id")), "least")  # both written: a large component is a join side that AQE splits
    by_fp = rep_of.join(least, "root").select("fp", "component_id", F.col("root").alias("class"))
    return fps.join(by_fp, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "class", "text_hash")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with exactly one row of each group of near-duplicates: one of
    the smallest id (null ids last), and of the rows with that id one of the
    smallest fingerprint and text hash.  Rows with the same id and text stay
    once; rows with one id and different texts belong to the groups of their
    texts.  Null text is a text without words."""
    groups = simhash_groups(docs, id_col, text_col, width, max_bits)
    first = F.min(F.struct(F.col(id_col).isNull().alias("last"), F.col(id_col).alias("id"), "fingerprint", "text_hash")).alias("first")
    mark, own, own_hash = fresh(docs, "hash"), fresh(docs, "own_id"), fresh(docs, "own_hash")
    stay = stash(groups.groupBy("class").agg(first).select(F.col("first.id").alias(own), F.col("first.text_hash").alias(own_hash)), "stay")
    # a text has one fingerprint, so id and text name a group's row; the join leaves rows dealt as the second step needs
    marked = docs.withColumn(mark, F.xxhash64(F.col(text_col).cast("string")))
    same = (F.col(mark) == F.col(own_hash)) & F.col(id_col).cast("long").eqNullSafe(F.col(own))
    return marked.join(stay, same, "left_semi").dropDuplicates([id_col, mark]).select(*docs.columns)
