"""Spelling variants by K-d trees over letter-count vectors.

One edit changes a word's letter counts little: a replaced letter lowers one
count by one and raises another (L1 distance 2), an inserted one raises one
count (distance 1).  So for every length pair, (n, n) for replacements and
(n, n + 1) for insertions and deletions, the words near a word lie in a small
box around its vector, and a K-d tree over the vectors of the longer length
finds them by range search, pruning the subtrees whose bounding box needs a
larger change.  What is found has the right letters; their order is verified on
the words themselves.

The work is dealt by the upper levels of the trees.  A tree per word length,
fitted on a bounded sample, cuts the vectors' space into boxes; every word has
one home box and is sent, as a query, to each box that holds a vector one edit
away.  A task builds the lower tree over the home vectors of one box.  The
sample shapes the boxes only; the search is exact whatever they are.  Crowded
boxes are cut into pieces by a hash of the home word, and each piece gets all
the box's queries, in slices.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagsmith.llm.common import LOWER, ship, stash

RUN = re.compile("[a-zÀ-ÿ]+")
LETTERS = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.uint8)  # every letter is one Latin-1 byte
PLACE = np.zeros(256, np.int64)
PLACE[LETTERS] = np.arange(len(LETTERS))
DIMS = len(LETTERS)
TOP = 100  # counts are cut here: distances only shrink, so the search misses nothing
BASE = np.uint64(0x9E3779B97F4A7C15)


# ---- words of the corpus -------------------------------------------------

def runs_of(doc_id, text: str | None, modulus: int | None) -> Counter:
    """Occurrences of the lower-cased runs of a text; a run whose crc32 of
    ``<doc_id>:<run>`` ``modulus`` divides loses the code point at that crc32
    modulo its length."""
    if not text:
        return Counter()
    found = Counter(RUN.findall(text.encode("utf-8", "surrogatepass").translate(LOWER).decode("utf-8", "surrogatepass")))
    if modulus is None:
        return found
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter = Counter()
    for w, n in found.items():
        h = zlib.crc32(w.encode(), seed)
        if h % modulus == 0:
            at = h % len(w)
            w = w[:at] + w[at + 1:]
        out[w] += n
    return out


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 5, min_count: int = 3,
                modulus: int | None = 97, held: int = 200_000) -> DataFrame:
    """(word, n): the words of at least ``min_length`` code points with at
    least ``min_count`` occurrences in all texts.  A task adds up to ``held``
    distinct words before it hands them on."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: Counter = Counter()

        def out() -> pa.RecordBatch:
            on = [(w, n) for w, n in got.items() if len(w) >= min_length]
            got.clear()
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in on], pa.string()), pa.array([n for _, n in on], pa.int64())], ["word", "n"])
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                for doc_id, text in zip(*(batch.slice(i, 64).column(c).to_pylist() for c in range(2))):
                    got.update(runs_of(doc_id, text, modulus))
                    if len(got) >= held:
                        yield out()
        yield out()
    src = docs.select(F.col(id_col).cast("string"), F.col(text_col).cast("string"))
    return src.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ---- vectors and trees ---------------------------------------------------

def letters(words: list[str], length: int) -> np.ndarray:
    """The words, all of one length, as rows of Latin-1 bytes."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), length)


def vectors(rows: np.ndarray) -> np.ndarray:
    """Letter counts (at most ``TOP``) of each row."""
    n, length = rows.shape
    out = np.empty((n, DIMS), np.int8)
    step = max(1, (1 << 22) // max(1, length))
    for i in range(0, n, step):
        part = PLACE[rows[i:i + step]] + np.arange(len(rows[i:i + step]))[:, None] * DIMS
        counts = np.bincount(part.ravel(), minlength=DIMS * len(rows[i:i + step]))
        out[i:i + step] = np.minimum(counts, TOP).reshape(-1, DIMS)
    return out


def best_cut(v: np.ndarray) -> tuple[int, int] | None:
    """(coordinate, value) of the most even cut ``<= value``; None if all
    vectors are equal."""
    wide = np.flatnonzero(v.min(0) != v.max(0))
    best, half = None, len(v) / 2
    for d in wide.tolist():
        count = np.cumsum(np.bincount(v[:, d]))[:-1]
        at = int(np.argmin(np.abs(count - half)))
        off = abs(count[at] - half)
        if best is None or off < best[0]:
            best = (off, d, at)
    return None if best is None else best[1:]


class Boxes:
    """The upper levels of the tree of one word length: ``cuts[i]`` =
    (coordinate, value, left, right) of inner node i, a negative child -b-1 is
    box b.  Boxes have no outer bounds, so each vector has a home."""

    def __init__(self, sample: np.ndarray, boxes: int, first: int):
        self.cuts: list = []
        self.first = self.next = first

        def grow(v: np.ndarray, wanted: int) -> int:
            cut = best_cut(v) if wanted > 1 and len(v) > 1 else None
            if cut is None:
                self.next += 1
                return -self.next
            at = len(self.cuts)
            self.cuts.append(None)
            left = v[:, cut[0]] <= cut[1]
            self.cuts[at] = (*cut, grow(v[left], wanted // 2), grow(v[~left], wanted - wanted // 2))
            return at
        self.root = grow(sample, boxes)

    def route(self, v: np.ndarray, down: int, up: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, box) for every box that a vector at most ``down`` lower and
        ``up`` higher in sum than the row's may lie in (0, 0: the home)."""
        rows, boxes = [], []
        low, high = np.full(DIMS, -1, np.int64), np.full(DIMS, TOP + 1, np.int64)

        def walk(node: int, at: np.ndarray, less: np.ndarray, more: np.ndarray) -> None:
            if not len(at):
                return
            if node < 0:
                rows.append(at)
                boxes.append(np.full(len(at), -node - 1))
                return
            d, cut, left, right = self.cuts[node]
            x, old_low, old_high = v[at, d].astype(np.int64), low[d], high[d]
            # what the change must lower or raise to get into the child's box
            need = less + np.maximum(x - cut, 0) - np.maximum(x - old_high, 0)
            high[d] = cut
            on = need <= down
            walk(left, at[on], need[on], more[on])
            high[d] = old_high
            need = more + np.maximum(cut + 1 - x, 0) - np.maximum(old_low - x, 0)
            low[d] = cut + 1
            on = need <= up
            walk(right, at[on], less[on], need[on])
            low[d] = old_low
        zero = np.zeros(len(v), np.int64)
        walk(self.root, np.arange(len(v)), zero, zero)
        return (np.concatenate(rows), np.concatenate(boxes)) if rows else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def range_search(home: np.ndarray, asked: np.ndarray, down: int, leaf: int = 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (row of ``asked``, row of ``home``) of vectors (all distinct
    within each) such that home = asked with ``down`` counts lowered by one in
    all and one raised.  A K-d tree over ``home`` with tight bounding boxes is
    walked with all queries that may still find something below a node."""
    def walk(h: np.ndarray, q: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        v = home[h]
        low, high = v.min(0), v.max(0)
        x = asked[q]
        on = (np.maximum(x, high) - high).sum(1, dtype=np.int64) <= down
        on[on] = (low - np.minimum(x[on], low)).sum(1, dtype=np.int64) <= 1
        del x  # or every level of the tree keeps its copy
        q = q[on]
        if not len(q):
            return
        cut = best_cut(v) if len(h) > leaf else None
        if cut is not None:
            left = v[:, cut[0]] <= cut[1]
            yield from walk(h[left], q)
            yield from walk(h[~left], q)
            return
        for i in range(0, len(q), 1024):
            diff = v[None, :, :] - asked[q[i:i + 1024]][:, None, :]
            near = ((diff > 0).sum(2) <= 1) & (np.abs(diff).sum(2, dtype=np.int64) <= down + 1)
            a, b = np.nonzero(near & (np.abs(diff).max(2) > 0 if down else True))
            yield q[i:i + 1024][a], h[b]
    if len(home) and len(asked):
        yield from walk(np.arange(len(home)), np.arange(len(asked)))


# ---- letter order --------------------------------------------------------

def _powers(n: int) -> np.ndarray:
    return np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, BASE))])


def _hash(rows: np.ndarray) -> np.ndarray:
    """Polynomial hash of each row; equal hashes are compared letter by letter."""
    return ((rows.astype(np.uint64) + np.uint64(1)) * _powers(rows.shape[1])[:rows.shape[1]]).sum(1, dtype=np.uint64)


class Order:
    """Home words by hash, to find the words that a known edit makes.  A
    query costs its length per vector found, however many words share that
    vector."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        h = _hash(rows)
        self.order = np.argsort(h, kind="stable")
        self.hash = h[self.order]

    def look(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``h``, home row) of equal hashes."""
        lo, hi = np.searchsorted(self.hash, h, "left"), np.searchsorted(self.hash, h, "right")
        n = hi - lo
        at = np.repeat(np.arange(len(h)), n)
        return at, self.order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]

    def replaced(self, words: np.ndarray, old: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row of ``words``, home row) where one ``old`` of a word replaced by
        ``new`` makes the home word."""
        row, pos = np.nonzero(words == old[:, None])
        by = (new[row].astype(np.uint64) - old[row].astype(np.uint64)) * _powers(words.shape[1])[pos]
        at, home = self.look(_hash(words)[row] + by)
        row = row[at]
        ok = (words[row] != self.rows[home]).sum(1) == 1
        return row[ok], home[ok]

    def inserted(self, words: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for one letter ``new`` inserted anywhere."""
        n, length = words.shape
        p = _powers(length)
        terms = (words.astype(np.uint64) + np.uint64(1)) * p[:length]
        left = np.concatenate([np.zeros((n, 1), np.uint64), np.cumsum(terms, 1, dtype=np.uint64)], 1)
        right = (left[:, -1:] - left) * BASE  # behind the insertion every letter moves up one place
        made = left + right + (new.astype(np.uint64) + np.uint64(1))[:, None] * p
        at, home = self.look(made.ravel())
        row, pos = at // (length + 1), at % (length + 1)
        shown = np.arange(length + 1)
        source = np.minimum(shown - (shown > pos[:, None]), length - 1)
        built = np.where(shown == pos[:, None], new[row][:, None], words[row[:, None], source])
        ok = (built == self.rows[home]).all(1)
        pairs = np.unique(np.stack([row[ok], home[ok]], 1), axis=0)  # aab + a: the same word from two places
        return pairs[:, 0], pairs[:, 1]


def near_in_box(home: list[str], asked: list[str], block: int = 1 << 16, cells: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (index in ``asked``, index in ``home``) one edit apart; the home
    words are of one length, the asked ones as long or one shorter.  Besides
    the words it holds the vectors of ``block`` asked ones, and the letters of
    about ``cells`` / length candidates, each several times in 64 bits."""
    length = len(home[0])
    rows = letters(home, length)
    order = Order(rows)
    classes = np.unique(vectors(rows), axis=0)
    sizes = np.array([len(w) for w in asked])
    for m in (length, length - 1):
        whole = np.flatnonzero(sizes == m)
        for i in range(0, len(whole) if m else 0, block):
            mine = whole[i:i + block]
            for w, b in _near_in_block(order, classes, letters([asked[k] for k in mine], m), int(m == length), cells):
                yield mine[w], b


def _near_in_block(order: Order, classes: np.ndarray, own: np.ndarray, down: int, cells: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (row of ``own``, home row) one replacement (``down`` 1) or one
    insertion (0) apart; ``classes`` are the distinct home vectors."""
    distinct, of = np.unique(vectors(own), axis=0, return_inverse=True)
    of = of.ravel()
    by = np.argsort(of, kind="stable")
    bound = np.searchsorted(of[by], np.arange(len(distinct) + 1))
    step = max(1, cells // own.shape[1])
    for q, h in range_search(classes, distinct, down):
        diff = classes[h] - distinct[q]
        # a change beyond the cut counts shows as none: then any letter may be the one
        cut = (distinct[q] >= TOP - 1).any(1) | (classes[h] >= TOP - 1).any(1)
        old, new = LETTERS[diff.argmin(1)], LETTERS[diff.argmax(1)]
        n = np.where(cut, 0, bound[q + 1] - bound[q])
        end = np.cumsum(n)
        for i in range(0, int(n.sum()), step):  # the words of all pairs of vectors, one after the other
            at = np.arange(i, min(i + step, int(end[-1])))
            p = np.searchsorted(end, at, "right")
            w = by[at - end[p] + n[p] + bound[q[p]]]
            a, b = order.replaced(own[w], old[p], new[p]) if down else order.inserted(own[w], new[p])
            yield w[a], b
        for w in np.unique(np.concatenate([np.zeros(0, np.int64), *(by[bound[c]:bound[c + 1]] for c in np.unique(q[cut]))])):
            seen = set()  # rare long words: every letter is tried once
            row = own[w:w + 1]
            for new_one in LETTERS:
                for old_one in (np.unique(row) if down else [new_one]):
                    if down and old_one == new_one:
                        continue
                    _, b = order.replaced(row, np.array([old_one]), np.array([new_one])) if down else order.inserted(row, np.array([new_one]))
                    seen.update(b.tolist())
            if seen:
                yield np.full(len(seen), w), np.array(sorted(seen))


# ---- the job -------------------------------------------------------------

def near_words(words: DataFrame, per_box: int = 4_000, sample: int = 100_000, slice_rows: int = 250_000) -> DataFrame:
    """(word, near): both directions of every pair of words one inserted,
    deleted or replaced letter apart.  ``words`` has distinct words.

    The trees of the boxes are fitted on ``sample`` words, the first by their
    hash."""
    spark = words.sparkSession
    ship(spark)
    sizes = {n: c for n, c in words.groupBy(F.length("word")).count().toLocalIterator()}
    fitted: dict[int, list] = {}
    for (w,) in words.select("word").orderBy(F.xxhash64("word")).limit(sample).toLocalIterator():
        fitted.setdefault(len(w), []).append(w)
    trees: dict[int, Boxes] = {}
    first = 0
    for n in sorted(sizes):
        v = vectors(letters(fitted[n], n)) if n in fitted else np.zeros((0, DIMS), np.int8)
        trees[n] = Boxes(v, max(1, min(-(-sizes[n] // per_box), len(v) // 8)), first)
        first = trees[n].next
    sent = spark.sparkContext.broadcast(trees)  # at most sample / 8 boxes and as many lengths as words can have

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = sent.value
        for whole in batches:
            for i in range(0, whole.num_rows, 4096):
                batch = whole.slice(i, 4096)
                given = batch.column(0).to_pylist()
                size = np.array([len(w) for w in given])
                for n in np.unique(size).tolist():
                    mine = np.flatnonzero(size == n)
                    v = vectors(letters([given[j] for j in mine], n))
                    r, b = trees[n].route(v, 0, 0)
                    ways = [(True, r, b), (False, *trees[n].route(v, 1, 1))]
                    if n + 1 in trees:
                        ways.append((False, *trees[n + 1].route(v, 0, 1)))
                    for own, r, b in ways:
                        yield pa.RecordBatch.from_arrays([pa.array(b), pa.array(np.full(len(b), own)), batch.column(0).take(pa.array(mine[r]))],
                                                         ["box", "home", "word"])
    routed = stash(words.select("word").mapInArrow(route, "box long, home boolean, word string"), "spelling-boxes")
    load = routed.groupBy("box").agg(F.sum(F.col("home").cast("long")).alias("homes"), F.sum((~F.col("home")).cast("long")).alias("queries"))
    pieces = stash(load.where("homes > 0").select(
        "box", F.ceil(F.col("homes") / (2 * per_box)).cast("long").alias("h"), F.ceil(F.col("queries") / slice_rows).cast("long").alias("q")), "spelling-pieces")
    piece = lambda n: F.pmod(F.xxhash64("word"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    dealt = routed.join(pieces, "box")  # a box without home words finds nothing
    both = dealt.where("home").select("box", "home", "word", piece("h").alias("i"), every("q").alias("j")).union(
        dealt.where("not home").select("box", "home", "word", every("h").alias("i"), piece("q").alias("j")))

    def near(t: pa.Table) -> pa.Table:
        home = t.column("home").to_numpy()
        given = t.column("word").to_pylist()
        own, asked = [given[i] for i in np.flatnonzero(home)], [given[i] for i in np.flatnonzero(~home)]
        found = list(near_in_box(own, asked)) if own and asked else []
        a, b = (np.concatenate([one[c] for one in found] or [np.zeros(0, np.int64)]) for c in (0, 1))
        left = pa.array(asked, pa.string()).take(pa.array(a))
        right = pa.array(own, pa.string()).take(pa.array(b))
        size = np.array([len(w) for w in asked], np.int64)
        back = pa.array(np.flatnonzero(size[a] < len(own[0])) if len(a) else a)  # found from the shorter word only
        return pa.table([pa.concat_arrays([left, right.take(back)]), pa.concat_arrays([right, left.take(back)])], names=["word", "near"])
    # a task sorts the rows of about eight groups, whatever the corpus
    tasks = pieces.agg(F.ceil(F.coalesce(F.sum(F.col("h") * F.col("q")), F.lit(0)) / 8)).first()[0]
    return both.repartition(max(1, int(tasks)), "box", "i", "j").groupBy("box", "i", "j").applyInArrow(near, "word string, near string")


def spelling_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 5, min_count: int = 3,
                    ratio: int = 2, modulus: int | None = 97) -> DataFrame:
    """One row per word: word, form, root (string), n, n_near, form_n (long).

    Words are the runs ``[A-Za-z\\u00C0-\\u00FF]+``, A-Z lower-cased, of at
    least ``min_length`` code points with at least ``min_count`` occurrences
    (n) in all texts; with ``modulus``, a run whose crc32 of ``<doc_id>:<run>``
    it divides first loses a letter (None: no run does).  ``n_near`` counts the
    words one inserted, deleted or replaced letter away, ``form`` is the one of
    them with the largest n (then the smallest in code-point order) if that is
    at least ``ratio`` times the word's n; ``root`` follows the forms to the
    last.

    Null and empty texts have no words; a null id counts as empty text.
    Repeated rows count each.  Other columns are ignored; an empty table gives
    no rows."""
    if ratio < 2:
        raise ValueError("ratio must be at least 2, or forms may go round in a circle")
    words = stash(count_words(docs, id_col, text_col, min_length, min_count, modulus), "spelling-words")
    pairs = stash(near_words(words), "spelling-near")
    best = pairs.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near").groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    found = stash(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best.near")).alias("form"),
        F.when(-F.col("best.less") >= ratio * F.col("n"), -F.col("best.less")).alias("form_n")), "spelling-forms")
    # n at least doubles (ratio 2) from form to form, so the walk ends; each round doubles its step
    step = stash(found.where("form is not null").select("word", F.col("form").alias("last")), "spelling-roots")
    while True:
        on = step.select(F.col("word").alias("last"), F.col("last").alias("further"))
        ahead = stash(step.join(on, "last", "left").select("word", F.coalesce("further", "last").alias("last"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        step = ahead.select("word", "last")
        if ahead.where("moved").isEmpty():
            break
    return found.join(step, "word", "left").select("word", "form", F.coalesce("last", "word").alias("root"), "n", "n_near", "form_n")


def brute_force(counts: dict[str, int], ratio: int = 2) -> list[tuple]:
    """(word, form, root, n, n_near, form_n) by making every edit; for tests."""
    alphabet = [chr(c) for c in LETTERS.tolist()]
    form, near_n = {}, {}
    for w in counts:
        made = {w[:i] + w[i + 1:] for i in range(len(w))}
        made |= {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in alphabet}
        made |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in alphabet}
        near = [x for x in made if x in counts and x != w]
        near_n[w] = len(near)
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], near_n[w], counts[form[w]] if form[w] else None))
    return out
