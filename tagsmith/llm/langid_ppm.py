"""Language identification by prediction by partial matching.

Each language has a context tree over bytes: for every context of 0 to
``order`` bytes the counts of the bytes that followed it.  The tree is frozen
after training.  A byte costs ``-log2 c / (n + d)`` bits in the longest context
that has seen it (c its count, n all counts and d the different bytes there);
every longer known context escapes first, at ``-log2 d / (n + d)`` bits
(method C); a byte that no context has seen costs 8 bits more.  The exact code
length of the whole text under each tree decides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagsmith.llm.common import LOWER, arrow_batches, map_batches, remainder, stash

CACHE_BITS = 21


def grams(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """(code of each byte with the ``order`` bytes before it, first byte of
    each text); the context before a text is spaces."""
    pad = b" " * order
    raw = np.frombuffer(b"".join(x for t in texts for x in (pad, t)), np.uint8)
    code = np.zeros(max(0, len(raw) - order), np.uint64)
    for i in range(order + 1):
        code = code << np.uint64(8) | raw[i:len(raw) - order + i]
    size = np.array([len(t) for t in texts], np.int64)
    keep = np.ones(len(code), bool)  # codes that end in a pad belong to no text
    at = np.cumsum(size + order) - order
    for k in range(order):
        keep[(at + k)[at + k < len(code)]] = False
    return code[keep], np.concatenate([[0], np.cumsum(size)])


class Table:
    """Values of (code, language) pairs, by code: only pairs that occur."""

    def __init__(self, code: np.ndarray, lang: np.ndarray, value: np.ndarray):
        first = np.flatnonzero(_changes(code))
        self.codes, self.start = code[first], np.append(first, len(code))
        self.lang, self.value = lang.astype(np.int32), value

    def of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``codes``, language, value) of all pairs of the codes."""
        row, found = _find(self.codes, codes)
        place = np.flatnonzero(found)
        a = self.start[row[place]]
        size = self.start[row[place] + 1] - a if len(place) else a
        at = np.arange(size.sum()) + np.repeat(a - np.cumsum(size) + size, size)
        return np.repeat(place, size), self.lang[at], self.value[at]


class Trees:
    """The languages' frozen context trees, merged into sorted tables.  They
    grow with the (context, byte, language) triples met in training; the rows
    of costs of the commonest codes, one cost a language, are kept up to
    ``cache_bytes``."""

    def __init__(self, order: int, langs: list[str], lang: np.ndarray, code: np.ndarray, n: np.ndarray, cache_bytes: int = 64 << 20):
        self.order, self.langs = order, langs
        self.bits: list[Table] = []
        self.escape: list[Table] = []
        for o in range(order, -1, -1):  # the counts of a shorter context are sums of longer ones
            code, lang, n, _ = _grouped(code & np.uint64((1 << 8 * (o + 1)) - 1), lang, n)
            ctx, own, total, kinds = _grouped(code >> np.uint64(8), lang, n)
            all_ = np.log2(total + kinds)
            self.escape.insert(0, Table(ctx, own, all_ - np.log2(kinds)))
            in_order = np.lexsort((lang, code >> np.uint64(8)))
            here = np.empty(len(code))
            here[in_order] = np.repeat(all_, kinds.astype(np.int64))
            self.bits.insert(0, Table(code, lang, here - np.log2(n)))
            if o == order:  # direct-mapped cache of the costs of codes seen in training
                first = np.flatnonzero(_changes(code))
                top, often = code[first], np.add.reduceat(n, first) if len(first) else n
        most = cache_bytes // (4 * max(1, len(langs)))
        if len(top) > most:
            top = top[np.sort(np.argsort(-often, kind="stable")[:most])]
        self.slot_code = np.full(1 << CACHE_BITS, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.slot_row = np.zeros(1 << CACHE_BITS, np.int32)
        slot = _slot(top)
        self.slot_code[slot], self.slot_row[slot] = top, np.arange(len(top))
        self.step = max(1, min(1 << 20, (1 << 23) // max(1, len(langs))))  # codes at once: one cost a language
        self.top_cost = np.zeros((max(1, len(top)), len(langs)), np.float32)
        for i in range(0, len(top), self.step):
            self.top_cost[i:i + self.step] = self._cost(top[i:i + self.step])

    def _cost(self, code: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each code, per language."""
        out = np.zeros((len(code), len(self.langs)))
        todo = np.ones(out.shape, bool)
        for o in range(self.order, -1, -1):
            g = code & np.uint64((1 << 8 * (o + 1)) - 1)
            at, lang, bits = self.bits[o].of(g)
            on = todo[at, lang]
            out[at[on], lang[on]] += bits[on]
            todo[at[on], lang[on]] = False
            at, lang, bits = self.escape[o].of(g >> np.uint64(8))
            on = todo[at, lang]
            out[at[on], lang[on]] += bits[on]
        out[todo] += 8.0
        return out

    def code_lengths(self, texts: list[bytes], step: int | None = None) -> np.ndarray:
        """Exact code length in bits of every text under every tree."""
        out = np.zeros((len(texts), len(self.langs)))
        code, start = grams(texts, self.order)
        step = step or self.step
        for i in range(0, len(code), step):
            c = code[i:i + step]
            slot = _slot(c)
            known = self.slot_code[slot] == c
            cost = self.top_cost[self.slot_row[slot]]
            if not known.all():
                new, at = np.unique(c[~known], return_inverse=True)
                cost[~known] = self._cost(new)[at]
            a, b = np.searchsorted(start, [i, i + len(c)], "right") - 1
            b = min(b, len(texts) - 1)
            first = np.clip(start[a:b + 1] - i, 0, len(c))
            held = np.diff(np.append(first, len(c))) > 0
            out[np.arange(a, b + 1)[held]] += np.add.reduceat(cost, first[held], axis=0, dtype=np.float64)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """(language or ``und``, posterior of the winner under equal priors)."""
        sure = [bool(self.langs) and t is not None and any(map(str.isalpha, t)) for t in texts]
        raw = [t.encode("utf-8", "surrogatepass").translate(LOWER) for t, s in zip(texts, sure) if s]
        out, score = ["und"] * len(texts), np.zeros(len(texts))
        if raw:
            bits = self.code_lengths(raw)
            best = bits.argmin(1)
            gap = np.minimum(bits - bits.min(1, keepdims=True), 1000)
            on = np.flatnonzero(sure)
            score[on] = 1 / np.exp2(-gap).sum(1)
            for i, b in zip(on.tolist(), best.tolist()):
                out[i] = self.langs[b]
        return out, score


def _slot(code: np.ndarray) -> np.ndarray:
    return (code * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - CACHE_BITS)).astype(np.int64)


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a sorted row differs from the one before it."""
    out = np.ones(len(columns[0]), bool)
    out[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return out


def _grouped(code: np.ndarray, lang: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(code, language, sum of n, rows) of each (code, language), sorted."""
    by = np.lexsort((lang, code))
    code, lang, n = code[by], lang[by], n[by].astype(float)
    first = np.flatnonzero(_changes(code, lang))
    if not len(first):
        return code, lang, n, n
    return code[first], lang[first], np.add.reduceat(n, first), np.diff(np.append(first, len(code))).astype(float)


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def train(docs: DataFrame, order: int = 3, docs_per_lang: int = 5000, bytes_per_lang: int = 32 << 20, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang") -> Trees:
    """Context trees of every non-null language of ``docs``, fitted on whole
    documents chosen by a hash of the id: about ``docs_per_lang`` documents and
    ``bytes_per_lang`` bytes of text of each language, whichever is less (all
    of them where there are fewer).  These bounds also bound the model, which
    holds no more (context, byte) pairs of a language than bytes were read."""
    src = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"),
                      F.pmod(F.xxhash64(id_col), F.lit(1 << 30)).alias("draw")).where("lang is not null and text is not null")
    sizes = src.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    share = F.least(F.lit(1.0), F.lit(docs_per_lang) / F.col("n"), F.lit(bytes_per_lang) / F.greatest(F.col("bytes"), F.lit(1)))
    sizes = stash(sizes.select("lang", F.floor(share * (1 << 30)).alias("below")), "languages")
    langs = sorted(r["lang"] for r in sizes.select("lang").collect())  # one row a language
    index = {v: i for i, v in enumerate(langs)}
    if not langs:
        return Trees(order, [], np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0))
    some = src.join(sizes, "lang").where("draw < below").select("lang", "text")

    def run(t: pa.Table) -> pa.Table:
        by: dict[str, list[bytes]] = {}
        for v, text in zip(t.column(0).to_pylist(), t.column(1).to_pylist()):
            by.setdefault(v, []).append(text.encode("utf-8", "surrogatepass").translate(LOWER))
        parts = [(index[v], *np.unique(grams(x, order)[0], return_counts=True)) for v, x in by.items()]
        return pa.table([pa.array(np.concatenate([np.full(len(c), i) for i, c, _ in parts]).astype(np.int32)),
                         pa.array(np.concatenate([c for _, c, _ in parts]).view(np.int64)),
                         pa.array(np.concatenate([n for _, _, n in parts]).astype(np.int64))], names=["lang", "code", "n"])
    counts = map_batches(some, run, "lang int, code long, n long", 256).groupBy("lang", "code").agg(F.sum("n").alias("n"))
    got = pa.Table.from_batches(list(arrow_batches(counts)), pa.schema([("lang", pa.int32()), ("code", pa.int64()), ("n", pa.int64())]))
    return Trees(order, langs, got.column("lang").to_numpy().astype(np.int64), got.column("code").to_numpy().view(np.uint64),
                 got.column("n").to_numpy().astype(float))


def identify(docs: DataFrame, modulus: int = 4, held_out: int = 2, order: int = 3, docs_per_lang: int = 5000,
             bytes_per_lang: int = 32 << 20, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per document: id, held_out, lang_pred, score.

    The trees learn from rows with text and a language whose crc32 of the
    id's text modulo ``modulus`` is not ``held_out``; a null id is no held-out
    one.  A prediction sees the whole text only.  ``lang_pred`` is ``und``
    (score 0) for null text, text without a letter, and if nothing was
    learned; equal code lengths go to the first language by name.  Repeated
    rows are predicted each; other columns are ignored; an empty table gives
    no rows."""
    if not 1 <= order <= 7:
        raise ValueError("order must be 1..7")
    out = F.coalesce(remainder(F.col(id_col), modulus) == held_out, F.lit(False))
    trees = train(docs.where(~out), order, docs_per_lang, bytes_per_lang, id_col, text_col, lang_col)
    sent = docs.sparkSession.sparkContext.broadcast(trees)

    def run(t: pa.Table) -> pa.Table:
        lang, score = sent.value.predict(t.column(2).to_pylist())
        return pa.table([t.column(0), t.column(1), pa.array(lang, pa.string()), pa.array(score)],
                        names=["id", "held_out", "lang_pred", "score"])
    src = docs.select(F.col(id_col).cast("long").alias("id"), out.alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return map_batches(src, run, "id long, held_out boolean, lang_pred string, score double", 512).withColumnRenamed("id", id_col)
