"""Token ids of whole texts with a public tokenizer, in Arrow batches."""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs one task per core

PUNCTUATION = b".,;:!?"
SLOTS = 1 << 22  # of the memo of pieces in a Python worker (80 MB); it is filled up to half
SPAN = 1 << 20   # bytes looked at in one go
JOIN = 500       # new words encoded in one call


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class _Hash:
    """128-bit polynomial hash of byte ranges of a buffer, all at once: the
    difference of two prefix sums, divided by the power of the first position
    (the base is odd, so its powers have inverses modulo 2^64)."""

    def __init__(self, seed: int = 20240229):
        rng = np.random.default_rng(seed)
        self.of_byte = rng.integers(1, 1 << 63, (2, 256), dtype=np.uint64) << np.uint64(1) | np.uint64(1)
        self.base = [int(x) | 1 for x in rng.integers(1 << 32, 1 << 63, 2)]
        self.power = [np.ones(1, np.uint64)] * 2
        self.inverse = [np.ones(1, np.uint64)] * 2

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.ones(n, np.uint64)
        out[1:] = np.uint64(base)
        return np.cumprod(out, dtype=np.uint64)

    def __call__(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
        if len(self.power[0]) < len(buf) + 1:
            n = max(len(buf) + 1, 2 * len(self.power[0]))
            self.power = [self._powers(b, n) for b in self.base]
            self.inverse = [self._powers(pow(b, -1, 1 << 64), n) for b in self.base]
        out = []
        for k in range(2):
            sums = np.zeros(len(buf) + 1, np.uint64)
            np.cumsum(self.of_byte[k][buf] * self.power[k][:len(buf)], out=sums[1:])
            out.append((sums[end] - sums[start]) * self.inverse[k][start])
        out[0] |= np.uint64(1)  # 0 marks a free slot
        return out


class Encoder:
    """Encodes texts to little-endian uint32 ids (as bytes).

    A tokenizer that drops white space and marks word ends (BPE with an
    end-of-word suffix) gives the same ids for a text as for its pieces
    between spaces, so the ids of pieces are memoised and the library encodes
    each new piece once; any other tokenizer encodes the texts whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        told = json.loads(self.tok.to_str())
        suffix = told["model"].get("end_of_word_suffix")
        first = (told.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
        self.by_piece = bool(suffix) and first.get("behavior") == "Removed" and first.get("invert") is True \
            and r"\s\p{L}\p{N}]" in first.get("pattern", {}).get("Regex", "")
        if self.by_piece:
            vocab = self.tok.get_vocab()
            self.ends = np.zeros(max(vocab.values()) + 1, bool)
            self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
            self.hash = _Hash()
            self.slots = [np.zeros(SLOTS, np.uint64) for _ in range(2)]
            self.slot_piece = np.zeros(SLOTS, np.int32)
            self.n_pieces = self.n_ids = self.n_slots = 0
            self.piece_start, self.piece_size = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
            self.ids = np.zeros(1 << 18, "<u4")

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[np.ndarray]:
        """Ids of words that are one pre-token each, encoded many at a time;
        the end-of-word marks tell them apart again."""
        out: list[np.ndarray] = []
        for i in range(0, len(words), JOIN):
            some = words[i:i + JOIN]
            ids = np.array(self.tok.encode(" ".join(some), add_special_tokens=False).ids, "<u4")
            last = np.flatnonzero(self.ends[ids]) + 1
            out += np.split(ids, last[:-1]) if len(last) == len(some) else self._whole(some)
        return out

    def _learn(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of new pieces.  A letters-only word with closing punctuation or
        capitals is put together from the plain word and the punctuation."""
        out: list = [None] * len(pieces)
        plain, made, other = [], [], []
        for i, p in enumerate(pieces):
            core = p.rstrip(PUNCTUATION)
            if core.isascii():
                word, low = core.isalpha(), core.lower()
            else:
                t = core.decode("utf-8", "surrogatepass")
                word, low = t.isalpha() and t.lower().isalpha() and max(t) < "\u0250", core
            if not word:
                other.append(i)
            elif low == p:
                plain.append(i)
            else:
                made.append((i, low, p[len(core):]))
        for i, ids in zip(plain, self._words([pieces[i].decode() for i in plain])):
            out[i] = ids
        for i, ids in zip(other, self._whole([pieces[i].decode("utf-8", "surrogatepass") for i in other])):
            out[i] = ids
        if made:
            cores = self._values(*_joined([c for _, c, _ in made]))
            tails = sorted({t for _, _, t in made})
            tail = dict(zip(tails, self._whole([t.decode() for t in tails])))
            for (i, _, t), v in zip(made, cores.tolist()):
                a = self.piece_start[v]
                ids = self.ids[a:a + self.piece_size[v]]
                out[i] = np.concatenate([ids, tail[t]]) if t else ids.copy()
        return out

    def _values(self, raw: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Piece numbers of the byte ranges; unknown ones are learned."""
        h, h2 = self.hash(np.frombuffer(raw, np.uint8), start, end)
        at = (h >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)
        value, todo = np.full(len(h), -1), np.arange(len(h))
        while len(todo):
            slot = at[todo]
            here = self.slots[0][slot]
            hit = (here == h[todo]) & (self.slots[1][slot] == h2[todo])
            value[todo[hit]] = self.slot_piece[slot[hit]]
            todo = todo[~hit & (here != 0)]
            at[todo] = (at[todo] + 1) % SLOTS
        miss = np.flatnonzero(value < 0)
        if len(miss):
            _, one, back = np.unique(h[miss], return_index=True, return_inverse=True)
            first = miss[one]
            ids = self._learn([raw[a:b] for a, b in zip(start[first].tolist(), end[first].tolist())])
            number = self.n_pieces + np.arange(len(ids))
            self._append(ids)
            value[miss] = number[back]
            room = SLOTS // 2 - self.n_slots
            self._insert(h[first][:room], h2[first][:room], number[:room])
        return value

    def _append(self, ids: list[np.ndarray]) -> None:
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        need = self.n_pieces + len(ids)
        if need > len(self.piece_size):
            self.piece_start, self.piece_size = (np.concatenate([x, np.zeros(need, x.dtype)]) for x in (self.piece_start, self.piece_size))
        total = int(size.sum())
        if self.n_ids + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(self.n_ids + total, "<u4")])
        self.piece_start[self.n_pieces:need] = self.n_ids + np.cumsum(size) - size
        self.piece_size[self.n_pieces:need] = size
        if total:
            self.ids[self.n_ids:self.n_ids + total] = np.concatenate(ids)
        self.n_pieces, self.n_ids = need, self.n_ids + total

    def _insert(self, h: np.ndarray, h2: np.ndarray, number: np.ndarray) -> None:
        at = (h >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)
        self.n_slots += len(h)
        while len(h):
            free = np.flatnonzero(self.slots[0][at] == 0)
            _, one = np.unique(at[free], return_index=True)
            put = free[one]
            self.slots[0][at[put]], self.slots[1][at[put]], self.slot_piece[at[put]] = h[put], h2[put], number[put]
            rest = np.ones(len(h), bool)
            rest[put] = False
            h, h2, number, at = h[rest], h2[rest], number[rest], (at[rest] + 1) % SLOTS

    def _span(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first id of each piece's end) of a buffer whose pieces are
        separated by spaces or line feeds."""
        buf = np.frombuffer(raw, np.uint8)
        gap = np.concatenate([[True], (buf == 32) | (buf == 10), [True]])
        start, end = np.flatnonzero(gap[:-1] & ~gap[1:]), np.flatnonzero(~gap[:-1] & gap[1:])
        full = self.n_slots >= SLOTS // 2
        mark = self.n_pieces, self.n_ids
        value = self._values(raw, start, end)
        size = self.piece_size[value]
        stop = np.cumsum(size)
        pick = np.repeat(self.piece_start[value] - stop + size, size) + np.arange(stop[-1] if len(stop) else 0)
        ids = self.ids[pick]
        if full:  # what found no slot is forgotten
            self.n_pieces, self.n_ids = mark
        return ids, np.stack([start, stop])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        texts = [t or "" for t in texts]
        if not self.by_piece:
            return [x.tobytes() for x in self._whole(texts)]
        out, some, size = [], [], 0
        for t in texts:
            raw = t.encode("utf-8", "surrogatepass")
            if some and size + len(raw) > SPAN:
                out += self._encode(some)
                some, size = [], 0
            some.append(raw)
            size += len(raw) + 1
        return out + self._encode(some)

    def _encode(self, raws: list[bytes]) -> list[bytes]:
        if len(raws) == 1 and len(raws[0]) > 2 * SPAN:  # a very long text, span by span
            raw, parts, a = raws[0], [], 0
            while a < len(raw):
                b = len(raw) if a + SPAN >= len(raw) else raw.find(b" ", a + SPAN)
                b = len(raw) if b < 0 else b
                parts.append(self._span(raw[a:b])[0].tobytes())
                a = b
            return [b"".join(parts)]
        ids, (start, stop) = self._span(b" ".join(raws))
        first = np.cumsum([0] + [len(r) + 1 for r in raws])
        cut = np.concatenate([[0], stop])[np.searchsorted(start, first)].tolist()
        flat = ids.tobytes()
        return [flat[4 * a:4 * b] for a, b in zip(cut, cut[1:])]


def _joined(pieces: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, pieces), np.int64, len(pieces))
    end = np.cumsum(size)
    return b"".join(pieces), end - size, end


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """The encoder of this Python worker; its memo lives as long as the worker."""
    return Encoder(path)
