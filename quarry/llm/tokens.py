"""Exact whole-text tokenisation with the tokenizers library, each distinct chunk encoded once per worker.

A text is cut at single blanks and line feeds with a plain character on both sides.  Both public BPE
files start a new pre-token there, so a chunk's ids do not depend on its neighbours.  Chunks are found
and hashed (64 bit) on the Arrow bytes, known ones are looked up in a bounded per-worker table that keeps
their bytes, and new ones go through the library many at a time, joined by a separator whose id marks the
borders.  Bytes are compared on every hit: where two chunks share a hash, the rows are encoded whole.
ASCII punctuation (not the apostrophe) next to an ASCII letter or digit is a border, too.  Any other
white space stays inside a chunk, which is then encoded whole.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from .common import mix, prefix_hash, range_hash, text_chunks

MAX_CHUNKS = 700_000            # cached chunks per Python worker (then the table starts again)
LOOP_WORDS = 64                 # words of a chunk compared for all chunks at once
_ENCODERS: dict[tuple, "ChunkEncoder"] = {}
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)       # the first k bytes of a word
_LEAD = np.zeros(256, dtype=bool)          # lead bytes of some non-ASCII white space
_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[*range(9, 14), *range(28, 33), 0]] = True
_KIND = np.zeros(256, dtype=np.uint8)      # 1 blank or line feed, 2 letter or digit, 3 punctuation
_KIND[[c for c in range(33, 127) if chr(c) != "'"]] = 3
_KIND[[c for c in range(128) if chr(c).isalnum()]] = 2
_KIND[[10, 32]] = 1


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes (little endian, zeros after the end) from every position on."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    return np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))


def chunk_spans(data: np.ndarray, off: np.ndarray, keep_space: bool):
    """Chunk starts, ends and the first chunk of each row."""
    n = len(data)
    kind = _KIND[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[off] = True
    row_edge = cut.copy()
    # single blanks and line feeds between plain characters
    p = np.flatnonzero(kind == 1)
    p = p[(p > 0) & (p + 1 < n)]
    prev, nxt = data[p - 1], data[p + 1]
    b2, b3 = data[np.maximum(p - 2, 0)], data[np.maximum(p - 3, 0)]
    bad = _BLANK[prev] | _BLANK[nxt] | _LEAD[nxt] | ((prev >= 128) & ((b2 == 0xC2) | ((b2 >= 128) & _LEAD[b3])))
    p = p[~bad & ~row_edge[p] & ~row_edge[p + 1]]
    cut[p] = True
    cut[p[data[p] == 10] + 1] = True
    # between ASCII letters or digits and ASCII punctuation other than the apostrophe
    cut[1:n] |= (kind[:-1] + kind[1:]) == 5
    s = np.flatnonzero(cut[:n])
    e = np.append(s[1:], n)
    first = np.searchsorted(s, off)
    if not keep_space:
        blank = np.zeros(n + 1, dtype=bool)
        blank[p[data[p] == 32]] = True
        s = s + blank[s]
    return s, e, first


class ChunkEncoder:
    def __init__(self, path: str, keep_space: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True      # their strings in a text are ordinary text
        self.keep_space = keep_space                # byte-level BPE: the blank belongs to the next word
        self.sep = "\n" if keep_space else " \x00 "
        self.bad = "\n" if keep_space else "\x00"
        ids = self.tok.encode(self.sep, add_special_tokens=False).ids
        self.sep_id = ids[0] if len(ids) == 1 else None
        self._reset()

    def _reset(self) -> None:
        self.bits = 21
        self.keys = np.zeros(1 << self.bits, dtype=np.uint64)
        self.slot = np.full(1 << self.bits, -1, dtype=np.int32)
        self.pool = np.zeros(1 << 20, dtype=np.uint32)
        self.start = np.zeros(MAX_CHUNKS + 1, dtype=np.int64)
        self.size = np.zeros(MAX_CHUNKS, dtype=np.int64)               # bytes of a chunk
        self.word = np.zeros(1 << 20, dtype=np.uint64)                 # the bytes, eight to a word
        self.word_at = np.zeros(MAX_CHUNKS + 1, dtype=np.int64)
        self.n = 0

    def _same(self, data: np.ndarray, s: np.ndarray, e: np.ndarray, entry: np.ndarray) -> bool:
        """Whether every chunk has the bytes of its entry."""
        if (self.size[entry] != e - s).any():
            return False
        words, left, at, k = _words(data), e - s, self.word_at[entry], 0
        while len(left):
            if k == LOOP_WORDS:                     # few are that long: compared one by one
                return all((words[a:a + n:8] & _MASK[np.minimum(n - np.arange(0, n, 8), 8)] == self.word[w:w + (n + 7) // 8]).all()
                           for a, n, w in zip(s, left, at + k))
            if ((words[s] & _MASK[np.minimum(left, 8)]) != self.word[at + k]).any():
                return False
            go = left > 8
            s, left, at, k = s[go] + 8, left[go] - 8, at[go], k + 1
        return True

    def _keep(self, data: np.ndarray, s: np.ndarray, e: np.ndarray) -> None:
        """Store the bytes of new chunks as entries n, n + 1, ..."""
        n, size = self.n, e - s
        count = (size + 7) // 8
        end = self.word_at[n] + np.cumsum(count)
        while end[-1] > len(self.word):
            self.word = np.concatenate([self.word, np.zeros(len(self.word), dtype=np.uint64)])
        part = np.arange(end[-1] - self.word_at[n]) - np.repeat(end - count - self.word_at[n], count)
        left = np.minimum(np.repeat(size, count) - 8 * part, 8)
        self.word[self.word_at[n]:end[-1]] = _words(data)[np.repeat(s, count) + 8 * part] & _MASK[left]
        self.word_at[n + 1:n + 1 + len(s)] = end
        self.size[n:n + len(s)] = size

    def whole(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Entry numbers, -1 where unknown (open addressing, all probes at once)."""
        mask = np.int64((1 << self.bits) - 1)
        at = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        out = np.full(len(h), -1, dtype=np.int32)
        todo = np.arange(len(h))
        while len(todo):
            v = self.slot[at]
            hit = (v >= 0) & (self.keys[at] == h[todo])
            out[todo[hit]] = v[hit]
            go = (v >= 0) & ~hit
            todo, at = todo[go], (at[go] + 1) & mask
        return out

    def _insert(self, h: np.ndarray, entry: np.ndarray) -> None:
        mask = np.int64((1 << self.bits) - 1)
        at = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(h):
            free = self.slot[at] < 0
            self.slot[at[free]] = entry[free]       # of several at one place the last stays
            self.keys[at[free]] = h[free]
            done = self.slot[at] == entry
            self.keys[at[done]] = h[done]
            h, entry, at = h[~done], entry[~done], (at[~done] + 1) & mask

    def _encode(self, new: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all chunks, sizes, and the order of the chunks in them."""
        plain = [i for i, c in enumerate(new) if self.sep_id is not None and c and self.bad not in c]
        groups = [plain[i:i + 500] for i in range(0, len(plain), 500)]
        ids, size, order, odd = [], [], [], sorted(set(range(len(new))) - set(plain))
        for grp, enc in zip(groups, self.tok.encode_batch_fast([self.sep.join([new[i] for i in g]) for g in groups],
                                                               add_special_tokens=False)):
            x = np.array(enc.ids, dtype=np.uint32)
            sep = x == self.sep_id
            at = np.flatnonzero(sep)
            if len(at) == len(grp) - 1:
                ids.append(x[~sep])
                size.append(np.diff(np.concatenate([[-1], at, [len(x)]])) - 1)
                order += grp
            else:                                   # a separator id inside a chunk: one by one
                odd += grp
        for i in odd:
            ids.append(np.array(self.whole(new[i]), dtype=np.uint32))
            size.append(np.array([len(ids[-1])]))
        return np.concatenate(ids), np.concatenate(size), np.array(order + odd, dtype=np.int64)

    def _learn(self, h: np.ndarray, data: np.ndarray, s: np.ndarray, e: np.ndarray) -> None:
        raw = data.tobytes()
        ids, size, order = self._encode([raw[a:b].decode("utf-8", "replace") for a, b in zip(s.tolist(), e.tolist())])
        lo, k = self.start[self.n], len(order)
        while lo + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(len(self.pool), dtype=np.uint32)])
        self.pool[lo:lo + len(ids)] = ids
        self.start[self.n + 1:self.n + 1 + k] = lo + np.cumsum(size)
        self._keep(data, s[order], e[order])
        self._insert(h[order], np.arange(self.n, self.n + k, dtype=np.int32))
        self.n += k

    def encode_bytes(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 rows -> all ids (uint32) and id offsets by row."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
        s, e, first = chunk_spans(data, off, self.keep_space)
        h = mix(range_hash(prefix_hash(data), s, e) + (e - s).astype(np.uint64))
        ent = self._find(h)
        miss = np.flatnonzero(ent < 0)
        if len(miss):
            u, k = np.unique(h[miss], return_index=True)
            if self.n + len(u) > MAX_CHUNKS:
                self._reset()
                u, k = np.unique(h, return_index=True)
                miss = np.arange(len(h))
            if len(u) > MAX_CHUNKS:                 # more new chunks in one slice than the table holds
                return self._slow(data, off)
            self._learn(u, data, s[miss[k]], e[miss[k]])
            ent[miss] = self._find(h[miss])
        if not self._same(data, s, e, ent):
            return self._slow(data, off)
        size = self.start[ent + 1] - self.start[ent]
        end = np.cumsum(size)
        flat = np.arange(end[-1]) + np.repeat(self.start[ent] - end + size, size)
        return self.pool[flat], np.concatenate([[0], end])[first]

    def _slow(self, data, off):
        raw = data.tobytes()
        rows = [np.array(self.whole(raw[a:b].decode("utf-8", "replace")), dtype=np.uint32) for a, b in zip(off, off[1:])]
        return np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])])


def encoder(path: str, keep_space: bool) -> ChunkEncoder:
    """One encoder per Python worker (workers are reused between tasks)."""
    key = (path, keep_space)
    if key not in _ENCODERS:
        _ENCODERS[key] = ChunkEncoder(path, keep_space)
    return _ENCODERS[key]


def encode_column(enc: ChunkEncoder, texts: pa.Array):
    """For slices of the column: first row, ids, id offsets by row."""
    for first, data, off in text_chunks(texts):
        ids, at = enc.encode_bytes(data, off)
        yield first, ids, at
