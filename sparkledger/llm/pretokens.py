"""Vectorised pre-tokenisation of the byte-level BPE vocabularies.

Splits texts exactly as the published pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``
does, by character classes and run boundaries on whole arrays of code points,
and groups equal pieces so that each distinct piece is encoded once.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex

from .common import HashIndex, mix64, ragged

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
#: The code points of Unicode's White_Space property.
WHITE_SPACE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    out = np.full(0x110000, OTHER, np.uint8)
    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for pattern, value in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER)):
        for m in regex.finditer(pattern, everything):
            a, b = m.span()
            # the string skips the surrogates
            out[a + 0x800 * (a >= 0xD800): b + 0x800 * (b > 0xD800)] = value
    out[WHITE_SPACE] = SPACE
    return out


def utf8_column(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is empty.  Offsets start at 0."""
    col = col.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8)
    data = np.frombuffer(col.buffers()[2], np.uint8)[offsets[0]:offsets[-1]] if col.buffers()[2] else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte position where each piece starts, and pieces per text.

    ``data`` holds the UTF-8 bytes of all texts, ``offsets`` their limits.
    """
    n_texts = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(n_texts, np.int64)
    lead = np.flatnonzero((data & 0xC0) != 0x80)  # byte position of each code point
    if len(lead) == len(data):
        points = data.astype(np.uint32)
    else:
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    kind = class_table()[points]
    text_at = np.searchsorted(lead, offsets[:-1][np.diff(offsets) > 0])
    mask = np.empty(len(points), bool)
    mask[0] = True
    np.not_equal(kind[1:], kind[:-1], out=mask[1:])
    mask[text_at] = True
    runs = np.flatnonzero(mask)
    ends = np.append(runs[1:], len(points))
    run_kind = kind[runs]
    follows = np.zeros(len(runs), bool)  # a run of the same text comes next
    follows[:-1] = True
    first = np.zeros(len(points) + 1, bool)
    first[text_at] = True
    follows[:-1] &= ~first[runs[1:]]
    # White space before something else: its last character stands alone, or goes with what follows if it is a blank.
    w = np.flatnonzero((run_kind == SPACE) & follows)
    last = ends[w] - 1
    mask[last] = True
    blank = points[last] == 32
    mask[ends[w][blank]] = False
    # Contractions: a lone apostrophe that starts a piece, then letters.
    c = np.flatnonzero((run_kind == OTHER) & follows & (ends - runs == 1))
    c = c[(points[runs[c]] == 39) & mask[runs[c]]]
    c = c[run_kind[c + 1] == LETTER] if c.size else c
    if c.size:
        at, stop = runs[c] + 1, ends[c + 1]
        c1 = points[at]
        c2 = np.where(at + 1 < stop, points[np.minimum(at + 1, len(points) - 1)], 0)
        one = np.isin(c1, [115, 116, 109, 100])
        two = ((c1 == 114) & (c2 == 101)) | ((c1 == 118) & (c2 == 101)) | ((c1 == 108) & (c2 == 108))
        took = np.where(one, 1, np.where(two, 2, 0))
        hit = took > 0
        mask[at[hit]] = False
        rest = (at + took)[hit]
        mask[rest[rest < stop[hit]]] = True
    starts = lead[np.flatnonzero(mask)]
    per_text = np.diff(np.searchsorted(starts, offsets))
    return starts, per_text


def piece_keys(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each piece's bytes."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray((len(data) + 1,), "<u8", padded.tobytes(), 0, (1,))
    h = mix64(lengths.astype(np.uint64) + np.uint64(0x1234567))
    c = mix64(lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    todo, at, left = np.arange(len(starts)), starts.copy(), lengths.astype(np.int64).copy()
    while todo.size:
        w = words[at]
        short = left < 8
        keep = np.uint64(64) - np.uint64(8) * np.minimum(left, 8).astype(np.uint64)
        w = np.where(short, (w << (keep & np.uint64(63))) >> (keep & np.uint64(63)), w)
        h[todo] = mix64(h[todo] ^ w)
        c[todo] = mix64(c[todo] * np.uint64(0xD6E8FEB86659FD93) + w)
        go = left > 8
        todo, at, left = todo[go], at[go] + 8, left[go] - 8
    return h, c


class PieceCache:
    """Token ids of distinct pieces, kept from batch to batch inside a worker.

    Holds at most ``limit`` pieces and starts anew beyond that, so memory is
    bounded whatever the vocabulary.  Pieces are told apart by 128 hashed bits.
    """

    def __init__(self, encode, limit: int = 1_200_000):
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self.index = HashIndex(21)
        self.check = np.zeros(1 << 16, np.uint64)
        self.start = np.zeros((1 << 16) + 1, np.int64)
        self.ids = np.zeros(1 << 18, np.uint16)

    def _append(self, check: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        n, used = self.index.count, int(self.start[self.index.count])
        while n + len(check) > len(self.check):
            self.check = np.concatenate([self.check, np.zeros_like(self.check)])
            self.start = np.concatenate([self.start, np.zeros(len(self.check) - len(self.start) + 1, np.int64)])
        while used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.check[n:n + len(check)] = check
        self.start[n + 1:n + 1 + len(check)] = used + np.cumsum(counts)
        self.ids[used:used + len(ids)] = ids

    def encode_texts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, ids per text)."""
        starts, per_text = piece_starts(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint16), np.zeros(len(per_text), np.int64)
        lengths = np.diff(np.append(starts, len(data)))
        h, c = piece_keys(data, starts, lengths)
        uniq, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        if not np.array_equal(c[first][inverse], c):  # two pieces share 64 bits: tell them apart by both hashes
            h = mix64(h ^ (c * np.uint64(0xA0761D6478BD642F)))
            uniq, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        if self.index.count + len(uniq) > self.limit:
            self._clear()
        entry = self.index.find(uniq)
        known = entry >= 0
        known[known] = self.check[entry[known]] == c[first][known]
        new = np.flatnonzero(~known)
        if new.size:
            fresh = new[entry[new] < 0]
            clash = new[entry[new] >= 0]
            counts, ids = self.encode(data, starts[first[new]], lengths[first[new]])
            order = np.concatenate([np.flatnonzero(entry[new] < 0), np.flatnonzero(entry[new] >= 0)])
            begin = np.cumsum(counts) - counts
            self._append(c[first[new[order]]], counts[order], ids[ragged(begin[order], counts[order])])
            base = self.index.count
            entry[fresh] = base + np.arange(len(fresh))
            entry[clash] = base + len(fresh) + np.arange(len(clash))
            self.index.add(uniq[fresh], entry[fresh].astype(np.int32))
            self.index.count = base + len(new)  # clashing pieces are held, but not found again
        which = entry[inverse]
        counts = (self.start[which + 1] - self.start[which])
        ids = self.ids[ragged(self.start[which], counts)]
        ends = np.cumsum(counts)
        text_ends = np.concatenate([[0], ends])[np.cumsum(per_text)]
        return ids, np.diff(text_ends, prepend=0)
