"""Operator 6: byte-level BPE encoding and decoding on padded numpy matrices.

Distinct pieces of a batch go into matrices by length (one bucket for each
power of two); every round each row merges its leftmost pair of minimum rank,
found by a hashed pair lookup, closes the gap, and rows without a mergeable
pair leave the matrix.  Pieces beyond the widest bucket are rows of their own
in which all leftmost occurrences of the minimum pair merge in one round as long
as that cannot change the order of merges.

Null and empty texts give no ids and empty bytes.  Texts are never cut.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HashIndex, map_arrow, ragged
from .pretokens import PieceCache, utf8_column

NO_RANK = np.int32(np.iinfo(np.int32).max)
WIDEST = 64


class RankTable:
    """Token bytes and the pair -> merged id lookup of a rank file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        size = max(ranks.values()) + 1
        assert size < 1 << 16, "ids are held in 16 bits"
        tokens = [b""] * size
        for piece, rank in ranks.items():
            tokens[rank] = piece
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.token_len = np.array([len(t) for t in tokens], np.int64)
        self.token_start = np.cumsum(self.token_len) - self.token_len
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        keys, vals = [], []
        for piece, rank in ranks.items():
            for cut in range(1, len(piece)):
                left, right = ranks.get(piece[:cut]), ranks.get(piece[cut:])
                if left is not None and right is not None:
                    keys.append(left << 16 | right)
                    vals.append(rank)
        self.pairs = HashIndex(max(10, int(np.ceil(np.log2(len(keys) * 2 + 1)))))
        # many pairs share one merged id, so values stored are positions into merged
        self.merged = np.array(vals or [0], np.int32)
        self.pairs.add(np.array(keys, np.uint64), np.arange(len(keys), dtype=np.int32))
        # Whole pieces that are tokens are one id even where the merges do not lead there.
        counts, ids = self.merge(self.token_bytes, self.token_start, self.token_len)
        single = np.zeros(size, bool)
        single[counts == 1] = ids[(np.cumsum(counts) - counts)[counts == 1]] == np.flatnonzero(counts == 1)
        self.direct = {tokens[i]: i for i in np.flatnonzero(~single & (self.token_len > 0))}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        at = self.pairs.find(left.astype(np.uint64) << np.uint64(16) | right.astype(np.uint64))
        return np.where(at >= 0, self.merged[at], NO_RANK)

    def merge(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids per piece and the ids of all pieces one after another."""
        counts = np.zeros(len(starts), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []  # (piece numbers, matrix of ids padded by -1)
        low = 0
        for width in (1, 2, 4, 8, 16, 32, WIDEST):
            rows = np.flatnonzero((lengths > low) & (lengths <= width))
            low = width
            for a in range(0, len(rows), 1 << 15):
                self._bucket(data, starts, lengths, rows[a:a + (1 << 15)], width, counts, parts)
        long_ids = {}
        for row in np.flatnonzero(lengths > WIDEST):
            long_ids[row] = self._long(self.byte_ids[data[starts[row]:starts[row] + lengths[row]]])
            counts[row] = len(long_ids[row])
        ends = np.cumsum(counts)
        out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint16)
        for rows, ids in parts:
            at = (ends - counts)[rows][:, None] + np.arange(ids.shape[1])
            keep = ids >= 0
            out[at[keep]] = ids[keep]
        for row, ids in long_ids.items():
            out[ends[row] - counts[row]:ends[row]] = ids
        return counts, out

    def _bucket(self, data, starts, lengths, rows, width, counts, parts) -> None:
        n = lengths[rows]
        cols = np.arange(width)
        at = np.minimum(starts[rows][:, None] + cols, len(data) - 1)
        ids = np.where(cols < n[:, None], self.byte_ids[data[at]], -1)
        ranks = np.full((len(rows), max(width, 2)), NO_RANK, np.int32)  # ranks[:, j]: pair (j, j+1)
        if width > 1:
            live = cols[1:] < n[:, None]
            ranks[:, :width - 1][live] = self.rank(ids[:, :-1][live], ids[:, 1:][live])
        n = n.copy()
        while len(rows):
            best = ranks.argmin(axis=1)
            each = np.arange(len(rows))
            low = ranks[each, best]
            done = low == NO_RANK
            if done.any():
                counts[rows[done]] = n[done]
                parts.append((rows[done], ids[done, :max(1, int(n[done].max()))]))
                go = ~done
                rows, n, ids, ranks, best, low = rows[go], n[go], ids[go], ranks[go], best[go], low[go]
                each = each[:len(rows)]
                if not len(rows):
                    return
            # Close the gap: columns after the merged pair move one to the left.
            w = ids.shape[1]
            src = np.arange(w) + (np.arange(w) > best[:, None])
            ids = np.where(src < w, np.take_along_axis(ids, np.minimum(src, w - 1), 1), -1)
            ids[each, best] = low
            w = ranks.shape[1]
            src = np.arange(w) + (np.arange(w) > best[:, None])
            ranks = np.where(src < w, np.take_along_axis(ranks, np.minimum(src, w - 1), 1), NO_RANK)
            n -= 1
            ranks[each, best] = NO_RANK
            right = np.flatnonzero(best + 1 < n)
            ranks[right, best[right]] = self.rank(ids[right, best[right]], ids[right, best[right] + 1])
            left = np.flatnonzero(best > 0)
            ranks[left, best[left] - 1] = self.rank(ids[left, best[left] - 1], ids[left, best[left]])
            if (most := int(n.max())) <= ids.shape[1] // 2:
                ids, ranks = ids[:, :most], ranks[:, :max(most, 2)]

    def _long(self, ids: np.ndarray) -> np.ndarray:
        ranks = self.rank(ids[:-1], ids[1:])
        while len(ranks) and (low := ranks.min()) != NO_RANK:
            at = np.flatnonzero(ranks == low)
            # Of overlapping pairs the leftmost of each chain merge.
            chain = np.concatenate([[0], np.cumsum(np.diff(at) > 1)])
            first = np.concatenate([[0], np.flatnonzero(np.diff(chain)) + 1])
            at = at[(np.arange(len(at)) - first[chain]) % 2 == 0]
            for take in (at, at[:1]):
                keep = np.ones(len(ids), bool)
                keep[take + 1] = False
                new = ids.copy()
                new[take] = low
                new = new[keep]
                pos = take - np.arange(len(take))
                near = np.unique(np.concatenate([pos - 1, pos]))
                near = near[(near >= 0) & (near < len(new) - 1)]
                fresh = self.rank(new[near], new[near + 1])
                if len(take) == 1 or not (fresh < low).any():
                    break
            keep_rank = np.ones(len(ranks), bool)
            keep_rank[take] = False
            ranks = ranks[keep_rank]
            ranks[near] = fresh
            ids = new
        return ids

    def encode_pieces(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts, ids = self.merge(data, starts, lengths)
        if self.direct:
            begin, fixed = np.cumsum(counts) - counts, None
            for i in np.flatnonzero(counts > 1):
                whole = self.direct.get(data[starts[i]:starts[i] + lengths[i]].tobytes())
                if whole is not None:
                    fixed = counts.copy() if fixed is None else fixed
                    fixed[i], ids[begin[i]] = 1, whole
            if fixed is not None:
                ids, counts = ids[ragged(begin, fixed)], fixed
        return counts, ids

    def decode(self, ids: np.ndarray) -> np.ndarray:
        return self.token_bytes[ragged(self.token_start[ids], self.token_len[ids])]


@lru_cache(maxsize=2)
def rank_table(path: str) -> RankTable:
    return RankTable(path)


@lru_cache(maxsize=2)
def _encoder(path: str) -> PieceCache:
    return PieceCache(rank_table(path).encode_pieces)


def split_binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary column: cell i holds the bytes of values up to ends[i]."""
    offsets = np.concatenate([[0], ends]).astype(np.int64) * values.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def bpe_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns (id, ids): ids as little-endian unsigned 32-bit integers in a binary."""

    def encode(piece: pa.RecordBatch) -> pa.RecordBatch:
        ids, counts = _encoder(path).encode_texts(*utf8_column(piece.column(1)))
        return pa.RecordBatch.from_arrays([piece.column(0), split_binary(ids.astype("<u4"), np.cumsum(counts))], names=["id", "ids"])

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("body"))
    return map_arrow(src, encode, "id long, ids binary", "body").withColumnRenamed("id", id_col)


def bpe_decode(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """Columns (id, ids, decoded): the bytes that the ids stand for."""

    def decode(piece: pa.RecordBatch) -> pa.RecordBatch:
        table = rank_table(path)
        col = piece.column(1).fill_null(b"").cast(pa.large_binary())
        offsets = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8)
        raw = col.buffers()[2]
        ids = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]].view("<u4") if raw else np.zeros(0, "<u4")
        ends = np.concatenate([[0], np.cumsum(table.token_len[ids])])
        at = (offsets[1:] - offsets[0]) // 4
        return pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), split_binary(table.decode(ids), ends[at])], names=["id", "ids", "decoded"])

    src = encoded.select(F.col(id_col).alias("id"), "ids")
    return map_arrow(src, decode, "id long, ids binary, decoded binary", "ids").withColumnRenamed("id", id_col)


def bpe_round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``bpe_decode(bpe_encode(docs))`` in one pass of one worker: columns (id, ids, decoded)."""

    def both(piece: pa.RecordBatch) -> pa.RecordBatch:
        table = rank_table(path)
        ids, counts = _encoder(path).encode_texts(*utf8_column(piece.column(1)))
        ends = np.cumsum(counts)
        lengths = np.concatenate([[0], np.cumsum(table.token_len[ids])])
        cells = [split_binary(ids.astype("<u4"), ends), split_binary(table.decode(ids), lengths[ends])]
        return pa.RecordBatch.from_arrays([piece.column(0), *cells], names=["id", "ids", "decoded"])

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("body"))
    return map_arrow(src, both, "id long, ids binary, decoded binary", "body").withColumnRenamed("id", id_col)


def bpe_digests(docs: DataFrame, path: str) -> DataFrame:
    """The query: one row per document with digests of its ids and decoded bytes."""
    done = bpe_round_trip(docs, path)
    return done.select(
        "doc_id",
        F.expr("cast(octet_length(ids) div 4 as long)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
