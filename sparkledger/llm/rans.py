"""Operator 7: token ids in files coded by a static range asymmetric numeral system.

One frequency table, counted over all ids, is shared by every block.  A block
holds whole documents of up to BLOCK ids together, or a piece of a longer one, dealt over LANES interleaved coder states and stands
alone: it carries its final states (the checkpoint a decoder starts from), its
32-bit words, the documents in it and a checksum of its ids, so blocks decode in
parallel and in any order.  Ids follow each other in ascending doc_id order,
every document closed by the end id.

File format: a folder ``blocks`` of Parquet rows, one a block, and a folder
``table`` with the 50k-odd scaled frequencies (bounded by the vocabulary).

Null and empty texts are documents of the end id alone; a null doc_id comes
first; rows of one doc_id are kept apart, by the hash of their text; an empty
table gives empty files.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import split_binary
from .common import arrow_steps, scratch_path
from .pretokens import PieceCache, utf8_column

SCALE_BITS = 20
LOW = np.uint64(1 << 31)
BLOCK, LANES = 1 << 16, 128
#: Blocks that one vectorised step codes together.
TOGETHER = 48
END_ID = 0


@lru_cache(maxsize=2)
def _library(path: str) -> PieceCache:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text

    def encode(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        pieces = [raw[a:b].decode() for a, b in zip(starts.tolist(), (starts + lengths).tolist(), strict=True)]
        chunks = [pieces[i:i + 2000] for i in range(0, len(pieces), 2000)]
        counts, ids = [], []
        for chunk, done in zip(chunks, tokenizer.encode_batch(chunks, is_pretokenized=True, add_special_tokens=False), strict=True):
            counts.append(np.bincount(np.array(done.word_ids, np.int64), minlength=len(chunk)))
            ids.append(np.array(done.ids, np.uint16))
        return np.concatenate(counts), np.concatenate(ids)

    return PieceCache(encode)


def scaled_frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to sum to 2**SCALE_BITS, at least 1 where a count is."""
    total, room = int(counts.sum()), 1 << SCALE_BITS
    if not total:
        return np.zeros(len(counts), np.int64)
    freq = np.where(counts > 0, np.maximum(1, np.floor(counts * (room / total))), 0).astype(np.int64)
    order = np.argsort(-freq, kind="stable")
    while (gap := room - int(freq.sum())) != 0:
        if gap > 0:
            freq[order[0]] += gap
        else:  # take from the most frequent, never below 1
            take = np.minimum(freq[order] - 1, -(-(freq[order] * -gap) // room) + 1)
            take = np.minimum(take, np.maximum(0, -gap - (np.cumsum(take) - take)))
            freq[order] -= take
    return freq


class Coder:
    """Encodes and decodes many blocks at once, all lanes in one vector."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.start = (np.cumsum(freq) - freq).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint16), freq)

    def encode(self, blocks: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(final states, words) of each block of ids."""
        steps = max(-(-len(b) // LANES) for b in blocks)
        ids = np.zeros((len(blocks), steps * LANES), np.uint16)
        size = np.array([len(b) for b in blocks])
        for row, b in zip(ids, blocks, strict=True):
            row[:len(b)] = b
        ids = ids.reshape(len(blocks), steps, LANES)
        state = np.full((len(blocks), LANES), LOW, np.uint64)
        words = np.zeros((len(blocks), steps, LANES), np.uint32)
        sent = np.zeros((len(blocks), steps, LANES), bool)
        bits, lane = np.uint64(SCALE_BITS), np.arange(LANES)
        limit = np.uint64((1 << 31 >> SCALE_BITS) << 32)
        for t in range(steps - 1, -1, -1):
            live = t * LANES + lane < size[:, None]
            full = bool(live.all())
            s = ids[:, t]
            f = self.freq[s] if full else np.where(live, self.freq[s], 1)
            over = state >= limit * f
            if not full:
                over &= live
            words[:, t] = state  # the low 32 bits
            sent[:, t] = over
            x = np.where(over, state >> np.uint64(32), state)
            q = x // f
            new = (q << bits) + (x - q * f) + self.start[s]
            state = new if full else np.where(live, new, state)
        return [(state[i], words[i][sent[i]]) for i in range(len(blocks))]

    def decode(self, blocks: list[tuple[int, np.ndarray, np.ndarray]]) -> list[np.ndarray]:
        """Ids of each (number of ids, final states, words)."""
        size = np.array([b[0] for b in blocks])
        steps = int(-(-size.max() // LANES))
        state = np.stack([b[1] for b in blocks])
        counts = np.array([len(b[2]) for b in blocks])
        words = np.concatenate([*(b[2] for b in blocks), np.zeros(1, np.uint32)]).astype(np.uint64)
        at = np.cumsum(counts) - counts
        out = np.zeros((len(blocks), steps, LANES), np.uint16)
        bits, slots, lane = np.uint64(SCALE_BITS), np.uint64((1 << SCALE_BITS) - 1), np.arange(LANES)
        for t in range(steps):
            slot = state & slots
            s = self.symbol[slot]
            out[:, t] = s
            new = self.freq[s] * (state >> bits) + slot - self.start[s]
            want = new < LOW
            if (t + 1) * LANES > size.min():
                live = t * LANES + lane < size[:, None]
                new, want = np.where(live, new, state), want & live
            row, col = np.nonzero(want)
            got = np.bincount(row, minlength=len(blocks))
            rank = np.arange(len(row)) - np.repeat(np.cumsum(got) - got, got)
            new[row, col] = (new[row, col] << np.uint64(32)) | words[np.repeat(at, got) + rank]
            at += got
            state = new
        return [out[i].reshape(-1)[:n] for i, n in enumerate(size)]


def _tokenised(docs: DataFrame, path: str, id_col: str, text_col: str) -> DataFrame:
    """(part, at, doc, n, ids): sorted by doc_id over range partitions; at: ids before it in its partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for piece in arrow_steps(batches, "body"):
            ids, counts = _library(path).encode_texts(*utf8_column(piece.column(2)))
            ends = np.cumsum(counts)
            ids = np.insert(ids, ends, END_ID)  # behind each document
            counts = counts + 1
            ends = np.cumsum(counts)
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(at + ends - counts), piece.column(1), pa.array(counts), split_binary(ids.astype("<u2"), ends)], names=["part", "at", "doc", "n", "ids"])
            at += int(ends[-1]) if len(ends) else 0

    src = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("body"))
    # The last key lets rows that are alike in all be dealt to several ranges.
    order = ("doc", F.xxhash64("body"), "row")
    src = src.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    return src.select(F.spark_partition_id().alias("part"), "doc", "body").mapInArrow(run, "part int, at long, doc long, n long, ids binary")


def write_ids(docs: DataFrame, tokenizer_path: str, out_path: str, vocabulary: int = 50257, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text and write the block files below ``out_path``."""
    spark = docs.sparkSession
    parts = scratch_path(spark, "ids")
    _tokenised(docs, tokenizer_path, id_col, text_col).write.option("compression", "zstd").parquet(parts)
    parts = spark.read.schema("part int, at long, doc long, n long, ids binary").parquet(parts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for b in batches:
            col = b.column(0).cast(pa.large_binary())
            raw = b"".join(x for x in col.to_pylist())
            total += np.bincount(np.frombuffer(raw, "<u2"), minlength=vocabulary)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["id", "n"])

    # At most one row for each id of the vocabulary, and one for each partition.
    freq_rows = parts.select("ids").mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(vocabulary, np.int64)
    for r in freq_rows:
        counts[r.id] = r.n
    freq = scaled_frequencies(counts)
    sizes = {r.part: r.n for r in parts.groupBy("part").agg(F.sum("n").alias("n")).collect()}
    base, ahead = {}, 0
    for part in sorted(sizes):
        base[part] = ahead
        ahead += sizes[part]
    spark.createDataFrame([(i, int(f)) for i, f in enumerate(freq.tolist()) if f], "id int, freq long").coalesce(1).write.parquet(f"{out_path}/table")
    shared = spark.sparkContext.broadcast((freq, base))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freq, base = shared.value
        coder, waiting = Coder(freq), []
        held, held_n, held_docs, start = [], 0, [], 0

        def close() -> None:
            nonlocal held, held_n, held_docs
            if held_n:
                waiting.append((start, np.concatenate(held), held_docs, held_docs[0]["size"] > BLOCK))
            held, held_n, held_docs = [], 0, []

        def flush() -> pa.RecordBatch:
            rows = []
            for (first, ids, pieces, long), (state, words) in zip(waiting, coder.encode([w[1] for w in waiting]), strict=True):
                rows.append({"long": long, "start": first, "n": len(ids), "states": state.astype("<u8").tobytes(), "words": words.astype("<u4").tobytes(), "crc": zlib.crc32(ids.astype("<u2").tobytes()), "docs": pieces})
            waiting.clear()
            return pa.RecordBatch.from_pylist(rows, BLOCK_ARROW)

        for b in batches:
            for part, at, doc, n, raw in zip(*(c.to_pylist() for c in b.columns), strict=True):
                first, ids = base[part] + at, np.frombuffer(raw, "<u2")
                if held_n and (start + held_n != first or held_n + n > BLOCK):
                    close()
                for off in range(0, n, BLOCK):
                    if not held_n:
                        start = first + off
                    take = min(n - off, BLOCK)
                    held.append(ids[off:off + take])
                    held_docs.append({"doc": doc, "first": first, "size": n, "off": off, "len": take})
                    held_n += take
                    if n > BLOCK:
                        close()
                    if len(waiting) == TOGETHER:
                        yield flush()
        close()
        if waiting:
            yield flush()

    parts.select("part", "at", "doc", "n", "ids").mapInArrow(blocks, BLOCK_SCHEMA).write.option("compression", "none").parquet(f"{out_path}/blocks")
    shared.unpersist()


PIECE = "struct<doc: bigint, first: bigint, size: bigint, off: bigint, len: bigint>"
BLOCK_SCHEMA = f"long boolean, start long, n long, states binary, words binary, crc long, docs array<{PIECE}>"
BLOCK_ARROW = pa.schema([("long", pa.bool_()), ("start", pa.int64()), ("n", pa.int64()), ("states", pa.binary()), ("words", pa.binary()), ("crc", pa.int64()), ("docs", pa.list_(pa.struct([(k, pa.int64()) for k in ("doc", "first", "size", "off", "len")])))])


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc, first, size, ids): every document of the files, ids as little-endian unsigned 32-bit integers.

    Raises where a block's ids do not match its checksum.  Only documents longer
    than a block are put together by a shuffle, of their pieces alone.
    """
    table_rows = spark.read.schema("id int, freq long").parquet(f"{path}/table").collect()  # at most the vocabulary
    freq = np.zeros(1 + max((r.id for r in table_rows), default=0), np.int64)
    for r in table_rows:
        freq[r.id] = r.freq
    shared = spark.sparkContext.broadcast(freq)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value)
        for b in batches:
            for a in range(0, b.num_rows, TOGETHER):
                rows = b.slice(a, TOGETHER)
                n = rows.column(1).to_pylist()
                states = [np.frombuffer(x, "<u8") for x in rows.column(2).to_pylist()]
                words = [np.frombuffer(x, "<u4") for x in rows.column(3).to_pylist()]
                ids = coder.decode(list(zip(n, states, words, strict=True)))
                for x, crc, first in zip(ids, rows.column(4).to_pylist(), rows.column(0).to_pylist(), strict=True):
                    if zlib.crc32(x.astype("<u2").tobytes()) != crc:
                        raise ValueError(f"block at {first} is damaged")
                flat = rows.column(5).flatten()
                fields = {k: flat.field(k) for k in ("doc", "first", "size", "off", "len")}
                ends = np.cumsum(np.asarray(fields["len"]))
                cells = split_binary(np.concatenate(ids).astype("<u4"), ends)
                yield pa.RecordBatch.from_arrays([fields["doc"], fields["first"], fields["size"], fields["off"], fields["len"], cells], names=["doc", "first", "size", "off", "len", "ids"])

    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    got = [blocks.where(x).drop("long").mapInArrow(pieces, "doc long, first long, size long, off long, len long, ids binary") for x in ("not long", "long")]
    whole = got[0].select("doc", "first", "size", "ids")
    split = got[1].groupBy("first").agg(
        F.max("doc").alias("doc"), F.max("size").alias("size"),
        F.expr("aggregate(array_sort(collect_list(struct(off, ids))), cast('' as binary), (a, x) -> concat(a, x.ids))").alias("ids"))
    return whole.unionAll(split.select("doc", "first", "size", "ids"))


def file_digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """The query: write the files, read them back, one row per document."""
    path = scratch_path(docs.sparkSession, "rans")
    write_ids(docs, tokenizer_path, path)
    return read_ids(docs.sparkSession, path).select(
        F.col("doc").alias("doc_id"), F.col("first").alias("start"),
        F.expr("cast(octet_length(ids) div 4 as long)").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
