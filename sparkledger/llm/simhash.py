"""Operator 12: SimHash near duplicates by deletion-variant signatures.

A fingerprint has 64 bits: bit i is set if it is set in over half of the XXH64 hashes
of the text's GRAM-word shingles (repeats included).  Two documents are linked if
their fingerprints differ in at most RADIUS bits; a component is what links reach.

Index and search work on distinct fingerprints, so copies count once:

1. The 64 bits are cut into CUT segments, the fewest for which RADIUS errors
   leave a segment with one error at most (three for four).  KEEP > 1 indexes unions of
   that many segments instead: longer keys, smaller buckets, more variants;
   for tables of billions of fingerprints take cut=6, keep=3.
2. Every segment is indexed as it is and once for each of its bits with that bit
   deleted (a wildcard).  Fingerprints whose segments differ in bit p meet where p is
   deleted, on opposite sides; those with equal segments meet in the exact bucket.
   So no pair meets twice on a segment, and a bucket of one side needs no work.
3. An equality shuffle brings buckets together; pairs are verified on all 64 bits.
   Segments shared by more than BLOCK fingerprints are cut into blocks by a hash, and
   every pair of blocks is a cell of its own: no cell holds more than about two
   blocks.  Cells give their links, large ones a spanning forest of them.

Null and empty texts have no word: fingerprint zero, linked like any other.
Texts of fewer than GRAM words are one shingle.  Rows that repeat a doc_id are
documents of their own.  A component is named by its least doc_id; null ids come
before all others.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_steps, connected_components, ragged, written
from .pretokens import utf8_column
from .repeats import NO_DOC, _texts, words_of

GRAM = 4
SEED = 42
RADIUS = 4
CUT = 3
KEEP = 1
#: Fingerprints of a block of one segment value.
BLOCK = 2048
#: Members up to which a cell's pairs are listed one by one.
SMALL = 64
#: Pairs compared at a time.
PAIRS = 1_000_000

#: Byte -> its eight bits, each in a byte of its own, so that sums of up to 255 bytes stay apart.
_SPREAD = (((np.arange(256, dtype=np.uint64)[:, None] >> np.arange(8, dtype=np.uint64)) & np.uint64(1)) << (np.arange(8, dtype=np.uint64) * np.uint64(8))).sum(1, dtype=np.uint64)


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(XXH64 of every shingle of all texts in order, shingles per text)."""
    lower = np.append(np.where((data >= 65) & (data <= 90), data + np.uint8(32), data), np.uint8(32))
    start, end, counts = words_of(lower[:-1], offsets)
    size = end - start
    # All words again, one space between them: a shingle is a slice of this.
    joined = lower[ragged(start, size + 1)]
    stop = np.cumsum(size + 1) - 1
    joined[stop] = 32
    begin = stop - size
    first = np.cumsum(counts) - counts
    text = np.repeat(np.arange(len(counts)), counts)
    last = np.minimum(np.arange(len(start)) + gram, (first + counts)[text]) - 1
    full = (np.arange(len(start)) + gram - 1 == last) | ((counts < gram)[text] & (np.arange(len(start)) == first[text]))
    raw, digest = joined.tobytes(), xxhash.xxh64_intdigest
    at = np.flatnonzero(full)
    hashes = np.fromiter((digest(raw[a:b], SEED) for a, b in zip(begin[at].tolist(), stop[last[at]].tolist(), strict=True)), np.uint64, len(at))
    return hashes, np.bincount(text[at], minlength=len(counts))


def fingerprints(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprint of every text (uint64) from its hashes; zero without any."""
    out = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    n = counts[some]
    pieces = -(-n // 255)
    of = np.repeat(np.arange(len(some)), pieces)
    step = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    cuts = (np.cumsum(n) - n)[of] + step * 255
    first = np.cumsum(pieces) - pieces
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    for j in range(8):
        lanes = np.add.reduceat(_SPREAD[octets[:, j]], cuts).astype("<u8").view(np.uint8).reshape(-1, 8)
        ones = np.add.reduceat(lanes.astype(np.int64), first, axis=0)
        for k in range(8):
            out[some] |= (ones[:, k] * 2 > n).astype(np.uint64) << np.uint64(8 * j + k)
    return out


def _fingerprint_rows(gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in arrow_steps(batches, "body"):
            fp = fingerprints(*shingle_hashes(*utf8_column(piece.column(2)), gram))
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(fp.view(np.int64))], names=["dk", "fp"])

    return run


def segment_masks(radius: int, cut: int, keep: int = 1) -> list[int]:
    """Bit masks of the segments (unions of ``keep`` out of ``cut``); raises where
    ``radius`` errors can put two into each of them."""
    each, more = divmod(radius, cut)
    if keep * each + max(0, keep - (cut - more)) > 1:
        raise ValueError(f"{radius} errors may put two into all unions of {keep} out of {cut} segments")
    edges = [64 * i // cut for i in range(cut + 1)]
    single = [sum(1 << b for b in range(x, y)) for x, y in zip(edges[:-1], edges[1:], strict=True)]
    return [sum(c) for c in combinations(single, keep)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def cells(fps: DataFrame, radius: int, cut: int, keep: int, block: int) -> DataFrame:
    """(cell, side, fp): members of sides 0 and 1 of a cell are to be compared with
    each other, members of side 2 among themselves.  ``fps`` has one row a fingerprint."""
    masks = segment_masks(radius, cut, keep)
    literal = lambda values: F.array(*[F.lit(_signed(v)).cast("long") for v in values])
    mask = F.element_at(literal(masks), F.col("slot") + 1)
    # Zero stands for no wildcard: the segment as it is.
    bits = F.element_at(F.array(*[literal([0] + [1 << b for b in range(64) if m >> b & 1]) for m in masks]), F.col("slot") + 1)
    parts = fps.select("fp", F.explode(F.array(*[F.lit(i) for i in range(len(masks))])).alias("slot")).withColumn("v", F.col("fp").bitwiseAND(mask))
    # Written, so that its size is known where it is joined.
    hot = written(parts.groupBy("slot", "v").agg(F.count("*").alias("n")).where(F.col("n") > block)
                  .select("slot", "v", F.ceil(F.col("n") / block).cast("int").alias("nb")), "hot_segments")
    parts = parts.join(hot, ["slot", "v"], "left").withColumn("nb", F.coalesce("nb", F.lit(1)))
    parts = parts.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("nb")).cast("int"))
    variants = parts.select("slot", "v", "fp", "nb", "own", F.explode(bits).alias("bit")).withColumn("nv", F.col("v").bitwiseXOR(F.col("bit")))
    other = hot.select("slot", F.col("v").alias("nv"), F.col("nb").alias("nb2"))
    met = variants.join(other, ["slot", "nv"], "left").withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("nb2", F.lit(1)) - 1)))
    exact = F.col("bit") == 0
    zero = F.when(exact, F.col("own") <= F.col("other")).otherwise(F.col("v").bitwiseAND(F.col("bit")) == 0)
    side: Column = F.when(exact & (F.col("own") == F.col("other")), 2).when(zero, 0).otherwise(1)
    b0, b1 = F.when(zero, F.col("own")).otherwise(F.col("other")), F.when(zero, F.col("other")).otherwise(F.col("own"))
    key = F.xxhash64("slot", "bit", F.least("v", "nv"), b0, b1)  # a collision only compares more
    return met.select(key.alias("cell"), side.cast("byte").alias("side"), "fp")


def forest(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest (a, b) of the links between two sets of fingerprints, or inside one."""
    cols = left if right is None else right
    link = np.empty((len(left), len(cols)), bool)
    for a in range(0, len(left), 256):
        link[a:a + 256] = np.bitwise_count(left[a:a + 256, None] ^ cols[None]) <= radius
    if right is None:
        np.fill_diagonal(link, False)
    seen_l = np.zeros(len(left), bool)
    seen_r = seen_l if right is None else np.zeros(len(cols), bool)
    out_a, out_b = [], []
    for root in np.flatnonzero(link.any(1)):
        if seen_l[root]:
            continue
        seen_l[root] = True
        front, rows = np.array([root]), True
        while len(front):
            part, seen = (link[front], seen_r) if rows else (link[:, front].T, seen_l)
            new = np.flatnonzero(part.any(0) & ~seen)
            seen[new] = True
            from_ = front[part[:, new].argmax(0)]
            out_a.append((left if rows else cols)[from_])
            out_b.append((cols if rows else left)[new])
            front, rows = new, rows if right is None else not rows
    empty = np.zeros(0, np.uint64)
    return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (empty, empty)


def verify_cells(cell: np.ndarray, side: np.ndarray, fp: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links of whole cells sorted by (cell, side)."""
    if not len(cell):
        return
    start = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    n = np.diff(np.append(start, len(cell)))
    n0, n2 = (np.add.reduceat((side == s).astype(np.int64), start) for s in (0, 2))
    n1 = n - n0 - n2
    busy = (n0 * n1 > 0) | (n2 > 1)
    for i in np.flatnonzero(busy & (n > SMALL)):
        one, two, three = np.split(fp[start[i]:start[i] + n[i]], [n0[i], n0[i] + n1[i]])
        if len(one) and len(two):
            yield forest(one, two, radius)
        if len(three) > 1:
            yield forest(three, None, radius)
    pick = np.flatnonzero(busy & (n <= SMALL))
    row = ragged(start[pick], n[pick])
    of = np.repeat(pick, n[pick])
    # Side 0 meets all of side 1; a member of side 2 meets those of side 2 after it.
    begin = np.where(side[row] == 0, (start + n0)[of], row + 1)
    length = np.where(side[row] == 0, n1[of], np.where(side[row] == 2, (start + n)[of] - row - 1, 0))
    done = np.cumsum(length)
    cuts = np.searchsorted(done, np.arange(0, (int(done[-1]) if len(done) else 0) + PAIRS, PAIRS))
    for lo, hi in zip(cuts[:-1], np.maximum(cuts[1:], cuts[:-1]), strict=True):
        hi = len(row) if hi >= len(row) else hi
        a, b = np.repeat(row[lo:hi], length[lo:hi]), ragged(begin[lo:hi], length[lo:hi])
        near = np.bitwise_count(fp[a] ^ fp[b]) <= radius
        yield fp[a[near]], fp[b[near]]


def _links(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def links(cols: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
            for a, b in verify_cells(*cols, radius):
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], names=["a", "b"])

        for batch in batches:
            cell, side, fp = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if not len(cell):
                continue
            held.append((cell, side, fp.view(np.uint64)))
            if cell[0] == cell[-1] or sum(len(h[0]) for h in held) < 50_000:
                continue
            cols = tuple(np.concatenate(x) for x in zip(*held, strict=True))
            cut = np.searchsorted(cols[0], cols[0][-1])  # the last cell may go on
            yield from links(tuple(c[:cut] for c in cols))
            held = [tuple(c[cut:] for c in cols)]
        if held:
            yield from links(tuple(np.concatenate(x) for x in zip(*held, strict=True)))

    return run


def near_fingerprints(fps: DataFrame, radius: int = RADIUS, cut: int = CUT, keep: int = KEEP, block: int = BLOCK) -> DataFrame:
    """(a, b): links between distinct fingerprints ``fps(fp)`` that connect all that lie
    within ``radius`` bits of each other, directly or through others."""
    met = cells(fps, radius, cut, keep, block)
    return met.repartition("cell").sortWithinPartitions("cell", "side").mapInArrow(_links(radius), "a long, b long")


def simhash_components(docs: DataFrame, radius: int = RADIUS, gram: int = GRAM, cut: int = CUT, keep: int = KEEP, block: int = BLOCK,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: dk (id), fp (fingerprint) and head (least id of its component)."""
    texts = _texts(docs, id_col, text_col).select("dk", "th", "body")
    signed = written(texts.mapInArrow(_fingerprint_rows(gram), "dk long, fp long"), "fingerprints")
    nodes = written(signed.groupBy("fp").agg(F.min("dk").alias("least")), "nodes")
    links = written(near_fingerprints(nodes.select("fp"), radius, cut, keep, block), "links")
    found = connected_components(links).select(F.col("node").alias("fp"), "component")
    named = nodes.join(found, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    heads = named.groupBy("component").agg(F.min("least").alias("head"))
    named = written(named.join(heads, "component").select("fp", "head"), "heads")
    return signed.join(named, "fp").select("dk", "fp", "head")


def component_rows(docs: DataFrame) -> DataFrame:
    """The query: one row per document with its fingerprint and component."""
    real = lambda c: F.when(F.col(c) != NO_DOC, F.col(c))
    return simhash_components(docs).select(real("dk").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), real("head").alias("component_id"))
