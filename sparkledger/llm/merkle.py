"""Operator 13: Merkle manifest of a dataset, its blocks in van Emde Boas order.

Every row is a leaf: the SHA-256 of its fields, each with its length.  The leaves of a source, in
the order of their ids, are hashed upwards in runs of 16 until one node remains, the
source's subroot; the subroots, in the order of their sources, likewise give the root.

1. Leaves are numbered per source by range partitions and per-task offsets, so a
   source that holds a third of all rows is spread over many tasks.
2. 16 ** HEIGHT consecutive leaves form an aligned block, a subtree of its own.  Its nodes are stored
   in van Emde Boas order: the levels are split in half, the top half is stored first, the
   subtrees below it follow one by one, each laid out alike.  ``address`` finds any node by arithmetic
   alone (also where the last run is short), for building as for reading siblings.
3. Block roots are the leaves of the next tier, and so on until a source has one block;
   the tree over the subroots is built by the same steps.  A tier is a Parquet table
   with a row for each block: the manifest.
4. Proofs go down the tiers: a block gets the siblings above it once, whatever
   the number of its leaves, and its leaves take the rest from the block itself.

Null fields read as absent (``-``), which differs from empty ones.  Null sources are a source of their
own before all others; null ids come first in theirs.  Rows that repeat an id are leaves of
their own, in the order of their hashes.  An empty table has no rows and no root.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkledger.operators.ranking import sequence_within, with_row_index

from .common import written

FAN = 16
#: Height of a block: it has up to FAN ** HEIGHT leaves.
HEIGHT = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows of an Arrow batch of blocks (a full block is some 300 KB).
BLOCK_BATCH = 50

_HEX = np.frombuffer("".join(f"{b:02x}" for b in range(256)).encode(), np.uint16)


def hexed(raw: np.ndarray) -> np.ndarray:
    """Lower-case hex text of byte rows, as byte rows twice as wide."""
    return _HEX[raw].view(np.uint8)


def tree_size(leaves, levels: int):
    """Nodes of a tree of ``levels`` levels over ``leaves`` leaves (numbers or arrays)."""
    return sum(-(-leaves // FAN ** k) for k in range(levels))


def levels_over(leaves: int) -> int:
    """Levels from the leaves to the single node that remains."""
    out = 1
    while leaves > 1:
        leaves, out = -(-leaves // FAN), out + 1
    return out


def address(leaves, levels: int, level: int, index):
    """Place of node ``index`` of ``level`` (0: leaves) in van Emde Boas order.

    The tree has one node in its highest level.  Only the last subtree of a level
    can be short, so all before it are full and their sizes follow from their height.
    """
    if levels == 1:
        return index * 0
    top = levels // 2
    low = levels - top  # levels of each subtree below the cut
    above = -(-leaves // FAN ** low)
    if level >= low:
        return address(above, top, level - low, index)
    span = FAN ** (low - 1)
    nth = index // FAN ** (low - 1 - level)
    own = np.minimum(span, leaves - nth * span)
    return tree_size(above, top) + nth * tree_size(span, low) + address(own, low, level, index - nth * FAN ** (low - 1 - level))


@lru_cache(maxsize=64)
def layout(leaves: int, levels: int) -> tuple[np.ndarray, ...]:
    """Addresses of all nodes, level by level."""
    return tuple(np.asarray(address(leaves, levels, k, np.arange(-(-leaves // FAN ** k)))) for k in range(levels))


def build_block(leaves: np.ndarray, levels: int) -> np.ndarray:
    """Digests (rows of 32 bytes) of all nodes over ``leaves``, in van Emde Boas order."""
    at = layout(len(leaves), levels)
    tree = np.empty((tree_size(len(leaves), levels), 32), np.uint8)
    tree[at[0]] = leaves
    for below, here in zip(at[:-1], at[1:], strict=True):
        text = hexed(tree[below])
        made = b"".join(sha256(text[i:i + FAN].tobytes()).digest() for i in range(0, len(below), FAN))
        tree[here] = np.frombuffer(made, np.uint8).reshape(-1, 32)
    return tree


class Block:
    """A stored block: siblings of its nodes by address."""

    def __init__(self, leaves: int, levels: int, nodes: bytes):
        self.n, self.levels = leaves, levels
        self.at = layout(leaves, levels)
        self.raw = np.frombuffer(nodes, np.uint8).reshape(-1, 32)
        self.text = hexed(self.raw)

    def run(self, level: int, index: int) -> tuple[np.ndarray, int]:
        """(addresses of the run that holds a node, the node's place in it)."""
        first = index // FAN * FAN
        return self.at[level][first:first + FAN], index - first

    def path(self, index: int, start: int = 0) -> list[tuple[np.ndarray, int]]:
        """Runs from the leaf's ancestor in level ``start`` up to below the block's root."""
        return [self.run(k, index // FAN ** k) for k in range(start, self.levels - 1)]


def pack(levels: list[tuple[bytes, bytes]]) -> bytes:
    """Siblings (to the left, to the right; digests) of each level, as bytes."""
    return b"".join(bytes([len(a) // 32, len(b) // 32]) + a + b for a, b in levels)


def unpack(path: bytes) -> list[tuple[bytes, bytes]]:
    out, i = [], 0
    while i < len(path):
        a, b = path[i] * 32, path[i + 1] * 32
        out.append((path[i + 2:i + 2 + a], path[i + 2 + a:i + 2 + a + b]))
        i += 2 + a + b
    return out


def fold(leaf: bytes, levels: list[tuple[bytes, bytes]]) -> bytes:
    """Root digest from a leaf's hex and its siblings' hex, level by level."""
    for a, b in levels:
        leaf = sha256(a + leaf + b).hexdigest().encode()
    return leaf


def _field(name: str, text: Column | None = None) -> Column:
    value = F.col(name).cast("string") if text is None else text
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_rows(docs: DataFrame) -> DataFrame:
    """(g, id, leaf, altered): source (null as empty, others behind an s), id, digest of the row, and
    the digest of the tampered row where it is to be tampered with."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    digest = lambda text: F.unhex(F.sha2(F.concat(*[_field(c) for c in FIELDS[:-1]], text), 256))
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return docs.select(
        F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("")).alias("g"), F.col("doc_id").alias("id"), digest(_field("text")).alias("leaf"),
        F.when(tampered, digest(_field("text", F.translate(F.col("text"), upper, lower)))).alias("altered"))


_BLOCK = "g string, block long, n int, levels int, nodes binary, root binary, ids array<long>, altered array<binary>"


def _build(height: int):
    size = FAN ** height

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def close(rows: pa.Table) -> None:
            n, block = rows.num_rows, rows["pos"][0].as_py() // size
            # A first block that is not full is the whole of its group.
            levels = levels_over(n) if block == 0 else height + 1
            leaves = np.frombuffer(b"".join(rows["leaf"].to_pylist()), np.uint8).reshape(-1, 32)
            tree = build_block(leaves, levels)
            out.append((rows["g"][0].as_py(), block, n, levels, tree.tobytes(), tree[layout(n, levels)[-1][0]].tobytes(), rows["id"].to_pylist(), rows["altered"].to_pylist()))

        held: list[pa.RecordBatch] = []
        for batch in batches:
            # Positions are dense: a block starts at every multiple of its size.
            cuts = np.flatnonzero(batch.column(1).to_numpy() % size == 0).tolist()
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if a in cuts and held:
                    close(pa.Table.from_batches(held))
                    held = []
                if b > a:
                    held.append(batch.slice(a, b - a))
                if len(out) >= BLOCK_BATCH:
                    yield _rows(out)
                    out.clear()
        if held:
            close(pa.Table.from_batches(held))
        if out:
            yield _rows(out)

    return run


def _rows(out: list[tuple]) -> pa.RecordBatch:
    schema = pa.schema([("g", pa.string()), ("block", pa.int64()), ("n", pa.int32()), ("levels", pa.int32()), ("nodes", pa.binary()), ("root", pa.binary()),
                        ("ids", pa.list_(pa.int64())), ("altered", pa.list_(pa.binary()))])
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def tiers(leaves: DataFrame, height: int = HEIGHT) -> list[DataFrame]:
    """Block tables over ``leaves(g, pos, leaf, id, altered)``, from the leaves up; ``pos`` counts from 0 in each g."""
    size = FAN ** height
    out = []
    while True:
        dealt = leaves.select("g", "pos", "leaf", "id", "altered").withColumn("block", F.expr(f"pos div {size}"))
        dealt = dealt.repartition("g", "block").sortWithinPartitions("g", "pos").drop("block")
        blocks = written(dealt.mapInArrow(_build(height), _BLOCK), "blocks")
        out.append(blocks)
        more = blocks.where("block > 0").select("g").distinct()
        if not more.limit(1).count():
            return out
        none = F.lit(None)
        leaves = blocks.select("g", F.col("block").alias("pos"), F.col("root").alias("leaf"), none.cast("long").alias("id"), none.cast("binary").alias("altered")).join(more, "g", "left_semi")


def _whole(blocks: DataFrame) -> DataFrame:
    """(g, root) of the groups that end in this tier."""
    return blocks.where("block = 0").select("g", "root").join(blocks.where("block > 0").select("g").distinct(), "g", "left_anti")


@dataclass
class Manifest:
    """Block tables of the sources and of the tree over their subroots, from the leaves up."""

    sources: list[DataFrame]
    top: list[DataFrame]
    subroots: DataFrame  # g, pos, subroot

    def root(self) -> str | None:
        """The dataset's root in hex; None where it has no rows."""
        row = self.top[-1].where("block = 0").select(F.lower(F.hex("root"))).first()
        return row[0] if row else None


def manifest(docs: DataFrame, height: int = HEIGHT) -> Manifest:
    leaves = written(leaf_rows(docs), "leaves")
    placed = sequence_within(leaves, "g", [("id", "asc"), ("leaf", "asc")], name="pos").withColumn("pos", F.col("pos") - 1)
    sources = tiers(placed, height)
    ends = [_whole(t) for t in sources]
    subroots = ends[0]
    for e in ends[1:]:
        subroots = subroots.unionAll(e)
    subroots = written(with_row_index(subroots.withColumnRenamed("root", "subroot"), [("g", "asc")], name="pos"), "subroots")
    none = F.lit(None)
    top = tiers(subroots.select(F.lit("").alias("g"), "pos", F.col("subroot").alias("leaf"), none.cast("long").alias("id"), none.cast("binary").alias("altered")), height)
    return Manifest(sources, top, subroots)


_PATH = "g string, pos long, path binary, subroot binary, root binary"


def _descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The siblings above each leaf of a block: those in the block and those above it."""
    for batch in batches:
        for i in range(0, batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            block = Block(row["n"], row["levels"], row["nodes"])
            out = []
            for leaf in range(block.n):
                own = [(block.raw[at[:k]].tobytes(), block.raw[at[k + 1:]].tobytes()) for at, k in block.path(leaf)]
                out.append(pack(own) + row["path"])
            start = row["block"] * row["size"]
            same = lambda v, n=block.n: pa.array([v] * n)
            yield pa.RecordBatch.from_arrays([same(row["g"]), pa.array(np.arange(start, start + block.n)), pa.array(out, pa.binary()), pa.array([row["subroot"]] * block.n, pa.binary()),
                                              pa.array([row["root"]] * block.n, pa.binary())], names=["g", "pos", "path", "subroot", "root"])


_PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _PROOF.split(", ")]
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            block = Block(row["n"], row["levels"], row["nodes"])
            above = [(a.hex().encode(), b.hex().encode()) for a, b in unpack(row["path"])]
            root, subroot = row["root"].hex(), row["subroot"].hex()
            out = []
            for first in range(0, block.n, FAN):
                # What the leaves of one run share.
                text = [(block.text[at[:k]].tobytes(), block.text[at[k + 1:]].tobytes()) for at, k in block.path(first, 1)] + above
                rest = b"".join(a + b for a, b in text)
                at = block.at[0][first:first + FAN]
                hexes = [block.text[a].tobytes() for a in at]
                for k, (leaf, doc, altered) in enumerate(zip(hexes, row["ids"][first:first + FAN], row["altered"][first:first + FAN], strict=True)):
                    a, b = b"".join(hexes[:k]), b"".join(hexes[k + 1:])
                    levels = text if block.levels == 1 else [(a, b), *text]
                    folded = fold(leaf if altered is None else altered.hex().encode(), levels).decode()
                    out.append((doc, leaf.decode(), subroot, root, sha256(a + b + rest).hexdigest(), folded, folded == root))
            types = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)


def _down(levels: list[DataFrame], entry: DataFrame, height: int, last) -> DataFrame:
    """From (g, path, subroot, root) of every group to what ``last`` makes of its lowest blocks."""
    paths = None
    for depth in range(len(levels) - 1, -1, -1):
        blocks = levels[depth]
        here = _whole(blocks).select("g").join(entry, "g").withColumn("block", F.lit(0).cast("long"))
        paths = here if paths is None else here.unionByName(paths.withColumnRenamed("pos", "block"))
        met = blocks.drop("root").join(paths, ["g", "block"])
        if depth == 0:
            return last(met)
        paths = written(_paths(met, height), "paths")
    raise ValueError("no tier")


def _paths(met: DataFrame, height: int) -> DataFrame:
    return met.drop("ids", "altered").withColumn("size", F.lit(FAN ** height).cast("long")).mapInArrow(_descend, _PATH)


def proofs(of: Manifest, height: int = HEIGHT) -> DataFrame:
    """Per row of the dataset: its leaf, subroot and root, the digest of its siblings, the root
    that its (where so marked, tampered) leaf folds to, and whether that is the root."""
    empty = F.lit(b"")
    start = of.top[-1].where("block = 0").select("g", empty.alias("path"), F.lit(None).cast("binary").alias("subroot"), "root")
    tops = written(_down(of.top, start, height, lambda met: _paths(met, height)), "paths").select("pos", "path", "root")
    entry = of.subroots.join(tops, "pos").select("g", "path", "subroot", "root")
    return _down(of.sources, entry, height, lambda met: met.mapInArrow(_prove, _PROOF))


def merkle_rows(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The query: one row per document, proved against the manifest."""
    return proofs(manifest(docs, height), height)
