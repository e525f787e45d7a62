"""Operator 4: n-gram Jaccard join by MinHash banding.

Documents are sets of GRAM-word n-grams (a text of fewer words is one n-gram of
all of them).  Equal sets are one node.  Band and row counts follow from the
recall wanted at the threshold; nodes meet on band hashes, each bucket linking
its nodes to its least one only, and connected buckets make candidate groups.
Inside a group every pair is verified on the full n-gram sets, in blocks of nodes
so that no task holds more than two blocks; what leaves a task is a count of
links for each node and a spanning forest of the verified links, never the
pairs.  Classes are the connected components of verified links.

Null and empty texts have no n-gram: each is a class of its own without links.
Rows that repeat a doc_id are documents of their own; equal rows are copies.
A class is named by its least doc_id; null ids come before all others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_steps, connected_components, mix64, written
from .pretokens import piece_keys, utf8_column
from .repeats import NO_DOC, _texts, sequence_hash, words_of

GRAM = 5
THRESHOLD = 0.8
RECALL = 0.9999
MAX_HASHES = 96
#: Nodes of a block of a candidate group.
BLOCK = 2048
_SEEDS = np.random.default_rng(4).integers(0, 1 << 63, (2, 256), dtype=np.uint64)


def bands_and_rows(threshold: float, recall: float, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows for which bands of them reach ``recall`` at
    ``threshold`` with no more than ``max_hashes`` hashes."""
    best = None
    for rows in range(1, max_hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows)) if threshold < 1 else 1
        if bands * rows <= max_hashes:
            best = (max(1, bands), rows)
    if best is None:
        raise ValueError("the recall needs more hashes")
    return best


def gram_sets(data: np.ndarray, offsets: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct n-gram hashes of all texts one after another, their number per text)."""
    start, end, counts = words_of(data, offsets)
    words, _ = piece_keys(data, start, end - start)
    first = np.cumsum(counts) - counts
    text = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(words))
    full = at + gram <= (first + counts)[text]
    grams = np.zeros(len(words), np.uint64)
    hashes = sequence_hash(words, gram)
    grams[:len(hashes)] = hashes
    short = np.flatnonzero((counts > 0) & (counts < gram))
    for i in short:
        whole = words[first[i]:first[i] + counts[i]]
        grams[first[i]] = sequence_hash(whole, len(whole), 1)[0]
        full[first[i]] = True
    text, grams = text[full], grams[full]
    order = np.lexsort((grams, text))
    text, grams = text[order], grams[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])
    return grams[new], np.bincount(text[new], minlength=len(counts))


def _signatures(gram: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in arrow_steps(batches, "body"):
            grams, sizes = gram_sets(*utf8_column(piece.column(2)), gram)
            some = np.flatnonzero(sizes)
            begin = (np.cumsum(sizes) - sizes)[some]
            keys = [np.zeros(len(sizes), np.uint64) for _ in range(2)]
            band = np.zeros((len(sizes), bands), np.uint64)
            if len(some):
                for i, k in enumerate(keys):
                    k[some] = np.add.reduceat(mix64(grams ^ _SEEDS[1, 250 + i]), begin)
                for b in range(bands):
                    got = np.zeros(len(some), np.uint64)
                    for r in range(rows):
                        j = b * rows + r
                        low = np.minimum.reduceat(grams * (_SEEDS[0, j] * np.uint64(2) + np.uint64(1)) + _SEEDS[1, j], begin)
                        got = mix64(got ^ low) * np.uint64(0x9E3779B97F4A7C15)
                    band[some, b] = got
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, band.size + 1, bands, dtype=np.int32)), pa.array(band.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(keys[0].view(np.int64)), pa.array(keys[1].view(np.int64)), pa.array(sizes), lists], names=["dk", "th", "k1", "k2", "size", "bands"])

    return run


def verify_block(left: tuple, right: tuple | None, threshold: float) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Linked documents of each node of two blocks, linked nodes, and a spanning forest.

    A block is (weights, n-gram hashes one after another, sizes); without a
    right block the pairs are those inside the left one.
    """
    blocks = [left] if right is None else [left, right]
    size = np.concatenate([b[2] for b in blocks])
    weight = np.concatenate([b[0] for b in blocks]).astype(np.float64)
    grams = np.concatenate([b[1] for b in blocks])
    node = np.repeat(np.arange(len(size)), size)
    _, code, df = np.unique(grams, return_inverse=True, return_counts=True)
    shared = df[code] > 1  # an n-gram of one node is in no intersection
    node, code = node[shared], code[shared]
    _, code = np.unique(code, return_inverse=True)
    order = np.argsort(code, kind="stable")
    node, code = node[order], code[order]
    n, split = len(size), len(left[2])
    rows = slice(0, n) if right is None else slice(0, split)
    cols = slice(0, n) if right is None else slice(split, n)
    common = np.zeros((rows.stop - rows.start, cols.stop - cols.start), np.float32)
    width = 1024
    total = int(code[-1]) + 1 if len(code) else 0
    for a in range(0, total, width):
        lo, hi = np.searchsorted(code, (a, a + width))
        m = np.zeros((n, width), np.float32)
        m[node[lo:hi], code[lo:hi] - a] = 1
        common += m[rows] @ m[cols].T
    need = threshold / (1 + threshold) * (size[rows][:, None] + size[cols][None]) - 1e-6
    link = common >= need
    if right is None:
        np.fill_diagonal(link, False)
    docs, nodes = np.zeros(n), np.zeros(n, np.int64)
    docs[rows] += link @ weight[cols]
    nodes[rows] += link.sum(1)
    if right is not None:
        docs[cols] += link.T @ weight[rows]
        nodes[cols] += link.sum(0)
    # Spanning forest, breadth first over the matrix of links.
    forest, seen = [], np.zeros(n, bool)
    r0, c0 = rows.start, cols.start
    for root in range(rows.start, rows.stop):
        if seen[root]:
            continue
        seen[root] = True
        queue = [root]
        while queue:
            x = queue.pop()
            near = np.zeros(n, bool)
            if rows.start <= x < rows.stop:
                near[cols] |= link[x - r0]
            if cols.start <= x < cols.stop:
                near[rows] |= link[:, x - c0]
            new = np.flatnonzero(near & ~seen)
            seen[new] = True
            forest += [(x, int(y)) for y in new]
            queue += new.tolist()
    return docs.astype(np.int64), nodes, forest


def _verify(gram: int, threshold: float):
    """Reads rows sorted by (group, i, j): the nodes of one pair of blocks of one group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for b in batches:
                yield from zip(*(c.to_pylist() for c in b.columns), strict=True)

        out: list[tuple] = []
        for (_, i, j), members in groupby(rows(), key=lambda r: r[:3]):
            sides: dict[int, dict[int, tuple]] = {}
            for _, _, _, block, node, weight, body in members:
                sides.setdefault(block, {})[node] = (weight, body)  # equal rows once
            sets, ids = [], []
            for block in sorted(sides):
                data, offsets = utf8_column(pa.array([x[1] for x in sides[block].values()], pa.string()))
                grams, sizes = gram_sets(data, offsets, gram)
                sets.append((np.array([x[0] for x in sides[block].values()]), grams, sizes))
                ids += sides[block]
            if i != j and len(sets) < 2:
                continue
            docs, nodes, forest = verify_block(sets[0], sets[1] if i != j else None, threshold)
            out += [(ids[x], ids[x], int(docs[x]), int(nodes[x])) for x in np.flatnonzero(nodes)]
            out += [(ids[x], ids[y], 0, 0) for x, y in forest]
            if len(out) > 50_000:
                yield batch(out)
                out = []
        if out:
            yield batch(out)

    def batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], names=["a", "b", "docs", "nodes"])

    return run


def similarity_classes(docs: DataFrame, threshold: float = THRESHOLD, gram: int = GRAM, recall: float = RECALL, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: dk, th (its id and text hash), n_links (other documents at the
    threshold, copies included), n_text_links (other n-gram sets), and its class by the
    least member (class_dk, class_th)."""
    bands, rows = bands_and_rows(threshold, recall)
    texts = _texts(docs, id_col, text_col)
    signed = written(texts.mapInArrow(_signatures(gram, bands, rows), "dk long, th long, k1 long, k2 long, size long, bands array<long>"), "signed")
    sets = signed.where("size > 0").groupBy("k1", "k2").agg(F.min(F.struct("dk", "th")).alias("lead"), F.count("*").alias("n"), F.first("bands").alias("bands"))
    sets = written(sets.withColumn("node", F.monotonically_increasing_id()), "sets")
    buckets = sets.select("node", F.posexplode("bands").alias("band", "hash"))
    least = buckets.groupBy("band", "hash").agg(F.min("node").alias("m"), F.count("*").alias("n")).where("n > 1").drop("n")
    edges = buckets.join(least, ["band", "hash"]).where("node <> m").select(F.col("node").alias("a"), F.col("m").alias("b")).distinct()
    groups = written(connected_components(edges).select("node", F.col("component").alias("comp")), "groups")
    sizes = groups.groupBy("comp").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    members = groups.join(sizes, "comp").join(sets.select("node", "n", "lead.dk", "lead.th"), "node")
    members = members.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = members.join(texts, ["dk", "th"]).select("comp", "block", "node", "n", "body", other)
    pairs = pairs.select("comp", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "n", "body")
    checked = pairs.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j", "block", "node").mapInArrow(_verify(gram, threshold), "a long, b long, docs long, nodes long")
    checked = written(checked, "links")
    classes = connected_components(checked.where("a <> b").select("a", "b"))
    links = checked.where("a = b").groupBy(F.col("a").alias("node")).agg(F.sum("docs").alias("docs"), F.sum("nodes").alias("nodes"))
    named = sets.select("node", "k1", "k2", "n", "lead").join(classes, "node", "left").join(links, "node", "left")
    named = named.withColumn("class", F.coalesce("component", "node"))
    heads = named.groupBy("class").agg(F.min("lead").alias("head"))
    named = named.join(heads, "class").select("k1", "k2", F.col("n").alias("copies"), "docs", "nodes", "head")
    lone = F.struct("dk", "th")
    some = signed.where("size > 0").select("dk", "th", "k1", "k2").join(named, ["k1", "k2"]).select(
        "dk", "th", (F.col("copies") - 1 + F.coalesce("docs", F.lit(0))).alias("n_links"), F.coalesce("nodes", F.lit(0)).alias("n_text_links"), "head")
    none = signed.where("size = 0").select("dk", "th", F.lit(0).cast("long").alias("n_links"), F.lit(0).cast("long").alias("n_text_links"), lone.alias("head"))
    return some.unionAll(none).select("dk", "th", "n_links", "n_text_links", F.col("head.dk").alias("class_dk"), F.col("head.th").alias("class_th"))


def class_rows(docs: DataFrame) -> DataFrame:
    """The query: one row per document with its class and its number of links."""
    real = lambda c: F.when(F.col(c) != NO_DOC, F.col(c))
    return similarity_classes(docs).select(real("dk").alias("doc_id"), real("class_dk").alias("class_id"), "n_links", "n_text_links")


ORACLE_SQL = """
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), grams AS (
    SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS g FROM words
), sets AS (
    SELECT g, md5(array_to_string(g, chr(10))) AS node, len(g) AS size, count(*) AS copies, min(doc_id) AS head FROM grams WHERE len(g) > 0 GROUP BY g
), rows AS (
    SELECT node, unnest(g) AS gram FROM sets
), pairs AS (
    SELECT a.node AS a, b.node AS b, count(*) AS common FROM rows a JOIN rows b ON a.gram = b.gram AND a.node <> b.node GROUP BY a.node, b.node
), links AS (
    SELECT a, b, y.copies FROM pairs JOIN sets x ON x.node = a JOIN sets y ON y.node = b WHERE common * 10 >= 8 * (x.size + y.size - common)
), reach(a, b) AS (
    SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), classes AS (
    SELECT s.node, min(least(s.head, coalesce(t.head, s.head))) AS class_id FROM sets s LEFT JOIN reach r ON r.a = s.node LEFT JOIN sets t ON t.node = r.b GROUP BY s.node
), counts AS (
    SELECT a AS node, sum(copies) AS docs, count(*) AS nodes FROM links GROUP BY a
)
SELECT d.doc_id, coalesce(c.class_id, d.doc_id) AS class_id,
    CAST(CASE WHEN s.node IS NULL THEN 0 ELSE s.copies - 1 + coalesce(n.docs, 0) END AS BIGINT) AS n_links, CAST(coalesce(n.nodes, 0) AS BIGINT) AS n_text_links
FROM grams d LEFT JOIN sets s ON s.g = d.g LEFT JOIN classes c ON c.node = s.node LEFT JOIN counts n ON n.node = s.node
"""
