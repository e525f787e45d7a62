"""Operator 8: approximate nearest neighbours by an inverted multi-index.

Vectors are cut in two halves, each half is quantised by its own codebook, and
an entry lies in the cell of its pair of centroids.  A query walks the cells in
the order of summed half distances, drawn from a heap, until the cells drawn
hold the wanted number of entries, and those entries are reranked by the exact
inner product on the original vectors in double precision.

For the inner product, vectors of unequal norm get one component more so that
all have the largest norm; nearest by distance then is largest by product.

The codebooks are trained on a bounded sample (at most TRAIN_ROWS rows,
spread by the hash of their id); every entry is indexed.  The counts of the cells, bounded by
the square of the codebook, go to the tasks that walk them.  Entries and queries
meet by a shuffle on the first half's centroid, a query bringing the set of its cells
there; centroids with many entries are dealt in slices to several tasks.

Vectors that are null, zero, of another length than the most frequent one, or hold null or
non-finite components take no part.  Rows that repeat a vec_id and its vector count once everywhere; other
rows of a vec_id are candidates and queries of their own for scoring, but a query returns each vec_id once, by its best score.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import spread_sample, written

TRAIN_ROWS = 20_000
#: Centroids of a half.
CENTROIDS = 128
#: Entries that a query draws at least: a share of all, and a number.  On vectors without any
#: structure 0.4 finds about 0.95 of the true neighbours.
PROBE_SHARE, PROBE_LEAST = 0.45, 2000
#: Entries below one centroid of the first half that go to one task.
SLICE = 4096
NEIGHBOURS = 20


def kmeans(x: np.ndarray, k: int, rounds: int = 15, seed: int = 8) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        near = nearest(x, centres)
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        n = np.bincount(near, minlength=len(centres))
        centres = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres)
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (-2 * x @ centres.T + (centres * centres).sum(1)).argmin(1)


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec array<double>, norm): vectors that take part."""
    vec = F.transform(F.col(vec_col), lambda v: v.cast("double"))
    ok = F.col("vec").isNotNull() & (F.size("vec") > 0) & F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, v: a + v * v))
    out = df.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec")).where(F.col("id").isNotNull()).where(ok)
    return out.withColumn("norm", norm).where("norm > 0 and norm < double('infinity')")


class Codebooks:
    """Two codebooks over the halves of a vector lifted to the norm ``top``."""

    def __init__(self, sample: np.ndarray, top: float, centroids: int):
        self.dim, self.top = sample.shape[1], top
        self.cut = (self.dim + 1) // 2
        lifted = self.lift(sample)
        k = max(1, min(centroids, len(sample)))
        self.halves = [kmeans(lifted[:, :self.cut], k), kmeans(lifted[:, self.cut:], k, seed=9)]

    def lift(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0.0, self.top ** 2 - (x * x).sum(1)))
        return np.concatenate([x, rest[:, None]], 1)

    def cells(self, x: np.ndarray) -> np.ndarray:
        y = self.lift(x)
        return nearest(y[:, :self.cut], self.halves[0]) * len(self.halves[1]) + nearest(y[:, self.cut:], self.halves[1])

    def walk(self, q: np.ndarray, counts: np.ndarray, wanted: int) -> list[int]:
        """Cells with entries, by summed distance of the halves, until they hold ``wanted``."""
        q = np.append(q * (self.top / np.linalg.norm(q)), 0.0)
        d = [((c - h) ** 2).sum(1) for c, h in zip(self.halves, (q[:self.cut], q[self.cut:]), strict=True)]
        order = [np.argsort(x, kind="stable") for x in d]
        d = [x[o] for x, o in zip(d, order, strict=True)]
        heap, seen, out, got = [(d[0][0] + d[1][0], 0, 0)], {(0, 0)}, [], 0
        while heap and got < wanted:
            _, i, j = heapq.heappop(heap)
            cell = int(order[0][i]) * len(d[1]) + int(order[1][j])
            if counts[cell]:
                out.append(cell)
                got += int(counts[cell])
            for a, b in ((i + 1, j), (i, j + 1)):
                if a < len(d[0]) and b < len(d[1]) and (a, b) not in seen:
                    seen.add((a, b))
                    heapq.heappush(heap, (d[0][a] + d[1][b], a, b))
        return out


def search(vectors: DataFrame, queries: DataFrame, neighbours: int = NEIGHBOURS, id_col: str = "vec_id", vec_col: str = "embedding", share: float = PROBE_SHARE, least: int = PROBE_LEAST) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found of each row of ``queries``, itself left out."""
    spark = vectors.sparkSession
    # Copies of a row would fill cells and places: they count once, from the facts on.
    entries = written(usable(vectors, id_col, vec_col).select("id", "vec").distinct(), "vectors")
    entries = entries.withColumn("norm", F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, v: a + v * v)))
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    facts = entries.groupBy(F.size("vec").alias("dim")).agg(F.count("*").alias("n"), F.max("norm").alias("top")).orderBy(F.desc("n"), "dim").limit(1).collect()
    if not facts:
        return empty
    dim, n, top = facts[0].dim, facts[0].n, facts[0].top
    entries = entries.where(F.size("vec") == dim)
    sample = spread_sample(entries.select("id", "vec"), F.struct("id", "vec"), TRAIN_ROWS).orderBy("id", "vec").toPandas()
    books = Codebooks(np.array(sample["vec"].tolist(), np.float64), top, CENTROIDS)
    second = len(books.halves[1])
    shared = spark.sparkContext.broadcast(books)
    wanted = max(least, neighbours + 1, int(share * n))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = np.asarray(b.column(1).flatten()).reshape(b.num_rows, dim)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(shared.value.cells(x).astype(np.int32))], names=["id", "vec", "cell"])

    listed = written(entries.select("id", "vec").mapInArrow(assign, "id long, vec array<double>, cell int"), "cells")
    counts = np.zeros(len(books.halves[0]) * len(books.halves[1]), np.int64)
    for r in listed.groupBy("cell").agg(F.count("*").alias("n")).collect():  # at most the squared codebook
        counts[r.cell] = r.n
    tally = spark.sparkContext.broadcast(counts)

    slices = np.maximum(1, -(-counts.reshape(-1, second).sum(1) // SLICE))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, slots, vecs, sets = [], [], [], []
            for q, vec in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                drawn = np.zeros(len(tally.value), bool)
                drawn[shared.value.walk(np.array(vec), tally.value, wanted)] = True
                drawn = drawn.reshape(-1, second)
                for first in np.flatnonzero(drawn.any(1)).tolist():
                    for part in range(int(slices[first])):
                        ids.append(q)
                        slots.append(first << 32 | part)
                        vecs.append(vec)
                        sets.append(np.packbits(drawn[first]).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int64()), pa.array([True] * len(ids)), pa.array(ids, pa.int64()), pa.array(vecs, pa.list_(pa.float64())), pa.nulls(len(ids), pa.int32()), pa.array(sets, pa.binary())], names=["slot", "asks", "id", "vec", "cell", "cells"])

    asking = usable(queries, id_col, vec_col).where(F.size("vec") == dim).select("id", "vec").distinct()
    # A walk costs far more than its row: every task takes a share, also where the queries are few bytes.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    # By another hash than that of ``distinct``, whose few small partitions would be kept otherwise.
    asking = asking.repartition(tasks, F.xxhash64("id", "vec"))
    asked = asking.mapInArrow(walk, "slot long, asks boolean, id long, vec array<double>, cell int, cells binary")
    parts = F.element_at(F.array(*(F.lit(int(x)) for x in slices)), (F.col("cell") / second).cast("int") + 1)
    held = listed.select(
        F.shiftleft((F.col("cell") / second).cast("int").cast("long"), 32).bitwiseOR(F.pmod(F.xxhash64("id", "vec"), parts).cast("long")).alias("slot"),
        F.lit(False).alias("asks"), "id", "vec", (F.col("cell") % second).alias("cell"), F.lit(None).cast("binary").alias("cells"))

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by slot, entries first: each query's best of a slot."""

        def best(entry_ids: list[int], entry_vecs: list[np.ndarray], cells: list[int], asks: list[tuple[int, np.ndarray, bytes]]) -> Iterator[pa.RecordBatch]:
            if not entry_ids or not asks:
                return
            ids, x = np.array(entry_ids), np.concatenate(entry_vecs).reshape(-1, dim)
            cell = np.array(cells)
            for a in range(0, len(asks), 1024):
                some = asks[a:a + 1024]
                score = np.stack([q for _, q, _ in some]) @ x.T
                drawn = np.unpackbits(np.frombuffer(b"".join(c for _, _, c in some), np.uint8).reshape(len(some), -1), axis=1)
                score[drawn[:, cell] == 0] = -np.inf
                score[np.array([i for i, _, _ in some])[:, None] == ids[None]] = -np.inf
                first = min(neighbours + 8, len(ids))
                top = np.argpartition(-score, first - 1, axis=1)[:, :first]
                out = [], [], []
                for row, ((q, v, _), at) in enumerate(zip(some, top, strict=True)):
                    keep = first
                    while True:
                        # All entries that tie with the last one kept, so that smaller ids win.
                        floor = score[row, at].min()
                        at = np.flatnonzero(score[row] >= floor) if np.isfinite(floor) else np.flatnonzero(np.isfinite(score[row]))
                        at = at[np.isfinite(score[row, at])]
                        # An id may have many vectors: more are kept until there are enough ids, or no more entries.
                        if not np.isfinite(floor) or keep == len(ids) or len(set(ids[at].tolist())) >= neighbours:
                            break
                        keep = min(4 * keep, len(ids))
                        at = np.argpartition(-score[row], keep - 1)[:keep]
                    # The same sum for the same vectors, whatever the block.
                    exact = (x[at] * v).sum(1)
                    order = np.lexsort((ids[at], -exact))
                    seen: set[int] = set()
                    for i in order:
                        if len(seen) == neighbours:
                            break
                        if (e := int(ids[at[i]])) not in seen:
                            seen.add(e)
                            out[0].append(q)
                            out[1].append(e)
                            out[2].append(float(exact[i]))
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], names=["query_id", "vec_id", "score"])

        slot, ids, vecs, cells, asks = None, [], [], [], []
        for b in batches:
            flat = np.asarray(b.column(3).flatten()).reshape(-1, dim)
            for s, asking, i, v, cell, drawn in zip(*(b.column(k).to_pylist() for k in range(3)), flat, b.column(4).to_pylist(), b.column(5).to_pylist(), strict=True):
                if s != slot:
                    yield from best(ids, vecs, cells, asks)
                    slot, ids, vecs, cells, asks = s, [], [], [], []
                if asking:
                    asks.append((i, v, drawn))
                    if len(asks) == 8192:
                        yield from best(ids, vecs, cells, asks)
                        asks = []
                else:
                    ids.append(i)
                    vecs.append(v)
                    cells.append(cell)
        yield from best(ids, vecs, cells, asks)

    met = held.unionAll(asked).repartition("slot").sortWithinPartitions("slot", "asks")
    found = met.mapInArrow(rerank, "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", rank.cast("int").alias("rank"), "vec_id", "score").where(F.col("rank") <= neighbours)


def every_twentieth(vectors: DataFrame) -> DataFrame:
    """The query: rows whose vec_id is divisible by 20, against all."""
    return search(vectors, vectors.where("vec_id % 20 = 0"))
