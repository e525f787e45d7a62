"""Helpers shared by the training-data operators.

Every operator takes the names of the columns it reads and returns only its own
columns: extra columns of the input, whatever they are called, are never read
and cannot clash with what an operator adds.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkledger.session import ensure_checkpoint_dir

#: Characters of text that one vectorised step inside a task handles at a time;
#: a single longer text is a step of its own.
STEP_CHARS = 500_000


@lru_cache(maxsize=4)
def _shipped(app_id: str) -> None:
    """Send this package to the executors of a session, as --py-files would."""
    root = Path(__file__).resolve().parents[2]
    archive = Path(tempfile.mkdtemp(prefix="package-")) / "training_data_package.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted((root / "sparkledger").rglob("*.py")):
            z.write(path, path.relative_to(root))
    SparkSession.active().sparkContext.addPyFile(str(archive))


#: Rows of an Arrow batch: texts may be long, and a task holds a batch several times over.
BATCH_ROWS = 1000


def ship_package(spark: SparkSession) -> None:
    _shipped(spark.sparkContext.applicationId)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and lets two
    branches of a later plan read the same rows without computing them twice.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_steps(batches: Iterator[pa.RecordBatch], text: str, step_chars: int = STEP_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into pieces of about ``step_chars`` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.names.index(text))
        sizes = np.asarray(pc.binary_length(col).fill_null(0).cast(pa.int64()))
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // step_chars, prepend=0)).tolist()
        edges = sorted({0, *cuts, batch.num_rows})
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            yield batch.slice(a, b - a)


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, text: str) -> DataFrame:
    """``mapInArrow`` over pieces of bounded text size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in arrow_steps(batches, text):
            yield fn(piece)

    return df.mapInArrow(run, schema)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of every (start, length) range, in order."""
    lengths = lengths.astype(np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.repeat(starts.astype(np.int64) - (ends - lengths), lengths) + np.arange(total)


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser, element-wise on uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spread_sample(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """At most ``rows`` rows, one for each slot of a hash of ``key`` (that of the least hash):
    a uniform sample that is reduced inside every task, so neither the driver nor one task
    gathers more than the sample."""
    hashed = df.select(F.pmod(F.xxhash64(key), F.lit(rows)).alias("__slot"), F.struct(F.xxhash64(key, F.lit(1)).alias("__order"), *df.columns).alias("__row"))
    picked = hashed.groupBy("__slot").agg(F.min("__row").alias("__row"))
    return picked.select(*[F.col("__row")[c].alias(c) for c in df.columns])


class HashIndex:
    """Open-addressing map from uint64 keys to non-negative int32, vectorised."""

    def __init__(self, bits: int):
        self.bits = bits
        self.mask = np.int64((1 << bits) - 1)
        self.keys = np.zeros(1 << bits, np.uint64)
        self.vals = np.full(1 << bits, -1, np.int32)
        self.count = 0

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Value of each key, -1 where it is absent."""
        slot = self._slots(keys)
        val = self.vals[slot]
        out = np.where((val >= 0) & (self.keys[slot] == keys), val, np.int32(-1))
        todo = np.flatnonzero((val >= 0) & (out < 0))
        while todo.size:
            s = (slot[todo] + 1) & self.mask
            slot[todo] = s
            val = self.vals[s]
            hit = (val >= 0) & (self.keys[s] == keys[todo])
            out[todo[hit]] = val[hit]
            todo = todo[(val >= 0) & ~hit]
        return out

    def add(self, keys: np.ndarray, vals: np.ndarray) -> None:
        """Add keys that are distinct and absent, with distinct values."""
        slot = self._slots(keys)
        todo = np.arange(len(keys))
        while todo.size:
            s = slot[todo]
            free = self.vals[s] < 0
            self.vals[s[free]] = vals[todo[free]]
            self.keys[s[free]] = keys[todo[free]]
            todo = todo[self.vals[s] != vals[todo]]
            slot[todo] = (slot[todo] + 1) & self.mask
        self.count += len(keys)


def connected_components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Smallest reachable node of every node of ``edges(a, b)`` (long columns).

    Large-star / small-star rounds (Kiveris et al.): every round is one pass of
    grouped minima over the edges, the number of edges never grows by more than
    the star rewiring, and it ends when a round changes nothing.  Every round
    is written to the shared checkpoint folder.  Returns (node, component).
    """
    ensure_checkpoint_dir(edges.sparkSession)
    edges = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b")
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().checkpoint()
    seen = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    state = seen(edges)
    for _ in range(max_rounds):
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Materialised, so that both sides of the join below come straight from an
        # exchange and Spark can split the rows of a node with very many neighbours.
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")).checkpoint()
        # Large star: neighbours above a node are linked to its smallest neighbour.
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b")
        # Small star: a node and its lower neighbours are linked to the smallest.
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low2, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = small.select("e.a", "e.b").where("a <> b").distinct().checkpoint()
        now = seen(edges)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
