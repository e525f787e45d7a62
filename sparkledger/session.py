"""Spark session construction and the shared checkpoint folder.

The library never creates its own scratch space on a cluster: lineage is cut
by tables written to the folder the cluster names in ``spark.checkpoint.dir``.  Only when that setting is absent (local tests, the
bench) do we pick a fresh folder under ``/tmp``.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Settings every session of ours wants.  AQE re-plans joins at runtime: it turns
# a sort-merge join into a broadcast only after measuring the real size of a
# side, splits skewed join partitions and coalesces tiny shuffle partitions.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # MIN/MAX/COUNT over a parquet scan (e.g. the stored max id) are answered
    # from file footers instead of reading the column.
    "spark.sql.parquet.aggregatePushdown": "true",
    # Checkpoint files of frames that are no longer referenced are deleted.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "sparkledger",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or fetch) a session with the library's base settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is.  In tests it may be missing; then a fresh ``/tmp`` folder is taken.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 -- Spark Connect: the server's spark.checkpoint.dir applies
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            raise RuntimeError("set spark.checkpoint.dir on the server") from None
        return folder
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="sparkledger-ckpt-", dir=os.environ.get("TMPDIR", "/tmp")))
    else:
        # A machine-local folder is invisible to other executors.
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
    return sc.getCheckpointDir()


#: Folders that ``staged`` has written inside the innermost ``staging``; none outside of one.
_STAGED: ContextVar[list[str] | None] = ContextVar("staged", default=None)
#: Shuffle files of a query go when it ends, not when the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df):
    """Write ``df`` once as a Parquet table below the checkpoint folder and read it back.

    Used where several branches of a plan read the same rows: the files keep
    one physical placement (partition ids, positions) also after lost executors
    re-run tasks, and later reads prune columns and push filters.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/staged-{uuid.uuid4().hex}"
    made = _STAGED.get()
    if made is not None:
        made.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staging() -> Iterator[list[str]]:
    """The list of the folders that ``staged`` writes inside (not those of a ``staging`` within)."""
    made: list[str] = []
    token = _STAGED.set(made)
    try:
        yield made
    finally:
        _STAGED.reset(token)


def discard(spark: SparkSession, folders: Sequence[str]) -> None:
    """Delete folders, on any file system that Spark reaches."""
    jvm = spark.sparkContext._jvm
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Work that leaves nothing behind: what ``staged`` writes inside is deleted at the end, and the shuffle
    files of a query when it ends.  Frames made inside must not be read after it.  (On Spark Connect the
    file systems are not at hand: there the folders stay.)"""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    with staging() as made:
        try:
            yield
        finally:
            spark.conf.set(SHUFFLE_CLEANUP, before)
            if hasattr(spark, "_jvm"):
                discard(spark, made)
