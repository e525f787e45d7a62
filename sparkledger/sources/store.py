"""Versioned snapshots of the stored tables, as plain Parquet folders.

A commit writes its rows to a fresh folder, split by the table's storage
partition, and then a marker that lists the folders making up the new version:
partitions the commit did not touch keep the folders they had.  Readers follow the
newest marker, so a run that dies before its marker leaves the previous version
current and a stray folder that nothing names; no plan overwrites files it is
reading.  All I/O but ``expire`` goes through Spark, so ``root`` may be any shared
file system.

Layout below ``root``::

    <table>/_commit=<id>/_part=<partition>/*.parquet     rows, with a hash of their values
    <table>/_rejects/_commit=<id>/*.parquet              rows the same commit could not store
    <table>/_versions/v=<version>/*.parquet              markers
    _published/p=<number>/*.parquet                      versions that belong together
    _runs/*.parquet                                      finished steps of runs

A version's marker folder may be written once: of two writers that start from
one version the second raises ``CommitConflict``.  (The check is Spark's
``errorifexists``, so a store without atomic folder creation leaves a gap of
milliseconds between check and write.)
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkledger.operators.quality import observed
from sparkledger.schemas import HASHED_PARTS, TABLE_KEYS, TABLE_PARTS, TABLE_SCHEMAS, TABLES_WITH_ID
from sparkledger.session import discard

_MARKER = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("kind", T.StringType()),
    T.StructField("part", T.StringType()),
    T.StructField("folder", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("committed_at", T.TimestampType()),
])
_PUBLICATION = T.StructType([
    T.StructField("number", T.LongType()),
    T.StructField("table", T.StringType()),
    T.StructField("version", T.LongType()),
    T.StructField("published_at", T.TimestampType()),
])
_STEP = T.StructType([
    T.StructField("run", T.StringType()),
    T.StructField("as_of", T.TimestampType()),
    T.StructField("scope", T.StringType()),
    T.StructField("step", T.StringType()),
    T.StructField("result", T.StringType()),
    T.StructField("finished_at", T.TimestampType()),
])
_REJECT = T.StructType([
    T.StructField("as_of", T.TimestampType()),
    T.StructField("reason", T.StringType()),
    T.StructField("row", T.StringType()),
])
COMMIT, PART, ROW_HASH = "_commit", "_part", "_hash"
#: Folders of a partition at which an append merges them.
MERGE_AFTER = 8
#: The step that ends a run.
PUBLISHED = "published"


class CommitConflict(RuntimeError):
    """Another writer has taken the version."""


def part_of(table: str) -> Column:
    """Storage partition of a row of ``table``, as text."""
    if table not in TABLE_PARTS:
        return F.lit("all")
    col, width = TABLE_PARTS[table]
    if table in HASHED_PARTS:
        value = F.pmod(F.xxhash64(col), F.lit(width))
    else:
        value = F.year(col) if width is None else F.floor(F.col(col) / width)
    return F.coalesce(value.cast("string"), F.lit("none"))


def hashed_columns(table: str, schema: T.StructType) -> list[str]:
    """Columns whose values a row hash covers: all but the natural key and the surrogate id."""
    skip = {*TABLE_KEYS.get(table, ()), *(["id"] if table in TABLES_WITH_ID else [])}
    return [f.name for f in schema.fields if f.name not in skip]


def row_hash(cols: Sequence[str]) -> Column:
    """64-bit hash of the values of ``cols``; nulls count by their place."""
    return F.xxhash64(*[x for c in cols for x in (F.col(c), F.col(c).isNull())]) if cols else F.lit(0).cast("long")


def reject_hash() -> Column:
    """64-bit hash of a reject; derived where it is read, so the files hold the text alone."""
    return F.xxhash64("reason", "row")


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, T.StructType] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schemas = dict(TABLE_SCHEMAS if schemas is None else schemas)

    # -- markers ----------------------------------------------------------
    def _small(self, path: str, schema: T.StructType) -> DataFrame | None:
        """A small table of the store's own; None before its first row."""
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{path}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _write_once(self, path: str, rows: list[tuple], schema: T.StructType, taken: str) -> None:
        try:
            self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("errorifexists").parquet(f"{self.root}/{path}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            raise CommitConflict(taken) from e

    def _markers(self, table: str) -> DataFrame | None:
        return self._small(f"{table}/_versions", _MARKER)

    def version(self, table: str) -> int:
        markers = self._markers(table)
        top = markers.agg(F.max("version")).first()[0] if markers is not None else None
        return int(top or 0)

    def entries(self, table: str, version: int, kind: str = "rows") -> list[tuple[str, str]]:
        """(partition, folder) pairs that make up a committed version."""
        markers = self._markers(table)
        if markers is None or not version:
            return []
        rows = markers.where((F.col("version") == version) & (F.col("kind") == kind)).select("part", "folder").collect()
        return sorted((r.part, r.folder) for r in rows)

    # -- reading ----------------------------------------------------------
    def _checked(self, table: str, version: int | None) -> int:
        current = self.version(table)
        if version is not None and not 0 <= version <= current:
            raise ValueError(f"{table} has versions 0..{current}, not {version}")
        return current if version is None else version

    def scan(self, table: str, version: int | None = None, parts: Iterable[str] | None = None) -> DataFrame:
        """Rows of a version with their storage partition (``PART``, a partition
        column, so filters on it open only its folders) and hash (``ROW_HASH``)."""
        found = self.entries(table, self._checked(table, version))
        wanted = None if parts is None else set(parts)
        paths = [f"{self.root}/{table}/{COMMIT}={folder}/{PART}={part}" for part, folder in found if wanted is None or part in wanted]
        schema = T.StructType([*self.schemas[table].fields, T.StructField(ROW_HASH, T.LongType()), T.StructField(COMMIT, T.StringType()), T.StructField(PART, T.StringType())])
        if not paths:
            return self.spark.createDataFrame([], schema).drop(COMMIT)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}").parquet(*paths).drop(COMMIT)

    def read(self, table: str, version: int | None = None, parts: Iterable[str] | None = None) -> DataFrame:
        """Current snapshot, or a given committed ``version`` (e.g. to compare
        or roll back after a bad landing), of all or the named partitions; an
        empty frame with the table schema where there is nothing."""
        return self.scan(table, version, parts).select(*self.schemas[table].fieldNames())

    def read_since(self, table: str, start: dt.date, version: int | None = None) -> DataFrame:
        """Rows of a table stored by year whose date is ``start`` or later: years
        before it are pruned by their folders, the rest is filtered in the scan."""
        col, width = TABLE_PARTS[table]
        if width is not None:
            raise ValueError(f"{table} is not stored by year")
        rows = self.scan(table, version).where((F.col(PART).try_cast("int") >= start.year) & (F.col(col) >= F.lit(start)))
        return rows.select(*self.schemas[table].fieldNames())

    # -- writing ----------------------------------------------------------
    def commit(self, table: str, df: DataFrame, replaces: Iterable[str] | None = None, appends: bool = False,
               base: int | None = None, rejects: DataFrame | None = None) -> int:
        """Write ``df`` as the next version and mark it committed.

        The new version is ``df`` in place of the partitions it ``replaces`` (all,
        if not given), or next to everything stored (``appends``).  ``base``: the version
        ``df`` was made from (default: the current one); raises ``CommitConflict`` where it is not
        current any more.  ``rejects`` (as_of, reason, row) become part of the version.
        """
        base = self.version(table) if base is None else base
        v, folder = base + 1, uuid.uuid4().hex
        fields = self.schemas[table].fields
        stored = self.entries(table, base)
        replaced = {p for p, _ in stored} if replaces is None and not appends else set(replaces or ())
        rows = df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
        rows = rows.withColumns({ROW_HASH: row_hash(hashed_columns(table, self.schemas[table])), PART: part_of(table)})
        folders: dict[str, int] = {}
        for p, _ in stored:
            folders[p] = folders.get(p, 0) + (p not in replaced)
        crowded = [p for p, n in folders.items() if n >= MERGE_AFTER]
        if crowded:
            rows = rows.unionByName(self.scan(table, base, crowded))
            replaced |= set(crowded)
        if table in TABLE_PARTS:  # one file for each partition and task, rows of a partition in key order
            rows = rows.sortWithinPartitions(PART, TABLE_PARTS[table][0])
        seen = Observation(f"{table}_v{v}")
        rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.collect_set(PART).alias("parts"))
        rows.write.option("compression", "zstd").partitionBy(PART).parquet(f"{self.root}/{table}/{COMMIT}={folder}")
        got = seen.get  # counted by the write itself
        now = dt.datetime.now(dt.timezone.utc)
        listed = [(v, "rows", p, f, None, now) for p, f in stored if p not in replaced]
        listed += [(v, "rows", p, folder, int(got["rows"]), now) for p in got["parts"]]
        if rejects is not None:
            lost = Observation(f"{table}_v{v}_rejects")
            rejects.select(*_REJECT.names).observe(lost, F.count(F.lit(1)).alias("n")).write.option("compression", "zstd").parquet(f"{self.root}/{table}/_rejects/{COMMIT}={folder}")
            listed.append((v, "rejects", None, folder, observed(lost, ["n"])["n"], now))
        self._mark(table, v, listed)
        return v

    def _mark(self, table: str, version: int, listed: list[tuple]) -> None:
        listed = listed or [(version, "empty", None, None, 0, dt.datetime.now(dt.timezone.utc))]
        self._write_once(f"{table}/_versions/v={version:010d}", listed, _MARKER, f"version {version} of {table} was committed by another writer")

    def add_rejects(self, table: str, rejects: DataFrame, base: int) -> int:
        """A version with the rows of ``base`` and these rejects."""
        folder, now, v = uuid.uuid4().hex, dt.datetime.now(dt.timezone.utc), base + 1
        rejects.select(*_REJECT.names).write.option("compression", "zstd").parquet(f"{self.root}/{table}/_rejects/{COMMIT}={folder}")
        self._mark(table, v, [*[(v, "rows", p, f, None, now) for p, f in self.entries(table, base)], (v, "rejects", None, folder, None, now)])
        return v

    def rejects(self, table: str) -> DataFrame:
        """(version, as_of, reason, row, hash): rows that commits could not store, each once, under
        the version that met it first.  Folders that no marker names (dead runs) do not count."""
        named, rows = self._rejected(table)
        # One row a version, broadcast: dealt out by folder, all rows of a commit would meet in one task.
        versions = self.spark.createDataFrame(named, f"version long, {COMMIT} string")
        first = rows.join(F.broadcast(versions), COMMIT).groupBy("reason", "hash", "row").agg(F.min(F.struct("version", "as_of")).alias("v"))
        return first.select("v.version", "v.as_of", "reason", "row", "hash")

    def new_rejects(self, table: str, rejects: DataFrame) -> DataFrame:
        """Those of ``rejects`` (as_of, reason, row) that no commit has, each once, in the order of
        their texts within a task (neighbours alike take less room)."""
        named, known = self._rejected(table)
        keys = ["reason", "row"]
        if named:
            rejects = rejects.withColumn("hash", reject_hash()).join(known.select("reason", "hash"), ["reason", "hash"], "left_anti")
            keys = ["reason", "hash", "row"]  # met by the exchange of the join
        return rejects.groupBy(*keys).agg(F.min("as_of").alias("as_of")).select(*_REJECT.names).sortWithinPartitions("reason", "row")

    def _rejected(self, table: str) -> tuple[list[tuple[int, str]], DataFrame]:
        """(version, folder) of the commits with rejects, and the rows of those folders with their hash."""
        schema = T.StructType([*_REJECT.fields, T.StructField(COMMIT, T.StringType())])
        markers = self._markers(table)
        named = [] if markers is None else [tuple(r) for r in markers.where("kind = 'rejects'").select("version", "folder").collect()]
        if not named:
            return [], self.spark.createDataFrame([], schema).withColumn("hash", reject_hash())
        base = f"{self.root}/{table}/_rejects"
        rows = self.spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{COMMIT}={folder}" for _, folder in named])
        return named, rows.withColumn("hash", reject_hash())

    # -- housekeeping -----------------------------------------------------
    def compact(self, table: str) -> int:
        """Bring every partition into one folder; returns the version (a new one if there was more than one)."""
        base = self.version(table)
        stored = [p for p, _ in self.entries(table, base)]
        split = sorted({p for p in stored if stored.count(p) > 1})
        if not split:
            return base
        key = TABLE_PARTS.get(table, (self.schemas[table].fieldNames()[0], None))[0]
        rows = self.scan(table, base, split).repartitionByRange(PART, key).drop(PART, ROW_HASH)
        return self.commit(table, rows, replaces=split, base=base)

    def expire(self, table: str, keep: int = 2) -> int:
        """Delete row folders that only versions before the last ``keep`` (and no
        publication still listed) name; returns how many.  Markers, rejects and folders that no
        marker names (a writer may be at work there) stay."""
        markers = self._markers(table)
        if markers is None:
            return 0
        held = {r.version for r in (self._publications() or self.spark.createDataFrame([], _PUBLICATION)).where(F.col("table") == table).collect()}
        rows = markers.where("kind = 'rows'").select("version", "folder").distinct().collect()
        last = self.version(table)
        live = {r.folder for r in rows if r.version > last - keep or r.version in held}
        dead = sorted({r.folder for r in rows} - live)
        discard(self.spark, [f"{self.root}/{table}/{COMMIT}={folder}" for folder in dead])
        return len(dead)

    # -- versions that belong together --------------------------------------
    def _publications(self) -> DataFrame | None:
        return self._small("_published", _PUBLICATION)

    def publish(self, versions: dict[str, int]) -> int:
        """Make these versions the ones that readers of published tables see, all at once."""
        found = self._publications()
        number = int((found.agg(F.max("number")).first()[0] if found is not None else None) or 0) + 1
        now = dt.datetime.now(dt.timezone.utc)
        self._write_once(f"_published/p={number:010d}", [(number, t, v, now) for t, v in sorted(versions.items())], _PUBLICATION,
                         f"publication {number} was made by another writer")
        return number

    def published(self) -> dict[str, int]:
        """Versions of the newest publication; empty before the first."""
        found = self._publications()
        if found is None:
            return {}
        rows = found.join(found.agg(F.max("number").alias("number")), "number").select("table", "version").collect()
        return {r.table: r.version for r in rows}

    def read_published(self, table: str) -> DataFrame:
        """A table as of the newest publication (empty before the first)."""
        return self.read(table, self.published().get(table, 0))

    # -- runs ---------------------------------------------------------------
    def open_run(self, as_of: dt.datetime, scope: str = "") -> tuple[str, dict[str, str]]:
        """(run, results of its finished steps): the unfinished run for ``as_of`` and ``scope``, or a new one."""
        steps = self._small("_runs", _STEP)
        if steps is not None:
            at = F.date_format("as_of", "yyyy-MM-dd HH:mm:ss") == as_of.strftime("%Y-%m-%d %H:%M:%S")
            rows = steps.where(at & (F.col("scope") == scope)).orderBy("finished_at").collect()
            over = {r.run for r in rows if r.step == PUBLISHED}
            left = [r for r in rows if r.run not in over]
            if left:
                return left[-1].run, {r.step: r.result for r in left if r.run == left[-1].run}
        return uuid.uuid4().hex, {}

    def finish_step(self, run: str, as_of: dt.datetime, scope: str, step: str, result: str) -> None:
        row = self.spark.createDataFrame([(run, as_of.strftime("%Y-%m-%d %H:%M:%S"), scope, step, result, dt.datetime.now(dt.timezone.utc))],
                                         "run string, as_of string, scope string, step string, result string, finished_at timestamp")
        row.withColumn("as_of", F.col("as_of").cast("timestamp")).coalesce(1).write.mode("append").parquet(f"{self.root}/_runs")

    # -- catalog --------------------------------------------------------------
    def register(self, database: str = "ledger", published: bool = False) -> list[str]:
        """One view per committed table in ``database``, each on its newest (or published)
        version, for ``spark.table("ledger.asset")`` in any session of the catalog.  A view names
        the folders of its version, so register again after a commit (``Ledger.update_all`` does)."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        versions, made = self.published() if published else {}, []
        for table, schema in sorted(self.schemas.items()):
            version = versions.get(table, 0) if published else self.version(table)
            if not version:
                continue
            found = self.entries(table, version)
            if found:
                cols = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields)
                names = ", ".join(f"'{folder}/{part}'" for part, folder in found)
                body = f"SELECT {cols} FROM parquet.`{self.root}/{table}` WHERE concat({COMMIT}, '/', CAST({PART} AS STRING)) IN ({names})"
            else:
                body = "SELECT " + ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields) + " WHERE false"
            self.spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{table}` AS {body}")
            made.append(table)
        return made
