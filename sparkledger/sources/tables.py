"""Stored tables: scans, records, catalog listing and column descriptions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(
    spark: SparkSession,
    source: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    **options: str,
) -> DataFrame:
    """Full scan of a stored table: a catalog name (``db.table``) or a path.

    Nothing is read until an action; projections and filters applied later
    are pushed into the scan by the optimizer.
    """
    if "/" not in source and ":" not in source and spark.catalog.tableExists(source):
        return spark.table(source)
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(source)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None,
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """Relational source; give a numeric ``partition_column`` with bounds to
    read in parallel slices instead of one connection."""
    props = dict(properties or {})
    if partition_column:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                               numPartitions=num_partitions, properties=props)
    return spark.read.jdbc(url, table, properties=props)


def records_to_df(spark: SparkSession, records: Iterable[Mapping[str, object]] | None, schema: T.StructType) -> DataFrame:
    """Rows (dicts) to a frame, always with a schema, so an empty list still has
    the table's columns.  For small, driver-side inputs only (fixtures)."""
    rows = [tuple(r.get(f.name) for f in schema.fields) for r in (records or [])]
    return spark.createDataFrame(rows, schema)


def small_rows(df: DataFrame, max_rows: int = 10_000) -> list[dict[str, object]]:
    """A small lookup's rows as dicts on the driver.

    Guarded: at most ``max_rows + 1`` rows are fetched, and a larger result
    raises instead of pulling an unbounded table through the driver.
    """
    got = df.limit(max_rows + 1).collect()
    if len(got) > max_rows:
        raise ValueError(f"lookup returned more than {max_rows} rows; join instead of collecting")
    return [r.asDict() for r in got]


def list_tables(spark: SparkSession) -> list[tuple[str, str]]:
    """``(database, table)`` pairs known to the catalog."""
    out = []
    for db in spark.catalog.listDatabases():
        out += [(db.name, t.name) for t in spark.catalog.listTables(db.name)]
    return out


def table_handle(spark: SparkSession, database: str, table: str) -> DataFrame:
    """Resolve a two-part name to the table."""
    return spark.table(f"{database}.{table}")


def describe_columns(df: DataFrame) -> DataFrame:
    """One row per column: ordinal, name, Spark type and non-null count.

    The counts come from a single aggregation over the table (partial counts
    per task, then one tiny merge), unpivoted into rows.
    """
    fields = df.schema.fields
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)])
    entries = ", ".join(
        f"{i + 1}L, '{f.name}', '{f.dataType.simpleString()}', c{i}" for i, f in enumerate(fields)
    )
    return counts.selectExpr(
        f"stack({len(fields)}, {entries}) as (ordinal, column_name, data_type, non_null)"
    )
