"""Landing-directory sources: saved JSON payloads from the upstream APIs.

HTTP collection is outside Spark; each endpoint's responses are saved as JSON
files under ``<landing>/<endpoint>/``.  One read covers every file of an
endpoint, so a fan-out over thousands of symbols is one scan, filtered by a
semi-join on the symbol list rather than one request per symbol.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkledger.functions.casts import lenient_double, lenient_long, ref_date_text, strip_chars
from sparkledger.functions.dates import days_before
from sparkledger.functions.names import snake_columns
from sparkledger.operators.lookup import symbols_frame
from sparkledger.operators.quality import require_status
from sparkledger.operators.ranking import keep_first, top_k_per_key
from sparkledger.operators.shape import drop_null_rows
from sparkledger.schemas import CPI_DAY_OF_MONTH, PAYLOAD_OK_STATUS, SERIES_PAYLOAD_SCHEMA


#: When a payload row was fetched: the ``fetched_at=`` folder of its landing file, or the file's modification time.
FETCHED = "_fetched_at"
#: Text of a record that could not be read; null where it could.
BROKEN = "_broken"

_FOLDER = r"/fetched_at=([0-9]{4}-[0-9]{2}-[0-9]{2}(?:T[0-9]{6})?)/"


def fetch_time() -> Column:
    """Fetch time of a landing file.  A copied landing has new modification times, so a folder
    ``fetched_at=2025-01-15`` or ``fetched_at=2025-01-15T020000`` (UTC) in the path counts before them."""
    text = F.regexp_extract(F.col("_metadata.file_path"), _FOLDER, 1)
    named = F.try_to_timestamp(F.when(F.length(text) == 10, F.concat(text, F.lit("T000000"))).otherwise(text), F.lit("yyyy-MM-dd'T'HHmmss"))
    return F.coalesce(named, F.col("_metadata.file_modification_time"))


def landed_texts(reader, path: str, json_lines: bool = False) -> DataFrame:
    """(text, fetch time) of every line (JSON Lines) or file; ``reader`` is
    ``spark.read`` or ``spark.readStream``."""
    # Any depth of folders; the text source adds none of them as columns.
    raw = reader.text(path, wholetext=not json_lines, recursiveFileLookup=True)
    return raw.select(F.col("value").alias("_text"), fetch_time().alias(FETCHED))


def parse_records(texts: DataFrame, schema: T.StructType, json_lines: bool = False) -> DataFrame:
    """Landed texts -> one row per record: the columns of ``schema`` (snake_case), ``FETCHED``
    and ``BROKEN``.

    A text is a JSON object or an array of objects.  A record that is no JSON, no object, or whose values
    do not fit the schema has its text in ``BROKEN``; of a file that breaks off, that is the whole file.
    Nothing is dropped but blank lines.
    """
    text = F.col("_text")
    # An array read as texts gives the text of each element; null where it is torn.
    records = F.when(F.ltrim(text).startswith("["), F.coalesce(F.from_json(text, T.ArrayType(T.StringType())), F.array(text))).otherwise(F.array(text))
    if not json_lines:
        texts = texts.select(F.explode(records).alias("_text"), FETCHED)
    texts = texts.where(F.trim(F.translate(F.coalesce(text, F.lit("null")), "\r\n\t", "   ")) != "")
    shape = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
    row = F.from_json(text, shape, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN})
    no_object = ~F.coalesce(F.ltrim(text).startswith("{"), F.lit(False))
    broken = F.when(no_object, F.coalesce(text, F.lit("null"))).otherwise(F.col(f"_p.{BROKEN}"))
    parsed = texts.withColumn("_p", row).select(*[F.col(f"_p.`{f.name}`") for f in schema.fields], F.col(FETCHED).alias("_0"), broken.alias("_1"))
    return snake_columns(parsed).withColumnsRenamed({"_0": FETCHED, "_1": BROKEN})


def read_landed(spark: SparkSession, path: str, schema: T.StructType, json_lines: bool = False) -> DataFrame:
    """Every record of a landing folder, unreadable ones included (``BROKEN``)."""
    return parse_records(landed_texts(spark.read, path, json_lines), schema, json_lines)


def read_payload(spark: SparkSession, path: str, schema: T.StructType, json_lines: bool = False) -> DataFrame:
    """JSON arrays of objects (one file per response) -> rows, snake_case names,
    and the time of their fetch as ``FETCHED``; unreadable records are left out (``read_landed`` has them).

    The schema (payload field names) is always given: nothing is inferred, and
    an empty folder yields zero rows with those columns.  A file holding one
    JSON array cannot be split between tasks, so large landings should be many
    files, JSON Lines (``json_lines=True``), or read by ``json_array.read_array``.
    """
    return read_landed(spark, path, schema, json_lines).where(F.col(BROKEN).isNull()).drop(BROKEN)


def unlisted_fields(texts: DataFrame, schema: T.StructType) -> DataFrame:
    """(field, records): fields that records have and ``schema`` does not list, so drift of a
    payload is seen.  Each record is read as a VARIANT; unreadable ones have no fields."""
    fields = texts.select(F.try_parse_json("_text").alias("v")).where("v is not null")
    objects = fields.where(F.schema_of_variant("v").startswith("OBJECT"))
    keys = objects.lateralJoin(objects.sparkSession.tvf.variant_explode(F.col("v").outer())).select("key")
    listed = [f.name for f in schema.fields]
    return keys.where(~F.col("key").isin(listed)).groupBy(F.col("key").alias("field")).agg(F.count(F.lit(1)).alias("records"))


def newest_fetch(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per natural key: that of the newest fetch, whatever lies in older
    files.  Of rows fetched at once the first in the order of their values stays
    (nulls last).  Rows without a fetch time are of one fetch.  Drops ``FETCHED``."""
    order = [(FETCHED, "desc_nulls_last")] if FETCHED in rows.columns else []
    order += [(c, "asc_nulls_last") for c in sorted(rows.columns) if c not in keys and c != FETCHED]
    return (keep_first(rows, keys, order) if order else rows.dropDuplicates(list(keys))).drop(FETCHED)


def parse_payload_column(df: DataFrame, col: str, schema: T.StructType | str, keep: Sequence[str] = ()) -> DataFrame:
    """JSON text held in a column -> typed columns (snake_case), next to ``keep``."""
    parsed = df.select(*keep, F.from_json(F.col(col), schema).alias("_p"))
    return snake_columns(parsed.select(*keep, "_p.*"))


def fan_out(payload: DataFrame, key: str, values: DataFrame | Sequence[str] | str) -> DataFrame:
    """Rows of ``payload`` for the listed key values (a scalar is one value).

    Values with no rows are simply absent; the frames are never concatenated
    one by one.
    """
    if isinstance(values, str):
        values = [values]
    if not isinstance(values, DataFrame):
        values = symbols_frame(payload.sparkSession, list(values), key)
    wanted = values.select(F.col(values.columns[0]).alias(key)).distinct()
    return payload.join(wanted, on=key, how="left_semi")


def explode_series(documents: DataFrame) -> DataFrame:
    """Nested series documents -> one row per (series, observation).

    ``documents`` has the ``SERIES_PAYLOAD_SCHEMA`` shape.  The month is the
    period code without its ``M`` (``M13`` -> 13, other codes -> null), year
    and value are lenient numbers, rows without a value are dropped, and
    ``ref_date`` is the text ``year-month-14`` (unpadded).
    """
    kept = [FETCHED] if FETCHED in documents.columns else []
    series = documents.select(*kept, F.explode("Results.series").alias("s"))
    obs = series.select(*kept, F.col("s.seriesID").alias("series_id"), F.explode("s.data").alias("d"))
    rows = obs.select(
        *kept,
        "series_id",
        lenient_long(F.col("d.year")).alias("year"),
        lenient_long(strip_chars(F.col("d.period"), "M")).alias("month"),
        F.col("d.periodName").alias("period_name"),
        lenient_double(F.col("d.value")).alias("series_value"),
    )
    return drop_null_rows(rows, "series_value").withColumn("ref_date", ref_date_text("year", "month", CPI_DAY_OF_MONTH))


def read_series(spark: SparkSession, path: str, json_lines: bool = False) -> DataFrame:
    """Series rows from the landing folder, newest fetch of each observation; a failed request raises."""
    docs = read_payload(spark, path, SERIES_PAYLOAD_SCHEMA, json_lines)
    require_status(docs, PAYLOAD_OK_STATUS)
    return newest_fetch(explode_series(docs), ["series_id", "year", "month"])


def screen(
    screener: DataFrame,
    min_mkt_cap: float,
    limit: int,
    country: str = "US",
    cap: str = "market_cap",
) -> DataFrame:
    """Screened symbols: cap above the threshold, in ``country``, not an ETF or
    fund, actively trading; the ``limit`` largest by cap (ties by symbol).

    ``orderBy().limit()`` plans a per-task top-n before one small merge.
    """
    kept = screener.filter(
        (F.col(cap) > F.lit(min_mkt_cap))
        & (F.col("country") == F.lit(country))
        & ~F.coalesce(F.col("is_etf"), F.lit(False))
        & ~F.coalesce(F.col("is_fund"), F.lit(False))
        & F.coalesce(F.col("is_actively_trading"), F.lit(False))
    )
    return kept.orderBy(F.col(cap).desc(), F.col("symbol").asc()).limit(limit)


def newest_per_symbol(payload: DataFrame, k: int, date: str = "date", key: str = "symbol", tiebreak: Sequence[str] = ()) -> DataFrame:
    """The per-symbol ``limit=k`` of the statement/earnings endpoints: the ``k``
    newest rows by ``date`` per symbol."""
    order = [(date, "desc_nulls_last")] + [(c, "asc") for c in tiebreak]
    return top_k_per_key(payload, key, order, k)


def first_match(payload: DataFrame, key: str = "query", order: Sequence[tuple[str, str]] = (("symbol", "asc"),)) -> DataFrame:
    """The ``limit=1`` of the search/profile endpoints: first row per query."""
    return top_k_per_key(payload, key, list(order), 1)


def _date(payload: DataFrame, date_col: str) -> Column:
    col = F.col(date_col)
    return col.try_cast("date") if isinstance(payload.schema[date_col].dataType, T.StringType) else col


def since(payload: DataFrame, date_col: str, as_of: dt.date | dt.datetime, days: int) -> DataFrame:
    """Rows dated within ``days`` before ``as_of`` (the price look-back); ``undated`` has those without a date."""
    # On a typed date/timestamp column the comparison reaches the parquet scan
    # as a pushed filter (and prunes date partitions).
    return payload.filter(_date(payload, date_col) >= F.lit(days_before(as_of, days)))


def undated(payload: DataFrame, date_col: str) -> DataFrame:
    """Rows whose date is missing or none."""
    return payload.filter(_date(payload, date_col).isNull())
