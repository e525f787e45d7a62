"""Table updates (the user-level API).

Each update is split in two:

* a pure transform ``<table>_payload(...)`` from landed payload rows (and the
  stored lookup tables it needs) to typed rows for the table -- a lazy plan;
* ``apply_update`` which diffs those rows against the stored snapshot and
  builds the next snapshot in one join (``upsert``) or, for insert-only
  tables, an anti-join plus append.

``Ledger`` wires them to a landing folder and a ``SnapshotStore``; its updates
write only rows that are new or differ.  ``as_of`` is explicit so a run can be
repeated exactly.
"""

from __future__ import annotations

import datetime as dt
import functools
import json
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sparkledger.functions import lenient_date, lenient_long, lenient_utc_timestamp, year_range
from sparkledger.operators import (
    add_constants,
    align_events,
    append,
    apply_schema,
    asset_map,
    blank_to_null,
    common_columns,
    keep_first,
    lookup_scalar,
    new_rows,
    observed,
    require_status,
    split_null_keys,
    stack_diagonal,
    to_period_id,
    updated_rows,
    upsert,
    next_id,
    with_row_index,
)
from sparkledger.schemas import (
    ASSET_CAT,
    ASSET_SUB_CAT,
    CPI_SERIES_ID,
    CPI_SERIES_NAME,
    CPI_YEARS,
    EARNING_ROWS,
    PAYLOAD_OK_STATUS,
    PRICE_DAYS,
    SCREEN_COUNTRY,
    SCREEN_LIMIT,
    SCREEN_MIN_MKT_CAP,
    SENTINEL_DATE,
    SENTINEL_PERIOD,
    SENTINEL_YEAR,
    SERIES_PAYLOAD_SCHEMA,
    PAYLOAD_SCHEMAS,
    STATEMENT_PERIODS,
    TABLE_KEYS,
    TABLES_WITH_ID,
)
from sparkledger.session import discard, scratch, staged, staging
from sparkledger.sources import (
    BROKEN,
    FETCHED,
    SnapshotStore,
    explode_series,
    fan_out,
    first_match,
    newest_fetch,
    newest_per_symbol,
    read_landed,
    screen,
    since,
    undated,
)
from sparkledger.sources.store import PART, PUBLISHED, ROW_HASH, hashed_columns, part_of, row_hash


@dataclass
class UpdateResult:
    """Lazy frames of one table update; only ``snapshot`` is written."""

    snapshot: DataFrame
    inserts: DataFrame
    updates: DataFrame
    rejects: DataFrame
    metrics: Observation  # payload rows and null-key rejects, filled without an extra pass
    writes: Observation  # inserted and updated rows, filled by the snapshot write


def prepare(schema, payload: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame, Observation]:
    """``(rows, rejects, metrics)``: the payload in the table's columns and types
    (strict), one row per key, and its rows with a null key.  Duplicate keys
    collapse to one row (a deterministic choice over the other columns; payload
    functions have taken the newest fetch before)."""
    keys = list(keys)
    stored = payload.sparkSession.createDataFrame([], schema)
    cols, _, incoming = common_columns(schema, stored, payload, keys)
    incoming = apply_schema(incoming, stored)
    metrics = Observation("payload")
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    incoming = incoming.observe(metrics, F.count(F.lit(1)).alias("rows"), F.count_if(any_null).alias("rejects"))
    good, rejects = split_null_keys(incoming, keys)
    others = [c for c in cols if c not in keys]
    good = keep_first(good, keys, [(c, "asc_nulls_last") for c in others]) if others else good.dropDuplicates(keys)
    return good, rejects, metrics


def apply_update(
    stored: DataFrame,
    payload: DataFrame,
    keys: Sequence[str],
    pk: str | None = None,
    insert_only: bool = False,
    first_id: int | None = None,
) -> UpdateResult:
    """Diff ``payload`` against ``stored`` on ``keys`` and build the next rows.

    New keys get ``pk`` ids from ``first_id``, or after the stored maximum.  With
    ``insert_only`` stored rows stay as they are and only new keys are added.
    """
    keys = list(keys)
    good, rejects, metrics = prepare(stored.schema, payload, keys)
    # The prepared payload (parsed JSON, mapped keys, casts) feeds the new-key
    # numbering and the merge: written once rather than derived for each.
    good = staged(good)
    inserts = new_rows(stored, good, keys)
    updates = updated_rows(stored, good, keys)
    writes = Observation("writes")
    if insert_only:
        if pk:
            inserts = with_row_index(inserts, [(k, "asc") for k in keys], name=pk,
                                     start=first_id if first_id is not None else next_id(stored, pk))
        inserts = inserts.observe(writes, F.count(F.lit(1)).alias("inserted"), F.lit(0).alias("updated"))
        snapshot = append(stored, inserts)
        updates = updates.limit(0)
    else:
        snapshot = upsert(stored, good, keys, pk=pk, first_id=first_id, observation=writes)
    return UpdateResult(snapshot, inserts, updates, rejects, metrics, writes)


def attach_asset_id(rows: DataFrame, amap: DataFrame, symbol: str = "symbol", out: str = "asset_id") -> DataFrame:
    """Rows of mapped symbols with the asset id in place of the symbol.

    One join on the symbol (never by position); the map has one row per asset.
    ``unmapped`` gives the rows that are not here.
    """
    m = amap.select(F.col("symbol").alias(symbol), F.col("id").cast("bigint").alias(out))
    return rows.join(m, on=symbol, how="inner").drop(symbol)


def with_asset_id(rows: DataFrame, amap: DataFrame) -> DataFrame:
    """``attach_asset_id`` that keeps the symbol.  Payload functions take it before they rank rows
    by symbol: the map has one row a symbol, so no ranking changes, and rows it lacks are not dealt out again."""
    return attach_asset_id(rows.withColumn("_symbol", F.col("symbol")), amap).withColumnRenamed("_symbol", "symbol")


def unmapped(rows: DataFrame, amap: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Rows whose symbol (null included) the map does not have: rejects."""
    return rows.join(amap.select(F.col("symbol").alias(symbol)), on=symbol, how="left_anti")


# ---------------------------------------------------------------------------
# Consumer-price index
# ---------------------------------------------------------------------------
def cpi_payload(series_rows: DataFrame, years: tuple[int, int] | None = None,
                series_ids: Sequence[str] | None = None, series_name: str = CPI_SERIES_NAME) -> DataFrame:
    rows = series_rows
    if years is not None:
        rows = rows.filter(F.col("year").between(years[0], years[1]))
    if series_ids is not None:
        rows = rows.filter(F.col("series_id").isin(list(series_ids)))
    return blank_to_null(add_constants(rows, {"series_name": series_name}))


# ---------------------------------------------------------------------------
# Assets (insert only)
# ---------------------------------------------------------------------------
def asset_payload(search_rows: DataFrame, symbols: DataFrame | Sequence[str] | None, cat_id: int,
                  query: str = "query", position: str = "position") -> DataFrame:
    """First search hit per queried symbol, as asset rows of category ``cat_id``.

    Of several fetches the newest counts, in it the least position.  Hits without a ``query`` are those of
    the symbol they name, hits without a ``position`` come last, by symbol and name.
    """
    asked = F.coalesce(F.col(query), F.col("symbol")) if query in search_rows.columns else F.col("symbol")
    place = F.col(position).cast("bigint") if position in search_rows.columns else F.lit(None).cast("bigint")
    rows = search_rows.withColumns({query: asked, position: place})
    rows = rows if symbols is None else fan_out(rows, query, symbols)
    order = [(position, "asc_nulls_last"), ("symbol", "asc"), ("name", "asc_nulls_last")]
    if FETCHED in rows.columns:
        order = [(FETCHED, "desc_nulls_last"), *order]
    rows = first_match(rows, query, order).withColumnRenamed("name", "description").drop(FETCHED)
    rows = add_constants(rows, {"asset_cat_id": (cat_id, "bigint"), "has_financials": True, "has_chart": True})
    return blank_to_null(rows)


# ---------------------------------------------------------------------------
# Equity profiles
# ---------------------------------------------------------------------------
def profile_payload(profile_rows: DataFrame, amap: DataFrame) -> DataFrame:
    rows = newest_fetch(with_asset_id(blank_to_null(profile_rows), amap), ["symbol"]).drop("symbol")
    if "ipo_date" in rows.columns:
        rows = rows.withColumn("ipo_date", lenient_date("ipo_date"))
    return rows


# ---------------------------------------------------------------------------
# T4: reporting periods, with one "not reported yet" placeholder per asset
# ---------------------------------------------------------------------------
def future_placeholders(asset_ids: DataFrame, key: str = "asset_id", ts_type: str = "timestamp") -> DataFrame:
    """One sentinel period per asset (date 4000-12-31, year 4000, period NA)."""
    return asset_ids.select(
        F.col(key).cast("bigint").alias("asset_id"),
        F.lit(SENTINEL_DATE).cast("date").alias("filing_date"),
        F.lit(f"{SENTINEL_DATE} 00:00:00").cast(ts_type).alias("accepted_date"),
        F.lit(SENTINEL_YEAR).cast("bigint").alias("fiscal_year"),
        F.lit(SENTINEL_PERIOD).alias("period"),
    )


def typed_statement_rows(statement_rows: DataFrame, amap: DataFrame, limit: int = STATEMENT_PERIODS) -> DataFrame:
    """Statement payload -> newest fetch of each quarter, newest ``limit`` quarters per symbol, asset id,
    lenient year/date/timestamp parsing, ``date`` renamed ``end_date``."""
    rows = newest_fetch(with_asset_id(blank_to_null(statement_rows), amap), ["symbol", "fiscal_year", "period"])
    rows = newest_per_symbol(rows, limit, "date", tiebreak=["period"]).drop("symbol")
    return rows.withColumns({
        "fiscal_year": lenient_long("fiscal_year"),
        "end_date": lenient_date("date"),
        "filing_date": lenient_date("filing_date"),
        "accepted_date": lenient_utc_timestamp("accepted_date"),
    }).drop("date")


def period_payload(statement_rows: DataFrame, amap: DataFrame, limit: int = STATEMENT_PERIODS) -> DataFrame:
    rows = typed_statement_rows(statement_rows, amap, limit)
    return stack_diagonal([rows, future_placeholders(amap.select(F.col("id").alias("asset_id")))])


# ---------------------------------------------------------------------------
# Statements keyed by reporting period
# ---------------------------------------------------------------------------
def statement_payload(statement_rows: DataFrame, amap: DataFrame, periods: DataFrame,
                      limit: int = STATEMENT_PERIODS) -> DataFrame:
    rows = typed_statement_rows(statement_rows, amap, limit)
    return to_period_id(rows, periods.select("id", "asset_id", "fiscal_year", "period"))


def without_period(typed: DataFrame, periods: DataFrame) -> DataFrame:
    """Typed statement rows whose (asset, year, period) has no reporting period (null parts included): rejects."""
    return typed.join(periods.select("asset_id", "fiscal_year", "period"), ["asset_id", "fiscal_year", "period"], "left_anti")


# ---------------------------------------------------------------------------
# Earnings aligned with reporting periods
# ---------------------------------------------------------------------------
def earning_payload(earning_rows: DataFrame, amap: DataFrame, periods: DataFrame, as_of: dt.datetime,
                    observation: Observation | None = None, limit: int = EARNING_ROWS,
                    report: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Newest fetch of each report, newest ``limit`` reports per symbol, aligned to
    periods; ``(aligned, rejects)``.  A report is a symbol and date, and the columns
    ``report`` where a payload has several a day."""
    # Payload fields other than symbol and date break ties between same-day rows.
    tiebreak = sorted(c for c in earning_rows.columns if c not in ("symbol", "date", FETCHED))
    rows = newest_fetch(with_asset_id(blank_to_null(earning_rows), amap), ["symbol", "date", *report])
    rows = newest_per_symbol(rows, limit, "date", tiebreak=tiebreak).drop("symbol")
    rows = rows.withColumns({
        "ref_date": lenient_date("date"),
        "accepted_date": lenient_utc_timestamp("date"),
    }).drop("date")
    # At most ``limit`` events and one period a quarter for each asset.
    return align_events(rows, periods.select("id", "asset_id", "accepted_date"), as_of=as_of, tiebreak=tiebreak,
                        observation=observation, small_groups=True)


def reports_after(state: DataFrame | None, delta: DataFrame, report: Sequence[str] = ("symbol", "date")) -> DataFrame:
    """All known reports of the symbols in ``delta``, the newest fetch of each report.

    Alignment ranks all reports of an asset, so a new report needs the older ones: ``state`` keeps them
    (with their fetch time), and nothing but the touched symbols is read of it.  None: no report of theirs is known."""
    seen = delta if FETCHED in delta.columns else delta.withColumn(FETCHED, F.lit(None).cast("timestamp"))
    # A batch without fetch times is newer than what is stored.
    seen = seen.withColumn(FETCHED, F.coalesce(FETCHED, F.lit("9999-01-01 00:00:00").cast("timestamp")))
    every = seen
    if state is not None:
        touched = delta.select("symbol").where("symbol is not null").distinct()
        every = state.join(touched, "symbol", "left_semi").unionByName(seen, allowMissingColumns=True)
    order = [(FETCHED, "desc_nulls_last")] + [(c, "asc_nulls_last") for c in sorted(every.columns) if c not in report and c != FETCHED]
    return keep_first(every, list(report), order)


# ---------------------------------------------------------------------------
# End-of-day prices
# ---------------------------------------------------------------------------
def price_payload(price_rows: DataFrame, amap: DataFrame, as_of: dt.date | dt.datetime,
                  days: int = PRICE_DAYS) -> DataFrame:
    rows = with_asset_id(since(blank_to_null(price_rows), "date", as_of, days), amap)
    rows = newest_fetch(rows, ["symbol", "date"]).drop("symbol")
    return rows.withColumn("end_date", lenient_date("date")).drop("date")


# ---------------------------------------------------------------------------
# Orchestration over a landing folder and a snapshot store
# ---------------------------------------------------------------------------
STATEMENT_TABLES = {
    "income_statement": "income_statement",
    "balance_sheet_statement": "balance_sheet_statement",
    "cash_flow_statement": "cash_flow_statement",
}


#: Stored assets up to which the map from symbols to ids (some 80 bytes a row) goes to every task.
BROADCAST_ASSETS = 100_000
#: Landing folders that a step of a run reads.
STEP_ENDPOINTS = {
    "cpi": ["cpi"],
    "asset": ["search", "screener"],
    "equity_profile": ["profile"],
    "reporting_period": ["income_statement"],
    **{table: [endpoint] for table, endpoint in STATEMENT_TABLES.items()},
    "earning": ["earnings"],
    "eod_price": ["historical_price"],
}


def tidy(update: Callable) -> Callable:
    """An update in a ``scratch``: its intermediate tables and shuffle files go with it, so a run needs
    the room of its largest step, not of all of them."""

    @functools.wraps(update)
    def run(self, *args, **kwargs):
        with scratch(self.spark):
            return update(self, *args, **kwargs)

    return run


def merge_changed(stored: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows with the columns of ``updates`` (unique on ``keys``) in place of their own, nulls
    included; no key is added."""
    others = [c for c in updates.columns if c not in keys and c in stored.columns]
    new = updates.select(*keys, F.struct(*[F.col(c) for c in others]).alias("_u")) if others else updates.select(*keys)
    joined = stored.join(new, list(keys), "left")
    return joined.select(*[F.when(F.col("_u").isNotNull(), F.col(f"_u.{c}")).otherwise(F.col(c)).alias(c) if c in others else F.col(c) for c in stored.columns])


class Ledger:
    """Runs the table updates: landing JSON in, versioned snapshots out.

    Landing folders may hold any number of fetches: of each natural key the
    newest counts, before any limit, ranking or merge.  What cannot be stored goes to
    ``rejects(table)`` with its reason:

    * ``corrupt``: a text that is no record (a torn file, a value of another type);
    * ``unmapped``: a symbol without a flagged asset;
    * ``undated``: a price without a date;
    * ``no_period``: a statement without a reporting period;
    * ``unaligned``: a report without a period and a placeholder;
    * ``null_key``: a null in the natural key.

    An update compares row hashes and writes only what is new or differs: rows of
    new keys are appended, partitions with a changed row are rewritten, and where
    nothing differs there is no new version.
    """

    def __init__(self, spark: SparkSession, store: SnapshotStore, landing: str, as_of: dt.datetime,
                 json_lines: bool = False):
        self.spark = spark
        self.store = store
        self.landing = landing.rstrip("/")
        self.as_of = as_of
        self.json_lines = json_lines
        self._read_once: dict[str, tuple[DataFrame, list[str]]] | None = None

    def _landed(self, endpoint: str, given: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
        """(rows, broken texts) of ``endpoint``, or of ``given`` rows (e.g. one micro-batch of
        new files from the streaming runner).  JSON is parsed once: what follows reads
        the parsed rows, and a run of all updates reads each endpoint once and keeps it to the last step that does."""
        if given is not None:
            landed = staged(given if BROKEN in given.columns else given.withColumn(BROKEN, F.lit(None).cast("string")))
        elif self._read_once is not None and endpoint in self._read_once:
            landed = self._read_once[endpoint][0]
        else:
            schema = SERIES_PAYLOAD_SCHEMA if endpoint == "cpi" else PAYLOAD_SCHEMAS[endpoint]
            records = read_landed(self.spark, f"{self.landing}/{endpoint}", schema, self.json_lines)
            if self._read_once is None:
                landed = staged(records)
            else:
                with staging() as made:
                    landed = staged(records)
                self._read_once[endpoint] = landed, made
        return landed.where(F.col(BROKEN).isNull()).drop(BROKEN), landed.where(F.col(BROKEN).isNotNull()).select(F.col(BROKEN).alias("text"))

    def _forget(self, endpoints: Iterable[str]) -> None:
        """Delete the parsed rows of endpoints that no later step reads."""
        for endpoint in endpoints:
            folders = self._read_once.pop(endpoint)[1]
            if hasattr(self.spark, "_jvm"):  # not on Spark Connect, see ``scratch``
                discard(self.spark, folders)

    def table(self, name: str) -> DataFrame:
        """A table as of the last finished run of all updates."""
        return self.store.read_published(name)

    def rejects(self, table: str) -> DataFrame:
        """(version, as_of, reason, row, hash): everything updates of ``table`` could not store, rows as JSON,
        each once, however often its fetch is read."""
        return self.store.rejects(table)

    def _rejected(self, table: str, lost: dict[str, DataFrame]) -> tuple[DataFrame | None, int]:
        """(rejects that no commit of ``table`` has, each once, or None; number of all), in one pass."""
        rows = None
        for reason, df in lost.items():
            row = F.to_json(F.struct(*[F.col(c) for c in df.columns if c != FETCHED]))
            cells = df.select(F.lit(self.as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp").alias("as_of"), F.lit(reason).alias("reason"), row.alias("row"))
            rows = cells if rows is None else rows.unionByName(cells)
        seen, kept = Observation("rejects"), Observation("new_rejects")
        new = self.store.new_rejects(table, rows.observe(seen, F.count(F.lit(1)).alias("n")))
        new = staged(new.observe(kept, F.count(F.lit(1)).alias("n")))
        if observed(kept, ["n"])["n"]:
            return new, observed(seen, ["n"])["n"]
        # Where none is new, Spark may drop the plan below its empty result, and the count of all with it.
        return None, observed(seen, ["n"])["n"] or rows.count()

    def _amap(self, flag: str, symbols: Sequence[str] | None) -> DataFrame:
        """The asset map, broadcast up to ``BROADCAST_ASSETS`` stored assets: a payload joined with it is then not dealt out,
        as it is where the planner learns the size of the map from an exchange of both sides."""
        assets = self.store.read("asset")
        amap = asset_map(assets, self.store.read("asset_cat"), flag, ASSET_CAT, symbols)
        return F.broadcast(amap) if assets.count() <= BROADCAST_ASSETS else amap

    @tidy
    def _update(self, table: str, payload: DataFrame, insert_only: bool = False, keys: Sequence[str] | None = None,
                lost: dict[str, DataFrame] | None = None) -> dict[str, int]:
        """Bring new and differing rows of a payload into the table.

        Of the stored side only keys and hashes of the partitions that the payload touches are read to find them."""
        keys, pk = list(keys or TABLE_KEYS[table]), "id" if table in TABLES_WITH_ID else None
        schema, base = self.store.schemas[table], self.store.version(table)
        good, null_keys, metrics = prepare(schema, payload, keys)
        every = hashed_columns(table, schema)
        # The stored hash covers all columns; it serves where the payload has them all.
        whole = keys == TABLE_KEYS[table] and set(every) <= set(good.columns)
        compared = every if whole else [c for c in good.columns if c not in keys and c != pk]
        good = staged(good.withColumns({PART: part_of(table), ROW_HASH: row_hash(compared)}))
        touched = [r[0] for r in good.select(PART).distinct().collect()]  # at most the partitions of a table
        if {p for p, _ in self.store.entries(table, base)}.isdisjoint(touched):
            changed = good.withColumn("_new", F.lit(True)).drop(ROW_HASH)  # nothing stored to compare with
        else:
            stored = self.store.scan(table, base, touched)
            have = stored.select(*keys, (F.col(ROW_HASH) if whole else row_hash(compared)).alias("_have"))
            new = F.col("_have").isNull()
            differs = new if insert_only else new | (F.col("_have") != F.col(ROW_HASH))
            changed = staged(good.join(have, keys, "left").where(differs).withColumn("_new", new).drop("_have", ROW_HASH))
        counts = {r[PART]: (r.inserted, r.updated) for r in changed.groupBy(PART).agg(
            F.count_if("_new").alias("inserted"), F.count_if(~F.col("_new")).alias("updated")).collect()}
        lost = dict(lost or {})
        if observed(metrics, ["rejects"])["rejects"]:
            lost["null_key"] = null_keys
        rejects, n_rejects = self._rejected(table, lost) if lost else (None, 0)
        inserted, updated = (sum(c[i] for c in counts.values()) for i in (0, 1))
        version = base
        if counts:
            rewritten = sorted(p for p, c in counts.items() if c[1])
            out = changed.where("_new").drop("_new", PART)
            if pk and inserted:
                out = with_row_index(out, [(k, "asc") for k in keys], name=pk, start=next_id(self.store.read(table, base), pk))
            out = append(self.spark.createDataFrame([], schema), out)
            if rewritten:
                changes = changed.where(~F.col("_new")).drop("_new", PART)
                out = out.unionByName(merge_changed(self.store.read(table, base, rewritten), changes, keys))
            version = self.store.commit(table, out, replaces=rewritten, base=base, rejects=rejects)
        elif rejects is not None:
            version = self.store.add_rejects(table, rejects, base)
        return {"version": version, "rows": observed(metrics, ["rows"])["rows"], "rejects": n_rejects, "inserted": inserted, "updated": updated}

    def _unmapped(self, rows: DataFrame, amap: DataFrame, symbols: Sequence[str] | None) -> dict[str, DataFrame]:
        """Rows of symbols outside the map; with a list of symbols the others were not asked for."""
        return {"unmapped": unmapped(rows, amap)} if symbols is None else {}

    @tidy
    def update_cpi(self, num_years: int = CPI_YEARS, series_ids: Sequence[str] = (CPI_SERIES_ID,),
                   keys: Sequence[str] | None = None, documents: DataFrame | None = None) -> dict[str, int]:
        """``documents``: nested series documents to use instead of the landing folder."""
        docs, broken = self._landed("cpi", documents)
        require_status(docs, PAYLOAD_OK_STATUS)
        series = newest_fetch(explode_series(docs), ["series_id", "year", "month"])
        return self._update("cpi", cpi_payload(series, year_range(self.as_of, num_years), series_ids), keys=keys, lost={"corrupt": broken})

    @tidy
    def update_asset(self, symbols: DataFrame | Sequence[str] | None = None, payload: DataFrame | None = None,
                     min_mkt_cap: float = SCREEN_MIN_MKT_CAP, limit: int = SCREEN_LIMIT,
                     country: str = SCREEN_COUNTRY) -> dict[str, int]:
        """New assets among ``symbols``, or among the ``limit`` largest of the newest screening."""
        cats = self.store.read("asset_cat")
        cat_id = lookup_scalar(cats.filter((F.col("cat") == ASSET_CAT) & (F.col("sub_cat") == ASSET_SUB_CAT)), "id")
        hits, broken = self._landed("search", payload)
        if isinstance(symbols, DataFrame):
            wanted: DataFrame | Sequence[str] = symbols
        elif not symbols:
            found, unread = self._landed("screener")
            broken = broken.unionByName(unread)
            wanted = screen(newest_fetch(found, ["symbol"]), min_mkt_cap, limit, country).select("symbol")
        else:
            wanted = list(symbols)
        return self._update("asset", asset_payload(hits, wanted, cat_id), insert_only=True, lost={"corrupt": broken})

    @tidy
    def update_equity_profile(self, symbols: Sequence[str] | None = None,
                              payload: DataFrame | None = None) -> dict[str, int]:
        (rows, broken), amap = self._landed("profile", payload), self._amap("has_financials", symbols)
        return self._update("equity_profile", profile_payload(rows, amap), lost={"corrupt": broken, **self._unmapped(rows, amap, symbols)})

    @tidy
    def update_reporting_period(self, symbols: Sequence[str] | None = None, payload: DataFrame | None = None,
                                limit: int = STATEMENT_PERIODS) -> dict[str, int]:
        (rows, broken), amap = self._landed("income_statement", payload), self._amap("has_financials", symbols)
        return self._update("reporting_period", period_payload(rows, amap, limit), lost={"corrupt": broken, **self._unmapped(rows, amap, symbols)})

    @tidy
    def update_statement(self, table: str, symbols: Sequence[str] | None = None, payload: DataFrame | None = None,
                         limit: int = STATEMENT_PERIODS) -> dict[str, int]:
        (rows, broken), amap = self._landed(STATEMENT_TABLES[table], payload), self._amap("has_financials", symbols)
        periods = self.store.read("reporting_period").select("id", "asset_id", "fiscal_year", "period")
        typed = staged(typed_statement_rows(rows, amap, limit))
        lost = {"corrupt": broken, "no_period": without_period(typed, periods), **self._unmapped(rows, amap, symbols)}
        return self._update(table, to_period_id(typed, periods), lost=lost)

    @tidy
    def update_earning(self, symbols: Sequence[str] | None = None, payload: DataFrame | None = None,
                       limit: int = EARNING_ROWS) -> dict[str, int]:
        """Alignment ranks an asset's reports among themselves.  The reports known so far are kept in the
        store (``earning_report``), so a payload may hold new ones alone: of the symbols in it the others come from there."""
        seen = Observation("alignment")
        (rows, broken), amap = self._landed("earnings", payload), self._amap("has_financials", symbols)
        keyed = blank_to_null(rows).where("symbol is not null and date is not null")
        touched = [r[0] for r in keyed.select(part_of("earning_report").alias(PART)).distinct().collect()]
        stored = {p for p, _ in self.store.entries("earning_report", self.store.version("earning_report"))}
        known = self.store.read("earning_report", parts=touched).withColumnRenamed("fetched_at", FETCHED)
        reports = staged(reports_after(None if stored.isdisjoint(touched) else known, keyed))
        self._update("earning_report", reports.withColumnRenamed(FETCHED, "fetched_at"))
        every = reports.unionByName(blank_to_null(rows).where("symbol is null or date is null"), allowMissingColumns=True)
        aligned, unaligned = earning_payload(every, amap, self.store.read("reporting_period"), self.as_of, observation=seen, limit=limit)
        out = self._update("earning", aligned, lost={"corrupt": broken, "unaligned": unaligned, **self._unmapped(rows, amap, symbols)})
        out["unaligned"] = observed(seen, ["unaligned"])["unaligned"]
        return out

    @tidy
    def update_eod_price(self, symbols: Sequence[str] | None = None, payload: DataFrame | None = None,
                         days: int = PRICE_DAYS) -> dict[str, int]:
        (rows, broken), amap = self._landed("historical_price", payload), self._amap("has_chart", symbols)
        lost = {"corrupt": broken, "undated": undated(rows, "date").join(amap, "symbol", "left_semi"), **self._unmapped(rows, amap, symbols)}
        return self._update("eod_price", price_payload(rows, amap, self.as_of, days), lost=lost)

    def update_all(self, symbols: Sequence[str] | None = None) -> dict[str, dict[str, int]]:
        """All updates in dependency order (assets before what keys on them), published together.

        Readers of ``table`` see the tables of the last finished run until the last update is done.  A run
        that died is taken up where it stopped: finished updates are not repeated.
        """
        steps = {"cpi": self.update_cpi, "asset": lambda: self.update_asset(symbols), "equity_profile": lambda: self.update_equity_profile(symbols),
                 "reporting_period": lambda: self.update_reporting_period(symbols)}
        steps |= {t: lambda t=t: self.update_statement(t, symbols) for t in STATEMENT_TABLES}
        steps |= {"earning": lambda: self.update_earning(symbols), "eod_price": lambda: self.update_eod_price(symbols)}
        run, done = self.store.open_run(self.as_of, ",".join(sorted(symbols or ())))
        out, self._read_once = {}, {}
        try:
            for name, step in steps.items():
                if name in done:
                    out[name] = json.loads(done[name])
                    continue
                out[name] = step()
                self.store.finish_step(run, self.as_of, ",".join(sorted(symbols or ())), name, json.dumps(out[name]))
                later = {e for step_name in list(steps)[len(out):] for e in STEP_ENDPOINTS[step_name]}
                self._forget(e for e in list(self._read_once) if e not in later)
        finally:
            self._forget(list(self._read_once))
            self._read_once = None
        self.store.publish({name: out[name]["version"] for name in steps})
        self.store.finish_step(run, self.as_of, ",".join(sorted(symbols or ())), PUBLISHED, "{}")
        return out
