"""Driver queries that run the ledger itself: landing folders and snapshot stores
built from the test tables, and what the store holds afterwards."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkledger.functions import snake_case
from sparkledger.operators import append
from sparkledger.plans.pipelines import Ledger, apply_update, earning_payload, price_payload, reports_after
from sparkledger.plans.queries import (
    ALIGN_AS_OF,
    ALIGN_AS_OF_TEXT,
    EARLIER,
    ORACLE,
    PRICE_AS_OF,
    SQL_AMAP_CHART,
    SQL_EARNING_ROWS,
    SQL_PERIOD_CTES,
    SQL_SERIES,
    as_stored,
    customer_assets,
    earning_rows,
    empty_table,
    fin_map,
    incoming_orders,
    nation_categories,
    period_snapshot,
    price_rows,
    profile_rows,
    register,
    screener_rows,
    search_rows,
    series_documents,
    sql_align,
    sql_top,
    statement_rows,
    stored_orders,
    table,
)
from sparkledger.schemas import (
    ASSET_CAT,
    ASSET_SUB_CAT,
    CPI_SERIES_ID,
    CPI_YEARS,
    EARNING_ROWS,
    PAYLOAD_SCHEMAS,
    PRICE_DAYS,
    SCREEN_LIMIT,
    SENTINEL_DATE,
    SENTINEL_PERIOD,
    SENTINEL_YEAR,
    STATEMENT_PERIODS,
    TABLE_SCHEMAS,
)
from sparkledger.session import ensure_checkpoint_dir, scratch
from sparkledger.sources import FETCHED, SnapshotStore, landed_texts, list_tables, read_array, table_handle, unlisted_fields
from sparkledger.sources.bucketed import merged_buckets, write_bucketed
from sparkledger.sources.store import PART

LEDGER_AS_OF = dt.datetime(2002, 1, 1)


def fresh_folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledger-{uuid.uuid4().hex}"


def land(df: DataFrame, folder: str, endpoint: str) -> None:
    """Write payload rows as JSON Lines (gzip) under the payload's field names, as one fetch
    (its files are not written at one moment)."""
    named = {snake_case(f.name): f.name for f in PAYLOAD_SCHEMAS[endpoint].fields}
    df.select(*[F.col(c).alias(named[c]) for c in df.columns if c in named]).write.option("compression", "gzip").json(f"{folder}/{endpoint}/fetched_at=2002-01-01")


def customers_ledger(spark: SparkSession, d: str, as_of: dt.datetime) -> Ledger:
    """A ledger whose stored assets are the customers, those of America as equities."""
    root = fresh_folder(spark)
    store = SnapshotStore(spark, f"{root}/store")
    store.commit("asset_cat", nation_categories(spark, d).withColumn("cat", F.when(F.col("cat") == "AMERICA", ASSET_CAT).otherwise(F.col("cat"))))
    store.commit("asset", append(empty_table(spark, "asset"), customer_assets(spark, d)))
    return Ledger(spark, store, f"{root}/landing", as_of, json_lines=True)


SQL_PRICES = f"""{SQL_AMAP_CHART},
pdays AS (SELECT c_name AS symbol, o_orderdate AS day, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents, count(*) AS volume
          FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2),
pp AS (SELECT a.id AS asset_id, CAST(day AS DATE) AS end_date, CAST(cents AS DOUBLE) / 100.0 AS close, volume
       FROM pdays JOIN amapc a USING (symbol) WHERE day >= TIMESTAMP '{PRICE_AS_OF - dt.timedelta(days=PRICE_DAYS)}')"""


# ---------------------------------------------------------------------------
# Only what is new or differs is written
# ---------------------------------------------------------------------------
@register("upsert_unchanged", f"""
WITH {SQL_PRICES}
SELECT CAST(year(end_date) AS VARCHAR) AS part, count(*) AS rows, CAST(sum(CAST(round(close * 100) AS BIGINT)) AS BIGINT) AS cents,
       bool_or(end_date < DATE '{EARLIER}') AS rewritten, 2::BIGINT AS versions
FROM pp GROUP BY 1""")
def q_upsert_unchanged(spark, d):
    """Three fetches of all prices: the second revises the years before 1999, the third is the second again."""
    ledger = customers_ledger(spark, d, dt.datetime.combine(PRICE_AS_OF, dt.time()))
    rows = price_rows(spark, d)
    first = rows.withColumn("close", F.when(F.col("date") < EARLIER, F.col("close") + 1.0).otherwise(F.col("close")))
    for fetch in (first, rows, rows):
        ledger.update_eod_price(payload=fetch)
    store, name = ledger.store, "eod_price"
    before, after = (spark.createDataFrame(store.entries(name, v), f"{PART} string, folder string") for v in (1, store.version(name)))
    moved = after.join(before, [PART, "folder"], "left_anti").select(PART, F.lit(True).alias("rewritten"))
    sums = store.scan(name).groupBy(PART).agg(F.count(F.lit(1)).alias("rows"), F.sum(F.round(F.col("close") * 100).cast("bigint")).alias("cents"))
    return sums.join(moved, PART, "left").select(F.col(PART).alias("part"), "rows", "cents", F.coalesce("rewritten", F.lit(False)).alias("rewritten"),
                                                 F.lit(store.version(name)).cast("long").alias("versions"))


@register("upsert_bucketed", ORACLE["upsert_snapshot"])
def q_upsert_bucketed(spark, d):
    """The upsert of ``upsert_snapshot`` on a table bucketed by its key."""
    stored = write_bucketed(stored_orders(spark, d), f"bucketed_{uuid.uuid4().hex}", ["o_orderkey"], 8, fresh_folder(spark))
    incoming = incoming_orders(spark, d).drop("o_orderpriority", "o_source")
    after = merged_buckets(stored, incoming, ["o_orderkey"], pk="id")
    return write_bucketed(after, f"bucketed_{uuid.uuid4().hex}", ["o_orderkey"], 8, fresh_folder(spark), dealt=True)


# ---------------------------------------------------------------------------
# S3, D3: records that cannot be read or stored
# ---------------------------------------------------------------------------
SQL_LINES = """lines AS (SELECT c_name AS symbol, strftime(o_orderdate, '%Y-%m-%d') AS date, count(*) AS volume
  FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2),
texts AS (SELECT *, '{"symbol":"' || symbol || '","date":"' || date || '","volume":' || volume || '}' AS text FROM lines)"""


def price_texts(spark: SparkSession, d: str) -> DataFrame:
    """(symbol, date, volume, text): prices as lines of JSON."""
    rows = price_rows(spark, d).select("symbol", "date", "volume")
    return rows.withColumn("text", F.concat(F.lit('{"symbol":"'), "symbol", F.lit('","date":"'), "date", F.lit('","volume":'), F.col("volume").cast("string"), F.lit("}")))


@register("reject_corrupt", f"""
WITH {SQL_AMAP_CHART}, {SQL_LINES},
landed AS (SELECT *, CASE WHEN volume % 2 = 0 THEN text[:length(text) - 3] WHEN date < '1996-01-01' THEN replace(text, '"volume":', '"volume":"x"') ELSE text END AS line FROM texts)
SELECT 'corrupt' AS reason, line AS text, count(*) AS rows FROM landed WHERE line <> text AND NOT (volume % 2 <> 0 AND date >= '1996-01-01') GROUP BY line
UNION ALL
SELECT 'stored', NULL, count(*) FROM landed JOIN amapc USING (symbol) WHERE line = text AND date >= '{PRICE_AS_OF - dt.timedelta(days=PRICE_DAYS)}'""")
def q_reject_corrupt(spark, d):
    """A landing with torn lines and wrong types, read twice: each broken text is kept once."""
    ledger = customers_ledger(spark, d, dt.datetime.combine(PRICE_AS_OF, dt.time()))
    texts = price_texts(spark, d)
    torn = F.expr("substring(text, 1, length(text) - 3)")
    typed = F.replace(F.col("text"), F.lit('"volume":'), F.lit('"volume":"x"'))
    line = F.when(F.col("volume") % 2 == 0, torn).when(F.col("date") < "1996-01-01", typed).otherwise(F.col("text"))
    texts.select(line.alias("value")).write.text(f"{ledger.landing}/historical_price")
    for _ in range(2):
        ledger.update_eod_price()
    kept = ledger.rejects("eod_price").where("reason = 'corrupt'").select("reason", F.get_json_object("row", "$.text").alias("text"))
    kept = kept.groupBy("reason", "text").agg(F.count(F.lit(1)).alias("rows"))
    stored = ledger.store.read("eod_price").agg(F.count(F.lit(1)).alias("rows"))
    return kept.unionByName(stored.select(F.lit("stored").alias("reason"), F.lit(None).cast("string").alias("text"), "rows"))


@register("array_payload", f"""
WITH {SQL_LINES}
SELECT symbol, date, volume, CASE WHEN volume % 2 = 0 THEN 'a "}} {{[' || symbol ELSE 'b' END AS note, 'n' AS inner_note FROM lines""")
def q_array_payload(spark, d):
    """Prices as JSON arrays, a file a task, with braces and quotes in strings and nested objects, read by byte ranges."""
    folder = fresh_folder(spark)
    rows = price_rows(spark, d).select("symbol", "date", "volume")
    note = F.when(F.col("volume") % 2 == 0, F.concat(F.lit('a "} {['), "symbol")).otherwise("b")
    text = F.to_json(F.struct("symbol", F.struct(F.struct(F.lit("n").alias("note")).alias("inner")).alias("more"), note.alias("note"), "date", "volume"))
    rows.select(text.alias("value")).write.option("lineSep", ",\n").text(folder)
    schema = T.StructType.fromDDL("symbol string, date string, volume bigint, note string, more struct<inner: struct<note: string>>")
    found = read_array(spark, folder, schema)
    return found.select("symbol", "date", "volume", "note", F.col("more.inner.note").alias("inner_note"))


@register("reject_undated", f"""
WITH {SQL_AMAP_CHART}, {SQL_LINES}
SELECT symbol, CASE WHEN volume % 2 = 0 THEN 'soon' END AS date, volume, count(*) AS rows FROM (
    SELECT DISTINCT symbol, volume, CASE WHEN volume % 2 = 0 THEN 'soon' END AS d FROM lines JOIN amapc USING (symbol)
    WHERE volume % 2 = 0 OR date < '1996-01-01') GROUP BY 1, 2, 3""")
def q_reject_undated(spark, d):
    """Prices without a date, or with a word for one, of assets with a chart."""
    ledger = customers_ledger(spark, d, dt.datetime.combine(PRICE_AS_OF, dt.time()))
    date = F.when(F.col("volume") % 2 == 0, "soon").when(F.col("date") < "1996-01-01", "").otherwise(F.col("date"))
    ledger.update_eod_price(payload=price_rows(spark, d).select("symbol", date.alias("date"), "volume"))
    row = F.from_json("row", "symbol string, date string, volume bigint").alias("r")
    found = ledger.rejects("eod_price").where("reason = 'undated'").select(row).select("r.symbol", F.nullif("r.date", F.lit("")).alias("date"), "r.volume")
    return found.groupBy("symbol", "date", "volume").agg(F.count(F.lit(1)).alias("rows"))


@register("reject_unmatched", f"""
WITH {SQL_PERIOD_CTES}
SELECT asset_id, CAST(fiscal_year AS BIGINT) AS fiscal_year, period, revenue
FROM {sql_top("p_all", "asset_id", "d DESC, period", STATEMENT_PERIODS)} WHERE fiscal_year >= 1998""")
def q_reject_unmatched(spark, d):
    """Statements whose periods are known up to 1997 only."""
    ledger = customers_ledger(spark, d, LEDGER_AS_OF)
    rows = statement_rows(spark, d)
    ledger.update_reporting_period(payload=rows.filter(F.col("fiscal_year") < "1998"), limit=1000)
    ledger.update_statement("income_statement", payload=rows)
    row = F.from_json("row", "asset_id bigint, fiscal_year bigint, period string, revenue bigint").alias("r")
    return ledger.rejects("income_statement").where("reason = 'no_period'").select(row).select("r.*")


@register("payload_drift", """
SELECT 'newRating' AS field, count(*) AS records FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT 'oldCode', count(*) FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""")
def q_payload_drift(spark, d):
    """Fields that landed profiles have and the payload schema does not list."""
    folder = fresh_folder(spark)
    code = F.when(F.col("sector").isin("BUILDING", "MACHINERY"), F.struct(F.lit(1).alias("n")))
    rating = F.when(F.col("sector") == "BUILDING", F.array(F.lit("A")))
    profile_rows(spark, d).select("symbol", F.col("company_name").alias("companyName"), code.alias("oldCode"), rating.alias("newRating")).write.json(folder)
    return unlisted_fields(landed_texts(spark.read, folder, json_lines=True), PAYLOAD_SCHEMAS["profile"])


# ---------------------------------------------------------------------------
# The first hit of the newest fetch
# ---------------------------------------------------------------------------
@register("first_hit", """
SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN c_name || '.W' ELSE c_name END AS symbol,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_name || ' Inc' END AS description
FROM customer""")
def q_first_hit(spark, d):
    """Two landed fetches of the search for every customer; in the newer one look-alikes come first for some."""
    ledger = customers_ledger(spark, d, LEDGER_AS_OF)
    ledger.store.commit("asset", empty_table(spark, "asset"))
    ledger.store.commit("asset_cat", spark.createDataFrame([(1, ASSET_CAT, ASSET_SUB_CAT)], TABLE_SCHEMAS["asset_cat"]))
    hits = search_rows(spark, d).join(table(spark, d, "customer").select(F.col("c_name").alias("query"), "c_mktsegment"), "query")
    old = hits.withColumn("position", 3 - F.col("position"))
    new = hits.withColumn("position", F.when(F.col("c_mktsegment") == "MACHINERY", 3 - F.col("position")).otherwise(F.col("position")))
    for when, rows in (("2024-01-01", old), ("2024-02-01", new)):
        rows.select("query", "position", "symbol", "name").write.json(f"{ledger.landing}/search/fetched_at={when}")
    ledger.update_asset(table(spark, d, "customer").select("c_name"))
    return ledger.store.read("asset").select("symbol", "description")


# ---------------------------------------------------------------------------
# New reports aligned with those the store keeps
# ---------------------------------------------------------------------------
@register("align_incremental", ORACLE["pipe_earning"])
def q_align_incremental(spark, d):
    """``pipe_earning`` with a second fetch of new reports alone: the older ones of the touched assets come from the state."""
    report = ["symbol", "date", "report_id"]
    amap, periods = fin_map(spark, d), as_stored(period_snapshot(spark, d))
    rows = as_stored(earning_rows(spark, d))
    early = F.col("date") < EARLIER
    state = rows.filter(early).withColumn(FETCHED, F.lit("2024-01-01 00:00:00").cast("timestamp"))
    aligned, _ = earning_payload(rows.filter(early), amap, periods, ALIGN_AS_OF, report=["report_id"])
    stored = as_stored(apply_update(empty_table(spark, "earning"), aligned, ["reporting_period_id"]).snapshot)
    delta = rows.filter(~early)
    current = as_stored(reports_after(state, delta, report))
    aligned, _ = earning_payload(current, amap, periods, ALIGN_AS_OF, report=["report_id"])
    return apply_update(stored, aligned, ["reporting_period_id"]).snapshot


# ---------------------------------------------------------------------------
# The stored side of a look-back; S15, S16: stored tables by name
# ---------------------------------------------------------------------------
RECENT_FROM = dt.date(1999, 7, 1)


@register("recent_prices", f"""
WITH {SQL_PRICES}
SELECT asset_id, end_date, close, volume FROM pp WHERE end_date >= DATE '{RECENT_FROM}'""")
def q_recent_prices(spark, d):
    """Stored prices from a date on; the years before it are not opened."""
    store = SnapshotStore(spark, fresh_folder(spark))
    store.commit("eod_price", price_payload(price_rows(spark, d), fin_map(spark, d, "has_chart"), PRICE_AS_OF))
    return store.read_since("eod_price", RECENT_FROM).select("asset_id", "end_date", "close", "volume")


def registered_tables(spark: SparkSession, d: str, names: list[str]) -> str:
    """A database with a view per table, each committed to a store."""
    frames = {name: table(spark, d, name) for name in names}
    store = SnapshotStore(spark, fresh_folder(spark), {name: df.schema for name, df in frames.items()})
    for name, df in frames.items():
        store.commit(name, df)
    database = f"ledger_{uuid.uuid4().hex}"
    store.register(database)
    return database


@register("catalog_listing", """
SELECT 'customer' AS table_name, count(*) AS rows FROM customer UNION ALL SELECT 'nation', count(*) FROM nation
UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'region', count(*) FROM region""")
def q_catalog_listing(spark, d):
    """The stored tables that another session finds in the catalog, with their row counts."""
    database = registered_tables(spark, d, ["customer", "nation", "orders", "region"])
    other = spark.newSession()
    out = None
    for name in sorted(t for db, t in list_tables(other) if db == database):
        one = table_handle(spark, database, name).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


@register("table_handle", "SELECT * FROM orders")
def q_table_handle(spark, d):
    return table_handle(spark, registered_tables(spark, d, ["orders"]), "orders")


# ---------------------------------------------------------------------------
# All updates from a landing folder, published together
# ---------------------------------------------------------------------------
SQL_LEDGER = f"""
WITH {SQL_SERIES}, {SQL_EARNING_ROWS},
screened AS (SELECT c_name AS symbol
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE c_acctbal * 1000000.0 > 1000000000 AND r_name = 'AMERICA' AND c_mktsegment NOT IN ('AUTOMOBILE', 'FURNITURE', 'HOUSEHOLD')
  ORDER BY c_acctbal * 1000000.0 DESC, c_name LIMIT {SCREEN_LIMIT}),
assets AS (SELECT row_number() OVER (ORDER BY symbol) AS id, symbol FROM screened),
st AS (SELECT c.c_name AS symbol, year(o.o_orderdate) AS fiscal_year, 'Q' || quarter(o.o_orderdate) AS period, max(o.o_orderdate) AS d,
              CAST(sum(CAST(round(o.o_totalprice * 100) AS BIGINT)) AS BIGINT) AS revenue, count(*) * 1000 AS net_income
       FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey GROUP BY 1, 2, 3),
p_all AS (SELECT a.id AS asset_id, st.* FROM st JOIN assets a USING (symbol)),
top AS (SELECT * FROM {sql_top("p_all", "asset_id", "CAST(d AS DATE) DESC, period", STATEMENT_PERIODS)}),
rp AS (SELECT row_number() OVER (ORDER BY asset_id, fiscal_year, period) AS id, * FROM (
         SELECT asset_id, fiscal_year, period, d AS accepted_date FROM top
         UNION ALL SELECT id, {SENTINEL_YEAR}, '{SENTINEL_PERIOD}', TIMESTAMP '{SENTINEL_DATE}' FROM assets)),
er AS (SELECT symbol, date_text, sum(eps_actual) AS eps_actual FROM er0 WHERE date_text <> '' GROUP BY 1, 2),
ein AS (SELECT a.id AS asset_id, CAST(date_text AS TIMESTAMP) AS accepted_date, CAST(date_text AS DATE) AS ref_date, eps_actual
        FROM {sql_top("er", "symbol", "date_text DESC", EARNING_ROWS)} x JOIN assets a USING (symbol)),
{sql_align("ein", "rp", ALIGN_AS_OF_TEXT, ["eps_actual"], ["eps_actual", "ref_date"], "e")},
prices AS (SELECT a.id AS asset_id, o_orderdate AS day, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents
           FROM orders JOIN customer ON c_custkey = o_custkey JOIN assets a ON a.symbol = c_name
           WHERE o_orderdate >= TIMESTAMP '{LEDGER_AS_OF - dt.timedelta(days=PRICE_DAYS)}' GROUP BY 1, 2),
cpi AS (SELECT * FROM series WHERE series_id = '1-URGENT' AND month IS NOT NULL AND year BETWEEN {LEDGER_AS_OF.year - CPI_YEARS} AND {LEDGER_AS_OF.year})"""


@register("update_all", f"""{SQL_LEDGER}
SELECT 'cpi' AS "table", count(*) AS rows, CAST(sum(CAST(round(series_value * 100) AS BIGINT)) AS BIGINT) AS total FROM cpi
UNION ALL SELECT 'asset', count(*), CAST(sum(id) AS BIGINT) FROM assets
UNION ALL SELECT 'equity_profile', count(*), CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS BIGINT) FROM assets JOIN customer ON c_name = symbol
UNION ALL SELECT 'reporting_period', count(*), CAST(sum(id * 100000 + asset_id + fiscal_year) AS BIGINT) FROM rp
UNION ALL SELECT 'income_statement', count(*), CAST(sum(revenue) AS BIGINT) FROM top
UNION ALL SELECT 'balance_sheet_statement', count(*), CAST(sum(revenue) AS BIGINT) FROM top
UNION ALL SELECT 'cash_flow_statement', count(*), CAST(sum(net_income) AS BIGINT) FROM top
UNION ALL SELECT 'earning', count(*), CAST(sum(reporting_period_id * 1000 + CAST(round(eps_actual) AS BIGINT)) AS BIGINT) FROM aligned_e
UNION ALL SELECT 'eod_price', count(*), CAST(sum(cents) AS BIGINT) FROM prices""")
def q_update_all(spark, d):
    """The published tables of the ledger after a run of all updates over a landing built from the tables."""
    root = fresh_folder(spark)
    landing = f"{root}/landing"
    with scratch(spark):  # the largest first, while nothing else lies there
        land(earning_rows(spark, d).filter("date <> ''").groupBy("symbol", "date").agg(F.sum("eps_actual").alias("eps_actual")), landing, "earnings")
        land(price_rows(spark, d), landing, "historical_price")
        statements = as_stored(statement_rows(spark, d))
        land(statements, landing, "income_statement")
        land(statements.withColumn("total_assets", F.col("revenue")), landing, "balance_sheet_statement")
        land(statements.withColumn("free_cash_flow", F.col("net_income")), landing, "cash_flow_statement")
    land(screener_rows(spark, d), landing, "screener")
    land(search_rows(spark, d), landing, "search")
    land(profile_rows(spark, d), landing, "profile")
    docs = series_documents(spark, d)
    docs.withColumn("Results", F.struct(F.transform("Results.series", lambda s: F.struct(
        F.when(s["seriesID"] == "1-URGENT", CPI_SERIES_ID).otherwise(s["seriesID"]).alias("seriesID"), s["data"].alias("data"))).alias("series"))).write.json(f"{landing}/cpi")
    store = SnapshotStore(spark, f"{root}/store")
    store.commit("asset_cat", spark.createDataFrame([(1, ASSET_CAT, ASSET_SUB_CAT)], TABLE_SCHEMAS["asset_cat"]))
    ledger = Ledger(spark, store, landing, LEDGER_AS_OF, json_lines=True)
    ledger.update_all()
    cents = lambda c: F.round(F.col(c) * 100).cast("bigint")
    totals = {"cpi": cents("series_value"), "asset": F.col("id"), "equity_profile": F.col("mkt_cap"),
              "reporting_period": F.col("id") * 100000 + F.col("asset_id") + F.col("fiscal_year"), "income_statement": F.col("revenue"),
              "balance_sheet_statement": F.col("total_assets"), "cash_flow_statement": F.col("free_cash_flow"),
              "earning": F.col("reporting_period_id") * 1000 + F.round("eps_actual").cast("bigint"), "eod_price": cents("close")}
    out = None
    for name, total in totals.items():
        one = ledger.table(name).agg(F.count(F.lit(1)).alias("rows"), F.sum(total).alias("total")).select(F.lit(name).alias("table"), "rows", "total")
        out = one if out is None else out.unionByName(one)
    return out
