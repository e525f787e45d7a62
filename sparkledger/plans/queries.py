"""Driver queries: every operator exercised on the given test tables.

Each entry pairs a Spark plan built from the library's operators with an
ANSI SQL statement (DuckDB dialect) computing the same result from the same
parquet tables.  Scenarios are derived from the tables themselves, never from
id subsets: e.g. the *stored* orders table is everything dated before 2000,
the *incoming* payload is a re-fetch of everything dated from 1999 on, with
revised prices, so the two overlap for a year.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkledger.functions import (
    lenient_date,
    lenient_double,
    lenient_long,
    lenient_utc_timestamp,
    snake_columns,
)
from sparkledger.operators import (
    PayloadStatusError,
    add_constants,
    align_events,
    append,
    apply_schema,
    asset_map,
    blank_to_null,
    common_columns,
    keep_last,
    key_metrics,
    key_subset,
    lookup_scalar,
    map_values,
    new_rows,
    nth_latest,
    observed,
    reattach_key,
    require_status,
    split_null_keys,
    stack,
    stack_diagonal,
    to_period_id,
    top_k_per_key,
    update_non_null,
    updated_rows,
    upsert,
    with_row_index,
)
from sparkledger.plans.pipelines import (
    apply_update,
    asset_payload,
    cpi_payload,
    earning_payload,
    future_placeholders,
    period_payload,
    price_payload,
    profile_payload,
    statement_payload,
    typed_statement_rows,
    unmapped,
)
from sparkledger.schemas import (
    CPI_SERIES_NAME,
    EARNING_ROWS,
    PAYLOAD_OK_STATUS,
    PRICE_DAYS,
    SCREEN_LIMIT,
    SCREEN_MIN_MKT_CAP,
    STATEMENT_PERIODS,
    TABLE_KEYS,
    TABLE_SCHEMAS,
    SENTINEL_DATE,
    SENTINEL_PERIOD,
    SENTINEL_YEAR,
)
from sparkledger.session import staged
from sparkledger.sources import (
    FETCHED,
    describe_columns,
    explode_series,
    fan_out,
    parse_payload_column,
    read_table,
    records_to_df,
    screen,
    since,
    small_rows,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def ntz(text: str) -> Column:
    return F.expr(f"TIMESTAMP_NTZ '{text}'")


# ---------------------------------------------------------------------------
# Shared scenario: stored orders (before 2000, with a surrogate id) and an
# incoming re-fetch (from 1999 on) whose payload is text-typed for the price,
# revises open orders' prices, blanks the status of partial orders and
# carries an extra column the table does not have.
# ---------------------------------------------------------------------------
STORED_BEFORE = "2000-01-01 00:00:00"
FETCH_FROM = "1999-01-01 00:00:00"


def stored_orders(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.filter(F.col("o_orderdate") < ntz(STORED_BEFORE)).withColumn("id", F.col("o_orderkey") + 1)


def incoming_orders(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").filter(F.col("o_orderdate") >= ntz(FETCH_FROM))
    price = F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice") + 100.0).otherwise(F.col("o_totalprice"))
    return o.select(
        "o_orderkey",
        "o_custkey",
        F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        price.cast("string").alias("o_totalprice"),
        "o_orderdate",
        "o_orderpriority",
        F.lit("api").alias("o_source"),
    )


SQL_SCENARIO = f"""
stored AS (
  SELECT *, o_orderkey + 1 AS id FROM orders WHERE o_orderdate < TIMESTAMP '{STORED_BEFORE}'),
incoming AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS o_orderstatus,
         CAST(CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 100.0 ELSE o_totalprice END AS VARCHAR)
           AS o_totalprice,
         o_orderdate, o_orderpriority, 'api' AS o_source
  FROM orders WHERE o_orderdate >= TIMESTAMP '{FETCH_FROM}')"""

INCOMING_TYPED = """o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice,
  o_orderdate, o_orderpriority, o_source"""


# ---------------------------------------------------------------------------
# Scans and column descriptions
# ---------------------------------------------------------------------------
@register("scan_table", "SELECT * FROM orders")
def q_scan_table(spark, d):
    return table(spark, d, "orders")


ORDERS_COLUMNS = [
    ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
    ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string"),
]


@register("describe_columns", "\nUNION ALL\n".join(
    f"SELECT CAST({i + 1} AS BIGINT) AS ordinal, '{c}' AS column_name, '{t}' AS data_type, "
    f"count({c}) AS non_null FROM orders"
    for i, (c, t) in enumerate(ORDERS_COLUMNS)
))
def q_describe_columns(spark, d):
    return describe_columns(table(spark, d, "orders"))


# ---------------------------------------------------------------------------
# Names, blanks, casts
# ---------------------------------------------------------------------------
@register("snake_case", """
SELECT o_orderkey AS o_order_key, o_custkey AS o_cust_key, o_orderstatus AS order_status_cd,
       o_totalprice AS total_price_usd, o_orderdate AS o_orderdate, o_orderpriority AS priority_text1code
FROM orders""")
def q_snake_case(spark, d):
    camel = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("oOrderKey"),
        F.col("o_custkey").alias("oCustKey"),
        F.col("o_orderstatus").alias("orderStatusCD"),
        F.col("o_totalprice").alias("totalPriceUSD"),
        F.col("o_orderdate"),
        F.col("o_orderpriority").alias("priorityText1Code"),
    )
    return snake_columns(camel)


@register("empty_to_null", """
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS o_orderpriority,
       o_totalprice
FROM orders""")
def q_empty_to_null(spark, d):
    o = table(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.lit("")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("")).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        "o_totalprice",
    )
    return blank_to_null(o)


@register("apply_schema", """
SELECT l_orderkey, l_partkey, CAST(l_suppkey AS INTEGER) AS l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       CAST(l_quantity AS BIGINT) AS l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
       CAST(l_shipdate AS DATE) AS l_shipdate
FROM lineitem""")
def q_apply_schema(spark, d):
    template = "l_suppkey int, l_linenumber bigint, l_quantity bigint, l_shipdate date, l_comment string"
    from pyspark.sql.types import _parse_datatype_string

    return apply_schema(table(spark, d, "lineitem"), _parse_datatype_string(template))


@register("lenient_casts", r"""
WITH t AS (
  SELECT event_id, event_type, ts, value,
         CASE WHEN event_type = 'error' THEN json_extract_string(props, '$.k') || '.5'
              WHEN event_type = 'signup' THEN ' ' || json_extract_string(props, '$.k') || ' '
              ELSE json_extract_string(props, '$.k') END AS k_text,
         CASE WHEN event_type = 'view' THEN strftime(ts, '%Y-%m-%d')
              WHEN event_type = 'click' THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
              WHEN event_type = 'purchase' THEN ''
              WHEN event_type = 'error' THEN 'n/a'
              ELSE strftime(ts, '%Y-%m-') || '99' END AS day_text,
         CASE WHEN event_type = 'purchase' THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS value_text
  FROM events)
SELECT event_id,
       CASE WHEN regexp_full_match(trim(k_text), '[+-]?[0-9]+') THEN CAST(trim(k_text) AS BIGINT) END AS k_long,
       TRY_CAST(CASE WHEN regexp_full_match(day_text, '[0-9]{4}-[0-9]{2}-[0-9]{2}( .*)?') THEN substr(day_text, 1, 10) END AS DATE)
         AS day_date,
       TRY_CAST(CASE WHEN regexp_full_match(day_text, '[0-9]{4}-[0-9]{2}-[0-9]{2}( [0-9:]+)?') THEN day_text END AS TIMESTAMP)
         AS day_ts,
       TRY_CAST(value_text AS DOUBLE) AS value_double
FROM t""")
def q_lenient_casts(spark, d):
    e = table(spark, d, "events")
    k = F.get_json_object("props", "$.k")
    k_text = (
        F.when(F.col("event_type") == "error", F.concat(k, F.lit(".5")))
        .when(F.col("event_type") == "signup", F.concat(F.lit(" "), k, F.lit(" ")))
        .otherwise(k)
    )
    day_text = (
        F.when(F.col("event_type") == "view", F.date_format("ts", "yyyy-MM-dd"))
        .when(F.col("event_type") == "click", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("event_type") == "purchase", F.lit(""))
        .when(F.col("event_type") == "error", F.lit("n/a"))
        .otherwise(F.concat(F.date_format("ts", "yyyy-MM-"), F.lit("99")))
    )
    value_text = F.when(F.col("event_type") == "purchase", F.lit("n/a")).otherwise(F.col("value").cast("string"))
    t = e.select("event_id", k_text.alias("k_text"), day_text.alias("day_text"), value_text.alias("value_text"))
    return t.select(
        "event_id",
        lenient_long("k_text").alias("k_long"),
        lenient_date("day_text").alias("day_date"),
        lenient_utc_timestamp("day_text").cast("timestamp_ntz").alias("day_ts"),
        lenient_double("value_text").alias("value_double"),
    )


# ---------------------------------------------------------------------------
# P4, P5, U1, U2
# ---------------------------------------------------------------------------
@register("common_columns", """
SELECT 'old' AS side, c_custkey, c_name, c_acctbal, c_mktsegment FROM customer
UNION ALL
SELECT 'new', c_custkey, c_name, c_acctbal + 1.0, c_mktsegment FROM customer""")
def q_common_columns(spark, d):
    stored = table(spark, d, "customer")
    incoming = stored.select(
        "c_mktsegment", (F.col("c_acctbal") + 1.0).alias("c_acctbal"), "c_name", "c_custkey",
        F.lit("x").alias("c_extra"),
    )
    cols, old, new = common_columns(stored.columns, stored, incoming, keys="c_custkey")
    return old.withColumn("side", F.lit("old")).unionByName(new.withColumn("side", F.lit("new")))


@register("add_constants", """
SELECT *, 'tpch' AS source, CAST(1 AS BIGINT) AS version, TRUE AS is_current, CAST(NULL AS BIGINT) AS parent_id
FROM customer""")
def q_add_constants(spark, d):
    return add_constants(
        table(spark, d, "customer"),
        {"source": "tpch", "version": (1, "bigint"), "is_current": True, "parent_id": (None, "bigint")},
    )


@register("union_diagonal", """
SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment,
       CAST(NULL AS INTEGER) AS nation FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_acctbal, NULL, s_nationkey FROM supplier""")
def q_union_diagonal(spark, d):
    c = table(spark, d, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"),
    )
    s = table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation"),
    )
    return stack_diagonal([c, s])


@register("union_relaxed", """
SELECT c_custkey AS key, CAST(c_nationkey AS BIGINT) AS nation, c_acctbal AS balance, c_mktsegment AS label
FROM customer
UNION ALL
SELECT s_suppkey, CAST(s_nationkey AS BIGINT), CAST(CAST(floor(s_acctbal) AS INTEGER) AS DOUBLE),
       CAST(s_nationkey AS VARCHAR)
FROM supplier""")
def q_union_relaxed(spark, d):
    c = table(spark, d, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("label"),
    )
    s = table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_nationkey").cast("bigint").alias("nation"),
        F.floor("s_acctbal").cast("int").alias("balance"), F.col("s_nationkey").alias("label"),
    )
    # int label meets string label -> string; int balance meets double -> double
    return stack([c, s.withColumn("label", F.col("label").cast("string"))])


# ---------------------------------------------------------------------------
# Diff and write
# ---------------------------------------------------------------------------
@register("new_rows", f"""
WITH {SQL_SCENARIO}
SELECT {INCOMING_TYPED} FROM incoming i
WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.o_orderkey = i.o_orderkey)""")
def q_new_rows(spark, d):
    return new_rows(stored_orders(spark, d), incoming_orders(spark, d), "o_orderkey")


@register("updated_rows", f"""
WITH {SQL_SCENARIO}
SELECT {INCOMING_TYPED} FROM incoming i
WHERE EXISTS (SELECT 1 FROM stored s WHERE s.o_orderkey = i.o_orderkey)""")
def q_updated_rows(spark, d):
    return updated_rows(stored_orders(spark, d), incoming_orders(spark, d), "o_orderkey")


@register("append_rows", f"""
WITH {SQL_SCENARIO}
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, id FROM stored
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DOUBLE), o_orderdate, o_orderpriority,
       CAST(NULL AS BIGINT)
FROM incoming i WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.o_orderkey = i.o_orderkey)""")
def q_append_rows(spark, d):
    stored = stored_orders(spark, d)
    return append(stored, new_rows(stored, incoming_orders(spark, d), "o_orderkey"))


@register("upsert_snapshot", f"""
WITH {SQL_SCENARIO},
inc AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice, o_orderdate
        FROM incoming),
merged AS (
  SELECT coalesce(s.o_orderkey, i.o_orderkey) AS o_orderkey,
         CASE WHEN i.o_orderkey IS NOT NULL THEN i.o_custkey ELSE s.o_custkey END AS o_custkey,
         CASE WHEN i.o_orderkey IS NOT NULL THEN i.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
         CASE WHEN i.o_orderkey IS NOT NULL THEN i.o_totalprice ELSE s.o_totalprice END AS o_totalprice,
         CASE WHEN i.o_orderkey IS NOT NULL THEN i.o_orderdate ELSE s.o_orderdate END AS o_orderdate,
         s.o_orderpriority AS o_orderpriority,
         s.id AS id
  FROM stored s FULL OUTER JOIN inc i ON s.o_orderkey = i.o_orderkey)
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       CASE WHEN id IS NOT NULL THEN id
            ELSE (SELECT max(id) FROM stored)
                 + row_number() OVER (PARTITION BY id IS NULL ORDER BY o_orderkey) END AS id
FROM merged""")
def q_upsert_snapshot(spark, d):
    # The payload lacks the priority column: stored values are kept, new rows
    # get null; a null status in the payload overwrites the stored one.
    incoming = incoming_orders(spark, d).drop("o_orderpriority", "o_source")
    return upsert(stored_orders(spark, d), incoming, "o_orderkey", pk="id")


@register("reattach_pk", f"""
WITH {SQL_SCENARIO}
SELECT i.o_orderkey, i.o_custkey, i.o_orderstatus, CAST(i.o_totalprice AS DOUBLE) AS o_totalprice,
       i.o_orderdate, i.o_orderpriority, i.o_source, s.id
FROM incoming i JOIN stored s ON s.o_orderkey = i.o_orderkey""")
def q_reattach_pk(spark, d):
    stored = stored_orders(spark, d)
    return reattach_key(updated_rows(stored, incoming_orders(spark, d), "o_orderkey"), stored, "o_orderkey", "id")


@register("update_join", f"""
WITH {SQL_SCENARIO}
SELECT s.o_orderkey, s.o_custkey, coalesce(i.o_orderstatus, s.o_orderstatus) AS o_orderstatus,
       coalesce(CAST(i.o_totalprice AS DOUBLE), s.o_totalprice) AS o_totalprice, s.o_orderdate,
       s.o_orderpriority, s.id
FROM stored s LEFT JOIN incoming i USING (o_orderkey)""")
def q_update_join(spark, d):
    stored = stored_orders(spark, d)
    right = apply_schema(incoming_orders(spark, d), stored).select("o_orderkey", "o_orderstatus", "o_totalprice")
    return update_non_null(stored, right, "o_orderkey")


# ---------------------------------------------------------------------------
# Key translation
# ---------------------------------------------------------------------------
def customer_assets(spark: SparkSession, d: str) -> DataFrame:
    """Customers as assets: symbol = name, category = nation, two flags."""
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("symbol"),
        F.col("c_nationkey").cast("bigint").alias("asset_cat_id"),
        (F.col("c_acctbal") > 0).alias("has_financials"),
        (F.col("c_mktsegment") != "AUTOMOBILE").alias("has_chart"),
    )


def nation_categories(spark: SparkSession, d: str) -> DataFrame:
    """Nations as asset categories: cat = region name, sub_cat = nation name."""
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").cast("bigint").alias("id"), F.col("r_name").alias("cat"), F.col("n_name").alias("sub_cat")
    )


SQL_CATS = """cats AS (SELECT CAST(n_nationkey AS BIGINT) AS id, r_name AS cat, n_name AS sub_cat
             FROM nation JOIN region ON n_regionkey = r_regionkey)"""


@register("value_map", """
WITH m AS (SELECT n_name, n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey
           WHERE r_name <> 'MIDDLE EAST')
SELECT c_custkey, n.n_name AS symbol, c_acctbal, CAST(m.n_nationkey AS BIGINT) AS nation_id
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN m ON m.n_name = n.n_name""")
def q_value_map(spark, d):
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    payload = c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", F.col("n_name").alias("symbol"), "c_acctbal")
    mapping = nation_categories(spark, d).filter(F.col("cat") != "MIDDLE EAST")
    return map_values(payload, "symbol", mapping, key="sub_cat", value="id", out="nation_id")


SQL_URGENT_2001 = """SELECT o_custkey FROM orders
  WHERE o_orderpriority = '1-URGENT' AND o_orderdate >= TIMESTAMP '2001-01-01'"""


@register("key_subset", f"""
SELECT c_name AS symbol, c_custkey AS id FROM customer WHERE c_custkey IN ({SQL_URGENT_2001})""")
def q_key_subset(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    wanted = (
        o.filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderdate") >= ntz("2001-01-01 00:00:00")))
        .join(c, o.o_custkey == c.c_custkey)
        .select(F.col("c_name").alias("symbol"))
    )
    return key_subset(customer_assets(spark, d).select("symbol", "id"), wanted, "symbol")


@register("fk_filtered_map", """
SELECT c_name AS symbol, c_custkey AS id
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE r_name = 'AMERICA' AND c_acctbal > 0""")
def q_fk_filtered_map(spark, d):
    return asset_map(customer_assets(spark, d), nation_categories(spark, d), "has_financials", cat="AMERICA")


@register("lookup_scalar", f"""
WITH {SQL_CATS},
cat AS (SELECT id FROM cats WHERE cat = 'AMERICA' AND sub_cat = 'NATION_1' LIMIT 1)
SELECT c_custkey, c_name, (SELECT id FROM cat) AS asset_cat_id
FROM customer WHERE c_nationkey = (SELECT id FROM cat)""")
def q_lookup_scalar(spark, d):
    cats = nation_categories(spark, d)
    cat_id = lookup_scalar(cats.filter((F.col("cat") == "AMERICA") & (F.col("sub_cat") == "NATION_1")), "id")
    c = table(spark, d, "customer").filter(F.col("c_nationkey") == F.lit(cat_id))
    return add_constants(c.select("c_custkey", "c_name"), {"asset_cat_id": (cat_id, "bigint")})


def order_periods(o: DataFrame) -> DataFrame:
    """Orders keyed like statements: asset, fiscal year, quarter label."""
    return o.withColumns({
        "asset_id": F.col("o_custkey"),
        "fiscal_year": F.year("o_orderdate").cast("bigint"),
        "period": F.concat(F.lit("Q"), F.quarter("o_orderdate").cast("string")),
    })


@register("composite_key_map", """
WITH p AS (SELECT min(o_orderkey) AS id, o_custkey AS asset_id, year(o_orderdate) AS fiscal_year,
                  'Q' || quarter(o_orderdate) AS period
           FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 2, 3, 4)
SELECT o.o_orderkey, o.o_totalprice AS revenue, p.id AS reporting_period_id
FROM orders o JOIN p ON p.asset_id = o.o_custkey AND p.fiscal_year = year(o.o_orderdate)
                    AND p.period = 'Q' || quarter(o.o_orderdate)""")
def q_composite_key_map(spark, d):
    o = order_periods(table(spark, d, "orders"))
    periods = (
        o.filter(F.col("o_orderstatus").isin("F", "O"))
        .groupBy("asset_id", "fiscal_year", "period")
        .agg(F.min("o_orderkey").alias("id"))
    )
    payload = o.select("o_orderkey", "asset_id", "fiscal_year", "period", F.col("o_totalprice").alias("revenue"))
    return to_period_id(payload, periods)


# ---------------------------------------------------------------------------
# A1, A2, A3/D3
# ---------------------------------------------------------------------------
@register("distinct_keys", "SELECT DISTINCT o_custkey FROM orders")
def q_distinct_keys(spark, d):
    return table(spark, d, "orders").select("o_custkey").distinct()


@register("load_metrics", """
SELECT count(*) AS rows, count(l.doc_id) AS labelled, count(*) FILTER (WHERE l.quality IS NULL) AS unlabelled,
       count(*) FILTER (WHERE l.toxic = 1) AS toxic
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def q_load_metrics(spark, d):
    docs, labels = table(spark, d, "documents").select("doc_id"), table(spark, d, "labels")
    joined = docs.join(labels.withColumn("_l", F.col("doc_id")), "doc_id", "left")
    return joined.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("_l").alias("labelled"),
        F.count_if(F.col("quality").isNull()).alias("unlabelled"),
        F.count_if(F.col("toxic") == 1).alias("toxic"),
    )


@register("reject_nulls", """
SELECT d.doc_id, d.lang, d.source, l.quality
FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.quality IS NULL""")
def q_reject_nulls(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source")
    joined = docs.join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    _, rejects = split_null_keys(joined, "quality")
    return rejects


# ---------------------------------------------------------------------------
# ordering
# ---------------------------------------------------------------------------
AS_OF_TEXT = "2002-01-01 00:00:00"


@register("nth_latest", f"""
WITH r AS (SELECT o_custkey, o_orderdate,
                  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC) AS rn
           FROM orders),
s AS (SELECT o_custkey, max(CASE WHEN rn = 2 THEN o_orderdate END) AS d, count(*) AS n
      FROM r WHERE rn <= 2 GROUP BY o_custkey)
SELECT c.c_custkey AS o_custkey, CASE WHEN s.n >= 2 THEN s.d ELSE TIMESTAMP '{AS_OF_TEXT}' END AS latest_report
FROM customer c LEFT JOIN s ON s.o_custkey = c.c_custkey""")
def q_nth_latest(spark, d):
    o = table(spark, d, "orders")
    second = nth_latest(o, "o_custkey", [("o_orderdate", "desc_nulls_first"), ("o_orderkey", "desc")], 2,
                        "o_orderdate", out="second")
    assets = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return assets.join(second, "o_custkey", "left").select(
        "o_custkey",
        F.when(F.col("_have") >= 2, F.col("second")).otherwise(ntz(AS_OF_TEXT)).alias("latest_report"),
    )


@register("topk_per_key", """
SELECT o_custkey, o_orderkey, o_orderdate, rank FROM (
  SELECT o_custkey, o_orderkey, o_orderdate,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rank
  FROM orders) WHERE rank <= 3""")
def q_topk_per_key(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return top_k_per_key(o, "o_custkey", [("o_orderdate", "desc"), ("o_orderkey", "asc")], 3, rank_col="rank")


@register("keep_last", """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate ASC NULLS LAST, o_orderkey DESC) AS rn
  FROM orders) WHERE rn = 1""")
def q_keep_last(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return keep_last(o, "o_custkey", [("o_orderdate", "desc_nulls_first"), ("o_orderkey", "asc")])


@register("row_index", """
SELECT o_orderkey, o_orderdate,
       row_number() OVER (ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey) - 1 AS row_idx
FROM orders""")
def q_row_index(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return with_row_index(o, [("o_orderdate", "desc_nulls_first"), ("o_orderkey", "asc")], "row_idx")


@register("screener", f"""
SELECT c_name AS symbol, c_acctbal * 1000000.0 AS market_cap,
       CASE WHEN r_name = 'AMERICA' THEN 'US' ELSE 'XX' END AS country,
       c_mktsegment = 'AUTOMOBILE' AS is_etf, c_mktsegment = 'FURNITURE' AS is_fund,
       c_mktsegment <> 'HOUSEHOLD' AS is_actively_trading
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE c_acctbal * 1000000.0 > 1000000000 AND r_name = 'AMERICA'
  AND c_mktsegment NOT IN ('AUTOMOBILE', 'FURNITURE', 'HOUSEHOLD')
ORDER BY market_cap DESC, symbol LIMIT {SCREEN_LIMIT}""")
def q_screener(spark, d):
    c, n, r = table(spark, d, "customer"), table(spark, d, "nation"), table(spark, d, "region")
    rows = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("c_name").alias("symbol"),
        (F.col("c_acctbal") * 1000000.0).alias("market_cap"),
        F.when(F.col("r_name") == "AMERICA", "US").otherwise("XX").alias("country"),
        (F.col("c_mktsegment") == "AUTOMOBILE").alias("is_etf"),
        (F.col("c_mktsegment") == "FURNITURE").alias("is_fund"),
        (F.col("c_mktsegment") != "HOUSEHOLD").alias("is_actively_trading"),
    )
    return screen(rows, SCREEN_MIN_MKT_CAP, SCREEN_LIMIT, country="US")


RANGE_AS_OF = dt.date(2001, 8, 1)


@register("recent_range", f"""
SELECT o_orderkey, o_custkey, o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '{RANGE_AS_OF - dt.timedelta(days=PRICE_DAYS)}'""")
def q_recent_range(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return since(o, "o_orderdate", RANGE_AS_OF, PRICE_DAYS)


# ---------------------------------------------------------------------------
# Nested series; S3/F10 JSON; S4 fan-out
# ---------------------------------------------------------------------------
def series_documents(spark: SparkSession, d: str) -> DataFrame:
    """Series payload documents built from orders: one series per priority,
    monthly totals as text, ``-`` for December (not yet published) and an
    ``S`` period code for the low-priority series.  One document per
    (series, year); each holds at most 12 observations."""
    o = table(spark, d, "orders")
    monthly = o.groupBy(
        F.col("o_orderpriority").alias("sid"), F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m")
    ).agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"))
    obs = F.struct(
        F.col("y").cast("string").alias("year"),
        F.concat(F.when(F.col("sid") == "5-LOW", "S").otherwise("M"), F.lpad(F.col("m").cast("string"), 2, "0")).alias("period"),
        F.date_format(F.make_date("y", "m", F.lit(1)), "MMMM").alias("periodName"),
        F.when(F.col("m") == 12, "-").otherwise((F.col("cents") / F.lit(100.0)).cast("string")).alias("value"),
    )
    per_doc = monthly.groupBy("sid", "y").agg(F.collect_list(obs).alias("data"))
    return per_doc.select(
        F.lit(PAYLOAD_OK_STATUS).alias("status"),
        F.struct(F.array(F.struct(F.col("sid").alias("seriesID"), F.col("data"))).alias("series")).alias("Results"),
    )


SQL_SERIES = """
m AS (SELECT o_orderpriority AS sid, year(o_orderdate) AS y, month(o_orderdate) AS mo,
             sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents
      FROM orders GROUP BY 1, 2, 3),
t AS (SELECT sid, y, mo,
             CASE WHEN sid = '5-LOW' THEN 'S' ELSE 'M' END || lpad(CAST(mo AS VARCHAR), 2, '0') AS period,
             strftime(make_date(y, mo, 1), '%B') AS pname,
             CASE WHEN mo = 12 THEN '-' ELSE CAST(CAST(cents AS DOUBLE) / 100.0 AS VARCHAR) END AS vtext
      FROM m),
series AS (
  SELECT sid AS series_id, CAST(y AS BIGINT) AS year, TRY_CAST(trim(period, 'M') AS BIGINT) AS month,
         pname AS period_name, TRY_CAST(vtext AS DOUBLE) AS series_value
  FROM t WHERE TRY_CAST(vtext AS DOUBLE) IS NOT NULL)"""


@register("series_parse", f"""
WITH {SQL_SERIES}
SELECT *, CAST(year AS VARCHAR) || '-' || CAST(month AS VARCHAR) || '-14' AS ref_date FROM series""")
def q_series_parse(spark, d):
    docs = series_documents(spark, d)
    require_status(docs, PAYLOAD_OK_STATUS)
    return explode_series(docs)


@register("json_payload", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def q_json_payload(spark, d):
    return parse_payload_column(table(spark, d, "events"), "props", "k bigint", keep=["event_id"])


@register("fanout_keys", """
SELECT event_id, user_id, event_type, value FROM events
WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 200)""")
def q_fanout_keys(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    buyers = e.filter((F.col("event_type") == "purchase") & (F.col("value") > 200)).select("user_id")
    return fan_out(e, "user_id", buyers)


# ---------------------------------------------------------------------------
# SQL builders for the oracle side of the pipelines
# ---------------------------------------------------------------------------
def sql_first_load(rows: str, keys: list[str], cols: list[str], pk: str = "id") -> str:
    """Rows loaded into an empty table: ids 1.. in key order."""
    return f"SELECT row_number() OVER (ORDER BY {', '.join(keys)}) AS {pk}, {', '.join(cols)} FROM {rows}"


def sql_upsert(stored: str, incoming: str, keys: list[str], cols: list[str], inc_cols: list[str],
               pk: str | None = None) -> str:
    """Next snapshot: incoming wins on shared columns, absent columns kept,
    new keys get ids after the stored maximum in key order."""
    on = " AND ".join(f"s.{k} = i.{k}" for k in keys)
    sel = []
    for c in cols:
        if c in keys:
            sel.append(f"coalesce(s.{c}, i.{c}) AS {c}")
        elif c in inc_cols:
            sel.append(f"CASE WHEN i._in THEN i.{c} ELSE s.{c} END AS {c}")
        else:
            sel.append(f"s.{c} AS {c}")
    pk_sel = f", s.{pk} AS _pk" if pk else ""
    merged = (f"SELECT {', '.join(sel)}{pk_sel} FROM {stored} s FULL OUTER JOIN "
              f"(SELECT {', '.join(inc_cols)}, TRUE AS _in FROM {incoming}) i ON {on}")
    if not pk:
        return merged
    return (f"SELECT coalesce(_pk, (SELECT coalesce(max({pk}), 0) FROM {stored}) + row_number() OVER "
            f"(PARTITION BY _pk IS NULL ORDER BY {', '.join(keys)})) AS {pk}, {', '.join(cols)} FROM ({merged})")


def sql_align(ev: str, periods: str, as_of: str, tiebreak: list[str], payload_cols: list[str], tag: str) -> str:
    """CTEs (suffix ``tag``) aligning ``ev`` (asset_id, accepted_date, payload)
    with ``periods`` (id, asset_id, accepted_date); result CTE ``aligned_{tag}``."""
    tb_asc = ", ".join(tiebreak)
    tb_desc = ", ".join(f"{c} DESC" for c in tiebreak)
    pc = ", ".join(payload_cols)
    return f"""
pr_{tag} AS (SELECT asset_id, accepted_date,
             row_number() OVER (PARTITION BY asset_id ORDER BY accepted_date DESC NULLS FIRST, id DESC) AS rn
             FROM {periods}),
cut_{tag} AS (SELECT asset_id,
              CASE WHEN count(*) FILTER (WHERE rn <= 2) >= 2 THEN max(CASE WHEN rn = 2 THEN accepted_date END)
                   ELSE TIMESTAMP '{as_of}' END + INTERVAL 14 DAY AS cut
              FROM pr_{tag} GROUP BY asset_id),
e_{tag} AS (SELECT ev.*, asset_id IS NOT NULL AND coalesce(ev.accepted_date <= CASE WHEN c.asset_id IS NOT NULL
                 THEN c.cut ELSE TIMESTAMP '{as_of}' + INTERVAL 14 DAY END, FALSE) AS elig
            FROM {ev} ev LEFT JOIN cut_{tag} c USING (asset_id)),
er_{tag} AS (SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY accepted_date DESC NULLS FIRST, {tb_asc}) AS seq
             FROM e_{tag} WHERE elig),
pe_{tag} AS (SELECT p.id, p.asset_id,
                    row_number() OVER (PARTITION BY p.asset_id ORDER BY p.accepted_date DESC NULLS FIRST, p.id DESC) AS seq
             FROM {periods} p JOIN cut_{tag} c USING (asset_id) WHERE p.accepted_date <= c.cut),
st_{tag} AS (SELECT er.asset_id, er.accepted_date, {", ".join("er." + c for c in payload_cols)}, pe.id AS matched
             FROM er_{tag} er JOIN pe_{tag} pe USING (asset_id, seq)
             UNION ALL
             SELECT asset_id, accepted_date, {pc}, CAST(NULL AS BIGINT) FROM e_{tag} WHERE NOT elig),
ph_{tag} AS (SELECT asset_id, max(id) AS ph_id FROM {periods}
             WHERE accepted_date = TIMESTAMP '{SENTINEL_DATE}' GROUP BY asset_id),
res_{tag} AS (SELECT st.*, coalesce(CASE WHEN matched IS NULL OR st.accepted_date = TIMESTAMP '{SENTINEL_DATE}'
                                         THEN ph.ph_id END, matched) AS reporting_period_id
              FROM st_{tag} st LEFT JOIN ph_{tag} ph USING (asset_id)),
aligned_{tag} AS (SELECT reporting_period_id, {pc} FROM (
    SELECT *, row_number() OVER (PARTITION BY reporting_period_id
                                 ORDER BY accepted_date ASC NULLS LAST, {tb_desc}) AS k
    FROM res_{tag} WHERE reporting_period_id IS NOT NULL) WHERE k = 1)"""


# ---------------------------------------------------------------------------
# T4 placeholders (U2) and J8 alignment on orders / lineitem
# ---------------------------------------------------------------------------
ALIGN_AS_OF = dt.datetime(2002, 1, 1)
ALIGN_AS_OF_TEXT = "2002-01-01 00:00:00"


def order_period_map(spark: SparkSession, d: str) -> DataFrame:
    """Periods: one per order (id = order key, asset = customer, dated by the
    order), plus a placeholder for each customer outside HOUSEHOLD."""
    o = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("asset_id"), F.col("o_orderdate").alias("accepted_date")
    )
    c = table(spark, d, "customer").filter(F.col("c_mktsegment") != "HOUSEHOLD")
    ph = c.select((F.lit(-1) - F.col("c_custkey")).alias("id"), F.col("c_custkey").alias("asset_id"),
                  ntz(f"{SENTINEL_DATE} 00:00:00").alias("accepted_date"))
    return o.unionByName(ph)


SQL_ORDER_PERIODS = f"""
periods AS (SELECT o_orderkey AS id, o_custkey AS asset_id, o_orderdate AS accepted_date FROM orders
            UNION ALL
            SELECT -1 - c_custkey, c_custkey, TIMESTAMP '{SENTINEL_DATE}' FROM customer
            WHERE c_mktsegment <> 'HOUSEHOLD')"""

SHIP_NULL_FROM = "2001-08-01 00:00:00"


def line_events(spark: SparkSession, d: str) -> DataFrame:
    """Events: one per (order, line), dated by the ship date (null for lines
    shipped from August 2001 on), owned by the order's customer."""
    li = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.max("l_shipdate").alias("ship"), F.sum("l_quantity").alias("eps_actual"))
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    ev = li.join(o, li.l_orderkey == o.o_orderkey)
    date = F.when(F.col("ship") >= ntz(SHIP_NULL_FROM), F.lit(None)).otherwise(F.col("ship"))
    return ev.select(
        F.col("o_custkey").alias("asset_id"), "l_orderkey", "l_linenumber",
        date.alias("accepted_date"), date.cast("date").alias("ref_date"), "eps_actual",
    )


SQL_LINE_EVENTS = f"""
li AS (SELECT l_orderkey, l_linenumber, max(l_shipdate) AS ship, sum(l_quantity) AS eps_actual
       FROM lineitem GROUP BY 1, 2),
ev AS (SELECT o.o_custkey AS asset_id, li.l_orderkey, li.l_linenumber,
              CASE WHEN ship >= TIMESTAMP '{SHIP_NULL_FROM}' THEN NULL ELSE ship END AS accepted_date,
              CAST(CASE WHEN ship >= TIMESTAMP '{SHIP_NULL_FROM}' THEN NULL ELSE ship END AS DATE) AS ref_date,
              eps_actual
       FROM li JOIN orders o ON o.o_orderkey = li.l_orderkey)"""


@register("align_events", f"""
WITH {SQL_ORDER_PERIODS}, {SQL_LINE_EVENTS},
{sql_align("ev", "periods", ALIGN_AS_OF_TEXT, ["l_orderkey", "l_linenumber"],
           ["l_orderkey", "l_linenumber", "ref_date", "eps_actual"], "a")}
SELECT * FROM aligned_a""")
def q_align_events(spark, d):
    aligned, _ = align_events(
        line_events(spark, d), order_period_map(spark, d), as_of=ALIGN_AS_OF,
        tiebreak=["l_orderkey", "l_linenumber"],
    )
    return aligned


@register("future_placeholder", f"""
SELECT o_custkey AS asset_id, year(o_orderdate) AS fiscal_year, 'Q' || quarter(o_orderdate) AS period,
       CAST(max(o_orderdate) AS DATE) AS end_date, CAST(max(o_orderdate) AS DATE) AS filing_date,
       max(o_orderdate) AS accepted_date
FROM orders GROUP BY 1, 2, 3
UNION ALL
SELECT c_custkey, {SENTINEL_YEAR}, '{SENTINEL_PERIOD}', NULL, DATE '{SENTINEL_DATE}', TIMESTAMP '{SENTINEL_DATE}'
FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'""")
def q_future_placeholder(spark, d):
    o = order_periods(table(spark, d, "orders"))
    rows = o.groupBy("asset_id", "fiscal_year", "period").agg(F.max("o_orderdate").alias("accepted_date")).select(
        "asset_id", "fiscal_year", "period",
        F.col("accepted_date").cast("date").alias("end_date"),
        F.col("accepted_date").cast("date").alias("filing_date"),
        "accepted_date",
    )
    assets = table(spark, d, "customer").filter(F.col("c_mktsegment") != "HOUSEHOLD")
    ph = future_placeholders(assets.select(F.col("c_custkey").alias("asset_id")), ts_type="timestamp_ntz")
    return stack_diagonal([rows, ph])


# ---------------------------------------------------------------------------
# T1-T9 on the test tables.  Each pipeline runs twice: an earlier fetch (data
# dated before 1999, some values different) into an empty table, then the
# current fetch; the query returns the snapshot after the second run.
# ---------------------------------------------------------------------------
EARLIER = "1999-01-01"
PRICE_AS_OF = dt.date(2001, 8, 1)


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], TABLE_SCHEMAS[name])


def as_stored(df: DataFrame) -> DataFrame:
    """Stands in for a table written by an earlier run: written once below
    the checkpoint folder, so later steps read it instead of re-deriving it."""
    return staged(df)


def fin_map(spark: SparkSession, d: str, flag: str = "has_financials") -> DataFrame:
    return asset_map(customer_assets(spark, d), nation_categories(spark, d), flag, cat="AMERICA")


def sql_amap(name: str, flag_sql: str) -> str:
    return f"""{name} AS (SELECT c_name AS symbol, c_custkey AS id
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE r_name = 'AMERICA' AND {flag_sql})"""


SQL_AMAP_FIN = sql_amap("amap", "c_acctbal > 0")
SQL_AMAP_CHART = sql_amap("amapc", "c_mktsegment <> 'AUTOMOBILE'")

CPI_COLS = ["year", "month", "series_id", "series_name", "series_value", "period_name", "ref_date"]
CPI_KEYS = ["series_id", "year", "month"]


@register("pipe_series", f"""
WITH {SQL_SERIES},
pay AS (SELECT year, month, series_id, 'cpi-u' AS series_name, series_value, period_name,
               CAST(CAST(year AS VARCHAR) || '-' || CAST(month AS VARCHAR) || '-14' AS DATE) AS ref_date
        FROM series WHERE month IS NOT NULL),
r1 AS (SELECT year, month, series_id, series_name, series_value + 1.0 AS series_value, period_name, ref_date
       FROM pay WHERE year < 1999),
s1 AS ({sql_first_load("r1", CPI_KEYS, CPI_COLS)})
{sql_upsert("s1", "pay", CPI_KEYS, CPI_COLS, CPI_COLS, pk="id")}""")
def q_pipe_series(spark, d):
    rows = explode_series(series_documents(spark, d))
    first = cpi_payload(rows.filter(F.col("year") < 1999).withColumn("series_value", F.col("series_value") + 1.0))
    s1 = as_stored(apply_update(empty_table(spark, "cpi"), first, CPI_KEYS, pk="id").snapshot)
    return apply_update(s1, cpi_payload(rows), CPI_KEYS, pk="id").snapshot


def screener_rows(spark: SparkSession, d: str) -> DataFrame:
    c, n, r = table(spark, d, "customer"), table(spark, d, "nation"), table(spark, d, "region")
    return c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("c_name").alias("symbol"),
        (F.col("c_acctbal") * 1000000.0).alias("market_cap"),
        F.when(F.col("r_name") == "AMERICA", "US").otherwise("XX").alias("country"),
        (F.col("c_mktsegment") == "AUTOMOBILE").alias("is_etf"),
        (F.col("c_mktsegment") == "FURNITURE").alias("is_fund"),
        (F.col("c_mktsegment") != "HOUSEHOLD").alias("is_actively_trading"),
    )


def search_rows(spark: SparkSession, d: str) -> DataFrame:
    """Search results: per queried name the exact hit first, then a look-alike."""
    c = table(spark, d, "customer")
    hit = c.select(
        F.col("c_name").alias("query"), F.col("c_name").alias("symbol"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "").otherwise(F.concat("c_name", F.lit(" Inc"))).alias("name"),
        F.lit(1).alias("position"),
    )
    alt = c.select(F.col("c_name").alias("query"), F.concat("c_name", F.lit(".W")).alias("symbol"),
                   F.lit("").alias("name"), F.lit(2).alias("position"))
    return hit.unionByName(alt)


ASSET_COLS = ["symbol", "description", "asset_cat_id", "has_financials", "has_chart"]


@register("pipe_asset", f"""
WITH {SQL_CATS},
catid AS (SELECT id FROM cats WHERE cat = 'AMERICA' AND sub_cat = 'NATION_1'),
search AS (SELECT c_name AS query, c_name AS symbol,
                  CASE WHEN c_mktsegment = 'MACHINERY' THEN '' ELSE c_name || ' Inc' END AS name, 1 AS position
           FROM customer
           UNION ALL SELECT c_name, c_name || '.W', '', 2 FROM customer),
hits AS (SELECT query, symbol, NULLIF(name, '') AS description FROM (
           SELECT *, row_number() OVER (PARTITION BY query ORDER BY position) AS rn FROM search) WHERE rn = 1),
screened AS (SELECT c_name AS symbol
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE c_acctbal * 1000000.0 > 1000000000 AND r_name = 'AMERICA'
    AND c_mktsegment NOT IN ('AUTOMOBILE', 'FURNITURE', 'HOUSEHOLD')
  ORDER BY c_acctbal * 1000000.0 DESC, c_name LIMIT {SCREEN_LIMIT}),
r1 AS (SELECT symbol, description, (SELECT id FROM catid) AS asset_cat_id, TRUE AS has_financials, TRUE AS has_chart
       FROM hits WHERE query IN (SELECT c_name FROM customer WHERE c_mktsegment = 'BUILDING')),
s1 AS ({sql_first_load("r1", ["symbol"], ASSET_COLS)}),
r2 AS (SELECT symbol, description, (SELECT id FROM catid) AS asset_cat_id, TRUE AS has_financials, TRUE AS has_chart
       FROM hits WHERE query IN (SELECT symbol FROM screened)),
ins AS (SELECT * FROM r2 WHERE symbol NOT IN (SELECT symbol FROM s1))
SELECT * FROM s1
UNION ALL
SELECT (SELECT coalesce(max(id), 0) FROM s1) + row_number() OVER (ORDER BY symbol), {", ".join(ASSET_COLS)} FROM ins""")
def q_pipe_asset(spark, d):
    cats = nation_categories(spark, d)
    cat_id = lookup_scalar(cats.filter((F.col("cat") == "AMERICA") & (F.col("sub_cat") == "NATION_1")), "id")
    search = search_rows(spark, d)
    building = table(spark, d, "customer").filter(F.col("c_mktsegment") == "BUILDING").select(F.col("c_name").alias("symbol"))
    s1 = as_stored(apply_update(empty_table(spark, "asset"), asset_payload(search, building, cat_id), ["symbol"],
                                pk="id", insert_only=True).snapshot)
    screened = screen(screener_rows(spark, d), SCREEN_MIN_MKT_CAP, SCREEN_LIMIT, "US").select("symbol")
    return apply_update(s1, asset_payload(search, screened, cat_id), ["symbol"], pk="id", insert_only=True).snapshot


PROFILE_COLS = ["asset_id", "company_name", "currency", "exchange", "industry", "sector", "country", "mkt_cap",
                "price", "beta", "exchange_short_name", "vol_avg", "last_div", "ipo_date", "description"]
PROFILE_IN = ["asset_id", "company_name", "currency", "sector", "mkt_cap", "price"]


def profile_rows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(
        F.col("c_name").alias("symbol"), F.col("c_name").alias("company_name"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "").otherwise("USD").alias("currency"),
        F.col("c_mktsegment").alias("sector"),
        F.round(F.col("c_acctbal") * 100).cast("bigint").alias("mkt_cap"),
        F.col("c_acctbal").alias("price"),
    )


@register("pipe_profile", f"""
WITH {SQL_AMAP_FIN},
pr AS (SELECT a.id AS asset_id, c_name AS company_name,
              CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE 'USD' END AS currency,
              c_mktsegment AS sector, CAST(round(c_acctbal * 100) AS BIGINT) AS mkt_cap, c_acctbal AS price
       FROM customer JOIN amap a ON a.symbol = c_name),
s1 AS (SELECT asset_id, company_name, currency, CAST(NULL AS VARCHAR) AS exchange, CAST(NULL AS VARCHAR) AS industry,
              sector, CAST(NULL AS VARCHAR) AS country, mkt_cap, price - 1.0 AS price, CAST(NULL AS DOUBLE) AS beta, CAST(NULL AS VARCHAR) AS exchange_short_name,
              CAST(NULL AS BIGINT) AS vol_avg, CAST(NULL AS DOUBLE) AS last_div, CAST(NULL AS DATE) AS ipo_date,
              CAST(NULL AS VARCHAR) AS description
       FROM pr WHERE sector = 'BUILDING')
{sql_upsert("s1", "pr", ["asset_id"], PROFILE_COLS, PROFILE_IN)}""")
def q_pipe_profile(spark, d):
    amap = fin_map(spark, d)
    rows = profile_rows(spark, d)
    first = profile_payload(rows.filter(F.col("sector") == "BUILDING").withColumn("price", F.col("price") - 1.0), amap)
    s1 = as_stored(apply_update(empty_table(spark, "equity_profile"), first, ["asset_id"]).snapshot)
    return apply_update(s1, profile_payload(rows, amap), ["asset_id"]).snapshot


def statement_rows(spark: SparkSession, d: str) -> DataFrame:
    """Quarterly statements per customer built from its orders."""
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    g = o.join(c, o.o_custkey == c.c_custkey).groupBy(
        F.col("c_name").alias("symbol"), "c_mktsegment",
        F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q"),
    ).agg(
        F.max("o_orderdate").alias("d"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("revenue"),
        (F.count(F.lit(1)) * 1000).alias("net_income"),
        (F.count(F.lit(1)) * 0.25).alias("eps"),
    )
    return g.select(
        "symbol",
        F.date_format("d", "yyyy-MM-dd").alias("date"),
        F.col("y").cast("string").alias("fiscal_year"),
        F.concat(F.lit("Q"), F.col("q").cast("string")).alias("period"),
        F.date_format("d", "yyyy-MM-dd").alias("filing_date"),
        F.date_format("d", "yyyy-MM-dd HH:mm:ss").alias("accepted_date"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "").otherwise("USD").alias("reported_currency"),
        "revenue", "net_income", "eps",
    )


PERIOD_KEYS = ["asset_id", "fiscal_year", "period"]
PERIOD_COLS = ["asset_id", "fiscal_year", "period", "end_date", "filing_date", "accepted_date"]


def period_snapshot(spark: SparkSession, d: str) -> DataFrame:
    amap = fin_map(spark, d)
    rows = as_stored(statement_rows(spark, d))
    s1 = as_stored(apply_update(empty_table(spark, "reporting_period"),
                                period_payload(rows.filter(F.col("date") < EARLIER), amap), PERIOD_KEYS, pk="id").snapshot)
    return apply_update(s1, period_payload(rows, amap), PERIOD_KEYS, pk="id").snapshot


def sql_top(rows: str, part: str, order: str, k: int, where: str = "TRUE") -> str:
    return (f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY {order}) AS _rn "
            f"FROM {rows} WHERE {where}) WHERE _rn <= {k})")


SQL_PERIOD_CTES = f"""{SQL_AMAP_FIN},
st AS (SELECT c.c_name AS symbol, year(o.o_orderdate) AS fiscal_year, 'Q' || quarter(o.o_orderdate) AS period,
              max(o.o_orderdate) AS d, CAST(sum(CAST(round(o.o_totalprice * 100) AS BIGINT)) AS BIGINT) AS revenue,
              count(*) * 1000 AS net_income, CAST(count(*) AS DOUBLE) * 0.25 AS eps
       FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey GROUP BY 1, 2, 3),
p_all AS (SELECT a.id AS asset_id, st.* FROM st JOIN amap a USING (symbol)),
r1 AS (SELECT asset_id, fiscal_year, period, CAST(d AS DATE) AS end_date, CAST(d AS DATE) AS filing_date,
              d AS accepted_date
       FROM {sql_top("p_all", "asset_id", "d DESC, period", STATEMENT_PERIODS, f"d < TIMESTAMP '{EARLIER}'")}
       UNION ALL
       SELECT id, {SENTINEL_YEAR}, '{SENTINEL_PERIOD}', NULL, DATE '{SENTINEL_DATE}', TIMESTAMP '{SENTINEL_DATE}'
       FROM amap),
s1 AS ({sql_first_load("r1", PERIOD_KEYS, PERIOD_COLS)}),
r2 AS (SELECT asset_id, fiscal_year, period, CAST(d AS DATE) AS end_date, CAST(d AS DATE) AS filing_date,
              d AS accepted_date
       FROM {sql_top("p_all", "asset_id", "d DESC, period", STATEMENT_PERIODS)}
       UNION ALL
       SELECT id, {SENTINEL_YEAR}, '{SENTINEL_PERIOD}', NULL, DATE '{SENTINEL_DATE}', TIMESTAMP '{SENTINEL_DATE}'
       FROM amap),
rp AS ({sql_upsert("s1", "r2", PERIOD_KEYS, PERIOD_COLS, PERIOD_COLS, pk="id")})"""


@register("pipe_period", f"WITH {SQL_PERIOD_CTES}\nSELECT * FROM rp")
def q_pipe_period(spark, d):
    snap = period_snapshot(spark, d)
    return snap.withColumn("accepted_date", F.col("accepted_date").cast("timestamp_ntz"))


STATEMENT_COLS = ["reporting_period_id", "revenue", "cost_of_revenue", "gross_profit", "operating_income",
                  "net_income", "eps", "eps_diluted", "cik", "weighted_average_shs_out", "weighted_average_shs_out_dil"]
STATEMENT_IN = ["reporting_period_id", "revenue", "net_income", "eps"]


@register("pipe_statement", f"""
WITH {SQL_PERIOD_CTES},
q1 AS (SELECT rp.id AS reporting_period_id, t.revenue + 1 AS revenue, t.net_income, t.eps
       FROM {sql_top("p_all", "asset_id", "d DESC, period", STATEMENT_PERIODS, f"d < TIMESTAMP '{EARLIER}'")} t
       JOIN rp USING (asset_id, fiscal_year, period)),
t1 AS (SELECT reporting_period_id, revenue, CAST(NULL AS BIGINT) AS cost_of_revenue,
              CAST(NULL AS BIGINT) AS gross_profit, CAST(NULL AS BIGINT) AS operating_income, net_income, eps,
              CAST(NULL AS DOUBLE) AS eps_diluted, CAST(NULL AS VARCHAR) AS cik,
              CAST(NULL AS BIGINT) AS weighted_average_shs_out, CAST(NULL AS BIGINT) AS weighted_average_shs_out_dil FROM q1),
q2 AS (SELECT rp.id AS reporting_period_id, t.revenue, t.net_income, t.eps
       FROM {sql_top("p_all", "asset_id", "d DESC, period", STATEMENT_PERIODS)} t
       JOIN rp USING (asset_id, fiscal_year, period))
{sql_upsert("t1", "q2", ["reporting_period_id"], STATEMENT_COLS, STATEMENT_IN)}""")
def q_pipe_statement(spark, d):
    amap, periods = fin_map(spark, d), as_stored(period_snapshot(spark, d))
    rows = statement_rows(spark, d)
    early = rows.filter(F.col("date") < EARLIER).withColumn("revenue", F.col("revenue") + 1)
    s1 = as_stored(apply_update(empty_table(spark, "income_statement"), statement_payload(early, amap, periods),
                                ["reporting_period_id"]).snapshot)
    return apply_update(s1, statement_payload(rows, amap, periods), ["reporting_period_id"]).snapshot


def price_rows(spark: SparkSession, d: str) -> DataFrame:
    """Daily rows per customer: order totals as the close, order count as volume."""
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    g = o.join(c, o.o_custkey == c.c_custkey).groupBy(F.col("c_name").alias("symbol"), F.col("o_orderdate").alias("day")).agg(
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"), F.count(F.lit(1)).alias("volume"))
    return g.select("symbol", F.date_format("day", "yyyy-MM-dd").alias("date"),
                    (F.col("cents") / 100.0).alias("close"), "volume")


PRICE_KEYS = ["asset_id", "end_date"]
PRICE_COLS = ["asset_id", "end_date", "open", "high", "low", "close", "volume"]
PRICE_IN = ["asset_id", "end_date", "close", "volume"]


@register("pipe_price", f"""
WITH {SQL_AMAP_CHART},
pdays AS (SELECT c_name AS symbol, o_orderdate AS day, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents,
                 count(*) AS volume
          FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2),
pp AS (SELECT a.id AS asset_id, CAST(day AS DATE) AS end_date, CAST(cents AS DOUBLE) / 100.0 AS close, volume, day
       FROM pdays JOIN amapc a USING (symbol)
       WHERE day >= TIMESTAMP '{PRICE_AS_OF - dt.timedelta(days=PRICE_DAYS)}'),
r1 AS (SELECT asset_id, end_date, CAST(NULL AS DOUBLE) AS open, CAST(NULL AS DOUBLE) AS high,
              CAST(NULL AS DOUBLE) AS low, close + 1.0 AS close, volume
       FROM pp WHERE day < TIMESTAMP '{EARLIER}'),
s1 AS ({sql_first_load("r1", PRICE_KEYS, PRICE_COLS)})
{sql_upsert("s1", "pp", PRICE_KEYS, PRICE_COLS, PRICE_IN, pk="id")}""")
def q_pipe_price(spark, d):
    amap = fin_map(spark, d, "has_chart")
    rows = price_rows(spark, d)
    early = rows.filter(F.col("date") < EARLIER).withColumn("close", F.col("close") + 1.0)
    s1 = as_stored(apply_update(empty_table(spark, "eod_price"), price_payload(early, amap, PRICE_AS_OF), PRICE_KEYS,
                                pk="id").snapshot)
    return apply_update(s1, price_payload(rows, amap, PRICE_AS_OF), PRICE_KEYS, pk="id").snapshot


def earning_rows(spark: SparkSession, d: str) -> DataFrame:
    """Earnings reports: one per (order, line), dated by the ship date (blank
    from August 2001 on), quantity as EPS and extended price as revenue."""
    li = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.max("l_shipdate").alias("ship"), F.sum("l_quantity").alias("eps_actual"),
        F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("revenue_actual"))
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    ev = li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
    return ev.select(
        F.col("c_name").alias("symbol"),
        F.when(F.col("ship") >= ntz(SHIP_NULL_FROM), "").otherwise(F.date_format("ship", "yyyy-MM-dd")).alias("date"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("report_id"),
        "eps_actual", "revenue_actual",
    )


EARNING_COLS = ["reporting_period_id", "ref_date", "eps_actual", "eps_estimated", "revenue_actual",
                "revenue_estimated"]
EARNING_IN = ["reporting_period_id", "ref_date", "eps_actual", "revenue_actual"]
EARNING_TB = ["eps_actual", "report_id", "revenue_actual"]


def sql_earning_run(tag: str, where: str) -> str:
    top = sql_top("er", "symbol", "NULLIF(date_text, '') DESC NULLS LAST, " + ", ".join(EARNING_TB), EARNING_ROWS, where)
    return f"""
ein_{tag} AS (SELECT a.id AS asset_id, CAST(NULLIF(date_text, '') AS TIMESTAMP) AS accepted_date,
                     CAST(NULLIF(date_text, '') AS DATE) AS ref_date, eps_actual, report_id, revenue_actual
              FROM {top} x JOIN amap a USING (symbol)),
{sql_align(f"ein_{tag}", "rp", ALIGN_AS_OF_TEXT, EARNING_TB, EARNING_TB + ["ref_date"], tag)}"""


@register("pipe_earning", f"""
WITH {SQL_PERIOD_CTES},
eli AS (SELECT l_orderkey, l_linenumber, max(l_shipdate) AS ship, sum(l_quantity) AS qty,
               CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents
        FROM lineitem GROUP BY 1, 2),
er AS (SELECT c.c_name AS symbol,
              CASE WHEN ship >= TIMESTAMP '{SHIP_NULL_FROM}' THEN '' ELSE strftime(ship, '%Y-%m-%d') END AS date_text,
              l_orderkey * 8 + l_linenumber AS report_id, qty AS eps_actual, cents AS revenue_actual
       FROM eli JOIN orders o ON o.o_orderkey = eli.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey),
{sql_earning_run("r1", f"date_text < '{EARLIER}'")},
{sql_earning_run("r2", "TRUE")},
t1 AS (SELECT reporting_period_id, ref_date, eps_actual, CAST(NULL AS DOUBLE) AS eps_estimated, revenue_actual,
              CAST(NULL AS BIGINT) AS revenue_estimated FROM aligned_r1)
{sql_upsert("t1", "aligned_r2", ["reporting_period_id"], EARNING_COLS, EARNING_IN)}""")
def q_pipe_earning(spark, d):
    amap, periods = fin_map(spark, d), as_stored(period_snapshot(spark, d))
    rows = earning_rows(spark, d)
    a1, _ = earning_payload(rows.filter(F.col("date") < EARLIER), amap, periods, ALIGN_AS_OF, report=["report_id"])
    s1 = as_stored(apply_update(empty_table(spark, "earning"), a1, ["reporting_period_id"]).snapshot)
    a2, _ = earning_payload(rows, amap, periods, ALIGN_AS_OF, report=["report_id"])
    return apply_update(s1, a2, ["reporting_period_id"]).snapshot


# ---------------------------------------------------------------------------
# Two fetches in one landing: the newest one counts, before any limit
# ---------------------------------------------------------------------------
FETCH_1, FETCH_2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def fetched(rows: DataFrame, when: str) -> DataFrame:
    return rows.withColumn(FETCHED, F.lit(when).cast("timestamp"))


@register("refetch_price", f"""
WITH {SQL_AMAP_CHART},
pdays AS (SELECT c_name AS symbol, o_orderdate AS day, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents,
                 count(*) AS volume
          FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2),
landed AS (SELECT symbol, day, CAST(cents AS DOUBLE) / 100.0 + 1.0 AS close, volume, 1 AS landing_no FROM pdays
           UNION ALL
           SELECT symbol, day, CAST(cents AS DOUBLE) / 100.0, volume, 2 FROM pdays WHERE day >= TIMESTAMP '{EARLIER}'),
pp AS (SELECT a.id AS asset_id, CAST(day AS DATE) AS end_date, close, volume FROM (
         SELECT *, row_number() OVER (PARTITION BY symbol, day ORDER BY landing_no DESC) AS k FROM landed)
       JOIN amapc a USING (symbol)
       WHERE k = 1 AND day >= TIMESTAMP '{PRICE_AS_OF - dt.timedelta(days=PRICE_DAYS)}'),
r1 AS (SELECT asset_id, end_date, CAST(NULL AS DOUBLE) AS open, CAST(NULL AS DOUBLE) AS high,
              CAST(NULL AS DOUBLE) AS low, close, volume FROM pp)
{sql_first_load("r1", PRICE_KEYS, PRICE_COLS)}""")
def q_refetch_price(spark, d):
    rows = price_rows(spark, d)
    landed = fetched(rows.withColumn("close", F.col("close") + 1.0), FETCH_1).unionByName(
        fetched(rows.filter(F.col("date") >= EARLIER), FETCH_2))
    return apply_update(empty_table(spark, "eod_price"), price_payload(landed, fin_map(spark, d, "has_chart"), PRICE_AS_OF),
                        PRICE_KEYS, pk="id").snapshot


@register("refetch_statement", f"""
WITH {SQL_AMAP_FIN},
st AS (SELECT c.c_name AS symbol, year(o.o_orderdate) AS fiscal_year, 'Q' || quarter(o.o_orderdate) AS period,
              max(o.o_orderdate) AS d, CAST(sum(CAST(round(o.o_totalprice * 100) AS BIGINT)) AS BIGINT) AS revenue
       FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey GROUP BY 1, 2, 3),
landed AS (SELECT *, 1 AS landing_no FROM st
           UNION ALL SELECT symbol, fiscal_year, period, d, revenue + 7, 2 FROM st WHERE fiscal_year >= 1998),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, fiscal_year, period ORDER BY landing_no DESC) AS k
                       FROM landed) WHERE k = 1)
SELECT a.id AS asset_id, fiscal_year, period, CAST(d AS DATE) AS end_date, revenue
FROM {sql_top("one", "symbol", "CAST(d AS DATE) DESC, period", STATEMENT_PERIODS)} JOIN amap a USING (symbol)""")
def q_refetch_statement(spark, d):
    rows = statement_rows(spark, d)
    landed = fetched(rows, FETCH_1).unionByName(
        fetched(rows.filter(F.col("fiscal_year") >= "1998").withColumn("revenue", F.col("revenue") + 7), FETCH_2))
    return typed_statement_rows(landed, fin_map(spark, d)).select("asset_id", "fiscal_year", "period", "end_date", "revenue")


SQL_EARNING_ROWS = f"""
eli AS (SELECT l_orderkey, l_linenumber, max(l_shipdate) AS ship, sum(l_quantity) AS qty,
               CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents
        FROM lineitem GROUP BY 1, 2),
er0 AS (SELECT c.c_name AS symbol,
              CASE WHEN ship >= TIMESTAMP '{SHIP_NULL_FROM}' THEN '' ELSE strftime(ship, '%Y-%m-%d') END AS date_text,
              l_orderkey * 8 + l_linenumber AS report_id, qty AS eps_actual, cents AS revenue_actual
       FROM eli JOIN orders o ON o.o_orderkey = eli.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey)"""


@register("refetch_earning", f"""
WITH {SQL_PERIOD_CTES}, {SQL_EARNING_ROWS},
landed AS (SELECT *, 1 AS landing_no FROM er0
           UNION ALL SELECT symbol, date_text, report_id, eps_actual + 0.5, revenue_actual, 2 FROM er0 WHERE report_id % 2 = 0),
er AS (SELECT symbol, date_text, report_id, eps_actual, revenue_actual FROM (
         SELECT *, row_number() OVER (PARTITION BY symbol, date_text, report_id ORDER BY landing_no DESC) AS k FROM landed) WHERE k = 1),
{sql_earning_run("r1", "TRUE")}
SELECT reporting_period_id, ref_date, eps_actual, revenue_actual FROM aligned_r1""")
def q_refetch_earning(spark, d):
    rows = earning_rows(spark, d)
    # Both fetches in one pass: a row, and behind it its revision where the report has one.
    fetches = F.array(*[F.struct(F.lit(when).cast("timestamp").alias(FETCHED), eps.alias("eps_actual"))
                        for when, eps in ((FETCH_1, F.col("eps_actual")), (FETCH_2, F.col("eps_actual") + 0.5))])
    fetches = F.when(F.col("report_id") % 2 == 0, fetches).otherwise(F.slice(fetches, 1, 1))
    landed = rows.withColumn("fetch", F.explode(fetches)).select("symbol", "date", "report_id", "revenue_actual", "fetch.*")
    aligned, _ = earning_payload(landed, fin_map(spark, d), as_stored(period_snapshot(spark, d)), ALIGN_AS_OF, report=["report_id"])
    return aligned.select("reporting_period_id", "ref_date", "eps_actual", "revenue_actual")


# ---------------------------------------------------------------------------
# D3: rows that cannot be stored
# ---------------------------------------------------------------------------
@register("reject_unmapped", f"""
WITH {SQL_AMAP_FIN}
SELECT c_name AS symbol, c_mktsegment AS sector, c_acctbal AS price
FROM customer WHERE c_name NOT IN (SELECT symbol FROM amap)""")
def q_reject_unmapped(spark, d):
    return unmapped(profile_rows(spark, d), fin_map(spark, d)).select("symbol", "sector", "price")


@register("reject_unaligned", f"""
WITH {SQL_ORDER_PERIODS}, {SQL_LINE_EVENTS},
{sql_align("ev", "periods", ALIGN_AS_OF_TEXT, ["l_orderkey", "l_linenumber"],
           ["l_orderkey", "l_linenumber", "ref_date", "eps_actual"], "a")}
SELECT asset_id, l_orderkey, l_linenumber, ref_date, eps_actual FROM res_a WHERE reporting_period_id IS NULL""")
def q_reject_unaligned(spark, d):
    _, rejects = align_events(line_events(spark, d), order_period_map(spark, d), as_of=ALIGN_AS_OF,
                              tiebreak=["l_orderkey", "l_linenumber"])
    return rejects.select("asset_id", "l_orderkey", "l_linenumber", "ref_date", "eps_actual")


# ---------------------------------------------------------------------------
# The other statements; T1 with its default keys and both filters
# ---------------------------------------------------------------------------
def sql_statement_first(cols: dict[str, str]) -> str:
    out = ", ".join(f"{sql} AS {name}" for name, sql in cols.items())
    return f"""
WITH {SQL_PERIOD_CTES}
SELECT rp.id AS reporting_period_id, {out}
FROM {sql_top("p_all", "asset_id", "d DESC, period", STATEMENT_PERIODS)} t JOIN rp USING (asset_id, fiscal_year, period)"""


def statement_first(spark: SparkSession, d: str, name: str, cols: dict[str, Column]) -> DataFrame:
    amap, periods = fin_map(spark, d), as_stored(period_snapshot(spark, d))
    rows = statement_rows(spark, d).withColumns(cols).drop("revenue", "net_income", "eps")
    return apply_update(empty_table(spark, name), statement_payload(rows, amap, periods), ["reporting_period_id"]).snapshot


@register("pipe_balance_sheet", sql_statement_first({
    "total_assets": "t.revenue", "total_liabilities": "t.net_income", "total_equity": "t.revenue - t.net_income"}))
def q_pipe_balance_sheet(spark, d):
    return statement_first(spark, d, "balance_sheet_statement", {
        "total_assets": F.col("revenue"), "total_liabilities": F.col("net_income"),
        "total_equity": F.col("revenue") - F.col("net_income")})


@register("pipe_cash_flow", sql_statement_first({
    "operating_cash_flow": "t.net_income", "capital_expenditure": "-t.net_income", "free_cash_flow": "CAST(NULL AS BIGINT)"}))
def q_pipe_cash_flow(spark, d):
    return statement_first(spark, d, "cash_flow_statement", {
        "operating_cash_flow": F.col("net_income"), "capital_expenditure": -F.col("net_income")})


@register("series_default_keys", f"""
WITH {SQL_SERIES},
pay AS (SELECT year, month, series_id, '{CPI_SERIES_NAME}' AS series_name, series_value, period_name,
               CAST(CAST(year AS VARCHAR) || '-' || CAST(month AS VARCHAR) || '-14' AS DATE) AS ref_date
        FROM series WHERE month IS NOT NULL AND series_id = '2-HIGH' AND year BETWEEN 1997 AND 2000)
{sql_first_load("pay", ["year", "month"], CPI_COLS)}""")
def q_series_default_keys(spark, d):
    rows = cpi_payload(explode_series(series_documents(spark, d)), (1997, 2000), ["2-HIGH"])
    return apply_update(empty_table(spark, "cpi"), rows, TABLE_KEYS["cpi"], pk="id").snapshot


# ---------------------------------------------------------------------------
# A2, D1, S14-S16
# ---------------------------------------------------------------------------
@register("key_counts", """
SELECT count(*) AS rows, count(*) FILTER (WHERE quality IS NULL) AS null_keys
FROM documents LEFT JOIN labels USING (doc_id)""")
def q_key_counts(spark, d):
    docs = table(spark, d, "documents").select("doc_id")
    seen, metrics = key_metrics(docs.join(table(spark, d, "labels"), "doc_id", "left"), "quality")
    seen.write.format("noop").mode("overwrite").save()  # the counts ride on this action
    got = observed(metrics, ["rows", "null_keys"])
    return spark.createDataFrame([(got["rows"], got["null_keys"])], "rows long, null_keys long")


@register("payload_status", f"""
SELECT o_orderstatus AS part, bool_or(o_orderpriority = '5-LOW') AS raises FROM orders GROUP BY 1
UNION ALL SELECT 'none', FALSE""")
def q_payload_status(spark, d):
    o = table(spark, d, "orders").select("o_orderstatus", F.when(F.col("o_orderpriority") == "5-LOW", "REQUEST_FAILED").otherwise(PAYLOAD_OK_STATUS).alias("status"))
    out = []
    for part in ("F", "O", "P", "none"):
        rows = o.filter(F.col("o_orderstatus") == part)
        if part != "none" and not rows.limit(1).count():
            continue
        try:
            require_status(rows, PAYLOAD_OK_STATUS)
            out.append((part, False))
        except PayloadStatusError:
            out.append((part, True))
    return spark.createDataFrame(out, "part string, raises boolean")


@register("records_frame", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def q_records_frame(spark, d):
    nation = table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return records_to_df(spark, small_rows(nation), nation.schema)


# Queries that run the ledger itself; they use what is defined above.
from sparkledger.plans import ledger_queries  # noqa: E402, F401
