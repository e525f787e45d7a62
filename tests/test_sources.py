import datetime as dt
import json
import os

import pytest
from pyspark.sql import types as T

from sparkledger.operators import PayloadStatusError
from sparkledger.sources import (
    FETCHED,
    SnapshotStore,
    describe_columns,
    explode_series,
    fan_out,
    list_tables,
    newest_fetch,
    read_payload,
    read_series,
    records_to_df,
    screen,
    since,
)
from sparkledger.schemas import SERIES_PAYLOAD_SCHEMA
from tests.conftest import rows


def write_json(path, obj):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        json.dump(obj, f)


SERIES_DOC = {
    "status": "REQUEST_SUCCEEDED",
    "Results": {"series": [{"seriesID": "CUUR0000SA0", "data": [
        {"year": "2024", "period": "M12", "periodName": "December", "value": "104.25"},
        {"year": "2024", "period": "M11", "periodName": "November", "value": "103.5"},
        {"year": "2024", "period": "M10", "periodName": "October", "value": "n/a"},
    ]}]},
}


def test_read_payload_snake_and_empty(spark, scratch):
    schema = T.StructType([T.StructField("reportedCurrency", T.StringType()), T.StructField("grossProfit", T.LongType())])
    write_json(f"{scratch}/p/a.json", [{"reportedCurrency": "EUR", "grossProfit": 420, "unlisted": 1}])
    df = read_payload(spark, f"{scratch}/p", schema)
    assert df.columns == ["reported_currency", "gross_profit", FETCHED]
    assert df.collect()[0].gross_profit == 420 and df.collect()[0][FETCHED] is not None
    write_json(f"{scratch}/e/a.json", [])
    empty = read_payload(spark, f"{scratch}/e", schema)
    assert empty.columns == ["reported_currency", "gross_profit", FETCHED] and empty.count() == 0


def test_newest_fetch_wins(spark):
    df = spark.createDataFrame(
        [("a", 1, 5.0, "2024-01-01 00:00:00"), ("a", 1, 4.0, "2024-03-01 00:00:00"), ("a", 1, 9.0, None),
         ("b", 1, 2.0, "2024-02-01 00:00:00"), ("b", 1, 1.0, "2024-02-01 00:00:00"), (None, 1, 3.0, None)],
        "symbol string, day int, close double, at string").selectExpr("symbol", "day", "close", f"cast(at as timestamp) as {FETCHED}")
    assert rows(newest_fetch(df, ["symbol", "day"])) == [("a", 1, 4.0), ("b", 1, 1.0), (None, 1, 3.0)]
    assert rows(newest_fetch(df.drop(FETCHED), ["symbol", "day"])) == [("a", 1, 4.0), ("b", 1, 1.0), (None, 1, 3.0)]


def test_series_parse_and_status(spark, scratch):
    write_json(f"{scratch}/cpi/a.json", SERIES_DOC)
    out = read_series(spark, f"{scratch}/cpi")
    got = rows(out, "series_id", "year", "month", "series_value", "ref_date")
    assert got == [("CUUR0000SA0", 2024, 11, 103.5, "2024-11-14"), ("CUUR0000SA0", 2024, 12, 104.25, "2024-12-14")]
    assert dict(out.dtypes)["year"] == "bigint" and dict(out.dtypes)["series_value"] == "double"
    write_json(f"{scratch}/bad/a.json", {"status": "REQUEST_FAILED", "Results": {"series": []}})
    with pytest.raises(PayloadStatusError):
        read_series(spark, f"{scratch}/bad")


def test_explode_series_from_frame(spark):
    docs = spark.createDataFrame([SERIES_DOC], SERIES_PAYLOAD_SCHEMA)
    assert explode_series(docs).count() == 2


def test_fan_out_and_screen(spark):
    df = spark.createDataFrame(
        [("AAPL", 3e12, "US", False, False, True), ("SPY", 5e11, "US", True, False, True),
         ("TINY", 1e6, "US", False, False, True), ("SAP", 2e11, "DE", False, False, True),
         ("MSFT", 3e12, "US", False, False, True), ("OLD", 2e9, "US", False, False, False)],
        "symbol string, market_cap double, country string, is_etf boolean, is_fund boolean, is_actively_trading boolean")
    assert rows(fan_out(df, "symbol", "AAPL"), "symbol") == [("AAPL",)]
    assert rows(fan_out(df, "symbol", ["AAPL", "MSFT", "NONE"]), "symbol") == [("AAPL",), ("MSFT",)]
    assert [r.symbol for r in screen(df, 1e9, 5).collect()] == ["AAPL", "MSFT"]
    assert [r.symbol for r in screen(df, 1e9, 1).collect()] == ["AAPL"]


def test_since(spark):
    df = spark.createDataFrame([("2020-01-01",), ("2024-06-01",), ("bad",)], "date string")
    assert rows(since(df, "date", dt.date(2025, 1, 1), 1825), "date") == [("2024-06-01",)]


def test_records_and_catalog(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    assert records_to_df(spark, [{"id": 1, "name": "a"}, {"id": 2, "name": "b"}], schema).count() == 2
    empty = records_to_df(spark, [], schema)
    assert empty.columns == ["id", "name"] and empty.count() == 0
    empty.createOrReplaceTempView("ledger_tmp")
    spark.range(1).write.mode("overwrite").saveAsTable("default.listed_here")
    try:
        assert ("default", "listed_here") in list_tables(spark)
    finally:
        spark.sql("DROP TABLE default.listed_here")
    desc = {r.column_name: (r.data_type, r.non_null) for r in describe_columns(
        records_to_df(spark, [{"id": 1}, {"id": 2, "name": "x"}], schema)).collect()}
    assert desc == {"id": ("bigint", 2), "name": ("string", 1)}


def test_snapshot_store_versions(spark, scratch):
    store = SnapshotStore(spark, f"{scratch}/store")
    assert store.version("asset_cat") == 0 and store.read("asset_cat").count() == 0
    cats = spark.createDataFrame([(1, "Equity", "UNKNOWN")], store.schemas["asset_cat"])
    assert store.commit("asset_cat", cats) == 1
    more = store.read("asset_cat").unionByName(spark.createDataFrame([(2, "Equity", "Tech")], store.schemas["asset_cat"]))
    assert store.commit("asset_cat", more) == 2
    assert store.read("asset_cat").count() == 2
    assert store.read("asset_cat", version=1).count() == 1
    with pytest.raises(ValueError):
        store.read("asset_cat", version=3)


def test_commit_survives_a_dead_run_and_rewrites_only_touched_partitions(spark, scratch):
    store = SnapshotStore(spark, f"{scratch}/store")
    price = lambda *days: spark.createDataFrame(
        [(i, 1, dt.date(y, 1, 2), c) for i, (y, c) in enumerate(days)], "id long, asset_id long, end_date date, close double")
    store.commit("eod_price", price((2023, 1.0), (2024, 2.0)))
    before = store.entries("eod_price", 1)
    assert [p for p, _ in before] == ["2023", "2024"]
    # A run that died: a folder that no marker names, with rows and without.
    price((2030, 9.0)).write.parquet(f"{scratch}/store/eod_price/data-dead")
    os.makedirs(f"{scratch}/store/eod_price/data-dead2/_temporary")
    assert store.commit("eod_price", price((2024, 3.0)), replaces=["2024"]) == 2
    after = store.entries("eod_price", 2)
    assert after[0] == before[0] and after[1] != before[1]
    assert rows(store.read("eod_price"), "end_date", "close") == [(dt.date(2023, 1, 2), 1.0), (dt.date(2024, 1, 2), 3.0)]
    assert rows(store.read("eod_price", parts=["2024"]), "close") == [(3.0,)]
    assert rows(store.read("eod_price", version=1), "close") == [(1.0,), (2.0,)]
    assert store.commit("eod_price", price((2024, 4.0), (2025, 5.0)), appends=True) == 3
    assert rows(store.read("eod_price"), "close") == [(1.0,), (3.0,), (4.0,), (5.0,)]
    assert store.commit("eod_price", price()) == 4 and store.read("eod_price").count() == 0


def test_unreadable_markers_are_no_empty_table(spark, scratch):
    store = SnapshotStore(spark, f"{scratch}/store")
    os.makedirs(f"{scratch}/store/asset_cat/_versions/v=1")
    with open(f"{scratch}/store/asset_cat/_versions/v=1/part-0.parquet", "w") as f:
        f.write("not a parquet file")
    with pytest.raises(Exception, match="(?i)parquet|footer|magic|corrupt"):
        store.version("asset_cat")


def test_table_handle_and_observed_metrics(spark):
    from sparkledger.operators import key_metrics
    from sparkledger.sources import table_handle

    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "k long, v string")
    df.createOrReplaceGlobalTempView("ledger_handle")
    assert table_handle(spark, "global_temp", "ledger_handle").count() == 3
    observed, obs = key_metrics(df, "k")
    assert observed.count() == 3          # the metrics ride on this action
    assert obs.get == {"rows": 3, "null_keys": 1}


def test_read_payload_json_lines(spark, scratch):
    os.makedirs(f"{scratch}/jl")
    with open(f"{scratch}/jl/a.json", "w") as f:
        f.write('{"symbol": "AAPL", "netIncome": 1}\n{"symbol": "MSFT", "netIncome": 2}\n')
    schema = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("netIncome", T.LongType())])
    df = read_payload(spark, f"{scratch}/jl", schema, json_lines=True)
    assert rows(df, "symbol", "net_income") == [("AAPL", 1), ("MSFT", 2)]


def test_small_rows_guard(spark):
    from sparkledger.sources import small_rows

    df = spark.range(5).withColumnRenamed("id", "k")
    assert small_rows(df) == [{"k": i} for i in range(5)]
    with pytest.raises(ValueError):
        small_rows(df, max_rows=3)
