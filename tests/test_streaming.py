import datetime as dt
import os

from pyspark.sql import types as T

from sparkledger.plans.pipelines import Ledger
from sparkledger.schemas import PAYLOAD_SCHEMAS
from sparkledger.sources import SnapshotStore
from sparkledger.streaming import run_new_files
from tests.conftest import rows
from tests.test_pipelines import write

PRICE_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()), T.StructField("date", T.StringType()),
    T.StructField("close", T.DoubleType()), T.StructField("volume", T.LongType()),
])


def test_only_new_files_are_applied(spark, scratch):
    store = SnapshotStore(spark, f"{scratch}/store")
    store.commit("asset_cat", spark.createDataFrame([(1, "Equity", "UNKNOWN")], store.schemas["asset_cat"]))
    store.commit("asset", spark.createDataFrame([(1, "AAPL", "Apple", 1, True, True)], store.schemas["asset"]))
    landing = f"{scratch}/landing"
    ledger = Ledger(spark, store, landing, as_of=dt.datetime(2025, 1, 15))
    write(f"{landing}/historical_price/a.json",
          [{"symbol": "AAPL", "date": f"2024-11-0{d}", "close": 1.0 * d, "volume": d} for d in (1, 2)])
    first = run_new_files(ledger, "historical_price", PRICE_SCHEMA)
    assert len(first) == 1
    assert rows(store.read("eod_price"), "id", "end_date", "close") == [
        (1, dt.date(2024, 11, 1), 1.0), (2, dt.date(2024, 11, 2), 2.0)]
    # A revision of day 2 and a new day arrive in a new file; the old file is not re-read.
    write(f"{landing}/historical_price/b.json",
          [{"symbol": "AAPL", "date": "2024-11-02", "close": 2.5, "volume": 2},
           {"symbol": "AAPL", "date": "2024-11-03", "close": 3.0, "volume": 3}])
    second = run_new_files(ledger, "historical_price", PRICE_SCHEMA)
    assert len(second) == 1
    assert rows(store.read("eod_price"), "id", "end_date", "close") == [
        (1, dt.date(2024, 11, 1), 1.0), (2, dt.date(2024, 11, 2), 2.5), (3, dt.date(2024, 11, 3), 3.0)]
    assert run_new_files(ledger, "historical_price", PRICE_SCHEMA) == []


def test_series_documents_stream(spark, scratch):
    from sparkledger.schemas import SERIES_PAYLOAD_SCHEMA
    from tests.test_sources import SERIES_DOC

    store = SnapshotStore(spark, f"{scratch}/store")
    landing = f"{scratch}/landing"
    ledger = Ledger(spark, store, landing, as_of=dt.datetime(2025, 1, 15))
    write(f"{landing}/cpi/a.json", SERIES_DOC)
    assert len(run_new_files(ledger, "cpi", SERIES_PAYLOAD_SCHEMA)) == 1
    assert rows(store.read("cpi"), "id", "year", "month") == [(1, 2024, 11), (2, 2024, 12)]


def test_one_revised_report_changes_one_row(spark, scratch):
    """Later files, one a batch, revise a single report: the other rows stay as they are."""
    from tests.test_pipelines import QUARTERS, build_landing

    landing = f"{scratch}/landing"
    build_landing(landing)
    store = SnapshotStore(spark, f"{scratch}/store")
    store.commit("asset_cat", spark.createDataFrame([(1, "Equity", "UNKNOWN")], store.schemas["asset_cat"]))
    ledger = Ledger(spark, store, landing, as_of=dt.datetime(2025, 1, 15))
    ledger.update_asset()
    schema = PAYLOAD_SCHEMAS
    run_new_files(ledger, "income_statement", schema["income_statement"])
    assert store.read("income_statement").count() == 3 * len(QUARTERS)
    assert store.read("reporting_period").count() == 3 * (len(QUARTERS) + 1)
    run_new_files(ledger, "earnings", schema["earnings"], max_files_per_batch=1)
    before = rows(store.read("earning"), "reporting_period_id", "ref_date", "eps_actual")
    assert len(before) == 3 * 5
    later = os.path.getmtime(f"{landing}/earnings/AAPL.json") + 60
    write(f"{landing}/earnings/revision.json", [{"symbol": "AAPL", "date": "2024-05-02", "epsActual": 7.5}])
    os.utime(f"{landing}/earnings/revision.json", (later, later))
    assert len(run_new_files(ledger, "earnings", schema["earnings"], max_files_per_batch=1)) == 1
    after = rows(store.read("earning"), "reporting_period_id", "ref_date", "eps_actual")
    changed = [(a, b) for a, b in zip(before, after) if a != b]
    assert len(after) == len(before) and len(changed) == 1
    assert changed[0][0][1] == changed[0][1][1] == dt.date(2024, 5, 2) and changed[0][1][2] == 7.5
