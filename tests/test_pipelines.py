import datetime as dt
import json
import os

import pytest

from sparkledger.plans.pipelines import Ledger
from sparkledger.sources import SnapshotStore
from tests.conftest import rows
from tests.test_sources import SERIES_DOC

SYMBOLS = ["AAPL", "MSFT", "NVDA"]
QUARTERS = [("2024-09-28", "2024", "Q4", "2024-11-02 07:15:00"), ("2024-06-29", "2024", "Q3", "2024-08-02 06:01:00"),
            ("2024-03-30", "2024", "Q2", "2024-05-03 06:01:00"), ("2023-12-30", "2024", "Q1", "2024-02-02 06:01:00")]


def write(path, obj):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        json.dump(obj, f)


def build_landing(root):
    write(f"{root}/cpi/2024.json", SERIES_DOC)
    write(f"{root}/screener/all.json", [
        {"symbol": s, "marketCap": 3e12 - i, "country": "US", "isEtf": False, "isFund": False,
         "isActivelyTrading": True} for i, s in enumerate(SYMBOLS)] + [
        {"symbol": "SPY", "marketCap": 5e11, "country": "US", "isEtf": True, "isFund": False,
         "isActivelyTrading": True}])
    for s in SYMBOLS:
        write(f"{root}/search/{s}.json", [{"symbol": s, "name": f"{s} Inc."}, {"symbol": f"{s}.X", "name": ""}])
        write(f"{root}/profile/{s}.json", [{"symbol": s, "companyName": f"{s} Inc.", "currency": "USD",
                                            "exchange": "NASDAQ", "industry": "", "sector": "Technology",
                                            "country": "US", "mktCap": 3000000, "price": 190.5, "beta": 1.2}])
        stm = [{"date": d, "symbol": s, "fiscalYear": fy, "period": p, "filingDate": a[:10], "acceptedDate": a,
                "reportedCurrency": "USD", "revenue": 1000 + i, "costOfRevenue": 400, "grossProfit": 600 + i,
                "operatingIncome": 300, "netIncome": 200 + i, "eps": 0.97, "epsDiluted": 0.96}
               for i, (d, fy, p, a) in enumerate(QUARTERS)]
        write(f"{root}/income_statement/{s}.json", stm)
        write(f"{root}/balance_sheet_statement/{s}.json", [
            {"date": d, "symbol": s, "fiscalYear": fy, "period": p, "filingDate": a[:10], "acceptedDate": a,
             "totalAssets": 10, "totalLiabilities": 4, "totalEquity": 6} for d, fy, p, a in QUARTERS])
        write(f"{root}/cash_flow_statement/{s}.json", [
            {"date": d, "symbol": s, "fiscalYear": fy, "period": p, "filingDate": a[:10], "acceptedDate": a,
             "operatingCashFlow": 5, "capitalExpenditure": -1, "freeCashFlow": 4} for d, fy, p, a in QUARTERS])
        write(f"{root}/earnings/{s}.json", [
            {"symbol": s, "date": d, "epsActual": 1.0, "epsEstimated": 0.9, "revenueActual": 10,
             "revenueEstimated": 9}
            for d in ["2025-04-30", "2025-01-30", "2024-10-31", "2024-08-01", "2024-05-02", "2024-02-01"]])
        write(f"{root}/historical_price/{s}.json", [
            {"symbol": s, "date": f"2024-11-{day:02d}", "open": 1.0, "high": 2.0, "low": 0.5, "close": 1.5,
             "volume": 100 * day} for day in range(1, 6)] + [
            {"symbol": s, "date": "2015-01-02", "open": 1.0, "high": 1.0, "low": 1.0, "close": 1.0, "volume": 1}])


@pytest.fixture
def ledger(spark, scratch):
    landing = f"{scratch}/landing"
    build_landing(landing)
    store = SnapshotStore(spark, f"{scratch}/store")
    store.commit("asset_cat", spark.createDataFrame([(1, "Equity", "UNKNOWN"), (2, "Fund", "ETF")],
                                                    store.schemas["asset_cat"]))
    return Ledger(spark, store, landing, as_of=dt.datetime(2025, 1, 15))


def test_update_all_and_idempotent(spark, ledger):
    ledger.update_all()
    st = ledger.store
    assert rows(st.read("asset"), "id", "symbol", "description", "asset_cat_id") == [
        (1, "AAPL", "AAPL Inc.", 1), (2, "MSFT", "MSFT Inc.", 1), (3, "NVDA", "NVDA Inc.", 1)]
    assert rows(st.read("cpi"), "year", "month", "series_value") == [(2024, 11, 103.5), (2024, 12, 104.25)]
    periods = st.read("reporting_period")
    assert periods.count() == 3 * (len(QUARTERS) + 1)
    assert periods.filter("period = 'NA' AND fiscal_year = 4000").count() == 3
    assert st.read("income_statement").count() == 3 * len(QUARTERS)
    assert st.read("balance_sheet_statement").count() == 3 * len(QUARTERS)
    assert st.read("eod_price").count() == 3 * 5          # the 2015 row is outside the look-back
    assert st.read("equity_profile").filter("industry IS NULL").count() == 3
    earning = st.read("earning")
    # Per symbol: 4 reported quarters align (the cut-off is the newest real
    # report + 2 weeks) and the two estimates collapse onto the placeholder.
    assert earning.count() == 3 * 5
    snaps = {t: rows(st.read(t)) for t in ["asset", "cpi", "reporting_period", "income_statement", "earning",
                                           "eod_price", "equity_profile"]}
    ledger.update_all()
    for t, before in snaps.items():
        assert rows(st.read(t)) == before, t


def test_symbol_subset_and_unknown(spark, ledger):
    ledger.update_asset(["AAPL", "MSFT"])
    assert rows(ledger.store.read("asset"), "symbol") == [("AAPL",), ("MSFT",)]
    ledger.update_reporting_period(["AAPL"])
    assert ledger.store.read("reporting_period").select("asset_id").distinct().count() == 1
    with pytest.raises(ValueError):
        ledger.update_equity_profile(["AAPL", "ZZZZ"])


def test_update_reports_counts_without_extra_pass(spark, ledger):
    assert ledger.update_asset()["inserted"] == 3
    assert ledger.update_asset()["inserted"] == 0
    first = ledger.update_reporting_period()
    assert (first["inserted"], first["updated"]) == (3 * 5, 0)
    again = ledger.update_reporting_period()
    assert (again["inserted"], again["updated"], again["version"]) == (0, 0, first["version"])
    out = ledger.update_earning()
    assert out["rows"] == 3 * 5 and out["rejects"] == 0
    assert out["unaligned"] == 0 and out["inserted"] == 3 * 5


def test_empty_payload_changes_nothing(spark, ledger):
    ledger.update_asset()
    ledger.update_eod_price()
    before = rows(ledger.store.read("eod_price"))
    empty = spark.createDataFrame([], "symbol string, date string, close double, volume long")
    out = ledger.update_eod_price(payload=empty)
    assert out["rows"] == 0 and out["rejects"] == 0
    assert rows(ledger.store.read("eod_price")) == before


def test_two_fetches_in_every_folder(spark, ledger):
    """A second fetch with the same and revised rows: limits and ranks see each key once, new values win."""
    ledger.update_all()
    before = {t: rows(ledger.store.read(t)) for t in ("income_statement", "earning", "eod_price", "equity_profile", "cpi")}
    root = ledger.landing
    late = 0
    for folder, name in [(f, n) for f in os.listdir(root) for n in os.listdir(f"{root}/{f}")]:
        path = f"{root}/{folder}/{name}"
        with open(path) as f:
            doc = json.load(f)
        if folder == "historical_price" and name == "MSFT.json":
            doc[0]["close"] = 2.5
        if folder == "profile" and name == "NVDA.json":
            doc[0]["price"] = 1.25
        if folder == "income_statement" and name == "AAPL.json":
            doc[0]["revenue"] = 9999
        late = os.path.getmtime(path) + 60
        write(f"{root}/{folder}/again-{name}", doc)
        os.utime(f"{root}/{folder}/again-{name}", (late, late))
    ledger.update_all()
    after = {t: rows(ledger.store.read(t)) for t in before}
    assert after["earning"] == before["earning"] and after["cpi"] == before["cpi"]
    for table, old, new in (("eod_price", 1.5, 2.5), ("equity_profile", 190.5, 1.25), ("income_statement", 1000, 9999)):
        changed = [(a, b) for a, b in zip(before[table], after[table]) if a != b]
        assert len(before[table]) == len(after[table]) and len(changed) == 1
        assert old in changed[0][0] and new in changed[0][1]


def test_rejects_are_kept(spark, ledger):
    ledger.update_asset()
    write(f"{ledger.landing}/historical_price/other.json", [
        {"symbol": "ZZZZ", "date": "2024-11-01", "close": 1.0}, {"symbol": "AAPL", "date": "2024-11-31", "close": 1.0}])
    ledger.update_reporting_period()
    out = ledger.update_eod_price()
    assert out["rejects"] == 2
    got = sorted((r.reason, json.loads(r.row)["symbol"]) for r in ledger.rejects("eod_price").collect())
    assert got == [("undated", "AAPL"), ("unmapped", "ZZZZ")]
    write(f"{ledger.landing}/earnings/odd.json", [{"symbol": "ZZZZ", "date": "2024-11-01"}])
    assert ledger.update_earning()["rejects"] == 1
    assert ledger.update_eod_price(["AAPL"])["rejects"] == 1  # the others were not asked for


def test_limits_are_arguments(spark, ledger):
    ledger.update_asset()
    ledger.update_reporting_period(limit=2)
    assert ledger.store.read("reporting_period").count() == 3 * (2 + 1)
    ledger.update_eod_price(days=20_000)
    assert ledger.store.read("eod_price").count() == 3 * 6
