"""The ledger's store and updates: what is written, kept, published and read."""

import datetime as dt
import json
import os
import threading

import pytest

from sparkledger.plans import pipelines
from sparkledger.plans.pipelines import Ledger, earning_payload, price_payload, profile_payload, typed_statement_rows
from sparkledger.schemas import PAYLOAD_SCHEMAS, TABLE_KEYS
from sparkledger.sources import BROKEN, FETCHED, CommitConflict, SnapshotStore, landed_texts, read_landed, unlisted_fields
from sparkledger.sources.bucketed import merged_buckets, write_bucketed
from sparkledger.streaming import run_new_files
from tests.conftest import rows
from tests.test_pipelines import SYMBOLS, build_landing, write
from tests.test_plans import plan

PRICES = PAYLOAD_SCHEMAS["historical_price"]


def new_ledger(spark, root, landing=None):
    store = SnapshotStore(spark, f"{root}/store")
    store.commit("asset_cat", spark.createDataFrame([(1, "Equity", "UNKNOWN")], store.schemas["asset_cat"]))
    return Ledger(spark, store, landing or f"{root}/landing", as_of=dt.datetime(2025, 1, 15))


def with_assets(spark, root):
    ledger = new_ledger(spark, root)
    ledger.store.commit("asset", spark.createDataFrame([(1, "AAPL", "Apple", 1, True, True), (2, "MSFT", None, 1, True, True)], ledger.store.schemas["asset"]))
    return ledger


def prices(spark, *data):
    return spark.createDataFrame(list(data), "symbol string, date string, close double, volume long")


def price_rows(spark, *data):
    return spark.createDataFrame([(i, 1, d, c) for i, (d, c) in enumerate(data)], "id long, asset_id long, end_date date, close double")


def data_folders(store, table):
    return {n for n in os.listdir(f"{store.root}/{table}") if n.startswith("_commit=")}


def test_identical_fetch_writes_no_folder(spark, scratch):
    ledger = with_assets(spark, scratch)
    store = ledger.store
    fetch = [("AAPL", "2023-03-01", 1.0, 1), ("AAPL", "2024-03-01", 2.0, None), ("MSFT", "2024-03-02", None, 3)]
    assert ledger.update_eod_price(payload=prices(spark, *fetch))["inserted"] == 3
    before = data_folders(store, "eod_price")
    again = ledger.update_eod_price(payload=prices(spark, *fetch))
    assert (again["version"], again["inserted"], again["updated"], again["rows"]) == (1, 0, 0, 3)
    assert data_folders(store, "eod_price") == before
    # One changed row rewrites its year only; a null replaces a value; a value moves between columns.
    fetch[1] = ("AAPL", "2024-03-01", None, 2)
    out = ledger.update_eod_price(payload=prices(spark, *fetch))
    assert (out["version"], out["inserted"], out["updated"]) == (2, 0, 1)
    old, new = dict(store.entries("eod_price", 1)), dict(store.entries("eod_price", 2))
    assert old["2023"] == new["2023"] and old["2024"] != new["2024"]
    # New keys alone are added in a folder of their own.
    out = ledger.update_eod_price(payload=prices(spark, *fetch, ("MSFT", "2024-03-05", 5.0, 5)))
    assert (out["inserted"], out["updated"]) == (1, 0)
    assert len([p for p, _ in store.entries("eod_price", 3) if p == "2024"]) == 2
    assert rows(store.read("eod_price"), "id", "asset_id", "end_date", "close", "volume") == [
        (1, 1, dt.date(2023, 3, 1), 1.0, 1), (2, 1, dt.date(2024, 3, 1), None, 2), (3, 2, dt.date(2024, 3, 2), None, 3), (4, 2, dt.date(2024, 3, 5), 5.0, 5)]
    assert store.read("eod_price", version=1).count() == 3


def test_a_payload_without_some_columns_keeps_them(spark, scratch):
    ledger = with_assets(spark, scratch)
    ledger.update_eod_price(payload=prices(spark, ("AAPL", "2024-03-01", 2.0, 7)))
    part = spark.createDataFrame([("AAPL", "2024-03-01", 2.0)], "symbol string, date string, close double")
    assert ledger.update_eod_price(payload=part)["updated"] == 0
    assert ledger.update_eod_price(payload=part.selectExpr("symbol", "date", "close + 1 as close"))["updated"] == 1
    assert rows(ledger.store.read("eod_price"), "close", "volume") == [(3.0, 7)]


def test_two_writers_of_one_version(spark, scratch):
    store = SnapshotStore(spark, f"{scratch}/store")
    store.commit("eod_price", price_rows(spark, (dt.date(2024, 1, 1), 1.0)))
    outcome = []

    def writer(value):
        try:
            outcome.append(store.commit("eod_price", price_rows(spark, (dt.date(2024, 1, 1), value)), base=1))
        except CommitConflict as e:
            outcome.append(e)

    first = threading.Thread(target=writer, args=(2.0,))
    first.start()
    first.join()
    writer(3.0)
    assert outcome[0] == 2 and isinstance(outcome[1], CommitConflict)
    assert store.version("eod_price") == 2 and rows(store.read("eod_price"), "close") == [(2.0,)]


def test_appends_are_merged_and_old_folders_expire(spark, scratch):
    store = SnapshotStore(spark, f"{scratch}/store")
    for day in range(1, 31):
        store.commit("eod_price", price_rows(spark, (dt.date(2024, 1, day), float(day))), appends=True)
        assert len(store.entries("eod_price", store.version("eod_price"))) <= 9
    version = store.compact("eod_price")
    assert len(store.entries("eod_price", version)) == 1 and store.compact("eod_price") == version
    assert sorted(r[0] for r in rows(store.read("eod_price"), "close")) == [float(d) for d in range(1, 31)]
    store.publish({"eod_price": 5})
    kept = {f for v in (5, version) for _, f in store.entries("eod_price", v)}
    os.makedirs(f"{store.root}/eod_price/_commit=busy")  # a writer at work
    assert store.expire("eod_price", keep=1) > 0
    assert {f"_commit={f}" for f in kept} | {"_commit=busy"} == data_folders(store, "eod_price")
    assert store.read("eod_price").count() == 30 and store.read_published("eod_price").count() == 5


def test_date_filter_opens_only_its_years(spark, scratch):
    store = SnapshotStore(spark, f"{scratch}/store")
    store.commit("eod_price", price_rows(spark, *[(dt.date(y, 6, 1), float(y)) for y in range(2015, 2025)]))
    got = store.read_since("eod_price", dt.date(2023, 1, 1))
    assert rows(got, "close") == [(2023.0,), (2024.0,)]
    shown = plan(got, "formatted")
    assert "_part" in shown.split("PartitionFilters:")[1].splitlines()[0]
    assert "GreaterThanOrEqual(end_date,2023-01-01)" in shown
    opened = {f.split("_part=")[1][:4] for f in got.inputFiles()}
    assert opened == {str(y) for y in range(2015, 2025)}  # inputFiles lists the relation, the filter prunes it:
    assert {r[0][-4:] for r in got.selectExpr("regexp_extract(input_file_name(), '_part=([0-9]+)', 1)").distinct().collect()} == {"2023", "2024"}
    with pytest.raises(ValueError):
        store.read_since("cpi", dt.date(2023, 1, 1))


def test_views_follow_the_newest_version_in_another_session(spark, scratch):
    store = SnapshotStore(spark, f"{scratch}/store")
    store.commit("eod_price", price_rows(spark, (dt.date(2023, 1, 1), 1.0), (dt.date(2024, 1, 1), 2.0)))
    store.commit("asset", spark.createDataFrame([], store.schemas["asset"]))
    assert store.register("ledger_views") == ["asset", "eod_price"]
    other = spark.newSession()
    assert other.table("ledger_views.eod_price").count() == 2 and other.table("ledger_views.asset").count() == 0
    assert other.table("ledger_views.eod_price").schema == store.read("eod_price").schema
    store.commit("eod_price", price_rows(spark, (dt.date(2024, 1, 1), 9.0)), replaces=["2024"])
    store.register("ledger_views")
    assert rows(other.table("ledger_views.eod_price"), "close") == [(1.0,), (9.0,)]


def test_broken_records_are_found(spark, scratch):
    os.makedirs(f"{scratch}/lines/fetched_at=2025-01-15T020000")
    with open(f"{scratch}/lines/fetched_at=2025-01-15T020000/a.json", "w") as f:
        f.write('{"symbol":"A","close":1.5,"added":{"x":1}}\n\n{"symbol":"B","close":"x"}\n{"symbol":"C","clo\n[1]\nnull\n{}\n')
    got = read_landed(spark, f"{scratch}/lines", PRICES, json_lines=True)
    assert sorted(r[0] for r in got.where(f"{BROKEN} is not null").select(BROKEN).collect()) == ['[1]', 'null', '{"symbol":"B","close":"x"}', '{"symbol":"C","clo']
    assert rows(got.where(f"{BROKEN} is null"), "symbol", "close") == [("A", 1.5), (None, None)]
    assert {str(r[0]) for r in got.select(FETCHED).collect()} == {"2025-01-15 02:00:00"}
    assert rows(unlisted_fields(landed_texts(spark.read, f"{scratch}/lines", True), PRICES)) == [("added", 1)]
    os.makedirs(f"{scratch}/arrays")
    for name, text in {"whole": '[{"symbol":"A","close":1.0},\n {"symbol":"B","volume":"q"}, 5]', "torn": '[{"symbol":"A"},{"sym', "one": '{"symbol":"S"}', "none": "[]", "blank": " \n"}.items():
        with open(f"{scratch}/arrays/{name}.json", "w") as f:
            f.write(text)
    got = read_landed(spark, f"{scratch}/arrays", PRICES)
    assert rows(got.where(f"{BROKEN} is null"), "symbol") == [("A",), ("S",)]
    assert sorted(r[0] for r in got.where(f"{BROKEN} is not null").select(BROKEN).collect()) == ['5', '[{"symbol":"A"},{"sym', '{"symbol":"B","volume":"q"}']


def test_same_run_twice_same_rejects(spark, scratch):
    ledger = with_assets(spark, scratch)
    write(f"{ledger.landing}/historical_price/a.json", [{"symbol": "AAPL", "date": "soon", "close": 1.0}, {"symbol": "ZZ", "date": "2024-03-01"}, {"symbol": "AAPL", "date": "2024-03-01", "close": 2.0}])
    with open(f"{ledger.landing}/historical_price/torn.json", "w") as f:
        f.write('[{"symbol":"MSFT","date":"2024-03-01","close":3.0},{"symbol"')
    first = ledger.update_eod_price()
    kept = rows(ledger.rejects("eod_price"))
    assert sorted((v, r, json.loads(t).get("symbol")) for v, _, r, t, _ in kept) == [(1, "corrupt", None), (1, "undated", "AAPL"), (1, "unmapped", "ZZ")]
    assert "MSFT" in next(t for _, _, r, t, _ in kept if r == "corrupt")
    assert ledger.update_eod_price() == {**first, "inserted": 0}
    assert rows(ledger.rejects("eod_price")) == kept
    # A dead run's rejects are in a folder that no marker names.
    ledger.rejects("eod_price").drop("version").write.parquet(f"{ledger.store.root}/eod_price/_rejects/_commit=dead")
    assert rows(ledger.rejects("eod_price")) == kept
    # Rejects alone make a version of the same rows.
    write(f"{ledger.landing}/historical_price/b.json", [{"symbol": "YY", "date": "2024-03-01"}])
    assert ledger.update_eod_price()["version"] == 2 and ledger.store.read("eod_price").count() == 1
    assert ledger.rejects("eod_price").count() == 4


def test_rejects_of_a_commit_are_not_dealt_out_by_commit(spark, scratch):
    store = SnapshotStore(spark, f"{scratch}/store")
    lost = "as_of timestamp, reason string, row string, hash long"
    at = [dt.datetime(2025, 1, d) for d in (1, 2)]
    first = spark.createDataFrame([(at[0], "corrupt", f"r{i}", i) for i in range(50)], lost)
    again = spark.createDataFrame([(at[1], "corrupt", f"r{i}", i) for i in range(40, 60)] * 2, lost)
    assert store.new_rejects("eod_price", first).count() == 50
    store.add_rejects("eod_price", first, 0)
    new = store.new_rejects("eod_price", again)
    assert rows(new, "row") == [(f"r{i}",) for i in range(50, 60)]
    # A second commit that repeats rejects: each counts once, under the version that met it first.
    store.add_rejects("eod_price", again, 1)
    assert store.rejects("eod_price").where("version = 1").count() == 50
    assert rows(store.rejects("eod_price").where("version = 2"), "as_of", "row") == [(at[1], f"r{i}") for i in range(50, 60)]
    # All rejects of a commit share its folder; an exchange by it would bring them into one task.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the rejects were many
    try:
        assert "hashpartitioning(_commit" not in plan(store.rejects("eod_price")) + plan(new)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_statement_without_a_period_is_rejected(spark, scratch):
    landing = f"{scratch}/landing"
    build_landing(landing)
    ledger = new_ledger(spark, scratch, landing)
    ledger.update_asset()
    ledger.update_reporting_period(["AAPL"])
    assert ledger.update_statement("income_statement")["inserted"] == 4
    lost = ledger.rejects("income_statement").where("reason = 'no_period'")
    assert lost.count() == 2 * 4


def test_killed_run_is_taken_up_and_published_at_once(spark, scratch, monkeypatch):
    landing = f"{scratch}/landing"
    build_landing(landing)
    ledger = new_ledger(spark, scratch, landing)
    ledger.update_all()
    before = {t: rows(ledger.table(t)) for t in TABLE_KEYS if t != "earning_report"}
    for folder, field in (("profile", "price"), ("income_statement", "revenue"), ("historical_price", "close")):
        path = f"{landing}/{folder}/AAPL.json"
        with open(path) as f:
            doc = json.load(f)
        doc[0][field] = 77
        write(f"{landing}/{folder}/later-AAPL.json", doc)
        late = os.path.getmtime(path) + 60
        os.utime(f"{landing}/{folder}/later-AAPL.json", (late, late))
    real, called = Ledger.update_statement, []

    def dies(self, table, *args, **kw):
        called.append(table)
        if table == "balance_sheet_statement":
            raise RuntimeError("killed")
        return real(self, table, *args, **kw)

    monkeypatch.setattr(Ledger, "update_statement", dies)
    with pytest.raises(RuntimeError, match="killed"):
        ledger.update_all()
    assert {t: rows(ledger.table(t)) for t in before} == before  # readers still see the run before
    assert rows(ledger.store.read("equity_profile")) != before["equity_profile"]
    monkeypatch.setattr(Ledger, "update_statement", real)
    monkeypatch.setattr(Ledger, "update_equity_profile", lambda *a, **k: pytest.fail("a finished step runs again"))
    out = ledger.update_all()
    assert set(out) == set(before) and out["equity_profile"]["updated"] == 1
    monkeypatch.undo()
    whole = new_ledger(spark, f"{scratch}/whole", landing)
    whole.update_all()
    for t in before:
        assert rows(ledger.table(t)) == rows(whole.table(t)), t


def test_first_hit_of_the_newest_fetch(spark, scratch):
    ledger = new_ledger(spark, scratch)
    for day, hits in (("2025-01-01", [("XB", 2, "XB"), ("XB", 1, "XB1")]), ("2025-01-02", [("XB", 1, "XB"), ("XB", 2, "XB1"), ("YB", 1, "YB.L")])):
        write(f"{ledger.landing}/search/fetched_at={day}/a.json", [{"query": q, "position": p, "symbol": s, "name": ""} for q, p, s in hits])
    ledger.update_asset(["XB", "YB"])
    assert rows(ledger.store.read("asset"), "symbol") == [("XB",), ("YB.L",)]


def test_two_fetches_in_one_micro_batch(spark, scratch):
    ledger = with_assets(spark, scratch)
    for name, close, at in (("a", 1.0, 1_700_000_000), ("b", 2.0, 1_700_000_100), ("c", 0.5, 1_699_999_000)):
        path = f"{ledger.landing}/historical_price/{name}.json"
        write(path, [{"symbol": "AAPL", "date": "2024-03-01", "close": close}])
        os.utime(path, (at, at))
    with open(f"{ledger.landing}/historical_price/torn.json", "w") as f:
        f.write('[{"symbol": "AAPL"')
    assert len(run_new_files(ledger, "historical_price", PRICES)) == 1
    assert rows(ledger.store.read("eod_price"), "close") == [(2.0,)]
    assert rows(ledger.rejects("eod_price"), "reason") == [("corrupt",)]


def test_new_report_needs_no_earlier_file(spark, scratch):
    landing = f"{scratch}/landing"
    build_landing(landing)
    ledger = new_ledger(spark, scratch, landing)
    ledger.update_asset()
    ledger.update_reporting_period()
    ledger.update_earning()
    before = rows(ledger.store.read("earning"), "reporting_period_id", "ref_date", "eps_actual")
    # The new report alone: the landed files of the older ones are not read again.
    delta = spark.createDataFrame([("AAPL", "2024-05-02", 7.5)], "symbol string, date string, eps_actual double")
    folder = {f for p, f in ledger.store.entries("earning_report", 1)}
    ledger.landing = f"{scratch}/gone"
    ledger.update_earning(payload=delta)
    after = rows(ledger.store.read("earning"), "reporting_period_id", "ref_date", "eps_actual")
    changed = [(a, b) for a, b in zip(before, after) if a != b]
    assert len(after) == len(before) and len(changed) == 1 and changed[0][1][1:] == (dt.date(2024, 5, 2), 7.5)
    same = [p for p, f in ledger.store.entries("earning_report", 2) if f in folder]
    assert len(same) == len({p for p, _ in ledger.store.entries("earning_report", 1)}) - 1  # one partition of the state was rewritten


def test_bucketed_upsert_moves_the_payload_only(spark, scratch):
    stored = spark.range(1, 200).selectExpr("id", "id * 2 as k", "concat('v', id) as val", "cast(null as string) as kept")
    new = spark.range(90, 110).selectExpr("id * 3 as k", "'n' as val").unionByName(spark.createDataFrame([(None, "x")], "k long, val string"))
    t = write_bucketed(stored, "bucketed_test_before", ["k"], 4, f"{scratch}/b1")
    after = merged_buckets(t, new, ["k"])
    lines = plan(after).splitlines()
    scan = next(i for i, line in enumerate(lines) if "bucketed_test_before" in line)
    join = next(i for i, line in enumerate(lines) if "FullOuter" in line)
    assert join < scan and not any("Exchange" in line for line in lines[join + 1:scan + 1]), "\n".join(lines)
    kept = write_bucketed(after, "bucketed_test_after", ["k"], 4, f"{scratch}/b2", dealt=True)
    assert kept.count() == 199 + len({i * 3 for i in range(90, 110)} - {i * 2 for i in range(1, 200)})
    assert len([n for n in os.listdir(f"{scratch}/b2") if n.endswith(".parquet")]) == 4
    assert sorted(r[0] for r in kept.where("val = 'n'").select("k").collect()) == [i * 3 for i in range(90, 110)]
    with pytest.raises(Exception, match="(?i)exists"):
        write_bucketed(stored, "bucketed_test_before", ["k"], 4, f"{scratch}/b3")


def test_rows_without_an_asset_are_left_out_before_any_ranking(spark):
    amap = spark.createDataFrame([("AAPL", 1)], "symbol string, id long")
    statements = spark.createDataFrame([("AAPL", "2024-01-31", "2024", "Q1", None, None, 5), ("OTHER", "2024-01-31", "2024", "Q1", None, None, 6)],
                                       "symbol string, date string, fiscal_year string, period string, filing_date string, accepted_date string, revenue long")
    periods = spark.createDataFrame([(7, 1, dt.datetime(2024, 1, 31))], "id long, asset_id long, accepted_date timestamp")
    days = statements.select("symbol", "date", "revenue")
    typed = typed_statement_rows(statements, amap)
    assert rows(typed, "asset_id", "fiscal_year", "revenue") == [(1, 2024, 5)] and "symbol" not in typed.columns
    found = [typed, profile_payload(days, amap), price_payload(days, amap, dt.date(2024, 2, 1)),
             earning_payload(days, amap, periods, dt.datetime(2024, 3, 1))[0]]
    assert [rows(df, "revenue") for df in found] == [[(5,)]] * 4
    for df in found[:3]:
        p = plan(df)
        assert "Join" in p and p.rindex("Window") < p.rindex("Join")  # plans read upwards


def test_a_first_load_writes_rows_and_rejects_without_a_second_pass(spark, scratch, monkeypatch):
    ledger, written, commits = with_assets(spark, scratch), [], []
    stage, commit = pipelines.staged, ledger.store.commit
    monkeypatch.setattr(pipelines, "staged", lambda df: written.append(df.columns) or stage(df))
    monkeypatch.setattr(ledger.store, "commit", lambda table, df, **more: commits.append(plan(more["rejects"])) or commit(table, df, **more))
    fetch = prices(spark, ("AAPL", "2024-03-01", 1.0, 1), ("NONE", "2024-03-01", 2.0, 2), ("NONE", "2024-03-01", 2.0, 2))
    out = ledger.update_eod_price(payload=fetch)
    assert (out["inserted"], out["rejects"], out["version"]) == (1, 2, 1)
    # The landed rows, the prepared rows and the new rejects; the commit reads those instead of deriving them again.
    assert len(written) == 3 and "Exchange" not in commits[0]
    assert ledger.rejects("eod_price").count() == 1
    out = ledger.update_eod_price(payload=fetch)
    assert (out["inserted"], out["updated"], out["rejects"], out["version"]) == (0, 0, 2, 1)
