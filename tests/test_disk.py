"""What an update leaves on disk: its tables and rejects, and nothing it has only worked with."""

import os

import pytest

from sparkledger.plans.ledger_queries import land
from sparkledger.plans.pipelines import STEP_ENDPOINTS, Ledger, unmapped, with_asset_id
from sparkledger.schemas import PAYLOAD_SCHEMAS
from sparkledger.session import SHUFFLE_CLEANUP, ensure_checkpoint_dir, staged
from sparkledger.session import scratch as scratch_of
from sparkledger.sources import FETCHED, read_payload
from tests.conftest import rows
from tests.test_ledger import new_ledger, prices, with_assets
from tests.test_pipelines import build_landing
from tests.test_plans import plan


def staged_folders(spark):
    return {n for n in os.listdir(ensure_checkpoint_dir(spark).removeprefix("file:")) if n.startswith("staged-")}


def shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {n for top in dirs for _, _, names in os.walk(str(top)) for n in names if n.startswith("shuffle_")}


def test_a_run_leaves_no_intermediate_table(spark, scratch, monkeypatch):
    landing = f"{scratch}/landing"
    build_landing(landing)
    ledger, before = new_ledger(spark, scratch, landing), staged_folders(spark)
    kept = staged(spark.range(3))  # made outside of the run
    mine = staged_folders(spark)
    real, seen = Ledger.update_statement, []

    def watched(self, table, *args, **kw):
        out = real(self, table, *args, **kw)
        seen.append(len(staged_folders(spark) - mine))
        return out

    monkeypatch.setattr(Ledger, "update_statement", watched)
    out = ledger.update_all()
    # Between two steps there are the parsed rows of this step's folder at most: no later step reads others again.
    assert seen == [1, 1, 1] and set(STEP_ENDPOINTS) == set(out)
    assert staged_folders(spark) == mine and len(mine - before) == 1 and kept.count() == 3
    ledger.update_earning()
    assert staged_folders(spark) == mine
    monkeypatch.setattr(Ledger, "update_statement", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        ledger.update_all()
    assert staged_folders(spark) == mine


def test_shuffle_files_go_with_their_query(spark):
    before, at = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP, "false")
    with scratch_of(spark):
        dealt = staged(spark.range(1000).repartition(4, "id"))
        assert dealt.groupBy((dealt.id % 7).alias("k")).count().count() == 7
        assert shuffle_files(spark) <= before
    assert spark.conf.get(SHUFFLE_CLEANUP) == at
    with pytest.raises(ZeroDivisionError), scratch_of(spark):
        assert 1 / 0
    assert spark.conf.get(SHUFFLE_CLEANUP) == at


def test_rejects_are_stored_as_their_text_alone(spark, scratch):
    ledger = with_assets(spark, scratch)
    fetch = prices(spark, ("AAPL", "2024-03-01", 1.0, 1), ("NONE", "2024-03-01", 2.0, 2), ("NONE", "2024-03-01", 2.0, 2), ("ALSO", "2024-03-01", 2.0, 2))
    ledger.update_eod_price(payload=fetch)
    files = spark.read.parquet(f"{ledger.store.root}/eod_price/_rejects")
    assert set(files.columns) == {"as_of", "reason", "row", "_commit"} and files.count() == 2
    kept = ledger.rejects("eod_price")
    assert kept.columns == ["version", "as_of", "reason", "row", "hash"] and kept.where("hash = xxhash64(reason, row)").count() == 2
    # A store whose files have the hash is read as before, and what it knows is not kept again.
    kept.select("as_of", "reason", "row", "hash").write.parquet(f"{ledger.store.root}/earning/_rejects/_commit=old")
    ledger.store._mark("earning", 1, [(1, "rejects", None, "old", 2, None)])
    assert rows(ledger.rejects("earning")) == rows(kept)
    more = kept.select("as_of", "reason", "row").unionByName(spark.sql("select timestamp'2025-01-15' as as_of, 'corrupt' as reason, 'x' as row"))
    assert rows(ledger.store.new_rejects("earning", more.unionByName(more)), "reason", "row") == [("corrupt", "x")]


def test_a_payload_is_not_dealt_out_to_meet_the_asset_map(spark, scratch):
    ledger = with_assets(spark, scratch)
    fetch = staged(prices(spark, ("AAPL", "2024-03-01", 1.0, 1), ("NONE", "2024-03-01", 2.0, 2)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the planner knew no sizes
    try:
        amap = ledger._amap("has_chart", None)
        for df in (with_asset_id(fetch, amap), unmapped(fetch, amap)):
            lines = plan(df).splitlines()
            scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "close" in line)
            assert "BroadcastHashJoin" in plan(df) and not any("Exchange" in line for line in lines[:scan])
            assert df.count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_landing_is_compressed(spark, scratch):
    fetch = prices(spark, *[("AAPL", f"2024-03-{d:02d}", float(d), d) for d in range(1, 20)])
    land(fetch, scratch, "historical_price")
    found = [n for _, _, names in os.walk(f"{scratch}/historical_price") for n in names if n.startswith("part-")]
    assert found and all(n.endswith(".json.gz") for n in found)
    got = read_payload(spark, f"{scratch}/historical_price", PAYLOAD_SCHEMAS["historical_price"], json_lines=True)
    assert rows(got.drop(FETCHED), "symbol", "date", "close", "volume") == rows(fetch)
