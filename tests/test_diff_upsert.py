from pyspark.sql import functions as F

from sparkledger.operators import append, new_rows, next_id, reattach_key, update_non_null, updated_rows, upsert
from tests.conftest import rows


def old_new(spark):
    """Stored codes 1-3; a payload that revises one, repeats one and adds two."""
    old = spark.createDataFrame(
        [(1, "K-10", "kettle"), (2, "L-20", "lamp"), (3, "M-30", "mirror")],
        "id long, symbol string, description string")
    new = spark.createDataFrame(
        [("K-10", "kettle"), ("L-20", "floor lamp"), ("N-40", "notebook"), ("P-50", "pan")],
        "symbol string, description string")
    return old, new


def test_new_and_updated_rows(spark):
    old, new = old_new(spark)
    assert rows(new_rows(old, new, ["symbol"]), "symbol") == [("N-40",), ("P-50",)]
    assert rows(updated_rows(old, new, "symbol"), "symbol") == [("K-10",), ("L-20",)]


def test_no_new_no_overlap(spark):
    old, _ = old_new(spark)
    same = spark.createDataFrame([("K-10", "kettle"), ("L-20", "lamp")], "symbol string, description string")
    other = spark.createDataFrame([("N-40", "notebook"), ("P-50", "pan")], "symbol string, description string")
    assert new_rows(old, same, "symbol").count() == 0
    assert updated_rows(old, other, "symbol").count() == 0


def test_empty_old_table(spark):
    _, new = old_new(spark)
    empty = spark.createDataFrame([], "symbol string, description string")
    assert new_rows(empty, new, "symbol").count() == 4
    assert updated_rows(empty, new, "symbol").count() == 0


def test_reattach_key(spark):
    old, new = old_new(spark)
    out = reattach_key(updated_rows(old, new, "symbol"), old, "symbol")
    assert rows(out, "symbol", "id") == [("K-10", 1), ("L-20", 2)]


def test_upsert_presence_flag_and_ids(spark):
    old, _ = old_new(spark)
    old = old.withColumn("sector", F.lit("home"))
    new = spark.createDataFrame(
        [("L-20", None), ("N-40", "notebook"), ("P-50", "pan")], "symbol string, description string")
    snap = upsert(old, new, "symbol", pk="id")
    got = rows(snap, "id", "symbol", "description", "sector")
    assert got == [
        (1, "K-10", "kettle", "home"),       # untouched
        (2, "L-20", None, "home"),          # null in payload overwrites; absent column kept
        (3, "M-30", "mirror", "home"),
        (4, "N-40", "notebook", None),          # new ids after max, in key order
        (5, "P-50", "pan", None),
    ]
    # a second identical run changes nothing
    assert rows(upsert(snap, new, "symbol", pk="id")) == rows(snap)


def test_upsert_into_empty_table(spark):
    empty = spark.createDataFrame([], "id long, symbol string, description string")
    _, new = old_new(spark)
    snap = upsert(empty, new, "symbol", pk="id", first_id=10)
    assert rows(snap, "id", "symbol") == [(10, "K-10"), (11, "L-20"), (12, "N-40"), (13, "P-50")]


def test_append_and_update_non_null(spark):
    old, new = old_new(spark)
    out = append(old, new_rows(old, new, "symbol"))
    assert out.columns == old.columns and out.count() == 5
    right = spark.createDataFrame([("K-10", None), ("L-20", "floor lamp")], "symbol string, description string")
    upd = update_non_null(old, right, "symbol")
    assert rows(upd, "symbol", "description") == [("K-10", "kettle"), ("L-20", "floor lamp"), ("M-30", "mirror")]


def test_upsert_of_the_touched_part_equals_the_full_merge(spark):
    stored = spark.createDataFrame(
        [(i, 1 + i % 3, 2000 + i % 10, f"v{i}") for i in range(60)], "id long, asset long, year long, val string"
    ).dropDuplicates(["asset", "year"])
    incoming = spark.createDataFrame(
        [(a, y, f"n{a}{y}") for a in (1, 2, 4) for y in (2007, 2008, 2009, 2010)], "asset long, year long, val string")
    full = upsert(stored, incoming, ["asset", "year"], pk="id")
    part = upsert(stored.filter("year >= 2007"), incoming, ["asset", "year"], pk="id", first_id=next_id(stored, "id"))
    assert rows(part.unionByName(stored.filter("year < 2007"))) == rows(full)
    empty = spark.createDataFrame([], "asset long, year long, val string")
    assert rows(upsert(stored, empty, ["asset", "year"], pk="id")) == rows(stored)
