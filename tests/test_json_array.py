"""Large JSON arrays: reading by byte ranges equals reading whole."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkledger.sources import BROKEN, array_texts, json_array, read_array

DEEP = T.ArrayType(T.StructType([T.StructField("k", T.StringType())]))
MORE = T.StructType([T.StructField("note", T.StringType()), T.StructField("deep", DEEP)])
SCHEMA = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("price", T.LongType()), T.StructField("more", MORE)])


@pytest.fixture
def small_blocks(spark):
    """Byte ranges of 48 bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    for n, v in zip(names, ("48", "1"), strict=True):
        spark.conf.set(n, v)
    yield
    for n, v in zip(names, before, strict=True):
        spark.conf.set(n, v)


def land(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8", newline="") as f:
        f.write(text)


def records(rng, n):
    nasty = ['"', "}", "{", "\\", "]", ",", "é", "\n", "x", "}\\\"", "{\"a\":1}"]
    some = lambda k: "".join(rng.choice(nasty) for _ in range(rng.randint(0, k)))
    return [{"symbol": some(8), "price": i, "more": rng.choice([None, {"note": some(30), "deep": [{"k": some(3)} for _ in range(rng.randint(0, 3))]}])} for i in range(n)]


def test_equals_json(spark, scratch, small_blocks, monkeypatch):
    monkeypatch.setattr(json_array, "RECORD_BLOCKS", 60)
    rng = random.Random(5)
    want = []
    for name, indent, ascii_only in (("a.json", None, True), ("b.json", 2, False), ("c.json", 1, True)):
        found = records(rng, 25)
        want += found
        land(f"{scratch}/arrays", name, json.dumps(found, indent=indent, ensure_ascii=ascii_only) + ("\n" if indent else ""))
    texts = array_texts(spark, f"{scratch}/arrays").select("_text").collect()
    key = lambda r: json.dumps(r, sort_keys=True)
    assert sorted((json.loads(r["_text"]) for r in texts), key=key) == sorted(want, key=key)
    read = read_array(spark, f"{scratch}/arrays", SCHEMA)
    assert read.where(F.col(BROKEN).isNotNull()).count() == 0
    got = [(r.symbol, r.price, r.more and r.more.asDict(recursive=True)) for r in read.collect()]
    assert sorted(got, key=str) == sorted(((r["symbol"], r["price"], r["more"]) for r in want), key=str)
    assert spark.read.text(f"{scratch}/arrays", lineSep="}").rdd.getNumPartitions() > 20


def test_whatever_is_no_array_of_objects_is_seen(spark, scratch, small_blocks):
    good = [{"symbol": f"S{i}", "price": i, "more": {"note": "x" * (i % 40)}} for i in range(30)]
    land(f"{scratch}/odd", "torn.json", json.dumps(good)[:-9])
    land(f"{scratch}/odd", "one.json", '{"symbol": "ONE", "price": 1}')
    land(f"{scratch}/odd", "part.json", '{"symbol": "P1", "price": 1},\n{"symbol": "P2", "price": 2},\n')
    land(f"{scratch}/odd", "open.json", '{"symbol": "OPEN", "price": 1')
    land(f"{scratch}/odd", "number.json", '[{"symbol": "N1", "price": 1}, 7, {"symbol": "N2", "price": 2}]')
    land(f"{scratch}/odd", "string.json", '[{"symbol": "Q1", "price": 1}, {"symbol": "Q2, "price": 2}]')
    for name, text in (("empty.json", ""), ("none.json", "[]"), ("blank.json", " [ \n ] \n")):
        land(f"{scratch}/odd", name, text)
    read = read_array(spark, f"{scratch}/odd", SCHEMA).collect()
    whole = sorted(r.symbol for r in read if r[BROKEN] is None)
    assert whole == sorted([f"S{i}" for i in range(29)] + ["ONE", "P1", "P2", "N1", "Q1"])
    broken = " ".join(r[BROKEN] for r in read if r[BROKEN] is not None)
    assert all(t in broken for t in ('"S29"', '"OPEN"', "7, {", "Q2"))


def test_a_record_over_many_blocks_is_not_gathered(spark, scratch, small_blocks):
    land(f"{scratch}/long", "a.json", '[{"symbol": "A", "price": 1}, {"symbol": "' + "} " * 400 + '", "price": 2}, {"symbol": "B", "price": 3}]')
    read = read_array(spark, f"{scratch}/long", SCHEMA).collect()
    assert sorted(r.symbol for r in read if r[BROKEN] is None) == ["A", "B"]
    broken = [r[BROKEN] for r in read if r[BROKEN] is not None]
    assert len(broken) > 4 and sum(t.count("}") for t in broken) == 401


def test_an_empty_folder(spark, scratch):
    os.makedirs(f"{scratch}/nothing")
    assert read_array(spark, f"{scratch}/nothing", SCHEMA).count() == 0
