"""Operator 9 against brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest

from sparkledger.llm import repeats


def brute(rows, window):
    texts = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, texts):
        gone = {x for k in range(len(w) - window + 1) if seen[tuple(w[k:k + window])] > 1 for x in range(k, k + window)}
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def sample_rows():
    rng = random.Random(3)
    word = lambda a: rng.choice(a)
    passage = " ".join(word("abcdéf") + word("xyz") for _ in range(50))
    rows = [(i, " ".join(word("abcdefgh") for _ in range(rng.randint(0, 60)))) for i in range(40)]
    rows += [(100 + i, " ".join(word("xyzw") for _ in range(30)) + " " + passage + "\n" + " ".join(word("xyzw") for _ in range(30))) for i in range(40)]
    return rows + [(200, passage), (200, passage), (201, None), (None, "a b"), (None, passage + " q"), (202, ""), (203, " ".join(["z"] * 300)), (204, " \t" + passage.replace(" ", "\x0b ") + " ")]


@pytest.mark.parametrize("window", [35, 13, 5])
@pytest.mark.parametrize("flush", [500_000, 200])
def test_equals_brute_force(spark, monkeypatch, window, flush):
    monkeypatch.setattr(repeats, "FLUSH", flush)
    monkeypatch.setattr(repeats, "CHUNK", flush * 8)
    rows = sample_rows()
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, spans int").repartition(3)
    got = sorted((tuple(r) for r in repeats.without_repeats(df, window=window).collect()), key=str)
    assert got == brute(rows, window)


def test_hot_groups_take_the_whole_window(spark, monkeypatch):
    """With every group counted as hot, windows are dealt one by one; the result is the same."""
    import numpy as np

    rows = sample_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    real = np.isin
    monkeypatch.setattr(repeats, "LEAST_HOT", 0)
    got = sorted((tuple(r) for r in repeats.without_repeats(df).collect()), key=str)
    assert got == brute(rows, 35)
    assert np.isin is real


def test_empty_table_and_digest(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.repeat_digests(df).count() == 0
    one = spark.createDataFrame([(7, "a  b")], "doc_id long, text string")
    assert [tuple(r) for r in repeats.repeat_digests(one).collect()] == [(7, 2, 0, hashlib.sha256(b"a b").hexdigest())]


def test_many_equal_rows_take_linear_time(spark):
    import time

    rng = random.Random(4)
    text = " ".join(rng.choice("abcdef") + str(rng.randint(0, 99)) for _ in range(300))
    other = "x " + " ".join(text.split()[100:150]) + " y"
    took = []
    for n in (2_000, 50_000):
        df = spark.range(n).selectExpr("7L as doc_id", f"'{text}' as text").unionAll(spark.createDataFrame([(8, other), (9, "a b"), (9, "a b")], "doc_id long, text string"))
        t = time.perf_counter()
        got = {tuple(r): r["count"] for r in repeats.without_repeats(df).groupBy("doc_id", "n_words", "n_removed", "kept").count().collect()}
        took.append(time.perf_counter() - t)
        assert got == {(7, 300, 300, "", n): n, (8, 52, 50, "x y", 1): 1, (9, 2, 0, "a b", 2): 2}
    assert took[1] < 15 * took[0] + 5
