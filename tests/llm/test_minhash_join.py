"""Operator 4 against all pairs."""

import random

import numpy as np
import pytest

from sparkledger.llm import minhash_join as mj


def grams(text):
    w = (text or "").split()
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def brute(rows):
    sets = [grams(t) for _, t in rows]
    n = len(rows)
    link = [[i != j and sets[i] and sets[j] and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]) for j in range(n)] for i in range(n)]
    cls = list(range(n))
    low = lambda i: (rows[i][0] is not None, rows[i][0] or 0)
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            x = todo.pop()
            for y in range(n):
                if link[x][y] and y not in seen:
                    seen.add(y)
                    todo.append(y)
        cls[i] = min(seen, key=low)
    return sorted(((rows[i][0], rows[cls[i]][0], sum(map(bool, link[i])), len({sets[j] for j in range(n) if link[i][j]} - {sets[i]})) for i in range(n)), key=str)


def sample_rows():
    rng = random.Random(4)
    base = [[rng.choice("abcdefghijklmnop") + str(rng.randint(0, 30)) for _ in range(120)] for _ in range(5)]
    rows = []
    for i in range(70):
        w = list(base[i % 5])
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = f"new{rng.randint(0, 9)}"
        rows.append((i, " ".join(w)))
    return rows + [(100, rows[0][1]), (101, "  ".join(rows[0][1].split())), (101, rows[0][1]), (102, None), (103, ""), (None, "a b"), (104, "a b"), (105, "a  b"), (106, "x " * 20000)]


@pytest.mark.parametrize("block", [2048, 7])
def test_equals_all_pairs(spark, block):
    rows = sample_rows()
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, node int").repartition(3)
    from pyspark.sql import functions as F

    got = mj.similarity_classes(df, block=block)
    real = lambda c: F.when(F.col(c) != mj.NO_DOC, F.col(c))
    got = sorted((tuple(r) for r in got.select(real("dk"), real("class_dk"), "n_links", "n_text_links").collect()), key=str)
    assert got == brute(rows)


def test_bands():
    bands, rows = mj.bands_and_rows(0.8, 0.9999)
    assert bands * rows <= mj.MAX_HASHES and 1 - (1 - 0.8 ** rows) ** bands >= 0.9999
    with pytest.raises(ValueError):
        mj.bands_and_rows(0.1, 0.999999, 4)


def test_block_pairs_cover_all_links():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.choice(40, 30)).astype(np.uint64) for _ in range(30)]
    side = lambda s: (np.ones(len(s)), np.concatenate(s), np.array([len(x) for x in s]))
    whole = mj.verify_block(side(sets), None, 0.5)[1]
    a, b = side(sets[:11]), side(sets[11:])
    parts = np.concatenate([mj.verify_block(a, None, 0.5)[1], mj.verify_block(b, None, 0.5)[1]]) + mj.verify_block(a, b, 0.5)[1]
    assert (whole == parts).all()


def test_empty_table(spark):
    assert mj.class_rows(spark.createDataFrame([], "doc_id long, text string")).count() == 0
