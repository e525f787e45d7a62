"""Operator 8 against exact search."""

import numpy as np
import pytest

from sparkledger.llm import multi_index as mi


def exact(ids, x, q, k):
    i = np.flatnonzero(ids == q)[0]
    s = (x * x[i]).sum(1)
    s[ids == q] = -np.inf
    best = {}
    for e, v in zip(ids, s):
        if np.isfinite(v):
            best[int(e)] = max(best.get(int(e), -np.inf), v)
    return [e for e, _ in sorted(best.items(), key=lambda p: (-p[1], p[0]))[:k]]


@pytest.mark.parametrize("scale", [0.0, 1.0])
def test_recall_and_order(spark, scale):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 16)) * np.exp(scale * rng.normal(size=(1500, 1)))
    x[700:900] = x[700]  # a large group of copies
    ids = np.arange(1500)
    rows = [(int(i), v.tolist(), 1) for i, v in zip(ids, x)] + [(5001, None, 1), (5020, [0.0] * 16, 1), (5040, [float("nan")] * 16, 1), (5060, [None] * 16, 1), (5080, [1.0], 1), (None, [1.0] * 16, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int").repartition(3)
    got = {}
    for r in mi.search(df, df.where("vec_id % 20 = 0"), share=0.45, least=100).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == {i for i in range(0, 1500, 20)}
    hit = total = 0
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert all(np.isclose(s, x[v] @ x[q], rtol=1e-12) for _, v, s in found)
        assert found == sorted(found, key=lambda f: (-f[2], f[1]))
        want = exact(ids, x, q, 20)
        hit += len(set(want) & {v for _, v, _ in found})
        total += 20
    assert hit / total >= 0.9


def test_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [0.5, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<double>")
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in mi.every_twentieth(df).orderBy("rank").collect()]
    assert got == [(0, 1, 2, 1.0), (0, 2, 1, 0.5)]
    assert mi.every_twentieth(df.limit(0)).count() == 0


def test_repeated_ids_take_no_places(spark):
    rng = np.random.default_rng(4)
    near = [[1.0, float(i) / 1000] for i in range(30)]
    rows = [(0, [1.0, 0.0])] + [(i + 1, v) for i, v in enumerate(near)]
    rows += [(77, [2.0, 0.0])] * 60  # one row many times
    rows += [(78, [3.0, float(x) / 100]) for x in rng.normal(size=300)]  # one id with many vectors
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = [r.vec_id for r in mi.search(df, df.where("vec_id = 0"), least=10_000).orderBy("rank").collect()]
    assert got == [78, 77, *range(1, 19)]


def test_copies_do_not_spend_the_probe_share(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 8)))]
    seen = []
    walk = mi.Codebooks.__init__
    monkeypatch.setattr(mi.Codebooks, "__init__", lambda self, sample, *a: (seen.append(len({tuple(x) for x in sample.tolist()}) == len(sample)), walk(self, sample, *a))[1])
    plain, copied = (spark.createDataFrame(r, "vec_id long, embedding array<double>") for r in (rows, rows + [rows[7]] * 400))
    found = [sorted(map(tuple, mi.search(df, df.where("vec_id % 20 = 0"), least=21).collect())) for df in (plain, copied)]
    assert found[0] == found[1] and seen == [True, True]


def test_walk_draws_cells_in_order():
    rng = np.random.default_rng(1)
    books = mi.Codebooks(rng.normal(size=(300, 6)), 5.0, 8)
    counts = rng.integers(0, 4, 64)
    q = rng.normal(size=6)
    y = np.append(q * 5.0 / np.linalg.norm(q), 0.0)
    d = [((c - h) ** 2).sum(1) for c, h in zip(books.halves, (y[:books.cut], y[books.cut:]))]
    total = (d[0][:, None] + d[1][None]).reshape(-1)
    want = [int(c) for c in np.argsort(total, kind="stable") if counts[c]]
    assert books.walk(q, counts, int(counts.sum())) == want
