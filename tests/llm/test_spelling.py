"""Operator 11 against all pairs of words."""

import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from sparkledger.llm import spelling as sp


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, slip=199):
    counts = Counter()
    for ident, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if ident is None else ident}:{run}".encode())
            if h % slip == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            counts[run] += 1
    vocab = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [x for x in vocab if one_edit(w, x)] for w in vocab}
    form = {}
    for w, others in near.items():
        top = min(others, key=lambda x: (-vocab[x], x), default=None)
        form[w] = top if top and vocab[top] >= 5 * vocab[w] else None
    out = []
    for w, n in vocab.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), vocab[form[w]] if form[w] else None))
    return sorted(out, key=str)


def sample_rows():
    rng = random.Random(11)
    base = ["".join(rng.choice("abcdé×") for _ in range(rng.randint(5, 9))) for _ in range(25)] + ["aaaaaa", "aaaaaaa", "aaaaaaaa", "baaaaaa", "aaabaaa", "abcdefabcdef"]
    words = []
    for w in base:
        words += [w] * rng.choice([5, 30, 160, 900])
        for _ in range(6):
            k = rng.randrange(len(w))
            v = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice("abcd") + w[k:], w[:k] + rng.choice("abcd") + w[k + 1:]])
            words += [v] * rng.choice([4, 5, 6, 31])
    rng.shuffle(words)
    rows = [(i, "".join(w.capitalize() + rng.choice([" ", ", ", "1", "Ā", "_"]) for w in words[i::60])) for i in range(60)]
    return rows + [(61, None), (62, ""), (None, rows[0][1]), (3, rows[3][1]), (3, rows[3][1]), (63, "Étatsun " * 9 + "étatsun " * 9 + "x" * 70000)]


@pytest.mark.parametrize("block,cell_chars", [(2048, 1 << 20), (3, 1 << 20), (2048, 40)])
def test_equals_all_pairs(spark, block, cell_chars):
    rows = sample_rows()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int").repartition(3)
    got = sp.variants(df, block=block, cell_chars=cell_chars)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute(rows)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert any(r[1] and r[1] != r[2] for r in want)  # a chain of forms


def test_slips_and_empty_table(spark):
    rows = sample_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sp.variants(df, slip=3)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, 3)
    assert sp.variants(df.limit(0)).count() == 0


def test_scan_finds_single_edits():
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 7))) for _ in range(400)})
    points, size = sp.word_matrix(words, max(map(len, words)))
    n = len(words)
    a, b = sp.scan(points, size, np.array([0]), np.array([n]), np.arange(n), np.zeros(n, np.int64))
    got = sorted(zip(a.tolist(), b.tolist(), strict=True))
    assert got == sorted((i, j) for i in range(n) for j in range(n) if one_edit(words[i], words[j]))


def test_long_words_and_small_steps(spark):
    rng = random.Random(6)
    long = "".join(rng.choice("abcdef") for _ in range(3000))
    words = {long, long[:-1], "z" + long, long[:1500] + "q" + long[1501:], long[::-1]} | {"abcdef" + "".join(rng.choice("ab") for _ in range(4)) for _ in range(40)}
    df = spark.createDataFrame([(w,) for w in sorted(words)], "word string").repartition(2)
    got = sp.near_words(df, block=8, cell_chars=20_000, step=5000).collect()
    assert sorted(tuple(r) for r in got) == sorted((a, b) for a in words for b in words if one_edit(a, b))
