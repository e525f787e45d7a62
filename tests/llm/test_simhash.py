"""Operator 12 against direct fingerprints and all pairs."""

import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from sparkledger.llm import simhash as sh
from sparkledger.llm.common import connected_components
from sparkledger.llm.pretokens import utf8_column


def fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\v\f\r":
        low = low.replace(blank, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    grams = [words] if len(words) < 4 else [words[i:i + 4] for i in range(len(words) - 3)]
    hashes = [xxhash.xxh64_intdigest(" ".join(g).encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, radius=4):
    up = list(range(len(prints)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= radius:
            up[top(j)] = top(i)
    return [top(i) for i in range(len(prints))]


def expected(rows):
    prints = [fingerprint(t) for _, t in rows]
    comp = components(prints)
    low = lambda i: (i is not None, i or 0)
    least = {}
    for (i, _), c in zip(rows, comp, strict=True):
        least[c] = min(least.get(c, i), i, key=low)
    return sorted(((i, f"{p:016x}", least[c]) for (i, _), p, c in zip(rows, prints, comp, strict=True)), key=str)


def sample_rows():
    rng = random.Random(12)
    base = [[rng.choice("abcdefgh") + str(rng.randint(0, 40)) for _ in range(300)] for _ in range(4)]
    rows = []
    for i in range(90):
        words = list(base[i % 4])
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = f"New{rng.randint(0, 9)}"
        rows.append((i, (" " if i % 2 else "\t\n ").join(words)))
    return rows + [(200, None), (201, ""), (202, " \t"), (203, "One two"), (204, "one  TWO"), (203, "one two"), (205, "Éa b c d É"), (206, "éa b c d é"),
                   (None, rows[0][1]), (None, "a b c d e f"), (207, "x " * 30000), (208, "x y z\x1cw v u")]


@pytest.mark.parametrize("cut,keep,block", [(3, 1, 2048), (3, 1, 5), (6, 3, 7)])
def test_equals_all_pairs(spark, cut, keep, block):
    from pyspark.sql import functions as F

    rows = sample_rows()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, fp int, head string").repartition(3)
    got = sh.simhash_components(df, cut=cut, keep=keep, block=block)
    real = lambda c: F.when(F.col(c) != sh.NO_DOC, F.col(c))
    got = got.select(real("dk"), F.lpad(F.lower(F.hex("fp")), 16, "0"), real("head")).collect()
    want = expected(rows)
    assert sorted((tuple(r) for r in got), key=str) == want
    assert len({r[2] for r in want}) < 60  # near copies are linked


def test_query_and_empty_table(spark):
    rows = sample_rows()
    got = sh.component_rows(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(rows)
    assert sh.component_rows(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def planted(seed, clusters, size):
    """Fingerprints in chains whose neighbours differ by up to four bits."""
    rng = random.Random(seed)
    out = set()
    for _ in range(clusters):
        x = rng.getrandbits(64)
        for _ in range(size):
            out.add(x)
            for b in rng.sample(range(64), rng.randint(0, 5)):
                x ^= 1 << b
    return sorted(out)


@pytest.mark.parametrize("cut,keep,block", [(3, 1, 2048), (3, 1, 16), (6, 3, 2048)])
def test_links_of_random_fingerprints(spark, cut, keep, block):
    # Dense: one segment is the same for many, so cells are large and cut into blocks.
    prints = sorted(set(planted(1, 40, 6)) | {(p & 0xFFFFF) << 44 | 0x123 for p in planted(2, 30, 8)})
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    links = sh.near_fingerprints(df, cut=cut, keep=keep, block=block)
    pairs = links.collect()
    assert all(((r.a ^ r.b) & (2 ** 64 - 1)).bit_count() <= 4 for r in pairs)
    found = {r.node % (1 << 64): r.component for r in connected_components(links).collect()}
    want = components(prints)
    assert len(set(want)) < len(prints)
    names = [found.get(p, ("lone", p)) for p in prints]
    assert len(set(names)) == len(set(zip(names, want, strict=True))) == len(set(want))


def test_masks_leave_one_error():
    for cut, keep in [(3, 1), (4, 1), (6, 3), (5, 2)]:
        masks = sh.segment_masks(4, cut, keep)
        rng = random.Random(3)
        for _ in range(2000):
            flip = sum(1 << b for b in rng.sample(range(64), 4))
            assert min((flip & m).bit_count() for m in masks) <= 1
    for cut, keep in [(2, 1), (6, 4)]:
        with pytest.raises(ValueError):
            sh.segment_masks(4, cut, keep)


def test_counts_over_255_hashes():
    import pyarrow as pa

    text = " ".join(f"w{i % 700}" for i in range(5000))
    hashes, counts = sh.shingle_hashes(*utf8_column(pa.array(["", text, "a b"])))
    assert counts.tolist() == [0, 4997, 1]
    assert [int(x) for x in sh.fingerprints(hashes, counts)] == [fingerprint(t) for t in ("", text, "a b")]
    assert np.array_equal(sh.fingerprints(np.zeros(0, np.uint64), np.zeros(2, np.int64)), np.zeros(2, np.uint64))
