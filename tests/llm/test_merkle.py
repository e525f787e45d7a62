"""Operator 13 against direct trees."""

import random
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest

from sparkledger.llm import merkle as mk


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, lower=False):
    doc_id, source, lang, n_chars, text = row
    if lower and text is not None:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([h(*low[i:i + 16]) for i in range(0, len(low), 16)])
    return levels


def siblings(levels, i):
    out = []
    for low in levels[:-1]:
        first = i // 16 * 16
        run = low[first:first + 16]
        out.append((run[:i - first], run[i - first + 1:]))
        i //= 16
    return out


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = tree([leaf(r) for r in groups[s]])
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, r in enumerate(groups[s]):
            path = siblings(trees[s], i) + siblings(top, k)
            bad = r[0] is not None and crc32(str(r[0]).encode()) % 5 == 0
            node = leaf(r, bad)
            for a, b in path:
                node = h(*a, node, *b)
            out.append((r[0], leaf(r), trees[s][-1][0], top[-1][0], h(*(x for a, b in path for x in a + b)), node, node == top[-1][0]))
    return sorted(out, key=str)


def sample_rows():
    rng = random.Random(13)
    sizes = {"a": 1, "B": 16, "b": 17, "é": 300, None: 40, "": 5, "z": 256, "zz": 257, **{f"s{i}": 2 for i in range(18)}}
    rows = []
    for s, n in sizes.items():
        for _ in range(n):
            i = len(rows)
            rows.append((i, s, rng.choice(["en", "", None]), rng.choice([None, i]), rng.choice([None, "", "Text", "text", "ÉA " * rng.randint(1, 4)])))
    rows += [(None, "z", "en", 1, "Null id"), (None, None, None, None, None), (3, "b", "en", 4, "X"), (3, "b", "en", 4, "Y"), (3, "b", "en", 4, "Y"), (10**12, "a", "de", 7, "Long " * 40000)]
    rng.shuffle(rows)
    return rows


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("height", [1, 2, 3])
def test_equals_direct_trees(spark, height):
    rows = sample_rows()
    df = spark.createDataFrame([(*r, "x", 1, b"") for r in rows], SCHEMA + ", leaf string, pos int, root binary").repartition(5)
    got = mk.merkle_rows(df, height)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = brute(rows)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert {r[6] for r in want} == {True, False}


def test_small_and_empty_tables(spark):
    one = [(5, "a", "en", 1, "T")]
    assert [tuple(r) for r in mk.merkle_rows(spark.createDataFrame(one, SCHEMA)).collect()] == brute(one)
    none = spark.createDataFrame([], SCHEMA)
    assert mk.merkle_rows(none).count() == 0
    assert mk.manifest(none).root() is None
    assert mk.manifest(spark.createDataFrame(one, SCHEMA)).root() == leaf(one[0])


def test_addresses_are_a_van_emde_boas_layout():
    for levels in range(1, 5):
        for n in {1, 2, 15, 16, 17, 255, 256, 257, 1000, 4096}:
            if not mk.levels_over(n) <= levels or n > 16 ** (levels - 1):
                continue
            at = mk.layout(n, levels)
            assert sorted(np.concatenate(at).tolist()) == list(range(mk.tree_size(n, levels)))
    # Three levels: the root, then each subtree of two levels in one piece.
    at = mk.layout(256, 3)
    assert at[2].tolist() == [0] and at[1].tolist() == [1 + 17 * k for k in range(16)]
    assert at[0][:16].tolist() == list(range(2, 18))
    # Five levels: two on top, three below; a subtree's nodes lie together.
    at = mk.layout(16 ** 4, 5)
    assert at[4].tolist() == [0] and at[3].tolist() == list(range(1, 17))
    assert at[2][1] == 17 + 273 and at[0][256] == 17 + 273 + 2


def test_block_siblings_and_paths():
    leaves = np.random.default_rng(1).integers(0, 256, (300, 32), dtype=np.uint8)
    levels = tree([x.tobytes().hex() for x in leaves])
    block = mk.Block(300, 4, mk.build_block(leaves, mk.levels_over(300)).tobytes())
    for i in (0, 15, 16, 255, 256, 299):
        got = [(block.raw[at[:k]].tobytes(), block.raw[at[k + 1:]].tobytes()) for at, k in block.path(i)]
        want = [(bytes.fromhex("".join(a)), bytes.fromhex("".join(b))) for a, b in siblings(levels, i)]
        assert got == want == mk.unpack(mk.pack(got))
