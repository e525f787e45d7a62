"""Operators 6 and 7 against the public tokenizer libraries and exact round trips."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
tokenizers = pytest.importorskip("tokenizers")

from sparkledger.llm import rans  # noqa: E402
from sparkledger.llm.bpe import bpe_decode, bpe_digests, bpe_encode, rank_table  # noqa: E402
from sparkledger.llm.pretokens import PieceCache, utf8_column  # noqa: E402

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = "ab 's'tre'll  \n\n\t1234é漢字😀 　.,!!''ѣ́ªⅷ\u0000"
HARD = ["", "a" * 5000, "ab" * 3000 + " " * 500 + "x", "don't we're I'll'llx 's 'S", " 'tis", "\n\n\n a", "   ", "<|endoftext|> x", "x\x85y\x1cz", "naïve café"]


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def random_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_encoding_equals_library_and_decodes(reference):
    table = rank_table(RANKS)
    cache = PieceCache(table.encode_pieces, limit=500)  # small, so it starts anew in between
    texts = random_texts(800, 1) + HARD
    for a in range(0, len(texts), 90):
        some = texts[a:a + 90]
        data, offsets = utf8_column(pa.array(some))
        ids, counts = cache.encode_texts(data, offsets)
        assert table.decode(ids).tobytes() == data.tobytes()
        ends = np.cumsum(counts)
        for text, n, end in zip(some, counts, ends):
            assert ids[end - n:end].tolist() == reference.encode_ordinary(text)


DOCS = [(3, "hello world"), (1, None), (None, "no id"), (2, ""), (2, "again again"), (2, "again again"), (9, "z" * 70000 + " tail")]


def docs(spark, rows=DOCS):
    # An extra column under a name that the operators use themselves.
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, ids string, n_tokens int")


def test_query_rows(spark, reference):
    got = sorted((tuple(r) for r in bpe_digests(docs(spark), RANKS).collect()), key=str)
    want = []
    for i, text in DOCS:
        ids = reference.encode_ordinary(text or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert bpe_decode(bpe_encode(docs(spark, []).limit(0), RANKS), RANKS).count() == 0


@pytest.mark.parametrize("block", [1 << 16, 500])
def test_files_round_trip(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(rans, "BLOCK", block)  # the second splits long documents over blocks
    path = str(tmp_path / f"ids{block}")
    rans.write_ids(docs(spark).repartition(3), JSON, path)
    tokenizer = tokenizers.Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    rows = sorted(rans.read_ids(spark, path).collect(), key=lambda r: r["first"])
    assert [r.doc for r in rows] == [None, 1, 2, 2, 2, 3, 9]
    at, left = 0, list(DOCS)
    for r in rows:
        text = next(t for i, t in left if i == r.doc and np.frombuffer(r.ids, "<u4").tolist() == [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0])
        left.remove((r.doc, text))
        assert r["first"] == at and r["size"] == len(r.ids) // 4
        at += r["size"]


def test_files_of_an_empty_table(spark):
    assert rans.file_digests(docs(spark).limit(0), JSON).count() == 0


def test_damage_is_noticed(spark, tmp_path):
    path = str(tmp_path / "bad")
    rans.write_ids(docs(spark), JSON, path)
    from pyspark.sql import functions as F

    blocks = spark.read.parquet(f"{path}/blocks")
    blocks.withColumn("crc", F.col("crc") + 1).write.parquet(f"{path}2/blocks")
    spark.read.parquet(f"{path}/table").write.parquet(f"{path}2/table")
    with pytest.raises(Exception, match="damaged"):
        rans.read_ids(spark, f"{path}2").collect()


def test_coder_on_skewed_and_rare_symbols():
    rng = np.random.default_rng(1)
    counts = np.zeros(50257, np.int64)
    blocks = [rng.integers(0, 50257, 3000).astype(np.uint16), np.zeros(1000, np.uint16), np.array([5], np.uint16), rng.geometric(0.2, 4097).astype(np.uint16)]
    for b in blocks:
        counts += np.bincount(b, minlength=len(counts))
    freq = rans.scaled_frequencies(counts)
    assert freq.sum() == 1 << rans.SCALE_BITS and ((freq > 0) == (counts > 0)).all()
    coder = rans.Coder(freq)
    coded = coder.encode(blocks)
    for b, d in zip(blocks, coder.decode([(len(b), *c) for b, c in zip(blocks, coded)])):
        assert (b == d).all()
    assert rans.scaled_frequencies(np.ones(50257, np.int64)).sum() == 1 << rans.SCALE_BITS
    assert zlib.crc32(b"") == 0
