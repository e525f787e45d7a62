"""Helpers, and the pipeline against its stages done by brute force."""

import random

import numpy as np

import corpus_pipeline
from sparkledger.llm import toxicity
from sparkledger.llm.common import HashIndex, connected_components
from sparkledger.llm.pii import base_spans


def test_hash_index():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 63, 900, dtype=np.uint64))
    index = HashIndex(10)
    index.add(keys, np.arange(len(keys), dtype=np.int32))
    assert (index.find(keys) == np.arange(len(keys))).all()
    assert (index.find(keys + np.uint64(1)) == -1).sum() >= len(keys) - 2


def test_connected_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100 + rng.randrange(30), 100 + rng.randrange(30)) for _ in range(15)] + [(7, 7), (300, 200)]
    label = {x: x for e in edges for x in e}
    for _ in range(60):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: c for x, c in label.items() if x in linked}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_stages(spark, tmp_path):
    rng = random.Random(11)
    words = "the of and house river stone garden people walk with light under every morning water".split()
    item = " ".join(rng.choice(words) + str(i) for i in range(20))
    docs, labels, kinds = [], [], {}
    for i in range(400):
        w = [rng.choice(words) + rng.choice(["", "s", "ly", "er"]) for _ in range(40)]
        kind = ("clean", "toxic", "leak", "mail")[i % 4]
        if kind == "toxic":
            w.insert(9, rng.choice(["idiot", "moron"]))
        if kind == "leak":
            w[5:5] = item.split()
        if kind == "mail":
            w.insert(9, f"anna.{i}@mail.example.com")
        kinds[i] = kind
        docs.append((i, " ".join(w), "en", "s", 1))
        labels.append((i, int(kind == "toxic")))
    docs += [(1000 + i, docs[i * 4][1], "en", "s", 1) for i in range(10)] + [(2000, None, "en", "s", None), (2001, "", "en", "s", 0), (0, docs[0][1], "en", "s", 1)]
    folder = str(tmp_path)
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    now = spark.read.parquet(f"{folder}/documents.parquet")
    columns = now.columns
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, folder).cache()
        seen.append((name, now))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert now.columns == columns
    ids = [sorted(r.doc_id for r in df.select("doc_id").collect()) for _, df in seen]
    assert ids[0] == sorted(d[0] for d in docs if kinds.get(d[0]) != "toxic")
    assert ids[1] == sorted({d[0] for d in docs if kinds.get(d[0]) != "toxic" and not 1000 <= d[0] < 2000})
    assert ids[2] == [i for i in ids[1] if kinds.get(i) != "leak"]
    assert ids[3] == ids[2] == ids[4]
    for r in seen[3][1].collect():
        assert not base_spans(r.text or "") and (r.n_chars == len(r.text) if r.text is not None else r.n_chars is None)
        assert ("<email>" in (r.text or "")) == (kinds.get(r.doc_id) == "mail")
    whole = {r.doc_id: (r.n_tokens, bytes(r.ids)) for r in corpus_pipeline.run(spark, folder).collect()}
    assert whole == {r.doc_id: (r.n_tokens, bytes(r.ids)) for r in seen[4][1].collect()}
    assert toxicity.THRESHOLD == 0.7
