"""Operator 2: restoration, the decoder against all paths, held-out accuracy."""

import itertools
import random
import zlib

import numpy as np

from sparkledger.llm import toxicity as tx

WORDS = "the of and house river stone garden people walk with light under every morning water little green small paper".split()
BAD = "idiot moron stupid".split()


def model_of(words):
    n3 = np.zeros((tx.SIZE,) * 3)
    for w in words:
        s = [0, 0, *(tx.CODE.get(c, tx.SIZE - 1) for c in w), 0]
        for a, b, c in zip(s, s[1:], s[2:]):
            n3[a, b, c] += 1
    return np.log((n3 + 0.05) / (n3 + 0.05).sum(2, keepdims=True))


def test_restores_disguises():
    r = tx.Restorer(model_of(WORDS + BAD * 3))
    for text, want in (("you 1d10t", "you idiot"), ("i d i o t", "idiot"), ("idiooot", "idiot"), ("m.o.r.o.n", "moron"), ("5tup1d!", "stupid!"), ("plain words, 12 of 30", "plain words, 12 of 30"), ("", "")):
        assert r.restore(text) == want
    assert "idiot" in r.words("he is an 1 d 1 0 t of " + "x" * 100_000)


def test_decoder_finds_the_cheapest_path():
    model = model_of(WORDS + BAD)

    def cost(chars):
        total, a, b = 0.0, 0, 0
        for c in chars:
            if c == " ":
                total, a, b = total - (model[a, b, 0] if b else 0), 0, 0
            else:
                k = tx.CODE.get(c, tx.SIZE - 1)
                total, a, b = total - model[a, b, k], b, k
        return total - (model[a, b, 0] if b else 0)

    for span in ("1d10t", "m.o r0n", "st*p1d", "i d 1 o t"):
        best = min((sum(x[1] for x in p) + cost("".join(x[0] for x in p).strip(" ").replace("  ", " ")), "".join(x[0] for x in p).replace("  ", " ").strip()) for p in itertools.product(*tx.lattice(span)))
        assert tx.decode(span, model).strip() == best[1]


def data(spark):
    rng = random.Random(5)
    docs, labels = [], []
    for i in range(600):
        words = [rng.choice(WORDS) + rng.choice(["", "", "s"]) for _ in range(rng.randint(20, 80))]
        toxic = i % 6 == 0
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(BAD if i % 12 else ["1d10t", "s t u p i d", "moroooon"]))
        docs.append((i, " ".join(words)))
        if i % 7:
            labels.append((i, int(toxic)))
    docs += [(900, None), (901, ""), (None, "the house"), (5, docs[5][1])]
    labels += [(None, 1), (1, None), (901, 1)]
    return (spark.createDataFrame([(*d, 0.5, "l") for d in docs], "doc_id long, text string, score double, toxic string").repartition(3),
            spark.createDataFrame(labels, "doc_id long, toxic int"), docs)


def test_held_out_accuracy_and_rows(spark):
    docs, labels, rows = data(spark)
    got = tx.toxicity(docs, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        held = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1
        assert r.held_out == held and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [r for r in got if r.held_out and r.doc_id < 600]
    right = sum(r.predicted == (r.doc_id % 6 == 0) for r in held)
    assert right >= 0.97 * len(held)


def test_only_near_copies_count_once(spark):
    rng = random.Random(3)
    # A phrase whose hash is the least of every text that holds it.
    phrase = min((" ".join(rng.choices(WORDS, k=5)) for _ in range(20_000)), key=lambda p: zlib.crc32(p.encode()))
    text = lambda: " ".join(rng.choices(WORDS, k=30))
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 != 1][:80]
    copied = text() + " idiot " + text()
    docs = [(i, f"{text()} {phrase} idiot {text()}") for i in ids[:20]]  # they share the phrase and no more
    docs += [(i, copied + (" end" if i % 2 else "")) for i in ids[20:40]]  # near copies of one text
    docs += [(i, text()) for i in ids[40:]]
    docs += [(ids[0], "short"), (ids[50], "")]  # a second text of an id
    labels = spark.createDataFrame([(i, int(k < 40)) for k, i in enumerate(ids)], "doc_id long, toxic int")
    share, usual, tree = tx.fit(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), labels, model_of(WORDS + BAD * 3))
    assert np.isclose(share, 21 / 61) and tree["idiot"] == (21, 21)
    reader = tx.Restorer(model_of(WORDS + BAD * 3))
    assert np.isclose(usual, np.mean([len(reader.words(d)) for _, d in [*docs[:21], *docs[40:80]]]))


def test_empty_tables(spark):
    docs, labels, _ = data(spark)
    assert tx.toxicity(docs.limit(0), labels).count() == 0
    assert {r.score for r in tx.toxicity(docs, labels.limit(0)).collect()} == {0.0}
